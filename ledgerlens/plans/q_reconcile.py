"""Reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import reconcile as RC
from ledgerlens.session import cut_lineage
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.operators import sla as SL
from ledgerlens.plans.q_sla import atraso_sql_body, payments_due
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import AS_OF_ORDERS_SQL as T, digits_sql, token_set_ctes
from ledgerlens.sources import fixtures as X

AS_OF = X.AS_OF_ORDERS
START_DATE = "2001-01-01"


def clean_key_sql(x: str) -> str:
    s = f"regexp_replace(trim({x}), '\\.0$', '')"
    return f"CASE WHEN lower({s}) IN ('', 'none', 'nan', 'null', '<na>', 'nat') THEN NULL ELSE {s} END"


def cpf_mask_sql(x: str) -> str:
    d = f"lpad({digits_sql(x)}, 11, '0')"
    return (f"CASE WHEN {x} IS NULL OR {x} = 'None' THEN NULL ELSE substr({d}, 1, 3) || '.' || substr({d}, 4, 3)"
            f" || '.' || substr({d}, 7, 3) || '-' || substr({d}, 10, 2) END")


_PREP = f"""
st AS (
  SELECT src_id, nom_banco, banco_id, num_proposta, num_contrato, val_comissao, val_repasse, val_liberado,
         status_producao, tipo_operacao, dat_credito, dsc_produto, dsc_convenio, prazo,
         dat_emprestimo AS data_emprestimo, dat_credito AS data_contrato,
         {clean_key_sql('num_proposta')} AS numero_proposta, {clean_key_sql('num_contrato')} AS numero_contrato,
         {cpf_mask_sql('cliente_id')} AS cliente_id, CAST(val_liberado AS DECIMAL(18,2)) AS valor_liberado
  FROM contratos_bancos),
prod AS (
  SELECT id, {clean_key_sql('numero_proposta')} AS numero_proposta, {clean_key_sql('numero_contrato')} AS numero_contrato,
         CAST(banco_id AS BIGINT) AS banco_id, {cpf_mask_sql('cliente_id')} AS cliente_id,
         CAST(valor_liberado AS DECIMAL(18,2)) AS valor_liberado, valor_comissao, data_contrato, convenio
  FROM producao_all
  WHERE data_contrato BETWEEN (SELECT MIN(dat_emprestimo) FROM contratos_bancos)
                          AND (SELECT MAX(dat_emprestimo) FROM contratos_bancos))"""


def _stages_sql(stages, left="st", right="prod", lid="src_id", rid="id") -> str:
    parts = []
    for i, (name, keys) in enumerate(stages, start=1):
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        prev = " UNION ALL ".join(f"SELECT {{c}} FROM s{j}" for j in range(1, i))
        lx = f" AND {lid} NOT IN ({prev.format(c=lid)})" if prev else ""
        rx = f" AND {rid} NOT IN ({prev.format(c=rid)})" if prev else ""
        kl = ", ".join(keys)
        on = " AND ".join(f"l.{k} = r.{k}" for k in keys)
        parts.append(f"""s{i} AS (
  SELECT l.{lid}, r.{rid}, {i} AS etapa, '{name}' AS etapa_nome
  FROM (SELECT {lid}, {kl}, row_number() OVER (PARTITION BY {kl} ORDER BY {lid}) AS rn FROM {left} WHERE {nn}{lx}) l
  JOIN (SELECT {rid}, {kl}, row_number() OVER (PARTITION BY {kl} ORDER BY {rid}) AS rn FROM {right} WHERE {nn}{rx}) r
    ON {on} AND l.rn = r.rn)""")
    union = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(1, len(stages) + 1))
    return ",\n".join(parts) + f",\npairs AS ({union})"


_BASE = f"WITH {_PREP},\n{_stages_sql(RC.STAGES)}\n"
_FIX = ["producao_all", "contratos_bancos"]


def _prepared(spark, sf_dir, *columns, stages=RC.STAGES):
    # the prepared statements feed the span filter, the pairing and the
    # reports: materialise them once, with the columns that these read
    keys = sorted({c for _, ks in stages for c in ks})
    st = RC.prepare_statements(X.bank_statements(spark, sf_dir)).select(*dict.fromkeys(["src_id", *keys, "dat_emprestimo", *columns]))
    st = cut_lineage(st, "statements")
    prod = RC.prepare_production(RC.production_in_span(X.production(spark, sf_dir), st))
    return st, prod


def _pairs(spark, sf_dir, *columns):
    st, prod = _prepared(spark, sf_dir, *columns)
    return st, prod, RC.staged_pairing(st, prod, RC.STAGES, left_held=True)


@query("conciliacao_etapas", with_fixtures(_BASE + "SELECT * FROM pairs", _FIX), headline=True)
def conciliacao_etapas(spark, sf_dir):
    return _pairs(spark, sf_dir)[2]


@query("conciliacao_resumo", with_fixtures(
    _BASE + "SELECT etapa, etapa_nome, CAST(COUNT(*) AS BIGINT) AS registros FROM pairs GROUP BY etapa, etapa_nome", _FIX))
def conciliacao_resumo(spark, sf_dir):
    return RC.stage_summary(_pairs(spark, sf_dir)[2])


@query("nao_encontrados_bancos", with_fixtures(
    _BASE + "SELECT src_id, nom_banco, numero_proposta, numero_contrato, cliente_id, valor_liberado FROM st "
            "WHERE src_id NOT IN (SELECT src_id FROM pairs)", _FIX))
def nao_encontrados_bancos(spark, sf_dir):
    st, _, pairs = _pairs(spark, sf_dir, "nom_banco")
    return RC.unmatched(st, pairs, "src_id").select(
        "src_id", "nom_banco", "numero_proposta", "numero_contrato", "cliente_id", "valor_liberado")


@query("nao_encontrados_ecb", with_fixtures(
    _BASE + "SELECT id, numero_proposta, numero_contrato, cliente_id, valor_liberado FROM prod "
            "WHERE id NOT IN (SELECT id FROM pairs)", _FIX))
def nao_encontrados_ecb(spark, sf_dir):
    _, prod, pairs = _pairs(spark, sf_dir)
    return RC.unmatched(prod, pairs, "id").select("id", "numero_proposta", "numero_contrato", "cliente_id",
                                                  "valor_liberado")


_RATE_SQL = f"""
se AS (
  SELECT src_id, data_emprestimo,
    upper(trim(nullif(trim(regexp_extract(upper(dsc_produto), '^(.*?)\\s*-\\s*TAXA', 1)), ''))) AS regra_extraida,
    TRY_CAST(replace(nullif(regexp_extract(upper(dsc_produto), 'TAXA\\s+([\\d,]+)%', 1), ''), ',', '.') AS DOUBLE) AS taxa_extraida,
    upper(trim(nullif(regexp_extract(upper(dsc_produto), 'C[ÓO]D\\.?\\s*(\\d+)', 1), ''))) AS codigo_extraido
  FROM st),
rt AS (
  SELECT upper(trim(descricao_banco)) AS regra, upper(trim(codigo)) AS inicio_regra, taxa_total AS taxa_com_seguro,
         taxa_vista AS taxa_sem_seguro, comissao_vista AS perc_empresa_avista, data_inicio,
         coalesce(data_fim, DATE '2099-12-31') AS data_fim, id AS taxa_id
  FROM tabela_taxas),
cand AS (
  SELECT se.src_id, rt.taxa_id, rt.perc_empresa_avista,
         coalesce(round(se.taxa_extraida, 2) = round(rt.taxa_com_seguro, 2)
                  OR round(se.taxa_extraida, 2) = round(rt.taxa_sem_seguro, 2), false) AS match_taxa
  FROM se JOIN rt ON se.regra_extraida = rt.regra AND se.codigo_extraido = rt.inicio_regra
  WHERE se.data_emprestimo >= CAST(rt.data_inicio AS TIMESTAMP) AND se.data_emprestimo <= CAST(rt.data_fim AS TIMESTAMP)),
best AS (
  SELECT src_id, taxa_id, match_taxa, perc_empresa_avista FROM (
    SELECT *, row_number() OVER (PARTITION BY src_id ORDER BY match_taxa DESC, perc_empresa_avista DESC, taxa_id DESC) AS rn
    FROM cand) WHERE rn = 1)"""

TAXA_SQL = with_fixtures(f"WITH {_PREP},{_RATE_SQL} SELECT * FROM best", _FIX + ["tabela_taxas"])


def _rates(spark, sf_dir):
    # no pairing here: the statements are read once, so no materialisation
    st = RC.prepare_statements(X.bank_statements(spark, sf_dir))
    return st, RC.effective_rate(st, X.rate_table(spark, sf_dir))


@query("taxa_vigente", TAXA_SQL, headline=True)
def taxa_vigente(spark, sf_dir):
    return _rates(spark, sf_dir)[1].select("src_id", "taxa_id", "match_taxa", "perc_empresa_avista")


RECALC_SQL = with_fixtures(f"""WITH {_PREP},{_RATE_SQL}
SELECT st.src_id,
  CASE WHEN upper(coalesce(st.nom_banco, '')) LIKE '%SANTANDER%' AND st.val_repasse IS NOT NULL
            AND st.val_comissao IS NOT NULL AND b.perc_empresa_avista IS NOT NULL
       THEN round(CAST(st.val_liberado AS DOUBLE) * (b.perc_empresa_avista / 100.0), 2)
       ELSE CAST(st.val_comissao AS DOUBLE) END AS val_comissao_total
FROM st LEFT JOIN best b ON b.src_id = st.src_id""", _FIX + ["tabela_taxas"])


@query("comissao_recalculada", RECALC_SQL)
def comissao_recalculada(spark, sf_dir):
    st, best = _rates(spark, sf_dir)
    return RC.expected_commission(st, best).select("src_id", "val_comissao_total")


# the payment block is the payment query's own SQL
_PAY = atraso_sql_body(SL.DEFAULT_SLA)
_REPORT_COLS = "nom_banco, num_proposta, num_contrato, val_comissao, status_producao, tipo_operacao, val_liberado, dat_credito"
REPORT_SQL = with_fixtures(_BASE + f""",
recente AS (SELECT *, ifnull(data_contrato::DATE >= greatest({T}::DATE - 30, DATE '{START_DATE}'), true) AS dentro FROM st),
blocos AS (
  SELECT 1 AS p, 'PAGAMENTOS' AS tabela, c.src_id AS rid, c.nom_banco, c.num_proposta, c.num_contrato, c.val_comissao,
         c.status_producao, c.tipo_operacao, c.val_liberado, c.dat_credito, pg.data_esperada_pgto, pg.status_pgto
  FROM contratos_bancos c JOIN ({_PAY}) pg ON pg.src_id = c.src_id
  UNION ALL BY NAME
  SELECT 2 AS p, 'NAO_ENCONTRADOS_ECB' AS tabela, id AS rid, numero_proposta AS num_proposta, numero_contrato AS num_contrato,
         valor_comissao AS val_comissao, valor_liberado AS val_liberado, data_contrato AS dat_credito
  FROM prod ANTI JOIN pairs USING (id)
  UNION ALL BY NAME SELECT 3 AS p, 'COMISSAO_NULA' AS tabela, src_id AS rid, {_REPORT_COLS} FROM recente WHERE dentro AND val_comissao IS NULL
  UNION ALL BY NAME SELECT 4 AS p, 'COMISSAO_ZERO' AS tabela, src_id AS rid, {_REPORT_COLS} FROM recente WHERE dentro AND val_comissao = 0
  UNION ALL BY NAME SELECT 5 AS p, 'PAGO' AS tabela, src_id AS rid, {_REPORT_COLS} FROM st
  WHERE status_producao = 'pago' AND val_comissao IS NOT NULL)
SELECT * EXCLUDE (p, rid) REPLACE (val_comissao::DECIMAL(18,2) AS val_comissao, val_liberado::DECIMAL(18,2) AS val_liberado)
FROM (FROM blocos WHERE dat_credito >= {T} - INTERVAL 63 DAY
      QUALIFY row_number() OVER (PARTITION BY num_proposta ORDER BY p, rid) = 1)
WHERE ifnull(nom_banco, '') NOT IN ('SABEMI', 'BANCO DO BRASIL')""", _FIX)


@query("report_conciliacao", REPORT_SQL, headline=True)
def report_conciliacao(spark, sf_dir):
    # the payments read the statements on disk too, for their dates and for the calendar's span
    st, prod, pairs = _pairs(spark, sf_dir, *RC.REPORT_STATEMENT_COLUMNS, "plataforma", "dat_confirmacao")
    return RC.report(st, prod, pairs, payments_due(spark, st), AS_OF, START_DATE)


CONVENIOS_SQL = with_fixtures(_BASE.rstrip() + f""",
pares_texto AS (
  SELECT src_id, prod.id, s.dsc_convenio, prod.convenio, s.dsc_convenio AS a, prod.convenio AS b
  FROM pairs JOIN st s USING (src_id) JOIN prod ON prod.id = pairs.id),
{token_set_ctes('pares_texto')}
SELECT src_id, id, dsc_convenio, convenio, semelhanca FROM pares_texto p
JOIN pontuado q ON q.a IS NOT DISTINCT FROM p.a AND q.b IS NOT DISTINCT FROM p.b""", _FIX)


@query("semelhanca_convenios", CONVENIOS_SQL)
def semelhanca_convenios(spark, sf_dir):
    """F17/J29 on matched pairs."""
    st, prod, pairs = _pairs(spark, sf_dir, "dsc_convenio")
    return RC.agreement_similarity(st, prod, pairs).select("src_id", "id", "dsc_convenio", "convenio", "semelhanca")


UNICA_SQL = with_fixtures(f"""WITH {_PREP},
{_stages_sql(RC.SINGLE_STAGE)}
SELECT * FROM pairs""", _FIX)


@query("conciliacao_etapa_unica", UNICA_SQL)
def conciliacao_etapa_unica(spark, sf_dir):
    st, prod = _prepared(spark, sf_dir, stages=RC.SINGLE_STAGE)
    return RC.staged_pairing(st, prod, RC.SINGLE_STAGE, left_held=True)


_VIEW_COLS = ("nom_banco, num_proposta, num_contrato, cliente_id, val_repasse, val_comissao, dat_emprestimo, "
              "status_producao, banco_id, tipo_operacao, val_liberado, dat_credito, dsc_produto, prazo, dsc_convenio, "
              "val_bruto")
EMPILHAR_SQL = with_fixtures(f"""
WITH nova AS (SELECT {_VIEW_COLS} FROM contratos_bancos WHERE banco_id <> 2),
bb AS (SELECT {_VIEW_COLS.replace('status_producao', "CASE WHEN status_producao = 'pago' THEN 'PRODUÇÃO' ELSE status_producao END AS status_producao")}
       FROM contratos_bancos WHERE banco_id = 2)
SELECT DISTINCT * FROM (
  SELECT nom_banco, num_proposta, num_contrato, cliente_id, val_repasse, val_comissao, dat_emprestimo, status_producao,
         banco_id, 'NOVA' AS plataforma, tipo_operacao, val_repasse AS val_liberado, dat_credito, dsc_produto, prazo,
         dsc_convenio, val_bruto
  FROM nova WHERE contains(upper(status_producao), 'PAGO')
  UNION ALL
  SELECT nom_banco, num_proposta, num_contrato, cliente_id, val_repasse, val_comissao, dat_emprestimo, status_producao,
         CAST(3 AS BIGINT), 'BB', NULL, val_liberado, dat_credito, NULL, prazo, NULL, val_bruto
  FROM bb WHERE upper(status_producao) = 'PRODUÇÃO')""", ["contratos_bancos"])


@query("empilhar_fontes", EMPILHAR_SQL)
def empilhar_fontes(spark, sf_dir):
    """The NOVA view (every bank but BB) and the BB view (bank 2,
    paid lines reported as in production) stacked with platform tags."""
    st = X.bank_statements(spark, sf_dir)
    nova = st.filter(F.col("banco_id") != 2)
    bb = st.filter(F.col("banco_id") == 2).withColumn(
        "status_producao", F.when(F.col("status_producao") == "pago", F.lit("PRODUÇÃO")).otherwise(F.col("status_producao")))
    return RC.stack_platform_views(nova, bb)
