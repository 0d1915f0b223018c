"""Funnel queries."""

from __future__ import annotations

from ledgerlens.operators import funnel as FN
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import ddd_state_cte, digits_sql, ticket_sql
from ledgerlens.sources import fixtures as X


def _sem9(x: str) -> str:
    return f"CASE WHEN length({x}) >= 11 AND substr({x}, 3, 1) = '9' THEN substr({x}, 1, 2) || substr({x}, 4) ELSE {x} END"


def _bins(v: str, edges, labels) -> str:
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        hi_s = "'inf'::DOUBLE" if hi == float("inf") else str(hi)
        parts.append(f"WHEN {v} > {lo} AND {v} <= {hi_s} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def _short(d: str, suf: str) -> str:
    return (f"CASE WHEN {d} IS NULL THEN NULL WHEN {d} < 0 THEN '<D0{suf}' WHEN {d} = 0 THEN 'D0{suf}' "
            f"WHEN {d} = 1 THEN 'D1{suf}' WHEN {d} = 2 THEN 'D2{suf}' ELSE 'D3+{suf}' END")


_LOCAL = (f"CASE WHEN starts_with({digits_sql('nc.telefone')}, '55') AND length({digits_sql('nc.telefone')}) > 11 "
          f"THEN substr({digits_sql('nc.telefone')}, 3) ELSE {digits_sql('nc.telefone')} END")
_LEAD_COLS = FN.LEAD_COLS
_PICK = ",\n       ".join(f"CASE WHEN a.data_chegada IS NOT NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in _LEAD_COLS)
_BUCKET = ("CASE WHEN dias IS NULL THEN NULL WHEN dias < 0 THEN '<D0' " +
           " ".join(f"WHEN dias = {i} THEN 'D{i}'" for i in range(6)) + " ELSE 'D6+' END")

_FUNNEL = f"""
ddd_estado AS ({ddd_state_cte()}),
stats AS (
  SELECT atendimento_id, CAST(COUNT(*) AS BIGINT) AS total_mensagens,
         MIN(CASE WHEN direcao = 'out' AND (tipo IS NULL OR tipo <> 'aviso') THEN criado_em END) AS data_inicio
  FROM crm_whatsapp GROUP BY atendimento_id),
tag AS (
  SELECT contato_id, etiqueta_id FROM (
    SELECT contato_id, etiqueta_id,
           row_number() OVER (PARTITION BY contato_id ORDER BY data_etiqueta DESC, etiqueta_id DESC) AS rn
    FROM crm_contato_etiquetas WHERE etiqueta_id IN (30, 20, 15)) WHERE rn = 1),
crm AS (
  SELECT a.id AS atendimento_id, a.contato_id, cc.contato, s.data_inicio,
         CAST(coalesce(s.total_mensagens, 0) AS BIGINT) AS total_mensagens, t.etiqueta_id,
         nullif({digits_sql('cc.contato')}, '') AS telefone
  FROM crm_atendimentos a JOIN contato_cliente cc ON cc.id = a.contato_id
  LEFT JOIN stats s ON s.atendimento_id = a.id LEFT JOIN tag t ON t.contato_id = a.contato_id
  WHERE s.data_inicio IS NOT NULL),
crm2 AS (SELECT *, {_sem9('telefone')} AS telefone_sem9 FROM crm),
ck AS (
  SELECT nc.id, nullif({digits_sql('nc.telefone')}, '') AS telefone, nc.data_chegada, nc.data_insercao, nc.ano,
         nc.valor, nc.tipo_veiculo, {ticket_sql('nc.valor')} AS classificacao_ticket, de.uf AS estado, ipc.genero,
         ipc.semelhanca, ipc.data_nascimento, nc.canal
  FROM negociacao_cockpit nc
  LEFT JOIN enriquecimento_lead ipc ON ipc.negociacao_id = nc.id
  LEFT JOIN ddd_estado de ON length({_LOCAL}) >= 10 AND de.ddd = TRY_CAST(substr({_LOCAL}, 1, 2) AS INTEGER)),
ck2 AS (SELECT *, {_sem9('telefone')} AS telefone_sem9 FROM ck WHERE telefone IS NOT NULL),
la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY telefone
         ORDER BY data_chegada DESC, data_insercao DESC, id DESC) AS rn FROM ck2) WHERE rn = 1),
lb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY telefone_sem9
         ORDER BY data_chegada DESC, data_insercao DESC, id DESC) AS rn FROM ck2) WHERE rn = 1),
m AS (
  SELECT crm2.*, {_PICK.replace('a.', 'a.').replace('b.', 'b.')}
  FROM crm2 LEFT JOIN la a ON a.telefone = crm2.telefone LEFT JOIN lb b ON b.telefone_sem9 = crm2.telefone_sem9),
prod AS (
  SELECT nullif({digits_sql('telefone_cliente')}, '') AS telefone, valor_comissao
  FROM producao_fin_banco WHERE origem_venda = 'CAMPANHA' AND data_cancelamento IS NULL),
prod2 AS (SELECT *, {_sem9('telefone')} AS telefone_sem9 FROM prod),
r1 AS (SELECT telefone, SUM(valor_comissao) AS r1 FROM prod2 WHERE telefone IS NOT NULL GROUP BY telefone),
r2 AS (SELECT telefone_sem9, SUM(valor_comissao) AS r2 FROM prod2 WHERE telefone_sem9 IS NOT NULL GROUP BY telefone_sem9),
f0 AS (
  SELECT m.*, CAST(coalesce(r1.r1, r2.r2, 0) AS DECIMAL(38,2)) AS receita_total,
         date_diff('day', CAST(m.data_chegada AS DATE), CAST(m.data_inicio AS DATE)) AS dias,
         TRY_CAST(split_part(CAST(m.ano AS VARCHAR), '/', 1) AS DOUBLE) AS ano_d,
         floor(date_diff('day', m.data_nascimento, CAST(m.data_chegada AS DATE)) / 365.25) AS idade
  FROM m LEFT JOIN r1 ON r1.telefone = m.telefone LEFT JOIN r2 ON r2.telefone_sem9 = m.telefone_sem9
  WHERE m.data_chegada IS NOT NULL),
funnel AS (
  SELECT *, total_mensagens >= 50 AS mais_50, total_mensagens >= 100 AS mais_100, total_mensagens >= 200 AS mais_200,
         etiqueta_id IS NOT NULL AS converteu_etiqueta, CAST(dias AS INTEGER) AS dias_desde_chegada,
         {_BUCKET} AS bucket,
         CASE WHEN total_mensagens >= 50 THEN {_short('dias', '_50m')} END AS bucket_50,
         CASE WHEN total_mensagens >= 100 THEN {_short('dias', '_100m')} END AS bucket_100,
         CAST(ano_d AS INTEGER) AS ano_inicio,
         {_bins('ano_d', FN.ANO_EDGES, FN.ANO_LABELS)} AS cat_ano,
         {_bins('valor', FN.VALOR_EDGES, FN.VALOR_LABELS)} AS cat_valor,
         {_bins('idade', FN.IDADE_EDGES, FN.IDADE_LABELS)} AS cat_idade,
         {_bins('semelhanca', FN.SEMELHANCA_EDGES, FN.SEMELHANCA_LABELS)} AS cat_semelhanca
  FROM f0)"""

_FIX = ["negociacao_cockpit", "enriquecimento_lead", "contato_cliente", "crm_whatsapp", "crm_atendimentos",
        "crm_contato_etiquetas", "producao_fin_banco"]
_OUT = ["atendimento_id", "telefone", "data_chegada", "total_mensagens", "etiqueta_id", "receita_total", "mais_50",
        "mais_100", "converteu_etiqueta", "dias_desde_chegada", "bucket", "bucket_50", "ano_inicio", "cat_ano",
        "cat_valor", "cat_idade", "cat_semelhanca", "estado", "genero", "classificacao_ticket"]

FUNIL_SQL = with_fixtures(f"WITH {_FUNNEL} SELECT {', '.join(_OUT)} FROM funnel", _FIX)


def _funnel(spark, sf_dir):
    crm = FN.crm_frame(X.crm_conversations(spark, sf_dir), X.contacts(spark, sf_dir),
                       X.crm_messages(spark, sf_dir), X.crm_tags(spark, sf_dir))
    return FN.funnel_frame(crm, X.leads(spark, sf_dir), X.lead_enrichment(spark, sf_dir),
                           X.campaign_production(spark, sf_dir))


@query("funil", FUNIL_SQL, headline=True)
def funil(spark, sf_dir):
    return _funnel(spark, sf_dir).select(*_OUT)


_GLOBAL = """taxas_globais AS (
  SELECT greatest(CAST(SUM(CAST(mais_50 AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 1e-9) AS tx_50,
         greatest(CAST(SUM(CAST(mais_100 AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 1e-9) AS tx_100,
         greatest(CAST(SUM(CAST(mais_200 AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 1e-9) AS tx_200,
         greatest(CAST(SUM(CAST(converteu_etiqueta AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 1e-9) AS tx_etiq
  FROM funnel)"""

_MEASURES = """CAST(COUNT(*) AS BIGINT) AS volume,
         CAST(SUM(CAST(mais_50 AS INTEGER)) AS BIGINT) AS casos_50,
         CAST(SUM(CAST(mais_100 AS INTEGER)) AS BIGINT) AS casos_100,
         CAST(SUM(CAST(mais_200 AS INTEGER)) AS BIGINT) AS casos_200,
         CAST(SUM(CAST(converteu_etiqueta AS INTEGER)) AS BIGINT) AS casos_etiqueta,
         CAST(SUM(receita_total) AS DECIMAL(38,2)) AS receita_gerada"""


def _rates_sql(src: str, keys: str) -> str:
    cols = []
    for c, n in [("casos_50", "50"), ("casos_100", "100"), ("casos_200", "200"), ("casos_etiqueta", "etiq")]:
        cols.append(f"CAST(g.{c} AS DOUBLE) / CAST(g.volume AS DOUBLE) * 1000.0 AS por_mil_{n}")
        cols.append(f"(CAST(g.{c} AS DOUBLE) / CAST(g.volume AS DOUBLE)) / taxas_globais.tx_{n} AS lift_{n}")
    return (f"SELECT {keys}, g.volume, g.casos_50, g.casos_100, g.casos_200, g.casos_etiqueta, g.receita_gerada, "
            f"{', '.join(cols)}, CAST(g.receita_gerada AS DOUBLE) / CAST(g.volume AS DOUBLE) AS receita_por_lead "
            f"FROM {src} g CROSS JOIN taxas_globais")


_ATTRS = FN.ATTRIBUTES
_CAST = ", ".join(f"CAST({a} AS VARCHAR) AS {a}" for a in _ATTRS)
_NAME = "CASE " + " ".join(f"WHEN GROUPING({a}) = 0 THEN '{a}'" for a in _ATTRS) + " END"
_VAL = "CASE " + " ".join(f"WHEN GROUPING({a}) = 0 THEN {a}" for a in _ATTRS) + " END"
LIFT_SQL = with_fixtures(f"""WITH {_FUNNEL}, {_GLOBAL},
b AS (SELECT {_CAST}, mais_50, mais_100, mais_200, converteu_etiqueta, receita_total FROM funnel),
grp AS (SELECT {_NAME} AS atributo, {_VAL} AS valor, {_MEASURES}
        FROM b GROUP BY GROUPING SETS ({', '.join(f'({a})' for a in _ATTRS)})),
g2 AS (SELECT * FROM grp WHERE volume > 0)
{_rates_sql('g2', 'g.atributo, g.valor')}""", _FIX)


@query("lift_atributo", LIFT_SQL, headline=True)
def lift_atributo(spark, sf_dir):
    return FN.lift_by_attribute(_funnel(spark, sf_dir))


_IA = sorted({a for p in FN.INTERACTIONS for a in p})
_ICAST = ", ".join(f"CAST({a} AS VARCHAR) AS {a}" for a in _IA)


def _pair_cond(a, b):
    others = " AND ".join(f"GROUPING({x}) = 1" for x in _IA if x not in (a, b))
    return f"GROUPING({a}) = 0 AND GROUPING({b}) = 0" + (f" AND {others}" if others else "")


_N1 = "CASE " + " ".join(f"WHEN {_pair_cond(a, b)} THEN '{a}'" for a, b in FN.INTERACTIONS) + " END"
_N2 = "CASE " + " ".join(f"WHEN {_pair_cond(a, b)} THEN '{b}'" for a, b in FN.INTERACTIONS) + " END"
_V1 = "CASE " + " ".join(f"WHEN {_pair_cond(a, b)} THEN {a}" for a, b in FN.INTERACTIONS) + " END"
_V2 = "CASE " + " ".join(f"WHEN {_pair_cond(a, b)} THEN {b}" for a, b in FN.INTERACTIONS) + " END"
INTER_SQL = with_fixtures(f"""WITH {_FUNNEL}, {_GLOBAL},
b AS (SELECT {_ICAST}, mais_50, mais_100, mais_200, converteu_etiqueta, receita_total FROM funnel),
grp AS (SELECT {_N1} AS atributo_1, {_N2} AS atributo_2, {_V1} AS valor_1, {_V2} AS valor_2, {_MEASURES}
        FROM b GROUP BY GROUPING SETS ({', '.join(f'({a}, {b})' for a, b in FN.INTERACTIONS)})),
g2 AS (SELECT * FROM grp WHERE volume >= 10)
{_rates_sql('g2', 'g.atributo_1, g.atributo_2, g.valor_1, g.valor_2')}""", _FIX)


@query("lift_interacao", INTER_SQL)
def lift_interacao(spark, sf_dir):
    return FN.lift_by_interaction(_funnel(spark, sf_dir))


DIARIO_SQL = with_fixtures(f"""WITH {_FUNNEL},
agg AS (
  SELECT CAST(data_chegada AS DATE) AS dia, CAST(COUNT(*) AS BIGINT) AS total_atendimentos,
         CAST(SUM(CAST(mais_50 AS INTEGER)) AS BIGINT) AS atendimentos_50,
         CAST(SUM(CAST(mais_100 AS INTEGER)) AS BIGINT) AS atendimentos_100,
         CAST(SUM(CAST(converteu_etiqueta AS INTEGER)) AS BIGINT) AS atendimentos_etiqueta,
         CAST(SUM(receita_total) AS DECIMAL(38,2)) AS receita_total
  FROM funnel GROUP BY 1)
SELECT *, CAST(atendimentos_50 AS DOUBLE) / CAST(total_atendimentos AS DOUBLE) * 100.0 AS taxa_50,
       CAST(atendimentos_100 AS DOUBLE) / CAST(total_atendimentos AS DOUBLE) * 100.0 AS taxa_100,
       CAST(atendimentos_etiqueta AS DOUBLE) / CAST(total_atendimentos AS DOUBLE) * 100.0 AS taxa_etiqueta,
       CAST(receita_total AS DOUBLE) / CAST(total_atendimentos AS DOUBLE) AS receita_por_lead
FROM agg""", _FIX)


@query("cohort_diario", DIARIO_SQL)
def cohort_diario(spark, sf_dir):
    return FN.daily_cohort(_funnel(spark, sf_dir))


# one conditional value a label
_CELLS = ", ".join(f"max(CASE WHEN cat_ano = '{label}' THEN lift_100 END) AS \"{label}\"" for label in FN.ANO_LABELS)
PIVOT_SQL = with_fixtures(f"""WITH {_FUNNEL}, {_GLOBAL},
b AS (SELECT {_ICAST}, mais_50, mais_100, mais_200, converteu_etiqueta, receita_total FROM funnel),
pares AS (SELECT bucket, cat_ano, {_MEASURES} FROM b GROUP BY bucket, cat_ano),
cheios AS (SELECT * FROM pares WHERE volume > 0),
razoes AS ({_rates_sql('cheios', 'g.bucket, g.cat_ano')})
SELECT bucket, {_CELLS} FROM razoes GROUP BY bucket""", _FIX)


@query("pivot_lift", PIVOT_SQL)
def pivot_lift(spark, sf_dir):
    """Lift matrix of (bucket x cat_ano)."""
    inter = FN.lift_by_interaction(_funnel(spark, sf_dir), min_volume=1)
    return FN.lift_matrix(inter, "bucket", "cat_ano", FN.ANO_LABELS)
