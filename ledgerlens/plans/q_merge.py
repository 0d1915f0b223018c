"""Keyed write-back queries (K5-K9, C8 write-back, C16 end-to-end update)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.dates import ts_ntz
from ledgerlens.operators import merge as MG
from ledgerlens.operators import reconcile as RC
from ledgerlens.plans import q_leads as QL
from ledgerlens.plans import q_reconcile as QR
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.sources import fixtures as X
from ledgerlens.sources.tables import read_table

AS_OF = X.AS_OF_EVENTS
GUARD_DATE = "2000-01-01"

PRIO_SQL = with_fixtures(f"""WITH {QL._CLASS_BASE},
t AS (SELECT id, CASE WHEN id % 5 = 0 THEN 10 END AS primeira_prioridade FROM negociacao_cockpit)
SELECT t.id,
       CASE WHEN c.id IS NOT NULL THEN c.prioridade END AS prioridade,
       CASE WHEN c.id IS NOT NULL THEN c.tipo_lead END AS tipo_lead,
       CASE WHEN c.id IS NOT NULL THEN coalesce(t.primeira_prioridade, c.prioridade) ELSE t.primeira_prioridade END
         AS primeira_prioridade,
       CASE WHEN c.id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' END AS data_classificacao
FROM t LEFT JOIN classified c ON c.id = t.id""", ["negociacao_cockpit", "enriquecimento_lead"])


@query("merge_prioridade", PRIO_SQL)
def merge_prioridade(spark, sf_dir):
    """C8 write-back: priority and type overwritten, first priority kept once
    set (K7), classification time stamped (K5)."""
    leads = X.leads(spark, sf_dir).select(
        "id", F.when(F.pmod(F.col("id"), F.lit(5)) == 0, F.lit(10)).alias("primeira_prioridade"))
    cl = QL._classified(spark, sf_dir).select("id", "prioridade", "tipo_lead",
                                              F.col("prioridade").alias("primeira_prioridade"))
    out = MG.merge(leads, cl, ["id"], {
        "prioridade": MG.OVERWRITE, "tipo_lead": MG.OVERWRITE,
        "primeira_prioridade": MG.FIRST_WRITE_WINS, "data_classificacao": ts_ntz(AS_OF)})
    return out.select("id", "prioridade", "tipo_lead", "primeira_prioridade", "data_classificacao")


PROD_SQL = with_fixtures(QR._BASE.rstrip() + f""",{QR._RATE_SQL},
rec AS (
  SELECT st.src_id, st.val_repasse, nullif(cb.val_bruto, 0) AS bruto, st.dsc_produto,
    CASE WHEN upper(coalesce(st.nom_banco, '')) LIKE '%SANTANDER%' AND st.val_repasse IS NOT NULL
              AND st.val_comissao IS NOT NULL AND b.perc_empresa_avista IS NOT NULL
         THEN round(CAST(st.val_liberado AS DOUBLE) * (b.perc_empresa_avista / 100.0), 2)
         ELSE CAST(st.val_comissao AS DOUBLE) END AS val_comissao_total,
    CASE WHEN st.val_repasse <> 0 THEN st.val_repasse END AS lib, st.prazo
  FROM st LEFT JOIN best b ON b.src_id = st.src_id JOIN contratos_bancos cb ON cb.src_id = st.src_id),
upd AS (SELECT pairs.id, rec.* FROM pairs JOIN rec ON rec.src_id = pairs.src_id)
SELECT p.id,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' THEN u.val_repasse END AS base_comissao,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' THEN u.val_comissao_total
       ELSE CAST(p.valor_comissao AS DOUBLE) END AS valor_comissao,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' THEN coalesce(u.lib, p.valor_liberado)
       ELSE p.valor_liberado END AS valor_liberado,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' THEN u.prazo END AS prazo,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' AND u.bruto IS NOT NULL THEN u.bruto
       WHEN p.id % 3 = 0 THEN p.valor_liberado END AS valor_financiado,
  CASE WHEN u.id IS NOT NULL AND p.data_contrato >= TIMESTAMP '{GUARD_DATE}' THEN u.dsc_produto END AS tabela
FROM prod p LEFT JOIN upd u ON u.id = p.id""", QR._FIX + ["tabela_taxas"])


@query("merge_producao", PROD_SQL)
def merge_producao(spark, sf_dir):
    """C16 write-back (K8): matched production rows get the statement's
    base, recalculated commission, amount unless zero (keep old when NULL)
    and term — only for contracts on/after the guard date."""
    st, prod, pairs = QR._pairs(spark, sf_dir, "nom_banco", "dsc_produto", "data_emprestimo", "val_repasse", "val_comissao",
                                "val_liberado", "val_bruto", "prazo")
    st = RC.paired_statements(st, pairs)
    best = RC.effective_rate(st, X.rate_table(spark, sf_dir))
    target = prod.select("id", "data_contrato", F.col("valor_comissao").cast("double").alias("valor_comissao"), "valor_liberado",
                         F.when(F.pmod("id", F.lit(3)) == 0, F.col("valor_liberado")).alias("valor_financiado"))
    out = RC.production_write_back(target, pairs, RC.expected_commission(st, best), GUARD_DATE)
    return out.select("id", "base_comissao", "valor_comissao", "valor_liberado", "valor_financiado", "prazo", "tabela")


REMK_SQL = with_fixtures(f"""
WITH t AS (SELECT id, CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 3 AS INTEGER) END AS contagem_remarketing,
                  enviado, data_chegada FROM negociacao_cockpit),
s AS (SELECT id FROM negociacao_cockpit WHERE enviado IS NOT NULL
        AND data_chegada >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 15 DAY)
SELECT t.id,
       CASE WHEN s.id IS NOT NULL THEN t.contagem_remarketing + 1 ELSE t.contagem_remarketing END AS contagem_remarketing,
       CASE WHEN s.id IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' END AS remarketing
FROM t LEFT JOIN s ON s.id = t.id""", ["negociacao_cockpit"])


@query("merge_remarketing", REMK_SQL)
def merge_remarketing(spark, sf_dir):
    """K6 + K5: remarketing counter incremented (NULL stays NULL) and time
    stamped for leads remarketed in the last 15 days."""
    leads = X.leads(spark, sf_dir)
    t = leads.select("id", F.when(F.pmod(F.col("id"), F.lit(4)) == 0, F.lit(None).cast("int"))
                     .otherwise(F.pmod(F.col("id"), F.lit(3)).cast("int")).alias("contagem_remarketing"))
    sent = leads.filter(F.col("enviado").isNotNull()
                        & (F.col("data_chegada") >= ts_ntz(AS_OF) - F.expr("INTERVAL 15 DAYS"))).select("id")
    out = MG.merge(t, sent, ["id"], {"contagem_remarketing": MG.INCREMENT, "remarketing": ts_ntz(AS_OF)})
    return out.select("id", "contagem_remarketing", "remarketing")


# ------------------------------------------------------------------ keyed writes on whole tables

UPSERT_SQL = """
WITH novo AS (
  SELECT o_custkey + if(o_orderpriority = '1-URGENT', 1000000000, 0) AS cliente_id, arg_max(CAST(o_totalprice AS DECIMAL(18,2)), (o_orderdate, o_orderkey)) AS saldo,
         arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS situacao
  FROM orders GROUP BY 1)
SELECT ifnull(c.c_custkey, novo.cliente_id) AS cliente_id, ifnull(novo.saldo, CAST(c.c_acctbal AS DECIMAL(18,2))) AS saldo,
       ifnull(c.c_mktsegment, novo.situacao) AS situacao
FROM customer c FULL JOIN novo ON novo.cliente_id = c.c_custkey"""


@query("upsert_saldos", UPSERT_SQL)
def upsert_saldos(spark, sf_dir):
    """K3 + K9 + K10: every order as an update of its client, the newest one a
    key; balances are overwritten, the first status stays, clients without a
    row (here the numbers given to urgent orders) are inserted."""
    c = read_table(spark, sf_dir, "customer")
    target = c.select(F.col("c_custkey").alias("cliente_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("saldo"),
                      F.col("c_mktsegment").alias("situacao"))
    o = read_table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + F.when(F.col("o_orderpriority") == "1-URGENT", 1000000000).otherwise(0)).alias("cliente_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("saldo"), F.col("o_orderpriority").alias("situacao"), "o_orderdate", "o_orderkey")
    updates = MG.unique_updates(o, ["cliente_id"], ["o_orderdate", "o_orderkey"]).select("cliente_id", "saldo", "situacao")
    return MG.merge(target, updates, ["cliente_id"], {"saldo": MG.OVERWRITE, "situacao": MG.FIRST_WRITE_WINS}, insert_missing=True)


REPLACE_SQL = """
SELECT c_custkey AS cliente_id, c_mktsegment AS tipo, CAST(c_acctbal AS DECIMAL(18,2)) AS valor FROM customer
WHERE (c_custkey, c_mktsegment) NOT IN (SELECT (o_custkey, 'BUILDING') FROM orders)
UNION ALL SELECT o_custkey, 'BUILDING', CAST(o_totalprice AS DECIMAL(18,2)) FROM orders"""


@query("substituir_por_chave", REPLACE_SQL)
def substituir_por_chave(spark, sf_dir):
    """Delete by (key, type), then insert."""
    c, o = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    target = c.select(F.col("c_custkey").alias("cliente_id"), F.col("c_mktsegment").alias("tipo"), F.col("c_acctbal").cast("decimal(18,2)").alias("valor"))
    rows = o.select(F.col("o_custkey").alias("cliente_id"), F.lit("BUILDING").alias("tipo"), F.col("o_totalprice").cast("decimal(18,2)").alias("valor"))
    return MG.replace_by_key(target, rows, ["cliente_id", "tipo"])


LOOKUP_SQL = """
WITH v AS (SELECT p_partkey AS versao, p_size AS faixa, DATE '1994-01-01' + CAST(p_partkey % 1500 AS INTEGER) AS inicio,
                  CASE WHEN p_partkey % 3 > 0 THEN DATE '1994-01-01' + CAST(p_partkey % 1500 + 400 AS INTEGER) END AS fim FROM part),
j AS (SELECT o_orderkey AS id, max((inicio, versao)) AS m FROM orders JOIN v ON v.faixa = o_custkey % 50 + 1
      WHERE CAST(o_orderdate AS DATE) BETWEEN inicio AND ifnull(fim, DATE '2099-12-31') GROUP BY 1)
SELECT o.o_orderkey AS id, j.m[2] AS versao FROM orders o LEFT JOIN j ON j.id = o.o_orderkey"""


@query("versao_vigente", LOOKUP_SQL)
def versao_vigente(spark, sf_dir):
    """The newest version in force on each order's date, if any."""
    p, o = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "orders")
    start = F.date_add(F.lit("1994-01-01").cast("date"), F.pmod("p_partkey", F.lit(1500)).cast("int"))
    versions = p.select(F.col("p_partkey").alias("versao"), F.col("p_size").cast("long").alias("faixa"), start.alias("inicio"),
                        F.when(F.pmod("p_partkey", F.lit(3)) > 0, F.date_add(start, 400)).alias("fim"))
    rows = o.select(F.col("o_orderkey").alias("id"), (F.pmod("o_custkey", F.lit(50)) + 1).alias("faixa"), F.to_date("o_orderdate").alias("dia"))
    out = RC.effective_dated_lookup(rows, versions, ["faixa"], "dia", "inicio", "fim", ["versao"], "id", order_cols=["inicio", "versao"])
    return out.select("id", "versao")
