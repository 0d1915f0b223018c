"""Lead distribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import assign as AS
from ledgerlens.operators.leads import FORBIDDEN_CHANNELS, RECOMMENDED_CHANNELS
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.q_leads import _CLASS_BASE, _classified
from ledgerlens.plans.registry import query
from ledgerlens.sources import fixtures as X

AS_OF = X.AS_OF_EVENTS
_FIX = ["negociacao_cockpit", "enriquecimento_lead"]
_FORB = ", ".join(f"'{c}'" for c in FORBIDDEN_CHANNELS)
_REC = ", ".join(f"'{c}'" for c in RECOMMENDED_CHANNELS)

# 2024-01-31 (Wed) minus two business days is Monday 2024-01-29.
_CANDS = f"""cands AS (
  SELECT id FROM r2 WHERE canal NOT IN ({_FORB}) AND canal IS NOT NULL
    AND CAST(data_chegada AS DATE) >= DATE '2024-01-29' AND CAST(data_chegada AS DATE) <= DATE '2024-01-31'
    AND prioridade = 3),
cons AS (SELECT s_suppkey AS usuario_id, s_name AS nome, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx
         FROM supplier),
ranked AS (SELECT id, CAST(row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR))) AS BIGINT) AS rn FROM cands)"""

RR_SQL = with_fixtures(f"""WITH {_CLASS_BASE}, {_CANDS}
SELECT r.id, r.rn, c.usuario_id, c.nome AS consultor
FROM ranked r CROSS JOIN (SELECT COUNT(*) AS n FROM cons) k JOIN cons c ON c.idx = (r.rn - 1) % k.n""", _FIX)


def _cands(spark, sf_dir):
    return AS.distribution_candidates(_classified(spark, sf_dir), AS_OF)


@query("round_robin", RR_SQL, headline=True)
def round_robin(spark, sf_dir):
    return AS.round_robin(_cands(spark, sf_dir), X.consultants(spark, sf_dir)).select("id", "rn", "usuario_id", "consultor")


BLOCOS_SQL = with_fixtures(f"""WITH {_CLASS_BASE}, {_CANDS}
SELECT r.id, r.rn, c.usuario_id, c.nome AS consultor
FROM ranked r JOIN cons c ON c.idx = CAST(floor((r.rn - 1) / {AS.PER_CONSULTANT}) AS BIGINT)""", _FIX)


@query("blocos", BLOCOS_SQL)
def blocos(spark, sf_dir):
    return AS.block_assignment(_cands(spark, sf_dir), X.consultants(spark, sf_dir)).select("id", "rn", "usuario_id", "consultor")


QUOTA_SQL = with_fixtures(f"""WITH {_CLASS_BASE},
occ AS (SELECT CAST(prioridade AS BIGINT) AS campanha_id, COUNT(*) AS ocupacao FROM r2
        WHERE enviado IS NOT NULL GROUP BY prioridade),
c AS (SELECT id, CAST(prioridade AS BIGINT) AS campanha_id,
             row_number() OVER (PARTITION BY prioridade ORDER BY md5('42' || CAST(id AS VARCHAR)), id) AS rn
      FROM r2 WHERE canal IN ({_REC}) AND prioridade IN (1, 2))
SELECT c.id, c.campanha_id, CAST(c.rn AS INTEGER) AS rn FROM c LEFT JOIN occ ON occ.campanha_id = c.campanha_id
WHERE c.rn <= {AS.CAMPAIGN_LIMIT} AND c.rn <= coalesce({AS.CAMPAIGN_LIMIT} - occ.ocupacao, {AS.CAMPAIGN_LIMIT})""", _FIX)


@query("quota_campanha", QUOTA_SQL)
def quota_campanha(spark, sf_dir):
    cl = _classified(spark, sf_dir)
    occ = AS.campaign_occupancy(cl.filter(F.col("enviado").isNotNull())
                                .withColumn("campanha_id", F.col("prioridade").cast("long")))
    return AS.quota_sample(cl, occ).select("id", "campanha_id", "rn")


def _dealt_sql(per: int) -> str:
    """C20 in plain ranks: everyone in turn, or best, draw, mix and blocks."""
    return with_fixtures(f"""WITH {_CLASS_BASE}, {_CANDS},
size AS (SELECT count(*) AS k, count(*) * {per} AS capacity, (SELECT count(*) FROM cands) AS n FROM cons),
pos AS (SELECT id, row_number() OVER (ORDER BY id) AS pos FROM cands),
draw AS (SELECT id, row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR))) AS d FROM pos, size WHERE pos > capacity),
mix AS (
  SELECT id FROM pos, size WHERE pos <= capacity
  UNION ALL SELECT id FROM draw, size WHERE d <= greatest(1, CAST(floor(capacity * 0.05) AS BIGINT))),
place AS (SELECT id, row_number() OVER (ORDER BY md5('42-' || CAST(id AS VARCHAR))) AS rn FROM mix),
dealt AS (
  SELECT id, pos AS rn, (pos - 1) % k AS idx FROM pos, size WHERE n <= capacity
  UNION ALL SELECT id, rn, (rn - 1) // {per} FROM place, size WHERE n > capacity AND rn <= capacity)
SELECT id, rn, usuario_id, nome AS consultor FROM dealt JOIN cons USING (idx)""", _FIX)


@query("distribuicao", _dealt_sql(AS.PER_CONSULTANT))
def distribuicao(spark, sf_dir):
    """C20 with room for all candidates."""
    return AS.distribute(_cands(spark, sf_dir), X.consultants(spark, sf_dir)).select("id", "rn", "usuario_id", "consultor")


@query("distribuicao_lotada", _dealt_sql(1))
def distribuicao_lotada(spark, sf_dir):
    """C20 + W8 beyond the capacity (one lead a consultant)."""
    return AS.distribute(_cands(spark, sf_dir), X.consultants(spark, sf_dir), per_consultant=1).select("id", "rn", "usuario_id", "consultor")


GERAL_SQL = with_fixtures(f"""WITH {_CLASS_BASE}, cons AS (SELECT count(*) AS k FROM supplier),
c AS (SELECT id, row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR))) AS rn FROM r2
      WHERE canal IN ({_REC}) AND abriu_regua = 'NAO TESTADO' AND prioridade = 1 AND semelhanca_nomes < 80)
SELECT id, rn FROM c, cons WHERE rn <= 100 * k""", _FIX)


@query("crm_geral", GERAL_SQL)
def crm_geral(spark, sf_dir):
    return AS.crm_general(_classified(spark, sf_dir), X.consultants(spark, sf_dir)).select("id", "rn")


REGUA_SQL = with_fixtures(f"""WITH {_CLASS_BASE}
SELECT id, row_number() OVER (ORDER BY md5('42' || CAST(id AS VARCHAR))) AS rn FROM r2
WHERE canal IN ({_REC}) AND abriu_regua = 'SIM' AND prioridade = 1""", _FIX)


@query("crm_regua_aberta", REGUA_SQL)
def crm_regua_aberta(spark, sf_dir):
    return AS.crm_open_ruler(_classified(spark, sf_dir)).select("id", "rn")


# the first two want the same leads; the third is nearly full, the last full
CASCADE = [AS.Campaign("CRM1", 1, 1, first_in_3_months=True, limit=5), AS.Campaign("CRM2", 2, 1, limit=30, most=2),
           AS.Campaign("CRM3", 3, 2, limit=8, lead_type="MQL"), AS.Campaign("CRM4", 4, 1, limit=5)]
_OCCUPIED = {1: 3, 3: 5, 4: 5}
CASCADE_SQL = with_fixtures(f"""WITH {_CLASS_BASE},
pool AS (SELECT id, prioridade, qtd_3_meses, c.tipo_lead AS tipo, md5('42' || CAST(id AS VARCHAR)) AS k
         FROM r2 JOIN (SELECT id, tipo_lead FROM classified) c USING (id) WHERE canal IN ({_REC})),
a AS (FROM pool SELECT 'CRM1' AS chave, id, k WHERE prioridade = 1 AND qtd_3_meses = 1 ORDER BY k LIMIT 2),
b AS (FROM pool SELECT 'CRM2' AS chave, id, k WHERE prioridade = 1 AND id NOT IN (SELECT id FROM a) ORDER BY k LIMIT 2),
c AS (FROM pool SELECT 'CRM3' AS chave, id, k WHERE prioridade = 2 AND tipo = 'MQL' ORDER BY k LIMIT 3)
SELECT chave, id, row_number() OVER (PARTITION BY chave ORDER BY k) AS rn FROM (FROM a UNION ALL FROM b UNION ALL FROM c)""", _FIX)


@query("cascata_campanhas", CASCADE_SQL)
def cascata_campanhas(spark, sf_dir):
    occupied = spark.createDataFrame(list(_OCCUPIED.items()), "campanha_id long, ocupacao long")
    return AS.campaign_cascade(_classified(spark, sf_dir), occupied, CASCADE).select("chave", "id", "rn")
