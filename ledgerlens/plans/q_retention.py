"""Cohort / retention / new-vs-recurring queries."""

from __future__ import annotations

from ledgerlens.operators import retention as R
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.sources import fixtures as X

# DuckDB: TIMESTAMPDIFF(MONTH) = calendar months minus one when the end's
# day-and-time is earlier than the start's (trap T1).
_MONTHS = """((year({b}) - year({a})) * 12 + month({b}) - month({a})
   - CASE WHEN day({b}) < day({a}) OR (day({b}) = day({a}) AND CAST({b} AS TIME) < CAST({a} AS TIME))
          THEN 1 ELSE 0 END)"""


def months_sql(a: str, b: str) -> str:
    return _MONTHS.format(a=a, b=b)


# every contract beside its client's earliest one
_AGED = f"""
SELECT strftime(d0, '%Y-%m') AS began, {months_sql('d0', 'd1')} AS age, who, paid
FROM (SELECT cliente_id AS who, data_contrato AS d1, valor_comissao AS paid,
             min(data_contrato) OVER (PARTITION BY cliente_id) AS d0
      FROM producao_all WHERE cliente_id IS NOT NULL)"""

SAFRA_SQL = with_fixtures(f"""
SELECT began AS safra, concat('M', age) AS mes, age::BIGINT AS idade_meses,
       count(DISTINCT who)::BIGINT AS clientes, sum(paid)::DECIMAL(38,2) AS receita
FROM ({_AGED}) GROUP BY began, age
""", ["producao_all"])


@query("safra_clientes", SAFRA_SQL, headline=True)
def safra_clientes(spark, sf_dir):
    return R.cohort_table(X.production(spark, sf_dir))


RETENCAO_SQL = with_fixtures(f"""
SELECT concat('M', age) AS mes, age::BIGINT AS idade_meses, count(DISTINCT (began, who))::BIGINT AS qtd_clientes
FROM ({_AGED}) GROUP BY age
""", ["producao_all"])


@query("cohort_retencao", RETENCAO_SQL)
def cohort_retencao(spark, sf_dir):
    return R.retention_curve(X.production(spark, sf_dir))


_BRANCHES = " UNION ALL ".join(
    f"SELECT DISTINCT cliente_id, data_contrato FROM producao_all "
    f"WHERE produto = '{pr}' AND data_cancelamento IS NULL"
    for pr in X.PRODUCT_TABLE_BY_PRIORITY
) + (" UNION ALL SELECT DISTINCT cliente_id, data_cartao AS data_contrato FROM producao_cartao "
     "WHERE data_cancelamento IS NULL")

# one row a client and month: its first and last contract of the month
NOVOS_SQL = with_fixtures(f"""
WITH mensal AS (
  SELECT cliente_id, date_trunc('month', data_contrato) AS mes, min(data_contrato) AS de, max(data_contrato) AS ate
  FROM ({_BRANCHES}) WHERE cliente_id IS NOT NULL GROUP BY ALL),
desde AS (SELECT mes, de, ate, min(de) OVER (PARTITION BY cliente_id) AS inicio FROM mensal),
contado AS (
  SELECT mes, count(*) FILTER (CAST(de AS DATE) = CAST(inicio AS DATE)) AS novos, count(*) FILTER (ate > inicio) AS recorrentes, count(*) AS clientes
  FROM desde GROUP BY mes)
SELECT strftime(mes, '%Y-%m') AS mes_ano, novos AS contagem_novos, recorrentes AS contagem_recorrentes,
       novos::DOUBLE / clientes AS proporcao_novos, recorrentes::DOUBLE / clientes AS proporcao_recorrentes
FROM contado""", ["producao_all", "producao_cartao"])


@query("clientes_novos_recorrentes", NOVOS_SQL, headline=True)
def clientes_novos_recorrentes(spark, sf_dir):
    tables = X.product_tables(spark, sf_dir)
    contracts = R.union_contracts(tables, date_alias={"producao_cartao": "data_cartao"})
    return R.new_vs_recurring(contracts)


PRIMEIRO_SQL = with_fixtures("""
SELECT cliente_id, MIN(data_contrato) AS primeira_data FROM producao_all GROUP BY cliente_id
""", ["producao_all"])


@query("primeiro_contrato", PRIMEIRO_SQL)
def primeiro_contrato(spark, sf_dir):
    return R.first_contract(X.production(spark, sf_dir))
