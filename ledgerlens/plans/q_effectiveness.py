"""Effectiveness, prior-contract and conversion-model queries."""

from __future__ import annotations

from ledgerlens.operators import effectiveness as EF
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.q_reconcile import cpf_mask_sql
from ledgerlens.plans.registry import query
from ledgerlens.sources import fixtures as X

START, END = "1998-01-01", "1999-01-01"
_FIX = ["lista_clientes", "tabulacoes", "producao_extenso"]

_PER_CLIENT = f"""
cl AS (SELECT {cpf_mask_sql('cliente_id')} AS cliente_id FROM lista_clientes),
t AS (SELECT {cpf_mask_sql('cpf')} AS cliente_id, efetiva FROM tabulacoes),
tt AS (SELECT cliente_id, CAST(COUNT(*) AS BIGINT) AS tabulacoes FROM t WHERE cliente_id IS NOT NULL GROUP BY cliente_id),
te AS (SELECT cliente_id, CAST(COUNT(*) AS BIGINT) AS tabulacoes_efetivas FROM t WHERE efetiva AND cliente_id IS NOT NULL
       GROUP BY cliente_id),
p AS (SELECT {cpf_mask_sql('cliente_id')} AS cliente_id, produto, Total_Liberado, valor_comissao, base_comissao
      FROM producao_extenso WHERE data_contrato >= TIMESTAMP '{START}'
        AND CAST(data_contrato AS DATE) <= CAST(DATE '{END}' - INTERVAL 1 DAY AS DATE)),
ps AS (SELECT cliente_id, SUM(Total_Liberado) AS Total_Liberado, SUM(valor_comissao) AS valor_comissao,
              SUM(base_comissao) AS base_comissao FROM p GROUP BY cliente_id),
pc AS (SELECT cliente_id, CAST(COUNT(*) AS BIGINT) AS Contratos FROM p
       WHERE NOT coalesce(produto = 'SEGURO PRESTAMISTA', false) AND cliente_id IS NOT NULL GROUP BY cliente_id),
per_client AS (
  SELECT cl.cliente_id, coalesce(tt.tabulacoes, 0) AS tabulacoes, coalesce(ps.Total_Liberado, 0) AS Total_Liberado,
         coalesce(ps.valor_comissao, 0) AS valor_comissao, coalesce(ps.base_comissao, 0) AS base_comissao,
         coalesce(te.tabulacoes_efetivas, 0) AS tabulacoes_efetivas, coalesce(pc.Contratos, 0) AS Contratos
  FROM cl LEFT JOIN tt ON tt.cliente_id = cl.cliente_id LEFT JOIN ps ON ps.cliente_id = cl.cliente_id
  LEFT JOIN te ON te.cliente_id = cl.cliente_id LEFT JOIN pc ON pc.cliente_id = cl.cliente_id)"""

CLIENT_SQL = with_fixtures(f"WITH {_PER_CLIENT} SELECT * FROM per_client", _FIX)


def _per_client(spark, sf_dir):
    return EF.client_effectiveness(X.client_list(spark, sf_dir), X.tabulations(spark, sf_dir),
                                   X.production_lines(spark, sf_dir), START, END)


@query("efetividade_clientes", CLIENT_SQL)
def efetividade_clientes(spark, sf_dir):
    return _per_client(spark, sf_dir).select("cliente_id", *EF.SUMMED)


_SUMS = ", ".join(f"CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DECIMAL(38,2)) AS {c}" for c in EF.SUMMED)
_UNION = " UNION ALL ".join(f"SELECT '{c}' AS Campo, {c} AS Soma, n, tab, tab_eff, valor_comissao AS vc, "
                            f"base_comissao AS bc FROM a" for c in EF.SUMMED)
EFET_SQL = with_fixtures(f"""WITH {_PER_CLIENT},
a AS (SELECT {_SUMS}, CAST(COUNT(*) AS BIGINT) AS n,
             CAST(SUM(CASE WHEN tabulacoes > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tab,
             CAST(SUM(CASE WHEN tabulacoes_efetivas > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tab_eff FROM per_client),
l AS ({_UNION})
SELECT Campo, Soma,
  CASE WHEN Campo = 'tabulacoes' THEN CASE WHEN n > 0 THEN CAST(tab AS DOUBLE) / CAST(n AS DOUBLE) * 100.0 ELSE 0.0 END END
    AS Proporcao,
  CASE WHEN Campo = 'tabulacoes' THEN tab WHEN Campo = 'tabulacoes_efetivas' THEN tab_eff END AS Clientes_Tabulados,
  CASE WHEN Campo = 'valor_comissao' THEN CASE WHEN bc <> 0 THEN CAST(vc AS DOUBLE) / CAST(bc AS DOUBLE) * 100.0
       ELSE 0.0 END END AS Rentabilidade
FROM l""", _FIX)


@query("efetividade", EFET_SQL, headline=True)
def efetividade(spark, sf_dir):
    return EF.effectiveness_summary(_per_client(spark, sf_dir))


ANTERIORES_SQL = with_fixtures(f"""
WITH p AS (SELECT {cpf_mask_sql('cliente_id')} AS cpf, CAST(data_contrato AS DATE) AS d FROM producao_extenso),
f AS (SELECT cpf, d BETWEEN DATE '{START}' - 366 AND DATE '{START}' - 1 AS ly,
             d BETWEEN DATE '1990-01-01' AND DATE '{START}' - 367 AS bf FROM p)
SELECT cpf, CAST(SUM(CASE WHEN ly THEN 1 ELSE 0 END) AS BIGINT) AS qtd_contratos_ultimo_ano,
       CAST(SUM(CASE WHEN bf THEN 1 ELSE 0 END) AS BIGINT) AS qtd_contratos_anteriores
FROM f WHERE ly OR bf GROUP BY cpf""", ["producao_extenso"])


@query("contratos_anteriores", ANTERIORES_SQL)
def contratos_anteriores(spark, sf_dir):
    return EF.prior_contracts(X.production_lines(spark, sf_dir), START)


@query("chance_conversao")
def chance_conversao(spark, sf_dir):
    """M1-M5: random-forest conversion chance per tabulated client (rows only)."""
    from ledgerlens.operators import model as M
    return M.conversion_scores(spark, sf_dir, START, END)


TREINO_SQL = with_fixtures(f"""
WITH t AS (SELECT {cpf_mask_sql('cpf')} AS cpf, count(*) AS tabulacoes_efetivas FROM tabulacoes
           WHERE efetiva AND data >= TIMESTAMP '{START}' AND data < TIMESTAMP '{END}' GROUP BY ALL HAVING cpf IS NOT NULL),
p AS (SELECT {cpf_mask_sql('cliente_id')} AS cpf, CAST(data_contrato AS DATE) AS dia FROM producao_extenso),
h AS (
  SELECT cpf, bool_or(dia >= DATE '{START}' AND dia < DATE '{END}') AS comprou, count(*) FILTER (dia >= DATE '{START}' - 366 AND dia < DATE '{START}') AS ultimo,
         count(*) FILTER (dia >= DATE '1990-01-01' AND dia < DATE '{START}' - 366) AS antes FROM p GROUP BY cpf)
SELECT cpf, CAST(ifnull(comprou, false) AS INTEGER) AS convertidos, tabulacoes_efetivas, ifnull(antes, 0) AS qtd_contratos_anteriores, ifnull(ultimo, 0) AS qtd_contratos_ultimo_ano
FROM t LEFT JOIN h USING (cpf)""", _FIX[1:])


@query("conjunto_treino", TREINO_SQL)
def conjunto_treino(spark, sf_dir):
    """M3: one row a client with an effective tabulation."""
    from ledgerlens.operators import model as M
    return M.training_set(X.tabulations(spark, sf_dir), X.production_lines(spark, sf_dir), START, END).select("cpf", M.LABEL, *M.FEATURES)


LISTA_SQL = with_fixtures(f"""
WITH l AS (SELECT DISTINCT {cpf_mask_sql('cliente_id')} AS cpf FROM lista_clientes),
t AS (SELECT {cpf_mask_sql('cpf')} AS cpf, count(*) AS n FROM tabulacoes WHERE efetiva AND data < TIMESTAMP '{END}' GROUP BY ALL),
p AS (SELECT {cpf_mask_sql('cliente_id')} AS cpf, count(*) FILTER (d >= DATE '{END}' - 366) AS ultimo, count(*) FILTER (d < DATE '{END}' - 366) AS antes
      FROM (SELECT cliente_id, CAST(data_contrato AS DATE) AS d FROM producao_extenso) WHERE d >= DATE '1990-01-01' AND d < DATE '{END}' GROUP BY ALL)
SELECT l.cpf, ifnull(t.n, 0) AS tabulacoes_efetivas, ifnull(p.antes, 0) AS qtd_contratos_anteriores, ifnull(p.ultimo, 0) AS qtd_contratos_ultimo_ano
FROM l LEFT JOIN t USING (cpf) LEFT JOIN p USING (cpf) WHERE l.cpf IS NOT NULL""", _FIX)


@query("atributos_lista", LISTA_SQL)
def atributos_lista(spark, sf_dir):
    """M4: the features of a client list alone."""
    from ledgerlens.operators import model as M
    clients = X.client_list(spark, sf_dir).withColumnRenamed("cliente_id", "cpf")
    return M.list_features(clients, X.tabulations(spark, sf_dir), X.production_lines(spark, sf_dir), END).select("cpf", *M.FEATURES)
