"""Lead enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import enrichment as EN
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import token_set_ctes
from ledgerlens.sources import fixtures as X


def _unenriched(spark, sf_dir):
    """All unsent, unenriched leads with a phone (the polling loop's union)."""
    leads = X.leads(spark, sf_dir)
    enr = X.lead_enrichment(spark, sf_dir).select(F.col("negociacao_id").alias("id"))
    return leads.join(enr, "id", "left_anti").filter(F.col("enviado").isNull() & F.col("telefone").isNotNull())


_DIG = "nullif(regexp_replace(regexp_replace(trim(CAST({x} AS VARCHAR)), '\\.0$', ''), '[^0-9]', '', 'g'), '')"
_CANDS = f"""cands AS (
  SELECT nc.* FROM negociacao_cockpit nc
  WHERE nc.id NOT IN (SELECT negociacao_id FROM enriquecimento_lead) AND nc.enviado IS NULL AND nc.telefone IS NOT NULL),
p AS (SELECT DISTINCT {_DIG.format(x='telefone')} AS telefone FROM cands WHERE {_DIG.format(x='telefone')} IS NOT NULL),
u AS (
  SELECT idTabela AS cliente_id, telefone FROM clientes WHERE telefone IN (SELECT telefone FROM p)
  UNION SELECT idTabela, celular FROM clientes WHERE celular IN (SELECT telefone FROM p)
  UNION SELECT cc.cliente_id, {_DIG.format(x='co.contato')} FROM cliente_contato cc JOIN contato_cliente co ON co.id = cc.contato_id
        WHERE {_DIG.format(x='co.contato')} IN (SELECT telefone FROM p)),
uf AS (SELECT cliente_id, uf FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY id DESC) AS rn FROM logradouro) WHERE rn = 1),
info AS (
  SELECT u.cliente_id, c.id AS cpf, coalesce(uf.uf, 'ND') AS UF, c.genero AS SEXO, c.data_nasc AS DATANASCIMENTO,
         c.nome AS nome_cliente_cadastro, u.telefone
  FROM u JOIN clientes c ON c.idTabela = u.cliente_id LEFT JOIN uf ON uf.cliente_id = u.cliente_id)"""
_FIX = ["negociacao_cockpit", "enriquecimento_lead", "clientes", "cliente_contato", "contato_cliente", "logradouro"]

INFO_SQL = with_fixtures(f"WITH {_CANDS} SELECT * FROM info", _FIX)


def _info(spark, sf_dir):
    return EN.client_info(_unenriched(spark, sf_dir).select("telefone"), X.clients(spark, sf_dir),
                          X.client_contacts(spark, sf_dir), X.contacts(spark, sf_dir), X.addresses(spark, sf_dir))


@query("info_cliente", INFO_SQL)
def info_cliente(spark, sf_dir):
    return _info(spark, sf_dir)


ENRIQUECIMENTO_SQL = with_fixtures(f"""WITH {_CANDS},
cadastro AS (
  FROM info SELECT * QUALIFY row_number() OVER (PARTITION BY telefone ORDER BY cpf DESC NULLS LAST, cliente_id DESC) = 1),
pendente AS (
  SELECT c.id, c.fone, upper(c.nome) AS a, upper(k.nome_cliente_cadastro) AS b, k.* EXCLUDE (telefone),
         coalesce(trim(CAST(k.cpf AS VARCHAR)), '') IN ('', 'nan') AS sem_cpf
  FROM (SELECT *, {_DIG.format(x='telefone')} AS fone FROM cands) c LEFT JOIN cadastro k ON k.telefone = c.fone
  WHERE length(c.fone) IN (10, 11)),
{token_set_ctes('pendente')}
SELECT id AS negociacao_id, fone AS telefone, cpf, CASE WHEN NOT sem_cpf THEN nome_cliente_cadastro END AS nome_cliente_cadastro, SEXO, UF,
       CASE WHEN sem_cpf THEN 0 ELSE semelhanca END AS semelhanca, DATANASCIMENTO,
       CASE WHEN cliente_id IS NULL THEN CASE WHEN length(fone) = 11 AND substr(fone, 3, 1) = '9' THEN 'CELULAR' WHEN length(fone) = 10 THEN 'FIXO' ELSE 'INVALIDO' END END AS tipo_contato
FROM pendente p JOIN pontuado q ON q.a IS NOT DISTINCT FROM p.a AND q.b IS NOT DISTINCT FROM p.b""", _FIX)


@query("enriquecimento", ENRIQUECIMENTO_SQL)
def enriquecimento(spark, sf_dir):
    """C24 over all pending leads."""
    return EN.enrichment_pass(_unenriched(spark, sf_dir), _info(spark, sf_dir))


BUDGET_SQL = with_fixtures(f"""WITH {_CANDS},
ph AS (SELECT {_DIG.format(x='telefone')} AS telefone, max(data_chegada) AS ultima_chegada FROM cands
       WHERE {_DIG.format(x='telefone')} IS NOT NULL GROUP BY 1)
SELECT telefone, ultima_chegada FROM ph ORDER BY ultima_chegada DESC, telefone LIMIT {EN.LOOKUP_BUDGET}""", _FIX)


@query("orcamento_consultas", BUDGET_SQL)
def orcamento_consultas(spark, sf_dir):
    return EN.lookup_budget(_unenriched(spark, sf_dir))
