"""Partner work-queue queries."""

from __future__ import annotations

from ledgerlens.functions import scalars as S
from ledgerlens.operators import queues as QU
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.q_leads import _CLASS_BASE, _classified
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import AS_OF_EVENTS_SQL as T
from ledgerlens.sources import fixtures as X

AS_OF = X.AS_OF_EVENTS
_STATES = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in S.STATE_NAME.items()) + ") t(uf, nome)"
_USAGE = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in S.USAGE_LABEL.items()) + ") t(codigo, rotulo)"


def _zfill(x: str) -> str:
    d = f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) < 11 THEN lpad({d}, 11, '0') ELSE {d} END"


SIM_SQL = with_fixtures(f"""WITH {_CLASS_BASE},
estados AS ({_STATES}),
top AS (
  SELECT * FROM r2
  WHERE prioridade = 1 AND (consultando = 0 OR locked_at < {T} - INTERVAL 5 MINUTE)
    AND enviado IS NULL AND telefone IS NOT NULL AND cpf IS NOT NULL AND estado IS NOT NULL AND estado <> 'ND'
    AND semelhanca_nomes >= 100 AND data_nascimento IS NOT NULL AND abriu_regua = 'NAO TESTADO'
    AND canal NOT LIKE '%seguro%' AND lower(canal) NOT LIKE '%quitados%' AND ano IS NOT NULL
    AND veiculo IS NOT NULL AND marca IS NOT NULL AND valor IS NOT NULL AND valor > 0
    AND tipo_veiculo IN ('MOTO', 'CARRO')
  ORDER BY data_chegada DESC, md5('42' || CAST(id AS VARCHAR)) LIMIT 1)
SELECT id, {_zfill('cpf')} AS cpf, strftime(data_nascimento, '%d/%m/%Y') AS nascimento, marca,
       CAST(trim((string_split(ano, '/'))[-1]) AS INTEGER) AS ano,
       trim(regexp_replace(veiculo, '\\s*\\d\\.\\d.*', '')) AS modelo,
       CAST(trunc(coalesce(valor, 0)) AS BIGINT) AS valor, coalesce(e.nome, top.estado) AS estado,
       upper(substr(tipo_veiculo, 1, 1)) || lower(substr(tipo_veiculo, 2)) AS tipoVeiculo,
       CASE WHEN CAST(trim((string_split(ano, '/'))[-1]) AS INTEGER) >= 2023 THEN '0km/Novo' ELSE 'Usado' END AS usadoNovo
FROM top LEFT JOIN estados e ON e.uf = upper(top.estado)""", ["negociacao_cockpit", "enriquecimento_lead"])


@query("fila_simulacoes", SIM_SQL)
def fila_simulacoes(spark, sf_dir):
    return QU.simulation_queue(_classified(spark, sf_dir), AS_OF)


PLACAS_SQL = with_fixtures(f"""
SELECT {_zfill('cpf')} AS cpf, placa FROM consulta_seguro WHERE data_placa IS NULL ORDER BY contato_id LIMIT 1""",
    ["consulta_seguro"])


@query("fila_placas", PLACAS_SQL)
def fila_placas(spark, sf_dir):
    return QU.plate_queue(X.insurance_queries(spark, sf_dir))


COTACAO_SQL = with_fixtures(f"""WITH estados AS ({_STATES}), usos AS ({_USAGE})
SELECT contato_id AS id, {_zfill('cpf')} AS cpf, marca, ano_combustivel, modelo,
       CAST(trunc(coalesce(preco_medio_veiculo, 0)) AS BIGINT) AS valor,
       coalesce(e.nome, q.uf_licenciamento) AS estado,
       upper(substr(tipo_veiculo, 1, 1)) || lower(substr(tipo_veiculo, 2)) AS tipoVeiculo,
       estado_veiculo AS usadoNovo, u.rotulo AS uso_veiculo,
       strftime(data_nascimento, '%d/%m/%Y') AS data_nascimento
FROM consulta_seguro q LEFT JOIN estados e ON e.uf = upper(q.uf_licenciamento)
LEFT JOIN usos u ON u.codigo = q.uso_veiculo
WHERE data_consulta IS NULL AND CAST(data_placa AS DATE) >= CAST({T} AS DATE) - 1
  AND modelo IS NOT NULL AND placa NOT LIKE 'CPF%'""", ["consulta_seguro"])


@query("fila_cotacao", COTACAO_SQL)
def fila_cotacao(spark, sf_dir):
    return QU.quote_queue(X.insurance_queries(spark, sf_dir), AS_OF)
