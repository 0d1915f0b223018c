"""Campaign batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import campaign as CP
from ledgerlens.operators import leads as L
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.q_leads import _DAILY, _daily
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import AS_OF_EVENTS_SQL as T
from ledgerlens.sources import fixtures as X

AS_OF = X.AS_OF_EVENTS
_BLOCK = ", ".join(str(c) for c in CP.BLOCKING_CAMPAIGNS)


def _json_sql(x: str, typ: str) -> str:
    return f"CASE WHEN json_valid(ofertas_json) THEN TRY_CAST(json_extract(ofertas_json, '{x}') AS {typ}) END"


def _item(valor: str, mapeamento: str, quoted: bool = True) -> str:
    v = f"'\"' || {valor} || '\"'" if quoted else f"CAST({valor} AS VARCHAR)"
    return f"'{{\"valor\":' || {v} || ',\"mapeamento\":\"{mapeamento}\"}}'"


_FIRST = ("upper(substr(split_part(trim(nome_cockpit), ' ', 1), 1, 1)) || "
          "lower(substr(split_part(trim(nome_cockpit), ' ', 1), 2))")
_OFFERS = " || ".join(
    f"CASE WHEN o{i}q IS NOT NULL AND o{i}v IS NOT NULL THEN ',\"Oferta {i}\":' || "
    + _item(f"CAST(CAST(o{i}q AS BIGINT) AS VARCHAR) || 'x de ' || CAST(o{i}v AS VARCHAR)", f"Parcela_{i}")
    + " ELSE '' END" for i in range(1, 4))
_JSON = ("'{\"Nome Cockpit\":' || " + _item("coalesce(nome_cockpit, '')", "Nome Cockpit")
         + " || ',\"Primeiro Nome Cockpit\":' || " + _item(f"coalesce({_FIRST}, '')", "Primeiro Nome Cockpit")
         + " || ',\"Veículo\":' || " + _item("coalesce(veiculo, '')", "Veículo")
         + " || ',\"Ano\":' || " + _item("coalesce(ano, '')", "Ano")
         + " || ',\"Valor\":' || " + _item("CAST(valor AS VARCHAR)", "Valor")
         + " || ',\"Canal\":' || " + _item("canal", "Canal")
         + " || ',\"Semelhança\":' || " + _item("semelhanca_nomes", "Semelhança", quoted=False)
         + " || ',\"Entrada Recomendada\":' || " + _item("coalesce(CAST(entrada AS VARCHAR), 'R$ 0,00')", "Entrada")
         + " || ',\"Valor Mínimo\":' || " + _item("coalesce(CAST(minimo AS VARCHAR), 'R$ 0,00')", "Valor Mínimo")
         + " || ',\"Modelo Selecionado\":' || " + _item("ifnull(modelo, 'ERRO MODELO')", "Modelo Selecionado")
         + " || " + _OFFERS + " || '}'")

LOTE_SQL = with_fixtures(f"""WITH {_DAILY},
b AS (
  SELECT id, nome AS nome_cockpit, veiculo, ano, valor, canal, semelhanca_nomes, cpf, telefone,
         CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN marca || ' ' || veiculo ELSE nullif(trim(substr(ano, 1, id % 2)), '') END AS modelo,
         {_json_sql('$.entradaRecomendada', 'DOUBLE')} AS entrada, {_json_sql('$.valorMinimo', 'DOUBLE')} AS minimo,
         {_json_sql('$.parcelas[0].quantidade', 'INTEGER')} AS o1q, {_json_sql('$.parcelas[0].valor', 'DOUBLE')} AS o1v,
         {_json_sql('$.parcelas[1].quantidade', 'INTEGER')} AS o2q, {_json_sql('$.parcelas[1].valor', 'DOUBLE')} AS o2v,
         {_json_sql('$.parcelas[2].quantidade', 'INTEGER')} AS o3q, {_json_sql('$.parcelas[2].valor', 'DOUBLE')} AS o3v
  FROM daily),
r0 AS (SELECT *, nullif(regexp_replace(regexp_replace(trim(CAST(cpf AS VARCHAR)), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS cpf_limpo,
              nullif(regexp_replace(regexp_replace(trim(telefone), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS telefone_limpo
       FROM b),
bycpf AS (SELECT id AS cpf_limpo, max(idTabela) AS cliente_cpf FROM clientes GROUP BY id),
phones AS (SELECT fone, max(idTabela) AS cliente_fone FROM (
             SELECT idTabela, translate(telefone, '()- +', '') AS fone FROM clientes
             UNION ALL SELECT idTabela, translate(celular, '()- +', '') FROM clientes)
           WHERE fone IS NOT NULL AND fone <> '' GROUP BY fone),
r1 AS (SELECT r0.*, coalesce(bycpf.cliente_cpf, phones.cliente_fone) AS cliente_id
       FROM r0 LEFT JOIN bycpf ON bycpf.cpf_limpo = r0.cpf_limpo LEFT JOIN phones ON phones.fone = r0.telefone_limpo),
r2 AS (SELECT *, md5('42' || CAST(id AS VARCHAR)) AS k, {_JSON} AS dados_json FROM r1
       WHERE cliente_id IS NOT NULL
         AND cliente_id NOT IN (SELECT cliente_id FROM campanha_cliente WHERE campanha_id IN ({_BLOCK}))),
lst AS (SELECT cliente_id, dados_json FROM (
          SELECT cliente_id, dados_json, row_number() OVER (PARTITION BY cliente_id ORDER BY k DESC) AS rn FROM r2)
        WHERE rn = 1),
fst AS (SELECT cliente_id, min(k) AS k FROM r2 GROUP BY cliente_id),
ranked AS (SELECT cliente_id, CAST(row_number() OVER (ORDER BY k) AS BIGINT) AS ordem FROM fst),
cons AS (SELECT s_suppkey AS usuario_id, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx
         FROM supplier),
n AS (SELECT count(*) AS n FROM cons)
SELECT ranked.cliente_id, ranked.ordem, cons.usuario_id, lst.dados_json
FROM ranked CROSS JOIN n LEFT JOIN cons ON n.n > 0 AND cons.idx = (ranked.ordem - 1) % n.n
JOIN lst ON lst.cliente_id = ranked.cliente_id""",
    ["negociacao_cockpit", "enriquecimento_lead", "contato_cliente", "clientes", "campanha_cliente"])


@query("lote_campanha", LOTE_SQL, headline=True)
def lote_campanha(spark, sf_dir):
    # some leads have a model text, some an empty one, some none
    third = F.pmod("id", F.lit(3))
    model = F.when(third == 1, F.concat("marca", F.lit(" "), "veiculo")).when(third == 2, F.substr("ano", F.lit(1), F.pmod("id", F.lit(2)).cast("int")))
    daily = L.parse_offers(_daily(spark, sf_dir)).withColumnRenamed("nome", "nome_cockpit").withColumn("modelo_selecionado", model)
    return CP.campaign_batch(daily, X.clients(spark, sf_dir), X.campaign_members(spark, sf_dir),
                             X.consultants(spark, sf_dir)).select("cliente_id", "ordem", "usuario_id", "dados_json")


PARADOS_SQL = with_fixtures(f"""
WITH m AS (SELECT cliente_id FROM campanha_cliente WHERE campanha_id = 777),
cp AS (SELECT idTabela AS cliente_id,
              nullif(regexp_replace(regexp_replace(trim(coalesce(celular, telefone)), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS fone
       FROM clientes),
lp AS (SELECT id, nullif(regexp_replace(regexp_replace(trim(translate(telefone, '()- +', '')), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS fone,
              CAST(data_chegada AS DATE) AS chegada FROM negociacao_cockpit),
j AS (SELECT m.cliente_id, lp.id, lp.chegada FROM m JOIN cp ON cp.cliente_id = m.cliente_id JOIN lp ON lp.fone = cp.fone
      WHERE lp.chegada IS NOT NULL)
SELECT cliente_id, id FROM j
WHERE (5 * CAST(floor(date_diff('day', DATE '1970-01-05', CAST({T} AS DATE)) / 7) AS BIGINT)
       + least(((date_diff('day', DATE '1970-01-05', CAST({T} AS DATE)) % 7) + 7) % 7, 5))
    - (5 * CAST(floor(date_diff('day', DATE '1970-01-05', chegada) / 7) AS BIGINT)
       + least(((date_diff('day', DATE '1970-01-05', chegada) % 7) + 7) % 7, 5)) > 1
  AND cliente_id NOT IN (SELECT DISTINCT relacao_id FROM telemarketing WHERE campanha_id IN ({_BLOCK}))""",
    ["negociacao_cockpit", "clientes", "campanha_cliente", "telemarketing"])


@query("liberar_parados", PARADOS_SQL)
def liberar_parados(spark, sf_dir):
    return CP.stale_assignments(X.campaign_members(spark, sf_dir), X.clients(spark, sf_dir), X.leads(spark, sf_dir),
                                X.contact_log(spark, sf_dir), 777, AS_OF)


RESOLVER_SQL = with_fixtures(f"""WITH {_DAILY},
r0 AS (SELECT id, nullif(regexp_replace(regexp_replace(trim(CAST(cpf AS VARCHAR)), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS cpf_limpo,
              nullif(regexp_replace(regexp_replace(trim(telefone), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS telefone_limpo
       FROM daily),
bycpf AS (SELECT id AS cpf_limpo, max(idTabela) AS cliente_cpf FROM clientes GROUP BY id),
phones AS (SELECT fone, max(idTabela) AS cliente_fone FROM (
             SELECT idTabela, translate(telefone, '()- +', '') AS fone FROM clientes
             UNION ALL SELECT idTabela, translate(celular, '()- +', '') FROM clientes)
           WHERE fone IS NOT NULL AND fone <> '' GROUP BY fone)
SELECT r0.id, r0.cpf_limpo, r0.telefone_limpo, coalesce(bycpf.cliente_cpf, phones.cliente_fone) AS cliente_id
FROM r0 LEFT JOIN bycpf ON bycpf.cpf_limpo = r0.cpf_limpo LEFT JOIN phones ON phones.fone = r0.telefone_limpo""",
    ["negociacao_cockpit", "enriquecimento_lead", "contato_cliente", "clientes"])


@query("resolver_cliente", RESOLVER_SQL)
def resolver_cliente(spark, sf_dir):
    r = CP.resolve_clients(_daily(spark, sf_dir), X.clients(spark, sf_dir))
    return r.select("id", "cpf_limpo", "telefone_limpo", "cliente_id")
