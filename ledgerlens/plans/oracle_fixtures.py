"""DuckDB restatement of ``ledgerlens.sources.fixtures`` as SQL CTE bodies.

Written independently of the Spark derivations so the oracle checks them
too.  ``with_fixtures(sql, names)`` prefixes a query with the CTEs it uses.
"""

from __future__ import annotations

PRODUCTION = """
SELECT o_orderkey AS id,
       lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS cliente_id,
       o_orderkey % 5 AS banco_id,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS numero_proposta,
       CASE WHEN o_orderkey % 11 <> 0 THEN 'CT' || CAST(o_orderkey AS VARCHAR) END AS numero_contrato,
       o_orderdate AS data_contrato,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS data_cancelamento,
       CAST(o_totalprice AS DECIMAL(18,2)) AS valor_comissao,
       CAST(o_totalprice AS DECIMAL(18,2)) AS valor_liberado,
       o_orderpriority AS produto,
       'CONVENIO BRAND#' || CAST(o_custkey % 25 + 1 AS VARCHAR) AS convenio
FROM orders
"""

CARD = """
SELECT lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') AS cliente_id,
       l.l_shipdate AS data_cartao,
       CASE WHEN o.o_orderstatus = 'P' THEN l.l_shipdate END AS data_cancelamento
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

LEADS = """
SELECT event_id AS id,
       user_id,
       CASE WHEN (user_id * 8 + event_id % 8) % 37 = 0 THEN NULL
            WHEN (user_id * 8 + event_id % 8) % 41 = 0 THEN ''
            ELSE '(' || CAST(11 + (user_id * 8 + event_id % 8) % 89 AS VARCHAR) || ') 9'
                 || lpad(CAST(((user_id * 8 + event_id % 8) * 7919) % 100000000 AS VARCHAR), 8, '0') END AS telefone,
       'Cliente ' || CAST(user_id AS VARCHAR) AS nome,
       'MODELO ' || CAST(user_id % 40 AS VARCHAR) AS veiculo,
       'FIPE' || CAST(user_id % 40 AS VARCHAR) AS fipe,
       'MARCA ' || CAST(user_id % 12 AS VARCHAR) AS marca,
       CAST(2010 + event_id % 16 AS VARCHAR) || '/' || CAST(2011 + event_id % 16 AS VARCHAR) AS ano,
       CAST(CAST(round(value * 100) AS BIGINT) * 2 AS DECIMAL(18,2)) AS valor,
       CASE WHEN event_id % 13 <> 0
            THEN CAST(CAST(round(value * 100) AS BIGINT) * 2 + (event_id % 10) * 500 AS DECIMAL(18,2)) END AS valor_fipe,
       CASE WHEN user_id % 5 = 0 THEN 'MOTO' ELSE 'CARRO' END AS tipo_veiculo,
       CASE event_type WHEN 'click' THEN 'APROVADO NÃO EFETIVADO' WHEN 'view' THEN 'C2C'
                       WHEN 'purchase' THEN 'SIMULAÇÃO DIGITAL - C2C' WHEN 'signup' THEN 'QUITADOS - C2C'
                       WHEN 'error' THEN 'SEGURO AUTO' END AS canal,
       CASE WHEN event_type IN ('click', 'view') THEN 'CRM' ELSE 'SMS' END AS tipo_envio,
       CASE WHEN event_id % 3 = 0 THEN 1 END AS enviado,
       CASE event_id % 4 WHEN 0 THEN 'SIM' WHEN 1 THEN 'NAO' WHEN 2 THEN 'NAO TESTADO' ELSE 'ERRO MODELO' END AS abriu_regua,
       CAST(event_id % 8 AS INTEGER) AS propostas_enviadas_minha_loja,
       CAST(event_id % 5 AS INTEGER) AS propostas_enviadas_outras_lojas,
       CASE WHEN event_id % 10 = 9 THEN '{not json'
            ELSE '{"entradaRecomendada": ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS VARCHAR)
              || ', "valorMinimo": ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 50 AS VARCHAR)
              || ', "parcelas": [{"quantidade": 12, "valor": ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 10 AS VARCHAR)
              || '}, {"quantidade": 24, "valor": ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 6 AS VARCHAR)
              || '}, {"quantidade": 36, "valor": ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) * 4 AS VARCHAR)
              || '}]}' END AS ofertas_json,
       ts AS data_chegada,
       ts AS data_insercao,
       CASE WHEN event_id % 7 = 1 THEN ts + INTERVAL 1 HOUR END AS data_hora_enviado,
       CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END AS consultando,
       CASE WHEN event_id % 6 = 0 THEN ts + to_minutes(CAST(event_id % 20 AS BIGINT)) END AS locked_at
FROM events
"""

ENRICHMENT = """
SELECT e.event_id AS negociacao_id,
       CASE WHEN e.user_id % 11 <> 0 THEN lpad(CAST(e.user_id AS VARCHAR), 11, '0') END AS cpf,
       c.c_name AS nome,
       CASE WHEN e.user_id % 3 = 0 THEN 'M' WHEN e.user_id % 3 = 1 THEN 'F' END AS genero,
       CAST(CASE WHEN e.user_id % 4 = 0 THEN 100 ELSE (e.user_id * 37) % 101 END AS INTEGER) AS semelhanca,
       CAST(DATE '1960-01-01' + CAST((e.user_id * 97) % 15000 AS INTEGER) AS DATE) AS data_nascimento
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
WHERE e.event_id % 7 <> 0
"""

CONTACTS = """
SELECT c_custkey AS id, c_custkey AS cliente_id,
       '(' || CAST(11 + c_custkey % 89 AS VARCHAR) || ') 9'
           || lpad(CAST((c_custkey * 7919) % 100000000 AS VARCHAR), 8, '0') AS contato,
       'CELULAR' AS tipo_contato,
       CAST(c_custkey % 2 AS INTEGER) AS whatsapp
FROM customer
"""

BANK_STATEMENTS = """
WITH g AS (
  SELECT l_orderkey, l_linenumber, l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS price,
         MIN(l_shipdate) AS ship, MAX(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey)
SELECT (g.l_orderkey * 8 + g.l_linenumber) * 1048576 + g.l_partkey AS src_id,
       CASE g.l_orderkey % 5 WHEN 0 THEN 'BANCO SANTANDER' WHEN 1 THEN 'BANCO PAN' WHEN 2 THEN 'BANCO DO BRASIL'
            WHEN 3 THEN 'SABEMI' ELSE 'BANCO C6' END AS nom_banco,
       g.l_orderkey % 5 AS banco_id,
       CASE WHEN g.l_linenumber % 3 <> 0 THEN CAST(g.l_orderkey AS VARCHAR) END AS num_proposta,
       CASE WHEN g.l_linenumber % 4 <> 0 THEN 'CT' || CAST(g.l_orderkey AS VARCHAR) END AS num_contrato,
       CASE WHEN g.l_orderkey % 13 <> 0 THEN lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') END AS cliente_id,
       g.price AS val_repasse,
       CASE WHEN g.l_linenumber = 1 THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE g.price END AS val_liberado,
       CASE WHEN g.l_linenumber = 7 THEN NULL WHEN g.flag = 'R' THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(g.price * 0.05 AS DECIMAL(18,2)) END AS val_comissao,
       g.ship AS dat_emprestimo,
       CAST(CAST(g.ship AS DATE) + CAST(g.l_linenumber AS INTEGER) AS TIMESTAMP) AS dat_credito,
       CASE WHEN g.flag = 'R' THEN 'PENDENTE' ELSE 'pago' END AS status_producao,
       upper(p.p_brand) || ' - TAXA ' || CAST(1 + g.l_partkey % 3 AS VARCHAR) || ',' || CAST(g.l_partkey % 10 AS VARCHAR)
         || '% CÓD. ' || CAST(p.p_size AS VARCHAR) AS dsc_produto,
       'CONVENIO ' || upper(p.p_brand) AS dsc_convenio,
       CAST(g.l_linenumber AS INTEGER) AS prazo,
       g.price AS val_bruto,
       CASE WHEN g.l_linenumber % 2 = 0 THEN 'REFIN' ELSE 'NOVO' END AS tipo_operacao,
       CASE WHEN g.flag = 'A' THEN CAST(CAST(g.ship AS DATE) + 40 AS TIMESTAMP) END AS dat_confirmacao,
       CASE WHEN g.l_orderkey % 5 = 2 THEN 'BB' ELSE 'NOVA' END AS plataforma
FROM g JOIN orders o ON g.l_orderkey = o.o_orderkey LEFT JOIN part p ON g.l_partkey = p.p_partkey
"""

RATE_TABLE = """
SELECT p_partkey AS id, upper(p_brand) AS descricao_banco, CAST(p_size AS VARCHAR) AS codigo, p_type AS forma_contrato,
       CAST((1 + p_partkey % 3) * 10 + p_partkey % 10 AS DOUBLE) / 10.0 AS taxa_total,
       CAST((1 + p_partkey % 4) * 10 + p_partkey % 7 AS DOUBLE) / 10.0 AS taxa_vista,
       CAST(p_partkey % 50 AS DOUBLE) / 10.0 AS comissao_vista,
       CAST(DATE '1994-01-01' + CAST((p_partkey % 5) * 365 AS INTEGER) AS DATE) AS data_inicio,
       CASE WHEN p_partkey % 3 <> 0 THEN CAST(DATE '1994-01-01' + CAST((p_partkey % 5) * 365 + 700 AS INTEGER) AS DATE) END AS data_fim
FROM part
"""

RATE_HISTORY = """
SELECT p_partkey AS id, 'R' || CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS codigo,
       upper(p_brand) AS descricao_banco, lpad(CAST(p_size AS VARCHAR), 3, '0') AS prazo,
       CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) / 100000.0 AS taxa_total,
       CAST(p_partkey % 30 AS DOUBLE) / 10.0 AS taxa_vista,
       CAST(p_partkey % 9 AS DOUBLE) / 10.0 AS comissao_total,
       CAST(p_partkey % 9 AS DOUBLE) / 10.0 AS comissao_vista,
       'banco_teste' AS banco, DATE '2024-01-01' AS data_inicio,
       CASE WHEN p_partkey % 17 = 0 THEN DATE '2024-06-30' END AS data_fim
FROM part
"""

NEW_RATE_FILE = """
WITH b AS (
  SELECT 'R' || CAST(p_partkey AS VARCHAR) AS codigo_regra, CAST(NULL AS VARCHAR) AS range_faixa,
         CAST(p_size AS VARCHAR) AS faixa_parcela, upper(p_brand) AS descricao_regra,
         CASE WHEN p_partkey % 10 = 1 THEN CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) / 100000.0 + 0.5
              ELSE CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) / 100000.0 END AS taxa_juros_sem_seguro,
         CAST(p_partkey % 30 AS DOUBLE) / 10.0 AS taxa_juros_com_seguro,
         CAST(p_partkey % 9 AS DOUBLE) / 10.0 AS percentual_comissao_a_vista,
         p_partkey AS pk
  FROM part WHERE p_partkey % 10 <> 0)
SELECT codigo_regra, range_faixa, faixa_parcela, descricao_regra, taxa_juros_sem_seguro, taxa_juros_com_seguro,
       percentual_comissao_a_vista FROM b
UNION ALL
SELECT 'N' || CAST(pk AS VARCHAR), range_faixa, faixa_parcela, descricao_regra, taxa_juros_sem_seguro,
       taxa_juros_com_seguro, percentual_comissao_a_vista FROM b WHERE pk % 10 = 2
"""

CRM_MESSAGES = """
SELECT conv_id AS atendimento_id, CASE WHEN role = 'assistant' THEN 'out' ELSE 'in' END AS direcao,
       CASE WHEN role = 'system' THEN 'aviso' ELSE 'texto' END AS tipo,
       TIMESTAMP '2024-01-15 08:00:00' + to_days(CAST(conv_id % 20 AS INTEGER)) + to_minutes(CAST(turn AS BIGINT)) AS criado_em
FROM conversations
"""

CRM_CONVERSATIONS = "SELECT DISTINCT conv_id AS id, conv_id AS contato_id FROM conversations"

CRM_TAGS = """
SELECT conv_id AS contato_id,
       CAST(CASE turn % 4 WHEN 0 THEN 30 WHEN 1 THEN 20 WHEN 2 THEN 15 ELSE 99 END AS INTEGER) AS etiqueta_id,
       TIMESTAMP '2024-01-20 00:00:00' + to_hours(CAST(turn AS BIGINT)) AS data_etiqueta
FROM conversations
"""

CAMPAIGN_PRODUCTION = """
SELECT o_orderkey AS id,
       '(' || CAST(11 + o_custkey % 89 AS VARCHAR) || ') 9' || lpad(CAST((o_custkey * 7919) % 100000000 AS VARCHAR), 8, '0')
         AS telefone_cliente,
       CASE WHEN o_orderkey % 3 = 0 THEN 'CAMPANHA' ELSE 'PARCEIRO' END AS origem_venda,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS data_cancelamento,
       CAST(o_totalprice AS DECIMAL(18,2)) AS valor_comissao,
       o_orderdate AS data_contrato,
       CAST(o_totalprice AS DECIMAL(18,2)) AS valor_veiculo,
       'R' || CAST(o_orderkey % 15 + 5 AS VARCHAR) AS regra,
       CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'S' END AS flag_estudo
FROM orders
"""

INSURANCE = """
SELECT c.c_name AS segurado, lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') AS cpfcnpj_do_cliente,
       CASE WHEN l.l_orderkey % 2 = 0 THEN strftime(o.o_orderdate, '%d/%m/%Y') ELSE strftime(o.o_orderdate, '%-d/%-m/%Y') END
         AS data_da_operacao,
       CAST(l.l_linenumber AS VARCHAR) || '/12' AS parcela,
       CASE WHEN l.l_returnflag IN ('R', 'A') THEN 'PENDENTE PAGAMENTO' ELSE 'PAGO' END AS status
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
"""

INSURANCE_SALES = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cliente_id,
       CASE c_custkey % 2 WHEN 0 THEN
         '(' || CAST(11 + c_custkey % 89 AS VARCHAR) || ') 9' || lpad(CAST((c_custkey * 7919) % 100000000 AS VARCHAR), 8, '0')
       END AS telefone_venda
FROM customer
"""

MONTHLY_INDEX = """
SELECT ano_mes, CAST((CAST(substr(ano_mes, 6, 2) AS INTEGER) * 7) % 10 AS DOUBLE) / 2.0 + 1.5 AS pcila_txa
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ano_mes FROM orders)
"""

PRODUCTION_LINES = """
SELECT lpad(CAST(o.o_custkey AS VARCHAR), 11, '0') AS cliente_id, o.o_orderdate AS data_contrato,
       CASE WHEN l.l_returnflag = 'R' THEN 'SEGURO PRESTAMISTA' ELSE 'CONSIGNADO' END AS produto,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS Total_Liberado,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS valor_comissao,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS base_comissao
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

TABULATIONS = """
SELECT lpad(CAST(user_id AS VARCHAR), 11, '0') AS cpf, event_type = 'purchase' AS efetiva,
       ts - INTERVAL 26 YEAR AS data FROM events
"""

CLIENT_LIST = "SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cliente_id FROM customer"

_MOBILE = ("'(' || CAST(11 + (c_custkey * 8) % 89 AS VARCHAR) || ') 9' "
           "|| lpad(CAST(((c_custkey * 8) * 7919) % 100000000 AS VARCHAR), 8, '0')")
_MOBILE_D = f"regexp_replace({_MOBILE}, '[^0-9]', '', 'g')"
CLIENTS = f"""
SELECT c_custkey AS idTabela, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS id, c_name AS nome,
       CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' END AS genero,
       CASE WHEN c_custkey % 2 = 1 THEN substr({_MOBILE_D}, 1, 2) || substr({_MOBILE_D}, 4) END AS telefone,
       CASE WHEN c_custkey % 2 = 0 THEN {_MOBILE_D} END AS celular,
       CAST(DATE '1950-01-01' + CAST((c_custkey * 131) % 20000 AS INTEGER) AS DATE) AS data_nasc
FROM customer
"""

CAMPAIGN_MEMBERS = """
SELECT CAST(CASE WHEN c_custkey % 13 <> 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 9011 WHEN c_custkey % 3 = 1 THEN 15422 ELSE 777 END AS BIGINT) AS campanha_id,
       c_custkey AS cliente_id, CASE WHEN c_custkey % 39 <> 0 THEN c_custkey % 7 + 100 END AS usuario_id
FROM customer
"""

CONTACT_LOG = """
SELECT o_orderkey AS id, o_custkey AS relacao_id, CAST(CASE WHEN o_orderkey % 50 = 0 THEN 9011 END AS BIGINT) AS campanha_id, o_orderdate AS dataregistro
FROM orders
"""

INSURANCE_QUERIES = """
SELECT event_id AS contato_id,
       CASE WHEN event_id % 9 = 0 THEN 'CPF' || CAST(user_id AS VARCHAR) ELSE 'ABC' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END AS placa,
       lpad(CAST(user_id AS VARCHAR), 11, '0') AS cpf,
       (['sp', 'RJ', 'mg', 'XX'])[user_id % 4 + 1] AS uf_licenciamento,
       CASE WHEN event_id % 2 = 0 THEN 'Usado' ELSE '0km/Novo' END AS estado_veiculo,
       'MARCA ' || CAST(user_id % 12 AS VARCHAR) AS marca,
       CASE WHEN event_id % 11 <> 0 THEN 'MODELO ' || CAST(user_id % 40 AS VARCHAR) || ' 1.6 FLEX' END AS modelo,
       CASE WHEN user_id % 5 = 0 THEN 'MOTO' ELSE 'CARRO' END AS tipo_veiculo,
       CAST(2010 + event_id % 16 AS VARCHAR) || ' FLEX' AS ano_combustivel,
       CASE WHEN event_id % 7 <> 0 THEN value * 300 END AS preco_medio_veiculo,
       (['PARTICULAR', 'APLICATIVO', 'PCD', 'TAXISTA', 'FROTA'])[event_id % 5 + 1] AS uso_veiculo,
       CAST(DATE '1960-01-01' + CAST((user_id * 97) % 15000 AS INTEGER) AS DATE) AS data_nascimento,
       CASE WHEN event_id % 4 <> 0 THEN ts END AS data_placa,
       CASE WHEN event_id % 5 = 0 THEN ts END AS data_consulta
FROM events WHERE event_type = 'purchase'
"""

ADDRESSES = """
SELECT c_custkey * 10 + 1 AS id, c_custkey AS cliente_id, (['AC', 'AL', 'AM', 'AP', 'BA', 'CE', 'DF', 'ES', 'GO', 'MA', 'MG', 'MS', 'MT', 'PA', 'PB', 'PE', 'PI', 'PR', 'RJ', 'RN', 'RO', 'RR', 'RS', 'SC', 'SE', 'SP', 'TO'])[c_nationkey % 27 + 1] AS uf
FROM customer
UNION ALL
SELECT c_custkey * 10 + 2, c_custkey, (['AC', 'AL', 'AM', 'AP', 'BA', 'CE', 'DF', 'ES', 'GO', 'MA', 'MG', 'MS', 'MT', 'PA', 'PB', 'PE', 'PI', 'PR', 'RJ', 'RN', 'RO', 'RR', 'RS', 'SC', 'SE', 'SP', 'TO'])[(c_nationkey + 5) % 27 + 1]
FROM customer WHERE c_custkey % 8 = 1
"""

CLIENT_CONTACTS = "SELECT c_custkey AS cliente_id, c_custkey AS contato_id FROM customer"

TELEMARKETING_TEXTS = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'empresa' ELSE 'cliente' END AS relacao,
       o_custkey AS relacao_id, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 11 END AS usuario_id,
       o_orderkey % 4 AS status_telemarketing_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'sem telefone'
            ELSE 'Contato <b>>(' || CAST(11 + o_custkey % 89 AS VARCHAR) || ')9'
                 || lpad(CAST((o_custkey * 7919) % 100000000 AS VARCHAR), 8, '0') || '<</b> ok' END AS texto,
       o_orderdate AS dataregistro
FROM orders
"""

STAFF_USERS = "SELECT s_suppkey AS id, 'user' || CAST(s_suppkey AS VARCHAR) AS login FROM supplier"

FIXTURES = {
    "producao_all": PRODUCTION,
    "producao_cartao": CARD,
    "negociacao_cockpit": LEADS,
    "enriquecimento_lead": ENRICHMENT,
    "contato_cliente": CONTACTS,
    "contratos_bancos": BANK_STATEMENTS,
    "tabela_taxas": RATE_TABLE,
    "tabela_taxas_hist": RATE_HISTORY,
    "arquivo_taxas": NEW_RATE_FILE,
    "crm_whatsapp": CRM_MESSAGES,
    "crm_atendimentos": CRM_CONVERSATIONS,
    "crm_contato_etiquetas": CRM_TAGS,
    "producao_fin_banco": CAMPAIGN_PRODUCTION,
    "comissao_seguro_auto": INSURANCE,
    "producao_seguros": INSURANCE_SALES,
    "pc_ila_financiamento": MONTHLY_INDEX,
    "producao_extenso": PRODUCTION_LINES,
    "tabulacoes": TABULATIONS,
    "lista_clientes": CLIENT_LIST,
    "clientes": CLIENTS,
    "campanha_cliente": CAMPAIGN_MEMBERS,
    "telemarketing": CONTACT_LOG,
    "consulta_seguro": INSURANCE_QUERIES,
    "logradouro": ADDRESSES,
    "cliente_contato": CLIENT_CONTACTS,
    "telemarketing_textos": TELEMARKETING_TEXTS,
    "usuario": STAFF_USERS,
}


def with_fixtures(sql: str, names: list[str], extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` (which must start with SELECT or WITH-less body) with CTEs."""
    if not names:
        return sql.strip()
    defs = dict(FIXTURES)
    defs.update(extra or {})
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
