"""Scalar-function queries over whole driver tables (F1-F16, F18-F28, F33-F42,
F48-F50, F56-F58, J23-J24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import dates as D
from ledgerlens.functions import scalars as S
from ledgerlens.plans.oracle_fixtures import with_fixtures
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_snippets import AS_OF_EVENTS_SQL, ddd_state_cte, digits_sql, ticket_sql
from ledgerlens.sources import fixtures as X
from ledgerlens.sources.tables import read_table

# ------------------------------------------------------------------ phones

_D = digits_sql("telefone")
_LOCAL = f"CASE WHEN starts_with({_D}, '55') AND length({_D}) > 11 THEN substr({_D}, 3) ELSE {_D} END"
PHONE_SQL = with_fixtures(f"""
WITH ddd_estado AS ({ddd_state_cte()}),
p AS (SELECT id, telefone, {_D} AS digitos FROM negociacao_cockpit)
SELECT p.id, p.telefone, p.digitos,
  nullif(regexp_replace(regexp_replace(trim(p.telefone), '\\.0$', ''), '[^0-9]', '', 'g'), '') AS numeros,
  CASE WHEN p.digitos = '' THEN NULL
       WHEN starts_with(p.digitos, '55') THEN CASE WHEN length(p.digitos) IN (12, 13) THEN p.digitos END
       WHEN length(p.digitos) IN (10, 11) THEN '55' || p.digitos END AS telefone_55,
  CASE WHEN length(p.digitos) >= 11 THEN right(p.digitos, 11) END AS ultimos_11,
  nullif(p.digitos, '') AS telefone_digitos,
  CASE WHEN length(p.digitos) >= 11 AND substr(p.digitos, 3, 1) = '9'
       THEN substr(p.digitos, 1, 2) || substr(p.digitos, 4) ELSE p.digitos END AS sem_nono,
  CASE WHEN length(lc) = 11 AND substr(lc, 3, 1) = '9' THEN 'CELULAR' WHEN length(lc) = 10 THEN 'FIXO'
       ELSE 'INVALIDO' END AS tipo_contato,
  de.uf AS estado,
  translate(p.telefone, '()- +', '') AS sem_pontuacao
FROM (SELECT *, {_LOCAL.replace('telefone', 'p0.telefone')} AS lc FROM negociacao_cockpit p0) q
JOIN p ON p.id = q.id
LEFT JOIN ddd_estado de ON length(q.lc) >= 10 AND de.ddd = TRY_CAST(substr(q.lc, 1, 2) AS INTEGER)
""", ["negociacao_cockpit"])


@query("norm_telefone", PHONE_SQL)
def norm_telefone(spark, sf_dir):
    t = F.col("telefone")
    d = S.digits(t)
    return X.leads(spark, sf_dir).select(
        "id", "telefone", d.alias("digitos"), S.digits_or_null(t).alias("numeros"),
        S.phone_55(t).alias("telefone_55"), S.last11(t).alias("ultimos_11"),
        S.phone_digits(t).alias("telefone_digitos"), S.drop_ninth_digit(d).alias("sem_nono"),
        S.phone_kind(t).alias("tipo_contato"), S.state_by_phone(t).alias("estado"),
        S.strip_phone_punct(t).alias("sem_pontuacao"))


# ------------------------------------------------------------------ cpf

_CD = digits_sql("cpf")
CPF_SQL = with_fixtures(f"""
SELECT negociacao_id, cpf,
  CASE WHEN cpf IS NULL OR cpf = 'None' THEN NULL
       ELSE substr(lpad({_CD}, 11, '0'), 1, 3) || '.' || substr(lpad({_CD}, 11, '0'), 4, 3) || '.'
            || substr(lpad({_CD}, 11, '0'), 7, 3) || '-' || substr(lpad({_CD}, 11, '0'), 10, 2) END AS cpf_formatado,
  CASE WHEN length({_CD}) = 11 THEN {_CD} END AS cpf_digitos,
  CASE WHEN length({_CD}) < 11 THEN lpad({_CD}, 11, '0') ELSE {_CD} END AS cpf_zfill
FROM (SELECT negociacao_id, CASE WHEN negociacao_id % 5 = 0 THEN ltrim(cpf, '0') ELSE cpf END AS cpf
      FROM enriquecimento_lead)
""", ["enriquecimento_lead"])


@query("formatar_cpf", CPF_SQL)
def formatar_cpf(spark, sf_dir):
    e = X.lead_enrichment(spark, sf_dir).select(
        "negociacao_id",
        F.when(F.pmod(F.col("negociacao_id"), F.lit(5)) == 0, F.ltrim(F.col("cpf"), F.lit("0"))).otherwise(F.col("cpf")).alias("cpf"))
    c = F.col("cpf")
    return e.select("negociacao_id", "cpf", S.cpf_mask(c).alias("cpf_formatado"),
                    S.cpf_unmask(c).alias("cpf_digitos"), S.cpf_zfill(c).alias("cpf_zfill"))


# ------------------------------------------------------------------ text

def _strip_sql(x: str) -> str:
    # DuckDB's own decomposition, not the library's table
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


_P = "de|da|do|das|dos|e"
TEXT_SQL = with_fixtures(f"""
-- DuckDB upper-cases 'ß' to 'ẞ'; Python and Spark give 'SS', so the oracle spells it out.
WITH t AS (SELECT conv_id, turn, text FROM conversations)
SELECT conv_id, turn,
  trim(regexp_replace(regexp_replace(lower({_strip_sql('text')}), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g')) AS texto_normalizado,
  CASE WHEN text IS NULL OR trim(text) = '' THEN ''
       ELSE trim(regexp_replace(regexp_replace(regexp_replace(lower({_strip_sql('trim(text)')}), '[^a-z0-9\\s]', '', 'g'),
                                               '\\b({_P})\\b', '', 'g'), '\\s+', ' ', 'g')) END AS nome_limpo,
  coalesce(upper(trim({_strip_sql('text')})), '') AS sem_acento_upper,
  upper(replace(trim(text), 'ß', 'SS')) AS upper_trim,
  upper(replace(substr(text, 1, 1), 'ß', 'SS')) || lower(substr(text, 2)) AS capitalizado
FROM t
""", [])


@query("limpar_texto", TEXT_SQL)
def limpar_texto(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    t = F.col("text")
    return c.select("conv_id", "turn", S.normalize_text(t).alias("texto_normalizado"),
                    S.clean_br_name(t).alias("nome_limpo"), S.accent_upper(t).alias("sem_acento_upper"),
                    S.upper_trim(t).alias("upper_trim"), S.capitalize_first(t).alias("capitalizado"))


# ------------------------------------------------------------------ money

def _money_text_sql() -> str:
    dec = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
    return (f"CASE o_orderkey % 4 WHEN 0 THEN 'R$ ' || replace({dec}, '.', ',') WHEN 1 THEN replace({dec}, '.', ',') "
            f"WHEN 2 THEN 'abc' ELSE {dec} END")


MONEY_SQL = f"""
WITH m AS (SELECT o_orderkey, {_money_text_sql()} AS texto FROM orders)
SELECT o_orderkey, texto,
  CASE WHEN texto IS NULL OR texto = '' THEN CAST(0 AS DECIMAL(38,4))
       ELSE coalesce(TRY_CAST(trim(replace(replace(replace(replace(texto, '.', ''), ',', '.'), 'R$', ''), 'RS', ''))
                              AS DECIMAL(38,4)), CAST(0 AS DECIMAL(38,4))) END AS valor_decimal,
  TRY_CAST(nullif(replace(regexp_replace(trim(coalesce(texto, '')), '[^0-9,.\\-]', '', 'g'), ',', '.'), '') AS DOUBLE) AS valor_numerico
FROM m
"""


@query("parse_valor", MONEY_SQL)
def parse_valor(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    dec = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    txt = (F.when(k == 0, F.concat(F.lit("R$ "), F.replace(dec, F.lit("."), F.lit(","))))
           .when(k == 1, F.replace(dec, F.lit("."), F.lit(",")))
           .when(k == 2, F.lit("abc")).otherwise(dec))
    m = o.select("o_orderkey", txt.alias("texto"))
    return m.select("o_orderkey", "texto", S.money_text_to_decimal(F.col("texto")).alias("valor_decimal"),
                    S.numeric_text(F.col("texto")).alias("valor_numerico"))


# ------------------------------------------------------------------ product text

INFO_SQL = with_fixtures("""
SELECT src_id, dsc_produto,
  nullif(trim(regexp_extract(upper(dsc_produto), '^(.*?)\\s*-\\s*TAXA', 1)), '') AS regra,
  TRY_CAST(replace(nullif(regexp_extract(upper(dsc_produto), 'TAXA\\s+([\\d,]+)%', 1), ''), ',', '.') AS DOUBLE) AS taxa,
  nullif(regexp_extract(upper(dsc_produto), 'C[ÓO]D\\.?\\s*(\\d+)', 1), '') AS codigo
FROM contratos_bancos""", ["contratos_bancos"])


@query("info_produto", INFO_SQL)
def info_produto(spark, sf_dir):
    s = X.bank_statements(spark, sf_dir)
    p = F.col("dsc_produto")
    return s.select("src_id", "dsc_produto", S.product_rule(p).alias("regra"), S.product_rate(p).alias("taxa"),
                    S.product_code(p).alias("codigo"))


# ------------------------------------------------------------------ bins

_EDGES = [0, 30000, 60000, 100000]
_LABELS = ["Até 30k", "30k-60k", "60k-100k"]


def _right_closed_sql(v: str) -> str:
    parts = " ".join(f"WHEN {v} > {lo} AND {v} <= {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(_EDGES[:-1], _EDGES[1:], _LABELS))
    return f"CASE {parts} END"


FAIXAS_SQL = with_fixtures(f"""
SELECT id, valor,
  {ticket_sql('valor')} AS classificacao_ticket,
  CASE WHEN valor IS NULL OR valor < 0 THEN NULL WHEN valor < 40000 THEN 'Baixo' WHEN valor < 70000 THEN 'Médio'
       WHEN valor < 100000 THEN 'Alto' ELSE 'Muito Alto' END AS classificacao_ticket_db,
  CASE WHEN valor >= 0 THEN CAST(CAST(floor(valor / 10000) * 10000 AS BIGINT) AS VARCHAR) || '-'
       || CAST(CAST(floor(valor / 10000) * 10000 AS BIGINT) + 10000 AS VARCHAR) END AS faixa_10k,
  {_right_closed_sql('valor')} AS faixa_valor
FROM negociacao_cockpit""", ["negociacao_cockpit"])


@query("faixas", FAIXAS_SQL)
def faixas(spark, sf_dir):
    v = F.col("valor")
    return X.leads(spark, sf_dir).select(
        "id", "valor", S.ticket_class(v).alias("classificacao_ticket"), S.ticket_class_db(v).alias("classificacao_ticket_db"),
        S.step_bins(v, 10000).alias("faixa_10k"), S.bins_right_closed(v, _EDGES, _LABELS).alias("faixa_valor"))


# ------------------------------------------------------------------ dates

def _ord(d: str) -> str:
    n = f"date_diff('day', DATE '1970-01-05', CAST({d} AS DATE))"
    return f"(5 * CAST(floor({n} / 7) AS BIGINT) + least((({n} % 7) + 7) % 7, 5))"


_DOW = "dayofweek(CAST(o_orderdate AS DATE))"  # DuckDB: 0 = Sunday .. 6 = Saturday
_ROLLED = (f"CASE WHEN {_DOW} = 0 THEN CAST(o_orderdate AS DATE) - 2 WHEN {_DOW} = 6 THEN CAST(o_orderdate AS DATE) - 1 "
           f"ELSE CAST(o_orderdate AS DATE) END")
_STEPS = f"CASE WHEN {_DOW} IN (0, 6) THEN 1 ELSE 2 END"
_W = f"({_ord(_ROLLED)} - {_STEPS})"

DIAS_SQL = f"""
SELECT o_orderkey, o_orderdate,
  CAST({_ord("DATE '2001-08-02'")} - {_ord('o_orderdate')} AS BIGINT) AS dias_uteis_ate_ref,
  CAST(DATE '1970-01-05' + CAST(CAST(floor({_W} / 5) AS BIGINT) * 7 + ((({_W}) % 5) + 5) % 5 AS INTEGER) AS DATE) AS menos_2_dias_uteis,
  strftime(o_orderdate, '%Y-%m') AS mes_ano,
  strftime(o_orderdate, '%d/%m/%Y') AS data_br,
  CAST(DATE '2001-08-02' - CAST(o_orderdate AS DATE) AS INTEGER) AS dias_corridos
FROM orders
"""


@query("dias_uteis", DIAS_SQL)
def dias_uteis(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    ref = F.lit("2001-08-02").cast("date")
    return o.select("o_orderkey", "o_orderdate",
                    D.business_days_between(d, ref).alias("dias_uteis_ate_ref"),
                    D.minus_business_days(d, 2).alias("menos_2_dias_uteis"),
                    D.month_label(d).alias("mes_ano"), D.format_br_date(d).alias("data_br"),
                    D.day_diff(ref, F.to_date(d)).alias("dias_corridos"))


IDADE_SQL = with_fixtures(f"""
SELECT negociacao_id, data_nascimento,
  CASE WHEN a BETWEEN 18 AND 99 THEN CAST(a AS INTEGER) END AS idade,
  CAST(floor(date_diff('day', data_nascimento, CAST({AS_OF_EVENTS_SQL} AS DATE)) / 365.25) AS INTEGER) AS idade_365
FROM (SELECT negociacao_id, data_nascimento,
        year(CAST({AS_OF_EVENTS_SQL} AS DATE)) - year(data_nascimento)
        - CASE WHEN month(CAST({AS_OF_EVENTS_SQL} AS DATE)) < month(data_nascimento)
                 OR (month(CAST({AS_OF_EVENTS_SQL} AS DATE)) = month(data_nascimento)
                     AND day(CAST({AS_OF_EVENTS_SQL} AS DATE)) < day(data_nascimento)) THEN 1 ELSE 0 END AS a
      FROM enriquecimento_lead)
""", ["enriquecimento_lead"])


@query("idade_clientes", IDADE_SQL)
def idade_clientes(spark, sf_dir):
    e = X.lead_enrichment(spark, sf_dir)
    as_of = D.ts_ntz(X.AS_OF_EVENTS)
    return e.select("negociacao_id", "data_nascimento", D.age_years(F.col("data_nascimento"), as_of).alias("idade"),
                    D.age_by_days(F.col("data_nascimento"), as_of).alias("idade_365"))
