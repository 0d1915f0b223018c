"""Reusable DuckDB SQL fragments for the oracle queries."""

from __future__ import annotations

from ledgerlens.functions import scalars as S

AS_OF_EVENTS_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_ORDERS_SQL = "TIMESTAMP '2001-08-02 00:00:00'"


def ticket_sql(v: str) -> str:
    lab = S.TICKET_LABELS
    return (f"CASE WHEN {v} IS NULL OR {v} <= 0 THEN '{S.TICKET_DEFAULT}' WHEN {v} < 40000 THEN '{lab[0]}' "
            f"WHEN {v} < 70000 THEN '{lab[1]}' WHEN {v} < 100000 THEN '{lab[2]}' ELSE '{lab[3]}' END")


def weekday_ordinal_sql(d: str) -> str:
    n = f"date_diff('day', DATE '1970-01-05', CAST({d} AS DATE))"
    return f"(5 * CAST(floor({n} / 7) AS BIGINT) + least((({n} % 7) + 7) % 7, 5))"


def busdays_sql(a: str, b: str) -> str:
    return f"({weekday_ordinal_sql(b)} - {weekday_ordinal_sql(a)})"


def ddd_state_cte() -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in S.DDD_STATE.items())
    return f"SELECT * FROM (VALUES {rows}) t(ddd, uf)"


def digits_sql(x: str) -> str:
    return f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '[^0-9]', '', 'g')"


def state_by_phone_sql(x: str, alias: str = "dd") -> str:
    """Expression joining to the ``ddd_estado`` CTE must be done by caller;
    this returns the local-number digits and the area code expression."""
    d = digits_sql(x)
    local = f"CASE WHEN starts_with({d}, '55') AND length({d}) > 11 THEN substr({d}, 3) ELSE {d} END"
    return local


def token_set_ctes(pairs: str, out: str = "pontuado") -> str:
    """CTEs that end in ``out`` (a, b, semelhanca): F17 and J29 of the distinct
    (a, b) of ``pairs``.  The subsequence is the table method: a row of
    lengths for each character of one string."""
    def clean(x: str) -> str:
        ascii_ = f"regexp_replace(strip_accents(trim({x})), '[^\\x00-\\x7F]', '', 'g')"
        kept = f"regexp_replace(lower({ascii_}), '[^a-z0-9\\s]', '', 'g')"
        return f"trim(regexp_replace(regexp_replace({kept}, '\\b(de|da|do|das|dos|e)\\b', '', 'g'), '\\s+', ' ', 'g'))"

    def tokens(x: str) -> str:
        return f"list_distinct(list_filter(string_split(ifnull({clean(x)}, ''), ' '), lambda t: t <> ''))"

    return f"""
_textos AS (SELECT DISTINCT a, b FROM {pairs}),
_fichas AS (SELECT a, b, {tokens('a')} AS x, {tokens('b')} AS y FROM _textos),
_partes AS (
  SELECT a, b, len(x) AS nx, len(y) AS ny, length(array_to_string(list_intersect(x, y), ' ')) AS comum,
         array_to_string(list_sort(list_filter(x, lambda t: NOT list_contains(y, t))), ' ') AS so_x,
         array_to_string(list_sort(list_filter(y, lambda t: NOT list_contains(x, t))), ' ') AS so_y FROM _fichas),
_linhas AS (
  SELECT *, string_split(so_x, '') AS letras, length(so_x) AS m, length(so_y) AS n FROM _partes),
_lcs AS (
  SELECT *, CASE WHEN m = 0 OR n = 0 THEN 0 ELSE list_last(list_reduce(
    list_prepend(list_transform(range(m + 1), lambda k: CAST(0 AS BIGINT)), list_transform(string_split(so_y, ''), lambda c: [CAST(ord(c) AS BIGINT)])),
    lambda linha, c: list_transform(range(m + 1), lambda j: list_max(list_transform(range(j + 1),
      lambda i: CASE WHEN i = 0 THEN 0 WHEN ord(letras[i]) = c[1] THEN linha[i] + 1 ELSE linha[i + 1] END))))) END AS lcs
  FROM _linhas),
_razoes AS (
  SELECT *, CAST(comum > 0 AS INTEGER) AS tem, comum + CAST(comum > 0 AS INTEGER) + m AS com_x, comum + CAST(comum > 0 AS INTEGER) + n AS com_y FROM _lcs),
{out} AS (
  SELECT a, b, CASE WHEN nx = 0 OR ny = 0 THEN 0 WHEN comum > 0 AND (m = 0 OR n = 0) THEN 100 ELSE CAST(round_even(
    CASE WHEN comum = 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * (m + n - 2 * lcs) / (com_x + com_y)::DOUBLE
    ELSE greatest(100.0::DOUBLE - 100.0::DOUBLE * (m + n - 2 * lcs) / (com_x + com_y)::DOUBLE, 100.0::DOUBLE - 100.0::DOUBLE * (tem + m) / (comum + com_x)::DOUBLE,
                  100.0::DOUBLE - 100.0::DOUBLE * (tem + n) / (comum + com_y)::DOUBLE) END, 0) AS INTEGER) END AS semelhanca
  FROM _razoes)"""
