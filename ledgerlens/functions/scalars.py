"""Text, identifier, money and binning scalars.

Every function maps Column(s) to a Column built from Spark built-ins, so the
whole chain stays JVM-side inside whole-stage codegen.  No Python UDFs.
Arguments accept a column name or a Column.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _accents() -> tuple[str, str]:
    """Latin letters whose compatibility decomposition is one ASCII character
    and marks, and those characters (for translate; Spark has no NFKD
    built-in, trap T12)."""
    pairs = []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, UNACCENTED = _accents()

# Brazilian name particles dropped by the name cleaner.
NAME_PARTICLES = ["de", "da", "do", "das", "dos", "e"]

# Text treated as a missing key, in any case.
NULL_WORDS = ["", "none", "nan", "null", "<na>", "nat"]
# Words that the text layer stores as NULL (exact case).
STORE_NULL_WORDS = ["nan", "NaT", "None"]

# Area code (DDD) -> state.
DDD_STATE = {
    11: "SP", 12: "SP", 13: "SP", 14: "SP", 15: "SP", 16: "SP", 17: "SP", 18: "SP", 19: "SP",
    21: "RJ", 22: "RJ", 24: "RJ", 27: "ES", 28: "ES",
    31: "MG", 32: "MG", 33: "MG", 34: "MG", 35: "MG", 37: "MG", 38: "MG",
    41: "PR", 42: "PR", 43: "PR", 44: "PR", 45: "PR", 46: "PR",
    47: "SC", 48: "SC", 49: "SC", 51: "RS", 53: "RS", 54: "RS", 55: "RS",
    61: "DF", 62: "GO", 64: "GO", 63: "TO", 65: "MT", 66: "MT", 67: "MS",
    68: "AC", 69: "RO", 71: "BA", 73: "BA", 74: "BA", 75: "BA", 77: "BA", 79: "SE",
    81: "PE", 87: "PE", 82: "AL", 83: "PB", 84: "RN", 85: "CE", 88: "CE",
    86: "PI", 89: "PI", 91: "PA", 93: "PA", 94: "PA", 92: "AM", 97: "AM",
    95: "RR", 96: "AP", 98: "MA", 99: "MA",
}

# State code -> state name.
STATE_NAME = {
    "AC": "ACRE", "AL": "ALAGOAS", "AP": "AMAPA", "AM": "AMAZONAS",
    "BA": "BAHIA", "CE": "CEARA", "DF": "DISTRITO FEDERAL", "ES": "ESPIRITO SANTO",
    "GO": "GOIAS", "MA": "MARANHAO", "MT": "MATO GROSSO", "MS": "MATO GROSSO DO SUL",
    "MG": "MINAS GERAIS", "PA": "PARA", "PB": "PARAIBA", "PR": "PARANA",
    "PE": "PERNAMBUCO", "PI": "PIAUI", "RJ": "RIO DE JANEIRO", "RN": "RIO GRANDE DO NORTE",
    "RS": "RIO GRANDE DO SUL", "RO": "RONDONIA", "RR": "RORAIMA", "SC": "SANTA CATARINA",
    "SP": "SAO PAULO", "SE": "SERGIPE", "TO": "TOCANTINS",
}

# Vehicle usage code -> label (no ELSE: others are NULL).
USAGE_LABEL = {
    "PARTICULAR": "Comum",
    "APLICATIVO": "Motorista de Aplicativo",
    "PCD": "PCD",
    "TAXISTA": "Taxista",
}


def literal_map(mapping: dict) -> Column:
    """A MapType literal; a constant folded into the plan (never a join)."""
    parts = []
    for k, v in mapping.items():
        parts += [F.lit(k), F.lit(v)]
    return F.create_map(*parts)


# ------------------------------------------------------------------ digits

def digits(x) -> Column:
    """digits only, NULL -> ''."""
    return F.regexp_replace(F.coalesce(_c(x).cast("string"), F.lit("")), r"\D", "")


def digits_or_null(x) -> Column:
    """digits after dropping a trailing ``.0``; empty -> NULL."""
    s = F.regexp_replace(F.trim(_c(x).cast("string")), r"\.0$", "")
    return F.nullif(F.regexp_replace(s, r"\D", ""), F.lit(""))


def phone_55(x) -> Column:
    """phone to the ``55...`` form, else NULL."""
    d = digits(x)
    n = F.length(d)
    return (F.when(d == "", F.lit(None).cast("string"))
            .when(d.startswith("55"), F.when(n.isin(12, 13), d))
            .when(n.isin(10, 11), F.concat(F.lit("55"), d)))


def last11(x) -> Column:
    """last 11 digits or NULL."""
    d = digits(x)
    return F.when(F.length(d) >= 11, F.substring(d, -11, 11))


def phone_digits(x) -> Column:
    """phone digits or NULL."""
    return F.nullif(digits(x), F.lit(""))


def drop_ninth_digit(x) -> Column:
    """drop the ninth digit (third char ``9``) when length >= 11."""
    s = _c(x)
    return F.when((F.length(s) >= 11) & (F.substring(s, 3, 1) == "9"),
                  F.concat(F.substring(s, 1, 2), F.substring(s, 4, 1 << 20))).otherwise(s)


def phone_kind(x) -> Column:
    """contact type from a normalised phone: CELULAR / FIXO / INVALIDO."""
    d = digits(x)
    n = F.length(d)
    local = F.when(d.startswith("55") & (n > 11), F.substring(d, 3, 1 << 20)).otherwise(d)
    ln = F.length(local)
    return (F.when((ln == 11) & (F.substring(local, 3, 1) == "9"), F.lit("CELULAR"))
            .when(ln == 10, F.lit("FIXO"))
            .otherwise(F.lit("INVALIDO")))


def cpf_mask(x) -> Column:
    """F8: CPF mask ``000.000.000-00`` (zero padded, cut at 11); NULL/'None' -> NULL."""
    raw = _c(x).cast("string")
    # the digits are named once, so they are taken out once a row
    out = F.regexp_replace(F.lpad(digits(raw), 11, "0"), r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4")
    return F.when(raw.isNull() | (raw == "None"), F.lit(None).cast("string")).otherwise(out)


def cpf_unmask(x) -> Column:
    """CPF digits, NULL unless exactly 11."""
    d = digits(x)
    return F.when(F.length(d) == 11, d)


def cpf_zfill(x) -> Column:
    """digits zero-filled to 11 (``zfill`` never cuts)."""
    d = digits(x)
    return F.when(F.length(d) < 11, F.lpad(d, 11, "0")).otherwise(d)


# ------------------------------------------------------------------ text

def strip_accents(x) -> Column:
    """Accents off via translate; other non-ASCII letters dropped (ASCII encode)."""
    t = F.translate(_c(x), ACCENTED, UNACCENTED)
    return F.regexp_replace(t, r"[^\x00-\x7F]", "")


def normalize_text(x) -> Column:
    """accents off, lower, punctuation off, single spaces, trimmed."""
    t = F.lower(strip_accents(x))
    t = F.regexp_replace(t, r"[^\w\s]", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def clean_br_name(x) -> Column:
    """F11 plus removal of Brazilian particles; NULL/blank -> ''."""
    s = _c(x).cast("string")
    t = F.lower(strip_accents(F.trim(s)))
    t = F.regexp_replace(t, r"[^a-z0-9\s]", "")
    t = F.regexp_replace(t, r"\b(" + "|".join(NAME_PARTICLES) + r")\b", "")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.when(s.isNull() | (F.trim(s) == ""), F.lit("")).otherwise(t)


def accent_upper(x) -> Column:
    """accents off, trimmed, upper; non-text -> ''."""
    return F.coalesce(F.upper(F.trim(strip_accents(x))), F.lit(""))


def upper_trim(x) -> Column:
    """upper + trim."""
    return F.upper(F.trim(_c(x)))


def capitalize_first(x) -> Column:
    """first letter upper, rest lower (not initcap)."""
    s = _c(x)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 20)))


def first_name(x) -> Column:
    """first word, capitalised."""
    w = F.split(F.trim(_c(x)), r"\s+").getItem(0)
    return capitalize_first(F.nullif(w, F.lit("")))


def model_trim(x) -> Column:
    """vehicle model text cut from the engine size on."""
    return F.trim(F.regexp_replace(_c(x), r"\s*\d\.\d.*", ""))


def model_year_first(x) -> Column:
    """model year before ``/``."""
    return F.split(_c(x), "/").getItem(0)


def model_year_last(x) -> Column:
    """model year after ``/`` (the whole text when there is none)."""
    return F.element_at(F.split(_c(x), "/"), -1)


def model_year_int(x) -> Column:
    """first four characters as an integer, NULL when not numeric."""
    return F.substring(_c(x), 1, 4).try_cast("int")


def new_or_used(year, as_of_year) -> Column:
    """``0km/Novo`` when year >= current-1, else ``Usado``."""
    return F.when(_c(year) >= (as_of_year - 1), F.lit("0km/Novo")).otherwise(F.lit("Usado"))


def strip_phone_punct(x) -> Column:
    """drop ``( ) - +`` and spaces."""
    return F.translate(_c(x), "()- +", "")


def leading_int(x) -> Column:
    """leading integer after optional spaces and an ``R`` prefix; none -> 0."""
    s = F.regexp_replace(_c(x), "R", "")
    m = F.regexp_extract(s, r"^\s*(\d+)", 1)
    return F.when(m == "", F.lit(0)).otherwise(m.try_cast("long")).cast("long")


def instalment_number(x) -> Column:
    """instalment number before ``/`` (``3/12`` -> 3), NULL when not numeric."""
    return F.substring_index(_c(x), "/", 1).try_cast("long")


def phone_from_text(x) -> Column:
    """phone in free text after ``>(``: from the marker on (trimmed),
    characters 3-4 are the area code and 6-14 the number, ``<`` removed.

    When the marker is absent the text from position 0 is '' in MySQL (Spark
    would return the whole string), so the result is '' (trap T5)."""
    s = _c(x)
    pos = F.locate(">(", s)
    tail = F.when(pos > 0, F.trim(F.substring(s, pos, 1 << 20))).otherwise(F.lit(""))
    ddd = F.replace(F.substring(tail, 3, 2), F.lit("<"), F.lit(""))
    num = F.replace(F.substring(tail, 6, 9), F.lit("<"), F.lit(""))
    return F.when(s.isNotNull(), F.concat(ddd, num))


# ------------------------------------------------------------------ money

def money_text_to_decimal(x) -> Column:
    """``R$ 1.234,56`` -> 1234.56 (decimal); bad or empty -> 0.

    Thousands dots are removed before the comma becomes the decimal point,
    so a float-like ``1234.56`` becomes 123456 (trap T16, kept)."""
    s = _c(x).cast("string")
    t = F.replace(s, F.lit("."), F.lit(""))
    t = F.replace(t, F.lit(","), F.lit("."))
    t = F.replace(t, F.lit("R$"), F.lit(""))
    t = F.replace(t, F.lit("RS"), F.lit(""))
    val = F.trim(t).try_cast("decimal(38,4)")
    return F.when(s.isNull() | (s == ""), F.lit(0).cast("decimal(38,4)")).otherwise(
        F.coalesce(val, F.lit(0).cast("decimal(38,4)")))


def numeric_text(x) -> Column:
    """keep digits , . -; comma -> dot; parse as double; bad -> NULL."""
    s = F.trim(F.coalesce(_c(x).cast("string"), F.lit("")))
    s = F.replace(F.regexp_replace(s, r"[^\d,.\-]", ""), F.lit(","), F.lit("."))
    return F.nullif(s, F.lit("")).try_cast("double")


def clean_key(x) -> Column:
    """F16: trim, drop trailing ``.0``; null words -> NULL (T3 default)."""
    t = F.trim(_c(x).cast("string"))
    s = F.when(F.contains(t, F.lit(".0")), F.regexp_replace(t, r"\.0$", "")).otherwise(t)  # most keys need no pattern
    return F.when(F.lower(s).isin(*NULL_WORDS), F.lit(None).cast("string")).otherwise(s)


def null_words_to_null(x) -> Column:
    """The exact words ``nan``, ``NaT`` and ``None`` -> NULL."""
    s = _c(x).cast("string")
    return F.when(s.isin(*STORE_NULL_WORDS), F.lit(None)).otherwise(s)


# ------------------------------------------------------------------ product

def product_rule(x, upper: bool = True) -> Column:
    """rule text before ``- TAXA`` (upper-cased), NULL if absent.  The
    three patterns here are fixed values: the statements' product text."""
    u = F.upper(_c(x)) if upper else _c(x)
    return F.nullif(F.trim(F.regexp_extract(u, r"^(.*?)\s*-\s*TAXA", 1)), F.lit(""))


def product_rate(x, upper: bool = True) -> Column:
    """rate ``TAXA x,y%`` as double, NULL if absent."""
    u = F.upper(_c(x)) if upper else _c(x)
    m = F.regexp_extract(u, r"TAXA\s+([\d,]+)%", 1)
    return F.replace(F.nullif(m, F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def product_code(x, upper: bool = True) -> Column:
    """code after ``CÓD.`` / ``COD``, NULL if absent."""
    u = F.upper(_c(x)) if upper else _c(x)
    return F.nullif(F.regexp_extract(u, r"C[ÓO]D\.?\s*(\d+)", 1), F.lit(""))


# ------------------------------------------------------------------ lookups

def state_by_phone(x) -> Column:
    """Area code -> state; drop ``55`` when longer than 11; NULL under 10 digits."""
    d = digits(x)
    local = F.when(d.startswith("55") & (F.length(d) > 11), F.substring(d, 3, 1 << 20)).otherwise(d)
    ddd = F.substring(local, 1, 2).try_cast("int")
    return F.when(F.length(local) >= 10, F.element_at(literal_map(DDD_STATE), ddd))


def state_name(x) -> Column:
    """State code -> name; unknown codes pass through."""
    s = _c(x)
    return F.coalesce(F.element_at(literal_map(STATE_NAME), F.upper(s)), s)


def usage_label(x) -> Column:
    """usage code -> label (exact match), others NULL."""
    return F.element_at(literal_map(USAGE_LABEL), _c(x))


def amount_int(x) -> Column:
    """NULL -> 0, truncated to integer."""
    return F.coalesce(_c(x), F.lit(0)).cast("long")


def first_contact(*cols) -> Column:
    """first non-null contact."""
    return F.coalesce(*[_c(c) for c in cols])


def concat_strict(*parts) -> Column:
    """``CONCAT`` where any NULL part makes the result NULL."""
    return F.concat(*[_c(p) for p in parts])


# ------------------------------------------------------------------ bins

def bins_right_closed(x, edges: list, labels: list) -> Column:
    """``pd.cut`` right-closed bins ``(e[i], e[i+1]]``; outside -> NULL."""
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v > F.lit(lo)) & (v <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bins_left_closed(x, edges: list, labels: list) -> Column:
    """F49/F50 manual: left-closed bins ``[e[i], e[i+1])``; outside -> NULL."""
    v = _c(x)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (v >= F.lit(lo)) & (v < F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


# Ticket classes (left-closed edges 0/40k/70k/100k/inf).
TICKET_EDGES = [0, 40000, 70000, 100000]
TICKET_LABELS = ["Baixo", "Médio", "Alto", "Muito Alto"]
TICKET_DEFAULT = "NÃO SIMULADO"


def ticket_class(x) -> Column:
    """F49 (daily form): <=0 or NULL -> NÃO SIMULADO, else left-closed classes."""
    v = _c(x)
    return (F.when(v.isNull() | (v <= 0), F.lit(TICKET_DEFAULT))
            .when(v < TICKET_EDGES[1], F.lit(TICKET_LABELS[0]))
            .when(v < TICKET_EDGES[2], F.lit(TICKET_LABELS[1]))
            .when(v < TICKET_EDGES[3], F.lit(TICKET_LABELS[2]))
            .otherwise(F.lit(TICKET_LABELS[3])))


def ticket_class_db(x) -> Column:
    """F49 (database form): Baixo from 0, NULL below 0 or NULL."""
    v = _c(x)
    return (F.when(v.isNull() | (v < 0), F.lit(None).cast("string"))
            .when(v < TICKET_EDGES[1], F.lit(TICKET_LABELS[0]))
            .when(v < TICKET_EDGES[2], F.lit(TICKET_LABELS[1]))
            .when(v < TICKET_EDGES[3], F.lit(TICKET_LABELS[2]))
            .otherwise(F.lit(TICKET_LABELS[3])))


def step_bins(x, step: int) -> Column:
    """generic left-closed bins of ``step``, label ``i-(i+step)``; negative -> NULL."""
    v = _c(x)
    lo = (F.floor(v / F.lit(step)) * F.lit(step)).cast("long")
    return F.when(v >= 0, F.concat(lo.cast("string"), F.lit("-"), (lo + step).cast("string")))


def day_bucket(x) -> Column:
    """``<D0``, ``D0`` .. ``D5``, ``D6+``; NULL stays NULL."""
    v = _c(x)
    expr = F.when(v.isNull(), F.lit(None).cast("string")).when(v < 0, F.lit("<D0"))
    for i in range(6):
        expr = expr.when(v == i, F.lit(f"D{i}"))
    return expr.otherwise(F.lit("D6+"))


def day_bucket_if(flag, x) -> Column:
    """the F51 bucket only where ``flag`` holds, else NULL."""
    return F.when(_c(flag), day_bucket(x))


def commission_split(pct) -> Column:
    """Percentage < 0.5 unchanged, otherwise x0.80 (NULL -> NULL)."""
    p = _c(pct)
    return F.when(p < 0.5, p).otherwise(p * F.lit(0.8))
