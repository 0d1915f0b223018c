"""Operator 4: personal data replaced by keyed, type-consistent surrogates.

Only DataFrame and SQL functions.  One pattern finds all entities of a text:
e-mail addresses, telephone numbers, payment cards (with a valid check
digit), IPv4 addresses, US social security numbers, IBANs, persons' names
after a title, and credentials (access keys, long hexadecimal tokens, values
after ``password=`` and the like).

* Coreference: mentions that differ in writing only (case of an address,
  punctuation or country code of a number, a person's title) share one
  canonical form, and the canonical form fixes the surrogate, everywhere.
* Keyed: surrogates come from SHA-256 of the key, type and canonical form.
* Type and format: digits become digits and letters letters, in each mention's
  own punctuation and case; an address keeps its top-level domain, mentions
  of one domain share one; octets stay octets; a card keeps its first digit
  and gets a valid check digit; telephone areas and exchanges stay dialable; a
  name has the syllables of its script (Latin, Cyrillic, Greek) and the ending
  of its title's gender.
* Distinctness: surrogates of all distinct entities are compared with each
  other and with all real entities; of those that meet, all but one draw
  again, until none do.  Every second attempt makes the surrogate longer (a
  name by a syllable, an address before its @, a number or credential by a
  character), so that more entities than a short form can tell apart fit.

Plan: texts without an entity only pass a filter.  The others are written
once with row numbers; distinct entities, a small table, get their surrogates;
mentions meet them by a join and go back to their row, and the text is put
together from its gaps and surrogates.

Null and empty texts stay as they are; all other columns pass through;
repeated rows stay repeated.  A corpus without entities comes back unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, stage

KEY = "ledgerlens"
ATTEMPTS = 64
GROWN = "(attempt div 2)"  # syllables or characters more than the form has

TITLES_M = "Mr|Herr|Monsieur|Señor|Sr|Signor|Г-н|Господин|Κύριος"
TITLES_F = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Signora|Г-жа|Госпожа|Κυρία"
TITLES_M, TITLES_F = (f"{t}|{t.upper()}" for t in (TITLES_M, TITLES_F))
_NAME = r"\p{Lu}[\p{L}'’-]+"

_SEVEN = "[0-9]" + "[ .()-]{0,3}[0-9]" * 6  # Java's look-behind takes no repeated group

# One pattern a type, tried in this order; none starts inside a word.
PATTERNS = {
    "EMAIL": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*\.\p{L}{2,24}(?![\p{L}\p{N}-])",
    "KEY": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?:ghp_|gho_|sk-|sk_live_|xox[abp]-)[A-Za-z0-9_-]{16,}+",
    "PASSWORD": r"(?<=(?i:password|passwd|pwd|secret|api_key|apikey)[=:])[^\s\"'<>,;]{4,}+",
    "HEX": r"(?<![A-Za-z0-9])(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
    "IBAN": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "SSN": r"(?<![\p{L}\p{N}.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "IP": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])",
    "PHONE": r"(?<![\p{L}\p{N}+.(-])(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}(?<=" + _SEVEN + r"\)?))(?![\p{L}\p{N}]|-[0-9])",
    "CARD": r"(?<![\p{L}\p{N}.+-])[2-6](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}]|[-.][0-9])",
    "NAME_M": rf"(?<![\p{{L}}-])(?:{TITLES_M})\.? {_NAME}(?: {_NAME})?(?: {_NAME})?",
    "NAME_F": rf"(?<![\p{{L}}-])(?:{TITLES_F})\.? {_NAME}(?: {_NAME})?(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DIGITS = ("PHONE", "CARD", "SSN")  # canonical forms of digits only
# what a text with any of them must hold: a quick look before the patterns
HINT = rf"@|[0-9]{{3}}[ -]|[0-9]{{13}}|[0-9]\.[0-9]|[0-9A-Z]{{16}}|[0-9a-f]{{32}}|\+[1-9]|ghp_|gho_|sk[-_]|xox[abp]-|(?i:password|passwd|pwd|secret|api_?key)[=:]|(?:{TITLES_M}|{TITLES_F})\.? \p{{Lu}}"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def entity_type(mention) -> F.Column:
    """The type of a whole match; null for digits that are no card."""
    out = None
    for name, pattern in PATTERNS.items():
        # the surroundings were judged in the text
        alone = mention.rlike(rf"\A(?:{pattern if name != 'PASSWORD' else '(?!)'})\z")
        if name == "CARD":
            alone = alone & (luhn_sum(F.regexp_replace(mention, "[ -]", "")) % 10 == 0)
        out = F.when(alone, F.lit(name)) if out is None else out.when(alone, F.lit(name))
    digits = mention.rlike(r"\A[0-9 -]{13,37}\z")
    return out.when(~digits, F.lit("PASSWORD"))


def luhn_sum(digits, check: bool = True):
    """The check sum of digits, with or without the check digit at its end."""
    odd = 0 if check else 1
    n = F.length(digits)
    each = F.transform(F.split(digits, ""), lambda d, i: F.when((n - 1 - i + odd) % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def canonical(kind: str, mention: str) -> F.Column:
    """What all mentions of an entity share."""
    m = F.col(mention)
    digits = F.regexp_replace(m, "[^0-9]", "")
    name = F.lower(F.regexp_replace(m, rf"\A(?:{TITLES_M}|{TITLES_F})\.? ", ""))
    return (F.when(F.col(kind) == "EMAIL", F.lower(m)).when(F.col(kind) == "PHONE", F.expr(f"right(regexp_replace({mention}, '[^0-9]', ''), 10)"))
            .when(F.col(kind).isin("CARD", "SSN"), digits).when(F.col(kind) == "IBAN", F.regexp_replace(m, " ", ""))
            .when(F.col(kind).startswith("NAME"), name).otherwise(m))


def _bytes(key: str, *parts: str) -> str:
    """128 pseudo-random bytes as hexadecimal digits."""
    said = ", ".join(parts)
    return "concat(" + ", ".join(f"sha2(concat_ws('|', {_lit(key)}, {k}, {said}), 256)" for k in range(4)) + ")"


def _draw(h: str, i: str, width: int = 2) -> str:
    """The number at place ``i`` (from 0)."""
    return f"cast(conv(substr({h}, pmod({i}, {256 // width}) * {width} + 1, {width}), 16, 10) as int)"


def _shaped(text: str, h: str, digits: str = "'0123456789'") -> str:
    """``text`` with each digit and letter drawn anew from its own kind."""
    draw = _draw(h, "i")
    pick = lambda chars: f"substr({chars}, {draw} % length({chars}) + 1, 1)"
    lower, upper = "'abcdefghijklmnopqrstuvwxyz'", "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
    return (f"concat_ws('', transform(split({text}, ''), (c, i) -> case when instr('0123456789', c) > 0 then {pick(digits)} "
            f"when c rlike '[\\\\p{{Lu}}]' then {pick(upper)} when c rlike '[\\\\p{{L}}]' then {pick(lower)} else c end))")


# consonants, vowels and the endings of men's and women's names, by script
SYLLABLES = {"Latin": ("bcdfglmnprstv", "aeiou", "o", "a"), "Cyrillic": ("бвгдзклмнпрст", "аеиоу", "н", "а"), "Greek": ("βγδζκλμνπρστ", "αειου", "ς", "α")}


def _name(key: str) -> str:
    """A lower-case name: each word keyed by itself, given names (all but
    the last word) with the ending of the gender."""
    h = _bytes(key, "'word'", "w", "if(attempt = 0, '', concat(canon, attempt))")

    def word(script: str) -> str:
        c, v, man, woman = SYLLABLES[script]
        syllables = (f"transform(sequence(1, greatest(2, least(6, length(w) div 2)) + {GROWN}), k -> concat(substr('{c}', {_draw(h, '2 * k')} % {len(c)} + 1, 1), "
                     f"substr('{v}', {_draw(h, '2 * k + 1')} % {len(v)} + 1, 1)))")
        end = f"if(i < size(split(canon, ' ')) - 1, if(kind = 'NAME_F', 'l{woman}', 'r{man}'), 'n')" if script == "Latin" else \
            f"if(i < size(split(canon, ' ')) - 1, if(kind = 'NAME_F', '{woman}', '{man}'), '')"
        return f"concat(concat_ws('', {syllables}), {end})"

    return (f"concat_ws(' ', transform(split(canon, ' '), (w, i) -> case when w rlike '[\\\\p{{IsCyrillic}}]' then {word('Cyrillic')} "
            f"when w rlike '[\\\\p{{IsGreek}}]' then {word('Greek')} else {word('Latin')} end))")


def surrogate(key: str) -> str:
    """SQL of the canonical surrogate of (kind, canon) at an attempt."""
    h = _bytes(key, "kind", "canon", "attempt")
    domain = "substring_index(canon, '@', -1)"
    tld = f"substring_index({domain}, '.', -1)"
    host = f"left({domain}, length({domain}) - length({tld}) - 1)"
    # drawn from the end of the hash, which only long forms reach
    more = lambda chars: (f"if({GROWN} = 0, '', concat_ws('', transform(sequence(1, {GROWN}), k -> "  # noqa: E731
                          f"substr('{chars}', {_draw(h, '128 - k')} % {len(chars)} + 1, 1))))")
    letters, numbers = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    email = f"concat({_shaped(chr(115) + 'ubstring_index(canon, ' + _lit('@') + ', 1)', h)}, {more(letters)}, '@', {_shaped(host, _bytes(key, _lit('domain'), domain))}, '.', {tld})"
    octets = f"concat_ws('.', transform(split(canon, '[.]'), (o, i) -> cast(1 + {_draw(h, 'i', 4)} % 254 as string)))"
    phone = (f"concat({more(numbers)}, concat_ws('', transform(split(canon, ''), (c, i) -> cast(if(length(canon) = 10 and i in (0, 3), 2 + {_draw(h, 'i')} % 8, "
             f"{_draw(h, 'i')} % 10) as string))))")
    body = f"concat(left(canon, 1), substr({_shaped('canon', h)}, 2, length(canon) - 2))"
    # a body's check digit, from a one-element array so that it is drawn once
    double = "if(2 * cast(c as int) > 9, 2 * cast(c as int) - 9, 2 * cast(c as int))"
    card = (f"transform(array({body}), b -> concat(b, cast(pmod(-aggregate(transform(split(b, ''), (c, i) -> "
            f"if((length(b) - i) % 2 = 1, {double}, cast(c as int))), 0, (x, y) -> x + y), 10) as string)))[0]")
    iban = f"concat(left(canon, 2), {_shaped('substr(canon, 3)', h)})"
    prefix = r"regexp_extract(canon, '^(AKIA|ASIA|ghp_|gho_|sk-|sk_live_|xox[abp]-)', 1)"
    secret = f"concat({prefix}, {_shaped(f'substr(canon, length({prefix}) + 1)', h)})"
    hexa = (f"concat_ws('', transform(split(canon, ''), (c, i) -> substr('0123456789abcdef', {_draw(h, 'i')} % 16 + 1, 1)))")
    return (f"case kind when 'EMAIL' then {email} when 'IP' then {octets} when 'PHONE' then {phone} when 'CARD' then {card} when 'IBAN' then {iban} "
            f"when 'KEY' then concat({secret}, {more(letters + numbers)}) when 'HEX' then {hexa} when 'PASSWORD' then concat({_shaped('canon', h)}, {more(letters + numbers)}) "
            f"when 'SSN' then {_shaped('canon', h)} else {_name(key)} end")


def rendered() -> str:
    """SQL of a mention's replacement: the canonical surrogate ``drawn`` in
    the mention's punctuation and case."""
    count = "length(regexp_replace(substr(mention, i + 1), '[^0-9]', ''))"
    # what a grown surrogate has more stands before a number's first digit
    # and at the end of an address's local part
    digits = (f"concat_ws('', transform(split(mention, ''), (c, i) -> case when instr('0123456789', c) = 0 or {count} > length(canon) then c "
              f"when {count} = length(canon) then left(drawn, length(drawn) - length(canon) + 1) else substr(drawn, length(drawn) - {count} + 1, 1) end))")
    grown = "(length(drawn) - length(canon))"
    cased = (f"concat_ws('', transform(split(drawn, ''), (c, i) -> if(substr(mention, case when i + 1 < instr(canon, '@') then i + 1 "
             rf"when i + 1 < instr(drawn, '@') then length(mention) + 1 else i + 1 - {grown} end, 1) rlike '[\\p{{Lu}}]', upper(c), c)))")
    # an IBAN's spaces stand in groups of four
    iban = "if(instr(mention, ' ') > 0, trim(regexp_replace(drawn, '(.{4})', '$1 ')), drawn)"
    title = rf"regexp_extract(mention, {_lit(rf'^((?:{TITLES_M}|{TITLES_F})\.? )')}, 1)"
    name = f"concat({title}, if(substr(mention, length({title}) + 1) = upper(substr(mention, length({title}) + 1)), upper(drawn), initcap(drawn)))"
    return (f"case when kind in ('PHONE', 'CARD', 'SSN') then {digits} when kind = 'EMAIL' then {cased} when kind = 'IBAN' then {iban} "
            f"when kind like 'NAME%' then {name} else drawn end")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, drawn: distinct surrogates of distinct entities."""
    drawn = entities.select("kind", "canon", F.lit(0).alias("attempt"))
    for _ in range(ATTEMPTS):
        drawn = stage(drawn.select("kind", "canon", "attempt").withColumn("drawn", F.expr(surrogate(key))), "surrogates")
        # all but the least entity of a surrogate draw again, and all whose
        # surrogate is a real entity
        shared = drawn.groupBy("drawn").agg(F.min(F.struct("kind", "canon")).alias("least"), F.count("*").alias("n")).where("n > 1")
        real = drawn.select(F.col("canon").alias("drawn")).distinct()
        again = drawn.join(shared, "drawn").where(F.struct("kind", "canon") != F.col("least")).select("kind", "canon").unionByName(
            drawn.join(real, "drawn", "left_semi").select("kind", "canon")).distinct()
        if again.isEmpty():
            return drawn.select("kind", "canon", "drawn")
        drawn = drawn.join(again.withColumn("more", F.lit(1)), ["kind", "canon"], "left").withColumn(
            "attempt", F.col("attempt") + F.coalesce("more", F.lit(0)))
    raise RuntimeError(f"surrogates still collide after {ATTEMPTS} attempts")


def replace(docs: DataFrame, key: str = KEY, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; ``count`` names a
    column for their number."""
    columns = docs.columns
    row, mentions, gaps = (free_name(docs, n) for n in ("row", "mentions", "gaps"))
    hit = F.coalesce(F.col(text).rlike(HINT) & F.col(text).rlike(ANY), F.lit(False))
    held = stage(docs.where(hit).withColumn(mentions, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
                 .withColumn(gaps, F.split(text, ANY, -1)).withColumn(row, F.monotonically_increasing_id()), "mentions")
    each = held.select(F.col(row).alias("row"), F.posexplode(mentions).alias("pos", "mention"))
    distinct = each.select("mention").distinct().withColumn("kind", entity_type(F.col("mention")))
    known = stage(distinct.where(F.col("kind").isNotNull()).withColumn("canon", canonical("kind", "mention")), "entities")
    drawn = assign(known.select("kind", "canon").distinct(), key)
    table = known.join(drawn, ["kind", "canon"]).select("mention", F.expr(rendered()).alias("new"))
    placed = each.join(table, "mention", "left").select(
        "row", F.struct("pos", F.coalesce("new", "mention").alias("new"), F.col("new").isNotNull().cast("long").alias("one")).alias("p"))
    placed = placed.groupBy("row").agg(F.array_sort(F.collect_list("p")).alias("p"))  # one text's mentions
    joined = held.join(placed.withColumnRenamed("row", row).withColumnRenamed("p", free_name(held, "placed")), row)
    p = F.col(free_name(held, "placed"))
    new_text = F.concat_ws("", F.flatten(F.zip_with(gaps, p["new"], lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))))
    number = F.aggregate(p["one"], F.lit(0).cast("long"), lambda a, x: a + x)
    extra = [number.alias(count)] if count else []
    done = joined.select(*[new_text.alias(c) if c == text else F.col(c) for c in columns], *extra)
    rest = docs.where(~hit)
    return rest.select(*columns, *([F.lit(0).cast("long").alias(count)] if count else [])).unionByName(done)


def replaced(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return replace(docs.select("doc_id", "text"), count="n_entities")
