"""Token-set name similarity (F17, J29), all in the JVM.

Tokens are split, de-duplicated, intersected and differenced with array
built-ins, and the ratios are column arithmetic.  The longest common
subsequence of the two difference strings is a fold over one string's
characters: the other string's places are bits in an array of ``WORD``-bit
words, and one addition with carry, one difference and one "or" a character
move all of them at once.  It runs only where it can matter: not for empty or
contained token sets, nor for strings without a letter in common.

Score semantics (0-100): 0 when either side is empty; 100 when the token
sets share a token and one set contains the other; otherwise the best of
three normalised insert/delete similarities, rounded half-to-even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import clean_br_name

WORD = 62  # bits of a long in use: a sum of two words never overflows


def _chars(s: Column) -> Column:
    n = F.length(s)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(s, i, F.lit(1)))) \
        .otherwise(F.array().cast("array<string>"))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in characters.  A place of
    ``a`` whose bit is off has raised the length so far by one."""
    long = lambda x: F.lit(x).cast("long")
    letters, n = _chars(a), F.length(a)
    words = F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / WORD).cast("int"), F.lit(0)))
    known = F.array_distinct(letters)

    def places(letter):  # the bits of a letter's places, word by word
        def word(w):
            mine = F.slice(letters, w * WORD + 1, F.lit(WORD))
            bits = F.transform(mine, lambda c, k: F.when(c == letter, F.call_function("shiftleft", long(1), k)).otherwise(long(0)))
            return F.aggregate(bits, long(0), lambda x, y: x.bitwiseOR(y))
        return F.transform(words, word)

    masks = F.map_from_arrays(known, F.transform(known, places))
    full = F.transform(words, lambda w: F.call_function("shiftleft", long(1), F.least(n - w * WORD, F.lit(WORD))) - 1)

    def step(v, letter):
        mask = F.element_at(masks, letter)

        def word(state, w):
            old = F.get(v, w)
            u = old.bitwiseAND(F.get(mask, w))
            total = old + u + state["carry"]
            new = total.bitwiseOR(old - u).bitwiseAND(F.get(full, w))
            return F.struct(F.call_function("shiftright", total, F.lit(WORD)).alias("carry"), F.concat(state["out"], F.array(new)).alias("out"))

        start = F.struct(long(0).alias("carry"), F.array().cast("array<bigint>").alias("out"))
        return F.when(mask.isNull(), v).otherwise(F.aggregate(words, start, word)["out"])

    left = F.aggregate(_chars(b), full, step)
    unset = n - F.aggregate(left, F.lit(0), lambda x, y: x + F.bit_count(y))
    some = (n > 0) & (F.length(b) > 0) & F.arrays_overlap(letters, _chars(b))
    return F.when(some, unset.cast("long")).otherwise(long(0))


def _tokens(s: Column) -> Column:
    low = F.trim(F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.array_distinct(F.filter(F.split(low, " "), lambda t: t != ""))


def _score(ta: Column, tb: Column, sect: Column, dab: Column, dba: Column, lcs: Column) -> Column:
    ls, lab, lba = F.length(sect), F.length(dab), F.length(dba)
    has = F.when(ls > 0, 1).otherwise(0)
    sect_ab = ls + has + lab
    sect_ba = ls + has + lba
    dist = lab + lba - F.lit(2) * lcs
    tot = (sect_ab + sect_ba).cast("double")
    r_diff = F.when(tot > 0, F.lit(100.0) - F.lit(100.0) * dist / tot).otherwise(F.lit(0.0))
    r_ab = F.lit(100.0) - F.lit(100.0) * (has + lab) / (ls + sect_ab).cast("double")
    r_ba = F.lit(100.0) - F.lit(100.0) * (has + lba) / (ls + sect_ba).cast("double")
    best = F.when(ls == 0, r_diff).otherwise(F.greatest(r_diff, r_ab, r_ba))
    empty = (F.size(ta) == 0) | (F.size(tb) == 0)
    contained = (ls > 0) & ((lab == 0) | (lba == 0))
    return (F.when(empty, F.lit(0))
            .when(contained, F.lit(100))
            .otherwise(F.bround(best, 0).cast("int")))


def _useful_lcs(dab: Column, dba: Column) -> Column:
    """0 without a fold where one side's tokens are all shared or absent."""
    return F.when((F.length(dab) > 0) & (F.length(dba) > 0), lcs_length(dab, dba)).otherwise(F.lit(0).cast("long"))


def token_set_ratio(a, b) -> Column:
    """F17 on two already-cleaned text columns (single-expression form, for
    small inputs; ``with_token_set_ratio`` is the staged form for tables)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    ta, tb = _tokens(a), _tokens(b)
    sect = F.array_join(F.array_sort(F.array_intersect(ta, tb)), " ")
    dab = F.array_join(F.array_sort(F.array_except(ta, tb)), " ")
    dba = F.array_join(F.array_sort(F.array_except(tb, ta)), " ")
    return _score(ta, tb, sect, dab, dba, _useful_lcs(dab, dba))


def with_token_set_ratio(df, a: str, b: str, out: str = "semelhanca", clean: bool = True):
    """F17/J29 as staged projections: tokens, then the joined token strings,
    then the LCS and the score.  Each stage references the previous one's
    columns, and Catalyst does not inline an expensive expression that is
    used several times, so the tokenisation runs once per row (a single
    expression tree would repeat it in every branch and outgrow codegen)."""
    ca = clean_br_name(F.col(a)) if clean else F.col(a)
    cb = clean_br_name(F.col(b)) if clean else F.col(b)
    d = df.withColumn("_ta", _tokens(ca)).withColumn("_tb", _tokens(cb))
    d = (d.withColumn("_sect", F.array_join(F.array_sort(F.array_intersect("_ta", "_tb")), " "))
         .withColumn("_dab", F.array_join(F.array_sort(F.array_except("_ta", "_tb")), " "))
         .withColumn("_dba", F.array_join(F.array_sort(F.array_except("_tb", "_ta")), " ")))
    d = d.withColumn("_lcs", _useful_lcs(F.col("_dab"), F.col("_dba")))
    d = d.withColumn(out, _score(F.col("_ta"), F.col("_tb"), F.col("_sect"), F.col("_dab"), F.col("_dba"),
                                 F.col("_lcs")))
    return d.drop("_ta", "_tb", "_sect", "_dab", "_dba", "_lcs")


def with_distinct_ratio(df: DataFrame, a: str, b: str, out: str = "semelhanca") -> DataFrame:
    """``with_token_set_ratio`` with each distinct pair of texts scored once.
    Scoring costs much a byte, so the pairs are dealt over all shuffle
    partitions; by their bytes they would be folded into a task or two."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct().repartition(tasks, F.xxhash64("_a", "_b"))
    scored = with_token_set_ratio(texts, "_a", "_b", out)
    return df.join(scored, F.col(a).eqNullSafe(F.col("_a")) & F.col(b).eqNullSafe(F.col("_b"))).drop("_a", "_b")


def name_similarity(a, b) -> Column:
    """Brazilian-name cleaning on both sides, then F17; 0 if either is empty."""
    return token_set_ratio(clean_br_name(a), clean_br_name(b))
