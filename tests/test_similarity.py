"""Token-set ratio values worked by hand (0-100, half-to-even rounding)."""

import random

from pyspark.sql import functions as F

from ledgerlens.functions.similarity import lcs_length, name_similarity, token_set_ratio


def brute_lcs(a, b):
    row = [0] * (len(a) + 1)
    for ch in b:
        last = row[:]
        for k, c in enumerate(a):
            row[k + 1] = last[k] + 1 if c == ch else max(row[k], last[k + 1])
    return row[-1]


def test_lcs(spark):
    rnd = random.Random(2)
    text = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    pairs = [("abcde", "ace"), ("", "abc"), ("abc", ""), ("silva", "silveira"), ("a" * 62, "a" * 62), ("a" * 63, "a" * 70), ("x" * 200, "y" * 200),
             ("é😀b", "😀é b"), ("b" * 130, "ab" * 100)]
    pairs += [(text(rnd.randint(0, n), s), text(rnd.randint(0, n), s)) for n in (5, 40, 70, 200) for s in ("ab", "abcdefgh ", "aé😀z") for _ in range(6)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(lcs_length(F.col("a"), F.col("b"))).collect()]
    assert got == [brute_lcs(a, b) for a, b in pairs]


def test_no_python_in_the_plan(spark):
    from ledgerlens.functions.similarity import with_distinct_ratio
    df = spark.createDataFrame([("José da Silva", "JOSE SILVA"), (None, "x"), (None, "x"), ("a", None)], "a string, b string")
    out = with_distinct_ratio(df, "a", "b", "s")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert sorted((r.a or "", r.s) for r in out.collect()) == [("", 0), ("", 0), ("José da Silva", 100), ("a", 0)]


def test_token_set_ratio(spark):
    pairs = [("joao silva", "silva joao"), ("joao silva", "joao"), ("", "joao"), ("ana", "bia"),
             ("joao pedro silva", "joao paulo silva"), ("abc", "abd")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(token_set_ratio(F.col("a"), F.col("b"))).collect()]
    # reordered -> 100; subset -> 100; empty -> 0; "ana"/"bia": lcs 1 -> 100-100*4/6 = 33.3 -> 33
    # "joao pedro silva"/"joao paulo silva": sect "joao silva"(10), diffs pedro/paulo, lcs = 2 ("po")
    #   dist = 5+5-4 = 6, sect_ab = 10+1+5 = 16 -> diff ratio 100-100*6/32 = 81.25; ab ratio 76.9 -> 81
    # "abc"/"abd": lcs 2, dist 2, total 6 -> 66.7 -> 67
    assert got == [100, 100, 0, 33, 81, 67]


def test_name_similarity_cleans(spark):
    df = spark.createDataFrame([("José da Silva", "JOSE SILVA")], "a string, b string")
    assert df.select(name_similarity(F.col("a"), F.col("b"))).first()[0] == 100


def test_staged_form_matches_expression(spark):
    from ledgerlens.functions.similarity import with_token_set_ratio
    pairs = [("José da Silva", "JOSE SILVA"), ("Maria Souza", "Ana Souza"), (None, "x"), ("CONVENIO BRAND#3", "CONVENIO BRAND#17")]
    df = spark.createDataFrame(pairs, "a string, b string")
    staged = [r.s for r in with_token_set_ratio(df, "a", "b", "s").collect()]
    expr = [r[0] for r in df.select(name_similarity(F.col("a"), F.col("b"))).collect()]
    assert staged == expr


def test_distinct_pairs_are_scored_by_many_tasks(spark):
    """Scoring is dear a byte: small text tables are not folded into one task."""
    from pyspark.sql import functions as F
    from ledgerlens.functions.similarity import with_distinct_ratio
    df = spark.createDataFrame([(f"ana {i}", f"{i} silva") for i in range(200)], "a string, b string")
    plan = with_distinct_ratio(df, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert with_distinct_ratio(df, "a", "b").where(F.col("semelhanca") > 0).count() == 200
