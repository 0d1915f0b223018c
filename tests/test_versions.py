import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import versions as V

DAY = dt.date(2020, 1, 1)


def brute(rows, versions):
    out = []
    for rid, k, d in rows:
        best = None
        for key, a, b, prio, value in versions:
            if key is not None and key == k and d is not None and a <= d <= b and (best is None or (prio, value) > best):
                best = (prio, value)
        out.append((rid, k, d, best and best[1]))
    return out


def looked_up(spark, rows, versions, **how):
    r = spark.createDataFrame(rows, "rid int, k string, d date").repartition(4)
    v = spark.createDataFrame(versions, "k string, a date, b date, prio int, value int").repartition(4)
    tree = V.version_tree(v, ["k"], F.col("a"), F.col("b"), ["prio", "value"], ["value"], **how)
    for level in tree.levels:  # a row meets one node at most
        assert level.groupBy("k", "_node").count().where("count > 1").isEmpty()
    fan = how.get("fan", V.FAN)
    assert (tree.levels[0].agg(F.max(F.size("_items"))).first()[0] or 0) <= fan
    return tree, [tuple(x) for x in V.lookup(r, tree, F.col("d"), fan).collect()]


@pytest.mark.parametrize("how", [{}, {"fan": 3}, {"fan": 4, "hot_threshold": 20}])
def test_overlaps_gaps_and_nulls(spark, how):
    rnd = random.Random(5)
    day = lambda n: DAY + dt.timedelta(n)
    versions = []
    for k in range(150):
        a = rnd.randint(0, 60)
        versions.append((rnd.choice(["x", "y", "z", None]), day(a), day(a + rnd.randint(-2, 25)), rnd.randint(0, 9), k))
    versions += [("x", day(3), day(9), 5, 999), ("x", day(3), day(9), 5, 999)]
    rows = [(k, rnd.choice(["x", "y", "z", "w", None]), rnd.choice([None, *map(day, range(-3, 95))])) for k in range(400)]
    rows += [(7, "x", day(4)), (7, "x", day(4))]  # repeated rows come out twice
    _, got = looked_up(spark, rows, versions, **how)
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows, versions)))


def test_ten_thousand_versions_of_one_key(spark):
    rnd = random.Random(6)
    versions = []
    for k in range(10_000):
        a = rnd.randint(0, 9000)
        versions.append(("hot", DAY + dt.timedelta(a), DAY + dt.timedelta(a + rnd.choice([0, 3, 40, 8000])), rnd.randint(0, 10**6), k))
    rows = [(k, "hot", DAY + dt.timedelta(rnd.randint(0, 9500))) for k in range(300)]
    tree, got = looked_up(spark, rows, versions)
    assert len(tree.levels) == 3 and sorted(got) == sorted(brute(rows, versions))


def test_no_versions(spark):
    _, got = looked_up(spark, [(1, "x", DAY)], [])
    assert got == [(1, "x", DAY, None)]


def test_instants(spark):
    """Both ends belong to a version; a later instant of its last day does not."""
    v = spark.sql("SELECT 'x' AS k, DATE'2024-01-01' AS a, DATE'2024-01-31' AS b, 1 AS value")
    r = spark.sql("SELECT 'x' AS k, explode(array(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-31 00:00:00', TIMESTAMP_NTZ'2024-01-31 00:00:00.000001')) AS t")
    tree = V.version_tree(v, ["k"], F.col("a"), F.col("b"), ["value"], ["value"])
    assert [x.value for x in V.lookup(r, tree, F.col("t")).orderBy("t").collect()] == [1, 1, None]


def test_blocks_are_dealt_over_all_partitions(spark):
    """Small version tables multiply into many blocks: not in one task."""
    from ledgerlens.operators.versions import elementary
    v = spark.createDataFrame([(1, i, i + 5, i) for i in range(50)], "k int, a int, b int, w int")
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c))
    out = elementary(v, ["k"], day("a"), day("b"), ["w"], ["w"])
    assert out._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2
    assert {r._best.w for r in out.collect() if r._best} == set(range(50))


def test_versions_in_force_at_the_same_time_count_once(spark, monkeypatch):
    from ledgerlens.operators import versions as V
    held, cut = [], V.cut_lineage
    monkeypatch.setattr(V, "cut_lineage", lambda df, name: held.append((name, cut(df, name))) or held[-1][1])
    v = spark.createDataFrame([("k", "2024-01-01", "2024-02-01", w) for w in range(50)], "k string, a string, b string, w int")
    out = V.elementary(v, ["k"], F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"), ["w"], ["w"]).collect()
    assert held[0][1].count() == 1 and sorted(r._n for r in out) == [0, 1]
    assert [r._best.w for r in out if r._n == 0] == [49]
