"""Connected components by alternating large-star and small-star steps.

Each step hangs every node on its smallest known neighbour with one grouped
minimum and one join, so a hub is a skewed join key that Spark can split,
never one group in one task.  Rounds are written to the shared checkpoint
folder; their number grows with the logarithm of the longest path.

Up to ``LOCAL_EDGES`` edges, counted first, one task joins them by union and
find instead; the result is the same.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import emit, rows_of, stage

LOCAL_EDGES = 100_000


def _hang(pairs: DataFrame, smaller: bool) -> DataFrame:
    """pairs (u, v): every v joins the least of u and its neighbours; large
    star keeps v > u, small star takes u > v and u joins as well."""
    if smaller:
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        joined = pairs.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _local(pairs: DataFrame) -> DataFrame:
    """(node, root) by union and find in one task."""
    kind = pairs.schema["u"].dataType
    arrow = pa.binary() if kind.simpleString() == "binary" else pa.int64()
    schema = pa.schema([("node", arrow), ("root", arrow)])

    def join(batches):
        root: dict = {}

        def find(x):
            top = x
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for u, v in rows_of(batches, "u", "v"):
            a, b = sorted((find(u), find(v)))
            root[b] = a
        yield from emit(schema, [(x, find(x)) for x in root])

    name = kind.simpleString()
    return pairs.coalesce(1).mapInArrow(join, f"node {name}, root {name}")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with an edge to another node; root is the
    least node reachable.  Null ends and loops are ignored."""
    pairs = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    if pairs.schema["u"].dataType.simpleString() in ("binary", "bigint") and pairs.count() <= LOCAL_EDGES:
        return _local(pairs)
    seen = None
    while True:
        pairs = stage(_hang(_hang(pairs, False), True), "star")
        now = tuple(pairs.agg(F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        # done: every node hangs on one root that hangs on none, or no change
        if now == seen or (now[0] == now[1] and pairs.join(pairs.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()):
            break
        seen = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
