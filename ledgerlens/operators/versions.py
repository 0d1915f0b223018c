"""Effective-dated lookup without a range join.

A join on the key alone pairs every row with all versions of its key before
the dates are compared.  Here the versions are arranged first, so that every
join is an equi-join in which a row meets one row at most:

1. ``elementary``: the bounds of a key's versions cut its time into elementary
   intervals, numbered in order.  Each version covers a stretch of them, taken
   apart into at most two aligned power-of-two blocks a level; a block keeps
   the best version that covers it (partial ``max(struct)``), and an interval's
   best is the greatest among the blocks it lies in.  n versions make at most
   2n intervals and O(n log n) blocks, however much they overlap.
2. ``tree``: sorted arrays of ``FAN`` intervals as leaves, and arrays of the
   first instants of ``FAN`` children above them, up to one root a key.
3. ``lookup``: a row goes from the root to its leaf by one equi-join on (key,
   node) a level; in an array of ``FAN`` instants it counts those not after
   its own.  A hot key's rows are the streamed side, which AQE splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import wall_micros
from ledgerlens.operators.skew import ranked_within
from ledgerlens.session import cut_lineage

FAN = 64


@dataclass
class VersionTree:
    """``levels[0]``: leaves (keys, _node, _items: instant and best version);
    above: (keys, _node, _starts)."""
    keys: list[str]
    levels: list[DataFrame]
    payload: list[str]


def _blocks(lo: str, hi: str) -> Column:
    """The aligned blocks (level, number) that make up [lo, hi)."""
    def at(j):
        size = F.call_function("shiftleft", F.lit(1).cast("long"), j)
        left = F.floor((F.col(lo) + size - 1) / size).cast("long")
        right = F.call_function("shiftright", F.col(hi), j)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        return F.filter(F.array(
            F.when((left < right) & odd(left), F.struct(j.alias("_level"), left.alias("_block"))),
            F.when((left < right) & odd(right), F.struct(j.alias("_level"), (right - 1).alias("_block")))), lambda b: b.isNotNull())

    top = F.length(F.bin(F.col(hi)))
    return F.flatten(F.transform(F.sequence(F.lit(0), top), at))


def elementary(versions: DataFrame, keys: list[str], first: Column, last: Column, order_cols: list[str], payload: list[str],
               hot_threshold: int | None = None) -> DataFrame:
    """keys, _at (microseconds), _n, _best: for each elementary interval of a
    key, in order from 0, the greatest version by ``order_cols`` in force
    (NULL in a gap).  A version is in force from ``first`` to ``last``
    inclusive; versions without a key, or that end before they start, never."""
    held = [c for c in dict.fromkeys([*order_cols, *payload])]
    v = versions.select(*keys, wall_micros(first).alias("_lo"), (wall_micros(last) + 1).alias("_hi"), F.struct(*held).alias("_best"))
    for k in keys:
        v = v.where(F.col(k).isNotNull())
    # of versions in force at the same time only the greatest counts
    v = v.where("_lo < _hi").groupBy(*keys, "_lo", "_hi").agg(F.max("_best").alias("_best"))
    v = cut_lineage(v, "versions")
    bounds = v.select(*keys, F.col("_lo").alias("_at")).unionByName(v.select(*keys, F.col("_hi").alias("_at"))).distinct()
    more = {} if hot_threshold is None else {"hot_threshold": hot_threshold}
    ranks = ranked_within(bounds, keys, "_at", **more).select(*keys, "_at", (F.col("rn") - 1).alias("_n"))
    numbered = v.join(ranks.withColumnsRenamed({"_at": "_lo", "_n": "_from"}), [*keys, "_lo"]) \
        .join(ranks.withColumnsRenamed({"_at": "_hi", "_n": "_to"}), [*keys, "_hi"])
    # blocks and levels multiply the rows of small tables: dealt over all
    # shuffle partitions, not folded into a task by their bytes
    tasks = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = numbered.repartition(tasks, F.xxhash64(*keys, "_from", "_to"))
    parts = numbered.select(*keys, "_best", F.explode(_blocks("_from", "_to")).alias("_b"))
    blocks = parts.groupBy(*keys, F.col("_b._level").alias("_level"), F.col("_b._block").alias("_block")).agg(F.max("_best").alias("_best"))
    used = blocks.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))  # a few levels a key
    lying = ranks.join(used, keys).repartition(tasks, F.xxhash64(*keys, "_n")).select(*keys, "_at", "_n", F.explode("_levels").alias("_level"))
    lying = lying.withColumn("_block", F.expr("shiftright(_n, _level)"))
    return lying.join(blocks, [*keys, "_level", "_block"], "left").groupBy(*keys, "_n", "_at").agg(F.max("_best").alias("_best"))


def tree(intervals: DataFrame, keys: list[str], payload: list[str], fan: int = FAN) -> VersionTree:
    up = F.floor(F.col("_n") / fan).cast("long")
    leaves = cut_lineage(intervals.groupBy(*keys, up.alias("_node")).agg(F.array_sort(F.collect_list(F.struct("_at", "_best"))).alias("_items")), "leaves")
    levels, nodes = [leaves], leaves.select(*keys, F.col("_node").alias("_n"), F.col("_items")[0]["_at"].alias("_at"))
    most = leaves.agg(F.max("_node")).first()[0] or 0
    while most > 0:  # one step for each power of ``fan``
        above = nodes.groupBy(*keys, up.alias("_node")).agg(F.array_sort(F.collect_list("_at")).alias("_starts"))
        levels.append(above)
        nodes = above.select(*keys, F.col("_node").alias("_n"), F.col("_starts")[0].alias("_at"))
        most //= fan
    return VersionTree(keys, levels, payload)


def lookup(rows: DataFrame, versions: VersionTree, at: Column, fan: int = FAN) -> DataFrame:
    """``rows`` with the payload of the version in force at ``at`` (NULLs if
    there is none); every row comes out once."""
    keys = versions.keys
    out = rows.withColumn("_p", wall_micros(at)).withColumn("_node", F.lit(0).cast("long"))
    passed = lambda c, instant: F.size(F.filter(c, instant))
    for level in reversed(versions.levels[1:]):
        out = out.join(level, [*keys, "_node"], "left")
        out = out.withColumn("_k", passed("_starts", lambda x: x <= F.col("_p")))  # counted once a row
        out = out.withColumn("_node", F.when(F.col("_k") > 0, F.col("_node") * fan + F.col("_k") - 1)).drop("_starts", "_k")
    out = out.join(versions.levels[0], [*keys, "_node"], "left")
    out = out.withColumn("_k", passed("_items", lambda x: x["_at"] <= F.col("_p")))
    out = out.withColumn("_best", F.get("_items", F.col("_k") - 1)["_best"])  # NULL before the first
    return out.select(*rows.columns, *[F.col("_best")[c].alias(c) for c in versions.payload])


def version_tree(versions: DataFrame, keys: list[str], first: Column, last: Column, order_cols: list[str], payload: list[str], fan: int = FAN,
                 hot_threshold: int | None = None) -> VersionTree:
    return tree(elementary(versions, keys, first, last, order_cols, payload, hot_threshold), keys, payload, fan)
