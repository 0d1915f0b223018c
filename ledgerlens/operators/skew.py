"""Skew-safe ranking primitives.

A plain ``row_number().over(partitionBy(k))`` sends every row of a key to one
task; if one key holds a third of the data, one task holds a third of the
data.  These helpers split hot keys over salt buckets and stitch the ranks
back together from per-bucket counts, so no task ever holds more than
``1/buckets`` of a hot key.  The salt is a deterministic function of a
numeric id (``pmod(id, buckets)``), so results are reproducible and can be
restated in plain SQL.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 64
# Rows that one bucket of a hot key or of a global rank holds, about; the
# number of buckets follows from it and the row count.
BUCKET_ROWS = 100_000
# Keys with more rows than this are split over buckets.  The set of hot
# keys is therefore at most (rows / HOT_THRESHOLD) long: a proven bound.
DEFAULT_HOT_THRESHOLD = 200_000
# Hash buckets that rows are counted by before their keys are.
HOT_BUCKETS = 1 << 14
# Largest hot-key list (rows) shipped to every executor as a broadcast.
DEFAULT_BROADCAST_MAX = 100_000


def hot_keys(df: DataFrame, keys: list[str], hot_threshold: int = DEFAULT_HOT_THRESHOLD):
    """Keys with more than ``hot_threshold`` rows (an exact count) and how
    many there are.

    A key's rows share a hash bucket, so rows are counted by bucket first (a
    shuffle of ``HOT_BUCKETS`` rows a task at most) and by key only in buckets
    that hold more than ``hot_threshold`` rows: in most tables, none."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS))
    crowded = [r["_b"] for r in df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_kn"))
               .filter(F.col("_kn") > hot_threshold).select("_b").collect()]  # HOT_BUCKETS rows at most
    if not crowded:
        return df.select(*keys).limit(0), 0
    hot = (df.filter(bucket.isin(crowded)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn"))
           .filter(F.col("_kn") > hot_threshold).select(*keys))
    return hot, hot.count()


def crowded_keys(df: DataFrame, key_sets: list[list[str]], hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> set[int]:
    """The places in ``key_sets`` of those that may have hot keys among rows
    that lack none of the set's columns: one pass over ``df`` for all sets.
    The others have none, nor has any part of ``df``."""
    full = [reduce(Column.__and__, [F.col(k).isNotNull() for k in ks]) for ks in key_sets]
    buckets = F.array(*[F.when(there, F.struct(F.lit(i).alias("i"), F.pmod(F.xxhash64(*ks), F.lit(HOT_BUCKETS)).alias("b")))
                        for i, (ks, there) in enumerate(zip(key_sets, full))])
    counts = df.select(F.explode(buckets).alias("_s")).groupBy("_s.i", "_s.b").agg(F.count(F.lit(1)).alias("_kn"))
    return {r.i for r in counts.filter(F.col("i").isNotNull() & (F.col("_kn") > hot_threshold)).select("i").distinct().collect()}


def ranked_within(df: DataFrame, keys: list[str], order_col: str,
                  out: str = "rn", buckets: int | None = None,
                  hot_threshold: int = DEFAULT_HOT_THRESHOLD,
                  broadcast_max: int = DEFAULT_BROADCAST_MAX, hot=None) -> DataFrame:
    """Dense rank 1..n of rows within ``keys``: ``row_number`` by
    ``order_col`` (unique within a key), whatever the size of a key.

    Hot keys (more than ``hot_threshold`` rows) are found exactly with a
    partial-aggregate count.  With none, this is a plain window (no key is
    big enough to skew a task).  Otherwise a hot key is cut into ranges of
    ``order_col`` at its own approximate quantiles (a mergeable partial
    aggregate; they decide only how even the ranges are).  Ranges are ranked
    in parallel, by an explicit repartition on (keys, range), since Catalyst
    would otherwise reuse the partitioning on the keys alone, and offset by
    the exact sizes of the ranges before them.  ``buckets`` defaults to one
    range per ``BUCKET_ROWS`` rows.  The hot-key list is broadcast only when
    its measured size is at most ``broadcast_max`` rows (it is also bounded by
    rows / hot_threshold).  ``hot`` may pass a precomputed ``hot_keys`` result
    (e.g. measured once on a superset of ``df``: a key hot in a subset is hot
    in the superset).
    """
    hot, n_hot = hot if hot is not None else hot_keys(df, keys, hot_threshold)
    if n_hot == 0:
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    hot = F.broadcast(hot) if n_hot <= broadcast_max else hot
    rows = df.join(hot, keys, "left_semi")
    n = buckets or max(2, min(10_000, -(-rows.count() // BUCKET_ROWS)))
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(F.col(order_col), [k / n for k in range(1, n)], 100 * n).alias("_cuts"))
    cuts = F.broadcast(cuts) if n_hot * n <= broadcast_max else cuts
    flagged = df.join(cuts, keys, "left")
    # the range: how many cuts lie below the row (0 for other keys)
    flagged = flagged.withColumn("_salt", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(order_col))), F.lit(0))) \
        .withColumn("_salt", F.greatest("_salt", F.lit(0))).withColumn("_hot", F.col("_cuts").isNotNull()).drop("_cuts")
    flagged = flagged.repartition(*[F.col(k) for k in keys], F.col("_salt"))
    w = Window.partitionBy(*keys, "_salt").orderBy(F.col(order_col).asc())
    local = flagged.withColumn("_rn_local", F.row_number().over(w))
    # offsets only for hot keys: at most ``n`` rows per hot key
    hot_counts = (flagged.filter(F.col("_hot"))
                  .groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_bn")))
    wo = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hot_counts.withColumn("_off", F.coalesce(F.sum("_bn").over(wo), F.lit(0))).drop("_bn")
    if n_hot * n <= broadcast_max:
        offsets = F.broadcast(offsets)
    ranked = local.join(offsets, [*keys, "_salt"], "left")
    return (ranked.withColumn(out, (F.col("_rn_local") + F.coalesce(F.col("_off"), F.lit(0))).cast("long"))
            .drop("_rn_local", "_off", "_salt", "_hot"))


def global_rank(df: DataFrame, order_col: str, out: str = "rn", buckets: int = DEFAULT_BUCKETS,
                salt: Column | None = None) -> DataFrame:
    """Rank 1..N by ``order_col`` (unique) without a single-partition window.

    Rows are ranked inside ranges of ``order_col``, then offset by the sizes
    of the ranges before them (a table with one row per range).  The ranges
    end at the column's approximate quantiles, unless ``salt`` gives each
    row's range, in order: a prefix of a uniform text key, say.  The rank is
    the exact global order either way."""
    if salt is None:
        # a few dozen values; a lambda over a scalar subquery here would stray
        # into the filters that Catalyst infers for the join below
        cuts = df.agg(F.percentile_approx(order_col, [k / buckets for k in range(1, buckets)], 100 * buckets)).first()[0] or []
        d = df.withColumn("_salt", reduce(add, [(F.col(order_col) > F.lit(c)).cast("int") for c in sorted(set(cuts))], F.lit(0)))
    else:
        d = df.withColumn("_salt", salt)
    w = Window.partitionBy("_salt").orderBy(F.col(order_col).asc())
    local = d.withColumn("_rn_local", F.row_number().over(w))
    counts = d.groupBy("_salt").agg(F.count(F.lit(1)).alias("_bn"))
    # a row a range: the unpartitioned window here is over a bounded table
    wo = Window.orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(wo), F.lit(0))).drop("_bn")
    out_df = local.join(F.broadcast(offsets), "_salt")
    return (out_df.withColumn(out, (F.col("_rn_local") + F.col("_off")).cast("long"))
            .drop("_rn_local", "_off", "_salt"))


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int,
                  salt_source: str, out: str = "rn", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Top-k rows per key in two phases: top-k per (key, salt), then top-k
    per key over at most ``k * buckets`` survivors — a hot key never lands
    whole in one task.  ``order`` must be a total order (end with an id)."""
    salted = df.withColumn("_salt", F.pmod(F.col(salt_source), F.lit(buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    survivors = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (survivors.drop("_r1", "_salt")
            .withColumn(out, F.row_number().over(w2)).filter(F.col(out) <= k))


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str], payload: list[str],
                   prefix: str = "") -> DataFrame:
    """Top-1 row per key as a partial aggregate (``max`` of a struct whose
    leading fields are the order columns).  Map-side combine means a hot key
    costs one row per map task in the shuffle, never a whole group."""
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)] + [F.col(c) for c in payload]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_top"))
    return agg.select(*keys, *[F.col(f"_top.{c}").alias(prefix + c) for c in payload])
