"""Upserts and keyed updates on plain DataFrames.

One helper, ``merge``, covers the reference's UPDATE/INSERT variants with
per-column rules; it is a left join of the target to the (key-unique)
updates plus, for upserts, the unmatched updates.  Updates are made unique
per key first with a partial ``max(struct)`` aggregate (never a window over
a possibly hot key).  The result is the next version of the table; writing
it is the caller's job (``ingest.write_version``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.skew import latest_per_key

OVERWRITE = "overwrite"          # K9: new value
KEEP_OLD_IF_NEW_NULL = "coalesce_new"  # K8: coalesce(new, old)
FIRST_WRITE_WINS = "coalesce_old"      # K7/K10: coalesce(old, new)
INCREMENT = "increment"          # K6: old + 1 (NULL stays NULL)


def _rule(rule, old: Column, new: Column) -> Column:
    if isinstance(rule, Column):  # K5: constant / expression
        return rule
    if rule == OVERWRITE:
        return new
    if rule == KEEP_OLD_IF_NEW_NULL:
        return F.coalesce(new, old)
    if rule == FIRST_WRITE_WINS:
        return F.coalesce(old, new)
    if rule == INCREMENT:
        return old + F.lit(1)
    raise ValueError(f"unknown rule {rule!r}")


def unique_updates(updates: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """K3: last duplicate per key wins, by ``order_cols`` (max struct)."""
    payload = [c for c in updates.columns if c not in keys]
    return latest_per_key(updates, keys, order_cols, payload)


def merge(target: DataFrame, updates: DataFrame, keys: list[str], rules: dict, guard: Column | None = None,
          insert_missing: bool = False, order_cols: list[str] | None = None) -> DataFrame:
    """Apply ``rules`` {column: rule} to target rows matched by
    ``keys`` (and satisfying ``guard`` on the target's columns); optionally
    insert updates with no matching target row (upsert, K3/K10).

    Of several updates with one key the greatest by ``order_cols`` counts (by
    default all other columns, in their order), so a repeated key never
    repeats a target row."""
    rest = [c for c in updates.columns if c not in keys]
    if rest:
        updates = unique_updates(updates, keys, order_cols or rest).select(*updates.columns)
    else:
        updates = updates.distinct()
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in keys])
    u = u.withColumn("_matched", F.lit(True))
    j = target.join(u, keys, "left")
    hit = F.coalesce(F.col("_matched"), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    out = j
    for c, rule in rules.items():
        new = F.col(f"_new_{c}") if f"_new_{c}" in j.columns else F.lit(None)
        old = F.col(c) if c in target.columns else F.lit(None)
        out = out.withColumn(c, F.when(hit, _rule(rule, old, new)).otherwise(old))
    out = out.select(*target.columns, *[c for c in rules if c not in target.columns])
    if insert_missing:
        new_rows = updates.join(target.select(*keys), keys, "left_anti")
        out = out.unionByName(new_rows, allowMissingColumns=True)
    return out


def replace_by_key(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Delete-then-insert by (key, type)."""
    return target.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def release_stale(target: DataFrame, stale: DataFrame, keys: list[str], reset_cols: list[str]) -> DataFrame:
    """Reset columns to NULL for stale rows (matched by ``keys``)."""
    flag = stale.select(*keys).distinct().withColumn("_stale", F.lit(True))
    j = target.join(flag, keys, "left")
    for c in reset_cols:
        j = j.withColumn(c, F.when(F.col("_stale"), F.lit(None).cast(target.schema[c].dataType)).otherwise(F.col(c)))
    return j.drop("_stale")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """K4: INSERT IGNORE — new keys only, one row per key (a deterministic
    pick: the greatest row, as a partial aggregate)."""
    payload = [c for c in rows.columns if c not in keys]
    fresh = latest_per_key(rows, keys, payload, payload) if payload else rows.distinct()
    fresh = fresh.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)
