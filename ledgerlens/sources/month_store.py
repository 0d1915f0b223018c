"""Month-sliced extraction with a high-water mark.

The store has one folder a month (``mes=yyyy-MM``).  A month that lay wholly
before the last run is closed: later runs neither read it from the source (the
filter reaches the scan) nor rewrite it.  Open months, those since the mark,
are read again and replaced whole by dynamic partition overwrite; months that
have become empty at the source are cleared.  The mark is written last, so a
lost run is done again from the same months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.ingest import _hadoop_path, _versions

FIRST = "2000-01-01"  # fixed value: where the first run begins


def high_water_mark(spark: SparkSession, root: str) -> str | None:
    """First day of the month in which the last finished run took place."""
    for v in sorted(_versions(spark, f"{root}/marks"), reverse=True):
        done, fs = _hadoop_path(spark, f"{root}/marks/version={v}/_SUCCESS")
        if fs.exists(done):
            return spark.read.schema("since string").json(f"{root}/marks/version={v}").first().since
    return None


def open_slice(source: DataFrame, date_col: str, since: str, as_of: str) -> DataFrame:
    """Rows from the month of ``since`` to the end of the month of ``as_of``,
    with their month."""
    start = F.lit(since).cast("date").cast("timestamp_ntz")
    end = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), 1).cast("timestamp_ntz")
    rows = source.filter((F.col(date_col) >= start) & (F.col(date_col) < end))
    return rows.withColumn("mes", F.date_format(date_col, "yyyy-MM"))


def _months(spark: SparkSession, root: str) -> set[str]:
    held, fs = _hadoop_path(spark, f"{root}/months")
    names = [s.getPath().getName() for s in fs.listStatus(held) if s.isDirectory()] if fs.exists(held) else []
    return {n.removeprefix("mes=") for n in names if n.startswith("mes=")}


def extract_months(source: DataFrame, date_col: str, root: str, as_of: str, first: str = FIRST) -> list[str]:
    """Bring the store up to ``as_of``; the months that were written."""
    spark, root = source.sparkSession, root.rstrip("/")
    since = high_water_mark(spark, root) or first
    rows = open_slice(source, date_col, since, as_of)
    before = _months(spark, root)
    # a month's rows are rebalanced: a large month is several files
    rows.hint("rebalance", "mes").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("mes").parquet(f"{root}/months")
    written = [r.mes for r in rows.select("mes").distinct().orderBy("mes").collect()]  # a row a month
    for month in before - set(written):
        if month >= since[:7]:
            path, fs = _hadoop_path(spark, f"{root}/months/mes={month}")
            fs.delete(path, True)
    mark = spark.createDataFrame([(as_of[:7] + "-01",)], "since string").coalesce(1)
    mark.write.json(f"{root}/marks/version={max(_versions(spark, f'{root}/marks'), default=0) + 1}")
    return written


def read_months(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame | None:
    """The stored rows; with ``months``, only their folders are read."""
    if not _months(spark, root.rstrip("/")):
        return None
    df = spark.read.parquet(f"{root.rstrip('/')}/months")
    return df if months is None else df.filter(F.col("mes").isin(months))
