"""Report and export sinks.

Writers take DataFrames and write them as directories (Parquet by default,
CSV on request); per-group exports use ``partitionBy`` after a repartition
on the same keys, so each group is written by the tasks that hold it —
never collected to the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coerce_date_columns(df: DataFrame) -> DataFrame:
    """Columns whose name contains ``data`` become dates (tolerant)."""
    out = df
    for f in df.schema.fields:
        if "data" in f.name.lower():
            if isinstance(f.dataType, T.StringType):
                out = out.withColumn(f.name, F.coalesce(F.try_to_date(F.col(f.name)),
                                                        F.try_to_date(F.col(f.name), "d/M/yyyy")))
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
                out = out.withColumn(f.name, F.to_date(F.col(f.name)))
    return out


def write_report_set(frames: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """One directory per named frame (the workbook's sheets)."""
    paths = {}
    for name, df in frames.items():
        path = os.path.join(root, name.replace(" ", "_"))
        w = coerce_date_columns(df).write.mode("overwrite")
        (w.option("header", True).option("sep", ";").csv(path) if fmt == "csv" else w.parquet(path))
        paths[name] = path
    return paths


def write_per_group(df: DataFrame, root: str, keys: list[str], fmt: str = "parquet") -> str:
    """One output directory per group (consultant, campaign).  Rows are
    rebalanced by group: Spark splits a large group over several tasks, which
    write several files in its directory."""
    w = df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
    (w.option("header", True).option("sep", ";").csv(root) if fmt == "csv" else w.parquet(root))
    return root


def write_csv_subset(df: DataFrame, cols: list[str], path: str, sep: str = ";") -> str:
    """A column subset as ``;``-separated CSV with a header."""
    df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path
