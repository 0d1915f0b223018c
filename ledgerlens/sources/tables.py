"""Driver-table access (S1): one lazy parquet scan per table.

Catalyst prunes columns and pushes filters into the scan, so callers select
what they need and filter early; nothing is read eagerly here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
