"""SparkSession construction and cluster-facing settings.

Operators never create sessions; they receive DataFrames.  This module is
for entry points (bench, tests, CLI) and for the one cluster setting the
library reads: ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins and coalesces shuffle
# partitions from runtime statistics; skew-join splits hot partitions; the
# session time zone is pinned so LTZ arithmetic is reproducible (all driver
# tables are TIMESTAMP_NTZ, so most plans do not depend on it at all).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
}


# Of tables that the library writes for itself: two thirds of the default's bytes.
CODEC = "zstd"
# A table of so many bytes is worth a collection of the driver's garbage.
RELEASE_BYTES = 16 << 20


def _default_driver_memory() -> str:
    """Half of physical memory (local mode: the driver JVM is the executor),
    capped at 16g; the bench machine has 7 GB."""
    try:
        with open("/proc/meminfo") as fh:
            kb = int(next(line for line in fh if line.startswith("MemTotal")).split()[1])
        return f"{max(1, min(16, kb // (1024 * 1024) // 2))}g"
    except (OSError, StopIteration, ValueError):
        return "2g"


def build_session(master: str | None = None, cpus: int | None = None,
                  shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlens",
                  extra: dict | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("LEDGERLENS_DRIVER_MEMORY", _default_driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset in local mode (tests) do we create a
    scratch folder of our own; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            # a folder of our own choice may be one machine's alone
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")  # tests: one machine
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a fresh scan of it.

    One computation of the plan (``Dataset.checkpoint`` on an unpersisted
    plan computes it twice), columnar and compressed on disk, and it
    survives executor loss: the data lives in the shared folder, not in
    executor block managers.  Later scans get column pruning and filter
    pushdown like any Parquet table.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    release_shuffles(spark, path)
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession, path: str) -> None:
    """Have the files of shuffles that nothing refers to any more deleted, once
    a table of ``RELEASE_BYTES`` is written to ``path``.  Spark does so when the
    driver's garbage is collected, which may be long after: until then each
    step's files lie beside those of the steps before."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(p).getLength() >= RELEASE_BYTES:
        gc.collect()  # references that Python holds to JVM objects
        sc._jvm.System.gc()
