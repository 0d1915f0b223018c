"""Incremental jobs on Structured Streaming.

The reference polls a folder every 15 minutes and deletes what it loaded;
here a file-source stream with ``trigger(availableNow=True)`` processes
exactly the files not yet seen (the checkpoint replaces deletion) and each
micro-batch goes through ``foreachBatch`` into the append-only sink.  A
replayed batch (driver lost after the write, checkpoint not yet committed)
inserts nothing twice: rows are keyed by their SHA-256 hash and commits by the
stream's batch number.

The checkpoint location lives under the shared ``spark.checkpoint.dir`` the
cluster names, never a machine-local folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.dates import ts_ntz
from ledgerlens.operators import leads as L
from ledgerlens.session import cut_lineage, ensure_checkpoint_dir
from ledgerlens.sources import append_table as AT


def _checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "streams", name)


def ingest_folder(spark: SparkSession, source_dir: str, schema: str, target_root: str, as_of: str,
                  fmt: str = "parquet", name: str = "ingest", options: dict | None = None,
                  checkpoint_location: str | None = None) -> None:
    """Ingest every new file of ``source_dir`` into the append-only table
    at ``target_root`` (K1 semantics per micro-batch), then stop.  A batch
    writes its own rows; a batch of this stream that is committed already
    (replay after a lost driver) is skipped."""
    location = checkpoint_location or _checkpoint_location(spark, name)
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        AT.insert(spark, target_root, batch, as_of, f"{location}#{epoch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", location)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ------------------------------------------------------------------ classification

WINDOW_DAYS = 15   # of arrivals that are classified
BUCKETS = 64       # of phones


def _phones(leads: DataFrame) -> DataFrame:
    """Arrivals a phone and instant: what the history windows need of them."""
    counted = leads.filter(F.col("telefone").isNotNull()).groupBy("telefone", F.col("data_chegada").alias("instante")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("balde", F.pmod(F.xxhash64("telefone"), F.lit(BUCKETS)).cast("int"))


def _history(phones: DataFrame, as_of) -> DataFrame:
    """A5 from counted instants; a NULL instant is older than all windows."""
    t = ts_ntz(as_of)
    since = lambda length: F.coalesce(F.sum(F.when(F.col("instante") >= t - F.expr(f"INTERVAL {length}"), F.col("n"))), F.lit(0)).cast("long")
    return phones.groupBy("telefone").agg(F.sum("n").cast("long").alias("qtd_total_historico"), since("3 MONTHS").alias("qtd_3_meses"),
                                          since("1 YEAR").alias("qtd_1_ano"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= AT.MOST_BROADCAST else df


def classify_batch(spark: SparkSession, root: str, arrivals: DataFrame, enrichment, as_of, batch: str, before_commit=None) -> int | None:
    """Classify the leads that a batch touches: its own, and those of the last
    ``WINDOW_DAYS`` days that share a phone with it, whose counts it changes.

    State under ``root``, appended by batch: ``phones`` (counted instants by
    bucket of the phone), ``leads`` (rows of the window by day) and ``classes``
    (results).  A batch reads the touched phones' counts in their buckets and
    the window's days; no arrival is counted again.  A batch that is committed
    already is skipped, and one lost before its commit does not exist."""
    root = root.rstrip("/")
    if batch in {r.batch for r in AT._committed(spark, root)}:
        return None
    old = [c.epoch for c in AT.commits(spark, root)]
    epoch = max((n for part in ("phones", "leads", "classes", "commits") for n in AT._epochs(spark, f"{root}/{part}")), default=0) + 1
    new = cut_lineage(arrivals, "arrivals")
    _phones(new).repartition("balde").write.partitionBy("balde").parquet(f"{root}/phones/epoch={epoch}")
    since = ts_ntz(as_of) - F.expr(f"INTERVAL {WINDOW_DAYS} DAYS")
    window = new.filter(F.col("data_chegada") >= since)
    window.withColumn("dia", F.date_format("data_chegada", "yyyy-MM-dd")).hint("rebalance", "dia").write.partitionBy("dia").parquet(f"{root}/leads/epoch={epoch}")

    touched = cut_lineage(_phones(new).select("telefone", "balde").distinct(), "touched")
    if touched.isEmpty():
        history, again = None, None
    else:
        buckets = [r.balde for r in touched.select("balde").distinct().collect()]  # 64 at most
        few = _few(touched.select("telefone"))
        counted = AT._part(spark, root, "phones", [*old, epoch]).filter(F.col("balde").isin(buckets))
        history = _history(counted.join(few, "telefone", "left_semi"), as_of)
        held = AT._part(spark, root, "leads", old)
        # a cast of the folder name would keep Spark from pruning the days
        again = None if held is None else held.filter(F.col("dia").cast("string") >= F.date_format(since, "yyyy-MM-dd")).filter(F.col("data_chegada") >= since) \
            .join(few, "telefone", "left_semi").select(*new.columns)
    leads = window if again is None else window.unionByName(again)
    history = _history(_phones(new), as_of) if history is None else history
    enrichment = enrichment() if callable(enrichment) else enrichment
    classified = L.classify(L.classification_input(leads, enrichment, as_of, WINDOW_DAYS, history), as_of)
    classified.select("id", "desclassificado", "prioridade", "tipo_lead", "elegivel", "classificacao_ticket", "estado", "qtd_3_meses") \
        .write.parquet(f"{root}/classes/epoch={epoch}")
    if before_commit is not None:
        before_commit()
    AT._commit(spark, root, epoch, batch, str(as_of), [])
    return epoch


def read_classes(spark: SparkSession, root: str) -> DataFrame | None:
    """Each lead's newest classification, with its first priority (K7)."""
    rows = AT._part(spark, root.rstrip("/"), "classes", [c.epoch for c in AT.commits(spark, root.rstrip("/"))])
    if rows is None:
        return None
    held = [c for c in rows.columns if c not in ("id", "epoch")]
    last = rows.groupBy("id").agg(F.max(F.struct("epoch", *held)).alias("_l"), F.min(F.struct("epoch", "prioridade")).alias("_f"))
    return last.select("id", *[F.col("_l")[c].alias(c) for c in held], F.col("_f.prioridade").alias("primeira_prioridade"))


def compact_classes(spark: SparkSession, root: str, as_of) -> int | None:
    """Fold the state: arrivals older than a year keep their number alone,
    leads older than the window go, every lead keeps its first and its newest
    result."""
    root = root.rstrip("/")
    done = AT.commits(spark, root)
    if len(done) < 2:
        return None
    old = [c.epoch for c in done]
    epoch = max(n for part in ("phones", "leads", "classes", "commits") for n in AT._epochs(spark, f"{root}/{part}")) + 1
    t = ts_ntz(as_of)
    kept = F.when(F.col("instante") >= t - F.expr("INTERVAL 1 YEAR"), F.col("instante"))
    phones = AT._part(spark, root, "phones", old).groupBy("balde", "telefone", kept.alias("instante")).agg(F.sum("n").alias("n"))
    phones.repartition("balde").write.partitionBy("balde").parquet(f"{root}/phones/epoch={epoch}")
    leads = AT._part(spark, root, "leads", old)
    if leads is not None:
        leads.drop("epoch").filter(F.col("data_chegada") >= t - F.expr(f"INTERVAL {WINDOW_DAYS} DAYS")).hint("rebalance", "dia") \
            .write.partitionBy("dia").parquet(f"{root}/leads/epoch={epoch}")
    classes = read_classes(spark, root)
    now = classes.drop("primeira_prioridade")
    # the older of two rows of one lead carries its first priority
    first = classes.select(*[F.col("primeira_prioridade").alias(c) if c == "prioridade" else F.col(c) for c in now.columns])
    first.write.parquet(f"{root}/classes/epoch={epoch}")
    now.write.parquet(f"{root}/classes/epoch={epoch + 1}")
    AT._commit(spark, root, epoch, f"compact-{epoch}", done[-1].as_of, old)
    AT._commit(spark, root, epoch + 1, f"compact-{epoch + 1}", done[-1].as_of, [])
    return epoch + 1


def classify_arrivals(spark: SparkSession, arrivals_dir: str, schema, enrichment, root: str, as_of, name: str = "classify",
                      checkpoint_location: str | None = None) -> None:
    """R2: every new file of lead rows is classified with what it touches
    (``classify_batch``), then stop.  ``enrichment`` is a table, or a function
    that reads it in every batch."""
    location = checkpoint_location or _checkpoint_location(spark, name)
    stream = spark.readStream.format("parquet").schema(schema).load(arrivals_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        classify_batch(spark, root, batch, enrichment, as_of, f"{location}#{epoch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
