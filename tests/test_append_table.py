import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.session import cut_lineage, ensure_checkpoint_dir
from ledgerlens.sources import append_table as AT
from ledgerlens.sources import ingest as IG


def files(root, part="rows"):
    return {os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, part)) for f in names if f.startswith("part-")}


def rows(spark, lo, hi, extra=False):
    df = spark.range(lo, hi).select(F.col("id").alias("Código"), F.concat(F.lit("name "), F.col("id") % 7).alias("Nome"))
    return df.withColumn("Novo Campo", F.lit("x")) if extra else df


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda r: tuple(str(r[c]) for c in cols)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_equals_the_whole_table_insert(spark, tmp_path):
    root = str(tmp_path / "t")
    batches = [(rows(spark, 0, 500), "2024-01-01"), (rows(spark, 400, 600).unionByName(rows(spark, 400, 600)), "2024-01-02"),
               (rows(spark, 0, 3, extra=True), "2024-01-03"), (rows(spark, 450, 460), "2024-01-04"), (rows(spark, 0, 0), "2024-01-05")]
    want = None
    for k, (df, day) in enumerate(batches):
        before, touched = files(root), files(root, "touched")
        assert AT.insert(spark, root, df, day, f"b{k}") == k + 1
        after = files(root)
        assert before <= after and touched <= files(root, "touched")  # nothing is written again
        new = spark.read.parquet(*(after - before)).count() if after - before else 0
        assert new == [500, 100, 3, 0, 0][k]
        want = IG.idempotent_insert(want, df, day)
        same(AT.read(spark, root), want.select(*AT.read(spark, root).columns))
    assert AT.compact(spark, root) == 6 and len(AT.commits(spark, root)) == 1
    same(AT.read(spark, root), want.select(*AT.read(spark, root).columns))
    assert AT.insert(spark, root, rows(spark, 0, 500), "2024-01-09", "b1") is None  # known batch ids survive
    AT.insert(spark, root, rows(spark, 590, 610), "2024-02-01", "b9")
    same(AT.read(spark, root), IG.idempotent_insert(want, rows(spark, 590, 610), "2024-02-01").select(*AT.read(spark, root).columns))


def test_lost_between_write_and_commit(spark, tmp_path):
    root = str(tmp_path / "t")
    AT.insert(spark, root, rows(spark, 0, 50), "2024-01-01", "a")

    def lost():
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError, match="driver lost"):
        AT.insert(spark, root, rows(spark, 40, 90), "2024-01-02", "b", before_commit=lost)
    first = AT.read(spark, root)
    assert first.count() == 50 and first.where("verificacao_hash is not null").count() == 0
    for _ in range(2):  # the retry, and a replay of it
        AT.insert(spark, root, rows(spark, 40, 90), "2024-01-02", "b")
        got = AT.read(spark, root)
        assert got.count() == got.select("row_hash").distinct().count() == 90 and got.where("verificacao_hash is not null").count() == 10


def test_new_rows_need_no_look_at_old_ones(spark, tmp_path):
    """The filters alone tell that most keys are new."""
    new = AT._hashed(rows(spark, 0, 4000), False).select("prefix", "row_hash")
    filters = AT.bloom_filters(new)
    assert new.join(filters, "prefix").where(AT._maybe(F.col("words"))).count() == 4000
    other = AT._hashed(rows(spark, 10_000, 30_000), False).select("prefix", "row_hash")
    assert other.join(filters, "prefix").where(AT._maybe(F.col("words"))).count() < 200


def test_a_batch_like_the_table_is_written_once(spark, tmp_path):
    """Known rows are told from new ones where the batch is dealt: no copy of
    it is staged; later batches read a table whose touched rows lie either
    way."""
    root, tables = str(tmp_path / "t"), os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    staged = lambda: set(os.listdir(tables)) if os.path.isdir(tables) else set()
    batches = [(rows(spark, 0, 300), "2024-01-01"), (rows(spark, 200, 700).unionByName(rows(spark, 250, 400)), "2024-01-02"),
               (rows(spark, 600, 800, extra=True).unionByName(rows(spark, 0, 0, extra=True)), "2024-01-03"), (rows(spark, 0, 700), "2024-01-04")]
    want = None
    for k, (df, day) in enumerate(batches):
        before = staged()
        AT.insert(spark, root, df, day, f"b{k}")
        assert staged() == before
        want = IG.idempotent_insert(want, df, day)
        same(AT.read(spark, root), want.select(*AT.read(spark, root).columns))
    assert not os.listdir(os.path.join(root, "staged"))
    for k, df in enumerate((rows(spark, 690, 710), rows(spark, 5, 6)), start=len(batches)):  # small ones ask the filters
        AT.insert(spark, root, df, f"2024-02-0{k}", f"b{k}")
        want = IG.idempotent_insert(want, df, f"2024-02-0{k}")
        same(AT.read(spark, root), want.select(*AT.read(spark, root).columns))


def test_files_of_finished_shuffles_go(spark, monkeypatch):
    monkeypatch.setattr(session, "RELEASE_BYTES", 0)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in disk.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}
    before = shuffles()
    cut_lineage(spark.range(5000).withColumn("k", F.col("id") % 100).repartition(7, "k"), "released")
    for _ in range(100):
        if shuffles() <= before:
            return
        time.sleep(0.1)
    raise AssertionError(f"{len(shuffles() - before)} files are left")
