import os

from pyspark.sql import functions as F

from ledgerlens.sources import month_store as MS


def frame(spark, days):
    return spark.createDataFrame([(k, d) for k, d in enumerate(days)], "id long, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root / "months") for f in names if f.startswith("part-")}


def test_only_open_months_are_read_and_written(spark, tmp_path):
    root = str(tmp_path)
    days = ["1999-05-01", "2024-01-10", "2024-02-29", "2024-03-05 10:00:00", "2024-03-31 23:59:59", "2024-04-01"]
    assert MS.extract_months(frame(spark, days), "d", root, "2024-03-15") == ["2024-01", "2024-02", "2024-03"]
    assert MS.high_water_mark(spark, root) == "2024-03-01"
    before = files(tmp_path)
    # January and February changed at the source, but are closed; March loses a row; May stays empty
    later = ["2024-01-10", "2024-01-11", "2024-03-05 10:00:00", "2024-04-01", "2024-04-02"]
    assert MS.extract_months(frame(spark, later), "d", root, "2024-05-02") == ["2024-03", "2024-04"]
    after = files(tmp_path)
    closed = {f for f in before if "mes=2024-03" not in f}
    assert len(closed) == 2 and all(before[f] == after[f] for f in closed)
    got = sorted((r.mes, str(r.d)) for r in MS.read_months(spark, root).collect())
    assert got == [("2024-01", "2024-01-10 00:00:00"), ("2024-02", "2024-02-29 00:00:00"), ("2024-03", "2024-03-05 10:00:00"),
                   ("2024-04", "2024-04-01 00:00:00"), ("2024-04", "2024-04-02 00:00:00")]
    assert MS.extract_months(frame(spark, []), "d", root, "2024-05-03") == []
    assert {r.mes for r in MS.read_months(spark, root).collect()} == {"2024-01", "2024-02", "2024-03", "2024-04"}


def test_the_slice_reaches_the_scan(spark, tmp_path):
    frame(spark, ["2024-01-10", "2024-03-05"]).write.parquet(str(tmp_path / "t"))
    df = MS.open_slice(spark.read.parquet(str(tmp_path / "t")), "d", "2024-03-01", "2024-03-15")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-03-01T00:00)" in plan and "LessThan(d,2024-04-01T00:00)" in plan and df.count() == 1


def test_months_prune(spark, tmp_path):
    root = str(tmp_path)
    assert MS.read_months(spark, root) is None
    MS.extract_months(frame(spark, ["2024-01-10", "2024-02-01"]), "d", root, "2024-02-15")
    df = MS.read_months(spark, root, ["2024-02"])
    assert "PartitionFilters: [mes" in df._jdf.queryExecution().executedPlan().toString() or df.count() == 1
