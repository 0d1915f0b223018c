import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import leads as L
from ledgerlens.sources import fixtures as X
from ledgerlens.streaming import incremental as ST

from conftest import SMOKE

COLS = ["id", "desclassificado", "prioridade", "tipo_lead", "elegivel", "classificacao_ticket", "estado", "qtd_3_meses"]


@pytest.fixture(scope="module")
def tables(spark):
    # fewer phones, so that later arrivals change what earlier ones were
    leads = X.leads(spark, SMOKE).withColumn("telefone", F.when(F.col("id") % 17 != 0, F.concat(F.lit("119876500"), F.lpad((F.col("id") % 40).cast("string"), 2, "0"))))
    leads, enr = leads.cache(), X.lead_enrichment(spark, SMOKE).cache()
    want = L.classify(L.classification_input(leads, enr, X.AS_OF_EVENTS), X.AS_OF_EVENTS).select(*COLS).collect()
    yield leads, enr, want
    leads.unpersist(), enr.unpersist()


def same(spark, root, want):
    got = ST.read_classes(spark, root).select(*COLS).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len({r.id for r in got}) == len(got) > 50


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_split_equals_the_batch(spark, tables, tmp_path, parts):
    leads, enr, want = tables
    root = str(tmp_path / "state")
    for k in range(parts):
        some = leads.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == k)
        assert ST.classify_batch(spark, root, some, enr, X.AS_OF_EVENTS, f"b{k}") == k + 1
        assert ST.classify_batch(spark, root, some, enr, X.AS_OF_EVENTS, f"b{k}") is None  # a replay
    same(spark, root, want)


def test_lost_batch_compaction_and_stream(spark, tables, tmp_path):
    leads, enr, want = tables
    root, arrivals = str(tmp_path / "state"), str(tmp_path / "in")
    third = F.pmod(F.xxhash64("id"), F.lit(3))

    def lost():
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError, match="driver lost"):
        ST.classify_batch(spark, root, leads.filter(third == 0), enr, X.AS_OF_EVENTS, "x", before_commit=lost)
    assert ST.read_classes(spark, root) is None
    for k in range(2):  # two files, two runs of the stream
        leads.filter(third == k).write.parquet(os.path.join(arrivals, f"f{k}"))
        ST.classify_arrivals(spark, os.path.join(arrivals, "*"), leads.schema, lambda: enr, root, X.AS_OF_EVENTS, checkpoint_location=str(tmp_path / "ck"))
    firsts = {r.id: r.primeira_prioridade for r in ST.read_classes(spark, root).collect()}
    assert ST.compact_classes(spark, root, X.AS_OF_EVENTS) is not None
    assert {r.id: r.primeira_prioridade for r in ST.read_classes(spark, root).collect()} == firsts
    ST.classify_batch(spark, root, leads.filter(third == 2), enr, X.AS_OF_EVENTS, "last")
    same(spark, root, want)
    # a batch without rows, and one whose leads have no phone
    assert ST.classify_batch(spark, root, leads.limit(0), enr, X.AS_OF_EVENTS, "none") is not None
    same(spark, root, want)
