import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import model as M


def brute_auc(rows):
    pos, neg = ([s for s, y in rows if y == k] for k in (1, 0))
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("levels", [1, 3, 50, 10**6])
def test_auc_equals_all_pairs(spark, levels):
    rnd = random.Random(levels)
    rows = [(rnd.randrange(levels) / 7, int(rnd.random() < 0.3)) for _ in range(600)]
    df = spark.createDataFrame(rows, f"s double, {M.LABEL} int")
    for buckets in (2, 64):
        assert M.exact_auc(df, "s", buckets=buckets) == pytest.approx(brute_auc(rows), abs=1e-12)
    assert M.exact_auc(df.filter(f"{M.LABEL} = 1"), "s") is None


def test_class_report(spark):
    rows = [(0, 0.0)] * 50 + [(0, 1.0)] * 10 + [(1, 1.0)] * 20 + [(1, 0.0)] * 5 + [(2, 0.0)] * 3
    df = spark.createDataFrame(rows, f"{M.LABEL} int, prediction double")
    got = {r.classe: (r.precision, r.recall, r.support) for r in M.class_report(df).collect()}
    assert got[0] == (50 / 58, 50 / 60, 60) and got[1] == (20 / 30, 20 / 25, 25) and got[2] == (0.0, 0.0, 3)
    f1 = {r.classe: r.f1 for r in M.class_report(df).collect()}
    assert f1[1] == pytest.approx(2 * (2 / 3) * 0.8 / (2 / 3 + 0.8)) and f1[2] == 0.0


def training(spark, n=400):
    rnd = random.Random(1)
    rows = []
    for k in range(n):
        a, b, c = rnd.randrange(5), rnd.randrange(4), rnd.randrange(3)
        rows.append((f"{k:011}", a, b, c, int(a + b + rnd.random() * 3 > 5)))
    return spark.createDataFrame(rows, "cpf string, tabulacoes_efetivas long, qtd_contratos_anteriores long, qtd_contratos_ultimo_ano long, convertidos int")


def test_folds_and_cross_validation(spark):
    df = training(spark)
    sizes = [r["count"] for r in M.folds(df).groupBy("_fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 50
    aucs = M.cross_validated_auc(df, trees=5)
    assert len(aucs) == 5 and all(a > 0.8 for a in aucs)


def test_stored_model_is_loaded_and_scores_a_list(spark, tmp_path):
    root, calls = str(tmp_path / "model"), []

    def rows():
        calls.append(1)
        return training(spark)

    first = M.stored_or_trained(spark, root, rows, trees=5)
    again = M.stored_or_trained(spark, root, rows, trees=5)
    assert calls == [1]  # the second run loads
    (tmp_path / "model" / "version=2" / "model").mkdir(parents=True)  # a run lost before its mark
    assert M.stored_or_trained(spark, root, rows, trees=5).stages[-1].getNumTrees == 5 and calls == [1]
    a, b = ({r.cpf: r.chance_conversao for r in M.score(m, training(spark)).collect()} for m in (first, again))
    assert a == b
    clients = spark.createDataFrame([("1", "x"), ("00000000001", "y"), ("99", "none before"), (None, "z")], "cpf string, nome string")
    tabs = spark.createDataFrame([("1", True, "2024-01-01 10:00:00"), ("1", False, "2024-01-01 10:00:00"), ("1", True, "2025-01-01 10:00:00"), ("5", True, "2024-01-01 10:00:00")],
                                 "cpf string, efetiva boolean, d string").select("cpf", "efetiva", F.col("d").cast("timestamp_ntz").alias("data"))
    prod = spark.createDataFrame([("1", "2023-12-01 00:00:00"), ("1", "2019-12-01 00:00:00"), ("7", "2023-12-01 00:00:00")], "cliente_id string, d string") \
        .select("cliente_id", F.col("d").cast("timestamp_ntz").alias("data_contrato"))
    f = {r.cpf: tuple(r)[1:] for r in M.list_features(clients, tabs, prod, "2024-06-01").select("cpf", *M.FEATURES).collect()}
    assert f == {"000.000.000-01": (1, 1, 1), "000.000.000-99": (0, 0, 0)}
    got = {r.nome: r.chance_conversao for r in M.score_list(again, clients, tabs, prod, "2024-06-01").collect()}
    assert got["z"] is None and got["x"] == got["y"] is not None and got["none before"] is not None
