from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.operators import assign as AS
from ledgerlens.session import cut_lineage


def ids(spark, n):
    return cut_lineage(spark.createDataFrame([(k,) for k in range(n)], "id long"))


def people(spark, n):
    return ids(spark, n).select(F.col("id").alias("usuario_id"), F.concat(F.lit("c"), "id").alias("nome"))


def test_under_capacity_everyone_in_turn(spark):
    got = AS.distribute(ids(spark, 7), people(spark, 3), per_consultant=5).orderBy("id").collect()
    assert [(r.id, r.rn, r.usuario_id) for r in got] == [(k, k + 1, k % 3) for k in range(7)]


def test_over_capacity_best_draw_and_blocks(spark):
    got = AS.distribute(ids(spark, 10_000), people(spark, 4), per_consultant=50).collect()
    assert sorted(r.rn for r in got) == list(range(1, 201)) and Counter(r.usuario_id for r in got) == dict.fromkeys(range(4), 50)
    assert all(r.usuario_id == (r.rn - 1) // 50 for r in got)
    best = [r.id for r in got if r.id < 200]
    assert len({r.id for r in got}) == 200 and 190 <= len(best) < 200  # ten more rows were drawn, ten of 210 cut off
    again = AS.distribute(ids(spark, 10_000).repartition(7), people(spark, 4), per_consultant=50).collect()
    assert {(r.id, r.rn) for r in again} == {(r.id, r.rn) for r in got}


def test_no_candidates(spark):
    assert AS.distribute(ids(spark, 0), people(spark, 4)).collect() == []
    assert AS.distribute(ids(spark, 9), people(spark, 0)).collect() == []


def test_cascade(spark):
    canal = AS.RECOMMENDED_CHANNELS[0]
    rows = ids(spark, 300).select("id", F.lit(canal).alias("canal"), (F.col("id") % 2 + 1).cast("int").alias("prioridade"), F.lit("MQL").alias("tipo_lead"),
                                   (F.col("id") % 3).alias("qtd_3_meses"))
    rows = rows.unionByName(rows.withColumn("canal", F.lit("OTHER")).withColumn("id", F.col("id") + 1000))
    occ = spark.createDataFrame([(1, 95), (3, 1000)], "campanha_id long, ocupacao long")
    plan = [AS.Campaign("a", 1, 1, limit=100, first_in_3_months=True), AS.Campaign("b", 2, 1, most=30), AS.Campaign("c", 3, 2), AS.Campaign("d", 4, 1, lead_type="SQL"),
            AS.Campaign("e", 5, 1)]
    got = AS.campaign_cascade(rows, occ, plan).collect()
    by = {k: sorted((r.rn, r.id) for r in got if r.chave == k) for k in "abcde"}
    assert [len(by[k]) for k in "abcde"] == [5, 30, 0, 0, 115] and len({r.id for r in got}) == 150
    assert all(r.qtd_3_meses == 1 for r in got if r.chave == "a") and all(r.id < 300 for r in got)
    key = {r.id: r.k for r in rows.select("id", AS.shuffle_key().alias("k")).collect()}
    for k in "abe":
        assert [i for _, i in by[k]] == sorted((i for _, i in by[k]), key=key.get)
    # each took the first by the shuffle key of what was left
    pool = sorted((i for i in range(300) if i % 2 == 0), key=key.get)
    a = [i for i in pool if i % 3 == 1][:5]
    assert [i for _, i in by["a"]] == a and [i for _, i in by["b"]] == [i for i in pool if i not in a][:30]
