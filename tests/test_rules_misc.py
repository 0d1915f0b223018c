"""Predicate builder (P1), gender lookup (S8, J25), dashboard refresh."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.operators import leads as L
from ledgerlens.operators.predicates import build_predicate
from ledgerlens.sources import fixtures as X
from ledgerlens.sources import ingest as IG

from conftest import SMOKE


def test_build_predicate(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id int, c string, v int")
    assert df.filter(build_predicate()).count() == 3
    p = build_predicate([F.col("v") > 5], {"c": None}, {"id": [1, 2]}, {"c": []})
    assert sorted(r.id for r in df.filter(p).collect()) == [1, 2]
    assert df.filter(build_predicate(equals={"c": "b"})).count() == 1


def _gender_csv():
    path = os.path.join(tempfile.mkdtemp(prefix="ll-gender-"), "nomes.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("classification,group_name,alternative_names\n")
        fh.write("F,MARIA,MARYA|MARÍA\n")
        fh.write("M,JOÃO,JOAO|JOAM\n")
        fh.write("X,ALEX,\n")
        fh.write("M,CLIENTE,\n")
        fh.write("F,CLIENTE,\n")  # the last row for a name wins
    return path


def test_gender_lookup(spark):
    lk = IG.gender_lookup(spark, _gender_csv())
    got = {r.nome: r.genero for r in lk.collect()}
    assert got["MARIA"] == "F" and got["JOAO"] == "M" and "ALEX" not in got and got["CLIENTE"] == "F"
    people = spark.createDataFrame([(1, " María Souza"), (2, "joão"), (3, None)], "id int, nome string")
    out = {r.id: r.genero for r in IG.infer_gender(people, lk).collect()}
    assert out == {1: "F", 2: "M", 3: None}


def test_dashboard_refresh(spark):
    lk = IG.gender_lookup(spark, _gender_csv())
    res = L.dashboard_refresh(X.leads(spark, SMOKE), X.campaign_production(spark, SMOKE),
                              X.monthly_index(spark, SMOKE), lk, X.AS_OF_EVENTS)
    assert set(res) == {"estado", "ticket", "comissao", "genero"}
    assert res["estado"].count() > 0 and res["ticket"].count() > 0
    assert res["genero"].filter(F.col("genero") != "F").count() == 0
