"""Conversion-chance model (M1-M5) on Spark ML.

Training set (M3): one row per effectively tabulated client, with the
conversion label (any production in the window) and prior-contract
features; every input is aggregated to one row per client *before* the
joins (trap T13), so no row multiplication.  The model (M1) is a
``RandomForestClassifier`` with 100 trees, seed 42 and balanced class
weights (n / (2 * n_class)) as a weight column; evaluation (M2) has 5-fold
ROC-AUC over hash folds, exact with ties, and a report a class; scoring (M4) is
``probability[1] * 100`` with a stored model, trained only if there is none,
over a given list of clients.  Training is
distributed by Spark ML (per-partition histograms, tree aggregation);
nothing is collected to the driver except the fitted trees.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import scalars as S
from ledgerlens.operators.effectiveness import key_frequency, merge_many, prior_contracts
from ledgerlens.session import cut_lineage
from ledgerlens.sources import fixtures as X
from ledgerlens.sources.ingest import _hadoop_path, _versions

FEATURES = ["tabulacoes_efetivas", "qtd_contratos_anteriores", "qtd_contratos_ultimo_ano"]
LABEL = "convertidos"
SEED = 42
N_TREES = 100


def training_set(tabs: DataFrame, production: DataFrame, start: str, end: str) -> DataFrame:
    """M3: effective tabulations in the window, conversion label and features, zero-filled."""
    t = (tabs.filter(F.col("efetiva") & (F.col("data") >= F.lit(start).cast("timestamp_ntz"))
                     & (F.col("data") < F.lit(end).cast("timestamp_ntz")))
         .withColumn("cpf", S.cpf_mask(F.col("cpf"))))
    tab_counts = key_frequency(t, "cpf", "tabulacoes_efetivas")
    p = production.withColumn("cpf", S.cpf_mask(F.col("cliente_id")))
    conv = (p.filter((F.col("data_contrato") >= F.lit(start).cast("timestamp_ntz"))
                     & (F.to_date("data_contrato") <= F.date_sub(F.lit(end).cast("date"), 1)))
            .select("cpf").distinct().withColumn(LABEL, F.lit(1)))
    feats = prior_contracts(production, start)
    out = merge_many(tab_counts.select("cpf"), [conv, tab_counts, feats], "cpf")
    return out.fillna(0, [LABEL, *FEATURES])


def with_balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class weight n / (n_classes * n_class) from a tiny per-class aggregate."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = counts.agg(F.sum("_nc")).scalar()          # scalar subqueries over a
    k = counts.agg(F.count(F.lit(1))).scalar()     # one-row-per-class table
    w = counts.select(label, (n / (k * F.col("_nc"))).alias("peso"))
    return df.join(F.broadcast(w), label)


def train(df: DataFrame, trees: int = N_TREES) -> PipelineModel:
    """M1: assemble features, fit the forest."""
    data = with_balanced_weights(df).withColumn("label", F.col(LABEL).cast("double"))
    rf = RandomForestClassifier(numTrees=trees, seed=SEED, featuresCol="features", labelCol="label",
                                weightCol="peso")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), rf]).fit(data)


def evaluate(df: DataFrame, seed: int = SEED) -> dict:
    """M2: 80/20 split ROC-AUC and accuracy, plus feature importances.

    Returns a small dict of metrics (the only driver-side values)."""
    data = with_balanced_weights(df).withColumn("label", F.col(LABEL).cast("double"))
    train_df, test_df = data.randomSplit([0.8, 0.2], seed=seed)
    fitted = train(train_df.drop("peso", "label"))
    pred = fitted.transform(test_df)
    auc = BinaryClassificationEvaluator(labelCol="label").evaluate(pred)
    report = [r.asDict() for r in class_report(pred).orderBy("classe").collect()]  # a row a class
    acc = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(pred)
    imp = fitted.stages[-1].featureImportances.toArray().tolist()
    return {"roc_auc": auc, "accuracy": acc, "importances": dict(zip(FEATURES, imp)), "classes": report}


def folds(df: DataFrame, key: str = "cpf", n: int = 5) -> DataFrame:
    """``_fold`` 0..n-1 by a hash of the key: the same on every run and cluster."""
    return df.withColumn("_fold", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def exact_auc(scored: DataFrame, score_col: str, label: str = LABEL, buckets: int = 64) -> float | None:
    """ROC-AUC: the share of (positive, negative) pairs in which the positive
    has the higher score, ties counting one half; None without both classes.

    Rows are counted a score first.  The negatives below a score are summed in
    ranges of the scores, and ranges are offset by the totals below them."""
    per = scored.groupBy(F.col(score_col).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    per = cut_lineage(per, "scores")
    cuts = per.agg(F.percentile_approx("s", [k / buckets for k in range(1, buckets)], 1000)).first()[0] or []
    per = per.withColumn("part", sum(((F.col("s") > F.lit(c)).cast("int") for c in sorted(set(cuts))), F.lit(0)))
    totals = {r.part: (r.pos, r.neg) for r in per.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}  # a row a range
    positive, negative = (sum(t[k] for t in totals.values()) for k in (0, 1))
    if not positive or not negative:
        return None
    below, at = 0, {}
    for part in sorted(totals):
        at[part] = below
        below += totals[part][1]
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in at.items() for x in kv]), F.col("part").cast("long"))
    w = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    under = per.withColumn("under", offset + F.coalesce(F.sum("neg").over(w), F.lit(0)))
    twice = under.agg(F.sum((F.col("pos") * (2 * F.col("under") + F.col("neg"))).cast("decimal(38,0)"))).first()[0]
    return float(twice) / (2.0 * positive * negative)


def cross_validated_auc(df: DataFrame, n: int = 5, trees: int = N_TREES) -> list[float | None]:
    """M2: ROC-AUC of each fold by a forest trained on the others."""
    data = cut_lineage(folds(df, n=n), "folds")
    out = []
    for k in range(n):
        fitted = train(data.filter(F.col("_fold") != k).drop("_fold"), trees)
        out.append(exact_auc(score(fitted, data.filter(F.col("_fold") == k), [LABEL]), "chance_conversao"))
    return out


def class_report(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """M2: classe, precision, recall, f1, support; 0 where a class is never
    predicted or never there.  One count a (label, prediction) first."""
    cells = predicted.groupBy(F.col(label).cast("int").alias("l"), F.col(prediction).cast("int").alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select(F.explode(F.array(F.struct(F.col("l").alias("classe"), F.lit(1).alias("is"), F.lit(0).alias("said")),
                                           F.struct(F.col("p").alias("classe"), F.lit(0).alias("is"), F.lit(1).alias("said")))).alias("x"), "l", "p", "n")
    per = sides.groupBy(F.col("x.classe").alias("classe")).agg(
        F.sum(F.col("x.is") * F.col("n")).alias("support"), F.sum(F.col("x.said") * F.col("n")).alias("said"),
        F.sum(F.when((F.col("l") == F.col("p")) & (F.col("x.is") == 1), F.col("n")).otherwise(0)).alias("hit"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    per = per.withColumn("precision", ratio(F.col("hit"), F.col("said"))).withColumn("recall", ratio(F.col("hit"), F.col("support")))
    both = F.col("precision") + F.col("recall")
    return per.select("classe", "precision", "recall", ratio(2 * F.col("precision") * F.col("recall"), both).alias("f1"), "support")


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M4: conversion chance in percent per client."""
    pred = model.transform(df)
    return pred.select("cpf", *(keep or []), (vector_to_array("probability")[1] * F.lit(100.0)).alias("chance_conversao"))


# ------------------------------------------------------------------ model store

def stored_model(spark: SparkSession, root: str) -> PipelineModel | None:
    """The newest complete version under ``root``."""
    for v in sorted(_versions(spark, root), reverse=True):
        path = f"{root.rstrip('/')}/version={v}"
        done, fs = _hadoop_path(spark, f"{path}/complete/_SUCCESS")
        if fs.exists(done):
            return PipelineModel.load(f"{path}/model")
    return None


def store_model(model: PipelineModel, spark: SparkSession, root: str) -> str:
    """Write the next version: the model, then its mark (a run lost between
    them leaves nothing that ``stored_model`` reads)."""
    path = f"{root.rstrip('/')}/version={max(_versions(spark, root), default=0) + 1}"
    model.write().save(f"{path}/model")
    spark.createDataFrame([(N_TREES, SEED)], "trees int, seed int").coalesce(1).write.json(f"{path}/complete")
    return path


def stored_or_trained(spark: SparkSession, root: str, training, trees: int = N_TREES) -> PipelineModel:
    """M4: the stored model; ``training()`` gives the rows if there is none."""
    model = stored_model(spark, root)
    if model is None:
        model = train(cut_lineage(training(), "training"), trees)
        store_model(model, spark, root)
    return model


def list_features(clients: DataFrame, tabs: DataFrame, production: DataFrame, as_of: str) -> DataFrame:
    """M4: the features of the clients of a list alone, up to ``as_of``: the
    histories are cut to the list before they are aggregated; a client without
    any has zeros.  One row a client of the list."""
    listed = clients.select(S.cpf_mask(F.col("cpf")).alias("cpf")).filter(F.col("cpf").isNotNull()).distinct()
    t = tabs.filter(F.col("efetiva") & (F.col("data") < F.lit(as_of).cast("timestamp_ntz"))).withColumn("cpf", S.cpf_mask(F.col("cpf"))).join(listed, "cpf", "left_semi")
    p = production.withColumn("_cpf", S.cpf_mask(F.col("cliente_id")))
    p = p.join(listed.withColumnRenamed("cpf", "_cpf"), "_cpf", "left_semi").drop("_cpf")
    return merge_many(listed, [key_frequency(t, "cpf", "tabulacoes_efetivas"), prior_contracts(p, as_of)], "cpf").fillna(0, FEATURES)


def score_list(model: PipelineModel, clients: DataFrame, tabs: DataFrame, production: DataFrame, as_of: str) -> DataFrame:
    """M4: ``clients`` with ``chance_conversao``; rows without a usable
    document have none."""
    scores = score(model, list_features(clients, tabs, production, as_of)).withColumnRenamed("cpf", "_cpf")
    return clients.withColumn("_cpf", S.cpf_mask(F.col("cpf"))).join(scores, "_cpf", "left").drop("_cpf")


def conversion_scores(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    """M3 -> M1 -> M4 on the driver tables (train if no model is given)."""
    ts = training_set(X.tabulations(spark, sf_dir), X.production_lines(spark, sf_dir), start, end)
    # the forest scans its input once per tree level: materialise it once in
    # the shared checkpoint folder instead of recomputing the joins each pass
    ts = cut_lineage(ts)
    model = train(ts)
    return score(model, ts)


def score_lookup(scores: DataFrame, clients: DataFrame, key: str = "cpf") -> DataFrame:
    """M5 + S12: scores for a client list — one left join (the reference
    sends the list in 1,000-key IN chunks)."""
    return clients.join(scores.select(key, "chance_conversao"), key, "left")
