"""The thirteen operators' queries over whole tables, and the pipeline.

Each thin query reads its table, applies the operator with production
parameters and derives the contract's columns.
"""

from __future__ import annotations

import importlib
import os

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.common import bounded_batches
from ledgerlens.llm import brown_lm, decontaminate, html_extract, language_id, lsh_forest, near_dup, sentence_pieces, substring_dedup, surrogates, token_alignment, token_binary, vector_file, word_runs

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_binary")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_binary.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return token_binary.read_tokens(files, digest=True)


@query("op2_lsh_forest")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return lsh_forest.neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op3_html_extract")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


@query("op4_surrogates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup", substring_dedup.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.deduplicate(table(spark, sf_dir, "documents")))


@query("op6_decontaminate", decontaminate.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, items, keep=["doc_id"]))


@query("op7_brown_lm")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.scored(table(spark, sf_dir, "documents"))


@query("op8_sentence_pieces")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


@query("op10_near_dup", near_dup.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


@query("op12_periodic_runs", word_runs.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.digest(word_runs.periodic_runs(table(spark, sf_dir, "documents"), word_runs.with_planted_run))


@query("op13_vector_file", vector_file.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_file.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict:
    importlib.import_module("corpus_pipeline")  # no pipeline, no queries
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
