"""The corpus pipeline: documents through five of the operators.

Each stage works on all that the one before it kept; its result is written
as Parquet in the shared checkpoint folder and read again.  All but the last
return the columns of ``documents``; other columns, whatever their names, go
through every stage unchanged.  ``run`` deletes the tables of a stage as soon
as the next one has written its result.

Null and empty texts, texts without a letter and an empty training set have no
language, so the first stage drops them.  Near duplicates keep one row of each
group: repeated rows are one, rows without an id give way to rows with one.
Contaminated rows go one by one, clean rows stay, repeated or not.  Personal
data are replaced row by row and the same value everywhere by the same
surrogate.  The last stage adds ``token_ids`` and ``decoded`` (null for null
texts).  An empty table stays empty through all stages.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontaminate, language_id, near_dup, sentence_pieces, surrogates
from ledgerlens.llm.common import delete_tables, stage, staged_tables
from ledgerlens.llm.queries import table, tokenizer_file


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language learned from the labels."""
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, personal data replaced in their texts."""
    return surrogates.replace(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids and the text decoded from them."""
    return sentence_pieces.round_trip(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", replace_personal_data),
    ("sentence_pieces", encode_pieces),
]

# No SQL can state suffix automata or the tokenizer's pieces; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    before: list[str] = []
    for name, apply in STAGES:
        with staged_tables() as own:
            docs = stage(apply(spark, docs, sf_dir), f"pipeline_{name}")
        delete_tables(spark, before + own[:-1])  # all but what this stage returns
        before = own[-1:]
    return docs
