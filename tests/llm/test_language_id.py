import zlib

import numpy as np
import pytest

from ledgerlens.llm import language_id as op

SAMPLES = {"en": "the cat and the dog sat on the mat, then they went home", "fr": "le chat et le chien sont sur la été à côté",
           "de": "der hund und die katze über straße"}


def plain(text):
    return " ".join("".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else " " for c in text).split())


def brute_phrases(segment, sample):
    """Longest matches from each phrase's start, by substring search; an
    unknown letter breaks the phrase before it and matches nothing."""
    n, k = 1, 0
    state = ""
    while k < len(segment):
        if state + segment[k] in sample:
            state += segment[k]
        else:
            n += 1
            state = segment[k] if segment[k] in sample else ""
        k += 1
    return n


@pytest.mark.parametrize("text", ["The CAT sat", "straße über alles", "日本語", "x", "le chien, the dog!! 42 und", "Été à côté " * 90])
def test_phrases_match_substring_search(text):
    model = op.build(SAMPLES)
    codes = op.encode(text, model.code)
    rows = [codes[i:i + 64] for i in range(0, len(codes), 64)]
    padded = np.zeros((len(rows), 64), dtype=np.uint8)
    for a, b in zip(padded, rows):
        a[: len(b)] = b
    flat = plain(text)
    assert len(flat) == len(codes)
    want = [[brute_phrases(flat[i:i + 64], plain(SAMPLES[k])) for k in model.langs] for i in range(0, len(flat), 64)]
    assert op.phrases(padded, model).tolist() == want


def test_decisions():
    model = op.build(SAMPLES)
    got = op.identify(["the dog went home", "et le chat", None, "", "123 -- !", "die katze", "日本"], model)
    assert [g["lang"] for g in got] == ["en", "fr", "und", "und", "und", "de", "de"]  # a tie goes to the first
    assert all(0 <= g["score"] <= 1 for g in got) and got[0]["score"] > 0.5


def test_batches_and_segments_change_nothing():
    model = op.build(SAMPLES)
    texts = [SAMPLES["en"] * k for k in range(40)] + [None, "x"]
    assert op.identify(texts, model, most=3) == op.identify(texts, model)


def test_rows_and_edges(spark):
    rows = [(i, k, SAMPLES[k] + f" {i}", 1) for i, k in enumerate(["en", "fr", "de"] * 12)] + [
        (100, "en", None, 0), (101, None, "the dog", 0), (None, "fr", "le chat", 0), (102, "en", "", 0), (103, "xx", "...", 0), (5, "de", "die katze " * 4000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, language int").repartition(3)
    got = op.identified(docs).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (100, 102, 103)} == {"und"}
    kept = op.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    empty = docs.limit(0)
    assert op.identified(empty).count() == 0 and op.keep_identified(empty).count() == 0
    unlabelled = docs.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in op.identified(unlabelled).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op9_language_id"](spark, sf).collect() if r.held_out and truth[r.doc_id]]
    assert len(got) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in got) / len(got) > 0.98
