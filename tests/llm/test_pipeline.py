"""The pipeline's stages against brute force on a small corpus."""

import os
import random
import re
import sys

import public_tokenizers
import pytest
import sentencepiece

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm.test_decontaminate import brute as contaminated_rows  # noqa: E402
from llm.test_near_dup import brute as near_rows  # noqa: E402

WORDS = {"en": "the cat dog house water would there their which about think through between nothing".split(),
         "de": "der hund katze haus wasser würde dort ihre welche über denken durch zwischen nichts".split()}
ITEM = "benchmark question about twelve special words which nobody else would ever write down here"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(11)
    rows = []
    for k in range(80):
        lang = "en" if k % 2 else "de"
        rows.append((k, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(30, 90))), lang, f"src{k % 3}"))
    for k in range(80, 100):  # copies with one changed word
        words = rows[rnd.randrange(80)][1].split()
        words[rnd.randrange(len(words))] = "changed"
        rows.append((k, " ".join(words), "en", "src0"))
    rows += [(101, f"there their {ITEM} about water", "en", "src1"), (102, None, None, None), (103, "", "en", "s"), (104, "123 --- 456", "en", "s"),
             (105, "write to cat.dog@house.example.com about the water through their house", "en", "s"), (None, "the house without an id", "en", None),
             (106, "the water " * 3000 + "end", None, "s")]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_run(spark, corpus):
    import corpus_pipeline

    path, rows = corpus
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, path).collect()}
    stay = [(i, t) for i, t, _, _ in rows if t and re.search("[a-zäöü]", t)]  # language: all with letters
    kept = {r[0] for r in near_rows(stay) if r[3]}
    stay = [(i, t) for i, t in stay if i in kept]
    clean = {r[0] for r in contaminated_rows(stay, [(1, ITEM)]) if not r[5]}
    assert set(got) == clean and 101 not in got and None in got and len(clean) < len(rows) - 15
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, t in stay:
        if i in clean:
            want = t if i != 105 else got[i].text
            assert got[i].text == got[i].decoded == want and got[i].token_ids == library.encode(want)
    assert re.fullmatch(r"write to [a-z]{3}\.[a-z]{3}@[a-z]{5}\.[a-z]{7}\.com about the water through their house", got[105].text)
    assert "cat.dog" not in got[105].text


def test_stages_keep_the_columns(spark, corpus):
    import corpus_pipeline

    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, path).columns == docs.columns, name
        assert apply(spark, docs.limit(0), path).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "personal_data", "sentence_pieces"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), path).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{k}" for k in range(1, 14)}
    assert set(__spark_entry__.oracle_sql()) <= names


def test_only_own_tables_are_deleted(spark, corpus):
    import corpus_pipeline

    from ledgerlens.llm import common, surrogates

    path, _ = corpus
    other = surrogates.replaced(spark.createDataFrame([(1, "write to cat.dog@house.example.com")], "doc_id long, text string"))
    with common.staged_tables() as own:
        made = corpus_pipeline.run(spark, path)
    assert other.count() == 1 and made.count() > 0
    last = own[-1]
    for p in own:  # all others are gone
        assert os.path.exists(p.removeprefix("file:")) == (p == last)


def test_repeated_rows_ties_and_clashing_columns(spark, corpus):
    import corpus_pipeline

    path, rows = corpus
    text = rows[1][1]
    odd = [(200, text, "en", "a", 1), (200, text, "en", "a", 1), (None, text, "en", "b", 1), (None, rows[3][1] + " more", None, None, 2),
           (None, rows[3][1] + " more", None, None, 2), (201, rows[5][1], "en", "c", 3), (201, rows[7][1], "en", "c", 3), (202, "", "en", "d", 0)]
    extra = spark.createDataFrame([(*r, "x", 5, 1.5, "y", 9) for r in odd],
                                  "doc_id long, text string, lang string, source string, n_chars long, language string, pieces int, row double, contamination string, h int")
    kept = corpus_pipeline.STAGES[1][1](spark, extra, path)
    assert kept.columns == extra.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())
    assert got == sorted([(False, 200, text), (True, 0, rows[3][1] + " more"), (False, 201, rows[5][1]), (False, 201, rows[7][1]), (False, 202, "")])
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, extra, path)
        assert out.columns[:len(extra.columns)] == extra.columns, name
        assert {tuple(r)[5:10] for r in out.collect()} == {("x", 5, 1.5, "y", 9)}, name
