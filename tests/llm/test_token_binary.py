import random
import string

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import token_binary as op
from ledgerlens.llm.common import cut_segments

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODE, TOK = op._encoder(PATH), Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
def test_code_round_trip(values):
    control, data = op.pack(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert op.unpack(control, data, step=3)[: len(values)].tolist() == values


def test_frequent_values_take_one_byte():
    control, data = op.pack(np.zeros(400, dtype=np.uint32))
    assert (len(control), len(data)) == (100, 400)


def check(rows, got):
    """Right ids for every row, in ascending doc_id order without gaps."""
    tok = Tokenizer.from_file(PATH)
    ids = [np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4") for _, text in rows]
    want = [(doc_id, len(x), op.crc_of(x)) for (doc_id, _), x in zip(rows, ids)]
    got = sorted(map(tuple, got), key=lambda r: r[1])
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == sorted(want, key=str)
    order = [(d is not None, d) for d, *_ in got]
    assert order == sorted(order, key=lambda o: (o[0], o[1] or 0))
    assert [s for _, s, _, _ in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]


def test_matches_the_tokenizer(spark):
    rows = [(5, "The cat's café, été x y  42nd\n\n\tÉTÉ ΣΑΣ <|endoftext|> end"), (2, None), (9, ""),
            (None, "null id"), (2, "again"), (7, "word " * 30000), (8, "x" * 5000), (5, "a\x1cb\x85c \x00d"), (5, "tie"), (5, "tie")]
    docs = spark.createDataFrame([(t, i, 7, "s", 1) for i, t in rows], "text string, doc_id long, start int, ids string, h int").repartition(3)
    files = op.write_tokens(docs, PATH, block_tokens=100)
    check(rows, op.read_tokens(files, digest=True).collect())
    assert [(r.doc_id, r.start, r.n_tokens, op.crc_of(np.frombuffer(r.ids, "<u4"))) for r in op.read_tokens(files).orderBy("start").collect()] == \
        [tuple(r) for r in op.read_tokens(files, digest=True).orderBy("start").collect()]


POOL = string.printable + "éÉßñÑ’ǅªº²½\xad\x80\x85ſİıŁ\x1c\x00Σσ日'̀<|>"


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(POOL), max_size=30))
def test_words_match_the_tokenizer(text):
    assert ENCODE.encode([text])[0].tolist() == TOK.encode(text, add_special_tokens=False).ids


def test_a_word_is_encoded_once_wherever_it_stands():
    seen = []
    ids = op.WordIds(lambda w: seen.append(w) or [len(w)], True)
    got = ids.encode(["one two, one", "two. " * 1000 + "one", "two"])
    assert sorted(seen) == [",", ".", "one", "two"] and got[0].tolist() == [3, 3, 1, 3] and len(got[1]) == 2001


def test_batches_segments_and_full_tables(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(POOL + "      ") for _ in range(rng.randint(0, 200))) for _ in range(60)] + ["", "y" * 500, "a, b. c", " x"]
    want = [TOK.encode(t, add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(op, "cut_segments", lambda b: cut_segments(b, 90))
    small = op.WordIds(ENCODE.encode_word, True, slots=1 << 8)
    assert [x.tolist() for x in small.encode(texts)] == want
    assert [x.tolist() for x in small.encode(texts)] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.read_tokens(op.write_tokens(docs, PATH)).count() == 0


def test_query_on_documents(spark):
    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op1_token_binary"](spark, sf).collect())
