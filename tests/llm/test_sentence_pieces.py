import random

import public_tokenizers
import pytest
import sentencepiece

from ledgerlens.llm import sentence_pieces as op

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return op.Pieces(PATH)


def chunked(pieces, text, size):
    t = op.escape(text)
    n = -(-len(t) // size)
    chunks = [op.Chunk(pieces, t[max(0, k * size - pieces.longest):k * size], t[k * size:(k + 1) * size],
                       t[(k + 1) * size:(k + 1) * size + pieces.longest], k == 0, k == n - 1) for k in range(n)]
    states = op.boundary_states([op.as_matrix(*c.matrix()) for c in chunks])
    return [i for k, c in enumerate(chunks) for i in c.ids(states[k], states[k + 1])]


POOLS = ["ab ", "the and ing on er re th a e ", " éèàçß日本①\n\t▁<0x0A></s>", "aaaaab", "internationalization of tokenization "]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 16, 40])
def test_chunks_give_the_library_ids(pieces, size):
    rnd = random.Random(size)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for _ in range(60):
        pool = rnd.choice(POOLS)
        text = "".join(rnd.choice([rnd.choice(pool), rnd.choice(pool), rnd.choice(pool.split() or ["x"])]) for _ in range(rnd.randint(1, 60)))
        assert chunked(pieces, text, size) == library.encode(text), repr(text)


def test_product_is_associative(pieces):
    t = op.escape("unbelievably longunbrokentokenizationtext of internationalization")
    size = 5
    parts = [op.as_matrix(*op.Chunk(pieces, t[max(0, a - 16):a], t[a:a + size], t[a + size:a + size + 16], a == 0, a + size >= len(t)).matrix())
             for a in range(0, len(t), size)]
    a, b, c = parts[2], parts[3], parts[4]
    assert op.combine(op.combine(a, b), c) == op.combine(a, op.combine(b, c))


TEXTS = [None, "", " ", "x", "  two  spaces ", "The cat\n\n sat\ton été 日本① mat.", "word " * 400, "unbroken" * 120, "été" * 300 + " " * 100 + "z", "\x00\x7f"]


def test_rows(spark, pieces):
    rows = [(k, t, "v") for k, t in enumerate(TEXTS)] + [(None, "null id " * 60, None), (3, "x", "v"), (3, "x", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = op.decode(op.encode(docs, PATH, chunk=50), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.token_ids == (None if r.text is None else library.encode(r.text)), r.text
        assert r.decoded == r.text and (r.text is None or r.decoded == library.decode(r.token_ids))
    assert sorted(map(str, ((r.doc_id, r.text, r["row"]) for r in got))) == sorted(map(str, rows))
    assert op.digest(docs.limit(0), PATH).count() == 0


def test_query_on_documents(spark):
    import zlib

    import numpy as np

    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), None if r.text is None else zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in QUERIES["op8_sentence_pieces"](spark, sf).collect() if r.restored}
    assert got == want
