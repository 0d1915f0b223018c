import random
import re

import numpy as np
import pyarrow as pa

from ledgerlens.llm import common


def test_hashed_words(monkeypatch):
    rnd = random.Random(1)
    pool = ["a", "B", "été", "x" * 63, "y" * 64, "z" * 65, "Z" * 65, "\x1c", "the", "The", "日本"]
    texts = [None, "", " \n\t", *(" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", "\n", "  "]) for _ in range(50))]
    monkeypatch.setattr(common, "cut_segments", lambda b, cut=common.cut_segments: cut(b, 300))
    h, counts, tails = common.hashed_words(texts, common.SPACE_TABLE, tails=True)
    want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    words = [w for ws in want for w in ws]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
    for word, tail in zip(words, tails.tolist()):
        assert tail.to_bytes(4, "big").lstrip(b"\0") == word.encode()[-3:].lstrip(b"\0")


def test_segments_end_between_words():
    buffer = b"aa bb  cccccccccccc d " * 5
    for most in (1, 3, 7, 50, 1000):
        parts = list(common.cut_segments(buffer, most))
        assert b" ".join(p for _, p in parts).split() == buffer.split()
        assert all(buffer[at:at + len(p)] == p for at, p in parts)


def test_emit_bounds_batches():
    schema = pa.schema([("a", pa.int64()), ("b", pa.binary())])
    batches = list(common.emit(schema, ((k, b"x" * 10) for k in range(25)), most_rows=10, most_bytes=45))
    assert [b.num_rows for b in batches] == [5, 5, 5, 5, 5] and pa.Table.from_batches(batches)["a"].to_pylist() == list(range(25))


def test_words_of_large_texts_are_found():
    h, counts = common.hashed_words(["w " * 700_000, "v" * 1_500_000], common.SPACE_TABLE)
    assert counts.tolist() == [700_000, 1] and len(np.unique(h)) == 2
