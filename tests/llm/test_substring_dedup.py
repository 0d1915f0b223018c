import random
import re

import numpy as np
import pytest

from ledgerlens.llm import substring_dedup as op


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k:k + 13])
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and least[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((i, len(w), len(gone), op.sha256_of([x for k, x in enumerate(w) if k not in gone])))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = ["the", "of", "and"] * 5 + [f"w{i}" for i in range(60)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(11, 60))] for _ in range(10)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocab) for _ in range(rnd.randint(1, 40))]
        rows.append((k * 3 % n, " ".join(parts)))
    return rows


EDGES = [(1000, None), (1001, ""), (1002, " \n"), (1003, "x " * 3000), (1004, "x " * 20), (1005, "x " * 12), (None, "x " * 20), (None, None),
         (1006, "A b c d e f g h i j k l m"), (1007, "a b c d e f g h i j k l m"), (1008, "q A b\tc d\ne f g h i j k l m z"),
         (1009, "same id one two three four five six seven eight nine ten eleven"), (1009, "pad same id one two three four five six seven eight nine ten eleven"),
         (1010, "\x1c\x85 é ü 4 5 6 7 8 9 10 11 12 13"), (1011, "\x1c\x85 é ü 4 5 6 7 8 9 10 11 12 13"), (1011, "\x1c\x85 é ü 4 5 6 7 8 9 10 11 12 13")]


@pytest.mark.parametrize("options", [{}, {"table_bits": 1 << 10, "flush": 50}])
def test_matches_brute_force(spark, options):
    rows = corpus(7) + EDGES
    docs = spark.createDataFrame([(t, i, 1, "r") for i, t in rows], "text string, doc_id long, crc int, ranges string").repartition(4)
    assert sorted(map(tuple, op.digest(op.deduplicate(docs, **options)).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert op.digest(op.deduplicate(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 3 + seed * 5, rng.integers(1, 40)).astype(np.uint32) for _ in range(12)]
    index = op.FmIndex(texts, 6)
    query = rng.integers(0, 5 + seed * 5, 200).astype(np.uint32)
    ends = np.arange(200)
    length, lo, hi = index.matching_statistics(index.symbols(query), ends, ends + 1)
    held = [t.tolist() for t in texts]
    count = lambda p: sum(t[i:i + len(p)] == p for t in held for i in range(len(t)))
    for e in range(200):
        want = max(k for k in range(min(6, e + 1) + 1) if not k or count(query[e - k + 1:e + 1].tolist()))
        assert length[e] == want
        if want:
            assert hi[e] - lo[e] == count(query[e - want + 1:e + 1].tolist())


def test_minimisers_cover_windows():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 100, dtype=np.uint64)
    for window, kmer in ((13, 6), (13, 3), (5, 5), (8, 1)):
        got = op.minimisers(h, window, kmer)
        parts = op.minimisers(h, kmer, kmer)
        assert got.tolist() == [parts[i:i + window - kmer + 1].min() for i in range(100 - window + 1)]


def test_words_that_agree_in_32_bits_differ(spark):
    words = [f"w{k}" for k in range(400_000)]
    low = op.hashed_words([" ".join(words)], op._SPACES)[0].astype(np.uint32)
    order = np.argsort(low, kind="stable")
    k = np.flatnonzero(low[order][1:] == low[order][:-1])[0]
    a, b = words[order[k]], words[order[k + 1]]
    rows = []
    for p in range(20):
        rest = " ".join(f"p{p}x{j}" for j in range(12))
        rows += [(2 * p, f"{a} {rest}"), (2 * p + 1, f"{b} {rest}")]
    got = op.digest(op.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows) and not any(r.n_removed for r in got)


@pytest.mark.parametrize("n", [10, 70_000])
def test_packed_words_come_back(n):
    words = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64).repeat(2)
    assert (op.decoded(*op.coded(words)) == words).all()
