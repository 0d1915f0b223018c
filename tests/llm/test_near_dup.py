import random
import re

import numpy as np
import pytest

from ledgerlens.llm import components as parts
from ledgerlens.llm import near_dup as op
from ledgerlens.llm.components import components


def sets_of(rows):
    out = {}
    for k, (_, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = min(5, len(w))
        out[k] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    return out


def brute(rows):
    s, root = sets_of(rows), list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in s:
        for b in range(a):
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
                root[find(a)] = find(b)
    group = {}
    for k in s:
        group.setdefault(find(k), []).append(rows[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in group.items()}
    return sorted(((rows[k][0], len(s[k]), c := least[find(k)], c is None or rows[k][0] == c) for k in s), key=str)


def corpus(seed, n=160):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(20, 120))] for _ in range(12)]
    rows, chain = [], list(base[0])
    for k in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 9])):
            t[rnd.randrange(len(t))] = rnd.choice(vocab)
        rows.append((1000 - k, " ".join(t)))
    for k in range(25):  # a chain: neighbours alike, its ends not
        chain[(k * 5) % len(chain)] = f"c{k}"
        rows.append((2000 + k, " ".join(chain)))
    return rows


EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "Only Three words"), (5, "only  three\nWORDS"), (6, "only three"), (7, "a b c d e"),
         (8, "A B C D E"), (None, "null id text that has some words"), (None, "a b c d e"), (None, "null id text that has some words"),
         (9, "\x1c\x85 odd"), (11, "x " * 5000), (12, "x " * 7000)]


def run(spark, rows):
    docs = spark.createDataFrame([(t, i, "node", 0) for i, t in rows], "text string, doc_id long, node string, bands int").repartition(4)
    return sorted(map(tuple, op.near_duplicates(docs).collect()), key=str)


def test_matches_brute_force(spark):
    rows = corpus(1) + EDGES
    assert run(spark, rows) == brute(rows)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(parts, "LOCAL_EDGES", 0)
    monkeypatch.setattr(op, "BLOCK", 7)
    rows = corpus(2, 120)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(5)
    for size in (4, 40, 400, 3000):
        for _ in range(300):
            both = rng.integers(0, 2**63, size, dtype=np.uint64)
            union = 100 * size // 75
            extra = rng.integers(0, 2**63, max(0, union - size), dtype=np.uint64)
            cut = rng.integers(0, len(extra) + 1)
            a, b = np.unique(np.concatenate([both, extra[:cut]])), np.unique(np.concatenate([both, extra[cut:]]))
            x, y = (np.frombuffer(op.odd_sketch(s), np.uint64) for s in (a, b))
            odd = np.array([np.bitwise_count(x ^ y).sum()])
            assert op.likely(odd, np.array([len(a)]), np.array([len(b)]))[0]
            assert abs(op.estimate(odd, len(a), len(b))[0] - size / (size + len(extra))) < (0.06 if size <= 400 else 0.16)


def test_keep_one(spark):
    rows = corpus(3, 60) + EDGES
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, kept int")
    got = op.keep_one(docs)
    want = sorted((r[0] for r in brute(rows) if r[3] and r[0] is not None))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == want


@pytest.mark.parametrize("local", [0, 100_000])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(parts, "LOCAL_EDGES", local)
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 300)] + [(500, 500), (600, 601), (601, 600), (7, None)]
    rnd.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + k: 100 for k in range(300)}, 600: 600, 601: 600}
