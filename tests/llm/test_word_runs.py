import hashlib
import random
import re
import zlib

import pytest

from ledgerlens.llm import word_runs as op


def brute_runs(words):
    """All lags, word by word."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)  # the least lag comes first
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(rows, plant=True):
    out = []
    for i, text in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        words = planted(i, words) if plant and i is not None else words
        runs = brute_runs(words)
        gone = {p for s, n, q in runs for p in range(s + q, s + n)}
        best = None
        for s, n, q in runs:
            if best is None or n * best[2] > best[1] * q:
                best = (s, n, q)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                    sha(" ".join(w for p, w in enumerate(words) if p not in gone))))
    return out


def texts(seed):
    rnd = random.Random(seed)
    word = lambda n: rnd.choice("abcdefgh"[:n])
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(1, 6)):
            u = [word(rnd.choice([2, 3, 8])) for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 13, 14, 20, 31]))]
            parts += (u * rnd.randint(1, 12))[:rnd.choice([1000, len(u) * 3, 25])]
        yield parts
    for k in range(30):
        yield [word(2) for _ in range(rnd.randint(0, 400))]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_all_lags(seed):
    docs = [[w.encode() for w in t] for t in texts(seed)]
    assert op.find_runs(docs) == [brute_runs(d) for d in docs]


def test_blocks_whose_parts_all_recur():
    """Every 16-gram occurs twice within a period: its next occurrence is never
    a period on."""
    x, y = [b"x%d" % i for i in range(20)], [b"y%d" % i for i in range(20)]
    u = sum((x if c == "x" else y for c in "xxxyxyyy"), [])
    doc = [b"before"] + u * 3 + u[:7] + [b"after"]
    assert op.find_runs([doc]) == [brute_runs(doc)] and (1, 3 * len(u) + 7, len(u)) in brute_runs(doc)


def test_lags_at_the_classes_edges():
    docs, period = [], 1
    for a, b, _ in op.lag_classes(1000):
        for q in {a, b - 1}:
            u = [b"w%d" % i for i in range(q)]
            n = max(24, 3 * q)
            docs += [(u * 30)[:n], (u * 30)[:n - 1], [b"p"] + (u * 30)[:n] + [b"q"]]
    assert op.find_runs(docs) == [brute_runs(d) for d in docs]


def test_every_stretch_is_extended_once():
    import numpy as np

    codes, _, _ = op._coded([[b"a"] * 5000])
    furthest = {}
    seeds = 3 * len(codes) + np.arange(4000)
    assert list(op.extended(codes, seeds[::7], 16, furthest)) == [(0, 4997, 3)] and furthest == {3: 4997}
    assert not list(op.extended(codes, seeds[50:60], 16, furthest))


def test_one_word_a_million_times():
    assert op.find_runs([[b"a"] * 1_000_000 + [b"b"]]) == [[(0, 1_000_000, 1)]]


ROWS = [(1, None), (2, ""), (3, " \t\n "), (4, "a " * 23), (5, "a " * 24), (6, "a\tb\x0bc " * 9 + "d"), (None, "x y " * 20), (7, "a " * 24), (7, "a " * 24),
        (8, "é ü " * 15 + "a a a " * 10), (9, "a b " * 24), (10, "A a " * 12)]


def frame(spark, rows):
    return spark.createDataFrame([(7, t, i, None, [1]) for i, t in rows], "n_runs long, text string, doc_id long, runs string, kept_text array<int>").repartition(3)


def test_query_equals_brute_force(spark):
    rows = ROWS + [(100 + k, " ".join(t)) for k, t in enumerate(texts(99))] + [(500, "lorem ipsum dolor " * 4000 + "end")]
    got = op.digest(op.periodic_runs(frame(spark, rows), op.with_planted_run)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))
    assert any(r[1] > 1 for r in got)


def test_operator_without_planting(spark):
    got = op.periodic_runs(frame(spark, ROWS)).collect()
    want = {(r[0], r[1]) for r in brute(ROWS, plant=False)}
    assert {(r.doc_id, len(r.runs)) for r in got} == want and len(got) == len(ROWS)
    assert {r.kept_text for r in got if r.doc_id == 8} == {"é ü a"}


def test_empty(spark):
    assert op.digest(op.periodic_runs(frame(spark, []))).count() == 0
