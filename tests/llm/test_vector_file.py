import math

import numpy as np
import pytest

from ledgerlens.llm import vector_file as op


def whole(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [max(-2**63, min(2**63 - 1, math.floor(256 * x))) for x in v]


def brute(rows, k):
    ok = sorted({(i, tuple(w)) for i, v in rows if i is not None and (w := whole(v)) is not None})
    out = []
    for i, q in ok:
        if i % 50 == 0:
            found = []
            for j, v in ok:
                if j != i and len(v) == len(q):
                    s = sum(a * b for a, b in zip(q, v))
                    found.append((-s, j))
            best = sorted(found)[:k]
            out += [(i, r + 1, j, -s if -2**63 <= -s < 2**63 else None) for r, (s, j) in enumerate(best)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(v, i, 3, "x", b"y") for i, v in rows], "embedding array<double>, vec_id long, rank int, q string, vec binary").repartition(3)


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


ODD = [(5000, None), (5050, []), (5051, []), (5100, [0.0] * 8), (5150, [1.0] * 7 + [float("nan")]), (5200, [1.0] * 7 + [None]), (None, [1.0] * 8),
       (5250, [1.0, 2.0]), (5251, [2.0, 1.0]), (5300, [float("inf")] * 8), (5350, [-0.001] * 8), (5351, [1e6] * 8)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 6000])
def test_equals_all_scores(spark, block_bytes):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(8) * (1 + i % 5)).round(int(rng.integers(0, 4))).tolist()) for i in range(900)]
    rows += [(2000 + i, rows[50][1]) for i in range(400)] + ODD + [(100, rows[100][1]), (150, rows[7][1])]
    vectors = frame(spark, rows)
    got = op.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, block_bytes=block_bytes).collect()
    want = [r for r in brute(rows, 5) if r[0] != 150]
    same([r for r in got if r.query_id != 150], want)  # 150 has two vectors: two queries
    assert len([r for r in got if r.query_id == 150]) == 10


def test_scores_beyond_a_double_and_a_long(spark):
    rows = [(0, [2.0**40 + 1, 3.0]), (1, [2.0**13 + 1, 0.00390625]), (2, [2.0**13 + 1, 0.0078125]), (3, [1e300, 1.0]), (4, [-1e300, 1.0]), (5, [2.0**50, 1.0])]
    vectors = frame(spark, rows)
    same(op.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5).collect(), brute(rows, 5))


def test_bounds_hold_and_reading_stops_early():
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.standard_normal((3000, 32)) / 6).astype(np.int64)
    q = v[:7]
    low, high = op.Cells.of(v).bounds(q)
    true = v @ q.T
    assert (low <= true).all() and (true <= high).all() and (high - low).mean() < 0.2 * true.std() * 6
    for j in range(7):
        entries = np.arange(3000)
        found, read = op.read_in_order(v, q[j], entries, high[:, j], 5)
        best = sorted(true[:, j].tolist(), reverse=True)[:6]
        assert sorted((s for _, s in found), reverse=True)[:6] == best and read < 600


def test_few_rows(spark):
    for rows in ([], [(50, [1.0])], [(50, [1.0]), (51, [2.0])], [(1, [1.0]), (2, [1.0])]):
        vectors = frame(spark, rows)
        same(op.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect(), brute(rows, 5))
