import numpy as np
import pytest

from ledgerlens.llm import lsh_forest as op


def exact(rows, queries, k):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i in queries:
        for q in {tuple(v) for j, v in ok if j == i}:
            found = sorted((-float(v @ np.array(q)), j) for j, v in ok if j != i and len(v) == len(q))
            out[i, q] = found[:k]
    return out


ODD = [(5000, None), (5020, []), (5040, [0.0] * 8), (5060, [1.0] * 7 + [float("nan")]), (5080, [1.0] * 7 + [None]), (None, [1.0] * 8),
       (5100, [1.0, 2.0]), (5101, [2.0, 1.0]), (5120, [float("inf")] * 8)]


def frame(spark, rows):
    return spark.createDataFrame([(v, i, 3, 0.5) for i, v in rows], "embedding array<float>, vec_id long, rank int, score double").repartition(3)


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.standard_normal(8) * (1 + i % 5)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + ODD + [(40, rows[40][1])]
    vectors = frame(spark, rows)
    got = op.neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=20).collect()
    want = exact(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 20)
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        mine.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(mine) == sorted(i for (i, _), f in want.items() if f)
    for (i, _), found in want.items():
        if found:
            assert [m[0] for m in mine[i]] == list(range(1, len(found) + 1))
            assert [m[1] for m in mine[i]] == [j for _, j in found]
            assert np.allclose([m[2] for m in mine[i]], [-s for s, _ in found], rtol=1e-12)


@pytest.mark.parametrize("norms", [False, True])
def test_recall(spark, norms):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6000, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    if norms:
        base *= rng.uniform(0.5, 2, (6000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    vectors = frame(spark, rows)
    got = op.neighbours(vectors, vectors.where("vec_id % 100 = 0"), k=20, shard=2500).collect()
    want = exact(rows, range(0, 6000, 100), 20)
    true = {(i, j) for (i, _), f in want.items() for _, j in f}
    mine = {(r.query_id, r.vec_id) for r in got}
    assert len(got) == len(true) == 1200 and len(mine & true) / len(true) >= 0.9


def test_candidates_are_the_longest_prefixes():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((2000, 16))
    forest = op.Forest(v, float(np.linalg.norm(v, axis=1).max()), trees=8)
    q = rng.standard_normal((5, 16))
    keys = forest._hash(q, np.zeros(5), np.linalg.norm(q, axis=1).max())
    own = np.empty((2000, 8), dtype=np.uint32)
    for t in range(8):
        own[forest.order[t], t] = forest.keys[t]
    assert all((np.diff(k.astype(np.int64)) >= 0).all() for k in forest.keys)
    for i, found in enumerate(forest.candidates(q, 400)):
        shared = 32 - np.ceil(np.log2((own ^ keys[i]).astype(float) + 1))  # bits in common, by tree
        depth = max(d for d in range(33) if (shared >= d).sum() >= 400)
        assert set(np.flatnonzero((shared >= depth + 1).any(axis=1))) <= set(found) <= set(np.flatnonzero((shared >= depth).any(axis=1)))


def test_empty(spark):
    vectors = frame(spark, [])
    assert op.neighbours(vectors, vectors).count() == 0
    lone = frame(spark, [(20, [1.0, 0.5])])
    assert op.neighbours(lone, lone).count() == 0


def test_query_recall_on_embeddings(spark):
    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    got = {(r.query_id, r.vec_id) for r in QUERIES["op2_lsh_forest"](spark, sf).collect()}
    hits = n = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        hits += sum((int(ids[q]), int(b)) in got for b in best)
        n += len(best)
    assert hits / n >= 0.9
