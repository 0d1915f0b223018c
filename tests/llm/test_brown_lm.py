import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import brown_lm as op


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(rows):
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    train = [t for i, x in rows if fold(i) not in (None, 2) for t in tokens(x)]
    c, n = Counter(train), len(train)
    out = []
    for i, x in rows:
        t = tokens(x)
        out.append((i, fold(i) == 2, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in t)))
    return out


def corpus(seed, n=90):
    rnd = random.Random(seed)
    vocab = [[f"a{i}", f"B{i}", f"c{i}"] for i in range(40)]
    rows = []
    for k in range(n):
        lang = k % 3
        rows.append((k, " ".join(rnd.choice(vocab)[lang] if rnd.random() < 0.9 else f"rare{rnd.randrange(10**6)}" for _ in range(rnd.randint(1, 80)))))
    return rows + [(200, None), (201, ""), (None, "a1 b1"), (None, None), (3, "a1 rare"), (3, "a1 rare"), (202, "x " * 5000)]


@pytest.mark.parametrize("slots", [op.SLOTS, 16])
def test_base_score_and_counts(spark, slots):
    rows = corpus(1)
    docs = spark.createDataFrame([(t, i, 0, 0.5) for i, t in rows], "text string, doc_id long, n int, score double").repartition(3)
    want = sorted(brute(rows), key=str)
    if slots == op.SLOTS:
        got = op.scored(docs).collect()
    else:
        model, counts = op.fit(docs.where(~op.held_out() & docs.doc_id.isNotNull()), slots=slots)
        got = op.score(docs, model, counts).withColumn("held_out", op.held_out()).withColumn("train_tokens", op.F.lit(model.tokens)).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 for g, w in zip(got, want))


def test_model_is_a_distribution_and_beats_the_base(spark):
    rows = corpus(2, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = op.fit(docs.where(~op.held_out() & docs.doc_id.isNotNull()))
    assert np.allclose((10 ** model.log_next).sum(axis=1), 1)
    seen = Counter(t for i, x in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens(x)[:-1])
    mass = np.zeros(op.CLASSES)
    for w, c in seen.items():
        kind = model.types(op.words_of([w])[0])[2][0]
        mass[model.class_of[kind]] += (c + 1) / 10 ** model.log_total[model.class_of[kind]]
    assert (mass < 1).all() and (mass[np.unique(model.class_of[:op.FREQUENT])] > 0).any()
    out = [r for r in op.scored(docs).collect() if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_exchange_finds_classes():
    rng = np.random.default_rng(3)
    truth = rng.integers(0, 3, 30)
    n = np.zeros((31, 31))
    for a in range(30):
        for b in range(30):
            n[a, b] = rng.poisson(40 if truth[b] == (truth[a] + 1) % 3 else 1)
    n[30, :30] = n[:30, 30] = 5
    of = op.exchange(n, 4, 30)
    assert of[30] == 3 and len({(int(t), int(c)) for t, c in zip(truth, of)}) == 3


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.scored(docs).count() == 0
    only = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [(r.n_known, r.base_score, r.train_tokens) for r in op.scored(only).collect()] == [(0, 0.0, 0)] * 2


def test_query_beats_the_base_on_held_out(spark):
    from ledgerlens.llm.queries import QUERIES

    got = [r for r in QUERIES["op7_brown_lm"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert len(got) > 100 and sum(r.score for r in got) > sum(r.base_score for r in got)


def test_frequent_words_keep_their_type_when_slots_are_shared(spark):
    """Words that lose their slot to a more frequent one still have a type of
    their own, so the scores do not depend on the number of slots."""
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where(op.F.col("doc_id").isNotNull() & ~op.held_out())
    got = {}
    for slots in (op.SLOTS, 16):
        model, counts = op.fit(train, slots=slots)
        assert len(model.top_hash) == min(op.FREQUENT, counts.where("n > 1").count()) > 16
        got[slots] = sorted((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in op.score(docs, model, counts).collect())
    assert got[op.SLOTS] == got[16]


def likelihood(pair):
    x = lambda v: (v * np.log(np.maximum(v, 1e-300))).sum()
    return x(pair) - x(pair.sum(axis=1)) - x(pair.sum(axis=0))


def test_best_classes_raise_the_likelihood_most():
    rng = np.random.default_rng(5)
    size, classes = 14, 5
    n = rng.poisson(0.7, (size, size))
    n[size - 1] += 1
    n[:, 0] += 1
    of = np.append(rng.integers(0, classes - 1, size - 1), classes - 1)  # the last is the end
    pair = np.zeros((classes, classes))
    np.add.at(pair, (of[:, None], of[None]), n)
    contexts = []
    for w in range(size - 1):
        cells = Counter()
        for v in range(size):
            if v != w:
                cells[of[v]] += n[v, w]
                cells[classes + of[v]] += n[w, v]
        cells[2 * classes] = n[w, w]
        contexts += [(w, k, c) for k, c in sorted(cells.items()) if c]
    word, code, times = np.array(contexts).T
    got = op.best_classes(pair, of[:-1], word, code, times)
    for w in range(size - 1):
        value = []
        for c in range(classes - 1):
            moved = of.copy()
            moved[w] = c
            other = np.zeros((classes, classes))
            np.add.at(other, (moved[:, None], moved[None]), n)
            value.append(likelihood(other))
        assert value[got[w]] > max(value) - 1e-5


@pytest.mark.parametrize("slots", [op.SLOTS, 16])
def test_every_training_word_is_classed_by_its_own_contexts(spark, slots):
    """Classes, transitions and scores against brute force; most words are
    not among the frequent ones, and come again in other parts."""
    rnd, classes = random.Random(7), 8
    rows = corpus(6) + [(300 + k, " ".join(f"w{min(rnd.randrange(1500), rnd.randrange(1500))}x{n % 3}" for n in range(rnd.randint(1, 60)))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, counts = op.fit(docs.where(op.F.col("doc_id").isNotNull() & ~op.held_out()), slots=slots, classes=classes)
    hashed = lambda w: op.words_of([w])[0][0]
    train = [tokens(x)[:-1] for i, x in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    seen = Counter(w for t in train for w in t)
    h = {w: hashed(w) for w in {w for _, x in rows for w in tokens(x)[:-1]}}
    top = {int(x): k for x, k in zip(model.top_hash, model.top_type)}
    assert len(top) == op.FREQUENT < sum(n > 1 for n in seen.values())
    kind = {w: top.get(int(x["h"]), op.FREQUENT + int(x["shape"])) for w, x in h.items()} | {None: op.END}
    pairs = np.zeros((op.TYPES, op.TYPES))
    for t in train:
        for a, b in zip([None, *t], [*t, None]):
            pairs[kind[a], kind[b]] += 1
    of = op.exchange(pairs, classes, op.END)
    seed = {w: int(of[k]) for w, k in kind.items()}
    follows = Counter((a, b) for t in train for a, b in zip([None, *t], [*t, None]))
    where = {}
    for (a, b), n in follows.items():
        where.setdefault(a, []).append((a, b, n))
        if a != b:
            where.setdefault(b, []).append((a, b, n))
    start = np.zeros((classes, classes))
    for (a, b), n in follows.items():
        start[seed[a], seed[b]] += n
    got = {r.h: (r.n, r.cls) for r in counts.collect()}
    assert {h: n for h, (n, _) in got.items()} == {int(h[w]["h"].astype(np.int64)): n for w, n in seen.items()}
    own = {w: got[int(h[w]["h"].astype(np.int64))][1] if w in seen else seed[w] for w in h} | {None: classes - 1}
    for w in seen:
        if kind[w] < op.FREQUENT:
            assert own[w] == seed[w]
            continue
        value = []
        for c in range(classes - 1):
            moved, now = start.copy(), seed | {w: c}
            for a, b, n in where[w]:
                moved[seed[a], seed[b]] -= n
                moved[now[a], now[b]] += n
            value.append(likelihood(moved))
        assert value[own[w]] > max(value) - 1e-5
    assert any(own[w] != seed[w] for w in seen)
    shared = {}
    for w in seen:
        if kind[w] >= op.FREQUENT:
            shared.setdefault(kind[w], set()).add(own[w])
    assert max(map(len, shared.values())) > 1  # words of one shape are told apart
    between = np.zeros((classes, classes))
    for (a, b), n in follows.items():
        between[own[a], own[b]] += n
    share = (between.sum(axis=0) + 1) / (between.sum() + classes)
    step = np.log10((between + op.PULL * share) / (between.sum(axis=1, keepdims=True) + op.PULL))
    size = [sum(n + 1 for w, n in seen.items() if own[w] == c) for c in range(classes)]
    want = []
    for _, x in rows:
        t = tokens(x)
        want.append((len(t), round(sum(step[own[a], own[b]] for a, b in zip([None, *t[:-1]], t))
                                   + sum(math.log10((seen[w] + 1) / (size[own[w]] + 1)) for w in t[:-1]), 6)))
    scores = sorted((r.n_tokens, round(r.score, 6)) for r in op.score(docs, model, counts).collect())
    assert np.allclose(scores, sorted(want), rtol=0, atol=1e-5)
