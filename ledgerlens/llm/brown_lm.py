"""Operator 7: a Brown class-based bigram model of word sequences.

Every word belongs to one class.  A text's probability is the product, over
its words and one end token, of P(class | class before) * P(word | class):

* transitions are counted over all training tokens (a text starts after an
  end) and smoothed towards the classes' own shares:
  (n(a, b) + ``PULL`` * share(b)) / (n(a) + ``PULL``);
* emissions are (c(word) + 1) / (N_class + V_class + 1), which leaves a share
  for words that no training text holds.

Classes come from exchange clustering in two steps.  The seed: types move one
at a time to the class that most raises the likelihood of the class bigrams,
until a sweep moves none (``SWEEPS`` sweeps at most).  The types, ``FREQUENT``
words and ``SHAPES`` groups of all other words by their last three bytes, are a
fixed parameter, so the matrix of their bigrams has a fixed size; its counts,
like all word counts, cover all training text.  Then every other word of the
training text, however rare, leaves its shape: its own neighbours are counted
by class and side over all training text, and it goes to the class of the
greatest gain by the same measure.  That sweep is one, over all words at once
and against the seed's classes; transitions and emissions are counted again
under the classes it gives.  A shape's class is left to words that no training
text holds.

The table of words (hash, count, class) is a distributed one.  A fixed table of
``SLOTS`` places, one word each (two places share the words that fall there, the
most frequent first), goes to every task; words it does not hold go through a join, for their class and for
the sum of log10(c + 1), which serves the score and the unigram base score.

Null and empty texts have the end token alone.  Rows with a null doc_id are
scored, neither learned from nor held out.  Repeated rows are separate rows.
With no training rows every count is zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE_TABLE, hashed_words, in_groups, mix64, rows_of, stage

CLASSES = 64
FREQUENT = 767
SHAPES = 256
SLOTS = 1 << 21
PULL = 50.0
SWEEPS = 12
FLUSH = 8 << 20
CELLS = 1 << 15      # context counts of which the gains are worked out at one time
WORD = np.dtype([("h", "<u8"), ("shape", "<u2")])
CONTEXT = np.dtype([("code", "<u2"), ("n", "<u4")])


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of the words of all texts, and their number a text."""
    h, counts, tails = hashed_words(texts, SPACE_TABLE, tails=True)
    words = np.zeros(len(h), dtype=WORD)
    words["h"], words["shape"] = h, mix64(tails) % np.uint64(SHAPES)
    return words, counts


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """Hash and shape of each word of each text."""
    words, counts = _words(texts)
    return np.split(words, np.cumsum(counts)[:-1])


def _grouped(rows):
    """Groups of rows that end in a text; the words of all, and their number
    a row."""
    for held in in_groups(rows, lambda r: len(r[-1] or "")):
        yield held, *_words([r[-1] for r in held])


def _worded(rows):
    """Rows that end in a text, with its words instead."""
    for held, words, counts in _grouped(rows):
        for row, own in zip(held, np.split(words, np.cumsum(counts)[:-1])):
            yield *row[:-1], own


def _ended(values: np.ndarray, counts: np.ndarray, end) -> np.ndarray:
    """``values``, ``counts`` a row, with ``end`` after each row's."""
    return np.insert(values, np.cumsum(counts), end)


def _before(values: np.ndarray, end) -> np.ndarray:
    """What stands before each of ``values``: an end before the first."""
    return np.concatenate([np.full(1, end, values.dtype), values[:-1]])


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values: ``data`` cut at ``offsets`` (in items)."""
    offsets = (offsets * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


# ------------------------------------------------------------- clustering

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(n: np.ndarray, classes: int, fixed: int, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for each type of the bigram counts ``n``; the type ``fixed``
    keeps the last class to itself.  Types start in classes dealt by
    frequency; each moves to the class with the best likelihood (ties: the
    lowest)."""
    n = n.astype(np.float64)
    size = len(n)
    weight = n.sum(axis=0) + n.sum(axis=1)
    order = [int(w) for w in np.argsort(-weight, kind="stable") if w != fixed]
    words = max(1, classes - 1)
    of = np.full(size, classes - 1)
    of[order] = np.arange(len(order)) % words
    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    right, left = n @ member, n.T @ member  # of each type: followers, and what it follows, by class
    pair = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            r, l, own, c = right[w].copy(), left[w].copy(), n[w, w], of[w]
            r[c] -= own
            l[c] -= own
            pair[c] -= r
            pair[:, c] -= l
            pair[c, c] -= own
            rows, cols, diag = pair.sum(axis=1), pair.sum(axis=0), np.diag(pair)
            out = _xlogx(pair + r) - _xlogx(pair)
            into = _xlogx(pair + l[:, None]) - _xlogx(pair)
            both = _xlogx(diag + r + l + own) - _xlogx(diag)
            gain = out.sum(axis=1) - np.diag(out) + into.sum(axis=0) - np.diag(into) + both
            gain -= _xlogx(rows + r.sum() + own) - _xlogx(rows) + _xlogx(cols + l.sum() + own) - _xlogx(cols)
            best = int(np.argmax(np.round(gain[:words], 6)))
            pair[best] += r
            pair[:, best] += l
            pair[best, best] += own
            if best != c:
                moved += 1
                of[w] = best
                right[:, c] -= n[:, w]
                right[:, best] += n[:, w]
                left[:, c] -= n[w]
                left[:, best] += n[w]
        if not moved:
            break
    return of


def best_classes(pair: np.ndarray, own_class: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For words whose classes are ``own_class``, the class of the best
    likelihood of the class bigrams ``pair``, all else staying (ties: the
    lowest).  The words' contexts, in the order of ``word`` and at least one a
    word: code a: n times after class a; classes + b: before class b;
    2 * classes: after the word itself.  The last class is the end's."""
    classes = len(pair)
    n, size = n.astype(np.float64), len(own_class)
    at, side = code % classes, code // classes
    l, r, own = np.zeros((size, classes)), np.zeros((size, classes)), np.zeros(size)
    l[word[side == 0], at[side == 0]] = n[side == 0]
    r[word[side == 1], at[side == 1]] = n[side == 1]
    own[word[side == 2]] = n[side == 2]
    each, here = np.arange(size), own_class
    gains = np.zeros((len(word), classes))  # of each context, by the word's class
    for k, (counts, other) in enumerate(((pair, r), (pair.T, l))):
        e = np.flatnonzero(side == k)
        rows, w, c, a = np.arange(len(e)), word[e], here[word[e]], at[e]
        base = counts[a]  # without the word, which stands in its own class now
        base[rows, c] -= n[e]
        same = np.flatnonzero(a == c)
        base[same] -= other[w[same]]
        base[same, c[same]] -= own[w[same]]
        gain = _xlogx(base + n[e, None]) - _xlogx(base)
        gain[rows, a] = 0  # counted below, from both sides
        gains[e] = gain
    gain = np.add.reduceat(gains, np.searchsorted(word, each), axis=0) if size else gains
    diag = np.repeat(np.diag(pair)[None], size, axis=0)
    diag[each, here] -= r[each, here] + l[each, here] + own
    gain += _xlogx(diag + r + l + own[:, None]) - _xlogx(diag)
    for total, much in ((pair.sum(axis=1), r.sum(axis=1) + own), (pair.sum(axis=0), l.sum(axis=1) + own)):
        total = np.repeat(total[None], size, axis=0)
        total[each, here] -= much
        gain -= _xlogx(total + much[:, None]) - _xlogx(total)
    return np.argmax(np.round(gain[:, :max(1, classes - 1)], 6), axis=1)


@dataclass
class Model:
    slot_hash: np.ndarray    # the word in each slot; two slots share a hash
    slot_count: np.ndarray
    slot_class: np.ndarray
    top_hash: np.ndarray     # the words with a type of their own, by hash
    top_type: np.ndarray
    class_of: np.ndarray     # type -> class; then each class, for words with one of their own
    log_next: np.ndarray     # class before, class
    log_total: np.ndarray    # class: log10(N + V + 1)
    tokens: int
    distinct: int
    ends: int

    def types(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot = (words["h"] & np.uint64(len(self.slot_hash) // 2 - 1)).astype(np.int64) * 2
        slot += self.slot_hash[slot] != words["h"]
        held = (self.slot_hash[slot] == words["h"]) & (self.slot_count[slot] > 0)
        kind = FREQUENT + words["shape"].astype(np.int64)
        if len(self.top_hash):
            at = np.minimum(np.searchsorted(self.top_hash, words["h"]), len(self.top_hash) - 1)
            kind = np.where(self.top_hash[at] == words["h"], self.top_type[at], kind)
        return slot, held, np.where(held, TYPES + self.slot_class[slot].astype(np.int64), kind)


END = FREQUENT + SHAPES
TYPES = END + 1


# ------------------------------------------------------------------ Spark

def held_out(doc_id: str = "doc_id", folds: int = 7, fold: int = 2):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _counts(train: DataFrame) -> DataFrame:
    """h, shape, n of every training word, each task's words summed first."""
    schema = pa.schema([("h", pa.int64()), ("shape", pa.int32()), ("n", pa.int64())])

    def count(batches):
        def summed(held):
            words = np.concatenate(held)
            h, first, n = np.unique(words["h"], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(words["shape"][first].astype(np.int32)),
                                              pa.array(n.astype(np.int64))], schema=schema)

        held, size = [], 0
        for (words,) in _worded(rows_of(batches, "text")):
            held.append(words)
            size += len(held[-1])
            if size >= FLUSH:
                yield from summed(held)
                held, size = [], 0
        if held:
            yield from summed(held)

    return train.select("text").mapInArrow(count, "h long, shape int, n long").groupBy("h", "shape").agg(F.sum("n").alias("n"))


def _bigrams(train: DataFrame, held) -> np.ndarray:
    """Counts of neighbouring types over all training text."""
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def count(batches):
        model, total = held.value, np.zeros(TYPES * TYPES, dtype=np.int64)
        cells, size = [], 0
        for (words,) in _worded(rows_of(batches, "text")):
            path = np.concatenate([[END], model.types(words)[2], [END]])
            cells.append(path[:-1] * TYPES + path[1:])
            size += len(path)
            if size >= 1 << 20:
                total += np.bincount(np.concatenate(cells), minlength=len(total))
                cells, size = [], 0
        if cells:
            total += np.bincount(np.concatenate(cells), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], schema=schema)

    got = train.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(TYPES * TYPES, dtype=np.int64)  # TYPES squared cells at most
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(TYPES, TYPES)


def _contexts(train: DataFrame, held) -> DataFrame:
    """h, its class in the seed, and how often it stands beside each class (a
    ``CONTEXT`` array) in a part of the text, of every word without a type of
    its own."""
    schema = pa.schema([("h", pa.int64()), ("cls", pa.int32()), ("contexts", pa.binary())])

    def count(batches):
        model = held.value
        classes, end = len(model.class_of) - TYPES, model.class_of[END]
        codes = 2 * classes + 1

        def summed(parts):
            h, cls, left, right = (np.concatenate(x) for x in zip(*parts))
            h, first, at = np.unique(h, return_index=True, return_inverse=True)
            cells = np.concatenate([at * codes + left, at[right >= 0] * codes + right[right >= 0]])
            cells, n = np.unique(cells, return_counts=True)
            out = np.zeros(len(cells), dtype=CONTEXT)
            out["code"], out["n"] = cells % codes, n
            offsets = np.searchsorted(cells, np.arange(len(h) + 1) * codes)
            batch = pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(cls[first].astype(np.int32)), _binary(out, offsets)], schema=schema)
            for k in range(0, batch.num_rows, 1 << 16):
                yield batch.slice(k, 1 << 16)

        parts, size = [], 0
        for _, words, counts in _grouped(rows_of(batches, "text")):
            kind = model.types(words)[2]
            h, kind = _ended(words["h"], counts, 0), _ended(kind, counts, END)
            cls = model.class_of[kind]
            before, after = _before(cls, end), np.append(cls[1:], end)
            again = (h == _before(h, 0)) & (kind != END) & (_before(kind, END) != END)
            left = np.where(again, codes - 1, before)
            right = np.where(np.append(again[1:], False), -1, classes + after)  # counted with the next
            rest = np.flatnonzero((kind >= FREQUENT) & (kind != END))
            if not len(rest):
                continue
            parts.append((h[rest], *(x[rest].astype(np.int16) for x in (cls, left, right))))
            size += len(rest)
            if size >= FLUSH // 8:  # a word stands in two contexts, each counted with its class
                yield from summed(parts)
                parts, size = [], 0
        if parts:
            yield from summed(parts)

    return train.select("text").mapInArrow(count, "h long, cls int, contexts binary")


def _reclassed(contexts: DataFrame, pair: np.ndarray) -> DataFrame:
    """h, n, cls of every word of ``contexts``: the class of the best gain."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("cls", pa.int32())])
    classes = len(pair)
    codes = 2 * classes + 1

    def placed(h, cls, sizes, cells):
        """Of whole words, in the order of h."""
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        word = np.repeat(np.searchsorted(first, np.arange(len(h)), "right") - 1, sizes)
        key, at = np.unique(word * codes + cells["code"], return_inverse=True)
        word, code, n = key // codes, key % codes, np.bincount(at, weights=cells["n"]).astype(np.int64)
        times = np.bincount(word, weights=n * ((code < classes) | (code == codes - 1))).astype(np.int64)  # a word follows something each time
        ends = np.searchsorted(word, np.arange(1, len(first) + 1))
        best, done = [], 0
        while done < len(first):
            start = ends[done - 1] if done else 0
            to = max(done + 1, int(np.searchsorted(ends, start + CELLS, "right")))
            e = slice(start, ends[to - 1])
            best.append(best_classes(pair, cls[first][done:to].astype(np.int64), word[e] - done, code[e], n[e]))
            done = to
        return pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(times), pa.array(np.concatenate(best).astype(np.int32))], schema=schema)

    def run(batches):
        kept = None  # the last word, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(2).to_pylist()
            now = (batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                   np.array([len(x) // CONTEXT.itemsize for x in parts]), np.frombuffer(b"".join(parts), dtype=CONTEXT))
            if kept is not None:
                now = tuple(np.concatenate(x) for x in zip(kept, now))
            h, cls, sizes, cells = now
            last = int(np.argmax(h == h[-1]))
            cut = int(sizes[:last].sum())
            if last:
                yield placed(h[:last], cls[:last], sizes[:last], cells[:cut])
            kept = h[last:], cls[last:], sizes[last:], cells[cut:]
        if kept is not None:
            yield placed(*kept)

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, "h long, n long, cls int")


def classify(train: DataFrame, slots: int = SLOTS, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model without its transitions, and the table of all words: h, n,
    cls."""
    spark = train.sparkSession
    counts = stage(_counts(train), "word_counts")
    words, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    ends = train.count()
    # the most frequent words of the whole table have a type of their own
    top = [tuple(r) for r in counts.where("n > 1").orderBy(F.desc("n"), "h").limit(FREQUENT).select("h", "n").collect()]
    top_hash = np.array([h for h, _ in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(top_hash)
    none = np.zeros(2, dtype=np.int64)
    model = Model(none.view(np.uint64), none, none.astype(np.uint8), top_hash[order], order, np.zeros(TYPES, np.int64), None, None, int(total) + ends, int(words) + (ends > 0), ends)
    pairs = _bigrams(train, spark.sparkContext.broadcast(model))
    of = exchange(pairs, classes, END)
    member = np.zeros((TYPES, classes))
    member[np.arange(TYPES), of] = 1
    model.class_of = np.concatenate([of, np.arange(classes)])
    # every other word by its own contexts
    rest = _reclassed(_contexts(train, spark.sparkContext.broadcast(model)), member.T @ pairs @ member)
    frequent = spark.createDataFrame([(h, n, int(of[k])) for k, (h, n) in enumerate(top)], "h long, n long, cls int")
    classed = stage(rest.unionByName(frequent), "word_classes")
    pair = F.col("h").bitwiseAND(slots // 2 - 1)
    best = classed.withColumn("k", F.row_number().over(Window.partitionBy(pair).orderBy(F.desc("n"), "h"))).where("k <= 2").select(
        (pair * 2 + F.col("k") - 1).alias("slot"), "n", "h", "cls").toArrow()  # a row a slot
    slot, n, h, cls = (best.column(c).to_numpy() for c in ("slot", "n", "h", "cls"))
    model.slot_hash, model.slot_count, model.slot_class = np.zeros(slots, dtype=np.uint64), np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.uint8)
    model.slot_hash[slot], model.slot_count[slot], model.slot_class[slot] = h.view(np.uint64), n, cls
    of_class = np.zeros(classes)
    for r in classed.groupBy("cls").agg((F.sum("n") + F.count("*")).alias("size")).collect():
        of_class[r.cls] = r["size"]
    model.log_total = np.log10(of_class + 1)
    return model, classed


def paths(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, the classes of its words (a byte each), the number of known
    words and the sum of their logs, of every row; on disk."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    outside = pa.struct([("h", pa.int64()), ("at", pa.binary())])  # a word in no slot, and its places
    schema = pa.schema([("doc_id", pa.int64()), ("path", pa.binary()), ("known", pa.int64()), ("logs", pa.float64()), ("rest", pa.list_(outside))])

    def run(batches):
        model = held.value
        for rows, words, counts in _grouped(rows_of(batches, "doc_id", "text")):
            slot, there, kind = model.types(words)
            size, starts = len(rows), np.concatenate([[0], np.cumsum(counts)])
            doc = np.repeat(np.arange(size), counts)
            logs = np.bincount(doc[there], weights=np.log10(model.slot_count[slot[there]] + 1.0), minlength=size)
            miss = np.flatnonzero(~there)
            miss = miss[np.lexsort((words["h"][miss], doc[miss]))]
            d, h, at = doc[miss], words["h"][miss], (miss - starts[doc[miss]]).astype("<i4")
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(d)), bool), (d[1:] != d[:-1]) | (h[1:] != h[:-1])]))
            rest = pa.StructArray.from_arrays([pa.array(h[first].view(np.int64)), _binary(at, np.append(first, len(at)))], fields=list(outside))
            lists = np.searchsorted(d[first], np.arange(size + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], type=pa.int64()), _binary(model.class_of[kind].astype(np.uint8), starts),
                pa.array(np.bincount(doc[there], minlength=size).astype(np.int64)), pa.array(logs), pa.ListArray.from_arrays(pa.array(lists), rest)], schema=schema)

    ddl = "doc_id long, path binary, known long, logs double, rest array<struct<h:long,at:binary>>"
    some = stage(docs.select("doc_id", "text").mapInArrow(run, ddl).withColumn("row", F.monotonically_increasing_id()), "paths")
    rest = some.select("row", F.explode("rest").alias("w")).select("row", "w.h", "w.at", (F.length("w.at") / 4).cast("long").alias("times"))
    found = rest.join(counts.select("h", "n", "cls"), "h").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("more_logs"), F.sum("times").alias("more_known"),
        F.collect_list(F.struct("cls", "at")).alias("places"))
    whole = some.drop("rest").join(found, "row", "left").select(
        "doc_id", "path", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("known"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"), "places")
    full = pa.schema([("doc_id", pa.int64()), ("path", pa.binary()), ("known", pa.int64()), ("logs", pa.float64())])

    def fill(batches):
        for batch in batches:
            path, counts = _path(batch.column(1))
            starts, places = np.concatenate([[0], np.cumsum(counts)]), batch.column(4)
            lists = places.value_lengths().fill_null(0).to_numpy()
            cls, at = places.flatten().flatten()
            at = at.to_pylist()
            times = np.array([len(x) // 4 for x in at], dtype=np.int64)
            start = np.repeat(np.repeat(starts[:-1], lists), times)
            path[start + np.frombuffer(b"".join(at), dtype="<i4")] = np.repeat(cls.to_numpy(), times)
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(path, starts), batch.column(2), batch.column(3)], schema=full)

    return stage(whole.mapInArrow(fill, "doc_id long, path binary, known long, logs double"), "whole_paths")


def _path(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all rows, and their number a row."""
    held = column.to_pylist()
    return np.frombuffer(bytearray(b"".join(held)), dtype=np.uint8), np.array([len(x) for x in held], dtype=np.int64)


def estimate(model: Model, train: DataFrame) -> None:
    """The model's transitions, counted over the paths ``train``."""
    classes, end = len(model.log_total), int(model.class_of[END])
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def count(batches):
        total = np.zeros(classes * classes, dtype=np.int64)
        for batch in batches:
            path, counts = _path(batch.column(0))
            b = _ended(path, counts, end).astype(np.int64)
            total += np.bincount(_before(b, end) * classes + b, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], schema=schema)

    got = train.select("path").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    between = np.zeros(classes * classes)  # classes squared cells
    between[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    between = between.reshape(classes, classes)
    share = (between.sum(axis=0) + 1) / (between.sum() + classes)
    model.log_next = np.log10((between + PULL * share) / (between.sum(axis=1, keepdims=True) + PULL))


def values(whole: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every path."""
    log_next, log_total, end = model.log_next, model.log_total, int(model.class_of[END])
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("part", pa.float64())])

    def run(batches):
        for batch in batches:
            path, counts = _path(batch.column(1))
            b = _ended(path, counts, end).astype(np.int64)
            each = log_next[_before(b, end), b] - log_total[b]  # of the end's class, log_total is 0
            part = np.bincount(np.repeat(np.arange(len(counts)), counts + 1), weights=each, minlength=len(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts + 1), batch.column(2), batch.column(3), pa.array(part)], schema=schema)

    at_end = float(np.log10(model.ends + 1.0))
    each = float(np.log10(model.tokens + model.distinct + 1.0))
    scored = whole.select("doc_id", "path", "known", "logs").mapInArrow(run, "doc_id long, n_tokens long, known long, logs double, part double")
    return scored.select(
        "doc_id", "n_tokens", (F.col("known") + F.lit(int(model.ends > 0))).alias("n_known"),
        (F.col("logs") + F.lit(at_end) - F.col("n_tokens") * F.lit(each)).alias("base_score"), (F.col("logs") + F.col("part")).alias("score"))


def fit(train: DataFrame, slots: int = SLOTS, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model, and the table of all words: h, n, cls."""
    model, counts = classify(train, slots, classes)
    estimate(model, paths(train.select(F.lit(None).cast("long").alias("doc_id"), "text"), model, counts))
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row."""
    return values(paths(docs, model, counts), model)


def scored(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = F.col("doc_id").isNotNull() & ~held_out()
    model, counts = classify(docs.where(learned))
    whole = paths(docs, model, counts)  # of all rows, once: the transitions and the scores follow from it
    estimate(model, whole.where(learned))
    return values(whole, model).select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
