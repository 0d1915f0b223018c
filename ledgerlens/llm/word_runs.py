"""Operator 12: periodic runs of words by seeds and extended diagonals.

A run is a stretch of consecutive words of one document with smallest period
q, at least ``LEAST`` words and ``REPEATS`` periods long, that no neighbouring
word extends.  Its words equal those q places on for at least
``max(LEAST - q, 2 q)`` places: the overlap that every run of that period
guarantees.  So lags are dealt into classes ``[a, b)``, and a class indexes
the k-grams of its least overlap k (16 for lags 1 to 8, else 2a).

* Seeds: for every occurrence of a k-gram, its next occurrence at least ``a``
  words on, if that is less than ``b`` on.  A k-gram of a run with period q in
  the class has no period of ``2a - q`` or less, so between ``a`` and
  ``b <= (3a + 2) / 2`` it occurs at q alone: no run is missed, and a text of
  one repeated word has one seed a place and class, not a pair for every two
  places.
* k-grams are named exactly from class to class: a longer one is the pair of
  the two shorter ones that cover it, and only places whose k-gram occurs
  again stay in the index.
* Extension: the seeds of a lag are taken in order of place; a table of the
  furthest place covered on each lag skips those that an earlier extension has
  covered.  Each extension is compared word by word in both directions.
* Of stretches with the same ends the least lag is the period.

Documents are independent, so Spark deals them out and nothing is shuffled;
a task works on groups of documents of about ``GROUP`` bytes together, and a
longer document is a group of its own (memory linear in its length, time n log
n).

Null and empty texts and texts without words have no runs and keep no words.
Rows are judged one by one: repeated rows and null doc_ids are rows of their
own.  Columns other than doc_id and text play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import emit, in_groups, mix64, rows_of

LEAST = 24
REPEATS = 3
SHORT = LEAST // REPEATS       # lags up to here share the first class
GRAM = LEAST - SHORT           # and its k-grams
GROUP = 4 << 20

_PLACE = np.random.default_rng(20240512).integers(0, 2**64, GRAM, dtype=np.uint64) | np.uint64(1)


def lag_classes(longest: int):
    """(a, b, k) for all lags up to a third of ``longest`` words."""
    yield 1, SHORT + 1, GRAM
    a = SHORT + 1
    while a <= longest // REPEATS:
        b = (3 * a + 2) // 2
        yield a, b, 2 * a
        a = b


def _coded(documents: list[list[bytes]]):
    """All words as numbers in one array, each document ended by a number of
    its own; the documents' first places and lengths."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    codes = np.empty(int(sizes.sum()) + len(documents), dtype=np.int64)
    for k, (at, words) in enumerate(zip(starts.tolist(), documents)):
        codes[at:at + len(words)] = [number.setdefault(w, len(number)) for w in words]
        codes[at + len(words)] = -1 - k
    return codes, starts, sizes


def _first_index(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Places (ascending) whose GRAM words occur again in the document, with
    a number for each such k-gram."""
    n = len(codes) - GRAM
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = mix64(codes.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    grams = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        grams += mixed[k:n + k] * _PLACE[k]
    owner = np.repeat(np.arange(len(starts)), sizes + 1)[:n]
    place = np.flatnonzero(np.arange(n) + GRAM <= (starts + sizes)[owner])
    h = mix64(grams[place] + mix64(owner[place].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.append(True, h[1:] != h[:-1])
    again = ~new
    again[:-1] |= ~new[1:]
    name = np.empty(len(place), dtype=np.int64)
    name[order] = np.cumsum(new)
    live = np.zeros(len(place), dtype=bool)
    live[order] = again
    return place[live], name[live]


def _seeds(place: np.ndarray, name: np.ndarray, a: int, b: int, total: int):
    """lag * total + place of every seed, ascending, and which places have
    their k-gram again ``b`` words on or more."""
    order = np.argsort(name * total + place)
    place, name = place[order], name[order]
    key = name * total + place
    at = np.searchsorted(key, key + a)
    found = at < len(key)
    at[~found] = 0
    found &= name[at] == name
    lag = np.where(found, place[at] - place, 0)
    found &= lag < b
    seeds = np.sort(lag[found] * total + place[found])
    first = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(name)) - 1
    wide = np.repeat(place[last] - place[first] >= b, last - first + 1)
    rest = np.zeros(len(order), dtype=bool)
    rest[order] = wide
    return seeds, rest


def _longer(place: np.ndarray, name: np.ndarray, more: int, total: int):
    """The index of k-grams ``more`` words longer (at most twice as long)."""
    at = np.full(total + more, -1, dtype=np.int64)
    at[place] = name
    second = at[place + more]
    ok = second >= 0
    place, pair = place[ok], name[ok] * (int(name.max(initial=0)) + 1) + second[ok]
    _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
    again = count[name] > 1
    return place[again], name[again].astype(np.int64)


def _matching(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """Words equal to those ``lag`` places on, from ``at`` in one direction."""
    done, size = 0, 64
    while True:
        if step > 0:
            x, y = codes[at + done:at + done + size], codes[at + lag + done:at + lag + done + size]
            x = x[:len(y)]
        else:
            low = max(0, at - done - size + 1)
            x, y = codes[low:at - done + 1][::-1], codes[low + lag:at + lag - done + 1][::-1]
        differ = x != y
        if differ.any():
            return done + int(differ.argmax())
        done += len(x)
        if len(x) < size:
            return done
        size *= 2


def extended(codes: np.ndarray, seeds: np.ndarray, gram: int, furthest: dict[int, int]):
    """(start, end, lag) of the stretches through the seeds; ``furthest`` is
    the table of the places covered on each lag."""
    if not len(seeds):
        return
    total = len(codes)
    cut = np.flatnonzero(np.append(True, np.diff(seeds) != 1))
    ends = np.append(cut[1:], len(seeds)) - 1
    for lag, at, last in zip((seeds[cut] // total).tolist(), (seeds[cut] % total).tolist(), (seeds[ends] % total).tolist()):
        at = max(at, furthest.get(lag, 0))
        while at < last + gram:  # one step, but where names met by chance
            ahead = _matching(codes, at, lag, 1)
            if ahead:
                start, end = at - _matching(codes, at, lag, -1) + 1, at + ahead
                furthest[lag] = end
                yield start, end, lag
            at += ahead + 1


def find_runs(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each document's runs, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    codes, starts, sizes = _coded(documents)
    total = len(codes)
    place, name = _first_index(codes, starts, sizes)
    found: list[tuple[int, int, int]] = []
    held = None
    for a, b, gram in lag_classes(int(sizes.max(initial=0))):
        if held is not None and len(place):
            long = sizes[np.searchsorted(starts, place, "right") - 1] >= REPEATS * a
            place, name = _longer(place[long], name[long], gram - held, total)
        if not len(place):
            break
        seeds, rest = _seeds(place, name, a, b, total)
        for start, end, lag in extended(codes, seeds, gram, {}):
            if end - start + lag >= max(LEAST, REPEATS * lag):
                found.append((start, end - start + lag, lag))
        place, name, held = place[rest], name[rest], gram
    least: dict[tuple[int, int], int] = {}
    for start, length, lag in found:
        least[start, length] = min(lag, least.get((start, length), lag))
    owners = np.searchsorted(starts, [s for s, _ in least], "right") - 1
    for k, ((start, length), period) in zip(owners.tolist(), least.items()):
        out[k].append((start - int(starts[k]), length, period))
    for rows in out:
        rows.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Each run's first period stays, unless another run drops it."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, gone in zip(words, np.cumsum(edge[:-1]).tolist()) if not gone]


def with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's input: documents whose crc32 ends in 0 repeat a block
    to their end."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


# ------------------------------------------------------------------ Spark

def periodic_runs(docs: DataFrame, words_of=None) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and
    kept_text (the words that stay, joined by a space) of every row.
    ``words_of(doc_id, words)`` may change a document's words before."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("kept_text", pa.string())])

    def search(batches):
        def rows():
            for held in in_groups(rows_of(batches, "doc_id", "text"), lambda r: len(r[1] or ""), GROUP):
                ids = [i for i, _ in held]
                words = [t.encode("utf-8", "surrogatepass").split() if t else [] for _, t in held]
                if words_of is not None:
                    words = [words_of(i, w) for i, w in zip(ids, words)]
                for i, w, runs in zip(ids, words, find_runs(words)):
                    named = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                    yield i, named, b" ".join(kept_words(w, runs)).decode("utf-8", "replace")

        yield from emit(schema, rows())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, "doc_id long, runs array<struct<start:long,length:long,period:long>>, kept_text string")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns."""
    runs = F.col("runs")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    kind = found.schema["runs"].dataType.elementType
    best = F.aggregate(runs, F.lit(None).cast(kind), lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


# The same in SQL: all pairs of equal 16-grams of a document, as islands of
# consecutive places on a lag.  crc32 bit by bit: 3988292384 is its polynomial.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
c AS (
  SELECT k, doc_id, ws, len(ws) AS n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) AS h FROM d),
g AS (SELECT *, (h // 10) % greatest(n, 1) AS a, (h // 10) % 8 AS r FROM c),
w AS MATERIALIZED (
  SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1]
    ELSE ws[a + (i - a) % (1 + (n - a) // (3 + r)) + 1] END) ELSE ws END AS ws FROM g),
grams AS MATERIALIZED (
  SELECT k, n, i, md5(array_to_string(ws[i + 1:i + 16], ' ')) AS gram FROM (SELECT k, n, ws, unnest(range(n - 15)) AS i FROM w WHERE n >= 24)),
same AS (SELECT x.k, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.k = y.k AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
island AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS part FROM same),
stretch AS (SELECT k, q, min(i) AS s, count(*) + 15 + q AS length FROM island GROUP BY k, q, part),
runs AS MATERIALIZED (SELECT k, s, length, min(q) AS q FROM stretch WHERE length >= greatest(24, 3 * q) GROUP BY k, s, length),
told AS (SELECT k, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY k),
best AS (
  SELECT k, s, length, q FROM (
    SELECT k, s, length, q, row_number() OVER (PARTITION BY k ORDER BY (1000000000 * CAST(length AS HUGEINT) * 1000000000) // q DESC, s, q) AS place FROM runs) WHERE place = 1),
gone AS (SELECT k, list(DISTINCT p) AS ps FROM (SELECT k, unnest(range(s + q, s + length)) AS p FROM runs) GROUP BY k)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(s AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * length // q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(list_transform(ws, lambda x, i: CASE WHEN list_contains(ps, i - 1) THEN NULL ELSE x END), lambda x: x IS NOT NULL) END, ' '), '')) AS collapsed_sha256
FROM w LEFT JOIN told USING (k) LEFT JOIN best USING (k) LEFT JOIN gone USING (k)
"""
