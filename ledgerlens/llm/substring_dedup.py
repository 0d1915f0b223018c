"""Operator 5: repeated passages by sharded, compressed FM-indexes.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a
window covers it whose word sequence also starts in a document with a
smaller doc_id.  Documents are judged as they came in.

A shard must see every occurrence of the windows it decides, and no more, so
shards are cut by content: a window's minimiser is the least hash of its
``KMER``-word parts, consecutive windows with one minimiser form a run, and a
run goes to the shard of its minimiser.

1. Every document sends its distinct minimisers, as packed hashes a bucket.
   A bucket finds those of two documents or more and writes them in its slice
   of a bit table; the table's size is capped (``TABLE_BITS``), and past that
   it only lets more runs through.
2. Runs that pass the table are grouped in their task by content: each
   distinct run once with its smallest doc_id, and its places apart, packed
   in one row a shard.
3. A shard's distinct runs make one FM-index: suffixes sorted to the window's
   depth, their BWT in a wavelet matrix with packed bits and block counts.
   Runs are streamed through it: backward search extends each position's
   match word by word (matching statistics up to the threshold) and keeps the
   suffix interval of those that reach it; a position whose interval is down
   to one suffix has met only itself and is done.  The least doc_id of the
   interval decides; places of the run become removed word ranges.  A shard
   holds only its distinct runs; places stream by.
4. Ranges meet their documents, and words are removed.

Words are compared by 64-bit hashes, which a packed row holds once each.  Null
and empty texts have no words.  A null doc_id is neither smaller nor larger than
another: such rows keep all words and remove none.  Rows that repeat a
doc_id are told apart by their texts and remove nothing from each other.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import emit, hashed_words, in_groups, mix64, rows_of

WINDOW = 13
KMER = 6
TABLE_BITS = 1 << 29
FLUSH = 16 << 20  # characters that a task groups at a time
_SPACES = bytes(32 if 9 <= i <= 13 else i for i in range(256))
_PLACE = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("at", "<u4")])


def split_words(text: str | None) -> list[bytes]:
    """UTF-8 words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return [w for w in text.encode("utf-8", "surrogatepass").translate(_SPACES).split(b" ") if w] if text else []


def minimisers(h: np.ndarray, window: int = WINDOW, kmer: int = KMER) -> np.ndarray:
    """The least part hash of each window (none if there are too few words)."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    parts = np.zeros(len(h) - kmer + 1, dtype=np.uint64)
    for k in range(kmer):
        parts += h[k:len(h) - kmer + 1 + k] * np.uint64(2 * k + 0x9E3779B97F4A7C15)
    least, span, want = mix64(parts), 1, window - kmer + 1
    while 2 * span <= want:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < want:
        least = np.minimum(least[:n], least[want - span:])
    return least


class Corpus:
    """Hashed words of some documents, end to end, and their runs."""

    def __init__(self, texts: list[str]):
        self.h, counts = hashed_words(texts, _SPACES)
        ends = np.cumsum(counts)
        self.first = ends - counts  # of each document
        self.least = minimisers(self.h)
        n = len(self.least)
        owner = np.repeat(np.arange(len(texts)), counts)[:n]
        inside = np.arange(n) + WINDOW <= ends[owner]
        new = np.ones(n, dtype=bool)
        new[1:] = (self.least[1:] != self.least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
        # a run: its first window, its windows, its document
        at = np.flatnonzero(new & inside)
        stop = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)[:n])
        self.at, self.windows, self.doc = at, stop - at + 1, owner[at]
        self.m = self.least[at]

    def contents(self, some: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences of some runs."""
        n = self.windows[some] + WINDOW - 1
        step = np.uint64(0x9E3779B97F4A7C15)
        longest = int(n.max(initial=0))
        if longest <= 64:  # sums over each word's place in the run
            out, power = np.zeros(len(some), dtype=np.uint64), np.uint64(1)
            for k in range(longest):
                inside = n > k
                out[inside] += mix64(self.h[self.at[some[inside]] + k]) * power
                power *= step
        else:
            import xxhash

            out = np.array([xxhash.xxh3_64_intdigest(self.h[a:a + b].tobytes()) for a, b in zip(self.at[some].tolist(), n.tolist())], dtype=np.uint64)
        return mix64(out + n.astype(np.uint64))


# --------------------------------------------------------------- FM-index

class WaveletMatrix:
    """Symbol counts before a place, by one packed bit row a symbol bit."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.n, self.levels = len(symbols), max(1, int(top).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = ((symbols >> level) & 1).astype(np.uint8)
            packed = np.zeros(self.n // 64 + 1, dtype=np.uint64)
            packed.view(np.uint8)[: -(-self.n // 8)] = np.packbits(bit, bitorder="little")
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(self.n - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        every = np.arange(top + 1)
        self.start = self._down(every, np.zeros(top + 1, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            word, inside = at >> 6, (at & 63).astype(np.uint64)
            ones = self.ones[k][word] + np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << inside) - np.uint64(1)))
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.start[symbol]


class FmIndex:
    """Over word sequences, for patterns of at most ``depth`` words."""

    def __init__(self, texts: list[np.ndarray], depth: int = WINDOW):
        self.depth = depth
        self.words, coded = np.unique(np.concatenate(texts), return_inverse=True)
        ends = np.cumsum([len(t) + 1 for t in texts])
        text = np.zeros(int(ends[-1]), dtype=np.int64)  # 0 ends a sequence
        inside = np.ones(len(text), dtype=bool)
        inside[ends - 1] = False
        text[inside] = coded + 1
        rank, span = text, 1
        while span < depth:  # suffixes by their first 1, 2, 4 ... words
            after = np.concatenate([rank[span:], np.zeros(min(span, len(rank)), np.int64)])[: len(rank)]
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
            span *= 2
        order = np.argsort(rank, kind="stable")
        self.owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[order]  # the text of each suffix
        top = len(self.words)
        self.wavelet = WaveletMatrix(text[order - 1], top)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.n = len(text)

    def symbols(self, seq: np.ndarray) -> np.ndarray:
        """The index's symbols of words; -1 for words it doesn't hold."""
        at = np.minimum(np.searchsorted(self.words, seq), len(self.words) - 1)
        return np.where(self.words[at] == seq, at + 1, -1)

    def matching_statistics(self, symbols: np.ndarray, ends: np.ndarray, limits: np.ndarray, indexed: bool = False):
        """For matches that end at ``ends`` and reach back ``limits`` words at
        most (and ``depth``): their length, and suffix interval [lo, hi).
        Of ``indexed`` sequences a match of one suffix is the sequence itself:
        it is not followed to its full length."""
        length = np.zeros(len(ends), dtype=np.int64)
        lo, hi = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.n, dtype=np.int64)
        alive = np.arange(len(ends))
        for k in range(self.depth):
            alive = alive[limits[alive] > k]
            c = symbols[ends[alive] - k]
            alive, c = alive[c > 0], c[c > 0]
            a = self.before[c] + self.wavelet.rank(c, lo[alive])
            b = self.before[c] + self.wavelet.rank(c, hi[alive])
            ok = a < b
            alive = alive[ok]
            lo[alive], hi[alive] = a[ok], b[ok]
            length[alive] += 1
            if indexed:
                alive = alive[hi[alive] - lo[alive] > 1]
            if not len(alive):
                break
        return length, lo, hi


def least_owners(texts: list[np.ndarray], docs: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """Of each text's windows, the least doc_id of a text that holds it: all
    texts are indexed, then streamed."""
    index = FmIndex(texts, window)
    flat = index.symbols(np.concatenate(texts))
    starts = np.cumsum([0] + [len(t) for t in texts])
    ends = np.concatenate([np.arange(a + window - 1, b) for a, b in zip(starts, starts[1:])])
    length, lo, hi = index.matching_statistics(flat, ends, np.full(len(ends), window), indexed=True)
    held = docs[index.owner]
    least = held[lo]  # of a single suffix, and of one document's repeats
    many = np.flatnonzero(hi - lo > 1)
    if len(many):
        if not (length[many] == window).all():
            raise AssertionError("a text's own window is missing from its index")
        uniq, at, back = np.unique(lo[many], return_index=True, return_inverse=True)
        cut = np.column_stack([uniq, hi[many][at]]).ravel()  # intervals of equal length are equal or apart
        least[many] = np.minimum.reduceat(np.append(held, 2**63 - 1), cut)[::2][back]
    return np.split(least, np.cumsum([len(t) - window + 1 for t in texts])[:-1])


# ------------------------------------------------------------------ Spark

def _buckets(n_docs: int) -> int:
    return 1 << max(4, min(16, (n_docs // 500).bit_length()))


def _place(m: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """A minimiser's bit: the bucket's slice, then a place inside it."""
    slice_bits = np.uint64(bits // buckets)
    return (m % np.uint64(buckets)) * slice_bits + (m // np.uint64(buckets)) % slice_bits


def _repeated(docs: DataFrame, buckets: int, bits: int, flush: int) -> np.ndarray:
    """The bit table of minimisers that two documents or more hold."""
    schema = pa.schema([("bucket", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])

    def gather(batches):
        def rows():
            for held in in_groups(rows_of(batches, "text"), lambda r: len(r[0] or ""), flush):
                corpus = Corpus([t for t, in held])
                if not len(corpus.m):
                    continue
                # minimisers by their first run; more, if a later one is another document's
                order = np.lexsort((corpus.doc, corpus.m))
                m, doc = corpus.m[order], corpus.doc[order]
                first = np.flatnonzero(np.append(True, m[1:] != m[:-1])[:len(m)])
                last = np.append(first[1:], len(m)) - 1
                m, many = m[first], doc[first] != doc[last]
                bucket = (m % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                m, many, bucket = m[order], many[order], bucket[order]
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in np.unique(bucket).tolist():
                    mine, more = m[cut[b]:cut[b + 1]], many[cut[b]:cut[b + 1]]
                    yield b, mine[~more].tobytes(), mine[more].tobytes()

        yield from emit(schema, rows())

    out = pa.schema([("bucket", pa.int64()), ("slice", pa.binary())])

    def decide(batches):
        def slice_of(bucket, once, more):
            m, n = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in once]), return_counts=True)
            m = np.concatenate([m[n > 1], *(np.frombuffer(b, np.uint64) for b in more)])
            row = np.zeros(bits // buckets, dtype=np.uint8)
            row[(_place(m, buckets, bits) - np.uint64(bucket * (bits // buckets))).astype(np.int64)] = 1
            return bucket, np.packbits(row, bitorder="little").tobytes()

        def rows():
            key, once, more = None, [], []
            for bucket, a, b in rows_of(batches, "bucket", "once", "more"):
                if bucket != key:
                    if once:
                        yield slice_of(key, once, more)
                    key, once, more = bucket, [], []
                once.append(a)
                more.append(b)
            if once:
                yield slice_of(key, once, more)

        yield from emit(out, rows())

    slices = docs.select("text").mapInArrow(gather, "bucket long, once binary, more binary") \
        .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(decide, "bucket long, slice binary")
    table = np.zeros(bits // 8, dtype=np.uint8)
    for row in slices.collect():  # bits / 8 bytes in all
        at = row.bucket * (bits // buckets // 8)
        table[at:at + len(row.slice)] = np.frombuffer(row.slice, np.uint8)
    return table


def _candidates(docs: DataFrame, table, buckets: int, bits: int, shards: int, flush: int) -> DataFrame:
    """Distinct runs (kind 0: hashes, least doc_ids, lengths, words as
    distinct hashes and places among them) and their places
    (kind 1: hashes, counts, places) of each task, packed by shard."""
    schema = pa.schema([("shard", pa.int64()), ("kind", pa.int64()), ("data", pa.binary())])

    def gather(batches):
        bit_table = table.value

        def rows():
            for held in in_groups(rows_of(batches, "doc_id", "text"), lambda r: len(r[1] or ""), flush):
                corpus = Corpus([t for _, t in held])
                place = _place(corpus.m, buckets, bits).astype(np.int64)
                hit = np.flatnonzero((bit_table[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
                if not len(hit):
                    continue
                ids = np.array([i for i, _ in held], dtype=np.int64)
                crcs = np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) if t else 0 for _, t in held], dtype=np.uint32)
                shard, run = (mix64(corpus.m[hit]) % np.uint64(shards)).astype(np.int64), corpus.contents(hit)
                order = np.lexsort((ids[corpus.doc[hit]], run, shard))
                hit, shard, run = hit[order], shard[order], run[order]
                places = np.zeros(len(hit), dtype=_PLACE)
                places["doc"], places["crc"] = ids[corpus.doc[hit]], crcs[corpus.doc[hit]]
                places["at"] = corpus.at[hit] - corpus.first[corpus.doc[hit]]
                first = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (shard[1:] != shard[:-1]))[:len(hit)])
                count = np.diff(np.append(first, len(hit)))
                n = corpus.windows[hit[first]] + WINDOW - 1
                words = corpus.h[np.repeat(corpus.at[hit[first]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                start = np.cumsum(n) - n
                cut = np.append(np.flatnonzero(np.append(True, shard[first][1:] != shard[first][:-1])[:len(first)]), len(first))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    here, some = int(shard[first[a]]), run[first[a:b]].tobytes()
                    yield here, 0, pack(some, places["doc"][first[a:b]].tobytes(), n[a:b].astype("<u4").tobytes(),
                                        *coded(words[start[a]:start[b - 1] + n[b - 1]]))
                    yield here, 1, pack(some, count[a:b].astype("<u4").tobytes(), places[first[a]:first[b - 1] + count[b - 1]].tobytes())

        yield from emit(schema, rows())

    return docs.where(F.col("doc_id").isNotNull()).mapInArrow(gather, "shard long, kind long, data binary")


def coded(words: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct hashes of words, and each word's place among them."""
    distinct, at = np.unique(words, return_inverse=True)
    return distinct.astype("<u8").tobytes(), at.astype("<u2" if len(distinct) <= 1 << 16 else "<u4").tobytes()


def decoded(distinct: bytes, at: bytes) -> np.ndarray:
    distinct = np.frombuffer(distinct, "<u8")
    return distinct[np.frombuffer(at, "<u2" if len(distinct) <= 1 << 16 else "<u4")]


def pack(*parts: bytes) -> bytes:
    return b"".join([np.array([len(parts), *map(len, parts)], dtype="<i8").tobytes(), *parts])


def unpack(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(data, "<i8", n, 8))
    return [data[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


class Shard:
    """Its distinct runs, and for each window the least doc_id."""

    def __init__(self, parts: list[bytes]):
        run, doc, n, distinct, at = zip(*map(unpack, parts))
        run = np.frombuffer(b"".join(run), np.uint64)
        doc, n = np.frombuffer(b"".join(doc), "<i8"), np.frombuffer(b"".join(n), "<u4").astype(np.int64)
        words = np.concatenate([decoded(*pair) for pair in zip(distinct, at)])
        start = np.cumsum(n) - n
        order = np.lexsort((doc, run))
        first = order[np.flatnonzero(np.append(True, run[order][1:] != run[order][:-1]))]
        self.run = run[first]
        least = least_owners([words[a:a + b] for a, b in zip(start[first].tolist(), n[first].tolist())], doc[first])
        self.windows = n[first] - WINDOW + 1
        self.start = np.cumsum(self.windows) - self.windows
        self.least = np.concatenate(least)

    def ranges(self, data: bytes):
        """doc, crc and removed word ranges of the places in one row."""
        run, count, places = unpack(data)
        places = np.frombuffer(places, _PLACE)
        entry = np.repeat(np.searchsorted(self.run, np.frombuffer(run, np.uint64)), np.frombuffer(count, "<u4"))
        n = self.windows[entry]
        place = np.repeat(np.arange(len(places)), n)
        inner = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        gone = self.least[np.repeat(self.start[entry], n) + inner] < places["doc"][place]
        place, inner = place[gone], inner[gone]
        if not len(place):
            return
        # windows of one place that touch are one range
        new = np.append(True, (place[1:] != place[:-1]) | (inner[1:] > inner[:-1] + WINDOW))
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(place)) - 1
        pairs = np.column_stack([inner[a], inner[b] + WINDOW]) + places["at"][place[a]][:, None]
        at, key = place[a], places[place[a]]
        order = np.lexsort((at, key["crc"], key["doc"]))
        pairs, key = pairs[order].astype("<u4"), key[order]
        cut = np.append(np.flatnonzero(np.append(True, (key["doc"][1:] != key["doc"][:-1]) | (key["crc"][1:] != key["crc"][:-1]))), len(key))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield int(key["doc"][i]), int(key["crc"][i]), pairs[i:j].tobytes()


def _ranges(candidates: DataFrame) -> DataFrame:
    """Removed word ranges (packed first and end words) of documents."""
    schema = pa.schema([("doc_id", pa.int64()), ("crc", pa.int64()), ("ranges", pa.binary())])

    def search(batches):
        def rows():
            key, parts, shard = None, [], None
            for here, kind, data in rows_of(batches, "shard", "kind", "data"):
                if here != key:
                    key, parts, shard = here, [], None
                if kind == 0:
                    parts.append(data)
                    continue
                if shard is None:
                    shard, parts = Shard(parts), []
                yield from shard.ranges(data)

        yield from emit(schema, rows())

    return candidates.repartition("shard").sortWithinPartitions("shard", "kind") \
        .mapInArrow(search, "doc_id long, crc long, ranges binary")


def deduplicate(docs: DataFrame, table_bits: int = TABLE_BITS, flush: int = FLUSH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs = docs.count()
    buckets = _buckets(n_docs)
    bits = min(table_bits, max(buckets * 64, 1 << (512 * n_docs).bit_length()))
    table = spark.sparkContext.broadcast(_repeated(docs.where(F.col("doc_id").isNotNull()), buckets, bits, flush))
    ranges = _ranges(_candidates(docs, table, buckets, bits, max(16, n_docs // 500), flush))
    ranges = ranges.groupBy("doc_id", "crc").agg(F.collect_list("ranges").alias("ranges"))  # a document's own
    keyed = docs.withColumn("crc", F.crc32(F.col("text").cast("binary")))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def remove(batches):
        def rows():
            for doc_id, text, cut in rows_of(batches, "doc_id", "text", "ranges"):
                words = split_words(text)
                if not cut:
                    yield doc_id, len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass")
                    continue
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                pairs = np.frombuffer(b"".join(cut), "<u4").reshape(-1, 2)
                np.add.at(edge, pairs[:, 0], 1)
                np.add.at(edge, pairs[:, 1], -1)
                kept = np.cumsum(edge[:-1]) == 0
                left = [w for w, k in zip(words, kept.tolist()) if k]
                yield doc_id, len(words), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass")

        yield from emit(schema, rows())

    return keyed.join(ranges, ["doc_id", "crc"], "left").select("doc_id", "text", "ranges") \
        .mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text string")


def digest(deduplicated: DataFrame) -> DataFrame:
    """The query's columns."""
    return deduplicated.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def sha256_of(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


# The same in SQL over whole tables: each window's least doc_id, by equality.
ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, k, array_to_string(ws[k:k + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w WHERE len(ws) >= 13)),
least_doc AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, p FROM (
    SELECT win.doc_id, unnest(range(k, k + 13)) AS p FROM win JOIN least_doc USING (g) WHERE d < win.doc_id)),
g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""
