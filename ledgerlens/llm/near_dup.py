"""Operator 10: near duplicates by MinHash bands and odd sketches.

A document's set holds its distinct ``SHINGLE``-word shingles, as 64-bit
hashes.  Two kinds of MinHash sample describe it: ``BANDS`` bands of ``ROWS``
independent minima find candidates, and the ``SAMPLE`` least hashes (all, in a
smaller set) fold into a bitmap of ``SKETCH_BITS`` bits in which each flips one
bit (an odd sketch).  The population count of two sketches' XOR estimates how
many samples differ, most precisely where few do, and with the sets' sizes
their similarity.  Pairs estimated six standard deviations below the
threshold or more are confirmed on the full sets by integer counts.

At similarity 0.75 a pair shares no band with probability
(1 - 0.75^4)^32 < 6e-6, and less above.

Groups may be of any size:

* Equal sets are one node (grouped by a 128-bit digest), so exact copies
  never meet in pairs.
* Every bucket first links its members to one leader, the node whose buckets
  are the fullest (of a text and its copies, mostly the text); each node
  keeps its best such leader, one pair a node.
* In buckets that still hold more than one component, each component but the
  largest then meets its nearest node outside, one pair a component,
  ``ROUNDS`` times.  That joins a group of near copies in passes linear in its
  size.
* Last, all pairs that are left between the components of a bucket.  A bucket
  beyond ``BLOCK`` nodes is dealt into blocks, and each pair of blocks is one
  group, so memory has a bound and no pair is left out.

Null or empty text, or no words: an empty set, linked with nothing.  Null
doc_ids are no representatives unless a whole component has no other; such
rows have a null component and are kept.  Repeated rows fall into one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE_TABLE, broadcast_if_small, delete_tables, emit, free_name, hashed_words, in_groups, mix64, rows_of, stage, staged_tables
from ledgerlens.llm.components import components

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
SAMPLE = 512
SKETCH_BITS = 2048
LEAST_WHOLE, LEAST_SAMPLED = 0.69, 0.6  # estimates to confirm: sets within the sample, and larger ones
ROUNDS = 2
BLOCK = 4096

_rng = np.random.default_rng(20240229)
_PLACE = _rng.integers(0, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_TIMES = _rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_FLIP = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = hashed_words(texts, SPACE_TABLE)
    out = []
    for h in np.split(hashes, np.cumsum(counts)[:-1]):
        n = min(SHINGLE, len(h))
        mixed = np.full(max(0, len(h) - n + 1) if n else 0, n, dtype=np.uint64)
        for k in range(n):
            mixed += h[k:len(h) - n + 1 + k] * _PLACE[k]
        out.append(np.unique(mix64(mixed)))
    return out


def _sets(rows):
    """Rows that end in a text, with its set instead."""
    for held in in_groups(rows, lambda r: len(r[-1] or "")):
        for row, s in zip(held, shingle_sets([r[-1] for r in held])):
            yield *row[:-1], s


def samples(sets: np.ndarray, step: int = 2048) -> np.ndarray:
    """``HASHES`` minima, one a permutation."""
    low = (sets >> np.uint64(16)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(low), step):
        x = (low[i:i + step] ^ _FLIP[:, None]) * _TIMES[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def bands_of(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def odd_sketch(sets: np.ndarray) -> bytes:
    """Each of the least hashes flips one bit."""
    place = (mix64(sets[:SAMPLE] + np.uint64(1)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def estimate(odd: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of sets of ``n`` and ``m`` hashes whose sketches' XOR has
    ``odd`` bits: d differing samples leave B/2 (1 - exp(-2d/B)) of B bits."""
    differ = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * odd / SKETCH_BITS, 1e-9))
    a, b = np.minimum(n, SAMPLE), np.minimum(m, SAMPLE)
    both = np.maximum(0, (a + b - differ) / 2) / np.minimum(a / n, b / m)  # scaled up from the smaller rate
    return both / np.maximum(n + m - both, 1)


def likely(odd: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return estimate(odd, n, m) >= np.where(np.maximum(n, m) <= SAMPLE, LEAST_WHOLE, LEAST_SAMPLED)


def similar(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """The exact test on two packed sorted sets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


# ------------------------------------------------------------------ Spark

def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, node (digest of the set),
    bands, sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def sign(batches):
        import xxhash

        def rows():
            for doc_id, h, s in _sets(rows_of(batches, "doc_id", "h", "text")):
                if not len(s):
                    yield doc_id, h, 0, None, None, None
                    continue
                m = samples(s)
                yield doc_id, h, len(s), xxhash.xxh3_128_digest(s.tobytes()), bands_of(m).tolist(), odd_sketch(s)

        yield from emit(schema, rows())

    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(sign, "doc_id long, h long, n_shingles long, node binary, bands array<long>, sketch binary")


def _confirmed(pairs: DataFrame, docs: DataFrame, first_id: DataFrame) -> DataFrame:
    """Of node pairs (a, b), those that pass the exact test.  Only the
    texts in question are read again: each by one document of its node."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    schema = pa.schema([("node", pa.binary()), ("n", pa.int64()), ("shingles", pa.binary())])

    def expand(batches):
        import xxhash

        def rows():
            for (s,) in _sets(rows_of(batches, "text")):
                s = s.tobytes()
                yield xxhash.xxh3_128_digest(s), len(s) // 8, s

        yield from emit(schema, rows(), most_rows=512)

    wanted = broadcast_if_small(stage(nodes.join(first_id, "node").select("doc_id").distinct(), "wanted"))
    # a node of null ids alone is read from all rows with a null id
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select("text")
    sets = stage(texts.mapInArrow(expand, "node binary, n long, shingles binary").dropDuplicates(["node"]), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    out = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def test(batches):
        yield from emit(out, ((a, b) for a, b, sa, sb in rows_of(batches, "a", "b", "sa", "sb") if similar(sa, sb)))

    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "sa", "sb") \
        .mapInArrow(test, "a binary, b binary")


def _close(pairs: DataFrame) -> DataFrame:
    """Node pairs with sketches sa, sb and sizes na, nb that the estimate
    lets through, with their odd bits."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("odd", pa.int64())])

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
            a, b, na, nb = get("a"), get("b"), np.array(get("na")), np.array(get("nb"))
            x, y = (np.frombuffer(b"".join(get(c)), np.uint64).reshape(len(a), -1) for c in ("sa", "sb"))
            odd = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            yield from emit(schema, ((a[k], b[k], int(odd[k])) for k in np.flatnonzero(likely(odd, na, nb))))

    return pairs.mapInArrow(keep, "a binary, b binary, odd long")


def _within(rows: DataFrame, nearest: bool) -> DataFrame:
    """Pairs between components inside each bucket, by sketch: all, or the
    nearest of each component but the largest.  rows: bucket, node, comp,
    sketch, n, and bands for all pairs, which come out of the first bucket they
    share alone.  Blocks of a large bucket meet block by block."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"))
    dealt = rows.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                         (F.col("mine") > F.col("other")).alias("second"), "node", "comp", "sketch", "n", *([] if nearest else ["bands"]))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("odd", pa.int64())])

    columns = ["bucket", "lo", "hi", "node", "comp", "sketch", "n", "second", *([] if nearest else ["bands"])]

    def pairs_of(held, diagonal, bucket):
        node, comp, sketch, n, second, *bands = zip(*held)
        bands = None if nearest else np.array(bands[0], dtype=np.int64)
        x = np.frombuffer(b"".join(sketch), np.uint64).reshape(len(node), -1)
        code = np.unique(np.array(comp, dtype=object), return_inverse=True)[1]
        n, second = np.array(n), np.array(second)
        best: dict = {}
        largest = int(np.bincount(code).argmax()) if nearest else -1
        for i in range(len(node)):
            if code[i] == largest:
                continue
            other = code != code[i]
            if not diagonal:
                other &= second != second[i]
            if not nearest:
                other[:i] = False
            js = np.flatnonzero(other)
            if len(js):
                odd = np.bitwise_count(x[js] ^ x[i]).sum(axis=1, dtype=np.int64)
                ok = np.flatnonzero(likely(odd, n[js], n[i]))
                if not nearest:
                    shared = bands[js[ok]] == bands[i]
                    first = bands[i][shared.argmax(axis=1)] == bucket  # no earlier band has both
                    yield from ((node[i], node[js[k]], int(odd[k])) for k in ok[first])
                elif len(ok):
                    k = ok[np.argmin(odd[ok])]
                    best[code[i]] = min(best.get(code[i], (1 << 30, b"", b"")), (int(odd[k]), node[i], node[js[k]]))
        yield from ((a, b, odd) for odd, a, b in best.values())

    def search(batches):
        def found():
            key, held = None, []
            for bucket, lo, hi, *row in rows_of(batches, *columns):
                if key != (bucket, lo, hi):
                    if held:
                        yield from pairs_of(held, key[1] == key[2], key[0])
                    key, held = (bucket, lo, hi), []
                held.append(row)
            if held:
                yield from pairs_of(held, key[1] == key[2], key[0])

        yield from emit(schema, found())

    found = dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi") \
        .mapInArrow(search, "a binary, b binary, odd long")
    if nearest:
        found = found.groupBy("a").agg(F.min(F.struct("odd", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``
    (doc_id, text)."""
    signed, named = _grouped(docs)
    done = signed.select("doc_id", "n_shingles", "node").join(named.select("node", "component_id"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return done.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and node, root, component_id of every node."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(_signed(docs), "signed")
    some = signed.where(F.col("node").isNotNull())
    nodes = stage(some.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
                                           F.first("sketch").alias("sketch")), "nodes")
    sketches, first_id = nodes.select("node", "sketch", "n"), nodes.select("node", "doc_id")
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stage(members.join(sizes, "bucket"), "shared")  # buckets of two nodes or more
    weight = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = shared.select("bucket", "node").join(weight, "node")
    leaders = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("l")).select("bucket", F.col("l.node").alias("leader"))

    # one pair a node: its nearest leader by sketch
    led = shared.select("bucket", "node").join(leaders, "bucket").where("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    led = led.join(sketches.toDF("b", "sb", "nb"), "b").join(sketches.toDF("a", "sa", "na"), "a")
    best = _close(led).groupBy("b").agg(F.min(F.struct("odd", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    links = _confirmed_links(stage(best, "led"), None, docs, first_id)
    # a first label: a node's leader; nodes of one label are linked for sure
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))

    # what is left: buckets that hold more than one component
    for k in range(ROUNDS + 1):
        labelled = shared.select("bucket", "node").join(roots, "node", "left").select(
            "bucket", "node", F.coalesce("root", "node").alias("comp"))
        mixed = labelled.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
        last = k == ROUNDS
        rest = labelled.join(mixed, "bucket").join(nodes, "node").select("bucket", "node", "comp", "sketch", "n", *(["bands"] if last else []))
        links = _confirmed_links(stage(_within(rest, nearest=not last), "found"), links, docs, first_id)
        roots = stage(components(links, "a", "b"), "roots")

    grouped = nodes.select("node", "doc_id").join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return signed, grouped.join(least, "root").select("node", "root", "component_id")


def _confirmed_links(pairs: DataFrame, links: DataFrame | None, docs: DataFrame, first_id: DataFrame) -> DataFrame:
    """The written links, with those of ``pairs`` that pass; the sets in
    question are deleted again."""
    with staged_tables() as own:
        more = _confirmed(pairs, docs, first_id)
        out = stage(more if links is None else links.unionByName(more), "links")
    delete_tables(docs.sparkSession, own[:-1])
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group, columns as they were: of the rows
    with the least doc_id (any id before none) the one whose text has the
    least hash, and of repeated rows one.  Rows without words stay."""
    key = ["doc_id", "h"]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed, named = _grouped(ids)
    rows = signed.where(F.col("node").isNotNull()).groupBy("doc_id", "h", "node").agg(F.count("*").alias("times"))
    rows = rows.join(named.select("node", "root"), "node")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h")
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    judged = stage(rows.join(first, "root").select("doc_id", "h", "times", (order == F.col("first")).alias("stays")), "judged")
    gone, repeated = judged.where(~F.col("stays")).select(*key), judged.where(F.col("stays") & (F.col("times") > 1)).select(*key)
    row_id, row_hash = docs["doc_id"].cast("long"), F.xxhash64(docs["text"])
    same = lambda k: row_id.eqNullSafe(k["doc_id"]) & (row_hash == k["h"])
    none = broadcast_if_small(gone)
    kept = docs.join(none, same(none), "left_anti")
    if repeated.isEmpty():
        return kept
    some = broadcast_if_small(repeated)
    number = free_name(docs, "h")
    once = kept.join(some, same(some), "left_semi").withColumn(number, F.xxhash64("text")).dropDuplicates(["doc_id", number]).drop(number)
    return kept.join(some, same(some), "left_anti").unionByName(once)


# The same in SQL: all pairs that share a shingle, exact set sizes, then reachability.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(5, len(ws)) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS k FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
