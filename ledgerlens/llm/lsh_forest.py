"""Operator 2: approximate nearest neighbours by a hash-prefix forest.

Every vector has, in each of ``TREES`` trees, a string of ``BITS`` hash bits
(signs of random projections).  A tree is the sorted array of its strings
with the vectors behind them, so the vectors that share a prefix with a query
are one interval, found by binary search.  A query descends each tree to its
longest matching prefix and then ascends all trees together, one bit a step,
until the intervals hold ``budget`` times the rows (the last step tree by
tree).  The candidates found are scored exactly, in double precision, on the
original vectors.

Nearness is the inner product: vectors get one more component, the root of
what their squared norm lacks to the largest, and queries a zero there, which
makes the nearest by angle the nearest by inner product.

Spark's part: equal vectors are one row with its ``k + 1`` smallest ids,
merged in each task before the shuffle, so a vector that fills the table
costs one row a task.  Rows are dealt by hash in shards of ``SHARD`` vectors; a
shard builds its forest and the query set streams past it in blocks.

Null, empty, zero, or non-finite vectors and null ids take no part, nor do
vectors of another length than the query's.  Rows with one id and several
vectors are several queries.  An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import emit, rows_of, stage

TREES = 128
BITS = 32
SHARD = 8192
BUDGET = 0.75
BLOCK = 256
SEED = 7


class Forest:
    """The trees over one shard's vectors."""

    def __init__(self, vectors: np.ndarray, largest: float, trees: int = TREES, seed: int = SEED):
        self.vectors, self.trees = vectors, trees
        self.planes = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, trees * BITS)).astype(np.float32)
        lacking = np.sqrt(np.maximum(0, largest**2 - (vectors**2).sum(axis=1)))
        keys = self._hash(vectors, lacking, max(largest, 1e-300))
        self.order = np.argsort(keys, axis=0, kind="stable").T.copy()
        self.keys = np.take_along_axis(keys, self.order.T, axis=0).T.copy()  # a sorted array a tree

    def _hash(self, vectors: np.ndarray, last: np.ndarray, scale: float) -> np.ndarray:
        out = np.empty((len(vectors), self.trees), dtype=np.uint32)
        for at in range(0, len(vectors), 1024):  # bounded memory
            part = np.column_stack([vectors[at:at + 1024], last[at:at + 1024]]) / scale
            bits = (part.astype(np.float32) @ self.planes > 0).reshape(len(part), self.trees, BITS)
            out[at:at + 1024] = np.packbits(bits, axis=2).view(">u4")[:, :, 0]
        return out

    def candidates(self, queries: np.ndarray, budget: float):
        """For each query, the rows found: some more than ``budget`` entries
        of the trees, deepest common prefixes first."""
        n = len(self.vectors)
        if n <= 512:
            for _ in queries:
                yield np.arange(n)
            return
        norm = np.sqrt((queries**2).sum(axis=1)).max()
        keys = self._hash(queries, np.zeros(len(queries)), norm)
        deepest = min(BITS, int(math.log2(n)) + 4)
        lo = np.empty((deepest + 1, self.trees, len(queries)), dtype=np.int32)
        hi = np.empty_like(lo)
        for depth in range(deepest + 1):
            rest = np.uint32((1 << (BITS - depth)) - 1)
            for t in range(self.trees):
                lo[depth, t] = np.searchsorted(self.keys[t], keys[:, t] & ~rest, "left")
                hi[depth, t] = np.searchsorted(self.keys[t], keys[:, t] | rest, "right")
        held = (hi - lo).astype(np.int64)
        total = held.sum(axis=1)  # depth, query
        for q in range(len(queries)):
            enough = int(np.flatnonzero(total[:, q] >= budget).max(initial=0))  # where the ascent ends
            found = np.zeros(n, dtype=bool)
            size = 0
            if enough < deepest:
                size = int(total[enough + 1, q])
                for t in range(self.trees):
                    found[self.order[t, lo[enough + 1, t, q]:hi[enough + 1, t, q]]] = True
            for t in range(self.trees):
                if size >= budget:
                    break
                found[self.order[t, lo[enough, t, q]:hi[enough, t, q]]] = True
                size += int(held[enough, t, q] - (held[enough + 1, t, q] if enough < deepest else 0))
            yield np.flatnonzero(found)

    def search(self, queries: np.ndarray, k: int, budget: float):
        """(rows, scores) of each query's ``k`` best, with all ties."""
        for q, rows in zip(queries, self.candidates(queries, budget * len(self.vectors))):
            scores = self.vectors[rows] @ q
            if len(rows) > k:
                best = scores >= np.partition(scores, len(rows) - k)[len(rows) - k]
                rows, scores = rows[best], scores[best]
            yield rows, scores


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    e = F.col("embedding")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & e.isNotNull()).where(~bad & F.exists(e, lambda x: x != 0))


def _packed(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors (bytes) with their k + 1 smallest ids."""
    schema = pa.schema([("vec", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def merge(batches):
        def rows():
            held: dict[bytes, list[int]] = {}
            for vec_id, embedding in rows_of(batches, "vec_id", "embedding"):
                ids = held.setdefault(np.array(embedding, dtype="<f8").tobytes(), [])
                ids.append(vec_id)
                if len(ids) > 8 * (k + 1):
                    ids[:] = sorted(set(ids))[: k + 1]
                if len(held) >= 65536:
                    yield from flushed(held)
                    held = {}
            yield from flushed(held)

        def flushed(held):
            for vec, ids in held.items():
                yield vec, sorted(set(ids))[: k + 1]

        yield from emit(schema, rows())

    merged = vectors.mapInArrow(merge, "vec binary, ids array<long>").groupBy("vec").agg(F.collect_list("ids").alias("ids"))
    return merged.select("vec", F.slice(F.array_sort(F.array_distinct(F.flatten("ids"))), 1, k + 1).alias("ids"))


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, budget: float = BUDGET, shard: int = SHARD, trees: int = TREES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row of
    ``queries`` (vec_id, embedding), other than itself."""
    spark = vectors.sparkSession
    packed = stage(_packed(usable(vectors), k), "vectors")
    width = (F.octet_length("vec") / 8).cast("int")
    norms = packed.withColumn("width", width).groupBy("width").agg(F.count("*").alias("n"))
    sizes = {r.width: -(-r.n // shard) for r in norms.collect()}  # a row a vector length
    schema = pa.schema([("norm", pa.float64())])

    def norm_of(batches):
        best = 0.0
        for (vec,) in rows_of(batches, "vec"):
            best = max(best, float(np.square(np.frombuffer(vec, "<f8")).sum()))
        yield pa.RecordBatch.from_arrays([pa.array([math.sqrt(best)])], schema=schema)

    largest = packed.select("vec").mapInArrow(norm_of, "norm double").agg(F.max("norm")).first()[0] or 0.0
    shards = spark.createDataFrame(list(sizes.items()) or [(0, 0)], "width int, shards long")
    asked = usable(queries).withColumn("width", F.size("embedding"))
    pack_schema = pa.schema([("query_id", pa.int64()), ("width", pa.int32()), ("vec", pa.binary())])

    def pack(batches):
        yield from emit(pack_schema, ((i, w, np.array(e, dtype="<f8").tobytes()) for i, w, e in rows_of(batches, "vec_id", "width", "embedding")))

    asked = asked.mapInArrow(pack, "query_id long, width int, vec binary").distinct()
    blocks = asked.join(F.broadcast(shards), "width").select(
        "width", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), "query_id", "vec",
        F.lit(None).cast("array<long>").alias("ids"))
    rows = packed.withColumn("width", width).join(F.broadcast(shards), "width").select(
        "width", F.pmod(F.xxhash64("vec"), F.col("shards")).alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("query_id"), "vec", "ids")
    out = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches):
        import zlib

        def answered(forest, ids, asked):
            for (query_id, vec), (found, scores) in zip(asked, forest.search(np.array([np.frombuffer(v, "<f8") for _, v in asked]), k + 1, budget)):
                best = sorted((-s, i) for r, s in zip(found.tolist(), scores.tolist()) for i in ids[r] if i != query_id)[:k]
                for s, i in best:
                    yield query_id, zlib.crc32(vec), i, -s

        def rows():
            key, vecs, ids, forest, asked = None, [], [], None, []
            for width, shard, kind, query_id, vec, own in rows_of(batches, "width", "shard", "kind", "query_id", "vec", "ids"):
                if key != (width, shard):
                    if asked:
                        yield from answered(forest, ids, asked)
                    key, vecs, ids, forest, asked = (width, shard), [], [], None, []
                if kind == 0:
                    vecs.append(np.frombuffer(vec, "<f8"))
                    ids.append(own)
                    continue
                if not vecs:
                    continue  # a shard without vectors
                if forest is None:
                    forest = Forest(np.array(vecs), largest, trees)
                asked.append((query_id, vec))
                if len(asked) >= BLOCK:
                    yield from answered(forest, ids, asked)
                    asked = []
            if asked:
                yield from answered(forest, ids, asked)

        yield from emit(out, rows())

    parts = max(1, sum(sizes.values()))
    found = rows.unionByName(blocks).repartition(parts, "width", "shard").sortWithinPartitions("width", "shard", "kind") \
        .mapInArrow(search, "query_id long, query long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
