"""Operator 13: exact top-k search by a vector-approximation file.

Components become integers (``floor(256 x)``) and the score is the integer
inner product.  The file has one row for each block of vectors: per dimension
up to ``CELLS`` cells (quantiles of the block) with the least and greatest
value that lies in each, one byte a component that names its cell, and, in
columns of their own, the exact vectors with their ids.

1. The approximations are scanned for every query.  A cell bounds a component
   on both sides, so two matrix products bound every score; the k+1 greatest
   lower bounds of all blocks give a score that k other vectors reach for sure
   (the query's own may be among the k+1).
2. A second scan leaves the vectors whose upper bound reaches it.
3. Exact vectors are read in the order of their upper bounds, the highest
   first, until the next bound is below the kth exact score: the rest cannot
   belong to the result.

Spark deals the rows to blocks of about ``BLOCK_BYTES`` by a hash of their id,
so no value makes a block large; in a block equal vectors are one entry with
its k+1 smallest ids, so a vector that fills the table is one entry a block.
The query set streams past each block.  The scan reads no exact vector and
the last step no approximation (columns of one Parquet table).

Null vectors or ids and vectors with a null or non-finite component take no
part.  Only vectors of the query's length are its candidates (vectors without
components score 0 among themselves).  Rows of the query's id are its own;
an id with several vectors is several queries and candidates; a repeated row
counts once.
Scaled components beyond a long are the nearest long.  All ranks are by exact
integers; a score that no long can hold comes out as null.  An empty table
gives no rows.  Columns other than vec_id and embedding play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import emit, rows_of, stage

SCALE = 256
CELLS = 64
BLOCK_BYTES = 4 << 20
QUERIES = 256       # scored together
EXACT = 2.0**53     # doubles hold smaller integers exactly
_OFFSET = 1 << 255  # order key of a score: 32 bytes, compared as bytes


class Cells:
    """The cells of a block's vectors and the bounds they give."""

    def __init__(self, low: np.ndarray, high: np.ndarray, codes: np.ndarray):
        self.low, self.high, self.codes = low, high, codes  # (dimension, cell) twice, (vector, dimension)

    @classmethod
    def of(cls, vectors: np.ndarray, cells: int = CELLS) -> "Cells":
        n, width = vectors.shape
        low, high = np.zeros((width, cells), dtype=np.int64), np.zeros((width, cells), dtype=np.int64)
        codes = np.zeros((n, width), dtype=np.uint8)
        for d in range(width):
            values = np.sort(vectors[:, d])
            marks = np.unique(values[np.arange(1, cells) * n // cells])
            codes[:, d] = cell = np.searchsorted(marks, vectors[:, d], "right")
            order = np.searchsorted(marks, values, "right")  # cells in order of value
            used, first = np.unique(order, return_index=True)
            low[d, used] = values[first]
            high[d, used] = values[np.append(first[1:], n) - 1]
            assert cell.max(initial=0) < cells
        return cls(low, high, codes)

    def bounds(self, queries: np.ndarray):
        """Lower and upper bounds of all scores (vector, query)."""
        at = np.arange(self.codes.shape[1])
        low, high = self.low[at, self.codes].astype(float), self.high[at, self.codes].astype(float)
        up, down = np.maximum(queries, 0).astype(float).T, np.minimum(queries, 0).astype(float).T
        slack = _most(queries) * max(_most(self.low), _most(self.high)) * self.codes.shape[1]
        slack = 0.0 if slack < EXACT else slack * 2.0**-40  # rounding of the products
        return low @ up + high @ down - slack, high @ up + low @ down + slack


def _most(x: np.ndarray) -> float:
    return float(np.abs(x.astype(float)).max(initial=0))


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    if _most(vectors) * _most(query) * len(query) < EXACT:
        return (vectors.astype(float) @ query.astype(float)).astype(np.int64).tolist()
    return [int(s) for s in vectors.astype(object) @ query.astype(object)] if len(query) else [0] * len(vectors)


def read_in_order(vectors: np.ndarray, query: np.ndarray, entries: np.ndarray, upper: np.ndarray, k: int, step: int = 32):
    """(entry, exact score) of the k+1 best and all ties, read by falling
    upper bound until the rest is out of reach; and how many were read."""
    order = np.lexsort((entries, -upper))
    got: list[tuple[int, int]] = []
    best: list[int] = []
    at = 0
    while at < len(order):
        if len(best) > k and upper[order[at]] < best[k]:
            break
        part = entries[order[at:at + step]]
        got += zip(part.tolist(), exact_scores(vectors[part], query))
        best = sorted((s for _, s in got), reverse=True)[:k + 1]
        at += step
    return [(e, s) for e, s in got if len(best) <= k or s >= best[k]], min(at, len(order))


# ------------------------------------------------------------------ Spark

def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id and v (integer components) of the rows that take part."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull()).where(~bad)
    return rows.select("vec_id", F.transform(e, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long")).alias("v"))


def vector_file(rows: DataFrame, k: int, blocks: int) -> DataFrame:
    """The written file: block, width, n, low, high, codes | vecs, ids."""
    schema = pa.schema([("block", pa.int64()), ("width", pa.int32()), ("n", pa.int64()), ("low", pa.binary()), ("high", pa.binary()), ("codes", pa.binary()),
                        ("vecs", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64())))])

    def written(block, held):
        for width, entries in sorted(held.items()):
            vecs = np.frombuffer(b"".join(entries), "<i8").reshape(len(entries), width)
            cells = Cells.of(vecs)
            yield (block, width, len(vecs), cells.low.tobytes(), cells.high.tobytes(), cells.codes.tobytes(), vecs.tobytes(),
                   [sorted(ids)[: k + 1] for ids in entries.values()])

    def build(batches):
        def out():
            here, held = None, {}
            for block, vec_id, v in rows_of(batches, "block", "vec_id", "v"):
                if block != here:
                    yield from written(here, held)
                    here, held = block, {}
                ids = held.setdefault(len(v), {}).setdefault(np.array(v, dtype="<i8").tobytes(), set())
                ids.add(vec_id)
                if len(ids) > 8 * (k + 1):
                    ids.intersection_update(sorted(ids)[: k + 1])
            yield from written(here, held)

        yield from emit(schema, out(), most_rows=1)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    ddl = "block long, width int, n long, low binary, high binary, codes binary, vecs binary, ids array<array<long>>"
    return stage(dealt.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(build, ddl), "vector_file")


def _past_blocks(file: DataFrame, parts: list[str], asked: DataFrame, columns: list[str], blocks: int, hold, answer, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows of ``asked`` (block, width, columns) stream past the block of
    their key: ``hold(width, *parts)`` takes it up, and ``answer(key, held,
    rows)`` gives result rows for up to ``QUERIES`` of them."""
    one = file.select("block", "width", F.lit(0).alias("kind"), *parts, *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in columns])
    many = asked.select("block", "width", F.lit(1).alias("kind"), *[F.lit(None).cast(file.schema[c].dataType).alias(c) for c in parts], *columns)

    def run(batches):
        def out():
            key, held, rows = None, None, []
            for block, width, kind, *values in rows_of(batches, "block", "width", "kind", *parts, *columns):
                if key != (block, width) or len(rows) >= QUERIES:
                    if rows:
                        yield from answer(key, held, rows)
                    rows = []
                if key != (block, width):
                    key, held = (block, width), None
                if kind == 0:
                    held = hold(width, *values[:len(parts)])
                elif held is not None:  # else the block has no vector of this length
                    rows.append(values[len(parts):])
            if rows:
                yield from answer(key, held, rows)

        yield from emit(schema, out())

    return one.unionByName(many).repartition(blocks, "block", "width").sortWithinPartitions("block", "width", "kind").mapInArrow(run, ddl)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each row of
    ``queries`` (vec_id, embedding) among the rows of other ids."""
    rows = scaled(vectors)
    size = rows.agg(F.sum(8 * F.size("v") + 8)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    file = vector_file(rows, k, blocks)

    pack_schema = pa.schema([("query_id", pa.int64()), ("width", pa.int32()), ("vec", pa.binary())])

    def pack(batches):
        yield from emit(pack_schema, ((i, len(v), np.array(v, dtype="<i8").tobytes()) for i, v in rows_of(batches, "vec_id", "v")))

    asked = scaled(queries).mapInArrow(pack, "query_id long, width int, vec binary").distinct()
    asked = stage(asked.withColumn("q", F.monotonically_increasing_id()), "queries")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")

    def cells_of(width, n, low, high, codes):
        table = lambda x: np.frombuffer(x, np.int64).reshape(width, CELLS)
        return Cells(table(low), table(high), np.frombuffer(codes, np.uint8).reshape(n, width))

    def matrix(vecs):
        return np.array([np.frombuffer(v, "<i8") for v in vecs])

    def lower_bounds(key, cells, rows):
        low, _ = cells.bounds(matrix(v for _, v in rows))
        most = min(k + 1, len(low))
        best = np.partition(low, len(low) - most, axis=0)[len(low) - most:]
        for (q, _), values in zip(rows, best.T.tolist()):
            yield q, values

    def candidates(key, cells, rows):
        _, high = cells.bounds(matrix(r[2] for r in rows))
        for (q, query_id, vec, least), upper in zip(rows, high.T):
            entries = np.arange(len(upper)) if least is None else np.flatnonzero(upper >= least)
            if len(entries):
                yield *key, q, query_id, vec, entries.astype("<i8").tobytes(), np.ascontiguousarray(upper[entries]).tobytes()

    def exact_of(width, vecs, ids):
        return np.frombuffer(vecs, "<i8").reshape(len(ids), width), ids

    def answers(key, held, rows):
        vectors, ids = held
        for q, query_id, vec, entries, upper in rows:
            found, _ = read_in_order(vectors, np.frombuffer(vec, "<i8"), np.frombuffer(entries, "<i8"), np.frombuffer(upper, "<f8"), k)
            best = sorted((-s, i) for e, s in found for i in ids[e] if i != query_id)[:k]
            for s, i in best:
                yield q, query_id, i, -s if -(1 << 63) <= -s < 1 << 63 else None, (_OFFSET - s).to_bytes(32, "big")

    approximate = ["n", "low", "high", "codes"]
    lower = _past_blocks(file, approximate, asked.select("q", "width", "vec", everywhere), ["q", "vec"], blocks, cells_of, lower_bounds,
                         pa.schema([("q", pa.int64()), ("bounds", pa.list_(pa.float64()))]), "q long, bounds array<double>")
    lower = lower.select("q", F.explode("bounds").alias("least"))
    least = lower.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("least")))).where(F.col("n") <= k + 1) \
        .where(F.col("n") == k + 1).select("q", "least")
    known = asked.join(least, "q", "left")
    near_schema = pa.schema([("block", pa.int64()), ("width", pa.int32()), ("q", pa.int64()), ("query_id", pa.int64()), ("vec", pa.binary()),
                             ("entries", pa.binary()), ("upper", pa.binary())])
    near = _past_blocks(file, approximate, known.select("q", "query_id", "width", "vec", "least", everywhere), ["q", "query_id", "vec", "least"], blocks,
                        cells_of, candidates, near_schema, "block long, width int, q long, query_id long, vec binary, entries binary, upper binary")
    found = _past_blocks(file, ["vecs", "ids"], near, ["q", "query_id", "vec", "entries", "upper"], blocks, exact_of, answers,
                         pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("key", pa.binary())]),
                         "q long, query_id long, vec_id long, score long, key binary")
    order = Window.partitionBy("q").orderBy(F.desc("key"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# The same in SQL: every query against every row.
ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(len(q.v)), lambda i: q.v[i + 1] * c.v[i + 1])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
