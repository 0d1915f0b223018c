"""Helpers shared by the operators: staging, word splitting, hashing."""

from __future__ import annotations

import contextlib
import os
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir


BATCH_BYTES = "4m"
SLICE = 256  # rows whose values are Python objects at one time
_open: list[list[str]] = []


def bounded_batches(spark) -> None:
    """Rows travel to Python in Arrow batches of at most ``BATCH_BYTES``,
    unless the session has a limit of its own: wide rows times the default
    number of rows would not fit an executor beside its heap."""
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "67108864", "64m", "64MB")
    if spark.conf.get(name, default[0]) in default:
        spark.conf.set(name, BATCH_BYTES)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and reread it."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = shared_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    for held in _open:
        held.append(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def staged_tables():
    """A list of the paths that ``stage`` writes inside the block."""
    held: list[str] = []
    _open.append(held)
    try:
        yield held
    finally:
        _open[:] = [x for x in _open if x is not held]


def delete_tables(spark, paths: list[str]) -> None:
    """Delete staged tables, which nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def broadcast_if_small(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A narrow staged table, counted: broadcast up to ``most`` rows, else
    left for a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def shared_path(spark, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def worker_state(name: str, make):
    """An object kept in this Python worker, which serves many tasks."""
    held = sys.modules.setdefault("_ledgerlens_worker_state", types.ModuleType("_ledgerlens_worker_state"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def _byte_table(keep) -> bytes:
    """Byte map: A-Z lower-cased, bytes outside ``keep`` to a space."""
    out = bytearray(32 if not keep(i) else i for i in range(256))
    for i in range(65, 91):
        out[i] = i + 32
    return bytes(out)


# words [^\x20\x09-\x0D]+ after lower-casing A-Z
SPACE_TABLE = _byte_table(lambda i: not (i == 32 or 9 <= i <= 13))
# words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM_TABLE = _byte_table(lambda i: 48 <= i <= 57 or 97 <= i <= 122 or i >= 128)


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str):
    """The rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))


def emit(schema: pa.Schema, rows, most_rows: int = 4096, most_bytes: int = 8 << 20):
    """Arrow batches of row tuples, bounded in rows and in bytes (of strings
    and of lists, whose items are Python objects here)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(40 * len(v) if isinstance(v, list) else len(v) for v in row if isinstance(v, (bytes, str, list)))
        if len(held) >= most_rows or size >= most_bytes:
            yield to_batch(schema, held)
            held, size = [], 0
    if held:
        yield to_batch(schema, held)


def to_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer form that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_column(df: DataFrame, make, inputs: list[str], out: str, ddl: str, arrow: pa.DataType, keep: list[str] | None = None) -> DataFrame:
    """``df`` (of its columns, ``keep``) with one more column from Python.
    ``make()`` is called in each task and returns a function from lists of
    the inputs' values to a list of results."""
    from pyspark.sql import types as T

    bounded_batches(df.sparkSession)
    keep = df.columns if keep is None else keep

    def run(batches):
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                column = lambda c: part.column(part.schema.get_field_index(c))
                made = fn(*(column(c).to_pylist() for c in inputs))
                yield pa.RecordBatch.from_arrays([*map(column, keep), pa.array(made, type=arrow)], names=[*keep, out])

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T._parse_datatype_string(ddl))])
    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)


# ------------------------------------------------------------ hashed words

SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2**64


def _powers():
    return (np.cumprod(np.full(SEGMENT + 1, _BASE, dtype=np.uint64)),
            np.cumprod(np.full(SEGMENT + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)))


def cut_segments(buffer: bytes, most: int = SEGMENT):
    """(start, part) of a buffer of words between spaces; a part is longer
    than ``most`` only if it is one word."""
    at = 0
    while at < len(buffer):
        end = min(at + most, len(buffer))
        if end < len(buffer):
            cut = buffer.rfind(b" ", at, end)
            end = cut if cut > at else buffer.find(b" ", end)
            end = end if end >= 0 else len(buffer)
        yield at, buffer[at:end]
        at = max(end, at + 1)


def span_hashes(part: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, wherever they stand: differences of a
    running polynomial sum modulo 2**64.  Spans of over 64 bytes are hashed by
    themselves."""
    import xxhash

    if len(part) <= SEGMENT:
        power, inverse = worker_state("powers", _powers)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((np.frombuffer(part, np.uint8).astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=total[1:])
        h = (total[end] - total[first]) * inverse[first]
    else:
        h = np.zeros(len(first), dtype=np.uint64)  # one word
    for k in np.flatnonzero(end - first > 64):
        h[k] = xxhash.xxh64_intdigest(part[first[k]:end[k]])
    return mix64(h)


def hashed_words(texts: list[str | None], table: bytes, tails: bool = False):
    """The words of all texts as 64-bit hashes in one array, and their number
    a text; with ``tails``, also each word's last three bytes.  ``table`` maps
    bytes and puts spaces between words."""
    raw = [t.encode("utf-8", "surrogatepass").translate(table) if t else b"" for t in texts]
    buffer = b" ".join(raw)
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    counts, hashes, ends = np.zeros(len(raw), dtype=np.int64), [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for at, part in cut_segments(buffer):
        b = np.frombuffer(part, np.uint8)
        word = np.concatenate([[False], b != 32, [False]])
        first, end = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        if not len(first):
            continue
        hashes.append(span_hashes(part, first, end))
        counts += np.bincount(np.searchsorted(starts, first + at, "right") - 1, minlength=len(raw))
        if tails:
            last = np.zeros(len(first), dtype=np.uint32)
            for k in (1, 2, 3):
                inside = end - first >= k
                last[inside] |= b[end[inside] - k].astype(np.uint32) << np.uint32(8 * (k - 1))
            ends.append(last)
    out = np.concatenate(hashes), counts
    return (*out, np.concatenate(ends)) if tails else out


def in_groups(rows, size_of, most: int = SEGMENT):
    """Lists of rows whose sizes add up to about ``most``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
