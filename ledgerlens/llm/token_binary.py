"""Operator 1: token ids in a compact binary file.

Ids are replaced by their frequency rank (the most frequent id is 0) and
written in a byte-aligned variable-length code: one to four data bytes a
value, with the lengths of four values packed in one separate control byte.
A control byte selects a row of a 256-entry shuffle table, so decoding is a
numpy table lookup without a branch per value.

File format: a folder of Parquet rows, each one self-contained block::

    "LTB1" | u32 documents | u64 control bytes | i64 id[documents]
           | u8 id_is_null[documents] | u64 n_tokens[documents]
           | control bytes | data bytes

A document's values are padded with rank 0 to a multiple of four, so the
documents of a block join byte for byte.  ``ranks`` beside the blocks holds
the rank table.  Blocks lie in ascending doc_id order (rows of one id by a
hash of their texts), by shard and block number; null ids come first.

Plan: texts are sorted by range of doc_id, encoded once and staged as
blocks of ids; ids are counted in each task and summed (the rank table is
bounded by the vocabulary); then each block is coded in place.  Only shard
totals, one row a task, are summed in order to give each document's start.

A null text counts as empty: it has the end id alone.  Repeated rows are
separate documents.  Empty table: no blocks and no rows.
"""

from __future__ import annotations

import itertools
import json
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import cut_segments, emit, in_groups, rows_of, shared_path, span_hashes, worker_state

MAGIC = b"LTB1"
BLOCK_TOKENS = 1 << 16


# ---------------------------------------------------------------- the code

# of each control byte, the data bytes of its four values
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, dtype="<u4")
    v[: len(values)] = values
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    control = (extra.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, step: int = 1 << 16) -> np.ndarray:
    """The values, padded to four a control byte; ``step`` bounds memory.

    A control byte looks up its four lengths; their running sum is where each
    value starts, and values of more bytes take them from there."""
    c = np.frombuffer(control, dtype=np.uint8)
    d = np.frombuffer(data, dtype=np.uint8)
    out = np.empty(4 * len(c), dtype="<u4")
    at = 0
    for i in range(0, len(c), step):
        length = LENGTHS[c[i:i + step]].ravel()
        ends = np.cumsum(length, dtype=np.int64)
        start = ends - length + at
        value = d[start].astype("<u4")
        for byte in (1, 2, 3):
            more = np.flatnonzero(length > byte)
            if not len(more):
                break
            value[more] |= d[start[more] + byte].astype("<u4") << np.uint32(8 * byte)
        out[4 * i:4 * i + len(value)] = value
        at += int(ends[-1])
    return out


def write_block(ids: list[int | None], sizes: list[int], ranks: np.ndarray) -> bytes:
    """A block of documents whose ``ranks`` follow each other."""
    n = np.array(sizes, dtype=np.int64)
    padded = -(-n // 4) * 4
    first, place = np.cumsum(n) - n, np.cumsum(padded) - padded
    values = np.zeros(int(padded.sum()), dtype="<u4")
    values[np.repeat(place - first, n) + np.arange(len(ranks))] = ranks
    control, data = pack(values)
    return b"".join([
        MAGIC, struct.pack("<IQ", len(ids), len(control)),
        np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
        np.array([i is None for i in ids], dtype=np.uint8).tobytes(),
        n.astype("<u8").tobytes(), control, data])


def read_block(block: bytes):
    """(doc_id, ranks) of each document of a block, in order."""
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    n, n_control = struct.unpack_from("<IQ", block, 4)
    at = 16
    ids = np.frombuffer(block, "<i8", n, at)
    nulls = np.frombuffer(block, np.uint8, n, at + 8 * n)
    sizes = np.frombuffer(block, "<u8", n, at + 9 * n).astype(np.int64)
    at += 17 * n
    ranks = unpack(block[at:at + n_control], block[at + n_control:])
    first = 0
    for i, null, size in zip(ids.tolist(), nulls.tolist(), sizes.tolist()):
        yield None if null else i, ranks[first:first + size]
        first += -(-size // 4) * 4


# ------------------------------------------------------------ the tokenizer

_SPACED = bytes(32 if i in (9, 10, 13) else i for i in range(256))
_LETTER = np.array([65 <= i <= 90 or 97 <= i <= 122 for i in range(256)])
_STOP = np.array([i in b".," for i in range(256)])


class WordIds:
    """ids of whole texts from the ids of their words, each encoded once.

    The words of many texts are found and hashed by numpy and looked up in an
    open-addressing table of hashes; only words not in it are encoded.  The
    table is emptied when it is full.  ``apart`` says that a stop or comma
    between a letter and white space is a word of its own."""

    def __init__(self, encode_word, apart: bool, slots: int = 1 << 22):
        self.encode_word, self.apart, self.slots = encode_word, apart, slots
        self.clear()

    def clear(self):
        self.key = np.zeros(self.slots, dtype=np.uint64)
        self.entry = np.zeros(self.slots, dtype=np.int32)
        self.n = self.used = 0
        self.start = np.zeros(1024, dtype=np.int64)
        self.length = np.zeros(1024, dtype=np.int32)
        self.flat = np.zeros(4096, dtype="<u4")

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 if there is none."""
        out, todo, slot = np.full(len(h), -1, dtype=np.int64), np.arange(len(h)), self._slot(h)
        while len(todo):
            key = self.key[slot]
            hit = key == h[todo]
            out[todo[hit]] = self.entry[slot[hit]]
            on = ~hit & (key != 0)
            todo, slot = todo[on], (slot[on] + 1) & (self.slots - 1)
        return out

    def _add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        """New entries for distinct hashes."""
        length = np.array([len(x) for x in ids], dtype=np.int32)
        flat = np.fromiter(itertools.chain.from_iterable(ids), dtype="<u4", count=int(length.sum()))
        while self.n + len(h) > len(self.start):
            self.start, self.length = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[self.n:self.n + len(h)] = self.used + np.cumsum(length) - length
        self.length[self.n:self.n + len(h)] = length
        self.flat[self.used:self.used + len(flat)] = flat
        todo, slot = np.arange(len(h)), self._slot(h)
        while len(todo):  # all take their slots at once; of several, one gets it
            free = self.key[slot] == 0
            self.key[slot[free]] = h[todo[free]]
            got = self.key[slot] == h[todo]
            self.entry[slot[got]] = self.n + todo[got]
            todo, slot = todo[~got], (slot[~got] + 1) & (self.slots - 1)
        self.used += len(flat)
        self.n += len(h)

    def _segment(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, number of ids and ids of a segment's words."""
        b = np.frombuffer(buffer, dtype=np.uint8)
        word = b != 32
        before, after = np.concatenate([[False], word[:-1]]), np.concatenate([word[1:], [False]])
        first, last = word & ~before, word & ~after
        if self.apart:
            stop = _STOP[b] & ~after
            stop[1:] &= _LETTER[b[:-1]]
            stop[:1] = False
            first |= stop
            last[:-1] |= stop[1:]
        first, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = np.maximum(span_hashes(buffer, first, end), np.uint64(1))
        if self.n + len(h) > self.slots // 2 or self.used > 16 * self.slots:
            self.clear()
        found = self._find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, at = np.unique(h[new], return_index=True)
            once = new[at]
            spans = zip(first[once].tolist(), end[once].tolist())
            self._add(unique, [self.encode_word(buffer[a:z].decode("utf-8", "replace")) for a, z in spans])
            found[new] = self._find(h[new])
        count = self.length[found].astype(np.int64)
        ids = self.flat[np.repeat(self.start[found] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
        return first, count, ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        buffer = b" ".join(raw).translate(_SPACED)
        starts = np.cumsum([0] + [len(r) + 1 for r in raw])
        totals, out = np.zeros(len(raw), dtype=np.int64), []
        for at, part in cut_segments(buffer):
            first, count, ids = self._segment(part)
            np.add.at(totals, np.searchsorted(starts, first + at, "right") - 1, count)
            out.append(ids)
        return np.split(np.concatenate(out) if out else np.zeros(0, dtype="<u4"), np.cumsum(totals)[:-1])


def _encoder(path: str) -> WordIds:
    """The tokenizer drops white space between words, so a text's ids are its
    words' ids in order.

    A Latin word goes straight to the library's BPE model, one pre-token at
    a time, as the file's normaliser (NFC, lower case) and pre-tokeniser
    would cut it; any other word takes the library's whole path."""
    import os

    import regex

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as fh:
        pattern = _pattern(json.load(fh))

    def whole(w: str) -> list[int]:
        return tok.encode(w, add_special_tokens=False).ids

    if pattern is None:
        return WordIds(whole, apart=False)
    model, cut = tok.model, regex.compile(pattern)
    shape = ByteLevel(add_prefix_space=False, use_regex=False)

    def piece(p: str) -> list[int]:
        p = p if p.isascii() and p.isprintable() else shape.pre_tokenize_str(p)[0][0]
        return [t.id for t in model.tokenize(p)]

    def latin(w: str) -> list[int]:
        if max(w) > "\u024f" or "<|" in w:
            return whole(w)
        w = w.lower()
        return piece(w) if w.isalpha() else [i for p in cut.findall(w) for i in piece(p)]

    return WordIds(latin, apart=True)


def _pattern(parts: dict) -> str | None:
    """The pre-tokeniser's pattern, if the file has the parts that the Latin
    path stands for; None sends every word down the whole path."""
    try:
        normal = [n["type"] for n in parts["normalizer"]["normalizers"]]
        split, shape = parts["pre_tokenizer"]["pretokenizers"]
        plain = normal == ["NFC", "Replace", "Lowercase"] and split["behavior"] == "Removed" and split["invert"] \
            and shape["type"] == "ByteLevel" and not shape["add_prefix_space"] and not shape["use_regex"]
        return split["pattern"]["Regex"] if plain else None
    except (KeyError, TypeError, ValueError):
        return None


def _vocabulary(path: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    return max([end_id, *Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()]) + 1


# ------------------------------------------------------------------ Spark

@dataclass
class TokenFiles:
    """Where the blocks and the rank table lie."""

    spark: SparkSession
    path: str

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks")

    @property
    def ranks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/ranks")


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 1, path: str | None = None,
                 block_tokens: int = BLOCK_TOKENS) -> TokenFiles:
    """Encode ``docs`` (doc_id, text) and write the files."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    wide = _vocabulary(tokenizer_path, end_id) > 1 << 16
    kind = "<u4" if wide else "<u2"
    schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())])

    def encode(batches):
        from pyspark import TaskContext

        encoder, shard = worker_state(f"encoder:{tokenizer_path}", lambda: _encoder(tokenizer_path)), TaskContext.get().partitionId()

        def documents():
            for held in in_groups(rows_of(batches, "doc_id", "text"), lambda r: len(r[1])):
                yield from zip((i for i, _ in held), encoder.encode([t for _, t in held]))

        def blocks():
            held, size, k, first = [], 0, 0, 0
            for doc_id, ids in documents():
                held.append((doc_id, len(ids) + 1, np.append(ids, np.uint32(end_id)).astype(kind).tobytes()))
                size += len(ids) + 1
                if size >= block_tokens:
                    yield joined(k, first, size, held)
                    held, size, k, first = [], 0, k + 1, first + size
            if held:
                yield joined(k, first, size, held)

        def joined(k, first, size, held):
            doc_ids, sizes, ids = zip(*held)
            return shard, k, first, size, list(doc_ids), list(sizes), b"".join(ids)

        yield from emit(schema, blocks(), most_rows=64)

    # A range of ids a task, cut in whole-document blocks.  The sort comes
    # before the encoding, so that sampling the ranges reads only the input,
    # and every later step works on blocks in place.
    (docs.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
         .mapInArrow(encode, "shard long, block long, first long, n_tokens long, doc_ids array<long>, sizes array<long>, ids binary")
         .write.option("compression", "zstd").parquet(f"{path}/staged"))
    staged = spark.read.parquet(f"{path}/staged")

    def count(batches):
        total = np.zeros(1, dtype=np.int64)
        for (ids,) in rows_of(batches, "ids"):
            n = np.bincount(np.frombuffer(ids, kind))
            short, long = sorted((total, n), key=len)
            long[: len(short)] += short
            total = long
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    counts = staged.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = sorted(counts.collect(), key=lambda r: (-r.n, r.id))  # bounded by the vocabulary
    spark.createDataFrame([(k, r.id, r.n) for k, r in enumerate(ranked)], "rank long, id long, n long").coalesce(1) \
        .write.parquet(f"{path}/ranks")
    to_rank = np.zeros(max((r.id for r in ranked), default=0) + 1, dtype=np.uint32)
    to_rank[[r.id for r in ranked]] = np.arange(len(ranked))
    table = spark.sparkContext.broadcast(to_rank)
    out = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])

    def code(batches):
        to_rank = table.value

        def blocks():
            for shard, block, first, n_tokens, doc_ids, sizes, ids in rows_of(batches, *schema.names):
                yield shard, block, first, n_tokens, write_block(doc_ids, sizes, to_rank[np.frombuffer(ids, kind)])

        yield from emit(out, blocks(), most_rows=64)

    staged.mapInArrow(code, "shard long, block long, first long, n_tokens long, data binary") \
        .write.option("compression", "zstd").parquet(f"{path}/blocks")
    return TokenFiles(spark, path)


def read_tokens(files: TokenFiles, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit), decoded
    from the files; with ``digest``, ids_crc32 in place of ids."""
    spark = files.spark
    ranked = {r.rank: r.id for r in files.ranks.collect()}
    table = spark.sparkContext.broadcast(np.array([ranked[k] for k in range(len(ranked))], dtype="<u4"))
    blocks = files.blocks
    per_shard = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("total"))  # one row a writing task
    shard_start = per_shard.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("shard_start"))
    # a row a writing task goes to every reader, never a row a block
    blocks = blocks.join(F.broadcast(shard_start), "shard").select((F.col("first") + F.col("shard_start")).alias("first"), "data")
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def decode(batches):
        to_id = table.value

        def docs():
            for first, data in rows_of(batches, "first", "data"):
                for doc_id, ranks in read_block(data):
                    ids = to_id[ranks].tobytes()
                    yield doc_id, first, len(ranks), zlib.crc32(ids) if digest else ids
                    first += len(ranks)

        yield from emit(schema, docs())

    return blocks.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
