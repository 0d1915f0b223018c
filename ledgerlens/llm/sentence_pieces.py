"""Operator 8: SentencePiece encoding and decoding by a max-plus scan.

The ids are the library's, also for documents too long for one task.

A byte-pair segmentation is the one path of pieces in which every two
neighbours, joined and encoded alone, stay apart: a max-plus path with weight
0 for such a step and minus infinity for any other.  So a giant document is
cut into chunks of ``CHUNK`` characters, and a boundary's states are the pieces
that may cover the character before it.

1. Each chunk, with the ``LONGEST`` characters around it, yields its transfer
   matrix from the states at its start to those at its end.  Pieces never
   reach over a word's start, so a chunk that holds one has a matrix of rank
   one: an entry vector (states that reach the first word start) and an exit
   vector (states reached from the last).
2. A document's matrices are combined associatively, prefixes and suffixes,
   which fixes the state at every boundary.  They are a few numbers a chunk.
3. Every chunk is backtraced alone between its two states; words that lie
   between its first and last word starts go to the library as they are.

Shorter documents are one chunk without boundaries.  Decoding is a table of
pieces; what the model keeps (all but U+2581, which comes back as a space)
makes the round trip.

Null texts have no ids (null) and decode to null; empty texts have none
(empty).  Rows keep their other columns; repeated rows are separate rows.
The model must be byte-pair with byte fallback and identity normalisation;
others are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import add_column, emit, free_name, rows_of, stage, worker_state

CHUNK = 32768
MARK = "▁"
START = (0, 0)
REMEMBERED = 20_000  # answers kept by a worker of each of two questions


class Pieces:
    """The model: vocabulary, which pieces may be neighbours, and decoding."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as fh:
            model.ParseFromString(fh.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap \
                or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
            raise ValueError("the model is not byte-pair with byte fallback and identity normalisation")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        spec.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.id = {p.piece: k for k, p in enumerate(model.pieces) if p.type in (1, 4)}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece reaches over a word's start")
        self.longest = max(map(len, self.id))
        self.bytes = [p.piece.replace(MARK, " ").encode() if p.type in (1, 4) else bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b""
                      for p in model.pieces]
        self.alone: dict[str, bool] = {}
        self.apart: dict[tuple[str, str], bool] = {}

    def encode_part(self, text: str) -> list[int]:
        """Ids of escaped text that starts a word (or the pieces of one)."""
        return self.part.encode(text.replace(MARK, " "), num_threads=1) if text else []

    def is_piece(self, text: str) -> bool:
        """Whether the text may be one piece of a path: a piece that is its
        own encoding, or a single character (bytes, if it is no piece)."""
        if len(text) == 1:
            return True
        got = self.alone.get(text)
        if got is None:
            if len(self.alone) > REMEMBERED:
                self.alone.clear()
            got = self.alone[text] = text in self.id and self.encode_part(text) == [self.id[text]]
        return got

    def may_follow(self, a: str, b: str) -> bool:
        if (b[0] == MARK and a[-1] != MARK) or any(len(x) == 1 and x not in self.id for x in (a, b)):
            return True  # a word's start, or a character that never merges
        got = self.apart.get((a, b))
        if got is None:
            if len(self.apart) > REMEMBERED:
                self.apart.clear()
            got = self.apart[a, b] = self.encode_part(a + b) == [self.id[a], self.id[b]]
        return got

    def ends(self, text: str, at: int) -> list[int]:
        return [e for e in range(at + 1, min(at + self.longest, len(text)) + 1) if self.is_piece(text[at:e])]

    def paths(self, text: str, origins: dict, limit: int) -> tuple[dict, dict]:
        """From states (start, end) with sets of origins: the states that
        first reach ``limit``, with theirs, and the steps back."""
        layers: dict[int, dict] = {}
        for state, of in origins.items():
            layers.setdefault(state[1], {})[state] = set(of)
        done, back, at = {}, {}, min(layers, default=limit)
        while layers:
            for state, of in layers.pop(at, {}).items():
                if state[1] >= limit:
                    done.setdefault(state, set()).update(of)
                    continue
                for e in self.ends(text, at):
                    if state[0] == state[1] or self.may_follow(text[state[0]:at], text[at:e]):
                        layers.setdefault(e, {}).setdefault((at, e), set()).update(of)
                        back.setdefault((at, e), []).append(state)
            at += 1
        return done, back

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def escape(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


class Chunk:
    """One chunk in its surroundings; positions count from its start."""

    def __init__(self, pieces: Pieces, before: str, text: str, after: str, first: bool, last: bool):
        self.pieces, self.base, self.full = pieces, len(before), before + text + after
        self.end, self.first, self.last = self.base + len(text), first, last
        full = self.full
        self.words = [p for p in range(max(1, self.base), self.end) if full[p] == MARK and full[p - 1] != MARK]
        if first:
            self.words = sorted({self.base, *self.words})

    def _in_states(self) -> list[tuple[int, int]]:
        if self.first:
            return [(self.base, self.base)]
        return [(s, e) for s in range(max(0, self.base - self.pieces.longest), self.base)
                for e in self.pieces.ends(self.full, s) if e >= self.base and not any(w < e for w in self.words[:1])]

    def _limits(self, states: dict) -> dict:
        return {s: o for s, o in states.items() if s[1] <= len(self.full) and (not self.last or s[1] == self.end)}

    def matrix(self) -> tuple[list, list, list]:
        """Entry states, exit states, and pairs of their numbers with weight
        0; a chunk with a word start gives its two vectors (no pairs)."""
        ins = self._in_states()
        if not self.words:
            done, _ = self.pieces.paths(self.full, {s: {k} for k, s in enumerate(ins)}, self.end)
            outs = list(self._limits(done))
            pairs = [(k, j) for j, s in enumerate(outs) for k in sorted(done[s])]
            return self._relative(ins, self.base), self._relative(outs, self.end), pairs
        done, _ = self.pieces.paths(self.full, {s: {k} for k, s in enumerate(ins)}, self.words[0])
        good = sorted({k for of in done.values() for k in of})
        at = self.words[-1]
        outs = list(self._limits(self.pieces.paths(self.full, {(at, at): {0}}, self.end)[0]))
        return self._relative([ins[k] for k in good], self.base), self._relative(outs, self.end), []

    def _relative(self, states, to: int) -> list:
        return [START if s[0] == s[1] else (s[0] - to, s[1] - to) for s in states]

    def _walk(self, origin: tuple, limit: int, target: tuple | None) -> list[int]:
        done, back = self.pieces.paths(self.full, {origin: {0}}, limit)
        at, out = target or next(iter(done)), []
        while at != origin:
            word = self.full[at[0]:at[1]]
            out.append([self.pieces.id[word]] if word in self.pieces.id else self.pieces.encode_part(word))
            at = back[at][0]  # one way back: the segmentation is unique
        return [i for ids in reversed(out) for i in ids]

    def ids(self, came: tuple, goes: tuple) -> list[int]:
        """Ids of the pieces that start in the chunk, between its states."""
        origin = (self.base, self.base) if came == START else (came[0] + self.base, came[1] + self.base)
        target = (goes[0] + self.end, goes[1] + self.end)
        if not self.words:
            return self._walk(origin, self.end, target)
        a, b = self.words[0], self.words[-1]
        return (self._walk(origin, a, None) if origin[1] < a else []) + self.pieces.encode_part(self.full[a:b]) \
            + self._walk((b, b), self.end, target)


def combine(a: dict, b: dict) -> dict:
    """The max-plus product of two matrices {(from, to): weight}."""
    by: dict = {}
    for (m, j), w in b.items():
        by.setdefault(m, []).append((j, w))
    out: dict = {}
    for (i, m), v in a.items():
        for j, w in by.get(m, ()):
            out[i, j] = max(out.get((i, j), -np.inf), v + w)
    return out


def as_matrix(ins: list, outs: list, pairs: list) -> dict:
    chosen = pairs or [(k, j) for k in range(len(ins)) for j in range(len(outs))]
    return {(ins[k], outs[j]): 0.0 for k, j in chosen}


def boundary_states(matrices: list[dict]) -> list[tuple]:
    """The best path's state at every boundary, ends included: prefixes from
    the left and suffixes from the right, where their sum is the greatest."""
    left = [{(START, START): 0.0}]
    for m in matrices:
        left.append(combine(left[-1], m))
    right: list[dict] = [{(j, "end"): 0.0 for _, j in left[-1]}]
    for m in reversed(matrices):
        right.append(combine(m, right[-1]))
    out = []
    for prefix, suffix in zip(left, reversed(right)):
        through = combine(prefix, suffix)
        best = max(through.values())
        out.append(min(s for _, s in prefix if (s, "end") in suffix and prefix[START, s] + suffix[s, "end"] == best))
    return out


# ------------------------------------------------------------------ Spark

def _pieces(path: str) -> Pieces:
    return worker_state(f"pieces:{path}", lambda: Pieces(path))


IDS = pa.list_(pa.int32())


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "token_ids", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with an array<int> column ``out``."""
    return _encoded(docs, model_path, lambda pieces: lambda text, ids: ids, text, out, "array<int>", IDS, docs.columns, chunk)


def _encoded(docs: DataFrame, model_path: str, make, text: str, out: str, ddl: str, arrow: pa.DataType, keep: list[str], chunk: int) -> DataFrame:
    """``docs`` (of its columns, ``keep``) with a column ``out``: what
    ``make(pieces)`` makes of each text and its ids, in the pass that encodes
    it."""
    columns = docs.columns
    giant = F.length(text) > chunk

    def encoded():
        pieces = _pieces(model_path)
        see = make(pieces)
        return lambda texts: [None if t is None else see(t, pieces.whole.encode(t, num_threads=1)) for t in texts]

    def joined():
        see = make(_pieces(model_path))
        return lambda texts, ids: [see(t, i) for t, i in zip(texts, ids)]

    short = add_column(docs.where(F.coalesce(~giant, F.lit(True))), encoded, [text], out, ddl, arrow, keep)
    row = free_name(docs, "row")
    kept = stage(docs.where(giant).withColumn(row, F.monotonically_increasing_id()), "giant")
    schema = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("n", pa.int64()), ("before", pa.string()), ("chunk", pa.string()), ("after", pa.string())])

    def cut(batches):
        reach = _pieces(model_path).longest

        def rows():
            for r, t in rows_of(batches, row, text):
                t = escape(t)
                n = -(-len(t) // chunk)
                for k in range(n):
                    a, b = k * chunk, min((k + 1) * chunk, len(t))
                    yield r, k, n, t[max(0, a - reach):a], t[a:b], t[b:b + reach]

        yield from emit(schema, rows())

    chunks = stage(kept.select(row, text).mapInArrow(cut, "row long, k long, n long, before string, chunk string, after string"), "chunks")
    at = lambda r: Chunk(_pieces(model_path), r[3], r[4], r[5], r[1] == 0, r[1] == r[2] - 1)
    states = pa.list_(pa.list_(pa.int32()))
    matrix_schema = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("ins", states), ("outs", states), ("pairs", states)])

    def transfer(batches):
        yield from emit(matrix_schema, ((r[0], r[1], *map(list, at(r).matrix())) for r in rows_of(batches, *schema.names)))

    matrices = chunks.mapInArrow(transfer, "row long, k long, ins array<array<int>>, outs array<array<int>>, pairs array<array<int>>")
    state_schema = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("came", pa.list_(pa.int32())), ("goes", pa.list_(pa.int32()))])

    def scan(batches):
        def rows():
            key, held = None, []
            for r, _, ins, outs, pairs in rows_of(batches, *matrix_schema.names):
                if r != key:
                    yield from solved(key, held)
                    key, held = r, []
                held.append(as_matrix([tuple(s) for s in ins], [tuple(s) for s in outs], [tuple(p) for p in pairs]))
            yield from solved(key, held)

        def solved(key, held):
            if held:
                found = boundary_states(held)
                for k in range(len(held)):
                    yield key, k, list(found[k]), list(found[k + 1])

        yield from emit(state_schema, rows())

    # a document's matrices, a few numbers a chunk, meet in one group
    fixed = matrices.repartition("row").sortWithinPartitions("row", "k").mapInArrow(scan, "row long, k long, came array<int>, goes array<int>")
    id_schema = pa.schema([("row", pa.int64()), ("k", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def backtrace(batches):
        yield from emit(id_schema, ((r[0], r[1], at(r).ids(tuple(r[6]), tuple(r[7]))) for r in rows_of(batches, *schema.names, "came", "goes")))

    parts = chunks.join(fixed, ["row", "k"]).mapInArrow(backtrace, "row long, k long, ids array<int>")
    ids = parts.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))  # one document's
    held = free_name(docs, "ids")
    ids = ids.select(F.col("row").alias(row), F.flatten(F.col("parts.ids")).alias(held))
    return short.unionByName(add_column(kept.join(ids, row).select(*columns, held), joined, [text, held], out, ddl, arrow, keep))


def decode(encoded: DataFrame, model_path: str, ids: str = "token_ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``encoded`` with a string column ``out``."""
    def make():
        pieces = _pieces(model_path)
        return lambda rows: [None if r is None else pieces.decode(r) for r in rows]

    return add_column(encoded, make, [ids], out, "string", pa.string(), keep)


def round_trip(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with token_ids and the text decoded from them, in one pass."""
    both = free_name(docs, "pieces")
    kind = pa.struct([("token_ids", IDS), ("decoded", pa.string())])
    got = _encoded(docs, model_path, lambda pieces: lambda t, ids: {"token_ids": ids, "decoded": pieces.decode(ids)},
                   text, both, "struct<token_ids:array<int>,decoded:string>", kind, docs.columns, CHUNK)
    return got.select(*docs.columns, F.col(both)["token_ids"].alias("token_ids"), F.col(both)["decoded"].alias("decoded"))


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit ids), and
    whether the decoded text is the text."""
    kind = pa.struct([("n", pa.int64()), ("crc", pa.int64()), ("restored", pa.bool_())])

    def make(pieces):
        import zlib

        return lambda text, ids: {"n": len(ids), "crc": zlib.crc32(np.array(ids, dtype="<u4").tobytes()), "restored": pieces.decode(ids) == text}

    got = _encoded(docs.select("doc_id", "text"), model_path, make, "text", "seen", "struct<n:bigint,crc:bigint,restored:boolean>", kind, ["doc_id"], CHUNK)
    seen = F.col("seen")
    return got.select("doc_id", F.coalesce(seen["n"], F.lit(0)).alias("n_tokens"), seen["crc"].alias("ids_crc32"),
                      F.coalesce(seen["restored"], F.lit(True)).alias("restored"))
