"""Operator 11: cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes: A (byte-level, of a space and the text) and
B (pieces, whose model adds the space).  Offsets where tokens of both end cut
the tokens into groups, and the two tokens that end there are linked.  The
count of an id pair is the number of its links in the corpus; a link is a best
one if no pair of its B id has a higher count.

1. Tokens never reach over a space between two visible characters, nor do
   those on one side depend on the other, so texts are cut there in units, and
   a unit is encoded and aligned once as long as it is remembered.
2. A task gathers the (pair, document, number) records of its documents and
   spills them every ``SPILL_CHARS`` characters (a link ends at a byte of its
   own, so that bounds them): sorted by B id, A id and document, radix-partitioned by the low bits of the
   B id, each part a run in zstd frames.  The runs are rows of a table in the
   shared folder, pairs and documents in columns of their own.
3. The pair frames alone are shuffled, by radix.  A k-way heap merge of a
   radix's runs adds up each pair; in that order (side major) a B id's pairs
   are neighbours, so its maximum is known as the next B id comes.  Every run
   gets the counts of its own pairs back.
4. Counts meet the document frames of their run again, spill by spill, and
   stream into sums for each document.

A pair is one entry a run however many documents hold it, and a spill has a
bounded size, so neither a hot pair nor a hot B id makes a task large.  A merge
holds one frame of each run of its radix and the radix's distinct pairs; the
number of radixes grows with the table.

Null and empty texts, and texts whose tokens' bytes are not the space and the
text on both sides (U+2581, for one, comes back as a space), have no tokens:
zeros and an empty ``groups``.  Rows are judged one by one: repeated rows and
null doc_ids are rows of their own, and count.  Columns other than doc_id and
text play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import emit, in_groups, rows_of, stage, worker_state
from ledgerlens.llm.sentence_pieces import Pieces

SPILL_CHARS = 1 << 22
GROUP = 1 << 19          # characters of documents taken up together
TOGETHER = 4096          # units encoded as one text
FRAME = 4096             # pairs in a zstd frame
REMEMBERED = 150_000     # units a worker keeps between spills, the first it meets
SHORT = 64               # characters of the units that are kept
_VISIBLE = r"[\w!-~]"
_CUT = re.compile(f"(?<={_VISIBLE}) (?={_VISIBLE})")
_WHOLE = re.compile(f"{_VISIBLE}(?:.*{_VISIBLE})?", re.DOTALL)


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and the units aligned before.  A unit's record: tokens
    of A, tokens of B, its groups as text, its linked pairs (B id << 32 | A
    id); None where bytes differ."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = Pieces(path_b)
        of = byte_alphabet()
        vocabulary = self.a.get_vocab()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.a_bytes[k] = token.encode() if token in special else bytes(of[c] for c in token)
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b.bytes))
        self.digits = [str(k) for k in range(max(len(self.a_bytes), len(self.b.bytes)))]
        self.known: dict[str, tuple | None] = {}

    def encode(self, text: str) -> tuple[list[int], list[int], bool]:
        """Ids of a space and the text by both, and whether their bytes are
        those."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.whole.encode(text, num_threads=1)
        same = (" " + text).encode("utf-8", "surrogatepass")
        return a, b, all(b"".join(map(of.__getitem__, ids)) == same for of, ids in ((self.a_bytes, a), (self.b.bytes, b)))

    def records(self, units: list[str], a: list[int], b: list[int]) -> list[tuple] | None:
        """The units' records from the ids of their text (units between single
        spaces); None if a unit does not end where tokens of both do."""
        ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) + 1 for u in units])
        flat_a, flat_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b])
        both, at_a, at_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        last = np.searchsorted(both, ends)
        if last[-1] >= len(both) or (both[last] != ends).any():
            return None
        text_a, text_b = ([self.digits[k] for k in ids] for ids in (a, b))
        groups, i, j = [], 0, 0
        for x, y in zip((at_a + 1).tolist(), (at_b + 1).tolist()):
            groups.append((text_a[i] if x == i + 1 else ",".join(text_a[i:x])) + "|" + (text_b[j] if y == j + 1 else ",".join(text_b[j:y])))
            i, j = x, y
        pairs = (flat_b[at_b] << 32 | flat_a[at_a]).tolist()
        n_a, n_b = np.diff(at_a[last] + 1, prepend=0).tolist(), np.diff(at_b[last] + 1, prepend=0).tolist()
        out, g = [], 0
        for x, y, h in zip(n_a, n_b, (last + 1).tolist()):
            out.append((x, y, ";".join(groups[g:h]).encode(), pairs[g:h]))
            g = h
        return out

    def alone(self, text: str) -> tuple | None:
        a, b, same = self.encode(text)
        return self.records([text], a, b)[0] if same else None

    def units(self, new: list[str], apart: bool) -> list[tuple | None]:
        """Records of units; ``apart``: they have visible characters at both
        ends, so they may be encoded as one text."""
        made: dict[str, tuple | None] = {}
        missing = [u for u in new if u not in self.known]
        for at in range(0, len(missing), TOGETHER):
            part = missing[at:at + TOGETHER]
            got = None
            if apart:
                a, b, same = self.encode(" ".join(part))
                got = self.records(part, a, b) if same else None
            made.update(zip(part, got if got is not None else map(self.alone, part)))
        out = [made[u] if u in made else self.known[u] for u in new]
        if len(self.known) < REMEMBERED:
            self.known.update((u, r) for u, r in made.items() if len(u) <= SHORT)
        return out


class Spill:
    """The documents and units gathered since the last spill."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.n_a, self.n_b, self.groups, self.pairs = aligner, [], [], [], []
        self.index: dict[str, int] = {}  # what stands between two spaces; -1: not to be cut off there
        self.odd: dict[str, int] = {}    # units of texts with such parts
        self.bad: set[int] = set()       # units whose bytes differ
        self.docs, self.parts, self.chars = [], [], 0

    def _put(self, record: tuple | None) -> int:
        k = len(self.n_a)
        if record is None:
            self.bad.add(k)
            record = 0, 0, b"", []
        for side, x in zip((self.n_a, self.n_b, self.groups, self.pairs), record):
            side.append(x)
        return k

    def add(self, docs: list[tuple[int | None, str | None]]) -> None:
        split = [t.split(" ") if t else [] for _, t in docs]
        new = set().union(*split).difference(self.index)
        whole = [p for p in new if _WHOLE.fullmatch(p)]
        self.index.update(dict.fromkeys(new, -1))
        self.index.update((u, self._put(r)) for u, r in zip(whole, self.aligner.units(whole, True)))
        for (doc_id, text), parts in zip(docs, split):
            got = list(map(self.index.__getitem__, parts))
            if -1 in got:
                parts = _CUT.split(text)
                odd = [p for p in dict.fromkeys(parts) if p not in self.odd]
                self.odd.update((u, self._put(r)) for u, r in zip(odd, self.aligner.units(odd, False)))
                got = list(map(self.odd.__getitem__, parts))
            if self.bad and not self.bad.isdisjoint(got):  # perhaps the bytes agree as a whole
                record = self.aligner.alone(text)
                got = [] if record is None else [self._put(record)]
            sha = hashlib.sha256(b";".join([self.groups[k] for k in got])).hexdigest() if got else ""
            self.docs.append((doc_id, sha))
            self.parts.append(np.array(got, dtype=np.int32))
            self.chars += len(text or "")

    def rows(self) -> list[tuple]:
        """doc_id, n_a, n_b, n_groups, groups_sha256 of the documents."""
        sizes = [len(p) for p in self.pairs]
        used = np.concatenate([np.zeros(0, np.int32), *self.parts])
        doc = np.repeat(np.arange(len(self.parts)), [len(p) for p in self.parts])
        sums = [np.bincount(doc, np.array(x, dtype=np.int64)[used], len(self.parts)).astype(np.int64).tolist() for x in (self.n_a, self.n_b, sizes)]
        return [(i, *n, sha) for (i, sha), *n in zip(self.docs, *sums)]

    def runs(self, radixes: int):
        """(radix, pair frames, document frames) of the records."""
        import zstandard

        sizes = np.array([len(p) for p in self.pairs], dtype=np.int64)
        codes, number = np.unique(np.array([c for p in self.pairs for c in p], dtype=np.int64), return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)])
        used = np.concatenate([np.zeros(0, np.int32), *self.parts])
        doc = np.repeat(np.arange(len(self.parts)), [len(p) for p in self.parts])
        n = sizes[used]
        ends = np.cumsum(n)
        if not len(ends) or not ends[-1]:
            return
        link = np.arange(ends[-1]) + np.repeat(first[used] - (ends - n), n)
        key, times = np.unique(number[link] * len(self.docs) + np.repeat(doc, n), return_counts=True)
        pair, doc = key // len(self.docs), key % len(self.docs)
        seen, pair = np.unique(pair, return_inverse=True)  # a unit may have served no document
        codes = codes[seen]
        radix = (codes >> 32) & (radixes - 1)
        order = np.argsort(radix, kind="stable")  # in a radix still by B id and A id
        held = np.append(np.searchsorted(pair, np.arange(len(codes))), len(pair))
        zip_ = zstandard.ZstdCompressor(level=3).compress
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(radix[order]) != 0)), len(order))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            mine = order[i:j]
            held_n = held[mine + 1] - held[mine]
            record = np.arange(held_n.sum()) + np.repeat(held[mine] - (np.cumsum(held_n) - held_n), held_n)
            links = np.add.reduceat(times[record], np.cumsum(held_n) - held_n)
            frames = [zip_(np.concatenate([codes[mine[k:k + FRAME]], links[k:k + FRAME]]).astype("<i8").tobytes()) for k in range(0, len(mine), FRAME)]
            docs = zip_(held_n.astype("<u4").tobytes() + doc[record].astype("<u4").tobytes() + times[record].astype("<u4").tobytes())
            yield int(radix[mine[0]]), frames, len(mine), len(record), docs


def run_frames(frames: list[bytes]):
    """(codes, links) of each frame of a run."""
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    for frame in frames:
        yield np.frombuffer(unzip(frame), "<i8").reshape(2, -1)


def merged(runs: list[list[bytes]]):
    """(codes, links) in ascending blocks without overlap, each pair once: a
    heap of the runs by the last pair of their current frame says how far all
    runs are known."""
    readers = [run_frames(r) for r in runs]
    heap, current = [], {}

    def refill(k):
        frame = next(readers[k], None)
        current.pop(k, None)
        if frame is not None:
            current[k] = frame
            heapq.heappush(heap, (int(frame[0, -1]), k))

    for k in range(len(runs)):
        refill(k)
    while heap:
        limit = heap[0][0]
        taken = []
        for k, (codes, links) in list(current.items()):
            n = int(np.searchsorted(codes, limit, "right"))
            if n:
                taken.append((codes[:n], links[:n]))
                current[k] = np.stack([codes[n:], links[n:]])
        while heap and heap[0][0] <= limit:
            refill(heapq.heappop(heap)[1])
        codes, where = np.unique(np.concatenate([c for c, _ in taken]), return_inverse=True)
        yield codes, np.bincount(where, weights=np.concatenate([n for _, n in taken]), minlength=len(codes)).astype(np.int64)


def counted(blocks):
    """(codes, counts, best) of the blocks, each with whole B ids: a block's
    last B id waits for the next block."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def closed(codes, counts):
        b = codes >> 32
        first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(b))))
        return codes, counts, counts == most

    for more, n in blocks:
        codes, counts = np.concatenate([codes, more]), np.concatenate([counts, n])
        done = int(np.searchsorted(codes, (codes[-1] >> 32) << 32))
        if done:
            yield closed(codes[:done], counts[:done])
            codes, counts = codes[done:], counts[done:]
    if len(codes):
        yield closed(codes, counts)


# ------------------------------------------------------------------ Spark

_RUN = "spill long, radix int, frames array<binary>, pairs int, records int, docs binary"
_DOC = "ordinal int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string"
LAST = 2**31 - 1  # sorts documents behind their spill's runs


def spilled(docs: DataFrame, path_a: str, path_b: str, radixes: int) -> DataFrame:
    """The written table of runs (radix, ..) and documents (ordinal, ..)."""
    schema = pa.schema([("spill", pa.int64()), ("radix", pa.int32()), ("frames", pa.list_(pa.binary())), ("pairs", pa.int32()), ("records", pa.int32()),
                        ("docs", pa.binary()), ("ordinal", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                        ("n_groups", pa.int64()), ("groups_sha256", pa.string())])

    def gather(batches):
        from pyspark import TaskContext

        aligner = worker_state(f"aligner {path_a} {path_b}", lambda: Aligner(path_a, path_b))
        part = TaskContext.get().partitionId() << 32

        def rows():
            held, number = Spill(aligner), part

            def written():
                for radix, frames, pairs, records, data in held.runs(radixes):
                    yield number, radix, frames, pairs, records, data, None, None, None, None, None, None
                for k, (doc_id, n_a, n_b, n_groups, sha) in enumerate(held.rows()):
                    yield number, LAST, None, None, None, None, k, doc_id, n_a, n_b, n_groups, sha

            for some in in_groups(rows_of(batches, "doc_id", "text"), lambda r: len(r[1] or ""), GROUP):
                held.add(some)
                if held.chars >= SPILL_CHARS:
                    yield from written()
                    held, number = Spill(aligner), number + 1
            yield from written()

        yield from emit(schema, rows())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(gather, f"{_RUN}, {_DOC}"), "spills")


def pair_counts(table: DataFrame) -> DataFrame:
    """spill, radix, counts: for every run the corpus-wide counts of its pairs
    in their order, best ones marked (zstd: counts, then a byte each)."""
    schema = pa.schema([("spill", pa.int64()), ("radix", pa.int32()), ("counts", pa.binary())])

    def merge(batches):
        def answered(spills, runs, radix):
            import zstandard

            zip_ = zstandard.ZstdCompressor(level=3).compress
            blocks = list(counted(merged(runs)))
            codes, counts, best = (np.concatenate([b[k] for b in blocks]) for k in range(3))
            for spill, frames in zip(spills, runs):
                at = np.searchsorted(codes, np.concatenate([c for c, _ in run_frames(frames)]))
                yield spill, radix, zip_(counts[at].astype("<i8").tobytes() + best[at].astype(np.uint8).tobytes())

        def rows():
            here, spills, runs = None, [], []
            for radix, spill, frames in rows_of(batches, "radix", "spill", "frames"):
                if radix != here:
                    if runs:
                        yield from answered(spills, runs, here)
                    here, spills, runs = radix, [], []
                spills.append(spill)
                runs.append(frames)
            if runs:
                yield from answered(spills, runs, here)

        yield from emit(schema, rows())

    return table.where(F.col("radix") < LAST).select("radix", "spill", "frames").repartition("radix").sortWithinPartitions("radix", "spill") \
        .mapInArrow(merge, "spill long, radix int, counts binary")


def alignment(docs: DataFrame, path_a: str, path_b: str, radixes: int | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of every row of ``docs`` (doc_id, text)."""
    if radixes is None:
        radixes = 1 << min(15, max(6, (docs.count() >> 16).bit_length()))
    table = spilled(docs, path_a, path_b, radixes)
    counts = stage(pair_counts(table), "pair_counts")
    filled = table.select("spill", "radix", F.lit(0).alias("kind"), "pairs", "records", "docs", *[c.split()[0] for c in _DOC.split(", ")])
    back = counts.select("spill", "radix", F.lit(1).alias("kind"), F.col("counts").alias("docs"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                        ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    columns = ["spill", "radix", "kind", "pairs", "records", "docs", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def add_up(batches):
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress

        def rows():
            here, total, run = None, None, None
            for spill, radix, kind, pairs, records, data, ordinal, doc_id, n_a, n_b, n_groups, sha in rows_of(batches, *columns):
                if spill != here:
                    here, total = spill, np.zeros((2, 0), dtype=np.int64)  # count_sum, n_best
                if radix == LAST:
                    count_sum, n_best = total[:, ordinal].tolist() if ordinal < total.shape[1] else (0, 0)
                    yield doc_id, n_a, n_b, n_groups, n_groups, n_best, count_sum, sha  # a group has one link
                elif kind == 0:
                    run = pairs, records, np.frombuffer(unzip(data), "<u4")
                else:
                    n, m, raw = run
                    pair, doc, times = np.repeat(np.arange(n), raw[:n]), raw[n:n + m], raw[n + m:].astype(np.int64)
                    data = unzip(data)
                    counts, best = np.frombuffer(data, "<i8", n), np.frombuffer(data, np.uint8, n, 8 * n)
                    if (more := int(doc.max()) + 1 - total.shape[1]) > 0:
                        total = np.pad(total, ((0, 0), (0, more)))
                    np.add.at(total[0], doc, times * counts[pair])
                    np.add.at(total[1], doc, times * best[pair])

        yield from emit(schema, rows())

    missing = [F.lit(None).cast(filled.schema[c].dataType).alias(c) for c in ("pairs", "records")]
    names = [c.split()[0] for c in _DOC.split(", ")]
    back = back.select("spill", "radix", "kind", *missing, "docs", *[F.lit(None).cast(filled.schema[c].dataType).alias(c) for c in names])
    return filled.unionByName(back).repartition("spill").sortWithinPartitions("spill", "radix", "kind", "ordinal").mapInArrow(
        add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
