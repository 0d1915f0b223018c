"""Operator 6: benchmark decontamination with one Aho-Corasick automaton.

Text and items are normalised the same way: A-Z lower-cased, words are runs
of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, joined by one space.
The patterns are the items' windows of ``window`` consecutive words (a
shorter item is one window).  Each text is scanned once; a match's end maps
to a word number, and hit words map back to character spans of the original
text.

The automaton is built in each task from the items' words.  Items beyond
``block_bytes`` of normalised text are dealt into blocks of that size, one
automaton and one pass a block, so that its memory has a bound whatever the
size of the benchmark; the passes' hits add up.

Null and empty texts have no words and no hits; items without words match
nothing; an item with a null id marks words but is not listed; repeated
items count once.  Other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import ALNUM_TABLE, stage

WINDOW = 10
BLOCK_BYTES = 256 << 10

RESULT = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
RESULT_DDL = "struct<n_words:bigint,n_hit:bigint,item_ids:array<string>,spans:array<struct<start:bigint,end:bigint>>>"


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split() if text else []
    last = max(0, len(words) - window)
    return [b" " + b" ".join(words[i:i + window]) + b" " for i in range(last + 1)] if words else []


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW):
    """One automaton; a pattern's value is its word count and item ids."""
    import ahocorasick

    owners = defaultdict(set)
    for item_id, text in items:
        for w in item_windows(text, window):
            owners[w].add(item_id)
    automaton = ahocorasick.Automaton()
    for w, ids in owners.items():
        automaton.add_word(w.decode("latin-1"), (w.count(b" ") - 1, tuple(i for i in ids if i is not None)))
    automaton.make_automaton()
    return automaton if owners else None


def scan_text(automaton, text: str | None) -> tuple[int, int, list, list]:
    """n_words, n_hit, item ids as sorted strings, character spans."""
    if not text:
        return 0, 0, [], []
    raw = text.encode("utf-8", "surrogatepass").translate(ALNUM_TABLE)
    words = raw.split()
    if not words or automaton is None:
        return len(words), 0, [], []
    normal = b" " + b" ".join(words) + b" "
    hits = list(automaton.iter(normal.decode("latin-1")))
    if not hits:
        return len(words), 0, [], []
    gaps = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    ids = set()
    for end, (n, owners) in hits:
        after = int(np.searchsorted(gaps, end))
        edge[after - n] += 1
        edge[after] -= 1
        ids.update(owners)
    hit = np.cumsum(edge[:-1]) > 0
    return len(words), int(hit.sum()), sorted(ids), spans_of(text, raw, hit)


def spans_of(text: str, raw: bytes, hit: np.ndarray) -> list[dict]:
    """Character spans in ``text`` of runs of hit words."""
    inside = np.concatenate([[0], (np.frombuffer(raw, np.uint8) != 32).astype(np.int8), [0]])
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    runs = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    original = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    chars = np.concatenate([[0], np.cumsum((original & 0xC0) != 0x80)])  # characters before each byte
    return [{"start": int(chars[start[a]]), "end": int(chars[end[b]])} for a, b in zip(first, last)]


def merge(old: dict | None, new: tuple) -> tuple:
    """Adds one pass's hits to the earlier passes'.  The hit count follows
    from the joined spans, counted again by the caller."""
    if not old or not old["n_hit"]:
        return new
    spans = sorted([(s["start"], s["end"]) for s in old["spans"]] + [(s["start"], s["end"]) for s in new[3]])
    joined: list[list[int]] = []
    for a, b in spans:
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return new[0], -1, sorted({*old["item_ids"], *new[2]}), [{"start": a, "end": b} for a, b in joined]


def words_in(text: str, spans: list[dict]) -> int:
    return sum(len(text[s["start"]:s["end"]].encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split()) for s in spans)


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "contamination", keep: list[str] | None = None,
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (of its columns, ``keep``) with a struct column ``out``:
    n_words, n_hit, item_ids and spans."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        last = k == blocks - 1
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        held = spark.sparkContext.broadcast([tuple(r) for r in mine.distinct().collect()])  # about block_bytes
        columns = (keep if last else list(dict.fromkeys([*keep, text])))
        more = k > 0

        def one_pass(batches, held=held, columns=columns, more=more):
            automaton = build(held.value, window)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                found = [scan_text(automaton, t) for t in texts]
                if more:
                    before = batch.column(batch.schema.get_field_index(out)).to_pylist()
                    found = [merge(o, f) for o, f in zip(before, found)]
                    found = [f if f[1] >= 0 else (f[0], words_in(t, f[3]), f[2], f[3]) for f, t in zip(found, texts)]
                column = pa.array([dict(zip(("n_words", "n_hit", "item_ids", "spans"), f)) for f in found], type=RESULT)
                kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, column], names=[*columns, out])

        need = list(dict.fromkeys([*columns, text, *([out] if more else [])]))
        schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(out, T._parse_datatype_string(RESULT_DDL))])
        docs = docs.select(*need).mapInArrow(one_pass, schema)
        if not last:
            docs = stage(docs, "decontaminate")
    return docs


def digest(scanned: DataFrame, out: str = "contamination") -> DataFrame:
    """The query's columns from the operator's struct."""
    c = F.col(out)
    return scanned.select(
        "doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["item_ids"], ","), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Only documents without a hit, columns as they were."""
    out = "contamination"
    while out in docs.columns:
        out = "_" + out
    return scan(docs, benchmark, out=out).where(F.col(out)["n_hit"] == 0).drop(out)


def sha256_of(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


# The same in SQL over whole tables: windows as lists, joined by equality.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[k:k + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS k FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT dw.doc_id, dw.k, dw.n, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(s) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
