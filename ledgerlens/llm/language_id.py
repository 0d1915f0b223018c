"""Operator 9: language identification by cross-parsing entropy.

Per language, the suffix automaton of a sample of labelled text.  A text is
parsed against it greedily: a phrase is the longest match from where the last
one ended, so a restart of the automaton is a new phrase.  A language that
shares long substrings with the text needs few phrases; ``phrases * log2(size
of the sample)`` bits is the cross-parsing entropy, and the language with the
least wins (ties: the first in alphabetical order).

Letters are lower-cased, every run of other characters is one space, and
letters that no sample holds match nothing.  Codes are bytes, so of more than
247 letters in all samples only the most frequent are told apart and the others
match nothing either: languages that differ in rarer letters alone are not.  Texts are cut into segments of
``SEGMENT`` characters, parsed in lock step by table lookup; a cut adds at
most one phrase a segment, for every language alike.

The fit is bounded by parameters: of each language at most ``SAMPLE_DOCS``
documents of ``LONGEST`` characters at most, chosen by a hash of the id, and
``SAMPLE_CHARS`` characters of those.  Prediction reads every whole text.

``score``: the winner's share, 1 / sum over languages of exp(their surplus of
normalised phrases over the winner's): near 1 where the decision is clear,
1 / languages where nothing tells them apart.  Null texts, texts without a
letter and an empty training set give ``und`` with score 0.  Rows with a null
doc_id are predicted, never learned from.  Repeated rows are separate rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import add_column, free_name

SAMPLE_DOCS = 24
LONGEST = 8000
SAMPLE_CHARS = 32768
SEGMENT = 256
UNKNOWN = "und"
LEAST_SCORE = 0.3

PAD, SPACE, STRANGE = 0, 1, 2  # codes before those of the letters
RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64())])
RESULT_DDL = "struct<lang:string,score:double>"


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray     # code point -> code
    table: np.ndarray    # (state * codes + code) -> next row << 1 | restarted
    root: np.ndarray     # each language's first row
    bits: np.ndarray     # log2 of each sample's size


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def code_table(letters: str) -> np.ndarray:
    code = np.full(0x110000, SPACE, dtype=np.uint8)
    code[[i for i in range(0x110000) if chr(i).isalpha()]] = STRANGE
    number = {c: k + STRANGE + 1 for k, c in enumerate(letters)}
    for c, k in number.items():
        code[ord(c)] = k
        for up in (c.upper(), c.title()):
            if len(up) == 1 and up.lower() == c:
                code[ord(up)] = k
    return code


def encode(text: str, code: np.ndarray) -> np.ndarray:
    """Codes with runs of spaces as one, none at the ends."""
    got = code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = got == SPACE
    keep = ~space
    keep[:-1] |= space[:-1] & ~space[1:]  # the last space of a run
    got = got[keep]
    return got[1:] if len(got) and got[0] == SPACE else got


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        new, p = len(step), last
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


def build(samples: dict[str, str]) -> Model:
    """samples: language -> text."""
    langs = sorted(k for k, v in samples.items() if any(c.isalpha() for c in v))
    letters = sorted({c for k in langs for c in samples[k].lower() if c.isalpha()})
    if len(letters) > 250 - STRANGE:  # the rest match nothing
        count = {}
        for k in langs:
            for c in samples[k].lower():
                count[c] = count.get(c, 0) + 1
        letters = sorted(sorted(letters, key=lambda c: (-count[c], c))[:250 - STRANGE])
    code = code_table("".join(letters))
    width = len(letters) + STRANGE + 1
    tables, roots, bits, base = [], [], [], 0
    for k in langs:
        codes = encode(samples[k], code)
        step = suffix_automaton(codes.tolist())
        go = np.zeros((len(step), width), dtype=np.int64)
        for state, out in enumerate(step):
            for c, to in out.items():
                go[state, c] = to
        go[:, STRANGE] = 0
        table = np.where(go > 0, (go * width + base) << 1, ((go[0] * width + base) << 1) | 1)
        table[:, PAD] = (np.arange(len(step)) * width + base) << 1
        tables.append(table.ravel())
        roots.append(base)
        bits.append(math.log2(len(codes) + 1))
        base += table.size
    table = np.concatenate(tables) if tables else np.zeros(0, dtype=np.int64)
    return Model(langs, code, table.astype(np.int32) if base < 2**30 else table, np.array(roots, dtype=np.int64), np.array(bits))


def phrases(segments: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of each segment (a row, padded) against each language."""
    state = np.repeat(model.root[:, None], len(segments), axis=1).astype(model.table.dtype)
    count = np.zeros(state.shape, dtype=np.int32)
    for column in np.ascontiguousarray(segments.T).astype(model.table.dtype):
        got = model.table[state + column]
        count += got & 1
        state = got >> 1
    return (count + 1).T


def identify(texts: list[str | None], model: Model, width: int = SEGMENT, most: int = 4096) -> list[dict]:
    """lang and score of each text."""
    out: list[dict] = [{"lang": UNKNOWN, "score": 0.0} for _ in texts]
    if not model.langs:
        return out
    total = np.zeros((len(texts), len(model.langs)), dtype=np.int64)
    held, owner = [], []

    def flush():
        if held:
            codes = np.zeros((len(held), width), dtype=np.uint8)
            for row, part in zip(codes, held):
                row[: len(part)] = part
            np.add.at(total, owner, phrases(codes, model))
            held.clear()
            owner.clear()

    for k, text in enumerate(texts):
        codes = encode(text, model.code) if text else ()
        if not len(codes) or codes.max() < STRANGE:
            continue
        for at in range(0, len(codes), width):
            held.append(codes[at:at + width])
            owner.append(k)
            if len(held) >= most:
                flush()
    flush()
    weighed = total * (model.bits / model.bits.max())
    for k in np.flatnonzero(total[:, 0]):
        surplus = weighed[k] - weighed[k].min()
        best = int(np.argmin(surplus))
        out[k] = {"lang": model.langs[best], "score": float(1 / np.exp(-surplus).sum())}
    return out


# ------------------------------------------------------------------ Spark

def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, longest: int = LONGEST, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the labelled rows outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= longest) & ~held_out())
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    # only rows near the head of the hash order are ranked: about four times
    # the sample of each language, however many rows it has
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * sample_docs) / F.col("n"))
    bound = sizes.select("lang", F.when(share >= 1, F.lit(2**63 - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long")).alias("bound"))
    near = rows.join(F.broadcast(bound), "lang").where(F.col("h") <= F.col("bound"))  # one row a language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    picked = near.withColumn("rank", rank).where(F.col("rank") <= sample_docs).select("lang", "rank", "text").collect()
    samples: dict[str, str] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["rank"])):
        samples[r["lang"]] = (samples.get(r["lang"], "") + " " + r["text"])[:sample_chars]
    return build(samples)


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column ``out``: lang and score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = held.value
        return lambda texts: identify(texts, model)

    return add_column(docs, make, [text], out, RESULT_DDL, RESULT, keep)


def identified(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = predict(rows, fit(docs), keep=["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """Documents in one of the learned languages, columns as they were: those
    without letters or whose languages can't be told apart go."""
    out = free_name(docs, "language")
    got = predict(docs, fit(docs), out=out)
    return got.where((F.col(out)["lang"] != UNKNOWN) & (F.col(out)["score"] >= least)).drop(out)
