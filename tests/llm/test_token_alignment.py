import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import token_alignment as op

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, libraries):
    """Whole texts through both libraries."""
    a, b = libraries
    of = op.byte_alphabet()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, x, y = [], [], [], []
        if text:
            e = a.encode(" " + text, add_special_tokens=False)
            ids_a, x = e.ids, [bytes(of[c] for c in a.id_to_token(k)) for k in e.ids]
            ids_b = b.encode(text)
            pieces = [b.id_to_piece(k) for k in ids_b]
            y = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("\u2581", " ").encode() for k, p in zip(ids_b, pieces)]
            if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
                ids_a = ids_b = x = y = []
        end_a, end_b = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
        ends = sorted(set(end_a) & set(end_b))
        at_b = {}
        for q, j in zip(ids_b, end_b):
            at_b.setdefault(j, []).append(q)
        links = [(p, q) for p, i in zip(ids_a, end_a) for q in at_b.get(i, [])]
        cut = [0] + ends
        groups = ";".join(",".join(str(k) for k, e in zip(ids_a, end_a) if s < e <= t) + "|" + ",".join(str(k) for k, e in zip(ids_b, end_b) if s < e <= t)
                          for s, t in zip(cut, cut[1:]))
        counts.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest() if ids_a else ""))
    most = Counter()
    for (p, q), n in counts.items():
        most[q] = max(most[q], n)
    return [(i, n_a, n_b, n_g, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha) for i, n_a, n_b, n_g, links, sha in docs]


def texts():
    rnd = random.Random(4)
    words = "the of and Haus cat's don't 2024 1,000 x=y() naïve Straße 東京タワー 한국어 \u0301e \U0001f600 \ufeff foo\nbar <s> </s> <0x41> <|endoftext|> e\u0301 a\u00a0b _x_ \t".split(" ")
    gaps = [" ", " ", " ", " ", " ", "  ", "\n", " \n", "\t", "", "   ", "\u2003", "\r\n", "\u3000 "]
    for _ in range(300):
        yield "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(1, 30)))


ROWS = [(1, None), (2, ""), (3, " "), (4, "   "), (5, " lead"), (6, "trail "), (7, "\n"), (8, "with \u2581 mark"), (9, "\u2581"), (10, "nul \0 byte"), (None, "no id here"),
        (11, "same same same"), (11, "same same same"), (12, "a" * 3000), (13, "foo\n"), (14, "foo\n bar foo\n"), (15, "x" + " y" * 500), (16, "\u00a0 x \u0085 y"),
        (17, "<s> </s> <unk> <0x0A> <|endoftext|>"), (18, "word " * 4000 + "end")]


def frame(spark, rows):
    return spark.createDataFrame([(t, 1, i, "r", b"d") for i, t in rows], "text string, n_a int, doc_id long, radix string, docs binary").repartition(4)


@pytest.mark.parametrize("spill", [op.SPILL_CHARS, 50])
def test_query_equals_whole_texts(spark, libraries, monkeypatch, spill):
    rows = ROWS + [(100 + k, t) for k, t in enumerate(texts())]
    aligner = op.Aligner(A, B)
    got = op.alignment(frame(spark, rows), A, B, radixes=8).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, libraries)))
    monkeypatch.setattr(op, "SPILL_CHARS", spill)
    monkeypatch.setattr(op, "FRAME", 16)
    assert local(rows, aligner, 4) == sorted(map(repr, brute(rows, libraries)))


def local(rows, aligner, radixes):
    """The same steps without Spark, with many small spills and frames."""
    spills, held = [], op.Spill(aligner)
    for i, t in rows:
        held.add([(i, t)])
        if held.chars >= op.SPILL_CHARS:
            spills.append(held)
            held = op.Spill(aligner)
    spills.append(held)
    runs = [(s, *run) for s in spills for run in s.runs(radixes)]
    counts = {}
    for r in range(radixes):
        mine = [x[2] for x in runs if x[1] == r]
        for codes, n, best in op.counted(op.merged(mine)):
            assert not set(codes.tolist()) & set(counts)
            counts.update(zip(codes.tolist(), zip(n.tolist(), best.tolist())))
    out = []
    for s in spills:
        for doc, got in zip(s.rows(), s.parts):
            links = [c for k in got.tolist() for c in s.pairs[k]]
            out.append((*doc[:4], len(links), sum(counts[c][1] for c in links), sum(counts[c][0] for c in links), doc[4]))
    return sorted(map(repr, out))


def test_given_documents(spark, libraries):
    from ledgerlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op11_token_alignment"](spark, sf).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows, libraries)))


def test_empty(spark):
    assert op.alignment(frame(spark, []), A, B).count() == 0
