import re

import pytest

from ledgerlens.llm import decontaminate as op


def brute(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(window, len(iw))
            for s in range(len(iw) - n + 1) if n else ():
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == iw[s:s + n]:
                        hit.update(range(k, k + n))
                        ids |= {str(item_id)} - {"None"}
        out.append((doc_id, len(w), len(hit), len(ids), op.sha256_of(sorted(ids)), bool(hit)))
    return sorted(out, key=str)


L = "one two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(3, L), (12, "Short item"), (7, ""), (8, None), (None, "null id here"), (9, "été À la"), (12, "Short item"), (30, L.upper())]
DOCS = [(1, f"zz {L} yy"), (2, L.replace(" ", "--\n")), (3, None), (4, ""), (5, "a short, ITEM shortitem"), (6, "null ID here? null id"),
        (7, L.replace("six", "6")), (8, (L + " ") * 300), (None, "short item short item"), (1, f"zz {L} yy"), (9, "x été À la, Été à la"),
        (10, "one two three four five six seven eight nine ten"), (11, "."), (12, "two three four five six seven eight nine ten eleven x short item")]


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_matches_brute_force(spark, block):
    docs = spark.createDataFrame([(*d, 1, 2) for d in DOCS], "doc_id long, text string, n_words int, item_ids int").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = op.digest(op.scan(docs, items, keep=["doc_id"], block_bytes=block))
    assert sorted(map(tuple, got.collect()), key=str) == brute(DOCS, ITEMS)


def test_spans_map_to_the_original():
    text = "Ünïcode — a SHORT,\nitem! end"
    n, hit, ids, spans = op.scan_text(op.build([("12", "short item")]), text)
    assert (n, hit, ids) == (6, 2, ["12"])
    assert [text[s["start"]:s["end"]] for s in spans] == ["SHORT,\nitem"]


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "short item", 9), (2, "fine", 8), (None, None, 7)], "doc_id long, text string, contamination int")
    got = op.clean(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == [(2, "fine", 8), (None, None, 7)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert op.digest(op.scan(docs, items)).where("contaminated").count() == 0
    assert op.scan(docs.limit(0), items).count() == 0
