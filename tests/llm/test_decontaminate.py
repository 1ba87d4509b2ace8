import re

import numpy as np
import pytest
from edge import EDGE, LONG, documents, empty, prose

from alloy.llm import decontaminate as dc
from alloy.llm.common import pick

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, items, size):
    windows = {}
    for name, text in items:
        w = WORD.findall(lower(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(name)
    out = []
    for i, text in docs:
        w, hit, held = WORD.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    held |= x
        out.append((i, len(w), len(hit), sorted(held, key=lambda s: (s is None, s or ""))))
    return sorted(out, key=str)


def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string").selectExpr("*", "'x' AS TEXT", "1 AS items", "2 AS __n")


SHARED = prose(77, 25)
ITEMS = [("1", prose(50, 40)), ("10", prose(50, 12)), ("2", "Two WORDS"), ("3", SHARED), ("4", SHARED + " " + prose(78, 9)),
         ("4", prose(79, 11)), (None, prose(80, 15)), ("5", None), ("6", " ...! "), ("7", ""), ("8", "é ß"), ("1", prose(50, 40))]
DOCS = [(r[0], r[1]) for r in EDGE] + [
    (20, prose(50, 40).upper()), (21, prose(1, 30) + ", " + SHARED.replace(" ", " -- ") + "; " + prose(2, 30)),
    (22, prose(50, 9)), (23, "two\nwords two words"), (24, SHARED + " " + SHARED), (25, prose(80, 15)[3:]), (26, "É ß é ß"),
    (27, LONG[:200_000] + " " + SHARED)]


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=str)


def doc_frame(spark, rows=DOCS):
    return documents(spark, [(i, t, "en", "a") for i, t in rows])


@pytest.mark.parametrize("size", [1, 3, 10])
def test_equals_brute_force(spark, size):
    got = found(dc.contamination(doc_frame(spark), items_frame(spark, ITEMS), size=size))
    assert got == brute(DOCS, ITEMS, size)
    assert any(n for _, _, n, _ in got)


def test_a_large_benchmark_is_scanned_in_parts(spark):
    many = ITEMS + [(str(100 + k), prose(k, 1500)) for k in range(12)]
    docs = DOCS + [(300 + k, prose(k, 60)) for k in range(12)]
    parts = list(dc._parts(items_frame(spark, many), 10, 64 << 10))
    assert len(parts) > 1
    got = found(dc.contamination(doc_frame(spark, docs), items_frame(spark, many), max_bytes=64 << 10))
    assert got == brute(docs, many, 10)


def test_long_items_are_dealt_in_chunks_and_long_texts_split_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE", 1000)
    text = (LONG + " " + SHARED).encode()
    assert b"".join(dc.pieces(text)) == text and len(list(dc.pieces(text))) > 100
    item = prose(5, 3 * dc.CHUNK)
    got = found(dc.contamination(doc_frame(spark, [(1, item), (2, prose(5, 40))]), items_frame(spark, [("a", item)])))
    assert got == [(1, 3 * dc.CHUNK, 3 * dc.CHUNK, ["a"]), (2, 40, 40, ["a"])]


def test_windows_of_one_hash_get_another_seed(monkeypatch):
    rows = [("a", b"one two three"), ("b", b"four five six")]
    real = dc._hash
    monkeypatch.setattr(dc, "_hash", lambda ids, at, size, seed: real(ids, at, size, seed) * np.uint64(seed > 1))
    part = dc.part_of(rows, 2)
    assert part.seed == 2 and len(part.windows[0].hashes) == 4


def test_spans_and_documents_are_removed(spark):
    docs, items = doc_frame(spark), items_frame(spark, ITEMS)
    cut = dc.decontaminated(docs, items)
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    texts = {r["doc_id"]: r["text"] for r in pick(cut, "doc_id", "text").collect() if r["doc_id"] is not None}
    assert texts[21] == prose(1, 30) + ", ; " + prose(2, 30)
    assert texts[20] == texts[23] == "" and texts[22] == prose(50, 9) and texts[2] is None
    again = dc.contamination(cut, items)
    assert all(r["n_hit"] == 0 for r in again.collect())
    kept = dc.decontaminated(docs, items, remove="documents")
    clean = [(i, t) for i, t in DOCS if brute([(i, t)], ITEMS, 10)[0][2] == 0]
    assert sorted(((r["doc_id"], r["text"]) for r in pick(kept, "doc_id", "text").collect()), key=str) == sorted(clean, key=str)
    with pytest.raises(ValueError):
        dc.decontaminated(docs, items, remove="rows")


def test_empty_tables(spark):
    none = items_frame(spark, [])
    assert dc.contamination(empty(spark), items_frame(spark, ITEMS)).count() == 0
    got = found(dc.contamination(doc_frame(spark), none))
    assert got == brute(DOCS, [], 10)


def test_cut_runs():
    assert dc.cut_runs(b"a, B c! d", [1, 3]) == b"a, ! d"
    assert dc.cut_runs(b"a b", []) == b"a b"
    assert dc.cut_runs(b"a b c", [0, 1, 2, 3]) == b" b "
