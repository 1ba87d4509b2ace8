import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import EDGE, documents, empty

from alloy.llm import language_id as li
from alloy.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = li.identify(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()
    sure = held[~held.rejected]
    assert len(sure) > 0.9 * len(held) and (sure.lang_pred == sure.lang).mean() >= 0.98


def test_only_the_text_decides_and_reruns_agree(spark):
    docs = table(spark, SF, "documents")
    model = li.train(*li.training_sample(docs, per_language=60))
    again = li.train(*li.training_sample(docs.repartition(5), per_language=60))
    assert (model.embedding == again.embedding).all()
    a = li.predict(docs, model).toPandas().set_index("doc_id")
    b = li.predict(docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source"), model).toPandas().set_index("doc_id")
    assert a.sort_index().equals(b.sort_index())


def test_edge_cases(spark):
    got = {r.doc_id: r for r in li.identify(documents(spark)).collect() if r.doc_id is not None}
    assert len(got) == len({i for i, *_ in EDGE if i is not None})
    for i in (2, 3, 4):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[10].lang_pred in {"en", "fr", "de"}
    assert li.identify(empty(spark)).count() == 0
    none = documents(spark, clash=False).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in li.identify(none).collect()} == {"und"}


def test_subwords_and_threshold():
    assert len(li.buckets("")) == 0 and len(li.buckets("123 ...")) == 0
    assert (li.buckets("Ab 1 cd") == li.buckets("ab, CD")).all()
    assert li._threshold(np.array([.9, .8, .7]), np.array([True, True, False]), 0.99) == .8


def test_no_language_is_left_out(spark):
    """201 languages, some of one document: all are learned; more than the sample's documents raise an error."""
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrstvz"]
    learned = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(learned[4 * k + i], " ".join(words[(k + j) % 200] + words[k % 200] for j in range(12)), f"l{k:03}", "a")
            for k in range(201) for i in range(1 + (k % 3))]
    langs = {r[2] for r in rows}
    assert len(langs) == 201
    texts, found = li.training_sample(documents(spark, rows))
    assert set(found) == langs and li.train(texts, found).languages == tuple(sorted(langs))
    with pytest.raises(ValueError, match="max_docs"):
        li.training_sample(documents(spark, rows), max_docs=100)


def subwords(text):
    """Bucket → count of the subwords of one to four bytes, by loops over words with their boundaries."""
    out = Counter()
    words = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in text.lower().encode("utf-8", "replace")).split()
    line = b" " + b" ".join(words) + b" "
    for n in li.SIZES:
        for i in range(len(line) - n + 1):
            g = line[i:i + n]
            if b" " in g[1:-1] or (g[:1] == b" " and g[-1:] == b" "):
                continue
            h = 0
            for k, byte in enumerate(g):
                h = (h * 1_099_511_628_211 + byte + k + 1) % 2 ** 64
            h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % 2 ** 64 >> 40
            out[h % li.BUCKETS] += 1
    return out


def test_predictions_equal_plain_loops(spark):
    docs = table(spark, SF, "documents").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10 ** 6 + i, t) for i, (_, t, *_) in enumerate(EDGE[:5] + EDGE[9:])]
    model = li.train(*li.training_sample(table(spark, SF, "documents"), per_language=60))
    got = {r["doc_id"]: r for r in li.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        if text is None or not any(c.isalpha() for c in text):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        grams = subwords(text)
        total = sum(grams.values())
        mean = [sum(n / total * float(model.embedding[b, d]) for b, n in grams.items()) for d in range(model.embedding.shape[1])]
        z = [sum(mean[d] * float(model.layer[d, k]) for d in range(len(mean))) / model.temperature for k in range(len(model.languages))]
        e = [math.exp(x - max(z)) for x in z]
        best = max(range(len(e)), key=e.__getitem__)
        assert got[i]["lang_pred"] == model.languages[best]
        assert got[i]["score"] == pytest.approx(e[best] / sum(e), abs=1e-4)
        assert got[i]["rejected"] == (got[i]["score"] < model.threshold)
