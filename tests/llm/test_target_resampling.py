import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from edge import EDGE, documents, empty, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from alloy.llm import target_resampling as tr
from alloy.llm.common import pick

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in [*w, *map(" ".join, zip(w, w[1:]))]]


def brute(docs, target, percent=25, least=20):
    s = Counter(b for _, t in docs for b in grams(t)[1])
    t = Counter(b for x in target for b in grams(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        n, g = grams(text)
        w = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([n >= least, i, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(order[:len(order) * percent // 100])}
    return sorted([(*r[1:], rank.get(id(r))) for r in rows], key=str)


DOCS = ([(r[0], r[1]) for r in EDGE] + [(1000 + i, prose(i % 40, 10 + i % 60)) for i in range(300)]
        + [(7, prose(50, 30))] * 90 + [(2000 + i, prose(51, 40)) for i in range(90)] + [(8, prose(52, 30)), (8, prose(53, 25))])
TARGET = [prose(50, 200), prose(3, 60), None, "", prose(50, 200)]


def frames(spark, docs=DOCS, target=TARGET):
    aim = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string").selectExpr("*", "1 AS TEXT", "2 AS buckets")
    return documents(spark, [(i, t, "en", "a") for i, t in docs]).selectExpr("*", "1 AS rank", "2 AS buckets", "3 AS total"), aim


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    got = rows_of(tr.resample(*frames(spark)))
    assert got == brute(DOCS, TARGET)
    assert sum(r[4] is not None for r in got) == sum(grams(t)[0] >= 20 for _, t in DOCS) // 4


def test_ranks_do_not_depend_on_partitions(spark):
    docs, aim = frames(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("1", "31"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(rows_of(tr.resample(docs.repartition(int(n)), aim, percent=60)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == brute(DOCS, TARGET, percent=60)


def test_no_group_of_equal_rows_is_sorted_in_one_task(spark):
    """All rows are equal: the range partitions still part them, and ranks are gapless."""
    docs, aim = frames(spark, [(1, prose(1, 30))] * 4000)
    got = tr.resample(docs.repartition(8), aim, percent=100)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 4001))
    rows = tr._weighed(pick(docs.repartition(8), "text", "doc_id"), aim, 10_000, 7, 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = [f for f in tr._ranked(rows, 100).inputFiles() if "/drawn-" in f]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = sorted(spark.read.parquet(f).count() for f in files)
    assert sum(sizes) == 4000 and sizes[-1] < 2000


def test_drawn_rows_keep_their_columns(spark):
    docs, aim = frames(spark)
    got = tr.resampled(docs, aim)
    assert got.columns == docs.columns
    want = Counter((r[0], r[1]) for r in brute(DOCS, TARGET) if r[4] is not None)
    assert Counter((r["doc_id"], len(grams(r["text"])[1])) for r in pick(got, "doc_id", "text").collect()) == want


def test_empty_tables(spark):
    docs, aim = frames(spark)
    assert tr.resample(empty(spark), aim).count() == 0
    assert rows_of(tr.resample(docs, aim.limit(0))) == brute(DOCS, [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 129), st.integers(1, 2 ** 21)), max_size=20), max_size=5), st.integers(0, 99))
def test_planes_add_up_to_the_dot_product(rows, seed):
    gain = np.random.default_rng(seed).integers(-30_000, 30_000, 130)
    rows = [dict(r) for r in rows]
    at = np.array([i for i, r in enumerate(rows) for _ in r], np.int64)
    bucket = np.array([b for r in rows for b in r], np.int64)
    count = np.array([c for r in rows for c in r.values()], np.int64)
    got = tr.sums(at, bucket, count, len(rows), 130, tr.bitplanes(np.maximum(gain, 0)), tr.bitplanes(np.maximum(-gain, 0)))
    assert got.tolist() == [sum(int(gain[b]) * c for b, c in r.items()) for r in rows]


def test_long_texts_are_split_between_words(monkeypatch):
    import alloy.llm.decontaminate as dc
    text = (prose(4, 3000) + " ÄÖ ß").encode()
    whole = tr.features(text)
    monkeypatch.setattr(dc, "PIECE", 50)
    n, found = tr.features(text)
    assert n == whole[0] and sorted(found) == sorted(whole[1])
