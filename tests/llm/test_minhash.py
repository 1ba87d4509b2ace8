import random
from collections import defaultdict

import numpy as np
import pytest
from edge import EDGE, documents, empty, prose

from alloy.llm import minhash
from alloy.llm.components import components


def brute_sets(rows, size):
    out = []
    for _, t, *_ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        n = min(size, len(w))
        out.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    return out


def brute(rows, size, percent=80):
    sets = brute_sets(rows, size)
    root = {i: i for i, *_ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][0], rows[b][0]
            if x is None or y is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(x), find(y)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i), find(i) == i) for (i, *_), s in zip(rows, sets, strict=True) if i is not None)


def edited(text, edits, rng):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def family_rows(seed, members, words, edits, start=1000):
    """A text and edits of it, around the threshold."""
    rng = random.Random(seed)
    base = prose(seed, words)
    return [(start + i, edited(base, rng.randrange(edits + 1), rng), "en", "s") for i in range(members)]


def result(docs, **how):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in minhash.near_duplicates(docs, **how).collect() if r.doc_id is not None)


def test_equals_brute_force(spark):
    rows = [*EDGE, *family_rows(11, 60, 150, 6), *family_rows(12, 25, 60, 3, 2000), *family_rows(13, 12, 400, 30, 3000),
            (4000, prose(11, 150).upper(), "en", "s"), (4001, " ".join(prose(11, 150).split()) + "\n", "en", "t")]
    rng = random.Random(3)
    rng.shuffle(rows)
    assert result(documents(spark, rows), size=4) == brute(rows, 4)


@pytest.mark.parametrize("divide", [1, 16])
def test_odd_members_in_small_blocks(spark, monkeypatch, divide):
    """A chain: neighbours are similar, the ends of a bucket are not; in blocks of buckets and of divided ones."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    monkeypatch.setattr(minhash, "DIVIDE", divide)
    w = prose(5, 400).split()
    rows = [(100 - k, " ".join(w[4 * k:4 * k + 120]), "en", "s") for k in range(40)]
    rows += family_rows(21, 40, 60, 4)
    assert result(documents(spark, rows), size=4) == brute(rows, 4)


def test_similar_sets_share_a_rare_shingle():
    """Whatever the counts that order them, and at the threshold itself."""
    rng = np.random.default_rng(4)
    for n in (1, 2, 4, 5, 9, 10, 99, 100, 400):
        for percent in (80, 95, 100):
            counts = rng.integers(0, 5, minhash.PLACES)
            y = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            x = np.sort(rng.permutation(y)[:-(-percent * n // 100)])  # a part of y that just holds the similarity
            assert minhash.similar(x, y, percent)
            assert np.intersect1d(minhash.rarest(x, counts, percent), minhash.rarest(y, counts, percent)).size
            assert len(minhash.rarest(y, counts, percent)) == n - -(-percent * n // 100) + 1
    assert len(minhash.rarest(np.zeros(0, np.uint64), counts, 80)) <= 1


def template_rows(n, own, rng):
    """Pages of one template, each with words of its own: far from the threshold."""
    base = prose(31, 90)
    return [(k, base + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(own)), "en", "s") for k in range(n)]


def test_pages_of_a_template_grow_in_proportion(spark, monkeypatch):
    """No block of a large bucket meets every other; links are those of brute force."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "DIVIDE", 1)
    rows, seen = {}, minhash.stored

    def counting(df, name):
        out = seen(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(minhash, "stored", counting)
    sizes = []
    for n in (250, 500, 1000):
        rng = random.Random(n)
        given = template_rows(n, 40, rng)
        given += [(5000 + k, edited(given[k][1], 2, rng), "en", "s") for k in range(20)]
        rows.clear()
        got = result(documents(spark, given), size=4)
        assert rows["minhash-large"] > 100  # the buckets are large ones
        if n == 250:
            assert got == brute(given, 4)
        assert sum(i >= 5000 and not kept for i, _, _, kept in got) >= 15
        sizes.append(rows.get("minhash-sides", 0) + rows["minhash-rarest"])
    assert sizes[2] < 5 * sizes[0], sizes


def test_rows_without_an_id(spark):
    rows = [(None, prose(1, 50), "en", "s"), (3, prose(1, 50), "en", "s"), (None, prose(2, 50), "en", "s")]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(None, 3, False), (3, 3, True), (None, None, True)}
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_signatures_estimate_the_similarity():
    a, b = minhash.shingles(prose(1, 900).encode().split(), 4), minhash.shingles(prose(1, 800).encode().split(), 4)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(true - same) < 0.12
    assert minhash.least_agreement(0.8) < 0.8 * minhash.BANDS * minhash.ROWS
    assert not minhash.similar(a[:10], a, 80) and minhash.similar(a[:80], a[:100], 80)


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {(r.node, r.component_id) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(x, find(x)) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_with_several_texts(spark):
    """A document is linked with all that any text of its id is linked with."""
    a, b, c, d = (prose(k, 60) for k in (21, 22, 23, 24))
    rows = [(5, a, "en", "s"), (5, b, "en", "s"), (9, b + " z", "en", "s"), (3, c, "en", "s"), (9, c, "en", "s"),
            (7, d, "en", "s"), (7, d, "en", "s"), (8, d + " y", "en", "s"), (None, a + " x", "en", "s"), (None, prose(25, 40), "en", "s"),
            (5, None, "en", "s"), (12, " ", "en", "s")]
    got = minhash.near_duplicates(documents(spark, rows), 4, 0.8).collect()
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_shingles"] > 0, r["component_id"], r["kept"]))
    assert len(got) == len(rows)
    assert by[9] == {(True, 3, False)} and by[3] == {(True, 3, True)}
    assert by[5] == {(True, 3, False), (False, 5, True)}
    assert by[7] == {(True, 7, True)} and by[8] == {(True, 7, False)} and by[12] == {(False, 12, True)}
    assert by[None] == {(True, 3, False), (True, None, True)}
