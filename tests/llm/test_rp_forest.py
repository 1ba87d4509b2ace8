import numpy as np
import pytest

from alloy.llm import rp_forest


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "'c' AS grp", "'c' AS n_links", "'c' AS LABEL")


def brute(rows, similarity):
    able = [(i, np.array(v, float), g) for i, v, g in rows
            if i is not None and v and g is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    ids = sorted({i for i, *_ in rows if i is not None})
    links = {i: set() for i in ids}
    for i, v, g in able:
        for j, w, h in able:
            if i < j and g == h and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= similarity:
                links[i].add(j)
                links[j].add(i)
    root = {i: i for i in ids}
    for _ in ids:
        root = {i: min([root[i], *(root[j] for j in links[i])]) for i in ids}
    return sorted((i, len(links[i]), root[i], root[i] == i) for i, *_ in rows if i is not None)


def clusters(rng, n, dim, labels, tight):
    """Random vectors, near copies, and one large tight group."""
    out = []
    for k in range(n):
        v = rng.standard_normal(dim)
        out.append((len(out), v.tolist(), int(k % labels)))
        for _ in range(rng.integers(0, 3)):
            out.append((len(out), (v + rng.standard_normal(dim) * rng.uniform(0.02, 0.3)).tolist(), int(k % labels)))
    centre = rng.standard_normal(dim)
    for _ in range(tight):
        out.append((len(out), (centre + rng.standard_normal(dim) * 0.12).tolist(), 0))
    out += [(len(out) + k, centre.tolist(), 0) for k in range(5)]
    return out


@pytest.mark.parametrize("leaf,block", [(512, 1024), (24, 1024), (24, 16)])
def test_links_equal_brute_force(spark, monkeypatch, leaf, block):
    """Small leaves make several rounds; small blocks split the tight group's leaves."""
    monkeypatch.setattr(rp_forest, "BLOCK", block)
    rows = clusters(np.random.default_rng(1), 150, 24, 2, 90)
    got = sorted(tuple(r) for r in rp_forest.linked_vectors(table_of(spark, rows), 0.98, leaf=leaf).collect())
    want = brute(rows, 0.98)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))  # no link below the threshold, none counted twice
    assert found >= 0.99 * there and there > 4000
    if leaf == 512:  # a single leaf a group: exact
        assert got == want


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    odd = [[0.0, 0.0], None, [], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0, 0.0]]
    rows = [(k, v, 1) for k, v in enumerate(odd)] + [
        (10, [1.0, 2.0], 1), (11, [2.0, 4.0], 1), (12, [1.0, 2.0], None), (13, [1.0, 2.0], None), (14, [1.0, 2.0], 2),
        (15, [1e200, 2e200], 1), (16, [1.0, 2.0], 1), (16, [1.0, 2.0], 1), (17, [-0.0, 1.0], 3), (18, [0.0, 1.0], 3)]
    got = sorted(tuple(r) for r in rp_forest.linked_vectors(table_of(spark, rows)).collect())
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got}
    assert all(by[k] == (0, k, True) for k in (*range(7), 12, 13, 14))
    assert by[10] == (3, 10, True) and all(by[k] == (3, 10, False) for k in (11, 15, 16))
    assert by[17] == (1, 17, True) and by[18] == (1, 17, False)
    none = table_of(spark, [(None, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)])
    assert {tuple(r) for r in rp_forest.linked_vectors(none).collect()} == {(None, 0, None, True), (1, 0, 1, True)}
    assert rp_forest.linked_vectors(table_of(spark, [])).count() == 0


def test_dense_nodes_are_leaves():
    rng = np.random.default_rng(2)
    ball = rp_forest.unit(np.ones(16) + rng.standard_normal((400, 16)) * 1e-3)
    assert rp_forest.fit(ball, 400, 0, 1, rp_forest._margin(0.98, 16), 32) == []
    spread = rp_forest.unit(rng.standard_normal((400, 16)))
    splits = rp_forest.fit(spread, 400, 0, 1, rp_forest._margin(0.98, 16), 32)
    parts = rp_forest.route(spread, 0, 1, {a: (t, p) for a, t, p in splits}, rp_forest._margin(0.98, 16))
    assert len(parts) > 4 and set(np.concatenate([r for _, r in parts])) == set(range(400))
