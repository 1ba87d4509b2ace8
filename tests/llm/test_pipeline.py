"""Each stage of corpus_pipeline against a brute-force version on its own input."""

import hashlib

import public_tokenizers as P
from edge import EDGE, documents, empty, prose
from test_minhash import brute as brute_components
from test_secret_scan import PATH

import corpus_pipeline as cp
from alloy.llm import importance, mixing, secret_scan
from alloy.llm.byte_bpe import encoding
from alloy.llm.common import stored, table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_stages_on_the_smallest_tables(spark, tmp_dir):
    docs = table(spark, SF, "documents").select(*COLUMNS)
    some = docs.where("doc_id = 7").collect()[0]
    text = " ".join(reversed(some.text.split())) + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" the end'
    docs = stored(docs.unionByName(spark.createDataFrame([(9001, text, "en", some.source, len(text))], docs.schema)), "t")
    first = {r.doc_id: r for r in docs.collect()}
    kept = importance.resample(docs, table(spark, SF, "labels")).where("kept").toPandas().doc_id
    good = stored(cp.quality(spark, docs, SF), "t")
    assert rows(good) == sorted((tuple(first[i]) for i in kept), key=str)
    marks = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    assert {i for i, r in marks.items() if r.quality == 1 and not r.toxic} - set(kept) == set()

    single = stored(cp.dedup(spark, good, SF), "t")
    want = {i for i, _, _, k in brute_components([tuple(r)[:4] for r in good.collect()], 5) if k}
    assert {r.doc_id for r in single.collect()} == want and single.count() == len(want) < good.count()

    clean = stored(cp.secrets(spark, single, SF), "t")
    enc = encoding(PATH, P.PATTERN)
    changed = 0
    for r in clean.collect():
        text = first[r.doc_id].text
        base = secret_scan.base_spans(text)
        spans = base + secret_scan.random_spans(enc, text, base, 2.2)
        assert r.text == secret_scan.redacted(text, spans) and r.n_chars == len(r.text)
        changed += r.text != text
    assert changed > 0 and clean.count() == single.count()

    mixed = stored(cp.mix(spark, clean, SF), "t")
    by = {r.doc_id: tuple(r) for r in clean.collect()}
    plan = mixing.mix_plan_rows(clean).toPandas()
    assert rows(mixed) == sorted((by[r.doc_id] for r in plan.itertuples() for _ in r.draws), key=str)

    last = cp.tokens(spark, mixed, SF).collect()
    assert len(last) == mixed.count()
    for r in last:
        ids = enc.encode_ordinary(by[r.doc_id][1] or "")
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    docs.write.parquet(f"{tmp_dir}/documents.parquet")  # the whole run over the same rows as the stages, 9001 with them
    table(spark, SF, "labels").write.parquet(f"{tmp_dir}/labels.parquet")
    assert sorted(map(tuple, cp.run(spark, tmp_dir).collect())) == sorted(map(tuple, last))


def test_dedup_judges_rows_not_ids(spark):
    """Several texts of one doc_id, and groups of rows without a doc_id."""
    copies = [(None, prose(2, 80), "en", "s")] * 3
    given = [(1, prose(1, 80), "en", "s"), (1, prose(50, 80), "en", "s"), (1, prose(90, 80), "en", "s"),
             (0, prose(50, 80), "en", "s"), (None, prose(1, 80), "en", "s"), *copies,
             (4, None, "en", "s"), (4, None, "en", "s"), (4, " ", "en", "s"), (None, "", "en", "s"), (None, "", "en", "s")]
    want = [given[0], given[2], given[3], copies[0], *given[-5:-4], *given[-3:]]
    names = ["doc_id", "text", "lang", "source"]
    docs = documents(spark, given, clash=False)
    for n in (1, 3, 7):
        got = cp.dedup(spark, docs.repartition(n), SF)
        assert got.columns == names
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    near = prose(7, 200)
    ties = documents(spark, [(3, near, "en", "a"), (3, near + " more", "en", "b"), (5, near, "en", "c")], clash=False)
    stay = {tuple(r) for n in (1, 2, 3) for r in cp.dedup(spark, ties.repartition(n), SF).collect()}
    assert len(stay) == 1 and stay.pop()[0] == 3


def test_stages_take_awkward_rows(spark):
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "secret scans",
                     "mixing sources to target weights", "byte-level BPE"]
    for start in (documents(spark, clash=False), empty(spark)):
        docs = start.selectExpr("*", "CAST(length(text) AS long) AS n_chars", "'c' AS kept", "'c' AS size",
                                "'c' AS score", "'c' AS component_id", "'c' AS n_tokens", "'c' AS redacted")
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, SF)
            if k < len(cp.STAGES) - 1:
                assert out.columns == docs.columns
            docs = stored(out, "t")
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_dedup_keeps_one_row_of_a_repeated_document(spark):
    docs = documents(spark, clash=False).selectExpr("*", "CAST(length(text) AS long) AS n_chars")
    got = [r.doc_id for r in cp.dedup(spark, docs, SF).collect()]
    assert sorted(i for i in got if i) == [1, 2, 3, 4, 6, 9, 10, 11]  # 5 is a copy of 1; 6 came twice
    assert got.count(None) == sum(i is None for i, *_ in EDGE)
