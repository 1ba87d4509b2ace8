import re

from pyspark.sql import functions as F

from alloy.llm import url_filter
from alloy.llm.queries import URL_RULES, listed_urls

URLS = [
    None, "", "no scheme", "http://", "http://Example.NET/en/1", "http://example.net/fr/1", "https://www.a.com/x/?utm_source=q&id=2#f",
    "http://a.com/x?id=2", "http://a.com/x/", "http://notnet/", "http://b.net", "http://b.net/", "http://sub.example.com/de/1?x",
    "http://example.com/de", "http://q.org/fr/9", "http://q.org/en/9", "ftp://x://y/z", "http://a.com?ref=1", "http://İ.com/A\n/b",
    "http://a.com/x/", "http://a.com:80/x", "http://a.com/" + "long/" * 20_000,
    "https://a.com:443/x", "https://a.com:80/x", "http://a.com:/x", "http://me:pw@a.com/x", "http://A.com./x", "http://a.com.:80/x",
    "http://a.com.:81/x", "http://a.com/%e4x%2f%zz%", "http://a.com/%E4x%2F%zz%", "HTTPS://www.a.com:443/x?gclid=1&q=%c3%9f", "http://@/x",
]


def brute(url, listed):
    m = re.search(r"://", url or "")
    rest = url[m.end():] if m else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host)
    rule, verdict = None, "block" if key(url) in listed else "allow"
    for kind, h, p in sorted(URL_RULES, key=lambda r: len(r[1] + r[2])):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rule, verdict = h + p, kind
    return host, path, rule, verdict


def key(url):
    m = re.search(r"://", url or "")
    rest = url[m.end():] if m else ""
    host = re.split(r"[/?#]", rest)[0]
    after = rest[len(host):].split("#")[0]
    path, _, query = after.partition("?")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), host).split("@")[-1]
    port = "443" if m and url[:m.start()].lower() == "https" else "80"
    name, colon, given = host.rpartition(":")
    if colon and given in ("", port):
        host, colon = name, ""
    if colon and given.isdigit():
        host = name.rstrip(".") + ":" + given
    else:
        host = host.rstrip(".")
    if not host:
        return None
    kept = [p for p in query.split("&") if p and not re.match(url_filter.TRACKING, p)]
    rest = path.rstrip("/") + ("?" + "&".join(kept) if kept else "")
    return re.sub(r"^www\.", "", host) + re.sub("%[0-9a-fA-F]{2}", lambda x: x[0].upper(), rest)


def test_verdicts_equal_brute_force_for_any_filter_size(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, "http://a.com/x")], "page_id long, url string")
    pages = pages.selectExpr("*", "'c' AS host", "'c' AS verdict", "'c' AS URL_KEY")
    names = ["a.com/x?id=2", "a.com/x", "q.org/fr/9", "a.com/x"]
    listed = spark.createDataFrame([(n,) for n in names] + [(None,)], "url_key string")
    want = sorted((i, *brute(u, set(names))) for i, u in enumerate(URLS))
    for blocks in (1, 64, url_filter.BLOCKS):
        got = url_filter.filter_urls(pages, listed, URL_RULES, blocks).select(
            "page_id", "host", "path", "rule", "verdict").collect()
        assert sorted(tuple(r) for r in got if r.page_id is not None) == want
        assert [r.verdict for r in got if r.page_id is None] == ["block"]


def test_the_filter_passes_every_listed_key_and_few_others(spark):
    keys = spark.range(5000).selectExpr("concat('host', id, '.com/p') AS url_key")
    bits = url_filter.bloom(keys, "url_key", 1 << 12)
    assert url_filter.with_possible(keys, "url_key", bits, 1 << 12).where("__possible").count() == 5000
    others = spark.range(5000).selectExpr("concat('other', id, '.com/p') AS url_key")
    assert url_filter.with_possible(others, "url_key", bits, 1 << 12).where("__possible").count() < 50


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "url_key string")
    assert url_filter.filter_urls(none, listed, URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.filter_urls(one, listed).collect()[0].verdict == "allow"


def test_canonical_urls_equal_plain_ones(spark):
    got = spark.createDataFrame([(u,) for u in URLS], "url string").select("url", url_filter.canonical(F.col("url")).alias("k"))
    for r in got.collect():
        assert r["k"] == (key(r["url"]) or None), r["url"]
    assert key("https://a.com:443/x") == key("http://me:pw@a.com/x") == key("http://a.com.:80/x") == "a.com/x"


def test_the_list_decides_and_not_the_host(spark):
    """At sf0.01 a clean page is listed for another page of its URL, while its host's other pages pass."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = url_filter.filter_urls(pages, listed_urls(pages)).toPandas()
    listed = set(found[found.listed].host)
    assert listed and listed & set(found[~found.listed].host)
    junk = pages.where(F.regexp_count("html", F.lit(r"[#%*$]{3}")) >= 10).limit(1).select(
        F.lit(10 ** 6).cast("long").alias("page_id"), F.concat(F.regexp_replace("url", "#.*", ""), F.lit("#other")).alias("url"),
        F.lit("<p>clean</p>").alias("html"))
    more = pages.unionByName(junk)
    got = url_filter.filter_urls(more, listed_urls(more)).where("page_id = 1000000").first()
    assert got["listed"]


def test_false_positives_are_removed_by_the_join(spark):
    """A filter of one block passes many unlisted keys; the join lists none of them."""
    keys = spark.range(40).selectExpr("concat('host', id, '.com/p') AS url_key")
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://host', id, '.com/p') AS url")
    rows = pages.select("page_id", url_filter.canonical(F.col("url")).alias("url_key"))
    passed = url_filter.with_possible(rows, "url_key", url_filter.bloom(keys, "url_key", 1), 1).where("__possible").count()
    assert passed > 45
    got = url_filter.filter_urls(pages, keys, blocks=1)
    assert got.where("listed").count() == 40 and got.count() == 3000


def test_a_hot_listed_url_is_split(spark, tmp_path):
    """A third of the pages on one listed URL: its partition is cut in the exact join."""
    pages = spark.range(60_000).selectExpr("id AS page_id", "CASE WHEN id % 3 = 0 THEN 'http://a.com/x' ELSE concat('http://b', id, '.com/') END AS url")
    pages.repartition(8).write.parquet(str(tmp_path / "pages"))
    listed = spark.range(30_000).selectExpr("concat('b', id * 2, '.com') AS url_key").union(spark.sql("SELECT 'a.com/x'"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = url_filter.filter_urls(spark.read.parquet(str(tmp_path / "pages")), listed)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert sum(r["listed"] for r in rows) == 20_000 + sum(1 for i in range(60_000) if i % 3 and i % 2 == 0 and i < 60_000)
