"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.llm import (byte_bpe, decontaminate, importance, language_id, line_frequency, minhash, mixing, ring, rp_forest,
                       secret_scan, target_resampling, url_filter, whitening)
from alloy.llm.common import pick, table

RANKS = "byte_bpe_50k.tiktoken"

#: Fixed values of the URL contract.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Pages whose html holds this many runs of symbols make up the list of URLs.
SYMBOL_RUNS, MOST_RUNS = r"[#%*$]{3}", 10
#: op2 draws this share of the documents that weigh as much as good ones.
DRAWN = 0.9


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_quality(table(spark, sf_dir, "documents"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), share=DRAWN)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.linked_vectors(table(spark, sf_dir, "embeddings"), similarity=0.98)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, similarity=0.8)


def listed_urls(pages: DataFrame) -> DataFrame:
    """Canonical URLs of the pages whose html is full of symbols; a NULL html is none of them.

    Other pages of the same canonical URL (by another scheme, host prefix,
    port or query) are listed with them, whatever their own html holds.
    """
    junk = F.regexp_count("html", F.lit(SYMBOL_RUNS)) >= MOST_RUNS
    return pick(pages, "url", "html").where(junk).select(url_filter.canonical(F.col("url")).alias("url_key"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, listed_urls(pages), URL_RULES)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan_rows(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.size("draws") * F.col("size")).cast("long").alias("taken"), "draws")


def op8_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_line_frequency, op2_importance_resampling, op3_byte_bpe, op4_rp_forest, op5_minhash, op6_url_filter, op7_mix_sources, op8_ring_shards, op9_language_id,
    op10_secret_scan, op11_decontaminate, op12_whitening, op13_target_resampling)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {
    "op1_line_frequency": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs),
windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows),
found AS (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1),
hit AS (SELECT r, unnest([i, i + 1, i + 2]) AS pos FROM grams JOIN found USING (r, g)),
repeats AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM hit GROUP BY r),
split AS (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM docs),
full_lines AS (SELECT * FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY r),
normal AS (
  SELECT source, text, trim(regexp_replace(regexp_replace(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT DISTINCT source, text, r0.line, r0.k FROM (
    SELECT source, text, line, row_number() OVER (PARTITION BY r, line) AS k FROM full_lines) r0) u),
lines AS (
  SELECT source, text, line, count(*) * (len(string_split(line, ' '))) AS size
  FROM normal GROUP BY source, text, line),
per_host AS (SELECT source, count(DISTINCT text) AS texts FROM docs GROUP BY source),
frequent AS (
  SELECT l.source, l.line FROM lines l JOIN per_host h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.texts HAVING count(*) > 10 AND count(*) > 0.01 * h.texts),
gone AS (
  SELECT l.source, l.text, sum(l.size) AS gone FROM lines l JOIN frequent f
  ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line GROUP BY l.source, l.text),
stats AS (
  SELECT d.doc_id, d.source, d.text, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs d JOIN words w USING (r) LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT s.*, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    CAST(n_words - coalesce(g.gone, 0) AS BIGINT) AS n_words_left
  FROM stats s LEFT JOIN gone g ON s.source IS NOT DISTINCT FROM g.source AND s.text = g.text)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_words_left,
  (NOT base_failed AND n_words_left >= 0.3 * n_words AND n_words_left >= 50) AS kept
FROM judged""",
    "op4_rp_forest": r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counts ON e.vec_id = a""",
    "op5_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
pairs AS (
  SELECT a, b FROM common JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)""",
    "op6_url_filter": r"""
WITH parts AS (
  SELECT page_id, html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1), '') AS query,
    lower(regexp_extract(url, '(?s)^(.*?)://', 1)) = 'https' AS secure
  FROM pages),
keyed AS (
  SELECT *, array_to_string(list_filter(string_split(query, '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)=')), '&') AS kept,
    regexp_replace(regexp_replace(host, '(?s)^.*@', ''),
      CASE WHEN secure THEN ':(443)?\z' ELSE ':(80)?\z' END, '') AS name
  FROM parts),
canon AS (
  SELECT *, CASE WHEN name <> '' THEN regexp_replace(regexp_replace(name, '\.+((:[0-9]+)?)\z', '\1'), '^www\.', '')
      || array_to_string(list_transform(string_split(regexp_replace(path, '/+\z', '')
      || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END, '%'), lambda s, i: CASE
        WHEN i > 1 AND regexp_matches(s, '^[0-9a-fA-F]{2}') THEN upper(s[:2]) || s[3:] ELSE s END), '%') END AS url_key
  FROM keyed),
listed AS (
  SELECT DISTINCT url_key FROM canon
  WHERE len(regexp_extract_all(html, '[#%*$]{3}')) >= 10),
rules(kind, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (
  SELECT page_id, host, path, url_key,
    (SELECT arg_max(h || p, length(h || p)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule
  FROM canon)
SELECT b.page_id, b.host, b.path, b.rule,
  coalesce(r.kind, CASE WHEN l.url_key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  b.url_key, l.url_key IS NOT NULL AS listed
FROM best b LEFT JOIN rules r ON b.rule = r.h || r.p
LEFT JOIN listed l ON b.url_key = l.url_key""",
    "op11_decontaminate": r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs CROSS JOIN lengths WHERE len(w) >= n)),
found AS (SELECT p.r, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
hit AS (
  SELECT r, count(DISTINCT pos) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, n, i FROM found)) GROUP BY r),
held AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN held USING (r)""",
}
