"""URL filter: a blocked Bloom filter, then an exact join for its hits.

The listed canonical URLs set bits in a filter of a fixed number of 512-bit
blocks.  The filter is the only broadcast and its size is a parameter, not
the list's: a longer list makes more false positives, never wrong verdicts,
because every possible hit is joined with the list itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.llm.common import pick, splittable_text

#: verdict, host, path: a rule holds for its host and all subdomains.
Rule = tuple[str, str, str]
BLOCKS = 1 << 16  # 512-bit blocks: 4 MB
WORDS = 8  # 64-bit words of a block; a key sets one bit in each
#: Query parameters that name a campaign and not a page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)="


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(_lower_ascii(host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1), F.lit(""))


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _percent_case(c: Column) -> Column:
    """Hexadecimal digits of percent codes as capitals."""
    return F.array_join(F.transform(F.split(c, "%", -1), lambda p, i: F.when(
        (i > 0) & p.rlike("^[0-9a-fA-F]{2}"), F.concat(F.upper(F.substring(p, 1, 2)), F.substr(p, F.lit(3)))).otherwise(p)), "%")


def canonical(url: Column) -> Column:
    """The key of a page: its host without user, default port, closing dots and a
    leading ``www.``, its path without closing slashes, and its query without
    tracking parameters; percent codes in capitals.  Scheme and fragment go.
    NULL without a host."""
    host = F.regexp_replace(host_of(url), r"(?s)^.*@", "")
    secure = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1)) == "https"
    host = F.regexp_replace(host, F.when(secure, r":(443)?\z").otherwise(r":(80)?\z"), F.lit(""))
    host = F.regexp_replace(F.regexp_replace(host, r"\.+(?=(:[0-9]+)?\z)", ""), r"^www\.", "")
    kept = F.array_join(F.filter(F.split(query_of(url), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)), "&")
    return F.when(host != "", F.concat(
        host, _percent_case(F.regexp_replace(path_of(url), r"/+\z", "")),
        F.when(kept != "", F.concat(F.lit("?"), _percent_case(kept))).otherwise("")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit for each word of the block, six hash bits each."""
    h = F.xxhash64(key, F.lit(7))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def bloom(keys: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of a key column: (__block, __w0 … __w7), one row per block in use."""
    k = F.col(key)
    bits = keys.where(k.isNotNull()).select(
        _block(k, blocks).alias("__block"), *[m.alias(f"__w{i}") for i, m in enumerate(_masks(k))])
    return bits.groupBy("__block").agg(*[F.bit_or(f"__w{i}").alias(f"__w{i}") for i in range(WORDS)])


def with_possible(rows: DataFrame, key: str, bits: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` with ``__possible``: false if the filter proves the key unlisted."""
    k = F.col(key)
    hit = reduce(lambda a, b: a & b, [
        F.col(f"__w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(k))])
    return (rows.withColumn("__block", _block(k, blocks))
            .join(F.broadcast(bits), "__block", "left")  # at most `blocks` rows of 72 bytes
            .withColumn("__possible", k.isNotNull() & F.coalesce(hit, F.lit(False)))
            .drop("__block", *[f"__w{i}" for i in range(WORDS)]))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text like ``net/``, and its verdict; else NULLs."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest wraps last
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (),
                blocks: int = BLOCKS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, url_key, listed.

    ``listed`` has a column ``url_key`` of canonical URLs (repeats and NULLs
    are allowed).  The verdict is the longest fitting rule's, else ``block``
    if the page's canonical URL is listed, else ``allow``.  A NULL url, or
    one without ``://``, has an empty host and path and is allowed.  Repeated
    pages are judged row by row; an empty list lists nothing; other columns
    of ``pages`` are not read.
    """
    if blocks > 1 << 20:
        raise ValueError("blocks: the filter would be over 64 MB")
    url = F.col("url")
    rows = pick(pages, "page_id", "url").select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"),
        canonical(url).alias("url_key"))
    keys = listed.select("url_key").where(F.col("url_key").isNotNull())
    probed = with_possible(rows, "url_key", bloom(keys, "url_key", blocks), blocks)
    exact = splittable_text(keys.distinct(), "url_key").withColumn("listed", F.lit(True))
    # a hash join whatever the list's size: distinct keys, dealt evenly over the partitions;
    # AQE can split the pages of one hot URL
    hits = probed.where("__possible").join(exact.hint("shuffle_hash"), "url_key", "left").withColumn(
        "listed", F.coalesce("listed", F.lit(False)))
    missed = probed.where(~F.col("__possible")).withColumn("listed", F.lit(False))
    judged = missed.unionByName(hits)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "url_key", "listed")
