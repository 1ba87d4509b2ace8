"""A corpus pipeline of five stages over the table ``documents``.

Quality classifier, near-duplicate removal, secret redaction, mixing of the
sources, and token counts.  Each stage is written as Parquet and read again
as the next one's input; each works on all rows that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.llm import byte_bpe, importance, minhash, mixing, secret_scan
from alloy.llm.common import splittable, stored, table

RANKS = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance weights keep; the labels are those of the table ``labels``."""
    return importance.resampled(docs, table(spark, sf_dir, "labels"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8).

    Rows are judged one by one, by a number that is written with them.  Of
    a group the row with the least doc_id stays, on ties that with the least
    hash of the text; a row with a doc_id goes before rows without.  Rows
    without shingles are in no group; one of equal doc_id and text stays, and
    all without a doc_id.
    """
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "dedup-rows")
    found = minhash.near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), size=5, similarity=0.8)
    grouped = F.col("n_shingles") > 0
    keys = rows.select("__row", F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"))
    keys = (found.withColumnRenamed("doc_id", "__row").join(keys, "__row").where(grouped | F.col("__id").isNotNull())
            .select("__row", "__id", "__hash", grouped.alias("__grouped"),
                    F.when(grouped, F.col("component_id")).otherwise(F.col("__id")).alias("__group"),
                    F.when(grouped, F.lit(0)).otherwise(F.col("__hash")).alias("__same")))
    keys = stored(keys, "dedup-keys")
    group = ["__grouped", "__group", "__same"]
    first = (keys.groupBy(*group).agg(
        F.min(F.struct(F.col("__id").isNull(), "__id", "__hash", "__row"))["__row"].alias("__first"), F.count("*").alias("__n"))
        .where(F.col("__n") > 1).drop("__n"))
    gone = keys.join(splittable(first, "__group"), group).where(F.col("__row") != F.col("__first")).select("__row")
    return rows.join(gone, "__row", "left_anti").drop("__row")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by ``[secret]`` and n_chars counted anew."""
    out = secret_scan.redact_secrets(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a document is left out or repeated as the mix draws it."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    return byte_bpe.token_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", dedup), ("secret scans", secrets),
          ("mixing sources to target weights", mix), ("byte-level BPE", tokens)]

#: Hash draws, MinHash components and BPE are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
    return docs
