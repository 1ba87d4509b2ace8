"""Landing-zone discovery (IO2, IO3).

A table is named by its file: ``<table>.csv``, or a folder ``<table>.csv/``
of CSV part files, in the landing root or in any sub-folder.  Discovery is
one listing by Spark's file index (``binaryFile`` with only path and length
read, so no file content is loaded).  Only files whose name matches the glob
are kept, so notes, markers and other formats in the landing area are
ignored.  A name found in several places is one table: all its files are
read together, and the reader raises if their headers differ.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.sources.csv import file_print, read_csv

_SCHEME = re.compile(r"^[A-Za-z][\w+.-]*:")


@dataclass(frozen=True)
class LandingTable:
    """Where a table's files are: files and folders to read, and its largest file in bytes.

    ``files`` that hold anything, ``file_print`` a hash of their names (see
    ``csv.file_print``), and ``state``, a fingerprint of the paths, lengths
    and times of all files.
    """

    paths: tuple[str, ...]
    largest: int
    files: int = 0
    file_print: int = 0
    state: str = ""


def _root_tail(root: str) -> str:
    """Path of ``root`` without scheme and leading slashes, made absolute when local."""
    root = root.rstrip("/")
    if not _SCHEME.match(root):
        root = os.path.abspath(root)
    return _SCHEME.sub("", root).lstrip("/")


def list_landing(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """One row per landing file: ``path``, ``length``, ``modified``, ``file``, ``entry``, ``table_name``.

    ``entry`` is the file, or the outermost folder named like one, relative
    to the root; ``table_name`` is its last part without ``.csv``.  ``file``
    is the path as ``input_file_name`` spells it.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true")
             .load(root)
             .select("path", "length", F.col("modificationTime").alias("modified"),
                     F.input_file_name().alias("file")))
    # listed paths are qualified (``file:/…``, ``s3a://bucket/…``): anchor at the start
    below = F.regexp_extract("path", r"^[A-Za-z][\w+.-]*:/*" + re.escape(_root_tail(root)) + "/(.+)", 1)
    folder = F.regexp_extract(below, r"^((?:[^/]+/)*?[^/]+\.csv)/", 1)
    entry = F.when(folder != "", folder).otherwise(below)
    return (files.withColumn("entry", entry)
                 .withColumn("table_name", F.regexp_replace(
                     F.regexp_extract("entry", r"([^/]+)$", 1), r"\.csv$", "")))


def found_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame | None:
    """``list_landing``; None if the root doesn't exist."""
    try:
        return list_landing(spark, root, glob)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def landing_entries(spark: SparkSession, root: str, glob: str = "*.csv",
                    files: DataFrame | None = None) -> dict[str, LandingTable]:
    """Table name → its places below the root, in the order of their paths.

    One row per table reaches the driver.  A missing root has no tables.
    ``files``: the root's ``list_landing``, where it has been listed already.
    """
    files = found_files(spark, root, glob) if files is None else files
    if files is None:
        return {}
    rows = (files.groupBy("table_name")
            .agg(F.sort_array(F.collect_set("entry")).alias("entries"),
                 F.max("length").alias("largest"),
                 F.count_if(F.col("length") > 0).alias("files"),
                 file_print(F.col("file"), F.col("length") > 0).alias("file_print"),
                 F.concat_ws("-", F.count(F.lit(1)), F.sum("length"),
                             *[F.hex(F.bit_xor(F.xxhash64("path", "length", "modified", F.lit(k))))
                               for k in (0, 1)]).alias("state"))
            .collect())
    base = root.rstrip("/")
    return {r.table_name: LandingTable(tuple(f"{base}/{e}" for e in r.entries), int(r.largest),
                                       int(r.files), int(r.file_print), r.state)
            for r in sorted(rows, key=lambda r: r.table_name)}


#: Files whose lines are hashed one by one list; beyond, all files of their tables are read.
MOST_PATHS = 1000


def repeated_files(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """Files that hold the same lines as another: (file, table_name, length, first_file, first_table).

    None if there are none.  Two files can only be equal if their lengths
    are, so only files that share one with a file of another entry are read:
    their lines are hashed, in any order, in two ways of 64 bits.  The first
    of equal files is the oldest, on ties the one with the least path; part
    files of one folder are one drop and not compared with each other.
    """
    sizes = files.where(F.col("length") > 0).groupBy("length").agg(
        F.count_distinct("entry").alias("entries")).where(F.col("entries") > 1)
    alike = files.join(sizes.select("length"), "length")
    some = alike.select("path").limit(MOST_PATHS + 1).collect()
    if not some:
        return None
    paths = [r["path"] for r in some]
    if len(paths) > MOST_PATHS:
        paths = [r["folder"] for r in files.groupBy(F.regexp_extract("path", "^(.*)/", 1).alias("folder")).count().collect()]
    h = F.xxhash64("value")
    lines = (spark.read.option("recursiveFileLookup", "true").text(paths)
             .groupBy(F.input_file_name().alias("file"))
             .agg(F.count(F.lit(1)).alias("lines"), F.bit_xor(h).alias("h1"),
                  F.sum(F.xxhash64("value", F.lit(1)).cast("decimal(20,0)")).alias("h2")))
    same = ["length", "lines", "h1", "h2"]
    hashed = alike.join(lines, "file")
    firsts = hashed.groupBy(*same).agg(
        F.min(F.struct("modified", "path", "file", "entry", "table_name")).alias("first"))
    found = hashed.join(firsts, same).where(F.col("entry") != F.col("first.entry"))
    return found.select("file", "table_name", "length", F.col("first.file").alias("first_file"),
                        F.col("first.table_name").alias("first_table"))


def landing_tables(spark: SparkSession, root: str, glob: str = "*.csv") -> dict[str, list[str]]:
    """Table name → paths to read, for every table with at least one file."""
    return {name: list(t.paths) for name, t in landing_entries(spark, root, glob).items()}


def scan_landing(spark: SparkSession, root: str, glob: str = "*.csv") -> dict[str, DataFrame]:
    """Every landing table as an all-string DataFrame."""
    return {name: read_csv(spark, paths, glob=glob)
            for name, paths in landing_tables(spark, root, glob).items()}


def landing_counts(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """``table_name``, ``n_rows`` for every landing table (records, not lines)."""
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in scan_landing(spark, root, glob).items()]
    if not frames:
        return spark.createDataFrame([], "table_name string, n_rows bigint")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
