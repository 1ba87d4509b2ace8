"""Parquet tables in a layer root, replaced whole or not at all (IO4-IO6).

A layer (bronze, silver, gold) is a folder or bucket prefix with one
sub-folder per table.  Every write goes to a fresh folder below the table's
(a *version*).  Which versions are current is said by the layer's manifest,
a small numbered JSON file below ``_manifests``; ``publish`` writes the next
one, for one table or for several at once, and ``read_table`` resolves it.
So a job that fails after its start leaves the old rows readable, tables
published together change together, and a plan may read the table that it
replaces.

A manifest is created under its number only if there is none of that number
yet and is read only when it is complete, so a writer that dies while
writing one leaves the last one in force.  One application at a time should
write a layer that lies in a store without exclusive creation.  Old versions
stay until ``drop_old`` removes them by age: readers that have resolved them
can finish.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
COMPRESSION = "zstd"
WEEK = 7 * 24 * 3600.0

_publishing = threading.Lock()


class ConcurrentPublish(RuntimeError):
    """Another writer keeps publishing to the same layer."""


@dataclass(frozen=True)
class Entry:
    """A table of a manifest: its folders below the table's, and what they were made from.

    ``made_from`` is a fingerprint that the writer chose; ``layout`` says how
    the rows are laid out (see ``alloy.sources.bucketed``).
    """

    folders: tuple[str, ...]
    made_from: str | None = None
    layout: dict | None = None


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    tables: dict[str, Entry] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """A written version that isn't published yet."""

    root: str
    name: str
    folder: str
    made_from: str | None = None
    layout: dict | None = None

    @property
    def path(self) -> str:
        return f"{table_path(self.root, self.name)}/{self.folder}"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# ------------------------------------------------------------------ manifests

def _store(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _listed(spark: SparkSession, path: str) -> list:
    """File statuses right below a folder; none if it doesn't exist."""
    fs, p = _store(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _store(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark: SparkSession, root: str) -> dict[int, object]:
    """Number → file status of every manifest of a layer."""
    found = _listed(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    named = {s.getPath().getName().removesuffix(".json"): s for s in found}
    return {int(n): s for n, s in named.items() if n.isdigit()}


def _load(spark: SparkSession, root: str, number: int) -> Manifest | None:
    """The manifest of a number; None if its writer didn't finish it."""
    try:
        tables = json.loads(_read_text(spark, f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json"))
    except json.JSONDecodeError:
        return None
    return Manifest(number, {t: Entry(tuple(e["folders"]), e.get("made_from"), e.get("layout"))
                             for t, e in tables.items()})


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The manifest in force: the newest complete one."""
    for n in sorted(_numbers(spark, root), reverse=True):
        if (found := _load(spark, root, n)) is not None:
            return found
    return Manifest()


def _create(spark: SparkSession, root: str, number: int, tables: dict[str, Entry]) -> bool:
    """Write the manifest of a number; False if there is one already."""
    text = json.dumps({t: {"folders": list(e.folders), "made_from": e.made_from, "layout": e.layout}
                       for t, e in sorted(tables.items())}, indent=1)
    fs, p = _store(spark, f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json")
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


# ------------------------------------------------------------------ writing

def stage_table(df: DataFrame, root: str, name: str, partition_by: Sequence[str] | None = None,
                max_records_per_file: int | None = None, made_from: str | None = None) -> Staged:
    """Write ``df`` as a version of table ``name`` that no reader sees yet.

    A failing job's folder is removed; the table is as it was.
    """
    staged = Staged(root, name, f"v-{uuid.uuid4().hex}", made_from)
    writer = df.write.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    try:
        writer.parquet(staged.path)
    except Exception:
        drop_staged(df.sparkSession, [staged])
        raise
    return staged


def drop_staged(spark: SparkSession, staged: Iterable[Staged]) -> None:
    """Remove versions that won't be published."""
    for s in staged:
        fs, p = _store(spark, s.path)
        fs.delete(p, True)


def publish(spark: SparkSession, staged: Sequence[Staged], append: bool = False, tries: int = 20) -> int:
    """Make versions current, all of one layer at the same moment; the manifest's number.

    ``append`` adds them to their tables' current folders instead of
    replacing these.  If another writer publishes first, its tables are kept
    and the next number is tried.
    """
    roots = {s.root.rstrip("/") for s in staged}
    if len(roots) != 1:
        raise ValueError(f"a publish is of one layer: {sorted(roots)}")
    (root,) = roots
    with _publishing:  # stores like a local disk don't create a file exclusively
        for _ in range(tries):
            now = manifest(spark, root)
            tables = dict(now.tables)
            for s in staged:
                old = tables[s.name].folders if append and s.name in tables else ()
                tables[s.name] = Entry((*old, s.folder), s.made_from, s.layout)
            number = max(_numbers(spark, root), default=0) + 1
            if _create(spark, root, number, tables):
                return number
    raise ConcurrentPublish(f"{root}: no free manifest number after {tries} tries")


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                max_records_per_file: int | None = None, made_from: str | None = None) -> str:
    """Write ``df`` as table ``name`` below ``root``, publish it, and return the version's path.

    ``mode``: ``overwrite`` replaces the table, ``append`` adds to it.  ``df``
    may read the table itself.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode}: overwrite or append")
    staged = stage_table(df, root, name, partition_by, max_records_per_file, made_from)
    publish(df.sparkSession, [staged], append=mode == "append")
    return staged.path


# ------------------------------------------------------------------ reading

def current_paths(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders of the table's current rows; the table's own folder if the layer's manifest doesn't list it."""
    return _paths(manifest(spark, root).tables.get(name), table_path(root, name))


def _paths(entry: Entry | None, base: str) -> list[str]:
    if entry is None:
        return [base]
    parts = [f"/{p}" for p in entry.layout["parts"]] if entry.layout else [""]
    return [f"{base}/{f}{p}" for f in entry.folders for p in parts]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy scan of the current version: filters and column choices reach the Parquet reader."""
    entry = manifest(spark, root).tables.get(name)
    reader = spark.read
    if entry and entry.layout:  # a bucketed folder without rows has no files
        reader = reader.schema(StructType.fromJson(entry.layout["schema"]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [reader.parquet(p) for p in _paths(entry, table_path(root, name))])


def read_staged(spark: SparkSession, staged: Staged) -> DataFrame:
    return spark.read.parquet(staged.path)


# ------------------------------------------------------------------ clearing

def drop_old(spark: SparkSession, root: str, older_than: float = WEEK, now: float | None = None) -> list[str]:
    """Remove versions that have not been current for ``older_than`` seconds; their paths.

    Kept are the folders of the manifest in force, those of manifests that a
    newer one replaced less than ``older_than`` seconds ago, and folders
    changed since then (they may be being written).
    """
    before = ((time.time() if now is None else now) - older_than) * 1000
    numbers = _numbers(spark, root)
    force = manifest(spark, root).number
    if not force:
        return []
    keep, stale = set(), []
    order = sorted(n for n in numbers if n <= force)
    for n, after in zip(order, [*order[1:], None]):
        if after is None or numbers[after].getModificationTime() >= before:
            found = _load(spark, root, n)
            keep |= {(t, f) for t, e in (found.tables if found else {}).items() for f in e.folders}
        else:
            stale.append(numbers[n].getPath())
    gone = []
    for table in {t for n in order for t in (_load(spark, root, n) or Manifest()).tables}:
        for s in _listed(spark, table_path(root, table)):
            name = s.getPath().getName()
            if name.startswith("v-") and (table, name) not in keep and s.getModificationTime() < before:
                fs, p = _store(spark, s.getPath().toString())
                fs.delete(p, True)
                gone.append(p.toString())
    for p in stale:
        fs, _ = _store(spark, root)
        fs.delete(p, False)
    return gone
