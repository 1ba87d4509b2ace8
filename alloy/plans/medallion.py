"""Layer runners (PL1-PL4): landing → bronze → silver → gold.

Each layer is a root folder (or bucket prefix) with one Parquet table per
sub-folder; every table is written by one Spark job and read back by the
next layer, so lineage never grows past one layer and a lost executor costs
at most a retried stage of the current job.

Tables are replaced by versions (``alloy.sources.parquet``): a failing job
leaves last run's rows readable.  Bronze loses no value: records that don't
fit their file's header go to the quarantine with their text, and a file
that ends inside a quoted value fails its table by name.  All gold tables of
a run are published at one moment, and only within the declared limits of
the quality checks, which run on the unpublished versions.

A failing table does not stop the others, but it is never hidden: tables
that depend on it are skipped, and the run raises ``LayerError`` at the end
listing every failure.  Each published table carries a fingerprint of what it
was made from, so a run with ``resume`` redoes only tables that failed or
whose inputs, specs or code have changed.

The tables of one layer are independent, so their jobs are submitted from
a few driver threads at once (``parallel``); Spark's scheduler interleaves
their stages, which keeps executors busy while one table's job is in a
short or skewed tail.  Layers still run in order.
"""

from __future__ import annotations

import functools
import hashlib
import inspect
import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.functions import cast, predicates, text
from alloy.operators import aggregate, clean, dedup, kpi, star
from alloy.operators.clean import clean_counted, empty_quarantine, quarantine, valid_rows
from alloy.plans import marketplace
from alloy.plans.jobs import DEFAULT_PARALLEL, described, each as _each
from alloy.plans.lake_checks import GOLD_INPUTS, gold_checks
from alloy.plans.marketplace import COLOCATED, GOLD_TABLES, KPI_TABLES, SILVER_SPECS, GoldTable, silver_post
from alloy.sources import csv
from alloy.sources.bucketed import bucketed_alike, hot_keys, join_bucketed, stage_bucketed
from alloy.sources.csv import OPEN, Checked, read_checked
from alloy.sources.landing import LandingTable, found_files, landing_entries, repeated_files
from alloy.sources.parquet import (WEEK, Staged, drop_old, drop_staged, manifest, publish, read_staged, read_table,
                                   stage_table, write_table)

OK = "ok"
KEPT = "kept"  # made from the same inputs by an earlier run
HELD = "held"  # written, but not published: a limit is exceeded
FAILED = "failed"
SKIPPED = "skipped"
UNMAPPED = "unmapped"
MISSING = "missing"
_DONE = (OK, KEPT)


class NoLandingFiles(RuntimeError):
    """The landing root holds no CSV file: nothing to ingest."""


class OpenQuote(ValueError):
    """A file ends inside a quoted value (a line does, in a table that is read line by line)."""


class NoHeader(ValueError):
    """A file without its table's header."""


class Misfits(ValueError):
    """Records that don't fit the header, and no quarantine to put them in."""


class LayerError(RuntimeError):
    """One or more tables of a run failed or were held back; ``report`` holds every status."""

    def __init__(self, report: dict[str, dict[str, str]], exceeded: Sequence[str] = ()):
        self.report = report
        failed = [f"{layer}/{t}: {s}" for layer, tables in report.items()
                  for t, s in tables.items() if s.startswith(FAILED)]
        held = [t for t, s in report.get("gold", {}).items() if s == HELD]
        said = ["tables failed: " + "; ".join(failed)] if failed else []
        if held:
            said.append(f"gold not published ({', '.join(exceeded)}): {', '.join(held)}")
        super().__init__(" | ".join(said))


@dataclass(frozen=True)
class Layout:
    """Roots of the layers. ``quarantine`` is optional (rejected rows)."""

    landing: str
    bronze: str
    silver: str
    gold: str
    quarantine: str | None = None


@dataclass(frozen=True)
class Limit:
    """Gold is published only if a check of ``lake_checks`` finds at most so many bad rows in a table."""

    check: str
    table: str
    most: int


@dataclass
class RunReport:
    bronze: dict[str, str] = field(default_factory=dict)
    silver: dict[str, str] = field(default_factory=dict)
    gold: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)  # "layer/table" → wall time
    largest_file: dict[str, int] = field(default_factory=dict)  # landing table → bytes, for information
    misfits: dict[str, dict[str, int]] = field(default_factory=dict)  # landing table → reason → records
    repeated: dict[str, dict[str, str]] = field(default_factory=dict)  # landing table → see ``run_bronze``
    checks: dict[str, int] = field(default_factory=dict)  # "check table" → bad rows, where limits were given
    exceeded: list[str] = field(default_factory=list)  # limits that hold gold back
    ingested: bool = False  # bronze ran in this run: tables it doesn't list are missing

    def as_dict(self) -> dict[str, dict[str, str]]:
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}

    def missing(self) -> list[str]:
        """Silver tables without landing files in this run; older outputs of theirs are left as they were."""
        return [t for t, s in self.silver.items() if s == MISSING]

    def failed(self) -> bool:
        return any(s.startswith(FAILED) or s == HELD for d in self.as_dict().values() for s in d.values())


def _timed(spark: SparkSession, report: RunReport, layer: str, name: str, work) -> str:
    """Run one table's work with a job description and record its wall time."""
    start = time.perf_counter()
    with described(spark, f"{layer}/{name}"):
        status = work()
    report.seconds[f"{layer}/{name}"] = round(time.perf_counter() - start, 3)
    return status


def _failure(e: Exception) -> str:
    return f"{FAILED}: {type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"


# ------------------------------------------------------------------ fingerprints

@functools.cache
def _code_print() -> str:
    """A hash of the code that the tables are made by."""
    modules = (cast, predicates, text, aggregate, clean, dedup, kpi, star, marketplace, csv)
    return hashlib.sha256("\n".join(inspect.getsource(m) for m in modules).encode()).hexdigest()


def _made_from(*parts) -> str:
    return hashlib.sha256(json.dumps([_code_print(), *parts], default=repr).encode()).hexdigest()


# ------------------------------------------------------------------ bronze

def landing_quarantine(name: str) -> str:
    """The quarantine table of a landing table's misfit records."""
    return f"{name}.landing"


def _misfits(name: str, table: LandingTable, checked: Checked, single: bool) -> dict[str, int]:
    """Records per reason that don't fit the header; raises for files that can't be read whole.

    If all odd records are headers, one of each file, there is nothing more
    to do; only else the files are read again.
    """
    seen = checked.seen.get
    if seen["n_odd"] == table.files and seen["header_files"] == table.file_print:
        return {}
    found = checked.misfits.groupBy("reason").agg(F.count("*").alias("n"), F.min("file").alias("file")).collect()
    reasons = {r["reason"]: r for r in found}
    if OPEN in reasons:
        where = "has a line that ends" if single else "ends"
        raise OpenQuote(f"{name}: {reasons[OPEN]['file']} {where} inside a quoted value")
    bare = checked.per_file.where("n_headers = 0").orderBy("file").first()
    if bare is not None:
        raise NoHeader(f"{name}: {bare['file']} has another header than the table's other files, or none")
    return {r: int(x["n"]) for r, x in sorted(reasons.items())}


def run_bronze(spark: SparkSession, layout: Layout, report: RunReport | None = None,
               parallel: int = DEFAULT_PARALLEL, single_line: Iterable[str] = (), resume: bool = False) -> RunReport:
    """PL1: every landing CSV table → Parquet, all columns as text.

    Tables with no silver spec are ingested as well and reported.  Records
    may span lines, so a file is read by one task, whatever its size.  Tables
    named in ``single_line`` are declared to hold no line breaks inside
    values and are read line by line, which Spark splits.  Either way the
    files are read once, or twice if there are records that don't fit.
    These go to the quarantine table ``<table>.landing`` (file, reason,
    record) and are counted in ``report.misfits``; without a quarantine they
    fail their table.  A file that ends inside a quoted value, or has not the
    table's header, fails its table before anything is published.

    Files that hold the same lines as an older file of their table, under
    another name or in another folder, are read once.  ``report.repeated``
    has for each table the number of such files (``skipped``), an example
    (``file``, ``first``), and ``other_table``, a table that holds a file
    equal to one of this table's; that one is read, as its name is its own.
    Sizes tell most files apart, so the check reads few.

    ``resume`` keeps tables whose files (paths, lengths and times) haven't
    changed since they were written.
    """
    report = report or RunReport()
    files = found_files(spark, layout.landing)
    found = landing_entries(spark, layout.landing, files=files)
    repeated = repeated_files(spark, files) if found else None
    extra = _repeated_by_table(repeated)
    single = set(single_line)
    now = manifest(spark, layout.bronze).tables if found else {}

    report.ingested = True
    report.repeated.update({n: r["said"] for n, r in extra.items()})
    report.largest_file.update({name: t.largest for name, t in found.items()})

    def one(name: str) -> str:
        table = found[name]
        try:
            made_from = _made_from("bronze", table.state, name in single, layout.quarantine)
            if resume and name in now and now[name].made_from == made_from:
                return KEPT if name in SILVER_SPECS else UNMAPPED
            skip = None
            if name in extra and extra[name]["files"]:
                skip = repeated.where((F.col("table_name") == name) & (F.col("first_table") == name))
                table = replace(table, files=table.files - extra[name]["files"],
                                file_print=table.file_print ^ extra[name]["file_print"])
            checked = read_checked(spark, list(table.paths), multi_line=name not in single, skip=skip)
            staged = stage_table(checked.rows, layout.bronze, name, made_from=made_from)
            try:
                misfits = _misfits(name, table, checked, name in single)
                _keep_misfits(spark, layout, name, checked, misfits)
            except Exception:
                drop_staged(spark, [staged])
                raise
            publish(spark, [staged])
            if misfits:
                report.misfits[name] = misfits
            return OK if name in SILVER_SPECS else UNMAPPED
        except Exception as e:  # isolate, report at the end
            return _failure(e)

    report.bronze.update(_each(
        found, lambda n: _timed(spark, report, "bronze", n, lambda: one(n)), parallel))
    return report


def _repeated_by_table(repeated: DataFrame | None) -> dict[str, dict]:
    """Per landing table, from one row each: what ``run_bronze`` reports, and number and print of the skipped files."""
    if repeated is None:
        return {}
    own = F.col("first_table") == F.col("table_name")
    rows = repeated.groupBy("table_name").agg(
        F.count_if(own).alias("files"), csv.file_print(F.col("file"), own).alias("file_print"),
        F.min(F.when(own, F.struct("file", "first_file"))).alias("x"),
        F.min(F.when(~own, F.col("first_table"))).alias("other")).collect()
    out = {}
    for r in rows:
        said = {"skipped": str(r["files"]), "file": r["x"]["file"], "first": r["x"]["first_file"]} if r["files"] else {}
        if r["other"]:
            said["other_table"] = r["other"]
        out[r["table_name"]] = {"files": r["files"], "file_print": r["file_print"], "said": said}
    return out


def _keep_misfits(spark: SparkSession, layout: Layout, name: str, checked: Checked, misfits: dict[str, int]) -> None:
    """Write the misfits to the quarantine; after a run without any, none are left there."""
    target = landing_quarantine(name)
    if misfits and not layout.quarantine:
        raise Misfits(f"{name}: records that don't fit the header and no quarantine for them: {misfits}")
    if misfits:
        write_table(checked.misfits, layout.quarantine, target)
    elif layout.quarantine and target in manifest(spark, layout.quarantine).tables:
        write_table(spark.createDataFrame([], checked.misfits.schema), layout.quarantine, target)


# ------------------------------------------------------------------ silver

def run_silver(spark: SparkSession, layout: Layout, report: RunReport | None = None,
               tables: Iterable[str] | None = None,
               parallel: int = DEFAULT_PARALLEL, resume: bool = False, buckets: int | None = None) -> RunReport:
    """PL2: each spec'd bronze table → clean table (and its rejected rows).

    How often keys repeat is counted first, by their hashes; if few do, the
    rows of the others are written without a shuffle.  The rejected rows are counted while the
    clean table is written; the quarantine reads bronze again only when there
    are any.  After a bronze
    run in the same report, tables it didn't ingest are ``missing``.
    ``resume`` keeps tables of the same bronze version and spec.  ``buckets``
    lays out the tables of the fact's join in so many buckets of their key.
    """
    report = report or RunReport()
    bronze, now = manifest(spark, layout.bronze).tables, manifest(spark, layout.silver).tables

    def one(name: str) -> str:
        spec = SILVER_SPECS[name]
        if report.bronze.get(name, OK).startswith(FAILED):
            return SKIPPED
        if report.ingested and name not in report.bronze:
            return MISSING
        try:
            made_from = _made_from("silver", bronze[name].folders, spec, layout.quarantine,
                                   name in COLOCATED and buckets) if name in bronze else None
            if resume and made_from and name in now and now[name].made_from == made_from:
                return KEPT
            raw = read_table(spark, layout.bronze, name)
            valid = valid_rows(clean.project(raw, spec), spec)  # for counts that read the key columns alone
            found = dedup.repeats(valid, spec.key) if spec.key else None
            try:
                cleaned, rejected = clean_counted(raw, spec, found)
                if buckets and name in COLOCATED:
                    key = COLOCATED[name]
                    staged = stage_bucketed(silver_post(name, cleaned), layout.silver, name, key, buckets,
                                            made_from=made_from, hot=hot_keys(valid, key, buckets))
                else:
                    staged = stage_table(silver_post(name, cleaned), layout.silver, name, made_from=made_from)
            finally:
                if found is not None:
                    found.hashes.unpersist()
            try:
                if layout.quarantine:
                    some = rejected.get["rejected"] > 0
                    write_table(quarantine(raw, spec) if some else empty_quarantine(raw, spec),
                                layout.quarantine, name)
            except Exception:
                drop_staged(spark, [staged])
                raise
            publish(spark, [staged])
            return OK
        except Exception as e:
            return _failure(e)

    report.silver.update(_each(
        tables or SILVER_SPECS, lambda n: _timed(spark, report, "silver", n, lambda: one(n)),
        parallel))
    return report


# ------------------------------------------------------------------ gold

def run_gold(spark: SparkSession, layout: Layout, report: RunReport | None = None,
             tables: dict[str, GoldTable] | None = None, parallel: int = DEFAULT_PARALLEL,
             limits: Sequence[Limit] = (), resume: bool = False) -> RunReport:
    """PL3: star schema from silver; a table whose input failed is skipped.

    Tables built from gold tables (indicators) are made after the others, from
    their new versions.  All tables are published together at the end.  With
    ``limits``, the quality checks run on the unpublished versions first; if
    one is exceeded, or can't be counted because a table that it needs
    failed, nothing is published, the tables are ``held``, and readers keep
    the last run's star.  ``resume`` keeps tables of the same inputs.
    """
    report = report or RunReport()
    tables = tables or GOLD_TABLES
    silver, now = manifest(spark, layout.silver).tables, manifest(spark, layout.gold).tables
    staged: dict[str, Staged] = {}
    made: dict[str, str | None] = {}

    def gold_frame(name: str) -> DataFrame:
        return read_staged(spark, staged[name]) if name in staged else read_table(spark, layout.gold, name)

    def one(name: str) -> str:
        gold = tables[name]
        done = report.gold if gold.from_gold else report.silver
        if any(done.get(i, OK) not in _DONE for i in gold.inputs):
            return SKIPPED
        try:
            known = [made.get(i) if gold.from_gold else i in silver and silver[i].folders for i in gold.inputs]
            made_from = made[name] = _made_from("gold", name, known) if all(known) else None
            if resume and made_from and name in now and now[name].made_from == made_from:
                return KEPT
            if gold.of_join and bucketed_alike(spark, layout.silver, *gold.inputs):
                frame = gold.of_join(join_bucketed(spark, layout.silver, *gold.inputs))
            else:
                frame = gold.build(*[gold_frame(i) if gold.from_gold else read_table(spark, layout.silver, i)
                                     for i in gold.inputs])
            staged[name] = stage_table(frame, layout.gold, name, made_from=made_from)
            return OK
        except Exception as e:
            return _failure(e)

    for late in (False, True):
        report.gold.update(_each(
            [n for n, t in tables.items() if t.from_gold == late],
            lambda n: _timed(spark, report, "gold", n, lambda: one(n)), parallel))
    if limits and staged:
        report.exceeded += _exceeded(spark, report, limits, gold_frame)
    if report.exceeded:
        drop_staged(spark, staged.values())
        report.gold.update(dict.fromkeys(staged, HELD))
    elif staged:
        publish(spark, list(staged.values()))
    return report


def _exceeded(spark: SparkSession, report: RunReport, limits: Sequence[Limit], frame) -> list[str]:
    """The limits that the checks of the star exceed, as text."""
    lost = [t for t in GOLD_INPUTS if report.gold.get(t, OK) not in _DONE]
    if lost:
        return [f"checks need {t}" for t in lost]
    with described(spark, "gold/checks"):
        rows = gold_checks({t: frame(t) for t in GOLD_INPUTS}).collect()  # a row per check
    found = {(r["check"], r["table_name"]): int(r["n_bad"]) for r in rows}
    report.checks.update({f"{c} {t}": n for (c, t), n in found.items()})
    unknown = [f"{x.check} {x.table}" for x in limits if (x.check, x.table) not in found]
    if unknown:
        return [f"no check {u}" for u in unknown]
    return [f"{x.check} {x.table}: {found[x.check, x.table]} > {x.most}" for x in limits
            if found[x.check, x.table] > x.most]


def run_layers(spark: SparkSession, layout: Layout, raise_on_failure: bool = True,
               parallel: int = DEFAULT_PARALLEL, kpis: bool = False,
               single_line: Iterable[str] = (), limits: Sequence[Limit] = (), resume: bool = False,
               buckets: int | None = None, keep_versions: float | None = WEEK) -> RunReport:
    """PL4: bronze, silver, gold in order; raise at the end if anything failed.

    ``kpis`` adds the aggregate indicator tables to the gold layer;
    ``single_line`` is passed to ``run_bronze``, ``buckets`` to
    ``run_silver``, ``limits`` to ``run_gold``, ``resume`` to all.  Versions that have not been current for
    ``keep_versions`` seconds are removed (None: none are).
    """
    report = run_bronze(spark, layout, parallel=parallel, single_line=single_line, resume=resume)
    if not report.bronze:  # stop early, before silver reads stale or missing tables
        raise NoLandingFiles(f"no landing CSV files below {layout.landing}")
    run_silver(spark, layout, report, parallel=parallel, resume=resume, buckets=buckets)
    run_gold(spark, layout, report, parallel=parallel, limits=limits, resume=resume,
             tables={**GOLD_TABLES, **KPI_TABLES} if kpis else GOLD_TABLES)
    if keep_versions is not None:
        for root in filter(None, (layout.bronze, layout.silver, layout.gold, layout.quarantine)):
            drop_old(spark, root, keep_versions)
    if raise_on_failure and report.failed():
        raise LayerError(report.as_dict(), report.exceeded)
    return report
