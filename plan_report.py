"""Summarise the physical plan of every registered query into PLANS.md.

Two rows per query: the plan Spark picks on the test data, and the plan when
only tables of a few kilobytes may be broadcast (nation, region: fixed-size
at every scale factor), which is the shape the joins take once the fact and
entity tables are large.  Counts come from the
formatted plan text; scans are only planned, never run.

    python plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from alloy.plans import tpch
from alloy.session import get_spark

FILE_QUERIES = {"csv_multiline_roundtrip", "landing_glob_scan", "landing_misfits", "atomic_replace", "kpi_cube_merged",
                "parquet_roundtrip", "stream_ingest"}

NOTES = "## Reading the at-scale rows"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    top = text.split("\n\n")[0]
    n = {k: len(re.findall(rf"\b{k}\b", top)) for k in
         ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
          "ShuffledHashJoin", "HashAggregate", "SortAggregate", "Window", "Scan"]}
    shuffles = n["Exchange"]  # \b keeps BroadcastExchange out of this count
    joins = []
    if n["SortMergeJoin"]:
        joins.append(f"{n['SortMergeJoin']} SMJ")
    if n["BroadcastHashJoin"]:
        joins.append(f"{n['BroadcastHashJoin']} BHJ")
    if n["ShuffledHashJoin"]:
        joins.append(f"{n['ShuffledHashJoin']} SHJ")
    aggs = []
    if n["HashAggregate"]:
        aggs.append(f"{n['HashAggregate']} hash")
    if n["SortAggregate"]:
        aggs.append(f"{n['SortAggregate']} sort")
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
    return (f"{shuffles} | {', '.join(joins) or '-'} | {', '.join(aggs) or '-'} | "
            f"{'yes' if n['Window'] else '-'} | {pushed}/{n['Scan']}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("alloy-plans", "local[8]", {"spark.sql.shuffle.partitions": "16"})
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python plan_report.py` on `{sf_dir}` (Spark {spark.version}).",
        "*default*: the plan Spark picks on the test data (small sides broadcast).",
        "*at scale*: `spark.sql.autoBroadcastJoinThreshold=10240`, so only fixed-size",
        "tables (nation, region) are broadcast, the shape once the fact and entity tables",
        "are large. Shuffles = hash exchanges (broadcasts not counted). Aggregates",
        "count partial and final operators. Pushed = scans with pushed filters / scans.",
        "The `medallion_*` queries read gold tables written by the layer run; their",
        "plans are the gold scans (the run itself is measured in `bench.py`).",
        "",
        "| query | mode | shuffles | joins | aggregates | window | pushed |",
        "| --- | --- | ---: | --- | --- | --- | --- |",
    ]
    for name, q in tpch.QUERIES.items():
        if name in FILE_QUERIES or name.startswith("medallion_"):
            continue
        for mode, threshold in (("default", None), ("at scale", "10240")):
            if threshold:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                lines.append(f"| {name} | {mode} | {summary(plan_text(q(spark, sf_dir)))} |")
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with open("PLANS.md") as f:  # the notes below the table are kept
        notes = f.read().partition(NOTES)
    with open("PLANS.md", "w") as f:
        f.write("\n".join(lines) + "\n\n" + notes[1] + notes[2])
    print("\n".join(lines))


if __name__ == "__main__":
    main()
