"""Benchmark: time the headline queries on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver).  One warm-up pass, then the
median of ``BENCH_REPEAT`` runs.  The layer run is timed on its own: the
landing CSVs (derived from the test tables) are written once, timed as
``landing_csv_write``; then ``layers_full_run`` (bronze → silver with
quarantine → gold with indicator tables, 28 tables written) and
``gold_quality_report`` are timed per repeat.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from alloy.plans import tpch  # noqa: E402
from alloy.plans.lake_checks import quality_report  # noqa: E402
from alloy.plans.medallion import Layout, run_layers  # noqa: E402
from alloy.plans.tpch_landing import write_landing  # noqa: E402
from alloy.session import get_spark, scratch_path  # noqa: E402

HEADLINE = [
    "fact_sales_join", "fact_join_hot_order", "role_playing_dims", "dedup_composite_key",
    "dedup_hot_key", "dedup_single_key",
    "silver_orders", "quarantine_rows", "centroid_3key", "group_avg_two", "key_uniqueness",
    "ri_orphans", "kpi_monthly_sales", "kpi_sales_by_region", "translate_accents",
    "computed_sum_col", "csv_multiline_roundtrip", "parquet_roundtrip",
    "stream_ingest",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark("alloy-bench", f"local[{cpus}]",
                      {"spark.sql.shuffle.partitions": str(int(cpus) * 2),
                       "spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name in HEADLINE:
        q = tpch.QUERIES[name]
        run(q(spark, sf_dir))  # warm-up
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            run(q(spark, sf_dir))
            runs.append(time.perf_counter() - t)
        times[name] = round(statistics.median(runs), 3)
    root = scratch_path(spark, "bench-lake")
    layout = Layout(*(f"{root}/{x}" for x in ("landing", "bronze", "silver", "gold", "quarantine")))
    t = time.perf_counter()
    write_landing(spark, sf_dir, layout.landing)
    times["landing_csv_write"] = round(time.perf_counter() - t, 3)
    lake = {"kpis": True, "single_line": tpch.SINGLE_LINE_TABLES}
    run_layers(spark, layout, **lake)  # warm-up
    runs, checks = [], []
    for _ in range(repeat):
        t = time.perf_counter()
        run_layers(spark, layout, **lake)
        runs.append(time.perf_counter() - t)
        t = time.perf_counter()
        run(quality_report(spark, layout.gold))
        checks.append(time.perf_counter() - t)
    times["layers_full_run"] = round(statistics.median(runs), 3)
    times["gold_quality_report"] = round(statistics.median(checks), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
