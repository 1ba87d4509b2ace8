"""Gold is published within its limits only; a retry redoes what failed or changed."""

import os
import uuid

import pytest
from conftest import rows

from alloy.operators import quality
from alloy.plans import marketplace as mp
from alloy.plans.lake_checks import quality_report
from alloy.plans.medallion import HELD, KEPT, OK, LayerError, Limit, run_layers
from alloy.sources.landing import found_files, landing_entries, repeated_files
from alloy.sources.parquet import manifest, read_table
from test_medallion import FIXTURES, _layout, _write_landing

NEGATIVE = Limit("negative_value", "dim_pagamentos", 1)


def _append(layout, name, *lines):
    with open(f"{layout.landing}/{name}.csv", "a") as f:
        f.write("".join(f"{x}\n" for x in lines))


def test_gold_beyond_a_limit_is_held_back_whole(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    report = run_layers(spark, layout, limits=[NEGATIVE], kpis=True)
    assert report.checks["negative_value dim_pagamentos"] == 1 and report.exceeded == []
    names = [*mp.GOLD_TABLES, *mp.KPI_TABLES]
    before = {t: rows(read_table(spark, layout.gold, t)) for t in names}
    number = manifest(spark, layout.gold).number
    _append(layout, mp.PAYMENTS, "o6,1,boleto,1,-9.0")
    _append(layout, mp.ITEMS, "o6,1,p1,s1,2018-01-01 00:00:00,5,1")
    with pytest.raises(LayerError, match=r"negative_value dim_pagamentos: 2 > 1") as e:
        run_layers(spark, layout, limits=[NEGATIVE], kpis=True)
    assert set(e.value.report["gold"].values()) == {HELD}
    assert {t: rows(read_table(spark, layout.gold, t)) for t in names} == before
    assert manifest(spark, layout.gold).number == number
    for t in names:  # nothing of the held version is left
        assert len(os.listdir(f"{layout.gold}/{t}")) == 1
    run_layers(spark, layout, limits=[Limit("negative_value", "dim_pagamentos", 2)], kpis=True)
    assert read_table(spark, layout.gold, "fato_vendas").count() == 4


def test_a_gate_that_cannot_be_counted_holds(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    with pytest.raises(LayerError, match="no check negative_value nowhere"):
        run_layers(spark, layout, limits=[Limit("negative_value", "nowhere", 5)])
    with open(f"{layout.landing}/{mp.REVIEWS}.csv", "w") as f:
        f.write("other\nx\n")
    with pytest.raises(LayerError, match="checks need dim_avaliacoes"):
        run_layers(spark, layout, limits=[NEGATIVE])
    assert manifest(spark, layout.gold).tables == {}


def _jobs(spark, work) -> int:
    """How many Spark jobs ``work`` starts from this thread."""
    sc, group = spark.sparkContext, f"jobs-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _statuses(report):
    return {f"{layer}/{t}": s for layer, tables in report.items() for t, s in tables.items()}


def test_a_retry_redoes_the_failed_table_and_its_dependants(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    with open(f"{layout.landing}/{mp.PRODUCTS}.csv", "w") as f:
        f.write("product_id,other\np1,x\n")
    with pytest.raises(LayerError):
        run_layers(spark, layout, kpis=True, resume=True)
    _write_products(layout)
    report = run_layers(spark, layout, kpis=True, resume=True)
    done = {k for k, s in _statuses(report.as_dict()).items() if s == OK}
    assert done == {f"bronze/{mp.PRODUCTS}", f"silver/{mp.PRODUCTS}", "gold/dim_produtos"}
    assert {s for k, s in _statuses(report.as_dict()).items() if k not in done} == {KEPT}
    assert rows(read_table(spark, layout.gold, "dim_produtos").select("nk_produto")) == [("p1",), ("p2",)]
    files = {t: read_table(spark, layout.gold, t).inputFiles() for t in mp.GOLD_TABLES}
    again = run_layers(spark, layout, kpis=True, resume=True)
    assert set(_statuses(again.as_dict()).values()) == {KEPT}
    assert {t: read_table(spark, layout.gold, t).inputFiles() for t in mp.GOLD_TABLES} == files


def _write_products(layout):
    with open(f"{layout.landing}/{mp.PRODUCTS}.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(FIXTURES[mp.PRODUCTS]) + "\n")


def test_a_changed_file_is_done_anew_down_to_the_indicators(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout, kpis=True, resume=True)
    _append(layout, mp.ITEMS, "o6,1,p1,s1,2018-01-01 00:00:00,5,1")
    report = run_layers(spark, layout, kpis=True, resume=True)
    done = {k for k, s in _statuses(report.as_dict()).items() if s == OK}
    assert done == {f"bronze/{mp.ITEMS}", f"silver/{mp.ITEMS}", "gold/fato_vendas", "gold/kpi_vendas_mensais",
                    "gold/kpi_vendas_por_estado"}
    assert read_table(spark, layout.gold, "fato_vendas").count() == 4


def test_jobs_of_kept_tables_are_not_started(spark, tmp_dir):
    """A run that keeps all tables starts the jobs that look at the landing files, and no other."""
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout)

    def look():
        files = found_files(spark, layout.landing)
        landing_entries(spark, layout.landing, files=files)
        repeated_files(spark, files)

    looking = _jobs(spark, look)
    assert _jobs(spark, lambda: run_layers(spark, layout, resume=True, parallel=1)) == looking
    assert _jobs(spark, lambda: run_layers(spark, layout, parallel=1)) > looking + 20


# ------------------------------------------------------------------ one-pass integrity

def test_integrity_equals_the_single_checks(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "a"), (7, "z"), (7, "z")], "k long, s string")
    one = spark.createDataFrame([(1,), (1,), (3,), (None,), (None,)], "k long")
    two = spark.createDataFrame([(1, "a"), (7, "z"), (2, None)], "x long, y string")
    keys = [quality.ForeignKey("orphans", "one", child, ("k",), one, ("k",), "repeated"),
            quality.ForeignKey("orphans", "two", child, ("k", "s"), two, ("x", "y")),
            quality.ForeignKey("unused", "child", one, ("k",), child, ("k",))]
    got = {(r.check, r.table_name): r.n_bad for r in quality.integrity(keys).collect()}
    assert got == {("orphans", "one"): 4, ("repeated", "one"): 1, ("orphans", "two"): 3, ("unused", "child"): 3}
    for k in keys:
        assert got[k.check, k.table] == quality.count_orphans(k.child, k.parent, k.child_key, k.parent_key).first()[0]
    none = quality.integrity([quality.ForeignKey("o", "t", child.limit(0), ("k",), one.limit(0), ("k",), "r")])
    assert rows(none) == [("o", "t", 0), ("r", "t", 0)]
    with pytest.raises(TypeError):
        quality.integrity([quality.ForeignKey("o", "t", child, ("s",), one, ("k",))])


def test_the_report_reads_the_fact_once(spark, tmp_dir):
    layout = _layout(tmp_dir)
    _write_landing(layout.landing)
    run_layers(spark, layout)
    plan = quality_report(spark, layout.gold)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("nk_produto#") and sum("valor_frete#" in x and "Relation" in x for x in plan.splitlines()) == 1
