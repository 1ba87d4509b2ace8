"""Every path of the lake through a Hadoop scheme that isn't ``file:`` (IO7).

``viewfs:`` mapped to a scratch folder stands in for an object store: only
Spark's readers and writers and Hadoop's file systems can open its paths, as
with ``s3a:``; ``open``, ``os.path`` and ``glob`` can't.
"""

import os
import time

import pytest
from conftest import rows

from alloy.plans import marketplace as mp
from alloy.plans.lake_checks import quality_report
from alloy.plans.medallion import KEPT, Layout, Limit, landing_quarantine, run_layers
from alloy.session import drop_scratch, scratch_path
from alloy.sources.bucketed import bucketed_alike
from alloy.sources.csv import FEW, write_csv
from alloy.sources.landing import landing_counts, landing_tables
from alloy.sources.parquet import drop_old, manifest, read_table
from alloy.streaming.ingest import LostCheckpoint, ingest_stream
from test_medallion import _layout, _write_landing


@pytest.fixture()
def store(spark, tmp_dir):
    """Root of a store that only Hadoop can open, and the local folder behind it."""
    host = "store" + os.path.basename(tmp_dir).replace("-", "").replace("_", "").lower()
    os.makedirs(f"{tmp_dir}/behind")
    spark.sparkContext._jsc.hadoopConfiguration().set(
        f"fs.viewfs.mounttable.{host}.link./lake", f"file://{tmp_dir}/behind")
    return f"viewfs://{host}/lake", f"{tmp_dir}/behind"


def _in_store(root):
    return Layout(*(f"{root}/{x}" for x in ("landing", "bronze", "silver", "gold", "quarantine")))


def test_layers_in_the_store_equal_local_ones(spark, store, tmp_dir):
    root, behind = store
    local, far = _layout(f"{tmp_dir}/local"), _in_store(root)
    for landing in (local.landing, f"{behind}/landing"):
        _write_landing(landing)
        with open(f"{landing}/{mp.PAYMENTS}.csv", "a") as f:
            f.write("o7,1,boleto\n")
    for layout in (local, far):
        report = run_layers(spark, layout, kpis=True, single_line=[mp.ORDERS], buckets=4,
                            limits=[Limit("negative_value", "dim_pagamentos", 1)])
        assert report.misfits == {mp.PAYMENTS: {FEW: 1}}
    for t in [*mp.GOLD_TABLES, *mp.KPI_TABLES]:
        assert rows(read_table(spark, far.gold, t)) == rows(read_table(spark, local.gold, t)), t
    assert bucketed_alike(spark, far.silver, mp.ITEMS, mp.ORDERS)
    assert rows(quality_report(spark, far.gold)) == rows(quality_report(spark, local.gold))
    assert read_table(spark, far.quarantine, landing_quarantine(mp.PAYMENTS)).first()["record"] == "o7,1,boleto"
    again = run_layers(spark, far, kpis=True, single_line=[mp.ORDERS], buckets=4, resume=True)
    assert {s for t in again.as_dict().values() for s in t.values()} == {KEPT}
    assert manifest(spark, far.gold).number == 1
    run_layers(spark, far, keep_versions=None)
    assert manifest(spark, far.gold).number == 2
    assert drop_old(spark, far.gold, 0, now=time.time() + 60) and read_table(spark, far.gold, "fato_vendas").count() == 3


def test_discovery_in_the_store(spark, store):
    root, behind = store
    os.makedirs(f"{behind}/landing/market")
    for name in ("orders", "market/orders", "market/sellers"):
        with open(f"{behind}/landing/{name}.csv", "w") as f:
            f.write("id\n1\n2\n")
    assert landing_tables(spark, f"{root}/landing") == {
        "orders": [f"{root}/landing/market/orders.csv", f"{root}/landing/orders.csv"],
        "sellers": [f"{root}/landing/market/sellers.csv"]}
    assert rows(landing_counts(spark, f"{root}/landing")) == [("orders", 4), ("sellers", 2)]


def test_streams_and_scratch_in_the_store(spark, store, monkeypatch):
    root, behind = store
    for module in ("alloy.session", "alloy.streaming.ingest"):  # the setting can't be changed while a session runs
        monkeypatch.setattr(f"{module}.checkpoint_root", lambda _: f"{root}/shared")
    df = spark.createDataFrame([(1, "a\nb"), (2, 'c "d"')], "id string, text string")
    write_csv(df, f"{root}/in/t.csv")
    ingest_stream(spark, f"{root}/in", f"{root}/out").awaitTermination()
    assert rows(spark.read.parquet(f"{root}/out")) == [("1", "a\nb"), ("2", 'c "d"')]
    with pytest.raises(LostCheckpoint):
        ingest_stream(spark, f"{root}/in", f"{root}/out", checkpoint=f"{root}/elsewhere")
    path = scratch_path(spark, "x")
    assert path.startswith(f"{root}/shared/")
    df.write.parquet(path)
    assert os.path.exists(path.replace(root, behind))
    drop_scratch(spark)
    assert not os.path.exists(path.replace(root, behind))
