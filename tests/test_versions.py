"""Tables are replaced whole or not at all; old versions go by age."""

import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from alloy.sources import parquet as pq


def ids(spark, root, name="t"):
    return sorted(r[0] for r in pq.read_table(spark, root, name).collect())


def broken(spark):
    """A job that writes some files and then fails."""
    bad = F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, 100, 1, 4).select(bad.cast("long").alias("id"))


def test_a_failing_overwrite_keeps_the_old_rows(spark, tmp_dir):
    pq.write_table(spark.range(3), tmp_dir, "t")
    with pytest.raises(Exception, match="lost"):
        pq.write_table(broken(spark), tmp_dir, "t")
    assert ids(spark, tmp_dir) == [0, 1, 2]
    assert os.listdir(f"{tmp_dir}/t") == list(pq.manifest(spark, tmp_dir).tables["t"].folders)


def test_a_first_write_that_fails_makes_no_table(spark, tmp_dir):
    with pytest.raises(Exception, match="lost"):
        pq.write_table(broken(spark), tmp_dir, "t")
    assert pq.manifest(spark, tmp_dir) == pq.Manifest()


def test_a_plan_may_replace_the_table_it_reads(spark, tmp_dir):
    pq.write_table(spark.range(4), tmp_dir, "t")
    pq.write_table(pq.read_table(spark, tmp_dir, "t").where("id > 1"), tmp_dir, "t")
    assert ids(spark, tmp_dir) == [2, 3]
    pq.write_table(pq.read_table(spark, tmp_dir, "t"), tmp_dir, "t", mode="append")
    assert ids(spark, tmp_dir) == [2, 2, 3, 3]
    with pytest.raises(ValueError):
        pq.write_table(spark.range(1), tmp_dir, "t", mode="ignore")


def test_readers_of_the_old_version_can_finish(spark, tmp_dir):
    pq.write_table(spark.range(3), tmp_dir, "t")
    old = pq.read_table(spark, tmp_dir, "t")
    pq.write_table(spark.range(10, 12), tmp_dir, "t")
    assert sorted(r[0] for r in old.collect()) == [0, 1, 2] and ids(spark, tmp_dir) == [10, 11]


def test_several_tables_are_published_at_one_moment(spark, tmp_dir):
    a, b = (pq.stage_table(spark.range(n), tmp_dir, t) for t, n in (("a", 1), ("b", 2)))
    assert pq.manifest(spark, tmp_dir).tables == {}
    assert pq.read_staged(spark, b).count() == 2
    assert pq.publish(spark, [a, b]) == 1
    assert ids(spark, tmp_dir, "a") == [0] and ids(spark, tmp_dir, "b") == [0, 1]
    with pytest.raises(ValueError):
        pq.publish(spark, [a, pq.Staged(f"{tmp_dir}/other", "c", "v-1")])


def test_an_unfinished_manifest_is_not_in_force(spark, tmp_dir):
    pq.write_table(spark.range(3), tmp_dir, "t")
    with open(f"{tmp_dir}/{pq.MANIFESTS}/0000000002.json", "w") as f:
        f.write('{"t": {"folders": ["v-')
    assert ids(spark, tmp_dir) == [0, 1, 2]
    pq.write_table(spark.range(1), tmp_dir, "t")
    assert ids(spark, tmp_dir) == [0] and pq.manifest(spark, tmp_dir).number == 3


def test_threads_publish_without_losing_tables(spark, tmp_dir):
    from alloy.plans.jobs import each
    each([f"t{i}" for i in range(12)], lambda n: pq.write_table(spark.range(int(n[1:])), tmp_dir, n), parallel=6)
    assert {n: len(ids(spark, tmp_dir, n)) for n in pq.manifest(spark, tmp_dir).tables} == {f"t{i}": i for i in range(12)}


def test_a_table_written_without_versions_is_read_and_replaced(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/t")
    assert ids(spark, tmp_dir) == [0, 1, 2, 3, 4]
    pq.write_table(pq.read_table(spark, tmp_dir, "t").where("id > 3"), tmp_dir, "t")
    assert ids(spark, tmp_dir) == [4]


def test_partitioned_tables_keep_their_columns(spark, tmp_dir):
    df = spark.range(6).withColumn("p", (F.col("id") % 2).cast("int"))
    pq.write_table(df, tmp_dir, "t", partition_by=["p"])
    pq.write_table(df, tmp_dir, "t", mode="append", partition_by=["p"])
    assert rows(pq.read_table(spark, tmp_dir, "t").groupBy("p").count()) == [(0, 6), (1, 6)]


def test_old_versions_go_by_age(spark, tmp_dir):
    for n in (1, 2, 3):
        pq.write_table(spark.range(n), tmp_dir, "t")
    pq.write_table(spark.range(7), tmp_dir, "u")
    left = pq.stage_table(spark.range(1), tmp_dir, "t")  # never published
    assert pq.drop_old(spark, tmp_dir, 3600) == []
    assert len(os.listdir(f"{tmp_dir}/t")) == 4
    gone = pq.drop_old(spark, tmp_dir, 0, now=time.time() + 60)
    assert len(gone) == 3 and any(left.folder in g for g in gone)
    assert len(ids(spark, tmp_dir)) == 3 and len(ids(spark, tmp_dir, "u")) == 7
    assert [f for f in os.listdir(f"{tmp_dir}/{pq.MANIFESTS}") if not f.startswith(".")] == ["0000000004.json"]
    assert pq.drop_old(spark, f"{tmp_dir}/none") == []
