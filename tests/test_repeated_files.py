"""The same file under two names or in two places is ingested once and reported."""

import os
import shutil

import pytest
from conftest import rows

from alloy.plans import marketplace as mp
from alloy.plans.medallion import KEPT, Layout, run_bronze, run_layers
from alloy.sources import landing
from alloy.sources.csv import FEW
from alloy.sources.parquet import read_table
from test_medallion import _gold, _layout, _write_landing


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_a_file_dropped_twice_does_not_count_twice(spark, tmp_dir):
    once, twice = _layout(f"{tmp_dir}/a"), _layout(f"{tmp_dir}/b")
    for layout in (once, twice):
        _write_landing(layout.landing)
    for name in (mp.PAYMENTS, mp.GEOLOCATION):
        os.makedirs(f"{twice.landing}/late", exist_ok=True)
        shutil.copy(f"{twice.landing}/{name}.csv", copy := f"{twice.landing}/late/{name}.csv")
        os.utime(copy, (os.path.getmtime(copy) + 60,) * 2)
    run_layers(spark, once)
    report = run_layers(spark, twice)
    assert set(report.repeated) == {mp.PAYMENTS, mp.GEOLOCATION}
    said = report.repeated[mp.PAYMENTS]
    assert said["skipped"] == "1" and said["file"].endswith(f"late/{mp.PAYMENTS}.csv") and "other_table" not in said
    for t in (mp.PAYMENTS, mp.GEOLOCATION):
        assert rows(read_table(spark, twice.bronze, t)) == rows(read_table(spark, once.bronze, t))
    for t in mp.GOLD_TABLES:
        assert rows(_gold(spark, twice, t)) == rows(_gold(spark, once, t))
    again = run_layers(spark, twice, resume=True)
    assert set(again.bronze.values()) == {KEPT} and again.repeated == report.repeated


def test_misfits_and_headers_of_skipped_files_are_not_counted(spark, tmp_dir):
    layout = _layout(tmp_dir)
    for place in ("", "x/", "y/"):
        write(f"{layout.landing}/{place}t.csv", "a,b\n1,2\n3\n4,5\n")
    write(f"{layout.landing}/z/t.csv", "a,b\n9,2\n3\n4,5\n")  # of equal length, with another line
    report = run_bronze(spark, layout)
    assert report.repeated["t"]["skipped"] == "2" and report.misfits == {"t": {FEW: 2}}
    assert rows(read_table(spark, layout.bronze, "t")) == [("1", "2"), ("4", "5"), ("4", "5"), ("9", "2")]


def test_other_names_are_reported_and_read(spark, tmp_dir):
    layout = _layout(tmp_dir)
    write(f"{layout.landing}/t.csv", "a,b\n1,2\n")
    write(f"{layout.landing}/t (1).csv", "a,b\n1,2\n")
    report = run_bronze(spark, layout)
    (name, said), = report.repeated.items()
    assert {name, said["other_table"]} == {"t", "t (1)"} and "skipped" not in said
    assert read_table(spark, layout.bronze, "t").count() == read_table(spark, layout.bronze, "t (1)").count() == 1


def test_part_files_of_one_folder_are_one_drop(spark, tmp_dir):
    layout = Layout(*(f"{tmp_dir}/{x}" for x in ("landing", "bronze", "silver", "gold")))
    for k in (0, 1):
        write(f"{layout.landing}/t.csv/part-{k}.csv", "a\n1\n")
    report = run_bronze(spark, layout)
    assert report.repeated == {} and read_table(spark, layout.bronze, "t").count() == 2


@pytest.mark.parametrize("most", [1, 1000])
def test_many_files_of_one_length(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(landing, "MOST_PATHS", most)
    for k in range(6):
        write(f"{tmp_dir}/p{k}/t.csv", f"a\n{k // 2}\n")
    write(f"{tmp_dir}/u.csv", "a\n1000\n")
    found = landing.repeated_files(spark, landing.found_files(spark, tmp_dir))
    got = {r["file"].split("/")[-2]: r["first_file"].split("/")[-2] for r in found.collect()}
    assert got == {"p1": "p0", "p3": "p2", "p5": "p4"}


def test_no_files(spark, tmp_dir):
    assert landing.found_files(spark, f"{tmp_dir}/none") is None
    write(f"{tmp_dir}/a.csv", "")
    write(f"{tmp_dir}/b.csv", "")
    assert landing.repeated_files(spark, landing.found_files(spark, tmp_dir)) is None
