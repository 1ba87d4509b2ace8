import os

import pytest

from alloy.sources.csv import read_csv, write_csv
from alloy.sources.landing import landing_counts, landing_tables, scan_landing
from alloy.sources.parquet import read_table, write_table

from conftest import rows

AWKWARD = [
    ("r1", "o1", "5", "Ótimo", "linha um\nlinha dois", "2018-01-18 00:00:00"),
    ("r2", "o2", "0", None, 'disse "ok", e saiu', None),
    ("r3", "o3", "6", "", "\tcomeça com tab, termina com espaço ", "bad"),
    ("r4", "o4", None, "x", "vírgula, ponto; e \r\nCRLF", "2018-01-19 10:00:00"),
]
SCHEMA = ("review_id string, order_id string, review_score string, review_comment_title string, "
          "review_comment_message string, review_creation_date string")


def test_multiline_csv_roundtrip_keeps_text_whole(spark, tmp_dir):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    path = os.path.join(tmp_dir, "reviews.csv")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert back.columns == df.columns
    # CSV has one spelling for "" and NULL: an empty string reads back as NULL,
    # as with the default reader settings; every other value is unchanged.
    want = df.selectExpr(
        *[f"nullif({c}, '') AS {c}" for c in df.columns])
    assert rows(back) == rows(want)


def test_single_line_reading_would_break_records(spark, tmp_dir):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    path = os.path.join(tmp_dir, "reviews.csv")
    write_csv(df, path)
    assert read_csv(spark, path, multiLine="false").count() != df.count()


def test_leading_zeros_survive(spark, tmp_dir):
    path = os.path.join(tmp_dir, "customers.csv")
    with open(path, "w") as f:
        f.write('customer_id,customer_zip_code_prefix\n"c1","01037"\nc2,09000\n')
    assert rows(read_csv(spark, path)) == [("c1", "01037"), ("c2", "09000")]


def test_landing_discovery_skips_other_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "landing")
    os.makedirs(os.path.join(root, "sellers.csv"))
    with open(os.path.join(root, "orders.csv"), "w") as f:
        f.write("order_id\no1\no2\n")
    with open(os.path.join(root, "sellers.csv", "part-0.csv"), "w") as f:
        f.write("seller_id\ns1\n")
    with open(os.path.join(root, "sellers.csv", "part-1.csv"), "w") as f:
        f.write("seller_id\ns2\ns3\n")
    with open(os.path.join(root, "note.txt"), "w") as f:
        f.write("not a table\n")
    assert set(landing_tables(spark, root)) == {"orders", "sellers"}
    assert rows(landing_counts(spark, root)) == [("orders", 2), ("sellers", 3)]


def test_parquet_overwrite_replaces(spark, tmp_dir):
    write_table(spark.range(10), tmp_dir, "t")
    write_table(spark.range(3), tmp_dir, "t")
    assert read_table(spark, tmp_dir, "t").count() == 3


def test_landing_root_named_like_an_outer_folder(spark, tmp_dir):
    outer = os.path.join(tmp_dir, "landing", "x")
    root = os.path.join(outer, "landing")
    os.makedirs(root)
    with open(os.path.join(root, "orders.csv"), "w") as f:
        f.write("order_id\no1\n")
    assert set(landing_tables(spark, root)) == {"orders"}


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


#: Files that readers disagree on: first line empty, CR line ends, mixed line ends, a Latin-1 byte, another delimiter.
ODD_FILES = [
    ("\na,b\n1,x\n2,y\n", "utf-8", {}), ("a,b\r1,x\r2,y\r", "utf-8", {}),
    ("a,b\r\n1,x\n2,y\r\n", "utf-8", {}), ("a,b\n1,caf\u00e9\n2,y\n", "latin-1", {}),
    ("a;b\n1;x\n2;y\n", "utf-8", {"sep": ";"}),
]


@pytest.mark.parametrize("k", range(len(ODD_FILES)))
def test_rows_do_not_depend_on_the_split_size(spark, tmp_dir, k):
    text, encoding, options = ODD_FILES[k]
    path = os.path.join(tmp_dir, "t.csv")
    _write(path, text, encoding)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("4", "64", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = read_csv(spark, path, **options)
            got.append((df.columns, rows(df)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] == got[2] and got[0][1]


def test_one_name_in_two_places_is_one_table(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "orders.csv"), "id\no1\n")
    _write(os.path.join(tmp_dir, "late", "orders.csv", "part-0.csv"), "id\no2\no3\n")
    _write(os.path.join(tmp_dir, "orders", "sellers.csv"), "id\ns1\n")
    assert rows(landing_counts(spark, tmp_dir)) == [("orders", 3), ("sellers", 1)]


def test_files_of_a_sub_folder_are_tables_of_their_own(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "market", "orders.csv"), "order_id,n\no1,1\n")
    _write(os.path.join(tmp_dir, "market", "sellers.csv"), "seller_id,zip\ns1,01037\n")
    found = scan_landing(spark, tmp_dir)
    assert {n: df.columns for n, df in found.items()} == {
        "orders": ["order_id", "n"], "sellers": ["seller_id", "zip"]}


@pytest.mark.parametrize("other", ["b,a\ny,2\n", "a,b,c\n1,2,3\n"])
def test_differing_headers_fail_the_read(spark, tmp_dir, other):
    _write(os.path.join(tmp_dir, "t.csv", "part-0.csv"), "a,b\n1,x\n")
    _write(os.path.join(tmp_dir, "t.csv", "part-1.csv"), other)
    with pytest.raises(Exception, match="header"):
        scan_landing(spark, tmp_dir)["t"].collect()
