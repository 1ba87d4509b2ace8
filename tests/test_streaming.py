import os

import pytest

from alloy.streaming.ingest import LostCheckpoint, ingest_stream

from conftest import rows


def test_available_now_ingests_only_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write('id,text\n1,"one\nline"\n2,two\n')
    target = os.path.join(tmp_dir, "bronze")
    ckpt = os.path.join(tmp_dir, "ckpt")
    ingest_stream(spark, src, target, checkpoint=ckpt).awaitTermination()
    assert rows(spark.read.parquet(target)) == [("1", "one\nline"), ("2", "two")]
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("id,text\n3,three\n")
    ingest_stream(spark, src, target, checkpoint=ckpt).awaitTermination()
    assert rows(spark.read.parquet(target)) == [("1", "one\nline"), ("2", "two"), ("3", "three")]


def _landing(tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("id,text\n1,one\n2,two\n")
    return src


def test_two_targets_of_one_source_have_their_own_checkpoints(spark, tmp_dir):
    src = _landing(tmp_dir)
    for name in ("first", "second"):
        target = os.path.join(tmp_dir, name)
        ingest_stream(spark, src, target).awaitTermination()
        assert rows(spark.read.parquet(target)) == [("1", "one"), ("2", "two")]


def test_a_target_without_its_checkpoint_is_refused(spark, tmp_dir):
    src, target = _landing(tmp_dir), os.path.join(tmp_dir, "bronze")
    ingest_stream(spark, src, target, checkpoint=os.path.join(tmp_dir, "old")).awaitTermination()
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("id,text\n3,three\n")
    with pytest.raises(LostCheckpoint):
        ingest_stream(spark, src, target, checkpoint=os.path.join(tmp_dir, "new"))
    ingest_stream(spark, src, target, checkpoint=os.path.join(tmp_dir, "old")).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_misfit_records_of_a_stream_go_to_its_quarantine(spark, tmp_dir):
    def drop(name, text):
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        with open(f"{tmp_dir}/in/{name}.csv", "w", newline="") as f:
            f.write(text)

    def run():
        ingest_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/check",
                      quarantine=f"{tmp_dir}/bad").awaitTermination()
        bad = spark.read.parquet(f"{tmp_dir}/bad")
        return rows(spark.read.parquet(f"{tmp_dir}/out")), rows(bad.select("reason", "record"))

    drop("a", 'id,text\n1,"l1\nl2"\n2\n3,x,y\n')
    good, bad = run()
    assert good == [("1", "l1\nl2")] and bad == [("surplus_fields", "3,x,y"), ("too_few_fields", "2")]
    drop("b", 'id,text\n4,"q ""w"""\n5,"open\n6,z\n')
    good, bad = run()
    assert good == [("1", "l1\nl2"), ("4", 'q "w"')]
    assert bad == [("open_quote", '5,"open\n6,z'), ("surplus_fields", "3,x,y"), ("too_few_fields", "2")]
    assert run() == (good, bad)  # nothing new: nothing is written twice
