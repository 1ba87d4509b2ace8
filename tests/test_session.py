import pytest

from alloy.session import checkpoint_root, drop_scratch, object_store_conf, scratch_path


def test_object_store_conf_has_no_secrets():
    conf = object_store_conf("http://store:9000", cloud_committer=True)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "directory"
    assert not any("secret" in k or "access.key" in k for k in conf)


def test_scratch_lives_below_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


class _Cluster:
    """A session of a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class sparkContext:
        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Cluster)


def test_a_local_session_without_a_folder_gets_one_of_its_own():
    class _Local(_Cluster):
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "local[2]", "spark.app.id": "local-test"}.get(key, default)

    assert checkpoint_root(_Local) == checkpoint_root(_Local)
    assert scratch_path(_Local, "x").startswith(checkpoint_root(_Local))


def test_scratch_of_the_application_can_be_dropped(spark, monkeypatch):
    root = f"{checkpoint_root(spark)}/other-application"
    monkeypatch.setattr("alloy.session._scratch_root", lambda _: root)
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    drop_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
