"""Spark session and shared-storage helpers.

Every operator in the package takes a ``SparkSession`` (or DataFrames) from
the caller; this module only builds a session for scripts and tests, and
hands out folders below the cluster's shared checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that suit any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Application id → its private folder, where no shared one is set.
_private: dict[str, str] = {}


def object_store_conf(
    endpoint: str,
    *,
    path_style: bool = True,
    ssl: bool = False,
    credentials_provider: str | None = None,
    buffer_dir: str | None = None,
    cloud_committer: bool = False,
) -> dict[str, str]:
    """Session settings for an S3-compatible store (IO7).

    Paths such as ``s3a://bucket/table`` then work in every reader and writer
    with no code change.  Secrets are left to the provider chain; they are
    never taken as arguments here.  ``cloud_committer`` selects the S3A
    "directory" committer with the Spark binding (needs the hadoop-cloud
    module on the classpath).
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    if buffer_dir:
        conf["spark.hadoop.fs.s3a.buffer.dir"] = buffer_dir
    if cloud_committer:
        conf.update({
            "spark.hadoop.fs.s3a.committer.name": "directory",
            "spark.hadoop.fs.s3a.committer.staging.conflict-mode": "replace",
            "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a":
                "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
            "spark.sql.sources.commitProtocolClass":
                "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
            "spark.sql.parquet.output.committer.class":
                "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
        })
    return conf


def get_spark(
    app: str = "alloy",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or return) a session with the package defaults.

    ``master`` is left to ``spark-submit`` when None.  ``conf`` overrides the
    defaults, e.g. ``spark.sql.shuffle.partitions`` sized to the data.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect: logging is the server's
        pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, so
    jobs that cut lineage or stage files survive a lost executor.  Where it
    is unset, a session in one process (master ``local…``) gets a private
    temporary folder; any other raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:  # classic sessions: a directory set with setCheckpointDir
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        app = spark.conf.get("spark.app.id", "app")  # the setting itself can't be changed while a session runs
        if app not in _private:
            _private[app] = tempfile.mkdtemp(prefix="alloy-ckpt-")
        root = _private[app]
    return root.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/alloy-scratch/{spark.conf.get('spark.app.id', 'app')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application below the shared checkpoint root."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch folders.

    Frames that operators have returned read them until they are written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable and return the root it uses."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root
