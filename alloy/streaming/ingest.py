"""Incremental landing → bronze ingestion with Structured Streaming.

The batch ``run_bronze`` rewrites every table on every run.  When landing
files only ever arrive (never change), the same CSV → Parquet step can run
as a file stream with an ``availableNow`` trigger: each run reads only files
not seen before, and the checkpoint plus the Parquet sink's log make the
result exactly-once even when executors or the driver die mid-run.  Each new
file is read by one task (``multiLine``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alloy.session import checkpoint_root
from alloy.sources.csv import CSV_READ_OPTIONS, read_csv, stream_checked


class LostCheckpoint(RuntimeError):
    """The target was written by a stream whose checkpoint isn't there."""


def header_schema(spark: SparkSession, path: str, glob: str = "*.csv") -> StructType:
    """All-string schema named by the CSV header (no inference pass)."""
    return read_csv(spark, path, glob=glob).schema


def default_checkpoint(spark: SparkSession, source: str, target: str) -> str:
    """A folder below the shared checkpoint root of this source and target alone."""
    name = hashlib.sha256(f"{source.rstrip('/')}\n{target.rstrip('/')}".encode()).hexdigest()[:24]
    return f"{checkpoint_root(spark)}/alloy-streams/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def ingest_stream(spark: SparkSession, source: str, target: str, *,
                  schema: StructType | None = None, checkpoint: str | None = None,
                  glob: str = "*.csv", quarantine: str | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream from CSV files below ``source`` to Parquet.

    With a ``quarantine`` path, records that don't fit the header go there
    (file, reason, record; see ``csv.stream_checked``) and no others to the
    target.  A stream of its own writes them, with a checkpoint of its own,
    and has finished when this function returns.

    Call ``awaitTermination()`` on the result to wait for the run to finish.
    The checkpoint defaults to a folder of this source and target below the
    shared checkpoint root.  A target that has a sink log while the
    checkpoint doesn't exist is refused: the sink would skip the new
    checkpoint's first batches as already written.
    """
    schema = schema or header_schema(spark, source, glob)
    checkpoint = checkpoint or default_checkpoint(spark, source, target)
    if _exists(spark, f"{target.rstrip('/')}/_spark_metadata") and not _exists(spark, checkpoint):
        raise LostCheckpoint(f"{target} was written by a stream, and its checkpoint {checkpoint} doesn't exist")
    if quarantine is not None:
        stream, misfits = stream_checked(spark, source, schema.names, glob)
        apart = f"{checkpoint.rstrip('/')}-misfits"
        if _exists(spark, f"{quarantine.rstrip('/')}/_spark_metadata") and not _exists(spark, apart):
            raise LostCheckpoint(f"{quarantine} was written by a stream, and its checkpoint {apart} doesn't exist")
        _write(misfits, quarantine, apart).awaitTermination()
        return _write(stream, target, checkpoint)
    stream = (spark.readStream.format("csv")
              .options(**CSV_READ_OPTIONS)
              .option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true")
              .schema(schema)
              .load(source))
    return _write(stream, target, checkpoint)


def _write(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
