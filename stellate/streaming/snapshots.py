"""Incremental ingestion of landed snapshots with Structured Streaming.

The statistics feed lands a full extract as ``<root>/<run_ts>/*.csv`` each
time it runs; the batch job then cleans the newest one.  As a stream:

* a file source over ``<root>/*/`` sees each landed file exactly once
  (progress is kept in the checkpoint location, so a restart, or a lost
  executor, neither skips nor repeats a snapshot);
* each micro-batch takes the newest snapshot it has seen a file of (several
  may have landed since the last trigger), reads that whole folder -- files
  of earlier batches included -- cleans it with the silver transformation and
  overwrites just the partitions it touches (dynamic partition overwrite), so
  re-processing is idempotent and a file landing late completes its snapshot;
* the newest snapshot written is kept beside the checkpoint: an older one
  that lands late never replaces it;
* ``trigger(availableNow=True)`` makes it a catch-up job that processes
  what has landed and stops -- the scheduled batch job's shape -- while a
  processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import StringType, StructField, StructType

from stellate.sinks.parquet import write_partitioned
from stellate.sources.snapshots import RUN_TS_RE

SNAPSHOT_RE = rf"/({RUN_TS_RE})/[^/]*$"


def newest_snapshot(batch: DataFrame) -> str:
    """Name of the newest snapshot folder present in ``batch`` (empty without one)."""
    name = F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_RE, 1)
    return batch.agg(F.max(name)).first()[0] or ""         # one scalar per micro-batch


def _written(spark: SparkSession, path: str) -> str:
    try:
        return spark.read.text(path).agg(F.max("value")).first()[0] or ""
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return ""


def ingest_snapshots(spark: SparkSession, root: str, columns: Sequence[str],
                     transform: Callable[[DataFrame], DataFrame], out_path: str,
                     partition_cols: Sequence[str], checkpoint: str, once: bool = True):
    """Stream landed CSV snapshots under ``root`` into a partitioned silver table.

    Returns the (finished, when ``once``) streaming query.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    base, mark = root.rstrip("/"), f"{checkpoint.rstrip('/')}-newest"
    stream = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
                   .option("pathGlobFilter", "*.csv").csv(f"{base}/*/").select("_metadata"))

    def write(batch: DataFrame, _epoch: int) -> None:
        session = batch.sparkSession
        newest = newest_snapshot(batch)
        if not newest or newest < _written(session, mark):
            return
        rows = (session.read.schema(schema).option("header", True).option("enforceSchema", False)
                       .option("pathGlobFilter", "*.csv").csv(f"{base}/{newest}"))
        write_partitioned(transform(rows), out_path, partition_cols)
        session.createDataFrame([(newest,)], "value string").coalesce(1).write.mode("overwrite").text(mark)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start()
    if once:
        q.awaitTermination()
    return q
