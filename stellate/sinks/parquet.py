"""Parquet sinks.

* ``write_table``: one table, replaced on rerun (the source jobs appended,
  so a rerun duplicated rows).
* ``write_partitioned``: partitioned by data columns (``year``, ``state``
  ...), one job for every partition value, with *dynamic* partition
  overwrite: a rerun replaces exactly the partitions it writes and leaves
  the others alone.  ``whole=True`` replaces everything under the path, so no
  partition of an earlier run is left that this one no longer has.

File sizes are left to AQE (``advisoryPartitionSizeInBytes``) and
``maxRecordsPerFile`` instead of a fixed ``coalesce(2)``, which would
funnel the whole upstream stage through two tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

MAX_RECORDS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite", whole: bool = False) -> None:
    cols = list(partition_cols)
    # No repartition by the partition columns: with few values (one year,
    # seven states) that would funnel the table through a handful of tasks.
    # Each task writes its own file per value it holds (the writer sorts by
    # the partition columns inside the task), capped by maxRecordsPerFile.
    (df.write.mode(mode)
       .option("partitionOverwriteMode", "static" if whole else "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(*cols).parquet(path))
