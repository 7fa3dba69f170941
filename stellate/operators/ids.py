"""Dense surrogate keys 1..n without a single-partition window.

``row_number() over (order by k)`` with no ``partitionBy`` plans an
``Exchange SinglePartition``: one task sorts the whole table.  Instead:

1. range-partition on the ordering (Spark samples the full key, so a value
   shared by a third of the rows does not make one partition huge when the
   order is total) and sort inside each partition;
2. tag every row with its partition and its position inside it, and
   materialise that once so the counts and
   the rows below come from the same physical partitioning, also after an
   executor loss (written once as Parquet in the shared checkpoint folder);
3. count rows per partition (one row per partition: bounded by the
   partition count), turn the counts into running offsets, broadcast them;
4. id = offset of the partition + position inside it + 1.

The ordering must be total for the ids to be reproducible; callers append
key columns to make it so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.session import materialize

_PART, _MONO, _FIRST, _OFF, _N = "__stl_part", "__stl_mono", "__stl_first", "__stl_off", "__stl_n"


def _col(c) -> Column:
    # ascending, nulls first: Spark's default for ``orderBy(name)``
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def assign_ids(df: DataFrame, order_by: Sequence, name: str = "id",
               first: bool = True, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = dense rank 1..n of each row under ``order_by``."""
    spark = df.sparkSession
    order = [_col(c) for c in order_by]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = materialize(df.repartitionByRange(max(n, 1), *order)
                           .sortWithinPartitions(*order)
                           .select("*", F.spark_partition_id().alias(_PART),
                                   F.monotonically_increasing_id().alias(_MONO)), "ids")
    # one row per partition: size bounded by the partition count
    per_part = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N), F.min(_MONO).alias(_FIRST))
    offsets = per_part.select(
        _PART, _FIRST,
        F.coalesce(F.sum(_N).over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    out = (tagged.join(F.broadcast(offsets), _PART)
                 .withColumn(name, F.col(_OFF) + F.col(_MONO) - F.col(_FIRST) + F.lit(1))
                 .drop(_PART, _MONO, _FIRST, _OFF))
    cols = [c for c in df.columns if c != name]
    return out.select(name, *cols) if first else out.select(*cols, name)
