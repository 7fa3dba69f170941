"""Data-quality helpers: null drops, typed keys, referential checks, counts.

Counts are collected with ``DataFrame.observe``: the metric rides along the
job that writes or returns the data, instead of re-running the lineage for
each ``count()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """``df`` itself; an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: no columns {missing} (there are {df.columns})")
    return df


def drop_null_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def drop_null_any(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.na.drop(how="any")


def normalise_key(df: DataFrame, col: str, to_type: str = "bigint",
                  observation: Observation | None = None) -> DataFrame:
    """Cast a text/mixed key to one declared type; malformed values become null.

    If ``observation`` is given, it records ``rejected`` (non-null inputs that
    did not convert) on the same job that consumes the result.
    """
    src = F.col(col)
    typed = F.trim(src.cast("string")).try_cast(to_type)
    out = df.withColumn(col, typed)
    if observation is not None:
        out = df.withColumn("__stl_typed", typed).observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.when(src.isNotNull() & F.col("__stl_typed").isNull(), 1).otherwise(0)).alias("rejected"),
        ).withColumn(col, F.col("__stl_typed")).drop("__stl_typed")
    return out


def orphan_keys(dim: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only: ``(key, side)`` with side 'bridge_only' / 'dim_only'."""
    d = dim.select(key).where(F.col(key).isNotNull()).distinct()
    b = bridge.select(key).where(F.col(key).isNotNull()).distinct()
    bridge_only = b.join(d, key, "left_anti").withColumn("side", F.lit("bridge_only"))
    dim_only = d.join(b, key, "left_anti").withColumn("side", F.lit("dim_only"))
    return bridge_only.unionByName(dim_only)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; read ``obs.get['rows']`` after an action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
