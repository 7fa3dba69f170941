"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import materialize

__all__ = ["column_type", "documents", "empty_text", "held_out", "materialize", "release", "row_ids", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and ``extra`` columns only: other columns never clash."""
    return docs.select("doc_id", empty_text(docs["text"]).alias("text"), *extra)


def empty_text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    code = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(code % modulus == remainder, F.lit(False))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does when their plans are collected as garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


class row_ids:  # noqa: N801
    """Numbers for the rows that a task emits: the task's partition, then a counter.

    Only valid once the emitted rows have been written (a written row keeps its
    number; a recomputed task gives the same numbers for the same input split).
    """

    def __init__(self):
        self.at = TaskContext.get().partitionId() << 40

    def take(self, n: int) -> range:
        out = range(self.at, self.at + n)
        self.at += n
        return out
