"""Publishing several tables at once, so readers see all of a run or none of it.

A run writes its tables under ``<root>/versions/year=<Y>/<version>/<table>`` and
then commits by creating one empty file, ``<root>/commits/year=<Y>/<n>-<version>``.
Creating a file is atomic on a file system and on an object store, and its name
says everything, so a reader never meets a half-written pointer.  The highest
``n`` is the year's version: a run that fails leaves the one before in place, a
rerun replaces the whole year, and a reader that has resolved a version keeps
reading it while the next one is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.sinks.parquet import write_partitioned, write_table


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a Hadoop path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _commits(spark: SparkSession, root: str, year: int) -> list[tuple[int, str]]:
    """(number, version) of a year's commits, oldest first."""
    return [(int(n), v) for n, _, v in (x.partition("-") for x in _names(spark, f"{root}/commits/year={int(year)}"))]


class Publication:
    """One run's tables of one year."""

    def __init__(self, spark: SparkSession, root: str, year: int):
        self.spark, self.root, self.year = spark, root.rstrip("/"), int(year)
        self.version = uuid.uuid4().hex
        self.path = f"{self.root}/versions/year={self.year}/{self.version}"

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write a table and read it back."""
        path = f"{self.path}/{name}"
        if partition_by:
            write_partitioned(df, path, partition_by, whole=True)
        else:
            write_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> int:
        """Make this version the year's; returns the commit's number."""
        number = max((n for n, _ in _commits(self.spark, self.root, self.year)), default=0) + 1
        fs, p = _folder(self.spark, f"{self.root}/commits/year={self.year}/{number:08d}-{self.version}")
        if not fs.createNewFile(p):
            raise RuntimeError(f"this version is committed already: {p}")
        return number


def read_published(spark: SparkSession, root: str, table: str, year: int | None = None) -> DataFrame:
    """A table of the committed version of a year (of every year if none is given), with its ``year``."""
    root = root.rstrip("/")
    years = [year] if year is not None else [int(x.partition("=")[2]) for x in _names(spark, f"{root}/commits")]
    found = [(y, c[-1][1]) for y in years if (c := _commits(spark, root, y))]
    if not found:
        raise FileNotFoundError(f"nothing is published under {root}" + (f" for {year}" if year is not None else ""))
    parts = [spark.read.parquet(f"{root}/versions/year={y}/{v}/{table}").withColumn("year", F.lit(int(y))) for y, v in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def drop_old_versions(spark: SparkSession, root: str, year: int, keep: int = 2) -> list[str]:
    """Delete versions of a year that were committed before the last ``keep``; returns their names.

    Versions without a commit may belong to a run that goes on and stay.
    """
    if keep < 1:
        raise ValueError("the committed version can't be dropped")
    root = root.rstrip("/")
    old = [v for _, v in _commits(spark, root, year)[:-keep]]
    for v in old:
        fs, p = _folder(spark, f"{root}/versions/year={int(year)}/{v}")
        fs.delete(p, True)
    return old
