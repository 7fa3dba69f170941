"""Delimited-text and Parquet sources.

CSV inputs are read as text (no ``inferSchema``: no sampling pass, and no
type guess that changes between files); typing is an explicit later step
(``functions.text``, ``functions.schema.apply_mapping``).

Spark maps columns by position, so every file's header is checked against the
schema (``enforceSchema=false``): a file whose columns come in another order,
or under other names, fails the job instead of swapping values; ``read_csv_by_name``
reads such files together, by name.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stellate.functions.schema import normalise_headers
from stellate.operators.union import union_by_name


def read_csv(spark: SparkSession, path: str, normalise: bool = True,
             columns: list[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header row, every column a string; headers normalised.

    With ``columns`` (raw header names) the schema is declared up front and
    Spark skips the header-sampling job.  ``encoding`` names the file
    charset (e.g. ``ISO-8859-1`` for extracts that are not UTF-8).
    """
    r = spark.read.option("header", True).option("enforceSchema", False).option("encoding", encoding)
    if columns:
        r = r.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = r.csv(path)
    return normalise_headers(df) if normalise else df


def read_csv_tree(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Every CSV file below ``path`` (recursively), header names kept as they are."""
    return (spark.read.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
                 .option("encoding", encoding).option("pathGlobFilter", "*.csv").csv(path))


def read_csv_by_name(spark: SparkSession, path: str, normalise: bool = True) -> DataFrame:
    """Every CSV file below ``path``, columns matched by name: files may order them in their own way or lack some.

    One aggregation finds each file's header line; files of one header are
    read together, with Spark's own check that they have it, and the groups are
    united by name (a column that a file lacks is null).  Per distinct header
    the driver holds its files' paths, as any file scan does.  A header must be
    one line; of two columns of a file that are called alike, none is guessed.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    heads = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    if not groups:
        raise FileNotFoundError(f"no .csv file with a header under {path}")
    parts = []
    for g in groups:
        own = [c.strip().lower() for c in next(csv.reader([g.header]))]
        if len(set(own)) < len(own):
            raise ValueError(f"a column is repeated in {g.files[0]}: {g.header}")
        part = spark.read.option("header", True).option("enforceSchema", False).csv(g.files)
        parts.append(normalise_headers(part) if normalise else part)
    return union_by_name(parts)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row (the shape the CSV readers expect)."""
    df.write.mode(mode).option("header", True).csv(path)
