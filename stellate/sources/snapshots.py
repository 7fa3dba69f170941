"""Timestamped snapshot folders: landing one, and reading the newest.

A feed is landed as ``<root>/<YYYY-MM-DD-HH-MM-SS>/part-*.csv``.  The reader
lists file metadata only (the ``binaryFile`` source prunes the content
column), picks the newest ``.csv`` file by modification time -- ties broken
by path, so the choice does not depend on listing order.  Inside a run
timestamp folder every CSV file of that folder is read, elsewhere that one
file.  Only one path string reaches the driver.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.sources.files import write_csv

# ---- fixed values -------------------------------------------------------------
RUN_TS_FORMAT = "%Y-%m-%d-%H-%M-%S"
RUN_TS_RE = r"\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2}"
# ----------------------------------------------------------------------------------


def run_timestamp(when: dt.datetime | None = None) -> str:
    """Folder name for a landing run; pass ``when`` explicitly for reproducible runs."""
    return (when or dt.datetime.now(dt.timezone.utc)).strftime(RUN_TS_FORMAT)


def land_snapshot(df: DataFrame, root: str, run_ts: str) -> str:
    """Write ``df`` as header CSV under ``<root>/<run_ts>``; returns that folder.

    Rerunning with the same ``run_ts`` replaces the snapshot.
    """
    path = f"{root.rstrip('/')}/{run_ts}"
    write_csv(df, path)
    return path


def latest_csv_file(spark: SparkSession, root: str) -> str:
    """Path of the most recently modified ``.csv`` file below ``root``."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
                  .option("recursiveFileLookup", True).load(root)
                  .select("path", "modificationTime"))
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no .csv file under {root}")
    return row["p"]


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest ``.csv`` file, with the other CSV files of its snapshot folder if it lies in one."""
    newest = latest_csv_file(spark, root)
    folder = newest.rsplit("/", 1)[0]
    whole = re.fullmatch(RUN_TS_RE, folder.rsplit("/", 1)[-1])
    return (spark.read.option("header", True).option("enforceSchema", False)
                 .option("pathGlobFilter", "*.csv").csv(folder if whole else newest))
