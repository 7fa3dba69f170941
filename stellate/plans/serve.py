"""Serving queries: price series by region, entity lookup, JSON rows.

Parameters are bound with ``spark.sql(..., args=...)`` (named parameter
markers), never spliced into the text, so a value such as ``' OR '1'='1``
is just a value.  Catalyst sees an ordinary filter, so it is pushed into
the Parquet scan and, on a table partitioned by the filtered column,
prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.text import none_text


def price_by_region(spark: SparkSession, houseprice: DataFrame, school: DataFrame,
                    local_gov_code: int) -> DataFrame:
    """Distinct (code, name, price, year) for one local-government code, by year.

    Both sides are made distinct before the join, so many schools of a code never meet many prices.
    """
    if local_gov_code is None:
        raise ValueError("local_gov_code is required")
    return spark.sql(
        """WITH price AS (SELECT DISTINCT local_government_code, median_house_price, year FROM {houseprice}
                         WHERE local_government_code = :code),
                region AS (SELECT DISTINCT local_government_code, local_government FROM {school})
           SELECT price.local_government_code, local_government, median_house_price, year
           FROM price JOIN region ON price.local_government_code = region.local_government_code
           ORDER BY year""",
        args={"code": int(local_gov_code)}, houseprice=houseprice, school=school)


def entity_lookup(spark: SparkSession, entities: DataFrame, name: str,
                  name_col: str = "school_name", limit: int | None = None) -> DataFrame:
    """All rows whose ``name_col`` equals ``name``; an empty name is an error.

    With ``limit`` the first rows by all columns, so a page is the same on every run.
    """
    if name is None or name == "":
        raise ValueError('A "name" parameter is required.')
    out = spark.sql(f"SELECT * FROM {{entities}} WHERE `{name_col}` = :name",
                    args={"name": name}, entities=entities)
    return out if limit is None else out.orderBy(*[F.col(f"`{c}`") for c in out.columns]).limit(limit)


def json_rows(df: DataFrame, col_name: str = "json") -> DataFrame:
    """Each row as a JSON object of strings; nulls become the text ``None``.

    Rendered on the executors; the driver never assembles the result.
    """
    return df.select(F.to_json(F.struct(*[none_text(F.col(f"`{c}`")).alias(c) for c in df.columns]))
                     .alias(col_name))
