"""Silver tables from the statistics-agency CSV extracts.

The extracts arrive with header names such as ``REGION: Region`` and every
value as text.  Numbers are read the way the original (non-ANSI) jobs read
them: a decimal keeps its integer part, anything else becomes null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.functions.schema import apply_mapping
from stellate.functions.text import code_label_part, postcode_prefix, truncating_int
from stellate.operators.joins import three_way_join

# ---- fixed values ------------------------------------------------------------
REGION = "REGION: Region"
STATE = "STATE: State"
PERIOD = "TIME_PERIOD: Time Period"
SEX = "SEXP: Sex"
PERSONS = "3: Persons"
DROP_INCOME = ["DATAFLOW", "MEDAVG: Median/Average", "REGION_TYPE: Region Type"]
DROP_DEMOGRAPHIC = ["DATAFLOW", "PCHAR: Selected person characteristic", "REGION_TYPE: Region Type"]
INCOME_COL = "Median total household income ($/weekly)"
SUBURB_MAPPING = [("year", "string", "year", "int"),
                  ("Post_code_D", "int", "postcode", "int"),
                  (INCOME_COL, "int", "median_total_household_income_($/weekly)", "int"),
                  ("Median_weekly_rent", "int", "median_weekly_rent", "int"),
                  ("Population", "int", "population", "int"),
                  ("State", "string", "state", "string")]
# -------------------------------------------------------------------------------


def house_price(raw: DataFrame) -> DataFrame:
    """(local_government_code int, year string, median_house_price int)."""
    return raw.select(
        truncating_int("LGA_2021").alias("local_government_code"),
        F.col("TIME_PERIOD").alias("year"),
        truncating_int("OBS_VALUE").alias("median_house_price"))


def _region_stats(df: DataFrame, drop: list[str], postcode_name: str, value_name: str) -> DataFrame:
    df = df.drop(*drop)
    out = (df.withColumn(REGION, postcode_prefix(F.col(f"`{REGION}`"), 4))
             .withColumn(STATE, code_label_part(F.col(f"`{STATE}`"), 1))
             .withColumn("OBS_VALUE", truncating_int("OBS_VALUE")))
    return out.withColumnsRenamed({REGION: postcode_name, STATE: "State", PERIOD: "year",
                                   "OBS_VALUE": value_name})


def household_income(raw: DataFrame) -> DataFrame:
    return _region_stats(raw, DROP_INCOME, "Post_code_HI", INCOME_COL)


def demographic(raw: DataFrame) -> DataFrame:
    persons = raw.where(F.col(f"`{SEX}`") == F.lit(PERSONS)).drop(SEX)
    return _region_stats(persons, DROP_DEMOGRAPHIC, "Post_code_D", "Population")


def weekly_rent(raw: DataFrame) -> DataFrame:
    return _region_stats(raw, DROP_INCOME, "Post_code_WR", "Median_weekly_rent")


def suburb_info(income_raw: DataFrame, demographic_raw: DataFrame, rent_raw: DataFrame) -> DataFrame:
    """Income, population and rent per postcode.

    The three sources are joined on postcode only (not year or state), as
    the source job does; a postcode with several years on one side fans out.
    """
    inc = household_income(income_raw).drop("State", "year")
    dem = demographic(demographic_raw)
    rent = weekly_rent(rent_raw).drop("State", "year")
    joined = three_way_join(dem, inc, rent, "Post_code_D", "Post_code_HI", "Post_code_WR")
    return apply_mapping(joined, SUBURB_MAPPING)
