"""The school pipelines' sources, derived from the benchmark tables.

Each source exists twice: as a Spark DataFrame and as the SQL text that
produces the same rows in DuckDB, so every pipeline table has an oracle.

* profile / location: one row per customer; the entity name is the market
  segment plus the balance in thousands (so names repeat and several rows
  share a (name, postcode) key); postcode = nation key; suburb = nation
  name; state derived from the region.
* detail: orders, one per row, pending ones with a campus suffix.
* scores: line items (grade = line number; returned lines under a campus
  name); fees: orders.
* statistics extracts: per-nation aggregates rendered as agency-style text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.plans.tables import table

# ---- fixed values: region -> state ---------------------------------------------
# MIDDLE EAST splits by market segment so one state has no catchments (TAS)
# and one has no gold partition (WA).
REGION_STATE = [("AFRICA", "NSW"), ("AMERICA", "VIC"), ("ASIA", "QLD"), ("EUROPE", "SA")]
OTHER_STATE_BUILDING, OTHER_STATE = "WA", "TAS"
# ----------------------------------------------------------------------------------


def _state(region: Column, segment: Column) -> Column:
    expr = F.when(segment == "BUILDING", F.lit(OTHER_STATE_BUILDING)).otherwise(F.lit(OTHER_STATE))
    for r, s in reversed(REGION_STATE):
        expr = F.when(region == r, F.lit(s)).otherwise(expr)
    return expr


def _state_sql(region: str, segment: str) -> str:
    whens = " ".join(f"WHEN {region} = '{r}' THEN '{s}'" for r, s in REGION_STATE)
    return (f"CASE {whens} WHEN {segment} = 'BUILDING' THEN '{OTHER_STATE_BUILDING}' "
            f"ELSE '{OTHER_STATE}' END")


def _name(seg: Column, bal: Column) -> Column:
    return F.concat(seg, F.lit(" "), F.floor(bal / 1000).cast("bigint").cast("string"))


NAME_SQL = "c_mktsegment || ' ' || CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR)"
CNR_SQL = ("customer JOIN nation ON c_nationkey = n_nationkey "
           "JOIN region ON n_regionkey = r_regionkey")


def _cnr(spark, d) -> DataFrame:
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


# ---- profile ---------------------------------------------------------------------

def profile_raw(spark, d) -> DataFrame:
    x = _cnr(spark, d)
    return x.select(
        F.col("c_custkey").alias("acara_sml_id"),
        _name(F.col("c_mktsegment"), F.col("c_acctbal")).alias("school_name"),
        F.col("c_mktsegment").alias("school_type"),
        F.col("n_name").alias("school_sector"),
        F.col("c_acctbal").alias("teaching_staff"),
        F.col("n_name").alias("suburb"),
        F.col("c_nationkey").alias("postcode"),
        _state(F.col("r_name"), F.col("c_mktsegment")).alias("state"),
        (F.col("c_custkey") + 1000000).alias("location_age_id"),
        F.col("r_name").alias("campus_type"),
        F.concat(F.lit("http://"), F.lower("c_name")).alias("school_url"),
        F.concat(F.col("r_name"), F.lit(" board")).alias("governing_body"),
        F.concat(F.lit("1-"), F.col("c_nationkey").cast("string")).alias("year_range"),
        (F.col("c_nationkey") * 10 + 5).alias("total_enrolments"),
        (F.col("c_nationkey") * 6).alias("girls_enrolments"),
        (F.col("c_nationkey") * 4 + 5).alias("boys_enrolments"),
        (F.col("c_custkey") % 7).alias("indigenous_enrolments_(%)"),
        (F.col("c_custkey") % 101).alias("language_background_other_than_english_-_yes_(%)"))


PROFILE_RAW_SQL = f"""SELECT c_custkey AS acara_sml_id, {NAME_SQL} AS school_name,
  c_mktsegment AS school_type, n_name AS school_sector, c_acctbal AS teaching_staff,
  n_name AS suburb, c_nationkey AS postcode, {_state_sql('r_name', 'c_mktsegment')} AS state,
  c_custkey + 1000000 AS location_age_id, r_name AS campus_type, 'http://' || lower(c_name) AS school_url,
  r_name || ' board' AS governing_body, '1-' || CAST(c_nationkey AS VARCHAR) AS year_range,
  c_nationkey * 10 + 5 AS total_enrolments, c_nationkey * 6 AS girls_enrolments,
  c_nationkey * 4 + 5 AS boys_enrolments, c_custkey % 7 AS "indigenous_enrolments_(%)",
  c_custkey % 101 AS "language_background_other_than_english_-_yes_(%)"
FROM {CNR_SQL}"""

#: Profile columns besides the keys, in the order in which survivors are told apart.
PROFILE_REST = ["school_id", "school_type", "campus_type", "school_sector", "school_url", "governing_body",
                "year_range", "teaching_staff", "total_enrolments", "girls_enrolments", "boys_enrolments",
                "indigenous", "multi_lingual", "suburb", "state"]
PROFILE_SQL = f"""SELECT acara_sml_id AS school_id, school_name, school_type, campus_type, school_sector, school_url,
  governing_body, year_range, teaching_staff, total_enrolments, girls_enrolments, boys_enrolments,
  "indigenous_enrolments_(%)" AS indigenous, "language_background_other_than_english_-_yes_(%)" AS multi_lingual,
  suburb, postcode, state,
  row_number() OVER (ORDER BY acara_sml_id ASC NULLS FIRST, school_name ASC NULLS FIRST,
                     postcode ASC NULLS FIRST) AS location_id
FROM ({PROFILE_RAW_SQL}) p"""


# ---- detail ------------------------------------------------------------------------

def detail_raw(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    base = _name(F.col("c_mktsegment"), F.col("c_acctbal"))
    name = F.when(F.col("o_orderstatus") == "P",
                  F.concat(base, F.lit(" - "), F.col("o_orderpriority"))).otherwise(base)
    return x.select(name.alias("school_name"), F.col("c_nationkey").alias("postcode"),
                    F.col("o_orderstatus").alias("gender"), F.col("o_orderpriority").alias("religion"))


DETAIL_RAW_SQL = f"""SELECT CASE WHEN o_orderstatus = 'P' THEN {NAME_SQL} || ' - ' || o_orderpriority
                 ELSE {NAME_SQL} END AS school_name,
  c_nationkey AS postcode, o_orderstatus AS gender, o_orderpriority AS religion
FROM orders JOIN customer ON o_custkey = c_custkey"""

DETAIL_SQL = f"""SELECT school_name, postcode, gender, religion FROM (
  SELECT *, row_number() OVER (PARTITION BY school_name, postcode
    ORDER BY gender ASC NULLS LAST, religion ASC NULLS LAST) AS rn FROM ({DETAIL_RAW_SQL}) d) t
WHERE rn = 1"""


# ---- scores and fees --------------------------------------------------------------------

def scores_raw(spark, d) -> DataFrame:
    li, o, c = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    base = _name(F.col("c_mktsegment"), F.col("c_acctbal"))
    name = F.when(F.col("l_returnflag") == "R",
                  F.concat(base, F.lit(" - Campus "), F.col("l_linestatus"))).otherwise(base)
    return x.select(
        F.col("c_nationkey").cast("string").alias("suburb"),
        name.alias("school_name"), F.col("c_nationkey").alias("postcode"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("grade"),
        F.col("l_quantity").alias("reading"), F.col("l_discount").alias("writing"),
        F.col("l_tax").alias("spelling"), F.col("l_extendedprice").alias("grammar"),
        F.when(~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")),
               F.col("l_partkey")).alias("numeracy"))


SCORES_SQL = f"""SELECT DISTINCT
  CASE WHEN l_returnflag = 'R' THEN {NAME_SQL} || ' - Campus ' || l_linestatus ELSE {NAME_SQL} END AS school_name,
  c_nationkey AS postcode, CAST(year(l_shipdate) AS VARCHAR) AS year,
  CASE WHEN l_linenumber != 7 THEN l_linenumber END AS grade,
  l_quantity AS reading, l_discount AS writing, l_tax AS spelling, l_extendedprice AS grammar,
  CASE WHEN NOT (l_linestatus = 'O' AND l_returnflag = 'N') THEN l_partkey END AS numeracy
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
SCORES_COLS = ["year", "grade", "reading", "writing", "spelling", "grammar", "numeracy"]


def fees_raw(spark, d) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    return x.select(
        F.col("c_nationkey").cast("string").alias("suburb"),
        _name(F.col("c_mktsegment"), F.col("c_acctbal")).alias("school_name"),
        F.col("c_nationkey").alias("postcode"),
        F.col("o_orderstatus").alias("boarding"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("international"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("fee_total"))


FEES_SQL = f"""SELECT DISTINCT {NAME_SQL} AS school_name, c_nationkey AS postcode,
  o_orderstatus AS boarding, CASE WHEN o_orderpriority != '1-URGENT' THEN o_orderpriority END AS international,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS fee_total
FROM orders JOIN customer ON o_custkey = c_custkey"""
FEES_COLS = ["boarding", "international", "fee_total"]


# ---- location ------------------------------------------------------------------------------

def location_raw(spark, d) -> DataFrame:
    x = _cnr(spark, d)
    return x.select(
        F.col("c_custkey").alias("acara_sml_id"),
        (F.col("c_custkey") + 1000000).alias("location_age_id"),
        _name(F.col("c_mktsegment"), F.col("c_acctbal")).alias("school_name"),
        _state(F.col("r_name"), F.col("c_mktsegment")).alias("state"),
        F.col("n_name").alias("suburb"), F.col("c_nationkey").alias("postcode"),
        (F.col("c_acctbal") / 100.0).alias("latitude"),
        (F.col("c_nationkey").cast("double") + 100.0).alias("longitude"),
        (F.col("c_nationkey") * 10 + F.col("n_regionkey")).alias("local_government_area"),
        F.col("n_name").alias("local_government_area_name"),
        F.col("c_mktsegment").alias("abs_remoteness_area_name"))


LOCATION_RAW_SQL = f"""SELECT c_custkey AS school_id, c_custkey + 1000000 AS ageid, {NAME_SQL} AS school_name,
  {_state_sql('r_name', 'c_mktsegment')} AS state, n_name AS suburb, c_nationkey AS postcode,
  c_acctbal / 100.0 AS latitude, CAST(c_nationkey AS DOUBLE) + 100.0 AS longitude,
  c_nationkey * 10 + n_regionkey AS local_government_code, n_name AS local_government,
  c_mktsegment AS geolocation
FROM {CNR_SQL}"""
LOCATION_REST = ["ageid", "state", "latitude", "longitude", "local_government_code",
                 "local_government", "geolocation"]


# ---- statistics extracts ----------------------------------------------------------------------

def _region_text(nk: Column, nname: Column) -> Column:
    return F.concat(F.lpad(nk.cast("string"), 4, "0"), F.lit(", "), nname)


def _state_text(rk: Column, rname: Column) -> Column:
    return F.concat(rk.cast("string"), F.lit(": "), rname)


def _money_text(v: Column) -> Column:
    return v.cast("decimal(18,2)").cast("string")


REGION_TEXT_SQL = "lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || ', ' || n_name"
STATE_TEXT_SQL = "CAST(n_regionkey AS VARCHAR) || ': ' || r_name"


def income_raw(spark, d) -> DataFrame:
    g = _cnr(spark, d).groupBy("n_nationkey", "n_name", "n_regionkey", "r_name").agg(
        F.max("c_acctbal").alias("v"))
    return g.select(F.lit("ABS:C21_G02_POA").alias("DATAFLOW"),
                    F.lit("1: Median").alias("MEDAVG: Median/Average"),
                    _region_text(F.col("n_nationkey"), F.col("n_name")).alias("REGION: Region"),
                    F.lit("POA: Postal Areas").alias("REGION_TYPE: Region Type"),
                    _state_text(F.col("n_regionkey"), F.col("r_name")).alias("STATE: State"),
                    F.lit("2021").alias("TIME_PERIOD: Time Period"),
                    _money_text(F.col("v")).alias("OBS_VALUE"))


INCOME_SQL = f"""SELECT {REGION_TEXT_SQL} AS region, {STATE_TEXT_SQL} AS state_text, '2021' AS period,
  CAST(CAST(max(c_acctbal) AS DECIMAL(18,2)) AS VARCHAR) AS obs
FROM {CNR_SQL} GROUP BY n_nationkey, n_name, n_regionkey, r_name"""


def demographic_raw(spark, d) -> DataFrame:
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    x = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    g = x.groupBy("n_nationkey", "n_name", "n_regionkey", "r_name").agg(
        F.count(F.lit(1)).alias("persons"),
        F.count(F.when(F.col("s_acctbal") > 5000, 1)).alias("males"))
    sex = F.explode(F.array(
        F.struct(F.lit("3: Persons").alias("sex"), F.col("persons").alias("v")),
        F.struct(F.lit("1: Males").alias("sex"), F.col("males").alias("v")))).alias("s")
    e = g.select("*", sex)
    return e.select(F.lit("ABS:C21_G01_POA").alias("DATAFLOW"),
                    F.lit("P_1: Total persons").alias("PCHAR: Selected person characteristic"),
                    F.col("s.sex").alias("SEXP: Sex"),
                    _region_text(F.col("n_nationkey"), F.col("n_name")).alias("REGION: Region"),
                    F.lit("POA: Postal Areas").alias("REGION_TYPE: Region Type"),
                    _state_text(F.col("n_regionkey"), F.col("r_name")).alias("STATE: State"),
                    F.lit("2021").alias("TIME_PERIOD: Time Period"),
                    F.col("s.v").cast("string").alias("OBS_VALUE"))


DEMOGRAPHIC_SQL = f"""SELECT {REGION_TEXT_SQL} AS region, {STATE_TEXT_SQL} AS state_text, '2021' AS period,
  CAST(count(*) AS VARCHAR) AS obs
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_nationkey, n_name, n_regionkey, r_name"""


def rent_raw(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    x = o.join(_cnr(spark, d), o.o_custkey == F.col("c_custkey"))
    g = x.groupBy("n_nationkey", "n_name", "n_regionkey", "r_name").agg(F.min("o_totalprice").alias("v"))
    return g.select(F.lit("ABS:C21_G36_POA").alias("DATAFLOW"),
                    F.lit("1: Median").alias("MEDAVG: Median/Average"),
                    _region_text(F.col("n_nationkey"), F.col("n_name")).alias("REGION: Region"),
                    F.lit("POA: Postal Areas").alias("REGION_TYPE: Region Type"),
                    _state_text(F.col("n_regionkey"), F.col("r_name")).alias("STATE: State"),
                    F.lit("2021").alias("TIME_PERIOD: Time Period"),
                    _money_text(F.col("v")).alias("OBS_VALUE"))


RENT_SQL = f"""SELECT {REGION_TEXT_SQL} AS region, {STATE_TEXT_SQL} AS state_text, '2021' AS period,
  CAST(CAST(min(o_totalprice) AS DECIMAL(18,2)) AS VARCHAR) AS obs
FROM orders JOIN {CNR_SQL} ON o_custkey = c_custkey GROUP BY n_nationkey, n_name, n_regionkey, r_name"""


def houseprice_raw(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    x = o.join(_cnr(spark, d), o.o_custkey == F.col("c_custkey"))
    g = x.groupBy((F.col("c_nationkey") * 10 + F.col("n_regionkey")).alias("lga"),
                  F.year("o_orderdate").alias("yr")).agg(F.max("o_totalprice").alias("v"))
    return g.select(F.lit("ABS_REGIONAL_LGA2021").alias("DATAFLOW"),
                    F.col("lga").cast("string").alias("LGA_2021"),
                    F.col("yr").cast("string").alias("TIME_PERIOD"),
                    _money_text(F.col("v")).alias("OBS_VALUE"),
                    F.lit("A").alias("FREQ"))


HOUSEPRICE_RAW_SQL = f"""SELECT CAST(c_nationkey * 10 + n_regionkey AS VARCHAR) AS LGA_2021,
  CAST(year(o_orderdate) AS VARCHAR) AS TIME_PERIOD,
  CAST(CAST(max(o_totalprice) AS DECIMAL(18,2)) AS VARCHAR) AS OBS_VALUE
FROM orders JOIN {CNR_SQL} ON o_custkey = c_custkey
GROUP BY c_nationkey * 10 + n_regionkey, year(o_orderdate)"""


def trunc_int_sql(x: str) -> str:
    """SQL twin of ``truncating_int``."""
    return (f"TRY_CAST(NULLIF(regexp_extract(trim({x}), '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1), '') "
            f"AS INTEGER)")


HOUSEPRICE_SQL = f"""SELECT {trunc_int_sql('LGA_2021')} AS local_government_code, TIME_PERIOD AS year,
  {trunc_int_sql('OBS_VALUE')} AS median_house_price FROM ({HOUSEPRICE_RAW_SQL}) h"""
