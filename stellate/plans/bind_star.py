"""Star-schema, silver and serving pipelines bound to the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators.joins import three_way_join
from stellate.operators.quality import orphan_keys
from stellate.plans import serve, silver, star
from stellate.plans import world as W
from stellate.plans.registry import register
from stellate.plans.tables import table


from stellate.plans.sql_text import sql_reconcile as _sql_reconcile


ID_ORDER = ["school_id", "school_name", "postcode"]
PROFILE_LEFT = [*W.PROFILE_REST, "location_id"]
T1_SQL = _sql_reconcile(W.PROFILE_SQL, W.DETAIL_SQL, PROFILE_LEFT, ["gender", "religion"],
                        order=PROFILE_LEFT + ["gender", "religion"], id_col="profile_id", id_order=ID_ORDER)
IDS_SQL = f"SELECT school_id, school_name, suburb, postcode FROM ({T1_SQL}) t1"
U2_SQL = _sql_reconcile(IDS_SQL, W.SCORES_SQL, ["school_id", "suburb"], W.SCORES_COLS,
                        order=["school_id", "suburb"] + W.SCORES_COLS, id_col="naplan_id", id_order=ID_ORDER)
U3_RAW = _sql_reconcile(IDS_SQL, W.FEES_SQL, ["school_id", "suburb"], W.FEES_COLS,
                        order=["school_id", "suburb"] + W.FEES_COLS, id_col="fees_id", id_order=ID_ORDER)
U3_SQL = (f"SELECT * FROM ({U3_RAW}) u WHERE fees_id IS NOT NULL AND school_name IS NOT NULL "
          "AND postcode IS NOT NULL AND school_id IS NOT NULL AND suburb IS NOT NULL "
          "AND boarding IS NOT NULL AND international IS NOT NULL AND fee_total IS NOT NULL")
SCORE_DIM_SQL = (f"SELECT naplan_id, reading, writing, spelling, grammar, numeracy FROM ({U2_SQL}) u "
                 "WHERE reading IS NOT NULL AND writing IS NOT NULL AND spelling IS NOT NULL "
                 "AND grammar IS NOT NULL AND numeracy IS NOT NULL")
SCORE_BRIDGE_SQL = f"SELECT school_id, naplan_id, grade FROM ({U2_SQL}) u WHERE grade IS NOT NULL"
LOC_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in ["school_id"] + W.LOCATION_REST)
LOCATION_BASE_SQL = f"""
WITH loc AS (SELECT school_id, ageid, school_name, state, suburb, postcode, latitude, longitude,
                    local_government_code, local_government, geolocation FROM (
  SELECT *, row_number() OVER (PARTITION BY suburb, school_name, postcode ORDER BY {LOC_ORDER}) AS rn
  FROM ({W.LOCATION_RAW_SQL}) l) t WHERE rn = 1),
ids AS (SELECT school_id, location_id FROM ({T1_SQL}) t1)
SELECT ids.location_id, loc.* FROM loc JOIN ids USING (school_id)"""


def _t1(spark, d):
    return star.profile_reconciled(star.prepare_profile(W.profile_raw(spark, d)), W.detail_raw(spark, d))


def _ids(spark, d):
    return star.school_ids(_t1(spark, d))


# ---- T1, T4 ---------------------------------------------------------------------------

@register("profile_reconciled", T1_SQL)
def q_profile_reconciled(spark, d):
    return _t1(spark, d)


@register("school_fact", f"SELECT {', '.join(star.FACT_COLUMNS)} FROM ({T1_SQL}) t1")
def q_school_fact(spark, d):
    return star.school_fact(_t1(spark, d))


# ---- T2, T3 ----------------------------------------------------------------------------

@register("score_dim", SCORE_DIM_SQL)
def q_score_dim(spark, d):
    return star.dimension_and_bridge(_ids(spark, d), W.scores_raw(spark, d), star.SCORES)[0]


@register("score_bridge", SCORE_BRIDGE_SQL)
def q_score_bridge(spark, d):
    return star.dimension_and_bridge(_ids(spark, d), W.scores_raw(spark, d), star.SCORES)[1]


@register("fees_dim", f"SELECT fees_id, fee_total FROM ({U3_SQL}) u")
def q_fees_dim(spark, d):
    return star.dimension_and_bridge(_ids(spark, d), W.fees_raw(spark, d), star.FEES)[0]


@register("fees_bridge", f"""SELECT school_id, fees_id, boarding, international FROM ({U3_SQL}) u
WHERE boarding IS NOT NULL AND international IS NOT NULL""")
def q_fees_bridge(spark, d):
    return star.dimension_and_bridge(_ids(spark, d), W.fees_raw(spark, d), star.FEES)[1]


@register("orphan_keys", f"""
WITH dk AS (SELECT DISTINCT naplan_id FROM ({SCORE_DIM_SQL}) a WHERE naplan_id IS NOT NULL),
bk AS (SELECT DISTINCT naplan_id FROM ({SCORE_BRIDGE_SQL}) b WHERE naplan_id IS NOT NULL)
SELECT naplan_id, 'bridge_only' AS side FROM bk WHERE naplan_id NOT IN (SELECT naplan_id FROM dk)
UNION ALL
SELECT naplan_id, 'dim_only' AS side FROM dk WHERE naplan_id NOT IN (SELECT naplan_id FROM bk)""")
def q_orphan_keys(spark, d):
    dim, bridge = star.dimension_and_bridge(_ids(spark, d), W.scores_raw(spark, d), star.SCORES)
    return orphan_keys(dim, bridge, "naplan_id")


# ---- T5 ------------------------------------------------------------------------------------

@register("location_base", LOCATION_BASE_SQL)
def q_location_base(spark, d):
    return star.location_base(W.location_raw(spark, d), _t1(spark, d))


# ---- T10, T11, J12 -------------------------------------------------------------------------

@register("house_price", W.HOUSEPRICE_SQL)
def q_house_price(spark, d):
    return silver.house_price(W.houseprice_raw(spark, d))


_INC = (f"SELECT TRY_CAST(substr(region, 1, 4) AS INTEGER) AS Post_code_HI, "
        f"{W.trunc_int_sql('obs')} AS income FROM ({W.INCOME_SQL}) i")
_DEM = (f"SELECT TRY_CAST(substr(region, 1, 4) AS INTEGER) AS Post_code_D, "
        f"trim(list_extract(string_split(state_text, ':'), 2)) AS State, period AS year, "
        f"{W.trunc_int_sql('obs')} AS Population FROM ({W.DEMOGRAPHIC_SQL}) dm")
_RENT = (f"SELECT TRY_CAST(substr(region, 1, 4) AS INTEGER) AS Post_code_WR, "
         f"{W.trunc_int_sql('obs')} AS rent FROM ({W.RENT_SQL}) r")
_JOINED = f"""SELECT d.Post_code_D, d.State, d.year, d.Population, i.income, r.rent
FROM ({_DEM}) d JOIN ({_INC}) i ON d.Post_code_D = i.Post_code_HI
JOIN ({_RENT}) r ON r.Post_code_WR = i.Post_code_HI"""


@register("three_way_join", f"""SELECT Post_code_D, State, year, Population,
  income AS "Median total household income ($/weekly)", rent AS Median_weekly_rent FROM ({_JOINED}) j""")
def q_three_way_join(spark, d):
    inc = silver.household_income(W.income_raw(spark, d)).drop("State", "year")
    dem = silver.demographic(W.demographic_raw(spark, d))
    rent = silver.weekly_rent(W.rent_raw(spark, d)).drop("State", "year")
    return three_way_join(dem, inc, rent, "Post_code_D", "Post_code_HI", "Post_code_WR")


@register("suburb_info", f"""SELECT TRY_CAST(year AS INTEGER) AS year, Post_code_D AS postcode,
  income AS "median_total_household_income_($/weekly)", rent AS median_weekly_rent,
  Population AS population, State AS state FROM ({_JOINED}) j""")
def q_suburb_info(spark, d):
    return silver.suburb_info(W.income_raw(spark, d), W.demographic_raw(spark, d), W.rent_raw(spark, d))


# ---- serving -------------------------------------------------------------------------------

PRICE_CODE = 72

_LOC_SCHOOL_SQL = f"SELECT * FROM ({W.LOCATION_RAW_SQL}) s"


@register("price_by_region", f"""SELECT DISTINCT h.local_government_code, s.local_government,
  h.median_house_price, h.year
FROM ({W.HOUSEPRICE_SQL}) h JOIN ({_LOC_SCHOOL_SQL}) s ON h.local_government_code = s.local_government_code
WHERE h.local_government_code = {PRICE_CODE}""")
def q_price_by_region(spark, d):
    school = W.location_raw(spark, d).withColumnsRenamed(
        {"local_government_area": "local_government_code", "local_government_area_name": "local_government"})
    return serve.price_by_region(spark, silver.house_price(W.houseprice_raw(spark, d)), school, PRICE_CODE)


LOOKUP_NAME = "BUILDING 3"


@register("entity_lookup", f"SELECT * FROM ({W.PROFILE_RAW_SQL}) p WHERE school_name = '{LOOKUP_NAME}'")
def q_entity_lookup(spark, d):
    return serve.entity_lookup(spark, W.profile_raw(spark, d), LOOKUP_NAME)


@register("json_rows", """SELECT json_object(
  'p_partkey', COALESCE(CAST(p_partkey AS VARCHAR), 'None'), 'p_name', COALESCE(p_name, 'None'),
  'p_brand', COALESCE(NULLIF(p_brand, 'Brand#1'), 'None'), 'p_size', COALESCE(CAST(p_size AS VARCHAR), 'None'),
  'p_retailprice', COALESCE(CAST(p_retailprice AS VARCHAR), 'None'))::VARCHAR AS json FROM part""")
def q_json_rows(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", "p_name", F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("p_brand"),
        "p_size", "p_retailprice")
    return serve.json_rows(p)
