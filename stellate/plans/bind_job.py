"""The end-to-end build bound to the benchmark tables: every star table is
written once and its row count observed on that write."""

from __future__ import annotations

from stellate.plans import bind_catchment as C
from stellate.plans import world as W
from stellate.plans.bind_star import SCORE_BRIDGE_SQL, SCORE_DIM_SQL, T1_SQL, U3_SQL
from stellate.plans.job import TABLES, run
from stellate.plans.registry import register
from stellate.session import scratch_dir

YEAR = 2024

_COUNT_SQL = {
    "school": f"SELECT count(*) FROM ({T1_SQL}) t",
    "profile": f"SELECT count(*) FROM ({T1_SQL}) t",
    "naplan": f"SELECT count(*) FROM ({SCORE_DIM_SQL}) t",
    "school_naplan": f"SELECT count(*) FROM ({SCORE_BRIDGE_SQL}) t",
    "fees": f"SELECT count(*) FROM ({U3_SQL}) t",
    "school_fees": f"SELECT count(*) FROM ({U3_SQL}) t WHERE boarding IS NOT NULL AND international IS NOT NULL",
    "location": f"SELECT count(*) FROM ({C.LOCATION_DIM_SQL}) t",
    "gold_school": f"SELECT count(*) FROM ({C.GOLD_SQL}) t",
}


@register("school_etl", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, ({_COUNT_SQL[t]}) AS row_count" for t in TABLES))
def q_school_etl(spark, d):
    sources = {"profile": W.profile_raw(spark, d), "detail": W.detail_raw(spark, d),
               "scores": W.scores_raw(spark, d), "fees": W.fees_raw(spark, d),
               "location": W.location_raw(spark, d)}
    cats = C.state_catchments(spark, d, smallest=True)
    counts = run(sources, cats, scratch_dir(spark, "star"), YEAR)
    # a dozen observed scalars, not data
    return spark.createDataFrame([(t, counts[t]) for t in TABLES], "table_name string, row_count bigint")
