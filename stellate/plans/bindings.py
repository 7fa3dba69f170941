"""Operators bound to the benchmark tables, with DuckDB oracle statements.

Each entry of ``QUERIES`` is ``(spark, sf_dir) -> DataFrame`` and reads whole
tables; ``ORACLE`` holds, for the same key, an SQL statement over the same
tables whose result must equal it (same column names, same values).

The reconciliation pipeline is bound as follows: ``part`` plays the profile
(p_partkey = entity id, p_name = name, p_size = postcode) and a second view
of ``part`` plays the crawled detail source, where some types carry campus
suffixes, a leading quote, a hyphen without spaces, or a shifted postcode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.operators.reconcile import reconcile
from stellate.plans.tables import table

from stellate.plans.registry import ORACLE, QUERIES, register  # noqa: F401
from stellate.plans.sql_text import sql_reconcile


# --------------------------------------------------------------------------
# shared inputs
# --------------------------------------------------------------------------

def profile_source(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("school_id"),
                    F.col("p_name").alias("school_name"),
                    F.col("p_size").alias("postcode"))


def detail_source(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    t = F.col("p_type")
    name = (F.when(t == "SMALL", F.concat("p_name", F.lit(" - "), "p_brand"))
             .when(t == "LARGE", F.concat(F.lit('"'), "p_name", F.lit(" - "), "p_brand", F.lit(" - North")))
             .when(t == "PROMO", F.concat("p_name", F.lit("-"), "p_brand"))
             .otherwise(F.col("p_name")))
    postcode = F.when(t == "MEDIUM", F.col("p_size") + 100).otherwise(F.col("p_size"))
    return p.select(name.alias("school_name"), postcode.alias("postcode"),
                    t.alias("kind"), F.col("p_brand").alias("brand"))


SQL_PROFILE = "SELECT p_partkey AS school_id, p_name AS school_name, p_size AS postcode FROM part"
SQL_DETAIL = """SELECT CASE WHEN p_type = 'SMALL' THEN p_name || ' - ' || p_brand
            WHEN p_type = 'LARGE' THEN '"' || p_name || ' - ' || p_brand || ' - North'
            WHEN p_type = 'PROMO' THEN p_name || '-' || p_brand
            ELSE p_name END AS school_name,
       CASE WHEN p_type = 'MEDIUM' THEN p_size + 100 ELSE p_size END AS postcode,
       p_type AS kind, p_brand AS brand
FROM part"""


# --------------------------------------------------------------------------
# flagship: two-pass reconcile with dense ids
# --------------------------------------------------------------------------

@register("reconcile", sql_reconcile(
    SQL_PROFILE, SQL_DETAIL, ["school_id"], ["kind", "brand"],
    order=["school_id", "kind", "brand"], id_col="profile_id",
    id_order=["school_id", "school_name", "postcode"]))
def q_reconcile(spark, d):
    return reconcile(profile_source(spark, d), detail_source(spark, d),
                     keys=("school_name", "postcode"), name_col="school_name",
                     id_col="profile_id", order_by=("school_id",))


# the other bindings register themselves on import
from stellate.plans import (bind_catchment, bind_geo, bind_io, bind_ops, bind_similarity,  # noqa: E402,F401
                            bind_job, bind_star, bind_streaming)
