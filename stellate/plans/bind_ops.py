"""Single operators bound to the benchmark tables (see ``bindings``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from stellate.functions import text as T
from stellate.functions.schema import apply_mapping, normalise_headers
from stellate.operators.dedupe import dedupe
from stellate.operators.ids import assign_ids
from stellate.operators.joins import (inner_join_dedupe, left_anti, left_join_dedupe,
                                      lookup_join, right_anti)
from stellate.operators.quality import drop_null_any, drop_null_subset, normalise_key
from stellate.operators.union import union_all, union_by_name
from stellate.plans.registry import register
from stellate.plans.tables import TABLES, table


#: Orders name customers this much further on, so both sides of an anti join have keys that miss.
SHIFT = 100


# ---- A3 one row per key ----------------------------------------------------

@register("dedupe_by_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
    o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST, o_orderstatus ASC NULLS LAST,
    o_totalprice ASC NULLS LAST, o_orderpriority ASC NULLS LAST) AS rn FROM orders) t
WHERE rn = 1""")
def q_dedupe_by_key(spark, d):
    return dedupe(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ---- W1 dense surrogate ids --------------------------------------------------

@register("surrogate_key", """
SELECT row_number() OVER (ORDER BY c_name ASC NULLS FIRST, c_custkey ASC NULLS FIRST) AS customer_id,
       c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""")
def q_surrogate_key(spark, d):
    return assign_ids(table(spark, d, "customer"), ["c_name", "c_custkey"], "customer_id")


# ---- joins -----------------------------------------------------------------------

@register("inner_join_using", f"""
WITH c AS (SELECT c_custkey AS custkey, c_name FROM customer),
o AS (SELECT o_custkey AS custkey, o_orderdate, o_orderkey FROM orders),
j AS (SELECT c.custkey, c.c_name, o.o_orderdate, o.o_orderkey FROM c JOIN o USING (custkey))
SELECT custkey, c_name, o_orderdate, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY c_name ASC NULLS LAST,
    o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST) AS rn FROM j) t WHERE rn = 1""")
def q_inner_join_using(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderdate", "o_orderkey")
    return inner_join_dedupe(c, o, ["custkey"], right_order=["o_orderdate", "o_orderkey"])


@register("left_anti", f"""
SELECT c_custkey AS custkey, c_name, c_mktsegment FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey + {SHIFT} = c.c_custkey)""")
def q_left_anti(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    o = table(spark, d, "orders").select((F.col("o_custkey") + SHIFT).alias("custkey"))
    return left_anti(c, o, ["custkey"])


@register("right_anti", f"""
SELECT o_custkey + {SHIFT} AS custkey, o_orderkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey + {SHIFT})""")
def q_right_anti(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"))
    o = table(spark, d, "orders").select((F.col("o_custkey") + SHIFT).alias("custkey"), "o_orderkey", "o_totalprice")
    return right_anti(c, o, ["custkey"])


@register("lookup_join", """
WITH s AS (SELECT s_nationkey AS nationkey, s_suppkey, s_name, s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey ASC NULLS LAST,
    s_name ASC NULLS LAST, s_acctbal ASC NULLS LAST) AS rn FROM supplier) t WHERE rn = 1)
SELECT c.c_custkey, c.c_name, s.s_suppkey, s.s_name, s.s_acctbal
FROM customer c JOIN s ON c.c_nationkey = s.nationkey""")
def q_lookup_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"), "s_suppkey",
                                           "s_name", "s_acctbal")
    return lookup_join(c, s, "nationkey", lookup_order=["s_suppkey"])


@register("left_join_dedupe", f"""
WITH c AS (SELECT c_custkey AS ageid, c_name AS school_name, c_nationkey AS postcode,
                  c_mktsegment AS state, c_acctbal AS balance FROM customer),
o AS (SELECT o_custkey AS ageid, o_orderpriority AS catchment, o_orderkey AS phone FROM orders),
j AS (SELECT c.*, o.catchment, o.phone FROM c LEFT JOIN o USING (ageid))
SELECT balance, catchment, phone FROM (
  SELECT *, row_number() OVER (PARTITION BY school_name, postcode ORDER BY ageid ASC NULLS LAST,
    state ASC NULLS LAST, balance ASC NULLS LAST, catchment ASC NULLS LAST, phone ASC NULLS LAST) AS rn
  FROM j) t WHERE rn = 1""")
def q_left_join_dedupe(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("ageid"), F.col("c_name").alias("school_name"),
        F.col("c_nationkey").alias("postcode"), F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("balance"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("ageid"),
                                      F.col("o_orderpriority").alias("catchment"),
                                      F.col("o_orderkey").alias("phone"))
    return left_join_dedupe(c, o, on="ageid", dedupe_keys=["school_name", "postcode"],
                            drop=["state", "school_name", "postcode"], order_by=["ageid"])


# ---- null handling / typing ---------------------------------------------------------

_EVENTS_HOLED = ("SELECT event_id, user_id, NULLIF(event_type, 'error') AS event_type, "
                 "CASE WHEN value > 90 THEN NULL ELSE value END AS value FROM events")


def _events_holed(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", "user_id",
                    F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
                    F.when(~(F.col("value") > 90) | F.col("value").isNull(), F.col("value")).alias("value"))


@register("na_drop_subset", f"SELECT * FROM ({_EVENTS_HOLED}) t WHERE event_type IS NOT NULL")
def q_na_drop_subset(spark, d):
    return drop_null_subset(_events_holed(spark, d), ["event_type"])


@register("na_drop_any", f"""SELECT * FROM ({_EVENTS_HOLED}) t
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL""")
def q_na_drop_any(spark, d):
    return drop_null_any(_events_holed(spark, d))


_INT_SQL = ("CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            "THEN TRY_CAST(trim({x}) AS {t}) END")


@register("key_normalise", f"""
WITH o AS (SELECT o_orderkey,
  CASE o_orderpriority WHEN '5-LOW' THEN CAST(o_custkey AS VARCHAR) || 'x'
                       WHEN '4-NOT SPECIFIED' THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
                       ELSE CAST(o_custkey AS VARCHAR) END AS custkey FROM orders),
t AS (SELECT o_orderkey, {_INT_SQL.format(x='custkey', t='BIGINT')} AS custkey FROM o)
SELECT t.o_orderkey, t.custkey, c.c_name FROM t JOIN customer c ON c.c_custkey = t.custkey""")
def q_key_normalise(spark, d):
    o = table(spark, d, "orders")
    p = F.col("o_orderpriority")
    k = F.col("o_custkey").cast("string")
    raw = o.select("o_orderkey", F.when(p == "5-LOW", F.concat(k, F.lit("x")))
                   .when(p == "4-NOT SPECIFIED", F.concat(F.lit(" "), k, F.lit(" ")))
                   .otherwise(k).alias("custkey"))
    typed = normalise_key(raw, "custkey", "bigint")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return typed.join(c, "custkey", "inner").select("o_orderkey", "custkey", "c_name")


_SAFE_SRC_SQL = """SELECT event_id, CASE event_type
    WHEN 'view' THEN CAST(user_id AS VARCHAR)
    WHEN 'click' THEN ' ' || CAST(user_id AS VARCHAR) || ' '
    WHEN 'error' THEN CAST(value AS VARCHAR)
    WHEN 'signup' THEN CASE WHEN user_id > 50 THEN '' ELSE 'x' || CAST(user_id AS VARCHAR) END
    ELSE CAST(event_id * 1000000 AS VARCHAR) END AS raw FROM events"""


@register("safe_cast", f"""
SELECT event_id, raw, {_INT_SQL.format(x='raw', t='INTEGER')} AS as_int FROM ({_SAFE_SRC_SQL}) s""")
def q_safe_cast(spark, d):
    e = table(spark, d, "events")
    t, u = F.col("event_type"), F.col("user_id").cast("string")
    raw = (F.when(t == "view", u)
            .when(t == "click", F.concat(F.lit(" "), u, F.lit(" ")))
            .when(t == "error", F.col("value").cast("string"))
            .when(t == "signup", F.when(F.col("user_id") > 50, F.lit("")).otherwise(F.concat(F.lit("x"), u)))
            .otherwise((F.col("event_id") * 1000000).cast("string")))
    return e.select("event_id", raw.alias("raw")).withColumn("as_int", T.safe_int("raw"))


# ---- scalar text functions -------------------------------------------------------

@register("code_label_split", """
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN replace(o_orderpriority, '-', '')
                                  WHEN 'F' THEN o_orderpriority || '-x' ELSE o_orderpriority END AS v FROM orders)
SELECT o_orderkey, v, trim(list_extract(string_split(v, '-'), 2)) AS label,
       CASE WHEN regexp_full_match(substr(v, 1, 1), '[+-]?[0-9]+') THEN TRY_CAST(substr(v, 1, 1) AS INTEGER) END AS code
FROM o""")
def q_code_label_split(spark, d):
    o = table(spark, d, "orders")
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    v = (F.when(s == "P", F.regexp_replace(p, "-", ""))
          .when(s == "F", F.concat(p, F.lit("-x"))).otherwise(p))
    out = o.select("o_orderkey", v.alias("v"))
    return out.select("o_orderkey", "v",
                      F.trim(F.get(F.split("v", "-"), 1)).alias("label"),
                      T.postcode_prefix("v", 1).alias("code"))


@register("address_concat", """
SELECT c_custkey, concat_ws(',', c_name, NULLIF(c_mktsegment, 'BUILDING'), 'NSW', c_nationkey) AS address
FROM customer""")
def q_address_concat(spark, d):
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return c.select("c_custkey", T.address("c_name", seg, F.lit("NSW"), "c_nationkey").alias("address"))


@register("display_name", """
SELECT p_partkey, concat_ws(' - ', p_name, concat_ws(' ', NULLIF(p_brand, 'Brand#1'), p_size)) AS name_suburb_postcode
FROM part""")
def q_display_name(spark, d):
    p = table(spark, d, "part")
    brand = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand"))
    return p.select("p_partkey", T.display_name("p_name", brand, "p_size").alias("name_suburb_postcode"))


@register("campus_base_name", """
WITH r AS (SELECT CASE WHEN p_type = 'SMALL' THEN p_name || ' - ' || p_brand
            WHEN p_type = 'LARGE' THEN '"' || p_name || ' - ' || p_brand || ' - North'
            WHEN p_type = 'PROMO' THEN p_name || '-' || p_brand
            ELSE p_name END AS school_name, p_partkey FROM part)
SELECT p_partkey, school_name, trim(regexp_extract(school_name, '^"?(.+?)\\s+-\\s+', 1)) AS base_name
FROM r WHERE school_name LIKE '% - %'""")
def q_campus_base_name(spark, d):
    p = table(spark, d, "part")
    t = F.col("p_type")
    name = (F.when(t == "SMALL", F.concat("p_name", F.lit(" - "), "p_brand"))
             .when(t == "LARGE", F.concat(F.lit('"'), "p_name", F.lit(" - "), "p_brand", F.lit(" - North")))
             .when(t == "PROMO", F.concat("p_name", F.lit("-"), "p_brand"))
             .otherwise(F.col("p_name")))
    r = p.select("p_partkey", name.alias("school_name"))
    return (r.where(T.has_campus_suffix("school_name"))
             .select("p_partkey", "school_name", T.campus_base_name("school_name").alias("base_name")))


@register("campus_qualified_name", """
WITH v AS (SELECT p_partkey, p_name AS school_name,
  CASE WHEN p_type = 'SMALL' THEN ' ' || upper(p_name) WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS campus_name
  FROM part)
SELECT p_partkey, CASE WHEN trim(lower(school_name)) != trim(lower(campus_name))
                  THEN school_name || '-' || campus_name ELSE school_name END AS school_name
FROM v""")
def q_campus_qualified_name(spark, d):
    p = table(spark, d, "part")
    t = F.col("p_type")
    campus = (F.when(t == "SMALL", F.concat(F.lit(" "), F.upper("p_name")))
               .when(t == "PROMO", F.lit(None).cast("string")).otherwise(F.col("p_brand")))
    v = p.select("p_partkey", F.col("p_name").alias("school_name"), campus.alias("campus_name"))
    return v.select("p_partkey", T.campus_qualified_name("school_name", "campus_name").alias("school_name"))


# ---- column shaping ------------------------------------------------------------------

@register("normalise_headers", """
SELECT c_custkey AS cust_key, c_name AS "customer_name", c_acctbal AS "acct.bal", c_mktsegment AS "mkt_segment"
FROM customer""")
def q_normalise_headers(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("Acct.Bal"), F.col("c_mktsegment").alias("MKT Segment"))
    return normalise_headers(c)


@register("apply_mapping", f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS year_text,
                  CAST(o_totalprice AS VARCHAR) AS total_text FROM orders)
SELECT {_INT_SQL.format(x='year_text', t='INTEGER')} AS year,
       CAST(o_custkey AS INTEGER) AS customer, o_orderpriority AS priority,
       {_INT_SQL.format(x='total_text', t='INTEGER')} AS total
FROM o""")
def q_apply_mapping(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.year("o_orderdate").cast("string").alias("year_text"),
        F.col("o_totalprice").cast("string").alias("total_text"))
    return apply_mapping(o, [("year_text", "string", "year", "int"),
                             ("o_custkey", "bigint", "customer", "int"),
                             ("o_orderpriority", "string", "priority", "string"),
                             ("total_text", "string", "total", "int")])


@register("project_rename", """
SELECT p_partkey AS part_id, p_name AS name, p_size AS size FROM part""")
def q_project_rename(spark, d):
    p = table(spark, d, "part")
    return (p.withColumnsRenamed({"p_partkey": "part_id", "p_name": "name", "absent": "x"})
             .drop("p_brand", "p_type", "p_retailprice", "absent")
             .withColumnRenamed("p_size", "size"))


# ---- filters / distinct / unions / counts --------------------------------------------

@register("eq_filter", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'")
def q_eq_filter(spark, d):
    e = table(spark, d, "events")
    return e.where(F.col("event_type") == F.lit("click")).select("event_id", "user_id", "value")


@register("distinct_rows", "SELECT DISTINCT lang, source FROM documents")
def q_distinct_rows(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()


@register("union_positional", """
SELECT c_custkey AS party_key, c_name AS party_name FROM customer
UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def q_union_positional(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"))
    return union_all([c, s])


@register("union_by_name", """
SELECT c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def q_union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
                                           F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("party_key"),
                                           F.col("s_name").alias("party_name"))
    return union_by_name([c, s])


@register("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def q_row_counts(spark, d):
    parts = [table(spark, d, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)
