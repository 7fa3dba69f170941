"""Sources and sinks bound to the benchmark tables: write a table in the
format, read it back with the reader, compare with the table itself.

Scratch folders are created under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from stellate.functions.html import centre_code, centre_code_sql
from stellate.operators.geometry import to_wkt
from stellate.plans import silver
from stellate.plans import world as W
from stellate.plans.bind_geo import RECT_SQL, parts_as_rectangles, rect_wkt_sql
from stellate.plans.registry import register
from stellate.plans.tables import table
from stellate.session import scratch_dir
from stellate.sinks.parquet import write_partitioned, write_table
from stellate.sources.files import read_csv, read_csv_by_name, read_csv_tree, read_parquet, write_csv
from stellate.sources.geo_text import read_geojson, read_kml, write_geojson, write_kml
from stellate.sources.snapshots import land_snapshot, read_latest_snapshot

RAW_SQL = f"""SELECT 'ABS_REGIONAL_LGA2021' AS DATAFLOW, LGA_2021, TIME_PERIOD, OBS_VALUE, 'A' AS FREQ
FROM ({W.HOUSEPRICE_RAW_SQL}) h"""


@register("csv_source", """SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS customer_name,
  c_mktsegment AS mkt_segment, CAST(c_nationkey AS VARCHAR) AS "nation.key" FROM customer""")
def q_csv_source(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("MKT Segment"), F.col("c_nationkey").alias("Nation.Key"))
    path = scratch_dir(spark, "csv")
    write_csv(c, path)
    return read_csv(spark, path)


@register("parquet_source", "SELECT * FROM part")
def q_parquet_source(spark, d):
    path = scratch_dir(spark, "parquet")
    table(spark, d, "part").write.parquet(path)
    return read_parquet(spark, path)


@register("parquet_roundtrip", "SELECT * FROM nation")
def q_parquet_roundtrip(spark, d):
    path = scratch_dir(spark, "table")
    n = table(spark, d, "nation")
    write_table(n, path)
    write_table(n, path)          # a rerun replaces, it does not append
    return spark.read.parquet(path)


@register("partitioned_sink", W.HOUSEPRICE_SQL)
def q_partitioned_sink(spark, d):
    path = scratch_dir(spark, "houseprice")
    hp = silver.house_price(W.houseprice_raw(spark, d))
    write_partitioned(hp, path, ["year"])
    write_partitioned(hp, path, ["year"])   # rerun: same partitions replaced
    return spark.read.schema(hp.schema).parquet(path).select(*hp.columns)


@register("csv_recursive", RAW_SQL)
def q_csv_recursive(spark, d):
    root = scratch_dir(spark, "tree")
    raw = W.houseprice_raw(spark, d)
    write_csv(raw.where(F.col("TIME_PERIOD") < "1998"), f"{root}/early")
    write_csv(raw.where(F.col("TIME_PERIOD") >= "1998"), f"{root}/late/more")
    return read_csv_tree(spark, root)


@register("csv_by_name", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def q_csv_by_name(spark, d):
    root = scratch_dir(spark, "named")
    o = table(spark, d, "orders")
    write_csv(o.where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus", "o_orderpriority"), f"{root}/a")
    write_csv(o.where("o_orderkey % 3 = 1").select("o_orderkey", "o_orderstatus"), f"{root}/b/less")
    write_csv(o.where("o_orderkey % 3 = 2").select("o_orderpriority", "o_orderstatus", "o_orderkey"), f"{root}/c")
    return read_csv_by_name(spark, root).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@register("land_snapshot", RAW_SQL)
def q_land_snapshot(spark, d):
    root = scratch_dir(spark, "landing")
    folder = land_snapshot(W.houseprice_raw(spark, d), root, "2024-01-01-00-00-00")
    return read_csv(spark, folder, normalise=False)


@register("latest_snapshot", RAW_SQL)
def q_latest_snapshot(spark, d):
    root = scratch_dir(spark, "snapshots")
    raw = W.houseprice_raw(spark, d)
    old = land_snapshot(raw.where(F.col("TIME_PERIOD") < "1998"), root, "2023-01-01-00-00-00")
    land_snapshot(raw, root, "2024-01-01-00-00-00")
    if old.startswith("file:") or old.startswith("/"):
        local = old[5:] if old.startswith("file:") else old
        for f in os.listdir(local):
            os.utime(os.path.join(local, f), (1_000_000_000, 1_000_000_000))
    return read_latest_snapshot(spark, root)


@register("geojson_source", f"""SELECT CAST(p_partkey AS VARCHAR) AS ENTITY_CODE, p_name AS School_Name,
  p_type AS Campus_Name, {rect_wkt_sql()} AS wkt
FROM ({RECT_SQL}) r JOIN (SELECT p_partkey AS k, p_type FROM part) t ON r.p_partkey = t.k""")
def q_geojson_source(spark, d):
    r = parts_as_rectangles(spark, d).join(table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey")
    r = r.select(F.col("p_partkey").alias("ENTITY_CODE"), F.col("p_name").alias("School_Name"),
                 F.col("p_type").alias("Campus_Name"), "geometry")
    path = scratch_dir(spark, "geojson")
    write_geojson(r, path, ["ENTITY_CODE", "School_Name", "Campus_Name"])
    g = read_geojson(spark, path, ["ENTITY_CODE", "School_Name", "Campus_Name"])
    return g.select("ENTITY_CODE", "School_Name", "Campus_Name", to_wkt("geometry").alias("wkt"))


_KML_DESC_SQL = ("'<table><tr><th>Field</th><th>Value</th></tr><tr><td>Name</td><td>' || p_name || "
                 "'</td></tr><tr><td>Centre</td><td>' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || "
                 "'</td></tr></table>'")


@register("kml_source", f"""SELECT CAST(p_partkey AS VARCHAR) AS Name,
  {centre_code_sql(_KML_DESC_SQL)} AS centre_code, {rect_wkt_sql()} AS wkt FROM ({RECT_SQL}) r""")
def q_kml_source(spark, d):
    r = parts_as_rectangles(spark, d)
    desc = F.concat(F.lit("<table><tr><th>Field</th><th>Value</th></tr><tr><td>Name</td><td>"), F.col("p_name"),
                    F.lit("</td></tr><tr><td>Centre</td><td>"),
                    F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit("</td></tr></table>"))
    r = r.select("p_partkey", desc.alias("description"), "geometry")
    path = scratch_dir(spark, "kml")
    write_kml(r, path, "p_partkey", "description")
    k = read_kml(spark, path)
    return k.select("Name", centre_code("Description").alias("centre_code"), to_wkt("geometry").alias("wkt"))


@register("xlsx_source", """SELECT CAST(c_custkey AS VARCHAR) AS cust_key, c_name AS customer_name,
  CAST(c_acctbal AS VARCHAR) AS acct_bal, c_mktsegment AS mkt_segment FROM customer""")
def q_xlsx_source(spark, d):
    from stellate.sources.xlsx import read_xlsx, write_xlsx
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("Acct Bal"), F.col("c_mktsegment").alias("MKT Segment"))
    path = scratch_dir(spark, "xlsx")
    write_xlsx(c, path)
    return read_xlsx(spark, path)


def _cw_rect_wkt_sql() -> str:
    from stellate.plans.bind_geo import _pt
    pts = [_pt("x0", "y0"), _pt("x0", "y0 + h"), _pt("x0 + w", "y0 + h"), _pt("x0 + w", "y0"), _pt("x0", "y0")]
    return "'POLYGON ((' || " + " || ', ' || ".join(pts) + " || '))'"


@register("shapefile_source", f"""SELECT CAST(p_partkey AS VARCHAR) AS USE_ID, p_name AS NAME,
  {_cw_rect_wkt_sql()} AS wkt FROM ({RECT_SQL}) r""")
def q_shapefile_source(spark, d):
    from stellate.sources.shapefile import read_shapefile, write_shapefile
    r = parts_as_rectangles(spark, d).select(F.col("p_partkey").alias("USE_ID"), F.col("p_name").alias("NAME"),
                                             "geometry")
    path = scratch_dir(spark, "shp")
    write_shapefile(r, path)
    s = read_shapefile(spark, path)
    return s.select("USE_ID", "NAME", to_wkt("geometry").alias("wkt"))
