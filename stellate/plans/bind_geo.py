"""Polygon operators bound to the benchmark tables.

Every part becomes an integer rectangle: x from its size, y from its price
in hundreds, width from its type name, height from its name.  Union area of
integer rectangles equals the number of distinct unit cells they cover,
which is what the oracle counts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.operators.geometry import area, dissolve, rectangle, split_duplicates, to_wkt
from stellate.plans.registry import register
from stellate.plans.tables import table

RECT_SQL = """SELECT p_partkey, p_brand, p_name, p_size, p_size AS x0,
  CAST(floor(p_retailprice / 100) AS BIGINT) AS y0, length(p_type) - 2 AS w, length(p_name) - 6 AS h
FROM part"""


def parts_as_rectangles(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", "p_brand", "p_name", "p_size",
                    rectangle(F.col("p_size"), F.floor(F.col("p_retailprice") / 100),
                              F.length("p_type") - 2, F.length("p_name") - 6).alias("geometry"))


def _pt(x: str, y: str) -> str:
    return f"CAST({x} AS VARCHAR) || ' ' || CAST({y} AS VARCHAR)"


def rect_wkt_sql(x0="x0", y0="y0", w="w", h="h") -> str:
    pts = [_pt(x0, y0), _pt(f"{x0} + {w}", y0), _pt(f"{x0} + {w}", f"{y0} + {h}"),
           _pt(x0, f"{y0} + {h}"), _pt(x0, y0)]
    return "'POLYGON ((' || " + " || ', ' || ".join(pts) + " || '))'"


@register("polygon_wkt", f"SELECT p_partkey, {rect_wkt_sql()} AS wkt FROM ({RECT_SQL}) r")
def q_polygon_wkt(spark, d):
    return parts_as_rectangles(spark, d).select("p_partkey", to_wkt("geometry").alias("wkt"))


@register("polygon_area", f"SELECT p_partkey, CAST(w * h AS DOUBLE) AS area FROM ({RECT_SQL}) r")
def q_polygon_area(spark, d):
    return parts_as_rectangles(spark, d).select("p_partkey", area("geometry").alias("area"))


@register("split_duplicates", """
SELECT p_partkey, p_name || '/' || CAST(p_size AS VARCHAR) AS zone_key,
       count(*) OVER (PARTITION BY p_name, p_size) >= 2 AS duplicated
FROM part""")
def q_split_duplicates(spark, d):
    r = parts_as_rectangles(spark, d).select(
        "p_partkey", F.concat_ws("/", "p_name", F.col("p_size").cast("string")).alias("zone_key"), "geometry")
    dup, single = split_duplicates(r, "zone_key")
    return (dup.select("p_partkey", "zone_key", F.lit(True).alias("duplicated"))
               .unionByName(single.select("p_partkey", "zone_key", F.lit(False).alias("duplicated"))))


@register("dissolve", f"""
WITH r AS ({RECT_SQL}),
xs AS (SELECT p_brand, unnest(range(x0, x0 + w)) AS x, y0, h FROM r),
cells AS (SELECT DISTINCT p_brand, x, unnest(range(y0, y0 + h)) AS y FROM xs),
first_part AS (SELECT p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY p_brand)
SELECT f.p_brand, f.p_partkey, CAST(count(*) AS DOUBLE) AS area
FROM cells c JOIN first_part f USING (p_brand) GROUP BY f.p_brand, f.p_partkey""")
def q_dissolve(spark, d):
    r = parts_as_rectangles(spark, d).select("p_brand", "p_partkey", "geometry")
    out = dissolve(r, "p_brand", "geometry", order_by=["p_partkey"])
    return out.select("p_brand", "p_partkey", F.round(area("geometry"), 6).alias("area"))


@register("dissolve_corners", f"""
WITH r AS ({RECT_SQL}),
xs AS (SELECT p_brand, unnest(range(x0, x0 + w)) AS x, y0, h FROM r),
cells AS (SELECT DISTINCT p_brand, x, unnest(range(y0, y0 + h)) AS y FROM xs),
touched AS (SELECT p_brand, x + dx AS x, y + dy AS y, CASE WHEN dx = dy THEN 1 ELSE 10 END AS place
            FROM cells, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(dx, dy))
SELECT p_brand, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y,
       CAST(CASE WHEN count(*) = 2 THEN 2 ELSE 1 END AS BIGINT) AS corners
FROM touched GROUP BY p_brand, x, y HAVING count(*) IN (1, 3) OR (count(*) = 2 AND sum(place) IN (2, 20))""")
def q_dissolve_corners(spark, d):
    """Every corner of every merged shape's rings; where rings touch in a point, one for each."""
    out = dissolve(parts_as_rectangles(spark, d).select("p_brand", "p_partkey", "geometry"), "p_brand", "geometry")
    rings = out.select("p_brand", F.explode(F.flatten("geometry")).alias("ring"))
    points = rings.select("p_brand", F.explode(F.slice("ring", 1, F.size("ring") - 1)).alias("p"))
    return points.groupBy("p_brand", F.get("p", 0).alias("x"), F.get("p", 1).alias("y")).agg(F.count("*").alias("corners"))
