"""GeoJSON and KML sources (Spark's own JSON and XML readers).

Both yield attribute columns plus ``geometry`` in the layout of
``operators.geometry.GEOM_TYPE`` (list of polygons -> rings -> [x, y]).

* GeoJSON: each file is one FeatureCollection (``multiLine``); features are
  exploded on the executors; Polygon and MultiPolygon are both accepted
  (coordinates are read as raw JSON text and parsed per geometry type).
* KML: the XML reader with ``rowTag=Placemark``; ``coordinates`` text
  (``x,y[,z] x,y[,z] ...``) is parsed with built-in string functions.

A malformed document, a geometry that is neither of the two kinds or a
coordinate that is no number fails the job: nothing is left out silently.

The ``write_*`` functions produce such files from a DataFrame (used to
build fixtures from tables): features are grouped into files by a hash
bucket, so every file holds a bounded number of features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from stellate.operators.geometry import GEOM_TYPE

# ---- fixed values -------------------------------------------------------------
GEOJSON_GLOB = "*.geojson*"
KML_GLOB = "*.kml"
KML_HEAD = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
KML_TAIL = "</Document></kml>"
# ----------------------------------------------------------------------------------

_FC_SCHEMA = StructType([
    StructField("type", StringType()),
    StructField("features", ArrayType(StructType([
        StructField("type", StringType()),
        StructField("properties", MapType(StringType(), StringType())),
        StructField("geometry", StructType([
            StructField("type", StringType()),
            StructField("coordinates", StringType()),
        ])),
    ]))),
])


def _geometry_from_json(gtype: Column, coords: Column) -> Column:
    strict = {"mode": "FAILFAST"}
    return (F.when(gtype == "Polygon", F.array(F.from_json(coords, "array<array<array<double>>>", strict)))
             .when(gtype == "MultiPolygon", F.from_json(coords, GEOM_TYPE, strict))
             .when(gtype.isNotNull(), F.raise_error(F.concat(F.lit("GeoJSON: unsupported geometry "), gtype))))


def read_geojson(spark: SparkSession, path: str, properties: list[str] | None = None,
                 glob: str = GEOJSON_GLOB) -> DataFrame:
    """One row per feature: the listed properties (text) and ``geometry``."""
    fc = (spark.read.schema(_FC_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
               .option("recursiveFileLookup", True)
               .option("pathGlobFilter", glob).json(path))
    f = fc.select(F.explode("features").alias("f"))
    geom = _geometry_from_json(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry")
    if properties is None:
        return f.select(F.col("f.properties").alias("properties"), geom)
    return f.select(*[F.col("f.properties").getItem(p).alias(p) for p in properties], geom)


def _write_documents(files: DataFrame, path: str, suffix: str) -> None:
    """Write one document per file (``b`` = file number, ``value`` = text).

    ``partitionBy`` puts every document in its own folder, hence its own
    file (a multi-line reader parses one document per file); the part files
    then get the extension the readers look for.
    """
    files.select("b", "value").write.mode("overwrite").partitionBy("b").text(path)
    spark = files.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    for d in fs.listStatus(root):
        if not d.isDirectory():
            continue
        for st in fs.listStatus(d.getPath()):
            name = st.getPath().getName()
            if name.startswith("part-"):
                fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(d.getPath(), name.rsplit(".", 1)[0] + suffix))


def _bucket(df: DataFrame, key: str, rows_per_file: int) -> Column:
    """File number for each row: about ``rows_per_file`` rows per file."""
    n_files = max(1, -(-df.count() // max(1, rows_per_file)))
    return F.pmod(F.xxhash64(key), F.lit(n_files))


def write_geojson(df: DataFrame, path: str, properties: list[str], geom: str = "geometry",
                  rows_per_file: int = 1000) -> None:
    """Write FeatureCollection files (MultiPolygon geometry when a row has several polygons)."""
    gtype = F.when(F.size(geom) == 1, F.lit("Polygon")).otherwise(F.lit("MultiPolygon"))
    coords = F.when(F.size(geom) == 1, F.to_json(F.get(F.col(geom), 0))).otherwise(F.to_json(F.col(geom)))
    props = F.to_json(F.struct(*[F.col(p).cast("string").alias(p) for p in properties]))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":{"type":"'),
                       gtype, F.lit('","coordinates":'), coords, F.lit("}}"))
    files = (df.select(_bucket(df, properties[0], rows_per_file).alias("b"), feature.alias("f"))
               .groupBy("b").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['),
                                          F.array_join(F.collect_list("f"), ","), F.lit("]}")).alias("value")))
    _write_documents(files, path, ".geojson")


# ---- KML ----------------------------------------------------------------------------

def _ring_from_text(text: Column) -> Column:
    def number(point: Column, i: int) -> Column:
        value = F.get(F.split(point, ","), i).try_cast("double")
        return F.coalesce(value, F.raise_error(F.concat(F.lit("KML: no coordinate pair: "), point)).cast("double"))

    pts = F.filter(F.split(F.trim(text), r"\s+"), lambda p: p != "")
    return F.transform(pts, lambda p: F.array(number(p, 0), number(p, 1)))


def _polygon_from_struct(poly: Column) -> Column:
    outer = _ring_from_text(poly["outerBoundaryIs"]["LinearRing"]["coordinates"])
    inner = F.transform(F.coalesce(poly["innerBoundaryIs"], F.array()),
                        lambda b: _ring_from_text(b["LinearRing"]["coordinates"]))
    return F.concat(F.array(outer), inner)


_RING = StructType([StructField("LinearRing", StructType([StructField("coordinates", StringType())]))])
_POLY = StructType([StructField("outerBoundaryIs", _RING), StructField("innerBoundaryIs", ArrayType(_RING))])
_PLACEMARK = StructType([
    StructField("name", StringType()),
    StructField("description", StringType()),
    StructField("Polygon", _POLY),
    StructField("MultiGeometry", StructType([StructField("Polygon", ArrayType(_POLY))])),
])


def read_kml(spark: SparkSession, path: str, glob: str = KML_GLOB) -> DataFrame:
    """One row per Placemark: ``Name``, ``Description`` (HTML text) and ``geometry``."""
    pm = (spark.read.format("xml").option("rowTag", "Placemark").option("mode", "FAILFAST").schema(_PLACEMARK)
               .option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path))
    geom = (F.when(F.col("Polygon").isNotNull(), F.array(_polygon_from_struct(F.col("Polygon"))))
             .when(F.col("MultiGeometry").isNotNull(),
                   F.transform(F.col("MultiGeometry.Polygon"), _polygon_from_struct))
             .otherwise(F.raise_error(F.concat(F.lit("KML: no polygon in Placemark "), F.coalesce("name", F.lit(""))))))
    return pm.select(F.col("name").alias("Name"), F.col("description").alias("Description"),
                     geom.alias("geometry"))


def _xml_escape(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _coords_text(ring: Column) -> Column:
    return F.array_join(F.transform(ring, lambda p: F.concat(F.get(p, 0).cast("string"), F.lit(","),
                                                             F.get(p, 1).cast("string"), F.lit(",0"))), " ")


def _kml_polygon(poly: Column) -> Column:
    outer = F.concat(F.lit("<outerBoundaryIs><LinearRing><coordinates>"), _coords_text(F.get(poly, 0)),
                     F.lit("</coordinates></LinearRing></outerBoundaryIs>"))
    inner = F.array_join(F.transform(F.slice(poly, F.lit(2), F.size(poly)), lambda r: F.concat(
        F.lit("<innerBoundaryIs><LinearRing><coordinates>"), _coords_text(r),
        F.lit("</coordinates></LinearRing></innerBoundaryIs>"))), "")
    return F.concat(F.lit("<Polygon>"), outer, inner, F.lit("</Polygon>"))


def write_kml(df: DataFrame, path: str, name: str, description: str, geom: str = "geometry",
              rows_per_file: int = 1000) -> None:
    """Write KML documents of Placemarks (description as CDATA)."""
    g = F.col(geom)
    shape = F.when(F.size(g) == 1, _kml_polygon(F.get(g, 0))).otherwise(
        F.concat(F.lit("<MultiGeometry>"), F.array_join(F.transform(g, _kml_polygon), ""),
                 F.lit("</MultiGeometry>")))
    pm = F.concat(F.lit("<Placemark><name>"), _xml_escape(F.col(name).cast("string")),
                  F.lit("</name><description><![CDATA["), F.col(description),
                  F.lit("]]></description>"), shape, F.lit("</Placemark>"))
    files = (df.select(_bucket(df, name, rows_per_file).alias("b"), pm.alias("p"))
               .groupBy("b").agg(F.concat(F.lit(KML_HEAD), F.array_join(F.collect_list("p"), ""),
                                          F.lit(KML_TAIL)).alias("value")))
    _write_documents(files, path, ".kml")
