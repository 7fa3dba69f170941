"""Hand-made files and tables that must give the right rows or an error, never lost or swapped data."""

import io
import os
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from stellate.functions.html import table_cell
from stellate.operators.geometry import GEOM_TYPE, area, dissolve
from stellate.operators.reconcile import reconcile
from stellate.plans import job, serve
from stellate.session import scratch_dir
from stellate.sources.files import read_csv, read_csv_tree
from stellate.sources.geo_text import read_geojson, read_kml
from stellate.sources.shapefile import parse_shp, read_shapefile, write_shapefile
from stellate.sources.snapshots import read_latest_snapshot
from stellate.sources.xlsx import read_xlsx
from stellate.streaming.snapshots import ingest_snapshots


def _folder(spark, name, **files):
    path = scratch_dir(spark, name)
    local = path[5:] if path.startswith("file:") else path
    os.makedirs(local, exist_ok=True)
    for file, content in files.items():
        _put(local, file.replace("__", "."), content)
    return path, local


def _put(local, name, content):
    full = os.path.join(local, name)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


def test_csv_with_columns_in_another_order_fails(spark):
    path, _ = _folder(spark, "csv-order", one__csv="a,b\n1,2\n", two__csv="b,a\n3,4\n")
    for df in (read_csv(spark, path), read_csv_tree(spark, path), read_csv(spark, path, columns=["a", "b"])):
        with pytest.raises(Exception, match="CSV header"):
            df.collect()
    same, _ = _folder(spark, "csv-same", one__csv="a,b\n1,2\n", two__csv="a,b\n3,4\n")
    assert rows(read_csv(spark, same)) == [("1", "2"), ("3", "4")]
    assert read_csv(spark, same).count() == 2 and rows(read_csv(spark, same).select("b")) == [("2",), ("4",)]


def test_newest_file_of_a_flat_folder(spark):
    path, local = _folder(spark, "flat", old__csv="v\n1\n", new__csv="v\n2\n")
    os.utime(os.path.join(local, "old.csv"), (1_000_000_000, 1_000_000_000))
    assert rows(read_latest_snapshot(spark, path)) == [("2",)]


NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _workbook(sheet_rows):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{REL}"><sheets>'
                                      '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet xmlns="{NS}"><sheetData>{sheet_rows}</sheetData></worksheet>')
    return buf.getvalue()


def _text(ref, v):
    return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'


def test_xlsx_repeated_headers_and_text_cells(spark):
    head = '<row r="1">' + _text("A1", "Fee") + _text("B1", "Fee") + _text("C1", "Code") + "</row>"
    body = '<row r="2"><c r="A2"><v>10</v></c><c r="B2"><v>2.5</v></c>' + _text("C2", "0042") + "</row>"
    path, _ = _folder(spark, "xlsx-heads", book__xlsx=_workbook(head + body))
    df = read_xlsx(spark, path, sheet=0, infer=True)
    assert df.columns == ["fee", "fee.1", "code"]
    assert tuple(df.first()) == (10, 2.5, "0042")
    clash = '<row r="1">' + _text("A1", "Fee") + _text("B1", "fee") + "</row>"
    path, _ = _folder(spark, "xlsx-clash", book__xlsx=_workbook(clash))
    with pytest.raises(Exception, match="collide"):
        read_xlsx(spark, path, sheet=0)


def _shp(*shapes):
    """Records of (type, rings)."""
    out = bytes(100)
    for i, (kind, rings) in enumerate(shapes):
        pts = np.array([p for r in rings for p in r], float).reshape(-1, 2)
        starts = np.cumsum([0] + [len(r) for r in rings])[:-1]
        rec = (struct.pack("<i4d", kind, 0, 0, 0, 0) + struct.pack("<ii", len(rings), len(pts))
               + struct.pack(f"<{len(rings)}i", *starts) + pts.astype("<f8").tobytes())
        out += struct.pack(">ii", i + 1, len(rec) // 2) + rec
    return out


def _square(x, y, side, clockwise=True):
    ring = [[x, y], [x, y + side], [x + side, y + side], [x + side, y], [x, y]]
    return ring if clockwise else ring[::-1]


def test_shapefile_hole_goes_to_the_shell_around_it():
    one, two = _square(0, 0, 10), _square(20, 0, 10)
    hole, island = _square(2, 2, 4, clockwise=False), _square(3, 3, 1)
    got = parse_shp(_shp((5, [one, two, hole])))[0]
    assert [len(p) for p in got] == [2, 1] and got[0][1] == hole
    got = parse_shp(_shp((5, [hole, two, one, island])))[0]
    assert sorted(len(p) for p in got) == [1, 1, 2]
    assert parse_shp(_shp((5, [_square(0, 0, 1, clockwise=False)])))[0] == [[_square(0, 0, 1, clockwise=False)]]
    with pytest.raises(ValueError, match="no polygon"):
        parse_shp(_shp((3, [one])))


def test_shapefile_lone_part_case_and_widths(spark):
    df = spark.createDataFrame([("a", [[_square(0.0, 0.0, 1.0)]])], f"name string, geometry {GEOM_TYPE}").coalesce(1)
    path, local = _folder(spark, "shp")
    write_shapefile(df, path)
    base = next(f for f in os.listdir(local) if f.endswith(".shp"))[:-4]
    os.rename(f"{local}/{base}.shp", f"{local}/{base}.SHP")
    assert read_shapefile(spark, path).select("name").first()[0] == "a"
    os.rename(f"{local}/{base}.dbf", f"{local}/other.dbf")
    with pytest.raises(Exception, match="no .dbf beside"):
        read_shapefile(spark, path)
    for wide in (df.withColumn("name", F.repeat("name", 300)), df.withColumnRenamed("name", "long_column_a")):
        with pytest.raises(Exception, match="too long"):
            write_shapefile(wide, scratch_dir(spark, "shp-wide"))


FEATURE = '{"type":"Feature","properties":{"n":"a"},"geometry":{"type":"%s","coordinates":%s}}'


def test_geojson_and_kml_faults_raise(spark):
    whole = '{"type":"FeatureCollection","features":[%s]}'
    good = whole % (FEATURE % ("Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]"))
    path, _ = _folder(spark, "gj-good", a__geojson=good)
    assert read_geojson(spark, path, ["n"]).first()["geometry"] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]
    for name, text in (("cut", good[:-30]), ("kind", whole % (FEATURE % ("GeometryCollection", "[]")))):
        path, _ = _folder(spark, f"gj-{name}", a__geojson=text)
        with pytest.raises(Exception):
            read_geojson(spark, path, ["n"]).collect()
    kml = ("<kml><Document><Placemark><name>p</name><Polygon><outerBoundaryIs><LinearRing><coordinates>%s"
           "</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Document></kml>")
    path, _ = _folder(spark, "kml-good", a__kml=kml % " 0,0,0 1,0,0\n1,1,0 0,0,0 ")
    assert read_kml(spark, path).first()["geometry"] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]
    path, _ = _folder(spark, "kml-bad", a__kml=kml % "0,0,0 1,x,0 1,1,0 0,0,0")
    with pytest.raises(Exception, match="no coordinate pair"):
        read_kml(spark, path).collect()


def test_stream_completes_a_snapshot_and_never_goes_back(spark):
    path, local = _folder(spark, "landing")
    out, checkpoint = scratch_dir(spark, "silver"), scratch_dir(spark, "stream")

    def run():
        ingest_snapshots(spark, path, ["v", "p"], lambda df: df, out, ["p"], checkpoint)
        return rows(spark.read.parquet(out), "v")

    _put(local, "2024-01-01-00-00-00/one.csv", "v,p\na,1\n")
    assert run() == [("a",)]
    _put(local, "2024-01-01-00-00-00/two.csv", "v,p\nb,1\n")
    assert run() == [("a",), ("b",)]
    _put(local, "2023-01-01-00-00-00/late.csv", "v,p\nold,1\n")
    assert run() == [("a",), ("b",)]


def test_reconcile_with_a_side_of_keys_only(spark):
    left = spark.createDataFrame([("A", 1, 7)], "school_name string, postcode int, school_id int")
    keys = spark.createDataFrame([("A", 1), ("B", 2)], "school_name string, postcode int")
    assert rows(reconcile(left, keys, id_col=None), "school_name", "school_id") == [("A", 7)]
    extra = spark.createDataFrame([("A", 1, "x")], "school_name string, postcode int, extra string")
    assert rows(reconcile(keys, extra, id_col=None, order_by=()), "school_name", "extra") == [("A", "x"), ("B", None)]


def test_identical_shapes_of_one_key_merge_once(spark):
    df = spark.range(3000).select(F.lit("k").alias("key"), F.lit(1).alias("x"),
                                  F.expr("array(array(array(array(0d,0d),array(2d,0d),array(2d,2d),array(0d,0d))))").alias("geometry"))
    got = dissolve(df, "key").select("key", area("geometry").alias("a")).collect()
    assert [(r["key"], r["a"]) for r in got] == [("k", 2.0)]


def test_limited_lookup_is_ordered(spark):
    df = spark.createDataFrame([("n", 3), ("n", 1), ("n", 2)], "school_name string, v int").repartition(3)
    assert rows(serve.entity_lookup(spark, df, "n", limit=2), "v") == [(1,), (2,)]
    assert serve.entity_lookup(spark, df, "n", limit=0).count() == 0


def test_whole_overwrite_leaves_no_stale_partition(spark):
    path = scratch_dir(spark, "whole")
    df = spark.createDataFrame([(1, "NSW"), (2, "SA")], "v int, state string")
    job.write_partitioned(df, path, ["state"], whole=True)
    job.write_partitioned(df.where("state = 'NSW'"), path, ["state"], whole=True)
    assert rows(spark.read.parquet(path), "v") == [(1,)]


def test_html_references_and_tag_names(spark):
    page = ("<table><thead class=x><track><tr><th>h</th></tr></thead><tr><td>a</td><td>b</td></tr>"
            "<tr><td>c</td><td>%s</td></tr></table>")
    cells = {"x&#233;y &#xE9;&#128512;": "x\u00e9y \u00e9\U0001F600", "&amp;#233;": "&#233;",
             "&#9999999;&#55296;": "&#9999999;&#55296;", "plain": "plain", "": ""}
    df = spark.createDataFrame([(k, page % k) for k in cells], "k string, html string")
    got = {r["k"]: r["v"] for r in df.select("k", table_cell("html").alias("v")).collect()}
    assert got == cells
