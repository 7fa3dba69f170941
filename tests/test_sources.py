import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stellate.operators.geometry import GEOM_TYPE, area
from stellate.session import scratch_dir
from stellate.sinks.parquet import write_partitioned
from stellate.sources.files import read_csv, write_csv
from stellate.sources.geo_text import read_geojson, read_kml, write_geojson, write_kml
from stellate.sources.shapefile import read_shapefile, write_shapefile
from stellate.sources.snapshots import land_snapshot, latest_csv_file, read_latest_snapshot
from stellate.sources.xlsx import read_xlsx, workbook_bytes


def _local(p):
    return p[5:] if p.startswith("file:") else p


def test_latest_snapshot_rules(spark):
    root = scratch_dir(spark, "snap")
    a = land_snapshot(spark.createDataFrame([("old",)], "v string"), root, "2024-01-01-00-00-00")
    b = land_snapshot(spark.createDataFrame([("new",)], "v string"), root, "2024-02-01-00-00-00")
    for folder, t in ((a, 1_000_000_000), (b, 1_000_000_000)):          # equal mtimes
        for f in os.listdir(_local(folder)):
            os.utime(os.path.join(_local(folder), f), (t, t))
    # tie -> larger path wins (b sorts after a)
    assert [r["v"] for r in read_latest_snapshot(spark, root).collect()] == ["new"]
    # a newer file that is not .csv is ignored; a newer .csv in a nested folder wins
    with open(os.path.join(_local(root), "notes.txt"), "w") as f:
        f.write("x")
    nested = land_snapshot(spark.createDataFrame([("nested",)], "v string"), root + "/deep", "2023-01-01-00-00-00")
    assert latest_csv_file(spark, root).startswith(nested.replace("file:", "file:").rstrip("/")) or \
        "deep" in latest_csv_file(spark, root)
    empty = scratch_dir(spark, "empty")
    os.makedirs(_local(empty), exist_ok=True)
    with pytest.raises(Exception):
        latest_csv_file(spark, empty)


def test_partitioned_write_rerun_and_null_partition(spark):
    path = scratch_dir(spark, "part")
    df = spark.createDataFrame([(1, "NSW"), (2, None), (3, "WA")], "v int, state string")
    write_partitioned(df, path, ["state"])
    write_partitioned(df.where(F.col("state") == "NSW"), path, ["state"])   # rerun of one partition
    got = rows(spark.read.parquet(path), "v", "state")
    assert got == [(1, "NSW"), (2, None), (3, "WA")]


def test_csv_headers(spark):
    path = scratch_dir(spark, "csv")
    write_csv(spark.createDataFrame([(1, "a")], "`Mixed Case` int, `x.y` string"), path)
    df = read_csv(spark, path)
    assert df.columns == ["mixed_case", "x.y"] and tuple(df.first()) == ("1", "a")


def test_xlsx_sheet_and_header_row(spark):
    path = scratch_dir(spark, "xlsx")
    os.makedirs(_local(path), exist_ok=True)
    wb = workbook_bytes([("Sites", [["title"], [], ["Org Unit No", "Full Name"], [101, "A & B"], [None, None],
                                    [102, "C"]]), ("Other", [["z"]])])
    with open(os.path.join(_local(path), "sites.xlsx"), "wb") as f:
        f.write(wb)
    df = read_xlsx(spark, path, sheet=0, header_row=2)
    assert df.columns == ["org_unit_no", "full_name"]
    assert rows(df) == [("101", "A & B"), ("102", "C")]


def test_geo_formats_round_trip(spark):
    hole = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]],
            [[1.0, 1.0], [1.0, 3.0], [3.0, 3.0], [3.0, 1.0], [1.0, 1.0]]]
    multi = [[[[10.0, 0.0], [11.0, 0.0], [11.0, 1.0], [10.0, 0.0]]], [[[20.0, 0.0], [21.0, 0.0], [21.0, 1.0], [20.0, 0.0]]]]
    df = spark.createDataFrame([("1", "<b>x</b>", [hole]), ("2", "y", multi)], f"id string, d string, g {GEOM_TYPE}")
    want = [("1", 12.0), ("2", 1.0)]
    p1 = scratch_dir(spark, "gj")
    write_geojson(df, p1, ["id"], "g")
    assert rows(read_geojson(spark, p1, ["id"]).select("id", F.round(area("geometry"), 6))) == want
    p2 = scratch_dir(spark, "kml")
    write_kml(df, p2, "id", "d", "g")
    k = read_kml(spark, p2)
    assert rows(k.select("Name", F.round(area("geometry"), 6))) == want
    assert sorted(r["Description"] for r in k.collect()) == ["<b>x</b>", "y"]
    p3 = scratch_dir(spark, "shp")
    write_shapefile(df.select(F.col("id").alias("ID"), "g"), p3, "g")
    assert rows(read_shapefile(spark, p3).select("ID", F.round(area("geometry"), 6))) == want


def test_snapshot_stream_is_incremental(spark):
    from stellate.streaming.snapshots import ingest_snapshots
    root, out, ckpt = scratch_dir(spark, "ls"), scratch_dir(spark, "silver"), scratch_dir(spark, "ck")
    ident = lambda df: df                                            # noqa: E731
    land_snapshot(spark.createDataFrame([("2020", "a"), ("2021", "b")], "year string, v string"),
                  root, "2024-01-01-00-00-00")
    ingest_snapshots(spark, root, ["year", "v"], ident, out, ["year"], ckpt)
    assert rows(spark.read.parquet(out), "year", "v") == [(2020, "a"), (2021, "b")]
    # a newer snapshot replaces the partitions it carries; the old file is not re-read
    land_snapshot(spark.createDataFrame([("2021", "c")], "year string, v string"), root, "2024-02-01-00-00-00")
    q = ingest_snapshots(spark, root, ["year", "v"], ident, out, ["year"], ckpt)
    assert rows(spark.read.parquet(out), "year", "v") == [(2020, "a"), (2021, "c")]
    assert q.lastProgress["numInputRows"] == 1


def test_xlsx_type_inference(spark):
    path = scratch_dir(spark, "xlsx-types")
    os.makedirs(_local(path), exist_ok=True)
    wb = workbook_bytes([("Notes", [["x"]]), ("Data", [["Postcode", "Share", "Name"], [2000, 12.5, "A"],
                                                       [None, 7, "B"], [800, 3, "C"]])])
    with open(os.path.join(_local(path), "p.xlsx"), "wb") as f:
        f.write(wb)
    df = read_xlsx(spark, path, infer=True)
    assert dict(df.dtypes) == {"postcode": "bigint", "share": "double", "name": "string"}
    assert rows(df) == [(None, 7.0, "B"), (800, 3.0, "C"), (2000, 12.5, "A")]


def test_shapefile_typed_attributes(spark):
    path = scratch_dir(spark, "shp-typed")
    sq = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]]
    df = spark.createDataFrame([(101, "A", sq), (None, "B", sq)], f"USE_ID bigint, NAME string, g {GEOM_TYPE}")
    write_shapefile(df, path, "g")
    t = read_shapefile(spark, path, typed=True)
    assert dict(t.dtypes)["USE_ID"] == "bigint" and dict(t.dtypes)["NAME"] == "string"
    assert rows(t.select("USE_ID", "NAME")) == [(None, "B"), (101, "A")]
    assert dict(read_shapefile(spark, path).dtypes)["USE_ID"] == "string"


def test_csv_encoding(spark):
    path = scratch_dir(spark, "latin1")
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), "a.csv"), "wb") as f:
        f.write("School Name,Postcode\nSt André,2000\n".encode("latin-1"))
    df = read_csv(spark, path, encoding="ISO-8859-1")
    assert [tuple(r) for r in df.collect()] == [("St André", "2000")]
