"""The end-to-end star build: layout, idempotent reruns, failures in the middle, and the same from files."""

import pytest
from pyspark.sql import functions as F

from stellate.operators.joins import left_join_smallest
from stellate.plans import bind_catchment as C
from stellate.plans import job, star
from stellate.plans import world as W
from stellate.plans.job import TABLES, run
from stellate.session import scratch_dir
from stellate.sinks.publish import Publication, drop_old_versions, read_published

SF = "/root/testdata/sf0.001"


def as_text(df):
    """The columns of a CSV source: all text but the postcode."""
    return df.select(*[F.col(c) if c == "postcode" else F.col(c).cast("string") for c in df.columns])


def sources(spark):
    return {"profile": W.profile_raw(spark, SF), "detail": as_text(W.detail_raw(spark, SF)),
            "scores": as_text(W.scores_raw(spark, SF)), "fees": as_text(W.fees_raw(spark, SF)), "location": W.location_raw(spark, SF)}


@pytest.fixture(scope="module")
def cats(spark):
    return C.state_catchments(spark, SF, smallest=True)


@pytest.fixture(scope="module")
def built(spark, cats):
    """(root, counts, rows by table) of a build of 2024."""
    root = scratch_dir(spark, "job")
    counts = run(sources(spark), cats, root, 2024)
    return root, counts, {t: read_published(spark, root, t, 2024).drop("year") for t in TABLES}


def number(value):
    try:
        return float(value) is not None
    except ValueError:
        return False


def text_rows(df):
    """Rows as text, columns by name; numbers by value."""
    cols = sorted(df.columns)
    return sorted(str(tuple(None if r[c] is None else f"{float(r[c]):.12g}" if number(r[c]) else r[c] for c in cols))
                  for r in df.collect())


def test_star_build_rerun_and_failure(spark, cats, built, monkeypatch):
    root, first, _ = built
    assert set(first) == set(TABLES)
    before = {t: text_rows(read_published(spark, root, t, 2024)) for t in TABLES}
    assert {t: len(rows) for t, rows in before.items()} == first
    states = {r.state for r in read_published(spark, root, "gold_school").select("state").distinct().collect()}
    assert "WA" not in states and states            # no gold partition for WA

    def fails(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(star, "profile_dim", fails)
    fewer = {**sources(spark), "fees": W.fees_raw(spark, SF).limit(0)}
    with pytest.raises(RuntimeError, match="lost"):
        run(fewer, cats, root, 2024)                 # seven tables are written by then
    assert {t: text_rows(read_published(spark, root, t, 2024)) for t in TABLES} == before
    monkeypatch.undo()
    again = run(fewer, cats, root, 2024)             # the same year again: replaced as a whole
    assert again["fees"] == 0 and {t: read_published(spark, root, t, 2024).count() for t in TABLES} == again
    other = scratch_dir(spark, "versions")
    for k in range(3):
        out = Publication(spark, other, 2024)
        out.write("t", spark.range(k))
        assert out.commit() == k + 1
    assert len(drop_old_versions(spark, other, 2024, keep=1)) == 2 and read_published(spark, other, "t").count() == 2
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "school", 1999)


def test_files_give_the_same_tables(spark, built, tmp_path):
    """Every source written in its own format and read back: workbooks, CSV, shapefiles, KML, GeoJSON."""
    from stellate.sinks.publish import read_published as read
    from stellate.sources.files import write_csv
    from stellate.sources.geo_text import write_geojson, write_kml
    from stellate.sources.shapefile import write_shapefile
    from stellate.sources.xlsx import write_xlsx
    src, root = sources(spark), str(tmp_path)
    paths = {n: f"{root}/{n}" for n in src}
    for n in ("profile", "location"):
        write_xlsx(src[n], paths[n])
    for n in ("detail", "scores", "fees"):
        write_csv(src[n], paths[n])
    zones, lists = {}, {}
    for state, feeds in C.zone_feeds(spark, SF).items():
        zones[state] = [f"{root}/{state}-{k}" for k in range(len(feeds))]
        for f, path in zip(feeds, zones[state]):
            f = f.dropDuplicates(f.columns[:1] + ["geometry"])
            if state in ("NSW", "SA"):
                write_shapefile(f, path)
            elif state == "QLD":
                write_kml(f, path, "Name", "Description")
            else:
                write_geojson(f, path, ["ENTITY_CODE", "School_Name"])
    for state, found in C.state_lists(spark, SF).items():
        lists[state] = f"{root}/{state}-list"
        if state == "SA":
            write_xlsx(found, lists[state], header_row=2, sheet=0)
        else:
            write_csv(found, lists[state])
    out = f"{root}/out"
    before = built[2]                                           # frames of the first version's files
    counts = job.run_files(spark, {**paths, "zones": zones, "lists": lists}, out)
    assert counts == built[1]
    for t in TABLES:
        if t != "location" and t != "gold_school":
            assert text_rows(read(spark, out, t).drop("year")) == text_rows(before[t]), t
    geo = ["location_id", "address", "phone", "fax", "state"]
    assert text_rows(read(spark, out, "location").select(*geo)) == text_rows(before["location"].select(*geo))
    assert read(spark, out, "school").select("year").distinct().collect()[0].year == job.this_year()


def test_absent_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="campus_type"):
        star.prepare_profile(W.profile_raw(spark, SF).drop("campus_type"))
    with pytest.raises(ValueError, match="location"):
        star.location_base(W.location_raw(spark, SF).drop("latitude"), spark.range(1))


def test_a_repeated_name_never_fans_out(spark):
    """3,000 zones and 3,000 details of one name: one row, and the join reads one row of each side."""
    left = spark.range(3000).select(F.lit("x").alias("name"), F.col("id").alias("zone"))
    right = spark.range(3000).select(F.lit("x").alias("name"), (F.col("id") + 5).alias("detail"))
    out = left_join_smallest(left.union(spark.createDataFrame([("y", 7)], left.schema)), right, "name")
    assert sorted(map(tuple, out.collect())) == [("x", 0, 5), ("y", 7, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") and plan.count("Aggregate") == 2      # both below the join


def test_silver_jobs(spark, tmp_path):
    from stellate.plans import silver
    from stellate.sources.files import write_csv
    from stellate.sources.snapshots import land_snapshot
    d = str(tmp_path)
    land_snapshot(W.houseprice_raw(spark, SF), f"{d}/landing", "2024-01-01-00-00-00")
    got = job.house_price_job(spark, f"{d}/landing", f"{d}/price")
    assert text_rows(got) == text_rows(silver.house_price(W.houseprice_raw(spark, SF))) and got.count()
    raw = {n: getattr(W, f"{n}_raw")(spark, SF) for n in ("income", "demographic", "rent")}
    for n, df in raw.items():
        write_csv(df, f"{d}/{n}")
    got = job.suburb_info_job(spark, *(f"{d}/{n}" for n in raw), f"{d}/suburb")
    assert text_rows(got) == text_rows(silver.suburb_info(*raw.values())) and got.count()
