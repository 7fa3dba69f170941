"""The jobs: the whole star build, and the two silver tables, from DataFrames or from files.

``run`` builds every star table once and publishes them together
(``sinks.publish``): a rerun replaces its year as a whole, a failed run changes
nothing that readers see.  Row counts are taken with ``DataFrame.observe`` on
the writes themselves: no extra ``count()`` jobs over the same lineage.  The
reconciled profile's ids come out of a written table, so the fact, dimensions,
bridges and gold table are all cut from the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stellate.operators.quality import normalise_key, require_columns
from stellate.plans import catchments, silver, star
from stellate.sinks.parquet import write_partitioned
from stellate.sinks.publish import Publication
from stellate.sources.files import read_csv
from stellate.sources.geo_text import read_geojson, read_kml
from stellate.sources.shapefile import read_shapefile
from stellate.sources.snapshots import read_latest_snapshot
from stellate.sources.xlsx import read_xlsx

TABLES = ["school", "profile", "naplan", "school_naplan", "fees", "school_fees", "location", "gold_school"]
#: Tables that are written per state, too.
PER_STATE = ["location", "gold_school"]


def this_year() -> int:
    return dt.datetime.now(dt.timezone.utc).year


def assert_columns(df: DataFrame, expected: list[str], name: str) -> DataFrame:
    """Fail fast when a table boundary does not have the expected columns."""
    if df.columns != expected:
        raise ValueError(f"{name}: columns {df.columns} != {expected}")
    return df


def run(sources: dict[str, DataFrame], catchment: DataFrame, out_root: str, year: int | None = None) -> dict[str, int]:
    """Build, write and publish every star table; return the observed row counts.

    ``sources``: profile, detail, scores, fees, location (raw frames);
    ``catchment``: one row per state and what its locations are reached by
    (``plans.catchments.attach``); ``year``: this year if not given.  Tables
    that feed later ones (location -> gold -> profile) are read back from
    their written files, so their lineage is computed once.
    """
    spark = sources["profile"].sparkSession
    out = Publication(spark, out_root, this_year() if year is None else year)
    counts: dict[str, int] = {}

    def write(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
        assert_columns(df, columns, name)
        obs = Observation(f"rows_{name}")
        written = out.write(name, df.observe(obs, F.count(F.lit(1)).alias("rows")), ["state"] if name in PER_STATE else None)
        counts[name] = int(obs.get["rows"])
        return written

    t1 = star.profile_reconciled(star.prepare_profile(sources["profile"]), sources["detail"])
    write("school", star.school_fact(t1), star.FACT_COLUMNS)
    ids = star.school_ids(t1)
    for source, dim_name, bridge_name, m in (("scores", "naplan", "school_naplan", star.SCORES),
                                             ("fees", "fees", "school_fees", star.FEES)):
        dim, bridge = star.dimension_and_bridge(ids, sources[source], m)
        write(dim_name, dim, [m.id, *[c for c in dim.columns if c != m.id]])
        write(bridge_name, bridge, ["school_id", m.id, *m.bridge])
    loc = star.location_base(sources["location"], t1)
    ldim = write("location", star.location_dim(loc, catchment), [*star.LOCATION_DIM_COLUMNS, "state"])
    gold = star.gold_school(t1, ldim)
    published = star.published(gold)
    write("gold_school", published, require_columns(published, star.LIST_COLUMNS, "gold").columns)
    profile = star.profile_dim(t1, gold)
    write("profile", profile, ["profile_id", *[c for c in profile.columns if c != "profile_id"]])
    out.commit()
    return counts


# ---- from files ------------------------------------------------------------------------------

def _typed(df: DataFrame, *keys: str) -> DataFrame:
    for key in keys:
        df = normalise_key(df, key)
    return df


def read_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """profile and location from workbooks (second sheet), detail, scores and fees from CSV; keys typed alike."""
    books = {n: _typed(read_xlsx(spark, paths[n], infer=True), "acara_sml_id", "postcode") for n in ("profile", "location")}
    texts = {n: _typed(read_csv(spark, paths[n]), "postcode") for n in ("detail", "scores", "fees")}
    detail = require_columns(texts["detail"], [*star.KEYS, "gender", "religion"], "detail")
    return {**books, **texts, "detail": detail.select(*star.KEYS, "gender", "religion")}


def read_catchments(spark: SparkSession, zones: dict[str, list[str]], lists: dict[str, str]) -> DataFrame:
    """The four states' zone feeds (shapefiles, KML, GeoJSON) and lists (CSV, a workbook) as one catchment table."""
    vic = catchments.ZONE_COLUMNS["VIC"]
    readers = {"NSW": read_shapefile, "QLD": read_kml, "SA": read_shapefile,
               "VIC": lambda s, path: read_geojson(s, path, list(vic.values()))}
    feeds = {state: [readers[state](spark, p) for p in paths] for state, paths in zones.items()}
    found = {state: read_xlsx(spark, path, sheet=0, header_row=2) if state == "SA" else read_csv(spark, path)
             for state, path in lists.items()}
    return catchments.attach(catchments.state_zones(feeds), found, smallest=True)


def run_files(spark: SparkSession, paths: dict, out_root: str, year: int | None = None) -> dict[str, int]:
    """``run`` on files: ``paths`` names the sources, and under ``zones`` and ``lists`` what each state publishes."""
    return run(read_sources(spark, paths), read_catchments(spark, paths["zones"], paths["lists"]), out_root, year)


# ---- silver tables ------------------------------------------------------------------------------

def house_price_job(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """The newest landed extract as the house-price table, partitioned by year; returns what was written."""
    table = silver.house_price(read_latest_snapshot(spark, landing))
    write_partitioned(table, out, ["year"])
    return spark.read.schema(table.schema).parquet(out).select(*table.columns)


def suburb_info_job(spark: SparkSession, income: str, demographic: str, rent: str, out: str) -> DataFrame:
    """The three census extracts as the suburb table; returns what was written."""
    table = silver.suburb_info(*(read_csv(spark, p, normalise=False) for p in (income, demographic, rent)))
    write_partitioned(table, out, ["year"])
    return spark.read.schema(table.schema).parquet(out).select(*table.columns)
