"""The snapshot stream bound to the benchmark tables: two snapshots of the
house-price extract are landed (an older partial one, then a full one); the
stream ingests both and the silver table must equal the full extract
cleaned."""

from __future__ import annotations

from pyspark.sql import functions as F

from stellate.plans import silver
from stellate.plans import world as W
from stellate.plans.registry import register
from stellate.session import scratch_dir
from stellate.sources.snapshots import land_snapshot
from stellate.streaming.snapshots import ingest_snapshots

RAW_COLUMNS = ["DATAFLOW", "LGA_2021", "TIME_PERIOD", "OBS_VALUE", "FREQ"]


@register("house_price_stream", W.HOUSEPRICE_SQL)
def q_house_price_stream(spark, d):
    root = scratch_dir(spark, "landing-stream")
    raw = W.houseprice_raw(spark, d)
    # an older partial extract whose values differ, then the full one
    land_snapshot(raw.where(F.col("TIME_PERIOD") < "1998").withColumn("OBS_VALUE", F.lit("1")),
                  root, "2023-06-30-00-00-00")
    land_snapshot(raw, root, "2024-06-30-00-00-00")
    out = scratch_dir(spark, "silver-houseprice")
    ingest_snapshots(spark, root, RAW_COLUMNS, silver.house_price, out, ["year"],
                     scratch_dir(spark, "stream-ckpt"))
    hp_schema = "local_government_code int, median_house_price int, year string"
    return spark.read.schema(hp_schema).parquet(out).select("local_government_code", "year", "median_house_price")
