from conftest import rows
from stellate.operators.joins import three_way_join
from stellate.operators.quality import drop_null_any, drop_null_subset, normalise_key, orphan_keys
from stellate.plans.silver import demographic, house_price


def test_null_drops(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "g", None), (3, "g", "y")], "id int, grade string, v string")
    assert [r["id"] for r in drop_null_subset(df, ["grade"]).collect()] == [2, 3]
    assert [r["id"] for r in drop_null_any(df).collect()] == [3]


def test_three_way_join_keys_only_on_postcode(spark):
    a = spark.createDataFrame([(2000, "2021", 5), (3000, "2021", 6), (None, "2021", 7)], "pa int, year string, x int")
    b = spark.createDataFrame([(2000, 1), (2000, 2), (3000, 3), (None, 9)], "pb int, y int")      # two years for 2000
    c = spark.createDataFrame([(2000, 10), (4000, 11)], "pc int, z int")                          # 3000 missing here
    out = rows(three_way_join(a, b, c, "pa", "pb", "pc"), "pa", "y", "z")
    assert out == [(2000, 1, 10), (2000, 2, 10)]       # fan-out kept, missing and null keys dropped


def test_silver_cleaners(spark):
    raw = spark.createDataFrame([("10", "2020", "473274.17", "x"), ("x", "2021", "", "y")],
                                "LGA_2021 string, TIME_PERIOD string, OBS_VALUE string, FREQ string")
    assert rows(house_price(raw)) == [(None, "2021", None), (10, "2020", 473274)]
    dem = spark.createDataFrame(
        [("D", "P", "3: Persons", "0800, NT", "POA", "7: Northern Territory", "2021", "12"),
         ("D", "P", "1: Males", "0800, NT", "POA", "7: Northern Territory", "2021", "5")],
        "DATAFLOW string, `PCHAR: Selected person characteristic` string, `SEXP: Sex` string, "
        "`REGION: Region` string, `REGION_TYPE: Region Type` string, `STATE: State` string, "
        "`TIME_PERIOD: Time Period` string, OBS_VALUE string")
    assert [tuple(r) for r in demographic(dem).collect()] == [(800, "Northern Territory", "2021", 12)]


def test_key_normalise_and_orphans(spark):
    from pyspark.sql import Observation
    obs = Observation("keys")
    df = spark.createDataFrame([(" 12 ",), ("x",), (None,), ("7",)], "k string")
    out = normalise_key(df, "k", "bigint", obs)
    assert sorted(r["k"] for r in out.collect() if r["k"] is not None) == [7, 12]
    assert obs.get["rejected"] == 1 and obs.get["rows"] == 4
    dim = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    bridge = spark.createDataFrame([(2,), (3,), (3,)], "id int")
    assert rows(orphan_keys(dim, bridge, "id")) == [(1, "dim_only"), (3, "bridge_only")]
