import pytest
from pyspark.sql import functions as F

from conftest import rows
from stellate.functions import text as T
from stellate.functions.html import centre_code
from stellate.functions.schema import apply_mapping, normalise_headers
from stellate.plans.serve import json_rows


def test_safe_and_truncating_int(spark):
    vals = ["12", "12.5", " 12 ", "", "x", None, "99999999999", "-7", "0800"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = {r["s"]: (r["strict"], r["trunc"]) for r in
           df.select("s", T.safe_int("s").alias("strict"), T.truncating_int("s").alias("trunc")).collect()}
    assert out["12"] == (12, 12)
    assert out["12.5"] == (None, 12)
    assert out[" 12 "] == (12, 12)
    assert out[""] == (None, None)
    assert out["x"] == (None, None)
    assert out[None] == (None, None)
    assert out["99999999999"] == (None, None)
    assert out["-7"] == (-7, -7)
    assert out["0800"] == (800, 800)


def test_code_label_and_postcode(spark):
    df = spark.createDataFrame([("1: New South Wales",), ("NSW",), ("a:b:c",), (None,)], "s string")
    got = dict(df.select("s", T.code_label_part("s").alias("l")).collect())
    assert got == {"1: New South Wales": "New South Wales", "NSW": None, "a:b:c": "b", None: None}
    pc = spark.createDataFrame([("2000, NSW",), ("0800, NT",), ("12",)], "r string")
    assert rows(pc.select(T.postcode_prefix("r").alias("p"))) == [(12,), (800,), (2000,)]


def test_address_and_display(spark):
    df = spark.createDataFrame([("1 Main", None, "2000"), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(T.address("a", "b", F.lit("NSW"), "c")).collect()]
    assert got == ["1 Main,NSW,2000", "NSW"]
    d = spark.createDataFrame([("X", "Y", 2000), ("X", None, None)], "n string, s string, p int")
    assert sorted(r[0] for r in d.select(T.display_name("n", "s", "p")).collect()) == ["X - ", "X - Y 2000"]


def test_campus_functions(spark):
    df = spark.createDataFrame([('"St Mary - North - Upper',), ("A - B",), ("A-B",)], "n string")
    out = [r[0] for r in df.where(T.has_campus_suffix("n")).select(T.campus_base_name("n")).collect()]
    assert sorted(out) == ["A", "St Mary"]
    q = spark.createDataFrame([("Abc", " abc "), ("Abc", "North"), ("Abc", None)], "n string, c string")
    assert sorted(r[0] for r in q.select(T.campus_qualified_name("n", "c")).collect()) == ["Abc", "Abc", "Abc-North"]


@pytest.mark.parametrize("html,code", [
    ("<p>none</p>", ""),
    ("<table><tr><td>a</td></tr><tr><td>b</td></tr></table>", ""),          # one column
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td><b>0042</b></td></tr></table>", "42"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>0000</td></tr></table>", ""),
    ("<table><tr><th>h</th><th>i</th></tr><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>7&amp;8</td></tr>"
     "</table><table><tr><td>x</td></tr></table>", "7&8"),                 # header row, entity, 2 tables
    ("", ""),
])
def test_html_cell(spark, html, code):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(centre_code("h")).first()[0] == code


def test_html_cell_is_native(spark):
    df = spark.createDataFrame([("<table></table>",)], "h string").select(centre_code("h"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Mixed Case` int, `a.b` int, `x y` int")
    assert normalise_headers(df).columns == ["mixed_case", "a.b", "x_y"]
    with pytest.raises(ValueError):
        normalise_headers(spark.createDataFrame([(1, 2)], "`A B` int, `a b` int"))


def test_apply_mapping(spark):
    df = spark.createDataFrame([("2021", "7", "x")], "y string, p string, drop_me string")
    out = apply_mapping(df, [("p", "string", "postcode", "int"), ("y", "string", "year", "int")])
    assert out.columns == ["postcode", "year"] and tuple(out.first()) == (7, 2021)


def test_json_rows(spark):
    df = spark.createDataFrame([(1, None, "café"), (2, "", "x")], "a int, b string, c string")
    got = sorted(r[0] for r in json_rows(df).collect())
    assert got == ['{"a":"1","b":"None","c":"café"}', '{"a":"2","b":"","c":"x"}']


def test_run_timestamp_and_zeros(spark):
    import datetime as dt
    from stellate.sources.snapshots import run_timestamp
    assert run_timestamp(dt.datetime(2024, 3, 5, 7, 8, 9)) == "2024-03-05-07-08-09"
    df = spark.createDataFrame([("0042",), ("0000",), ("7",)], "s string")
    assert sorted(r[0] for r in df.select(T.strip_leading_zeros("s")).collect()) == ["", "42", "7"]
