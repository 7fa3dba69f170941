"""Physical-plan properties: pushdown, pruning, partial aggregation, shuffle count."""

import contextlib
import io
import re

import __spark_entry__ as E
from stellate.operators import overlay
from stellate.operators.dedupe import dedupe
from stellate.operators.reconcile import reconcile

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_projection_reach_the_scan(spark):
    plan = _plan(E.queries()["eq_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in read and "ts" not in read


def test_dedupe_aggregates_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(dedupe(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "partial_min_by" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_reconcile_shuffle_budget(spark):
    left = spark.read.parquet(f"{SF}/part.parquet").selectExpr(
        "p_partkey AS school_id", "p_name AS school_name", "p_size AS postcode")
    right = spark.read.parquet(f"{SF}/part.parquet").selectExpr(
        "p_name || ' - ' || p_brand AS school_name", "p_size AS postcode", "p_type AS kind")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(reconcile(left, right, id_col=None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two aggregations (match, then re-key after the campus strip), no joins
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan and "CartesianProduct" not in plan
    assert plan.count("partial_min_by") >= 2


def test_reconciled_rows_travel_once(spark):
    """The input's rows are aggregated by their order, which holds them: only the second aggregation takes rows beside it."""
    left = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 1, None)], "school_id int, school_name string, postcode int, kind string")
    right = spark.createDataFrame([("a", 1, None, 2.0), ("a", 1, "q", 1.0), ("b", 1, "q", 1.0)],
                                  "school_name string, postcode int, gender string, other double")
    out = reconcile(left, right, id_col=None)
    assert _plan(out).count("partial_min_by") == 3
    assert [tuple(r) for r in out.collect()] == [("a", 1, 1, "x", "q", 1.0)]


def test_no_python_udf_in_cleaning_queries(spark):
    for key in ("html_table_cell", "polygon_wkt", "polygon_area", "campus_base_name", "safe_cast"):
        plan = _plan(E.queries()[key](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_edges_are_cut_without_functions_of_array_elements(spark):
    """Spark does not compile lambda functions; a cut runs for every pair of edges that share a cell."""
    edges = spark.createDataFrame([((1,), 0, 0, 4, 0, 1), ((1,), 2, 0, 6, 0, 1), ((1,), 3, -2, 3, 2, 1)],
                                  "k struct<key: int>, ax long, ay long, bx long, by long, f long")
    cut = overlay._cut(edges, overlay._grids(edges, overlay.PER_CELL))
    assert "lambda" not in _plan(cut)
    assert sorted((r.ax, r.ay, r.bx, r.by, r.f) for r in cut.collect()) == [
        (0, 0, 2, 0, 1), (2, 0, 3, 0, 2), (3, -2, 3, 0, 1), (3, 0, 3, 2, 1), (3, 0, 4, 0, 2), (4, 0, 6, 0, 1)]


def test_edges_are_cut_in_methods_that_java_compiles(spark):
    """Spark's generated methods stay below the 8,000 bytes of code up to which Java compiles one."""
    edges = spark.createDataFrame([((1,), 0, 0, 4, 4, 1), ((1,), 0, 4, 4, 0, 1)],
                                  "k struct<key: int>, ax long, ay long, bx long, by long, f long")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")                                   # the final plan, before it runs
    try:
        found = overlay._cuts(overlay._in_cells(edges, overlay._grids(edges, 4)))
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            found.explain("codegen")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", out.getvalue())]
        assert sizes and all(0 < x < 8000 for x in sizes)
        assert {(r.ax, r.ay, *r.point) for r in found.collect()} == {(0, 0, 2, 2), (0, 4, 2, 2)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
