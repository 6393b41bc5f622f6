"""Hand-computed edge rows (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from rateweave.functions.exprs import availability_bucket, parse_money
from rateweave.operators import clean, constraints, curves, encoders, report, select


def _pred(spark, rows):
    df = spark.createDataFrame(rows, "listing_id string, current_price double, predicted_demand_before double")
    return df.withColumn("predicted_revenue_before", F.col("current_price") * F.col("predicted_demand_before"))


def _best(spark, rows, **kw):
    out = report.recommend(select.best_price_elastic(_pred(spark, rows), **kw))
    return {r["listing_id"]: r for r in out.collect()}


def test_elastic_ordinary_and_inelastic(spark):
    r = _best(spark, [("a", 100.0, 5.0)])["a"]
    assert r["optimized_price"] == 70.0
    assert math.isclose(r["predicted_demand_after"], 5 * 0.7 ** -1.2, rel_tol=1e-12)
    assert r["recommendation"] == "decrease"
    r = _best(spark, [("a", 100.0, 5.0)], elasticity=-0.5)["a"]
    assert r["optimized_price"] == 130.0 and r["recommendation"] == "increase"


def test_elasticity_column(spark):
    df = _pred(spark, [("a", 100.0, 5.0), ("b", 100.0, 5.0)]).withColumn(
        "e", F.when(F.col("listing_id") == "a", -1.2).otherwise(-0.5))
    got = {r["listing_id"]: r["optimized_price"] for r in select.best_price_elastic(df, elasticity="e").collect()}
    assert got == {"a": 70.0, "b": 130.0}


def test_zero_price_zero_and_negative_demand(spark):
    got = _best(spark, [("zp", 0.0, 5.0), ("zd", 100.0, 0.0), ("neg", 100.0, -1.0)])
    assert got["zp"]["optimized_price"] == 0.0 and got["zp"]["expected_improvement"] == 0.0
    assert got["zp"]["recommendation"] == "keep"
    assert got["zd"]["optimized_price"] == 100.0 and got["zd"]["recommendation"] == "keep"
    neg = got["neg"]
    assert neg["optimized_price"] == 70.0 and neg["predicted_demand_after"] == 0.0
    assert neg["predicted_revenue_after"] == 0.0 and neg["expected_improvement"] == 100.0


def test_keep_band(spark):
    df = spark.createDataFrame([("k", 100.0, 102.0), ("i", 100.0, 102.01), ("z", 0.0, 5.0)],
                               "listing_id string, current_price double, optimized_price double")
    got = {r["listing_id"]: r["recommendation"] for r in report.recommend(df).collect()}
    assert got == {"k": "keep", "i": "increase", "z": "keep"}


def test_reason_text_two_decimals(spark):
    df = spark.createDataFrame(
        [("a", "increase", 1234.5678, 1.0, 2.0, 10.0, 20.0)],
        "listing_id string, recommendation string, expected_improvement double, predicted_demand_before double, "
        "predicted_demand_after double, predicted_revenue_before double, predicted_revenue_after double")
    txt = report.report_reason(df).first()["reason"]
    assert txt == "Increase price because expected revenue improves by 1234.57 while demand remains acceptable."


def test_grid_floor_and_mid(spark):
    df = spark.createDataFrame([(1.0,), (100.0,)], "p double")
    rows = df.select("p", curves.price_grid("p", 15, 0.8, 1.2).alias("g")).collect()
    g = {r["p"]: r["g"] for r in rows}
    assert g[1.0][0] == 1.0 and g[1.0][-1] == 2.0 and len(g[1.0]) == 15
    assert g[100.0][7] == 100.0 and g[100.0][0] == 80.0 and g[100.0][-1] == 120.0


def test_money_parse(spark):
    df = spark.createDataFrame([("$1,234",), ("$50 ",), ("abc",)], "s string")
    assert [r[0] for r in df.select(parse_money("s")).collect()] == [1234.0, 50.0, None]
    with pytest.raises(Exception):
        df.select(parse_money("s", strict=True)).collect()


def test_availability_bucket(spark):
    df = spark.createDataFrame([(120.0,), (121.0,), (240.0,), (241.0,), (None,)], "availability_365 double")
    assert [r[0] for r in df.select(availability_bucket()).collect()] == ["low", "medium", "medium", "high", "high"]


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "x string")
    assert sorted(r[0] for r in clean.impute_mode(df, ["x"]).collect()) == ["a", "a", "a", "b", "b", "c"]


def test_frequency_encoding(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    f = encoders.fit_frequency(train, "c")
    tr = sorted(((r["c"], r["c_freq"]) for r in encoders.apply_frequency(train, f, "c", unseen_zero=False).collect()),
                key=str)
    assert tr[0] == ("a", pytest.approx(2 / 3)) and tr[2] == ("b", pytest.approx(1 / 3)) and tr[3] == (None, None)
    te = {r["c"]: r["c_freq"] for r in encoders.apply_frequency(test, f, "c").collect()}
    assert te["a"] == pytest.approx(2 / 3) and te["z"] == 0.0 and te[None] == 0.0


def _curve(spark, rows):
    return spark.createDataFrame(
        rows, "listing_id long, option_id int, room_type string, current_price double, candidate_price double, "
              "expected_revenue double, predicted_demand double")


def test_room_hierarchy(spark):
    c = _curve(spark, [(1, 0, "Private room", 100.0, 100.0, 1.0, 1.0),
                       (2, 0, "Shared room", 90.0, 120.0, 1.0, 1.0),
                       (2, 1, "Shared room", 90.0, 95.0, 1.0, 1.0),
                       (3, 0, "Hotel room", 500.0, 900.0, 1.0, 1.0)])
    kept = {(r["listing_id"], r["option_id"]) for r in constraints.room_hierarchy(c).collect()}
    assert kept == {(1, 0), (2, 1), (3, 0)}


def test_revenue_tie_lowest_option_and_infeasible(spark):
    c = _curve(spark, [(1, 0, "x", 10.0, 9.0, 5.0, 1.0), (1, 1, "x", 10.0, 11.0, 5.0, 1.0),
                       (2, 0, "x", 10.0, 30.0, 9.0, 1.0)])
    c = constraints.limit_change_ok(c, 20.0, out="feasible")
    sel = {r["listing_id"]: r for r in select.select_best_option(c, feasible="feasible").collect()}
    assert sel[1]["option_id"] == 0 and sel[1]["feasible"]
    assert not sel[2]["feasible"] and sel[2]["option_id"] is None


def test_odd_numbers_and_half_cents(spark):
    from rateweave.functions.exprs import fmt2

    odd = spark.createDataFrame([(x,) for x in ("5d", "$7f", "Infinity", "NaN", "1e3", " -2.5 ", "", None, "1,2")], "s string")
    assert [r[0] for r in odd.select(parse_money("s")).collect()] == [None, None, None, None, 1000.0, -2.5, None, None, 12.0]
    xs = [0.125, 2.675, 1.005, 0.375, -0.125, 0.0, 1e15, 12345.675, -2.5, 0.005, 1234567.895, 99.995]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(fmt2("x")).collect()]
    assert got == [f"{x:.2f}" for x in xs]


def test_median_of_integers_and_null_price(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "listing_id long, n int")
    assert [r["n"] for r in clean.impute_median(df, ["n"]).orderBy("listing_id").collect()] == [2.0, 3.0, 2.5]
    none = spark.createDataFrame([(None,)], "p double")
    assert none.select(curves.price_grid("p", 15, 0.8, 1.2).alias("g")).first()["g"] is None


def test_quantiles_with_infinity_end(spark):
    from rateweave.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(float("inf"),), (float("-inf"),)], "x double")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "x", [0.5, 1.0], gather_limit=5).collect()}
    assert got == {0.5: 9.5, 1.0: 19.0}


def test_too_deep_trees_are_refused():
    from rateweave.operators.models import tree_depth

    assert tree_depth(None) == 30 and tree_depth(12) == 12
    with pytest.raises(ValueError, match="deeper"):
        tree_depth(31)
