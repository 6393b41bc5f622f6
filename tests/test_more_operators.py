"""Operators not covered by the oracle queries: nested summary, min-max, one-hot,
filter forms of the rules, infeasibility helpers, streaming inference."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_data_summary_nested(spark):
    from rateweave.operators import profile

    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 3.0)], "s string, x double")
    row = profile.data_summary(df).first()
    assert row["n_rows"] == 3 and row["n_columns"] == 2
    assert {m["column"]: m["missing_count"] for m in row["missing"]} == {"s": 1, "x": 1}
    assert {d["column"]: d["n_distinct"] for d in row["distinct"]} == {"s": 2}
    assert row["numeric"][0]["q50"] == pytest.approx(2.0)


def test_minmax_and_fit_on(spark):
    from rateweave.operators import features

    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    got = [r["x_minmax"] for r in features.minmax(df, "x").orderBy("x").collect()]
    assert got == pytest.approx([0.0, 0.5, 1.0], abs=1e-8)
    other = spark.createDataFrame([(20.0,)], "x double")
    assert features.minmax(other, "x", fit_on=df).first()["x_minmax"] == pytest.approx(2.0, abs=1e-8)


def test_one_hot_sorted_unseen_zero(spark):
    from rateweave.operators import encoders

    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    cats = encoders.fit_categories(train, "c")
    assert cats == ["a", "b"]
    table = encoders.category_table(train, "c")
    vec = {r["c"]: r["v"] for r in encoders.one_hot_vector(
        spark.createDataFrame([("a",), ("z",), (None,)], "c string"), "c", table, drop_input=False)
        .withColumnRenamed("c_onehot", "v").collect()}
    assert vec["a"].toArray().tolist() == [1.0, 0.0] and not vec["z"].toArray().any() and not vec[None].toArray().any()
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    rows = encoders.one_hot(test, "c", cats, drop_input=False).orderBy(F.col("c").asc_nulls_last()).collect()
    assert [(r["c_a"], r["c_b"]) for r in rows] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def _curve(spark):
    rows = [(1, 0, "Private room", "N1", 100.0, 70.0, 50.0, 1.0, 90.0),
            (1, 1, "Private room", "N1", 100.0, 110.0, 60.0, 1.0, 90.0),
            (2, 0, "Shared room", "N1", 40.0, 60.0, 10.0, 1.0, None),
            (3, 0, "Private room", None, 400.0, 500.0, 5.0, 1.0, 100.0)]
    return spark.createDataFrame(rows, "listing_id long, option_id int, room_type string, neighbourhood_group string, "
                                       "current_price double, candidate_price double, expected_revenue double, "
                                       "predicted_demand double, competitor_avg_price double")


def _ids(df):
    return sorted((r["listing_id"], r["option_id"]) for r in df.collect())


def test_rule_filter_forms(spark):
    from rateweave.operators import constraints as c

    cv = _curve(spark)
    assert _ids(c.limit_change(cv, 20.0)) == [(1, 1)]
    # area N1: current 40..100 -> [30, 125]; NULL area untouched
    assert _ids(c.area_band(cv, deviation_pct=25.0)) == [(1, 0), (1, 1), (2, 0), (3, 0)]
    # room band Private: [75, 500]; Shared: [30, 50]
    assert _ids(c.room_band(cv)) == [(1, 1), (3, 0)]
    assert _ids(c.competitor_cap(cv, 1.2)) == [(1, 0), (2, 0)]
    assert _ids(c.price_bounds(cv, 65.0, 200.0)) == [(1, 0), (1, 1)]
    assert _ids(c.competitor_cap(cv.drop("competitor_avg_price"))) == _ids(cv)


def test_infeasible_helpers(spark):
    from rateweave.operators import constraints as c
    from rateweave.operators import select

    cv = _curve(spark)
    allowed = c.price_bounds(cv, 65.0, 200.0)
    assert sorted(r[0] for r in select.infeasible_listings(cv, allowed).collect()) == [2, 3]
    flagged = c.price_bounds_ok(cv, 65.0, 200.0, out="feasible")
    sel = select.select_best_option(flagged, feasible="feasible")
    with pytest.raises(RuntimeError, match="No feasible"):
        select.require_feasible(sel)
    out = select.optimize_curve(allowed)
    r = out.filter("listing_id = 1").first()
    assert r["recommended_price"] == 110.0 and r["expected_revenue_change"] == -40.0
    assert r["reason"] == "Selected as best feasible option under optimization rules."


def test_streaming_inference_equals_batch(spark):
    import __spark_entry__ as entry

    s = entry.queries()["s01_stream_inference"](spark, SF_SMALL)
    b = entry.queries()["h1_inference"](spark, SF_SMALL)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_streaming_with_model(spark):
    import tempfile

    from rateweave.operators import clean, encoders, features, models
    from rateweave.plans import jobs
    from rateweave.sources.listings import load_listings
    from rateweave.streaming.inference_stream import start_inference_stream

    lst = load_listings(spark, SF_SMALL)
    train, _ = encoders.split(clean.drop_leakage(features.demand_score(lst)))
    m = models.fit_model(train, "linear", ["price", "number_of_reviews"], ["room_type"])
    root = tempfile.mkdtemp(prefix="rateweave-stream-", dir="/tmp")
    lst.repartition(3).write.parquet(f"{root}/in")
    q = start_inference_stream(spark, f"{root}/in", lst.schema, None, f"{root}/out", f"{root}/ck", max_files=1, model=m)
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/out").drop("batch_id")
    want = jobs.inference_job(lst, model=m)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_batches_of_a_stream_do_not_scan_the_reference(spark, tmp_path):
    from rateweave.operators import clean, features
    from rateweave.sources.listings import load_listings
    from rateweave.streaming.inference_stream import score_batch

    load_listings(spark, SF_SMALL).write.parquet(str(tmp_path / "reference"))
    reference = spark.read.parquet(str(tmp_path / "reference"))
    fit = features.demand_extremes(clean.prepare_inference_input(reference))
    batch = reference.limit(20)
    scored = score_batch(batch, fit)
    assert scored._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    whole = score_batch(batch, clean.prepare_inference_input(reference))
    assert scored.exceptAll(whole).count() == 0
