"""Packed rows and long curves give the same recommendations: repeated ids, column bounds, the
demand at the curve point nearest the current price."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateweave.operators import models, report, select
from rateweave.plans import jobs, options

LISTINGS = ("listing_id long, price double, room_type string, neighbourhood_group string, competitor_avg_price double, "
            "reviews_per_month double, number_of_reviews double, availability_365 double, lo double, hi double")
KEY = ["listing_id", "current_price", "recommended_price", "predicted_demand_before", "predicted_demand_after", "price_action", "reason"]


def listings(spark, seed=1, n=120):
    r = random.Random(seed)
    gap = lambda x: None if r.random() < .1 else x
    rows = [(r.randint(1, n // 2), gap(r.choice([0.0, 40.0, 80.0, round(r.uniform(5, 300), 2)])), gap(r.choice(["Entire home/apt", "Private room"])),
             gap(r.choice("AB")), gap(r.uniform(20, 200)), gap(r.random()), gap(float(r.randint(0, 9))), gap(float(r.randint(0, 365))),
             gap(r.uniform(1, 60)), gap(r.uniform(60, 300))) for _ in range(n)]
    rows += rows[:5] + [(None, 50.0, None, None, None, 0.5, 1.0, 100.0, None, None)] * 2
    return spark.createDataFrame(rows, LISTINGS)


def rows_of(df):
    return sorted((tuple(r[c] for c in KEY) for r in df.collect()), key=str)


RULES = [dict(), dict(change_pct=10.0, competitor_factor=1.2), dict(area_pct=25.0, room_band=True), dict(hierarchy=True),
         dict(bounds=("lo", "hi")), dict(bounds=(20.0, "hi")), dict(bounds=(None, 120.0)), dict(bounds=("lo", None), change_pct=20.0)]


@pytest.mark.parametrize("rules", RULES, ids=str)
def test_both_forms_agree_on_repeated_ids(spark, rules):
    lst = listings(spark)
    packed = options.with_options(lst, carry=options.bound_columns(rules.get("bounds")))
    long = options.explode_options(packed)
    got, want = options.recommend(packed, true_before=True, **rules), jobs.recommendation_job(long, true_before=True, **rules)
    assert rows_of(got) == rows_of(want)
    assert got.groupBy("listing_id").count().where("count > 1").isEmpty()
    infeasible = options.select_best(packed, **rules).where("not feasible and size(array(listing_id)) > 0")
    priced = {r[0] for r in long.select("listing_id").distinct().collect()}
    assert {r[0] for r in infeasible.select("listing_id").collect()} & priced == priced - {r.listing_id for r in got.collect()}


def test_two_rows_of_one_id_compete(spark):
    one = "1L as listing_id, {p}D as price, 'Private room' as room_type, 'A' as neighbourhood_group, CAST(null AS DOUBLE) as " \
          "competitor_avg_price, {r}D as reviews_per_month, 3D as number_of_reviews, 100D as availability_365"
    lst = spark.sql("SELECT " + one.format(p=50, r=1) + " UNION ALL SELECT " + one.format(p=100, r=9))
    rows = options.with_options(lst)
    got = options.recommend(rows).collect()
    assert len(got) == 1 and rows_of(options.recommend(rows)) == rows_of(jobs.recommendation_job(options.explode_options(rows)))
    assert len(options.recommend(rows, unique_ids=True).collect()) == 2          # as the caller said


def test_nearest_is_the_least_distance_then_option(spark):
    curve = spark.createDataFrame([(1, 0, 10.0, 8.0, 5.0), (1, 1, 10.0, 12.0, 3.0), (1, 2, 10.0, 30.0, 1.0), (2, 0, None, 8.0, 5.0),
                                   (3, 4, 10.0, 10.0, None), (3, 5, 10.0, 11.0, 2.0)],
                                  "listing_id long, option_id int, current_price double, candidate_price double, predicted_demand double")
    got = {r[0]: r[1] for r in select.nearest_demand(curve, "now").collect()}
    assert got == {1: 5.0, 2: None, 3: None}


def test_run_recommendation_is_the_same_on_every_path(spark, tmp_path):
    from rateweave.operators import features

    lst = listings(spark, 2).where("listing_id is not null and price > 0")
    rules = dict(bounds=("lo", "hi"), change_pct=20.0)
    got = {}
    for name, more in (("neither", {}), ("budget", {"max_avg_pct": 1000.0})):
        jobs.run_recommendation(spark, lst, str(tmp_path / name), true_before=True, **more, **rules)
        sel = spark.read.parquet(str(tmp_path / name / "selection"))
        got[name] = sorted((r.listing_id, r.recommended_price, r[report.NEAREST]) for r in sel.collect())
    assert got["neither"] and got["neither"] == got["budget"]
    train = features.demand_score(lst)
    model = models.fit_model(train, "linear", ["price", "number_of_reviews"], ["room_type"])
    jobs.run_recommendation(spark, lst, str(tmp_path / "model"), model=model, true_before=True, **rules)
    sel = spark.read.parquet(str(tmp_path / "model" / "selection"))
    assert sel.count() == sel.select("listing_id").distinct().count() > 0
    assert {"lo", "hi"} <= set(sel.columns) and sel.where("recommended_price < lo or recommended_price > hi").isEmpty()
    assert not sel.where("lo is not null").isEmpty()


def test_lookup_has_an_order(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 2.0, "a"), (1, 9.0, "0"), (2, 0.0, "")], "listing_id long, x double, y string")
    assert {tuple(report.listing_row(df.repartition(k), 1).first()) for k in (1, 2, 3)} == {(1, 2.0, "a")}


# ---- stages

def test_static_stages_stand_below_the_explode(spark):
    from rateweave.operators import encoders, features
    from rateweave.sources.listings import load_listings

    lst = features.demand_score(load_listings(spark, SF_SMALL))
    m = models.fit_model(lst, "linear", *encoders.feature_columns(lst, exclude=["listing_id", "host_id", "raw_price", "demand_score"]))
    once, again = models.split_by_input(m.stages, "price")
    names = [type(s).__name__ for s in again]
    assert names == ["ListingFeatures", "MedianScalerModel", "VectorAssembler", "LinearRegressionModel"]
    assert again[0].wanted() == ["price_log", "price_per_minimum_night"] and again[1].wanted() == ["price__z"]
    assert sum(type(s).__name__ == "StringIndexerModel" for s in once) == sum(type(s).__name__ == "OneHotEncoderModel" for s in once) > 0
    plan = models.model_curve(lst, m)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [k for k, line in enumerate(plan) if "Generate" in line]
    assert len(at) == 1 and "PythonUDF" not in "\n".join(plan)
    above, below = "\n".join(plan[:at[0]]), "\n".join(plan[at[0]:])
    assert "__oh" in below and "UDF" in below
    made_above = [p for p in above.split(" AS ")[1:] if p.split("#")[0].strip("`").endswith(("__idx", "__oh", "__c"))]
    assert not made_above


def test_stages_saved_loaded_and_without_inputs(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel

    from rateweave.operators.stages import CategoryTexts, ListingFeatures, MedianScaler

    df = spark.createDataFrame([(1.0, 2.0, "x", None), (None, 4.0, "y", "a"), (float("nan"), 9.0, None, "b"), (7.0, float("inf"), "x", "a")],
                               "price double, minimum_nights double, room_type string, neighbourhood_group string").withColumn(
        "nothing", F.lit(None).cast("double"))
    pipe = Pipeline(stages=[ListingFeatures(), CategoryTexts(inputCols=["room_type"]), MedianScaler(inputCols=["price", "minimum_nights", "nothing"])])
    fitted = pipe.fit(df)
    fitted.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    rows = [tuple(r) for r in again.transform(df).select("price__z", "minimum_nights__z", "nothing__z", "room_type__c").collect()]
    assert rows == [tuple(r) for r in fitted.transform(df).select("price__z", "minimum_nights__z", "nothing__z", "room_type__c").collect()]
    prices = [1.0, 4.0, 4.0, 7.0]                            # gaps take the median of 1 and 7
    dev = (sum((p - 4) ** 2 for p in prices) / 4) ** 0.5
    assert [r[0] for r in rows] == pytest.approx([(p - 4) / dev for p in prices])
    assert [r[2] for r in rows] == [0.0] * 4 and [r[3] for r in rows] == ["x", "y", "missing", "x"]
    bare = again.stages[0].transform(df.drop("room_type", "minimum_nights"))
    assert "price_log" in bare.columns and "room_type_neighbourhood" not in bare.columns and "price_per_minimum_night" not in bare.columns


def test_grid_search_by_hand(spark):
    from rateweave.operators import encoders, features
    from rateweave.sources.listings import load_listings

    lst = features.demand_score(load_listings(spark, SF_SMALL))
    points, predictions, scores = models.grid_search(lst, "ridge", ["price", "number_of_reviews"], [], grid={"alpha": [0.1, 10.0, 1e9]}, folds=4)
    assert [p["alpha"] for p in points] == [0.1, 10.0, 1e9] and models.best_point(scores) in (0, 1)
    pdf = predictions.toPandas()
    assert (pdf.groupby("point").listing_id.nunique() == lst.count()).all() and not pdf.duplicated(["point", "listing_id"]).any()
    folds = lst.select("listing_id", models.fold_of("listing_id", 4).alias("f")).toPandas().set_index("listing_id").f
    assert (pdf.fold.to_numpy() == folds.loc[pdf.listing_id].to_numpy()).all() and set(folds) <= {0, 1, 2, 3}
    for r in scores.collect():
        own = pdf[(pdf.point == r.point) & (pdf.fold == r.fold)]
        rest = ((own.demand_score - own.prediction) ** 2).sum() / ((own.demand_score - own.demand_score.mean()) ** 2).sum()
        assert r.rows == len(own) and r.r2 == pytest.approx(1 - rest)
    model, best = models.tune(lst, "ridge", ["price", "number_of_reviews"], [], grid={"alpha": [0.1, 1e9]})
    assert best == {"alpha": 0.1} and model.transform(lst).count() == lst.count()
    assert encoders is not None
