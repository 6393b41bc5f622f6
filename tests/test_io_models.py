"""Sources/sinks (A-*), model fit/save/load/tune (E-*), run log (E-10)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="rateweave-test-", dir="/tmp")


def test_csv_roundtrip_and_contract(spark):
    from rateweave.operators import clean
    from rateweave.sources import io

    d = _tmp()
    p = os.path.join(d, "raw.csv")
    with open(p, "w") as f:
        f.write("id,Price,Service Fee,room type,neighbourhood group,availability 365,number of reviews,reviews per month\n")
        f.write('1,"$1,234",$50 ,Private room,Brooklyn,10,3,0.5\n')
        f.write("2,abc,,,Queens,,,\n")
    df = io.read_listings(spark, p, schema=None)
    df = df.toDF(*[c for c in df.columns])
    prepared = clean.prepare_inference_input(clean.parse_money_columns(clean.normalize_columns(df), ["price", "service_fee"]))
    rows = {r["listing_id"]: r for r in prepared.collect()}
    assert rows["1"]["price"] == 1234.0 and rows["1"]["service_fee"] == 50.0
    assert rows["2"]["price"] == 0.0 and rows["2"]["room_type"] == "Unknown"
    with pytest.raises(ValueError, match="input lacks columns: nope"):
        clean.require_columns(df, ["id", "nope"])
    assert io.resolve_first(spark, [os.path.join(d, "missing.csv"), p]) == p
    with pytest.raises(FileNotFoundError, match="missing.csv"):
        io.resolve_first(spark, [os.path.join(d, "missing.csv")])
    assert io.read_listings(spark, prepared) is prepared
    io.write_report(prepared, os.path.join(d, "report"))
    io.write_summary(prepared.agg(F.count(F.lit(1)).alias("n")), os.path.join(d, "summary"))
    io.write_curve(prepared, os.path.join(d, "curve"), partition_by=["room_type"])
    assert spark.read.option("header", True).csv(os.path.join(d, "report")).count() == 2
    assert spark.read.json(os.path.join(d, "summary")).first()["n"] == 2
    assert spark.read.parquet(os.path.join(d, "curve")).count() == 2


def _train_test(spark):
    from rateweave.operators import clean, encoders, features
    from rateweave.sources.listings import load_listings

    data = clean.drop_leakage(features.demand_score(load_listings(spark, "/root/testdata/sf0.01")))
    return encoders.split(data)


NUM = ["price", "service_fee", "minimum_nights", "number_of_reviews", "review_rate_number"]
CAT = ["room_type", "neighbourhood_group"]


def test_fit_save_load_score_and_ridge(spark):
    import numpy as np

    from rateweave.operators import models
    from rateweave.sources import io

    train, test = _train_test(spark)
    m = models.fit_model(train, "ridge", NUM, CAT)
    d = _tmp()
    io.save_model(m, os.path.join(d, "model"))
    m2 = io.load_model(os.path.join(d, "model"))
    a = [r[0] for r in m.transform(test).select("prediction").collect()]
    b = [r[0] for r in m2.transform(test).select("prediction").collect()]
    assert np.allclose(a, b)
    met = models.regression_metrics(m.transform(test)).first()
    assert met["rmse"] > 0 and met["r2"] < 1
    sc = models.score(test, m)
    assert sc.columns == ["listing_id", "current_price", "predicted_demand_before", "predicted_revenue_before"]


def test_ols_matches_closed_form(spark):
    import numpy as np

    from rateweave.operators import models

    train, _ = _train_test(spark)
    m = models.fit_simple_linear(train, "number_of_reviews")
    pdf = train.select("number_of_reviews", "demand_score").toPandas().dropna()
    slope, intercept = np.polyfit(pdf["number_of_reviews"], pdf["demand_score"], 1)
    lr = m.stages[-1]
    assert lr.coefficients[0] == pytest.approx(slope, rel=1e-8)
    assert lr.intercept == pytest.approx(intercept, rel=1e-8)


def test_tune_and_run_log(spark):
    import time

    from rateweave.operators import models

    train, test = _train_test(spark)
    t = time.time()
    m, params = models.tune(train, "gbt", NUM, CAT, grid={"maxIter": [3, 5], "maxDepth": [2]}, subset_rows=500,
                            parallelism=2)
    assert params["maxIter"] in (3, 5)
    met = models.regression_metrics(m.transform(test)).first()
    cmp = models.compare_models({"gbt": m, "missing": None}, test)
    assert models.select_best(cmp).first()["best_model"] == "gbt"
    d = _tmp()
    models.append_runs(spark, [models.run_record("gbt", params, met, t)], os.path.join(d, "runs"))
    models.append_runs(spark, [models.run_record("gbt", params, met, t)], os.path.join(d, "runs"))
    assert spark.read.parquet(os.path.join(d, "runs")).count() == 2
    sub = models.tuning_subset(train, 100)
    assert sub.count() == 100 and sub.select("listing_id").distinct().count() == 100


def test_train_models_shared_preprocessing(spark):
    import numpy as np

    from rateweave.operators import models

    train, test = _train_test(spark)
    both = models.train_models(train, ("linear", "ridge"), NUM, CAT, parallel=2)
    assert set(both) == {"linear", "ridge"}
    single = models.fit_model(train, "linear", NUM, CAT)
    a = [r[0] for r in both["linear"].transform(test).orderBy("listing_id").select("prediction").collect()]
    b = [r[0] for r in single.transform(test).orderBy("listing_id").select("prediction").collect()]
    assert np.allclose(a, b, rtol=1e-6, atol=1e-9)


def test_ridge_matches_closed_form(spark):
    import numpy as np

    from rateweave.operators import models

    train, _ = _train_test(spark)
    m = models.fit_model(train, "ridge", NUM, CAT)
    prep_out = m.transform(train).select("features", "demand_score").toPandas()
    X = np.vstack([v.toArray() for v in prep_out["features"]])
    y = prep_out["demand_score"].to_numpy()
    xm, ym = X.mean(axis=0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(X.shape[1]), Xc.T @ yc)
    b = ym - xm @ w
    lr = m.stages[-1]
    assert np.allclose(lr.coefficients.toArray(), w, rtol=1e-5, atol=1e-7)
    assert lr.intercept == pytest.approx(b, rel=1e-5, abs=1e-7)
