"""Runnable jobs: inputs -> sinks."""

import os
import tempfile

from conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="rateweave-jobs-", dir="/tmp")


def test_run_inference_and_recommendation(spark):
    from rateweave.plans import jobs
    from rateweave.sources.listings import load_listings

    d = _tmp()
    lst = load_listings(spark, SF_SMALL)
    src = os.path.join(d, "listings.parquet")
    lst.write.parquet(src)
    s = jobs.run_inference(spark, [os.path.join(d, "nope.csv"), src], os.path.join(d, "inf"))
    assert s["total_listings"] == lst.count()
    assert s["increase_count"] + s["decrease_count"] + s["keep_count"] == s["total_listings"]
    assert spark.read.json(os.path.join(d, "inf", "inference_summary")).count() == 1
    r = jobs.run_recommendation(spark, lst, os.path.join(d, "rec"), change_pct=20.0, competitor_factor=1.2)
    assert r["num_recommendations"] == r["rows_written"] > 0
    b = jobs.run_recommendation(spark, lst, os.path.join(d, "bud"), max_avg_pct=5.0)
    assert b["budget"]["used_cost"] <= b["budget"]["budget"] + 1e-6
    assert abs(b["average_price_change_pct"]) <= 20.0


def test_run_profile_clean_encoders(spark):
    from pyspark.sql import functions as F

    from rateweave.operators import encoders
    from rateweave.plans import jobs
    from rateweave.sources.listings import load_listings

    d = _tmp()
    lst = load_listings(spark, SF_SMALL)
    jobs.run_profile(spark, lst, d)
    assert spark.read.json(os.path.join(d, "data_summary")).first()["n_rows"] == lst.count()
    out = jobs.run_clean_and_engineer(lst.drop("price").withColumnRenamed("raw_price", "price"), os.path.join(d, "fe"))
    assert "availability_bucket" in out.columns and out.count() > 0
    tr, te = encoders.split(lst)
    a, b = jobs.run_encoders(tr, te, ["room_type"], ["neighbourhood_group"], ["price"])
    assert any(c.startswith("room_type_") for c in a.columns)
    m = a.agg(F.avg("price"), F.stddev_pop("price")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9
    assert b.count() == te.count()


def test_recommendation_on_infeasible_error(spark):
    import pytest

    from rateweave.plans import jobs
    from rateweave.sources.listings import load_listings

    curve = jobs.target_curve(load_listings(spark, SF_SMALL))
    assert jobs.recommendation_job(curve, bounds=(0.0, 1e9), on_infeasible="error").count() > 0
    with pytest.raises(RuntimeError, match="No feasible"):
        jobs.recommendation_job(curve, bounds=(1e8, 1e9), on_infeasible="error")
