"""Exact distributed quantiles against numpy, including the refinement passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateweave.operators import profile
from rateweave.operators.quantiles import exact_quantiles


def _np_q(values, q):
    return float(np.quantile(np.asarray(values, dtype=float), q, method="linear"))


def test_small_fixture_skew_and_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    sk = profile.profile_skew(df, ["x"]).first()["skewness"]
    assert sk == pytest.approx(1.7636326, abs=1e-6)
    d = profile.profile_numeric(df, ["x"]).first()
    assert d["q25"] == pytest.approx(1.75) and d["q50"] == pytest.approx(2.5) and d["count"] == 4


@pytest.mark.parametrize("gather_limit,bins", [(200_000, 1024), (7, 4), (3, 2)])
def test_exact_quantiles_refinement(spark, gather_limit, bins):
    rng = np.random.default_rng(7)
    groups = {"hot": np.concatenate([rng.exponential(3.0, 400), np.zeros(150), np.full(30, 2.5)]),
              "cold": rng.normal(10, 2, 37), "one": np.array([4.0]), "dup": np.full(20, 1.25)}
    rows = [(g, float(v)) for g, vals in groups.items() for v in vals] + [("hot", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["q"]): r["value"]
           for r in exact_quantiles(df, "v", probs, by=["g"], gather_limit=gather_limit, bins=bins).collect()}
    assert ("nan", 0.5) not in got
    for g, vals in groups.items():
        for q in probs:
            assert got[(g, q)] == pytest.approx(_np_q(vals, q), rel=1e-12, abs=1e-12), (g, q)


def test_iqr_and_box(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "k string, x double")
    iq = profile.iqr_outliers(df, ["x"]).first()
    q1, q3 = _np_q(vals, 0.25), _np_q(vals, 0.75)
    assert iq["q1"] == pytest.approx(q1) and iq["q3"] == pytest.approx(q3) and iq["n_outliers"] == 1
    b = profile.box_stats(df, "x", by="k").first()
    assert b["whisker_high"] == 6.0 and b["whisker_low"] == 1.0 and b["n_outliers"] == 1 and b["max"] == 100.0


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and max(h) == 5 and h[5] == 3


def test_distinct_and_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, float("nan")), ("a", 2.0)], "s string, x double")
    d = {r["column"]: r["n_distinct"] for r in profile.profile_distinct(df).collect()}
    assert d == {"s": 2}
    m = {r["column"]: r["missing_count"] for r in profile.profile_missing(df).collect()}
    assert m == {"s": 1, "x": 2}
    assert profile.value_counts(df, "s").first()["s"] == "a"
    assert F is not None


def test_approx_paths_close_to_exact(spark):
    from rateweave.operators import clean
    from rateweave.operators.quantiles import column_quantiles

    rng = np.random.default_rng(3)
    vals = rng.normal(50, 10, 5000)
    df = spark.createDataFrame([(float(v), None if i % 10 == 0 else float(v)) for i, v in enumerate(vals)],
                               "x double, y double")
    ex = column_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    ap = column_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], accuracy=10_000)
    for c in ("x", "y"):
        for a, b in zip(ex[c], ap[c]):
            assert abs(a - b) < 0.5
    d = profile.profile_numeric(df, ["x"], accuracy=10_000).first()
    assert abs(d["q50"] - float(np.median(vals))) < 0.5
    filled = clean.impute_median(df, ["y"], approx_accuracy=10_000)
    assert filled.filter("y IS NULL").count() == 0
