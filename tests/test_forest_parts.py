"""Forests too large for the driver: fitted, kept, scored and saved by some trees at a time."""

import pytest
from pyspark.sql import functions as F

from rateweave.operators import models
from rateweave.sources import io

NUM, CAT = ["price", "nights"], ["kind"]


def _rows(spark, n=240):
    k = F.col("listing_id")
    return spark.range(n).select(
        F.col("id").alias("listing_id")).select(
        k, (k * 37 % 101).cast("double").alias("price"), (k % 7).cast("double").alias("nights"),
        F.when(k % 11 != 0, F.concat(F.lit("k"), k % 3)).alias("kind"),
        ((k * 37 % 101) / F.lit(50.0) + k % 5).alias("demand_score"))


@pytest.fixture
def few(monkeypatch):
    """The driver holds 2000 nodes: of 240 rows, 4 trees of 480 nodes, in fits of one tree."""
    monkeypatch.setattr(models, "FOREST_NODES", 2000)
    monkeypatch.setattr(models, "FOREST_FITS_AT_ONCE", 3)


def _fit_sizes(monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    sizes, own = [], RandomForestRegressor._fit

    def fit(self, data):
        sizes.append((self.getNumTrees(), self.getSeed()))
        return own(self, data)

    monkeypatch.setattr(RandomForestRegressor, "_fit", fit)
    return sizes


def test_no_fit_has_more_trees_than_the_driver_holds(spark, few, monkeypatch):
    sizes = _fit_sizes(monkeypatch)
    lst = _rows(spark)
    params = {"numTrees": 7, "maxDepth": 20}
    by_kinds = models.train_models(lst, ("forest",), NUM, CAT, params={"forest": params})["forest"]
    alone = models.fit_model(lst, "forest", NUM, CAT, params=params)
    assert sorted(t for t, _ in sizes) == [1] * 14 and len({s for _, s in sizes}) == 7
    for m in (by_kinds, alone):
        assert m.stages[-1].getNumTrees == 7 and [f.getNumTrees for f in m.stages[-1].forests()] == [1] * 7


def test_prediction_is_the_mean_over_all_trees(spark, few, tmp_path):
    lst = _rows(spark)
    m = models.fit_model(lst, "forest", NUM, CAT, params={"numTrees": 7, "maxDepth": 20})
    twice = lst.unionByName(lst.where("listing_id < 9"))           # rows that come twice stay so
    got = [(r["listing_id"], r["prediction"]) for r in m.transform(twice).collect()]
    assert len(got) == 249 and len(set(got)) == 240
    feats = twice
    for stage in m.stages[:-1]:
        feats = stage.transform(feats)
    each = [dict(f.transform(feats).select("listing_id", "prediction").collect()) for f in m.stages[-1].forests()]
    want = {k: sum(e[k] for e in each) / 7 for k in each[0]}
    assert dict(got) == pytest.approx(want)
    assert len({round(e[5], 9) for e in each}) > 1                  # other trees in each part
    path = str(tmp_path / "m")
    io.save_model(m, path)
    back = io.load_model(path)
    assert all(p.startswith(path) or p.startswith(f"file:{path}") for p in back.stages[-1].getOrDefault("paths"))
    assert {(r["listing_id"], r["prediction"]) for r in back.transform(twice).collect()} == set(got)


def test_curve_of_a_forest_in_parts(spark, few):
    lst = _rows(spark)
    m = models.fit_model(lst, "forest", NUM, CAT, params={"numTrees": 5, "maxDepth": 20})
    curve = models.model_curve(lst, m).collect()
    assert len(curve) == 240 * 15 and len({(r["listing_id"], r["option_id"]) for r in curve}) == 240 * 15
    r2 = models.regression_metrics(m.transform(lst)).first()["r2"]
    assert r2 > 0.5


def test_small_forests_are_fitted_at_once(spark, monkeypatch):
    sizes = _fit_sizes(monkeypatch)
    m = models.fit_model(_rows(spark), "forest", NUM, CAT, params={"numTrees": 7, "maxDepth": 4})
    assert sizes == [(7, 42)] and len(m.stages[-1].trees) == 7
