"""One key holding a third of all rows: results stay exact and the big side is
never shuffled for a group statistic."""

import numpy as np
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    df = spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("listing_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string")))
        .alias("neighbourhood_group"),
        F.when(F.col("id") % 3 == 0, F.lit("Private room")).otherwise(F.lit("Shared room")).alias("room_type"),
        ((F.col("id") * 7919) % 1000 / 10.0 + 5.0).alias("current_price"),
    )
    return df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_band_rule_broadcasts_stats(spark, skewed):
    from rateweave.operators import constraints, curves

    curve = curves.explode_grid(skewed, curves.price_grid("current_price", 15, 0.8, 1.2))
    flagged = constraints.area_band_ok(curve, deviation_pct=25.0)
    plan = _plan(flagged)
    assert "BroadcastHashJoin" in plan
    # the exploded side reaches the join without an Exchange
    assert "SortMergeJoin" not in plan
    got = flagged.groupBy("neighbourhood_group").agg(F.count_if(~F.col("ok_area")).alias("bad")).collect()
    assert all(r["bad"] == 0 for r in got)       # current price always lies inside its own band


def test_selection_on_hot_listing(spark, skewed):
    from rateweave.operators import select

    # a third of all curve rows belong to one listing id
    rows = skewed.select(F.when(F.col("listing_id") % 3 == 0, F.lit(-1)).otherwise(F.col("listing_id"))
                         .alias("listing_id"),
                         F.col("listing_id").cast("int").alias("option_id"),
                         F.col("current_price"), F.col("current_price").alias("candidate_price"),
                         ((F.col("listing_id") * 31) % 1001).cast("double").alias("expected_revenue"))
    sel = {r["listing_id"]: r for r in select.select_best_option(rows).collect()}
    pdf = rows.toPandas()
    hot = pdf[pdf.listing_id == -1]
    best = hot.sort_values(["expected_revenue", "option_id"], ascending=[False, True]).iloc[0]
    assert sel[-1]["option_id"] == best.option_id
    assert len(sel) == pdf.listing_id.nunique()
    plan = _plan(select.select_best_option(rows))
    assert "partial_max_by" in plan


def test_quantiles_hot_group_refined(spark, skewed):
    from rateweave.operators.quantiles import exact_quantiles

    got = {(r["neighbourhood_group"], r["q"]): r["value"] for r in exact_quantiles(
        skewed, "current_price", [0.25, 0.5, 0.9], by=["neighbourhood_group"], gather_limit=1000, bins=64).collect()}
    pdf = skewed.toPandas()
    for g in ["HOT", "g1", "g50"]:
        vals = pdf[pdf.neighbourhood_group == g].current_price.to_numpy()
        for q in (0.25, 0.5, 0.9):
            assert got[(g, q)] == pytest.approx(float(np.quantile(vals, q)), abs=1e-9)


def test_target_mean_hot_key(spark, skewed):
    from rateweave.operators import features

    out = features.target_mean(skewed, "neighbourhood_group", "current_price", "m")
    assert "BroadcastHashJoin" in _plan(out)
    hot = out.filter("neighbourhood_group = 'HOT'").select("m").distinct().collect()
    pdf = skewed.toPandas()
    assert len(hot) == 1 and hot[0][0] == pytest.approx(pdf[pdf.neighbourhood_group == "HOT"].current_price.mean())
