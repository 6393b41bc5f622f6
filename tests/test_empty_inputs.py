"""Empty frames and all-NULL columns: operators return empty/NULL results, never fail."""


def test_empty_and_all_null(spark):
    from rateweave.operators import budget, clean, features, profile, select
    from rateweave.operators.quantiles import column_quantiles, exact_quantiles

    empty = spark.createDataFrame([], "listing_id long, x double, s string")
    assert exact_quantiles(empty, "x", [0.5]).count() == 0
    assert column_quantiles(empty, ["x"], [0.5]) == {"x": [None]}
    assert clean.impute_median(empty, ["x"]).count() == 0
    assert profile.histogram(empty, "x").count() == 0
    assert profile.profile_numeric(empty, ["x"]).count() == 0
    assert profile.profile_missing(empty).filter("missing_pct IS NOT NULL").count() == 0

    nulls = spark.createDataFrame([(1, None, None), (2, None, None)], "listing_id long, x double, s string")
    d = profile.profile_numeric(nulls, ["x"]).first()
    assert d["count"] == 0 and d["q50"] is None
    assert clean.impute_mode(nulls, ["s"]).filter("s IS NULL").count() == 2
    sc = features.demand_score(spark.createDataFrame(
        [], "reviews_per_month double, number_of_reviews double, availability_365 double"))
    assert sc.count() == 0

    curve = spark.createDataFrame([], "listing_id long, option_id int, current_price double, "
                                      "candidate_price double, expected_revenue double")
    sel, s = budget.select_with_budget(curve, 10.0)
    assert sel.count() == 0 and s["num_listings"] == 0
    assert select.select_best_option(curve).count() == 0
