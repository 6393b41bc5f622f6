"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (through the listing adapter) and runs
the library operators over the whole input.  Double outputs are rounded to
6 decimals with ``rint`` (the same rule as the oracle side), nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.functions.exprs import fmt2, parse_money
from rateweave.operators import clean, constraints, curves, encoders, features, profile, report, select
from rateweave.plans import jobs, options
from rateweave.session import cut_lineage, ensure_checkpoint_dir
from rateweave.sources import io
from rateweave.sources.listings import load_listings

# Fixed parameters of the registered queries.
ROOM_ELASTICITY = {"Entire home/apt": -0.6, "Private room": -0.9, "Shared room": -1.4, "Hotel room": -1.1}
LOOKUP_ID = 42
FILTER_ACTIONS, FILTER_LO, FILTER_HI = ["decrease"], 50.0, 200.0
CHANGE_LIMIT_PCT = 10.0
BOUNDS = (20.0, 400.0)
PROFILE_NUMERIC = ["price", "service_fee", "minimum_nights", "number_of_reviews", "reviews_per_month",
                   "availability_365", "review_rate_number"]
CORR_COLS = ["price", "number_of_reviews", "reviews_per_month", "availability_365", "demand_score"]


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    s = float(10 ** digits)
    return df.select(*[
        (F.rint(F.col(f.name) * F.lit(s)) / F.lit(s) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double"
        else F.col(f.name)
        for f in df.schema.fields
    ])


def L(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Listings for queries that read them several times: written once, of ``cols`` only if given."""
    own = load_listings(spark, sf_dir, materialize=False)
    return cut_lineage(own.select(*cols) if cols else own)


def once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings for queries that read them once: nothing is written, unread columns are not computed."""
    return load_listings(spark, sf_dir, materialize=False)


def _scored(spark, sf_dir):
    return features.demand_score(L(spark, sf_dir))


# ------------------------------------------------------------------ H-1 / G

def q_h1_inference(spark, sf_dir):
    return round_doubles(jobs.inference_job(L(spark, sf_dir)))


def q_h1_inference_room_elasticity(spark, sf_dir):
    lst = L(spark, sf_dir)
    e = F.lit(None).cast("double")
    for k, v in ROOM_ELASTICITY.items():
        e = F.when(F.col("room_type") == k, F.lit(v)).otherwise(e)
    pred = jobs.prediction_frame(jobs.target_inference_input(lst.withColumn("elasticity", e)),
                                 carry=["elasticity"])
    best = select.best_price_elastic(pred, elasticity="elasticity")
    return round_doubles(report.build_report(best))


def _report(spark, sf_dir):
    """The persisted inference report the dashboard reads (written once to the
    checkpoint directory, so dashboard filters never re-run the optimisation)."""
    return cut_lineage(jobs.inference_job(L(spark, sf_dir)))


def q_g08_inference_summary(spark, sf_dir):
    return round_doubles(report.inference_summary(_report(spark, sf_dir)))


def q_g11_dashboard_kpis(spark, sf_dir):
    return round_doubles(report.dashboard_kpis(_report(spark, sf_dir)))


def q_g12_revenue_impact(spark, sf_dir):
    return round_doubles(report.revenue_impact(_report(spark, sf_dir)))


def q_b16_filter_recommendations(spark, sf_dir):
    r = report.filter_recommendations(_report(spark, sf_dir), FILTER_ACTIONS, FILTER_LO, FILTER_HI)
    return round_doubles(report.dashboard_table(r))


def q_b16_filter_defaults(spark, sf_dir):
    return round_doubles(report.dashboard_table(report.filter_recommendations(_report(spark, sf_dir))))


def q_f05_explorer_listing(spark, sf_dir):
    """Explorer view: one listing of the persisted report -> its 30-point
    elasticity curve (demand and revenue at each price)."""
    row = report.listing_row(_report(spark, sf_dir), str(LOOKUP_ID)).select(
        "listing_id", "current_price", "predicted_demand_before", "optimized_price")
    return round_doubles(curves.elastic_curve(row))


def q_g13_listing_insight(spark, sf_dir):
    return round_doubles(report.listing_insight(_report(spark, sf_dir), str(LOOKUP_ID)))


# ------------------------------------------------------------------ B

def q_b04_inference_input(spark, sf_dir):
    return round_doubles(clean.prepare_inference_input(once(spark, sf_dir), keep_extra=False))


ODD_MONEY = ["5d", "$7f", "Infinity", "$1,234", " $12.50 ", "", "-3e2", "NaN", "0x10", "1.2.3"]


def q_b03_enforce_types(spark, sf_dir):
    """Numbers as text, with text that only some parsers take."""
    lst = once(spark, sf_dir)
    odd = F.element_at(F.array(*[F.lit(x) for x in ODD_MONEY]), (F.col("listing_id") % len(ODD_MONEY)).cast("int") + 1)
    text = lst.select("listing_id", F.when(F.col("listing_id") % 2 == 0, odd).otherwise(F.col("price").cast("string"))
                      .alias("price"), "room_type")
    return round_doubles(clean.enforce_types(text).select(F.col("listing_id").cast("long").alias("listing_id"), "price"))


def q_b05_parse_money(spark, sf_dir):
    lst = once(spark, sf_dir)
    return round_doubles(lst.select("listing_id", "raw_price",
                                    parse_money(F.col("raw_price")).alias("parsed_price")))


def q_b05_parse_odd_money(spark, sf_dir):
    odd = F.element_at(F.array(*[F.lit(x) for x in ODD_MONEY]), (F.col("listing_id") % len(ODD_MONEY)).cast("int") + 1)
    return round_doubles(once(spark, sf_dir).select("listing_id", parse_money(odd).alias("parsed_price")))


def q_b01_b06_b09_names_and_fills(spark, sf_dir):
    """Names of the raw file normalised, raw columns dropped, the country filled."""
    lst = once(spark, sf_dir)
    raw = lst.select(F.col("listing_id").alias(" ID "), F.col("room_type").alias("Room Type"), F.lit("x").alias("NAME"),
                     F.lit("y").alias("house_rules"), F.lit(None).cast("string").alias("license"),
                     F.lit(2000.0).alias("Construction year"), F.lit("US").alias("country code"), F.lit("z").alias("host name"),
                     F.when(F.col("listing_id") % 3 > 0, "Canada").alias("Country"))
    return clean.impute_const(clean.drop_columns(clean.normalize_columns(raw)), {"country": clean.DEFAULT_COUNTRY})


def q_b02_missing_columns(spark, sf_dir):
    """What the input contract says of listings that lack columns."""
    lst = once(spark, sf_dir)
    try:
        clean.require_columns(lst.select("listing_id", "price"), list(clean.INFERENCE_SCHEMA))
        said = ""
    except ValueError as e:
        said = str(e)
    return lst.agg(F.count(F.lit(1)).alias("listings")).withColumn("said", F.lit(said))


def q_b07_integer_median(spark, sf_dir):
    """The median of an integer column can lie between two integers."""
    lst = once(spark, sf_dir).select("listing_id", F.when(F.col("listing_id") % 2 == 0, F.col("listing_id")).alias("half"))
    return clean.impute_median(lst, ["half"]).select("listing_id", "half")


def _with_odd_values(lst: DataFrame) -> DataFrame:
    """Prices with NULL, NaN and infinities, and a column without values."""
    k = F.col("listing_id") % 50
    odd = F.when(k == 1, None).when(k == 2, float("nan")).when(k == 3, float("inf")).when(k == 4, float("-inf"))
    return lst.select("listing_id", "room_type", odd.otherwise(F.col("price")).alias("price"), "minimum_nights",
                      F.lit(None).cast("double").alias("nothing"), F.lit(None).cast("string").alias("no_text"))


def q_b13_odd_values_dropped(spark, sf_dir):
    odd = _with_odd_values(once(spark, sf_dir)).drop("nothing", "no_text")
    return round_doubles(clean.drop_nulls(features.null_non_finite(odd), ["price"]))


def q_b14_leakage_columns(spark, sf_dir):
    lst = once(spark, sf_dir)
    left = clean.drop_leakage(lst).columns
    return lst.agg(F.count(F.lit(1)).alias("listings")).withColumn("left", F.lit(",".join(sorted(left))))


def q_c03_distinct_of_nothing(spark, sf_dir):
    return profile.profile_distinct(_with_odd_values(once(spark, sf_dir)))


def q_c08_iqr_odd_values(spark, sf_dir):
    return round_doubles(profile.iqr_outliers(features.null_non_finite(_with_odd_values(L(spark, sf_dir))),
                                              ["price", "minimum_nights", "nothing"]))


def q_c09_histogram_odd_values(spark, sf_dir):
    return round_doubles(profile.histogram(_with_odd_values(L(spark, sf_dir)), "price", 200))


SKETCHED = ["price", "minimum_nights", "reviews_per_month"], ["room_type", "neighbourhood_group", "listing_id"]


def q_c03_c04_sketches(spark, sf_dir):
    """The state of two halves, kept as a table and merged, against one pass and the exact values."""
    from rateweave.operators import sketches
    from rateweave.operators.quantiles import column_quantiles

    lst = L(spark, sf_dir, "listing_id", *SKETCHED[0], *SKETCHED[1][:2])
    path = _scratch(spark, "state")
    for half in (0, 1):
        sketches.add_to_state(path, lst.where(F.col("listing_id") % 2 == half), *SKETCHED)
    merged, whole = cut_lineage(sketches.read_state(spark, path)), cut_lineage(sketches.profile_state(lst, *SKETCHED))
    same = merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    exact = profile.profile_distinct(lst.withColumn("listing_id", F.col("listing_id").cast("string")), SKETCHED[1])
    near = exact.join(sketches.distinct_estimates(merged).withColumnRenamed("n_distinct", "about"), "column").select(
        "column", "n_distinct", (F.abs(F.col("about") - F.col("n_distinct")) <= 4 * 1.04 / 64 * F.col("n_distinct")).alias("within_bound"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = {(r["column"], r["p"]): r["value"] for r in sketches.quantile_estimates(merged, probs).collect()}
    ranks = {c: lst.where(F.col(c).isNotNull()).count() - 1 for c in SKETCHED[0]}
    wanted = {c: column_quantiles(lst, [c], [math.floor(p * n) / n for p in probs])[c] for c, n in ranks.items()}
    good = {c: all(abs(found[c, p] - w) <= sketches.ALPHA * abs(w) * (1 + 1e-9) for p, w in zip(probs, wanted[c])) for c in wanted}
    rows = spark.createDataFrame([(c, ranks[c] + 1, ok) for c, ok in good.items()], "column string, n_distinct long, within_bound boolean")
    return near.unionByName(rows).select("column", F.col("n_distinct").alias("n"), "within_bound", F.lit(same).alias("merged_is_one_pass"))


def q_c06_data_summary(spark, sf_dir):
    lst = L(spark, sf_dir, "listing_id", "room_type", "price")
    row = profile.data_summary(lst)
    return row.select("n_rows", "n_columns", F.size("missing").alias("n_missing"), F.size("numeric").alias("n_numeric"),
                      F.element_at("distinct", 1)["n_distinct"].alias("room_types"))


def q_d03_minmax(spark, sf_dir):
    return round_doubles(features.minmax(L(spark, sf_dir, "listing_id", "price"), "price").select("listing_id", "price_minmax"))


def q_d14_indicators(spark, sf_dir):
    lst = L(spark, sf_dir, "listing_id", "room_type")
    return encoders.one_hot(lst, "room_type", ["Hotel room", "Private room", "Shared room"])


def q_d17_numeric_columns(spark, sf_dir):
    lst = once(spark, sf_dir)
    return lst.agg(F.count(F.lit(1)).alias("listings")).withColumn("numeric", F.lit(",".join(sorted(profile.numeric_columns(lst)))))


def q_b07_impute_median(spark, sf_dir):
    cols = ["reviews_per_month", "availability_365", "review_rate_number", "service_fee"]
    return round_doubles(clean.impute_median(L(spark, sf_dir, "listing_id", *cols), cols).select("listing_id", *cols))


def q_b08_impute_mode(spark, sf_dir):
    cols = ["cancellation_policy", "instant_bookable", "neighbourhood_group"]
    return clean.impute_mode(L(spark, sf_dir, "listing_id", *cols), cols).select("listing_id", *cols)


def _raw_file(lst: DataFrame) -> DataFrame:
    """Listings with the gaps and the extra columns of the raw file."""
    k = F.col("listing_id")
    return lst.withColumns({
        "price": F.when(k % 31 != 0, F.col("raw_price")),
        "number_of_reviews": F.when(k % 37 != 0, F.col("number_of_reviews")),
        "country": F.when(k % 29 != 0, F.when(k % 3 == 0, "Canada").otherwise("United States")),
        "host_identity_verified": F.when(k % 5 != 0, "verified"),
        **{c: F.lit("x") for c in clean.DROPPED_RAW_COLUMNS}}).drop("raw_price")


def q_h4_clean_batch(spark, sf_dir):
    return round_doubles(clean.clean_batch(cut_lineage(_raw_file(once(spark, sf_dir)))))


def q_b12_drop_nulls(spark, sf_dir):
    lst = once(spark, sf_dir)
    return round_doubles(clean.drop_nulls(clean.prep_categorical(
        features.null_non_finite(lst), ["room_type"]), ["reviews_per_month", "availability_365"]))


# ------------------------------------------------------------------ C

def q_c01_profile_shape(spark, sf_dir):
    return profile.profile_shape(once(spark, sf_dir)).drop("columns")


def q_c02_profile_missing(spark, sf_dir):
    return round_doubles(profile.profile_missing(once(spark, sf_dir)))


def q_c03_profile_distinct(spark, sf_dir):
    return profile.profile_distinct(once(spark, sf_dir))


def q_c04_profile_numeric(spark, sf_dir):
    return round_doubles(profile.profile_numeric(L(spark, sf_dir, *PROFILE_NUMERIC), PROFILE_NUMERIC))


def q_c07_skew(spark, sf_dir):
    return round_doubles(profile.profile_skew(once(spark, sf_dir), PROFILE_NUMERIC))


def q_c08_iqr_outliers(spark, sf_dir):
    return round_doubles(profile.iqr_outliers(L(spark, sf_dir, *PROFILE_NUMERIC), PROFILE_NUMERIC))


def q_c09_histogram(spark, sf_dir):
    return round_doubles(profile.histogram(L(spark, sf_dir, "price"), "price", 50))


def q_c10_box_price_by_room(spark, sf_dir):
    return round_doubles(profile.box_stats(L(spark, sf_dir, "price", "room_type"), "price", by="room_type"))


def q_c10_box_demand_by_area(spark, sf_dir):
    return round_doubles(profile.box_stats(_scored(spark, sf_dir), "demand_score", by="neighbourhood_group"))


def q_c11_corr_matrix(spark, sf_dir):
    return round_doubles(profile.corr_matrix(_scored(spark, sf_dir), CORR_COLS))


def q_c12_bin2d(spark, sf_dir):
    return round_doubles(profile.bin2d(_scored(spark, sf_dir), "price", "demand_score", 20, value="price"))


def q_c13_value_counts(spark, sf_dir):
    return profile.value_counts(once(spark, sf_dir), "room_type")


# ------------------------------------------------------------------ D

def q_d02_demand_score(spark, sf_dir):
    return round_doubles(_scored(spark, sf_dir).select("listing_id", "demand_score"))


def q_h4_engineer_batch(spark, sf_dir):
    return round_doubles(features.engineer_batch(L(spark, sf_dir)).drop("raw_price"))


def q_d12_model_features(spark, sf_dir):
    return round_doubles(features.engineer_model_features(once(spark, sf_dir)).select(
        "listing_id", "price_log", "price_per_minimum_night", "room_type_neighbourhood"))


def q_d19_split(spark, sf_dir):
    return once(spark, sf_dir).select("listing_id", encoders.is_test("listing_id").alias("is_test"))


def q_d13_frequency(spark, sf_dir):
    lst = L(spark, sf_dir, "listing_id", "neighbourhood_group")
    train, test = encoders.split(lst)
    freq = encoders.fit_frequency(train, "neighbourhood_group")
    tr = encoders.apply_frequency(train, freq, "neighbourhood_group", unseen_zero=False)
    te = encoders.apply_frequency(test, freq, "neighbourhood_group", unseen_zero=True)
    cols = ["listing_id", "neighbourhood_group", "neighbourhood_group_freq"]
    return round_doubles(tr.select(*cols, F.lit(False).alias("is_test")).unionByName(
        te.select(*cols, F.lit(True).alias("is_test"))))


def q_d14_category_index(spark, sf_dir):
    lst = L(spark, sf_dir, "listing_id", "room_type")
    train, _ = encoders.split(lst)
    cats = encoders.category_table(train, "room_type")
    return encoders.category_index(lst, "room_type", cats).select("listing_id", "room_type", "room_type_index")


def q_d15_median_imputer(spark, sf_dir):
    cols = ["reviews_per_month", "availability_365", "service_fee"]
    train, test = encoders.split(L(spark, sf_dir, "listing_id", *cols))
    st = encoders.fit_median_imputer(train, cols)
    return round_doubles(st.apply_fill(test).select("listing_id", *cols))


def q_d16_std_scaler(spark, sf_dir):
    cols = ["price", "number_of_reviews", "minimum_nights"]
    train, test = encoders.split(L(spark, sf_dir, "listing_id", *cols))
    st = encoders.fit_std_scaler(train, cols)
    return round_doubles(encoders.apply_std_scaler(test.select("listing_id", *cols), st, cols))


# ------------------------------------------------------------------ F

#: What curves are made of.
PRICED = ["listing_id", "price", "room_type", "neighbourhood_group", "competitor_avg_price", "reviews_per_month", "number_of_reviews",
          "availability_365"]


def _curve(spark, sf_dir):
    return jobs.target_curve(L(spark, sf_dir, *PRICED))


def _packed(spark, sf_dir):
    """Listings with their options in one row, written once: rules and summaries read them again.  There
    is one listing for each part, so ids don't repeat (``unique_ids``)."""
    return cut_lineage(options.with_options(L(spark, sf_dir, *PRICED)))


def _options_once(spark, sf_dir):
    """The same for what reads them once; a table of few files is dealt out first, as options cost time."""
    return options.with_options(L(spark, sf_dir, *PRICED).repartition(spark.sparkContext.defaultParallelism))


def q_f01_curve_without_price(spark, sf_dir):
    """Listings without a price have no candidates."""
    lst = L(spark, sf_dir)
    gaps = lst.withColumn("price", F.when(F.col("listing_id") % 41 != 0, F.col("price")))
    return round_doubles(jobs.target_curve(gaps).groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("options"), F.min("candidate_price").alias("lowest")))


def q_f08_without_revenue(spark, sf_dir):
    """Options without a revenue are never chosen; a listing that has no other is infeasible."""
    c = _curve(spark, sf_dir).withColumn("expected_revenue", F.when(
        (F.col("listing_id") % 7 != 0) & (F.col("option_id") != 0), F.col("expected_revenue")))
    sel = select.select_best_option(c.withColumn("feasible", F.lit(True)), feasible="feasible")
    return round_doubles(sel.select("listing_id", F.coalesce("option_id", F.lit(-1)).alias("option_id"), "expected_revenue",
                                    "feasible"))


def q_f01_target_curve(spark, sf_dir):
    return round_doubles(_curve(spark, sf_dir))


def q_f05_elastic_curve(spark, sf_dir):
    pred = jobs.prediction_frame(features.demand_score(L(spark, sf_dir)))
    c = curves.elastic_curve(pred.select("listing_id", "current_price", "predicted_demand_before"))
    return round_doubles(c)


def q_f06_option_ids(spark, sf_dir):
    c = _curve(spark, sf_dir).select("listing_id", "candidate_price", F.col("option_id").alias("grid_option"))
    return curves.option_ids(c, order="grid_option").select("listing_id", "grid_option", "option_id")


def _recs(spark, sf_dir, **rules):
    return round_doubles(options.recommend(_packed(spark, sf_dir), unique_ids=True, **rules))


def q_f08_select_best(spark, sf_dir):
    return _recs(spark, sf_dir)


def q_f08_long_curve(spark, sf_dir):
    """The grouped form, for curves that come as rows."""
    return round_doubles(jobs.recommendation_job(_curve(spark, sf_dir)))


def q_h2_long_curve(spark, sf_dir):
    return round_doubles(jobs.recommendation_job(_curve(spark, sf_dir), **ALL_RULES))


def q_f11_limit_change(spark, sf_dir):
    return _recs(spark, sf_dir, change_pct=CHANGE_LIMIT_PCT)


def q_f12_area_band(spark, sf_dir):
    return _recs(spark, sf_dir, area_pct=constraints.AREA_DEVIATION_PCT)


def q_f13_room_band(spark, sf_dir):
    return _recs(spark, sf_dir, room_band=True)


def q_f14_room_hierarchy(spark, sf_dir):
    return _recs(spark, sf_dir, hierarchy=True)


def q_f15_competitor_cap(spark, sf_dir):
    return _recs(spark, sf_dir, competitor_factor=constraints.COMPETITOR_FACTOR)


def q_f16_price_bounds(spark, sf_dir):
    return _recs(spark, sf_dir, bounds=BOUNDS)


ALL_RULES = dict(change_pct=constraints.MAX_CHANGE_PCT, area_pct=constraints.AREA_DEVIATION_PCT, room_band=True,
                 hierarchy=True, competitor_factor=constraints.COMPETITOR_FACTOR)


def q_h2_recommendation(spark, sf_dir):
    return _recs(spark, sf_dir, **ALL_RULES)


def q_f09_infeasible(spark, sf_dir):
    sel = options.select_best(_packed(spark, sf_dir), unique_ids=True, **ALL_RULES)
    return sel.filter(~F.col("feasible")).select("listing_id")


def q_g09_recommendation_summary(spark, sf_dir):
    return round_doubles(report.recommendation_summary(options.recommend(_packed(spark, sf_dir), unique_ids=True, **ALL_RULES)))


def q_g10_selection_summary(spark, sf_dir):
    rows = _packed(spark, sf_dir)
    flags = {"neighborhood": True}
    sel = options.optimize(rows, unique_ids=True, area_pct=constraints.AREA_DEVIATION_PCT).where("feasible")
    return round_doubles(report.selection_summary(rows, sel, flags, packed="options").select("*", "optional_constraints.*")
                         .drop("optional_constraints"))


def q_g07_true_before(spark, sf_dir):
    """The business table with the demand at the current price as the demand before."""
    rows = _packed(spark, sf_dir)
    demand = features.demand_score(L(spark, sf_dir, "listing_id", "reviews_per_month", "number_of_reviews", "availability_365"))
    sel = options.optimize(rows, unique_ids=True).where("feasible").drop("feasible").join(
        demand.select("listing_id", F.col("demand_score").alias("now")), "listing_id")
    return round_doubles(report.build_recommendations(sel, true_before="now"))


def q_g07_nearest_before(spark, sf_dir):
    """The business table with the demand at the curve point nearest the current price before."""
    return _recs(spark, sf_dir, true_before=True, **ALL_RULES)


def q_g07_nearest_before_long(spark, sf_dir):
    return round_doubles(jobs.recommendation_job(_curve(spark, sf_dir), true_before=True, **ALL_RULES))


def _shared_ids(spark, sf_dir):
    """Listings of which every two neighbours have one id."""
    return L(spark, sf_dir).withColumn("listing_id", F.col("listing_id") - F.col("listing_id") % 2)


def q_f08_repeated_ids(spark, sf_dir):
    """Rows of one id are one listing."""
    return round_doubles(options.recommend(cut_lineage(options.with_options(_shared_ids(spark, sf_dir))), true_before=True,
                                           **ALL_RULES))


def q_f08_repeated_ids_long(spark, sf_dir):
    return round_doubles(jobs.recommendation_job(jobs.target_curve(_shared_ids(spark, sf_dir)), true_before=True, **ALL_RULES))


COLUMN_BOUNDS = ("least_price", "most_price")


def _with_bounds(df):
    return df.withColumn("least_price", F.col("competitor_avg_price") * F.lit(0.5)).withColumn(
        "most_price", F.when(F.col("listing_id") % 4 != 0, F.col("competitor_avg_price") * F.lit(1.1)))


def q_f16_column_bounds(spark, sf_dir):
    """Price bounds that the listings bring along."""
    rows = options.with_options(_with_bounds(L(spark, sf_dir)), carry=COLUMN_BOUNDS)
    return round_doubles(options.recommend(cut_lineage(rows), bounds=COLUMN_BOUNDS))


def q_f16_column_bounds_long(spark, sf_dir):
    return round_doubles(jobs.recommendation_job(_with_bounds(_curve(spark, sf_dir)), bounds=COLUMN_BOUNDS))


def q_g02_half_cents(spark, sf_dir):
    """Amounts at and beside half a cent, written with two decimals."""
    x = F.col("listing_id") / F.lit(1000.0)
    return once(spark, sf_dir).select("listing_id", fmt2(x).alias("plain"), fmt2(-x * F.lit(1.1)).alias("scaled"),
                                      fmt2((F.col("listing_id") * 2 + 1) / F.lit(8.0)).alias("ties"))


def q_f17_selection(spark, sf_dir):
    sel = options.optimize(_packed(spark, sf_dir), unique_ids=True, competitor_factor=constraints.COMPETITOR_FACTOR).where("feasible")
    return round_doubles(sel.select("listing_id", "option_id", "current_price", "recommended_price",
                                    "predicted_demand", "expected_revenue", "current_revenue_estimate",
                                    "expected_revenue_change", "price_change", "price_change_pct", "reason"))


# ------------------------------------------------------------------ F-10

BUDGET_COLUMNS = ["listing_id", "option_id", "current_price", "candidate_price", "expected_revenue", "abs_price_change_pct"]


def q_f10_budget(spark, sf_dir):
    from rateweave.operators import budget

    sel, _ = options.select_with_budget(_options_once(spark, sf_dir), budget.DEFAULT_MAX_AVG_PCT, unique_ids=True)
    return round_doubles(sel.select(*BUDGET_COLUMNS))


def q_f10_budget_long_curve(spark, sf_dir):
    """The same from a curve that comes as rows."""
    from rateweave.operators import budget

    sel, _ = budget.select_with_budget(_curve(spark, sf_dir), max_avg_pct=budget.DEFAULT_MAX_AVG_PCT)
    return round_doubles(sel.select(*BUDGET_COLUMNS))


def q_f10_budget_packed_rules(spark, sf_dir):
    """The budget over what the rules allow, on packed rows."""
    sel, _ = options.select_with_budget(_options_once(spark, sf_dir), 5.0, competitor_factor=constraints.COMPETITOR_FACTOR)
    return round_doubles(sel.select(*BUDGET_COLUMNS))


def _alike(spark, sf_dir):
    """One and the same curve for every listing."""
    lst = L(spark, sf_dir, "listing_id")
    same = lst.select("listing_id", F.lit(100.0).alias("current_price"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("option_id"))
    return same.select("*", (F.lit(100.0) + F.lit(5.0) * F.col("option_id")).alias("candidate_price"),
                       (F.lit(100.0) + F.col("option_id") * (F.lit(9.0) - F.col("option_id"))).alias("expected_revenue"))


def q_f10_budget_alike(spark, sf_dir):
    """Equal listings split at the cut, so the budget is used to within one step."""
    from rateweave.operators import budget

    sel, _ = budget.select_with_budget(_alike(spark, sf_dir), max_avg_pct=7.0)
    return round_doubles(sel.select(*BUDGET_COLUMNS))


def q_f10_budget_with_rules(spark, sf_dir):
    """The budget over what the rules allow; N counts all listings."""
    from rateweave.operators import budget

    flagged = constraints.apply_rules(_curve(spark, sf_dir), competitor_factor=constraints.COMPETITOR_FACTOR)
    sel, _ = budget.select_with_budget(flagged, max_avg_pct=5.0, feasible="feasible")
    return round_doubles(sel.select(*BUDGET_COLUMNS))


def q_f10_budget_refined(spark, sf_dir):
    """The listings nearest the cut chosen anew: within the budget, one option for each listing, never
    worse than the cut alone, gap against the same upper bound."""
    from rateweave.operators import budget

    curve = cut_lineage(_curve(spark, sf_dir))
    sel, s = budget.select_with_budget(curve, max_avg_pct=budget.DEFAULT_MAX_AVG_PCT, refine=True)
    _, plain = budget.select_with_budget(curve, max_avg_pct=budget.DEFAULT_MAX_AVG_PCT)
    return sel.agg(F.count(F.lit(1)).alias("listings"), F.count_distinct("listing_id").alias("distinct_listings")).select(
        "*", F.lit(s["used_cost"] <= s["budget"] + 1e-6).alias("within_budget"),
        F.lit(s["objective"] >= plain["objective"]).alias("never_worse"), F.lit(s["gap"] <= plain["gap"] + 1e-9).alias("gap_not_larger"))


def q_f10_budget_summary(spark, sf_dir):
    from rateweave.operators import budget

    _, s = budget.select_with_budget(_curve(spark, sf_dir), max_avg_pct=budget.DEFAULT_MAX_AVG_PCT)
    return round_doubles(budget.budget_summary_frame(spark, s))


# ------------------------------------------------------------------ E (rows-only: fitted models)

#: Not inputs of a model: ids, and the price as text.
MODEL_EXCLUDE = ["listing_id", "host_id", "raw_price"]


def _train_test(spark, sf_dir):
    data = clean.drop_leakage(features.demand_score(L(spark, sf_dir)))
    return encoders.split(data)


def q_e01_linear_single(spark, sf_dir):
    from rateweave.operators import models

    train, test = _train_test(spark, sf_dir)
    m = models.fit_simple_linear(train, "number_of_reviews")
    return round_doubles(models.regression_metrics(m.transform(test.filter(F.col("number_of_reviews").isNotNull()))))


def q_h3_training(spark, sf_dir):
    from rateweave.operators import models

    train, test = _train_test(spark, sf_dir)
    train, test = cut_lineage(train), cut_lineage(test)
    fitted = models.train_models(train, ("linear", "ridge", "forest", "gbt"),
                                 *encoders.feature_columns(train, exclude=MODEL_EXCLUDE))
    cmp = models.compare_models(fitted, test)
    best = models.select_best(cmp).scalar()
    return cmp.withColumn("is_best", F.col("model") == best).drop("_order")


def _model(spark, sf_dir, kind="forest"):
    from rateweave.operators import models

    train, _ = _train_test(spark, sf_dir)
    train = cut_lineage(train)
    return models.fit_model(train, kind, *encoders.feature_columns(train, exclude=MODEL_EXCLUDE))


def _two_feature_fit(spark, sf_dir, kind):
    """Coefficients on price and number of reviews, scaled by the population's deviation."""
    from rateweave.operators import models

    train, _ = _train_test(spark, sf_dir)
    m = models.fit_model(cut_lineage(train.select("listing_id", "price", "number_of_reviews", "demand_score")), kind,
                         ["price", "number_of_reviews"], [])
    lr = m.stages[-1]
    rows = [("price", float(lr.coefficients[0])), ("number_of_reviews", float(lr.coefficients[1])),
            ("intercept", float(lr.intercept))]
    return round_doubles(spark.createDataFrame(rows, "term string, value double"), 4)


def q_e01_linear_two(spark, sf_dir):
    return _two_feature_fit(spark, sf_dir, "linear")


def q_e02_ridge_two(spark, sf_dir):
    return _two_feature_fit(spark, sf_dir, "ridge")


def q_d18_scaled(spark, sf_dir):
    """Scaled numeric inputs of the test side, as the fitted preprocessor gives them."""
    from pyspark.ml.functions import vector_to_array

    train, test = _train_test(spark, sf_dir)
    cols = ["price", "number_of_reviews", "minimum_nights"]
    train, test = (cut_lineage(t.select("listing_id", *cols, "demand_score")) for t in (train, test))
    prep = encoders.build_preprocessor(cols, []).fit(train)
    x = vector_to_array("features")
    return round_doubles(prep.transform(test).select("listing_id", *[x[i].alias(c) for i, c in enumerate(cols)]))


def q_d18_scaled_odd_values(spark, sf_dir):
    """The same with gaps, NaN, infinities and a column without values: exact medians fill them."""
    from pyspark.ml.functions import vector_to_array

    cols = ["price", "minimum_nights", "nothing"]
    train, test = encoders.split(cut_lineage(_with_odd_values(once(spark, sf_dir)).select("listing_id", *cols)))
    prep = encoders.build_preprocessor(cols, []).fit(train)
    x = vector_to_array("features")
    return round_doubles(prep.transform(test).select("listing_id", *[x[i].alias(c) for i, c in enumerate(cols)]))


def q_d12_stage_in_a_pipeline(spark, sf_dir):
    """The feature stage, saved and loaded inside a pipeline, on listings with and without room types."""
    from pyspark.ml import Pipeline

    from rateweave.operators.stages import ListingFeatures

    lst = once(spark, sf_dir)
    path = _scratch(spark, "stage")
    io.save_model(Pipeline(stages=[ListingFeatures()]).fit(lst), path)
    stage = io.load_model(path)
    whole = stage.transform(lst).select("listing_id", "price_log", "price_per_minimum_night", "room_type_neighbourhood")
    bare = stage.transform(lst.drop("room_type"))
    return round_doubles(whole.join(bare.select("listing_id", F.col("price_log").alias("bare_price_log"), F.lit(
        "room_type_neighbourhood" in bare.columns).alias("bare_has_area")), "listing_id"))


def q_e05_grid_search(spark, sf_dir):
    """One row for each grid point and fold: its rows, and whether the score is what the written
    predictions give and the best point has the largest mean score."""
    from rateweave.operators import models

    train, _ = _train_test(spark, sf_dir)
    train = cut_lineage(train)
    points, predictions, scores = models.grid_search(train, "forest", *encoders.feature_columns(train, exclude=MODEL_EXCLUDE),
                                                     grid={"numTrees": [5, 8], "maxDepth": [2, 5]}, subset_rows=1000)
    scores = cut_lineage(scores)
    d, p = F.col("demand_score"), F.col("prediction")
    again = predictions.groupBy("point", "fold").agg(
        (1 - F.avg((d - p) * (d - p)) / F.var_pop(d)).alias("again"), F.count_distinct("listing_id").alias("listings"))
    top = scores.groupBy("point").agg(F.avg("r2").alias("m")).orderBy(F.desc("m"), "point").first()["point"]
    return scores.join(again, ["point", "fold"]).select(
        "point", "fold", "rows", "listings", (F.abs(F.col("r2") - F.col("again")) < 1e-9).alias("r2_from_predictions"),
        F.lit(top == models.best_point(scores)).alias("best_has_the_top_mean"),
        F.lit(points[0] == {"numTrees": 5, "maxDepth": 2}).alias("first_point"))


def q_e03_forest_facts(spark, sf_dir):
    """What must hold of a forest: its trees, means of training labels as predictions, an error below
    that of the mean."""
    from rateweave.operators import models

    train, test = (cut_lineage(t) for t in _train_test(spark, sf_dir))
    m = models.fit_model(train, "forest", *encoders.feature_columns(train, exclude=MODEL_EXCLUDE),
                         params={"numTrees": 12, "maxDepth": 6})
    lo, hi = train.agg(F.min("demand_score"), F.max("demand_score")).first()
    forest = m.stages[-1]
    d, p = F.col("demand_score"), F.col("prediction")
    return m.transform(test).agg(
        F.count(p).alias("predicted"), F.bool_and(p.between(lo - 1e-9, hi + 1e-9)).alias("within_labels"),
        (F.avg((d - p) * (d - p)) < F.var_pop(d)).alias("error_below_that_of_the_mean")).select(
        "*", F.lit(forest.getNumTrees).alias("trees"), F.lit(max(t.depth for t in forest.trees) <= 6).alias("depth_kept"),
        F.lit(abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9).alias("importances_sum_to_one"))


def q_e04_staged_losses(spark, sf_dir):
    """Losses by round of boosting: the training loss never rises, the last one is that of the model's
    own predictions, and the best round has the least loss on the rows held out."""
    from rateweave.operators import models

    train, test = (cut_lineage(t) for t in _train_test(spark, sf_dir))
    m = models.fit_model(train, "gbt", *encoders.feature_columns(train, exclude=MODEL_EXCLUDE),
                         params={"maxIter": 12, "maxDepth": 3})
    losses = cut_lineage(models.staged_losses(m, train, test))
    rows = losses.orderBy("round").collect()
    d, p = F.col("demand_score"), F.col("prediction")
    own = [m.transform(t).agg(F.avg((d - p) * (d - p))).first()[0] for t in (train, test)]
    best = [r["round"] for r in rows if r["is_best"]]
    return losses.agg(F.count(F.lit(1)).alias("rounds")).select(
        "rounds", F.lit(train.count()).alias("train_rows"), F.lit(test.count()).alias("validation_rows"),
        F.lit(all(b["train_loss"] <= a["train_loss"] + 1e-12 for a, b in zip(rows, rows[1:]))).alias("train_never_rises"),
        F.lit(abs(own[0] - rows[-1]["train_loss"]) < 1e-9 and abs(own[1] - rows[-1]["validation_loss"]) < 1e-9)
        .alias("last_is_the_models"),
        F.lit(best == [min(rows, key=lambda r: (r["validation_loss"], r["round"]))["round"]]).alias("best_has_the_least"))


def q_e10_training_log(spark, sf_dir):
    """The log that a training run wrote, beside the comparison that it made."""
    from rateweave.operators import models

    train, test = (cut_lineage(t) for t in _train_test(spark, sf_dir))
    path = _scratch(spark, "training")
    _, compared = models.train_and_log(train, test, ("linear", "ridge", "gbt"), ["price", "number_of_reviews",
                                       "minimum_nights", "service_fee"], [], path, params={"gbt": {"maxIter": 5}})
    said = compared.select(F.col("model").alias("run_name"), F.col("rmse").alias("e"), F.col("mae").alias("a"), F.col("r2").alias("r"))
    same = (F.col("rmse") == F.col("e")) & (F.col("mae") == F.col("a")) & (F.col("r2") == F.col("r"))
    return spark.read.parquet(path).join(said, "run_name").select(
        "run_name", F.col("params.train_rows").alias("train_rows"), F.col("params.test_rows").alias("test_rows"),
        F.col("params")["maxIter"].alias("max_iter"), same.alias("metrics_as_compared"), (F.col("duration_sec") > 0).alias("timed"))


def q_f04_static_once(spark, sf_dir):
    """The curve of a model whose static stages ran once per listing, against the whole pipeline on
    every candidate."""
    from rateweave.operators import models

    m = _model(spark, sf_dir, "ridge")
    lst = L(spark, sf_dir)
    own = models.model_curve(lst, m, clip=False)
    whole = m.transform(curves.explode_grid(lst, curves.price_grid("price", 15, 0.8, 1.2)).withColumn("price", F.col("candidate_price")))
    both = own.join(whole.select("listing_id", "option_id", F.col("prediction").alias("again")), ["listing_id", "option_id"])
    return both.groupBy("listing_id").agg(F.count(F.lit(1)).alias("options"), F.bool_and(
        F.abs(F.col("predicted_demand") - F.col("again")) <= 1e-6).alias("same"))


def q_h5_encoders(spark, sf_dir):
    """Indicator and frequency encoding, logarithms, fills and scaling of the test side."""
    lst = L(spark, sf_dir, "listing_id", "room_type", "neighbourhood_group", "price", "minimum_nights", "number_of_reviews",
            "reviews_per_month")
    train, test = encoders.split(lst)
    _, out = jobs.run_encoders(train, test, {"room_type": ["Hotel room", "Private room"]}, ["neighbourhood_group"],
                               ["price", "minimum_nights", "number_of_reviews", "reviews_per_month"])
    return round_doubles(out)


def q_e06_tuning_subset(spark, sf_dir):
    from rateweave.operators import models

    train, _ = encoders.split(L(spark, sf_dir, "listing_id"))
    return models.tuning_subset(train, 300)


def q_h3_training_facts(spark, sf_dir):
    """What must hold of a training run: models compared, metrics of the written predictions."""
    from rateweave.operators import models

    train, test = _train_test(spark, sf_dir)
    train, test = cut_lineage(train), cut_lineage(test)
    fitted = models.train_models(train, ("linear", "ridge", "forest", "gbt"),
                                 *encoders.feature_columns(train, exclude=MODEL_EXCLUDE),
                                 params={"forest": {"numTrees": 20, "maxDepth": 8}, "gbt": {"maxIter": 20}})
    cmp = cut_lineage(models.compare_models(fitted, test))
    pred = cut_lineage(fitted["forest"].transform(test).select("demand_score", "prediction"))
    err = F.col("demand_score") - F.col("prediction")
    again = pred.agg(F.sqrt(F.avg(err * err)).alias("e")).first()["e"]
    best = models.select_best(cmp).first()["best_model"]
    top = cmp.orderBy(F.desc("r2"), "_order").first()["model"]
    same = cmp.where("model = 'forest'").first()["rmse"]
    return cmp.agg(F.count(F.lit(1)).alias("models")).select(
        "models", F.lit(pred.count()).alias("test_rows"), F.lit(best == top).alias("best_has_the_top_r2"),
        F.lit(abs(same - again) < 1e-4).alias("metrics_recomputed"))


def q_e10_run_log(spark, sf_dir):
    """Two runs appended to a log and read back."""
    import time

    from rateweave.operators import models

    lst = once(spark, sf_dir)
    path = _scratch(spark, "runs")
    n = lst.count()
    for k in range(2):
        models.append_runs(spark, [models.run_record(f"run{k}", {"rows": n}, {"rmse": 1.0 + k, "mae": 0.5, "r2": 0.1}, time.time())],
                           path)
    return spark.read.parquet(path).select("run_name", F.col("params.rows").alias("rows"), "rmse", "mae", "r2",
                                           (F.col("duration_sec") >= 0).alias("timed"))


# ------------------------------------------------------------------ A: written, then read

def _scratch(spark, name: str) -> str:
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_a01_csv_scan(spark, sf_dir):
    """A CSV file with quotes, line breaks and other column places, read by the header's names."""
    lst = once(spark, sf_dir)
    path = _scratch(spark, "csv")
    lst.select(F.concat(F.lit('said "no", '), "room_type", F.lit("\nthen left")).alias("house rules"), F.col("price").alias("Price"),
               F.col("listing_id").alias("id"), F.col("instant_bookable")).write.option("header", True) \
        .option("escape", '"').option("quoteAll", True).csv(path)
    return round_doubles(io.read_listings(spark, path).select(
        "listing_id", "house_rules", io_price("price"), "instant_bookable"))


def q_a01_rejected_rows(spark, sf_dir):
    """A file of which some records lack a column, have one too many, or hold text that is no number:
    what is good and what is rejected, by reason, adds up."""
    k = F.col("listing_id")
    lst = once(spark, sf_dir)
    line = F.concat_ws(",", F.when(k % 10 == 1, F.concat(F.lit("x"), k)).otherwise(k.cast("string")),
                       F.lit('"a ""quoted"", text"'), F.when(k % 10 == 2, "three").otherwise(F.col("minimum_nights").cast("string")))
    line = F.when(k % 10 == 3, F.concat(line, F.lit(",more"))).when(k % 10 == 4, k.cast("string")).otherwise(line)
    path = _scratch(spark, "rejects")
    head = spark.createDataFrame([("id,NAME,minimum nights",)], "line string")
    for part, rows in enumerate((lst.where("listing_id % 2 = 0"), lst.where("listing_id % 2 = 1"))):
        file = f"{path}/{part}"
        lines = rows.select(F.struct(F.lit(1).alias("o"), k, line.alias("line")).alias("r")).unionByName(
            head.select(F.struct(F.lit(0).alias("o"), F.lit(0).cast("long").alias("listing_id"), "line").alias("r")))
        lines.repartition(1).sortWithinPartitions("r").select("r.line").write.text(file)
    good, rejected = io.split_listings(spark, [f"{path}/0", f"{path}/1"])
    kinds = rejected.select(F.concat_ws(";", F.transform("reasons", lambda r: F.regexp_replace(r, "'.*'", "it"))).alias("said"))
    return kinds.unionByName(good.select(F.when((F.col("name") == 'a "quoted", text') & F.col("listing_id").isNotNull(), "good")
                                         .otherwise("wrong").alias("said"))).groupBy("said").agg(F.count(F.lit(1)).alias("records"))


def io_price(c):
    return parse_money(c).alias("price")


def q_a02_a03_first_path_or_frame(spark, sf_dir):
    """The first path that is there; a frame is taken as it is."""
    lst = once(spark, sf_dir)
    path = _scratch(spark, "listings") + ".parquet"
    lst.select("listing_id", "price").write.parquet(path)
    found = io.read_listings(spark, io.resolve_first(spark, [path + ".missing", path]))
    return round_doubles(io.read_listings(spark, found))


def q_a04_report_csv(spark, sf_dir):
    path = _scratch(spark, "report")
    report_ = jobs.inference_job(L(spark, sf_dir))
    io.write_report(report_, path)
    return round_doubles(spark.read.option("header", True).schema(report_.schema).option("escape", '"').csv(path))


def q_a05_summary_json(spark, sf_dir):
    path = _scratch(spark, "summary")
    io.write_summary(report.inference_summary(_report(spark, sf_dir)), path)
    kept = ["total_listings", "increase_count", "decrease_count", "keep_count", "total_expected_improvement",
            "average_expected_improvement", "max_expected_improvement", "min_expected_improvement"]
    return round_doubles(spark.read.json(path).select(*kept))


def q_a06_curve_parquet(spark, sf_dir):
    path = _scratch(spark, "curve")
    io.write_curve(_curve(spark, sf_dir), path, partition_by=["room_type"])
    return round_doubles(spark.read.parquet(path).select(*FULL_CURVE))


def q_a06_curve_by_listing(spark, sf_dir):
    """Recommendations from a curve that was laid out by listing."""
    import uuid

    name = f"curve_{uuid.uuid4().hex}"
    curve = io.write_curve_by_listing(_curve(spark, sf_dir), name, _scratch(spark, name), 8)
    return round_doubles(jobs.recommendation_job(curve, true_before=True, **ALL_RULES))


def q_a07_model_saved(spark, sf_dir):
    """A saved model predicts as the one that was saved."""
    path = _scratch(spark, "model")
    m = _model(spark, sf_dir, "linear")
    io.save_model(m, path)
    _, test = _train_test(spark, sf_dir)
    test = cut_lineage(test)
    a, b = (x.transform(test).select("listing_id", F.col("prediction").alias(n)) for x, n in ((m, "p"), (io.load_model(path), "q")))
    return a.join(b, "listing_id").agg(F.count(F.lit(1)).alias("rows"),
                                       F.bool_and(F.abs(F.col("p") - F.col("q")) < 1e-12).alias("same"))


FULL_CURVE = ["listing_id", "option_id", "current_price", "candidate_price", "predicted_demand", "expected_revenue",
              "price_change", "price_change_pct", "room_type", "neighbourhood_group", "competitor_avg_price"]


def q_e11_score(spark, sf_dir):
    from rateweave.operators import models

    return round_doubles(models.score(L(spark, sf_dir), _model(spark, sf_dir, "ridge")))


def q_h1_inference_model(spark, sf_dir):
    return round_doubles(jobs.inference_job(L(spark, sf_dir), model=_model(spark, sf_dir, "ridge")))


def q_f04_model_curve_recommendation(spark, sf_dir):
    from rateweave.operators import models

    curve = models.model_curve(L(spark, sf_dir), _model(spark, sf_dir, "forest"),
                               repartition=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return round_doubles(jobs.recommendation_job(curve, change_pct=constraints.MAX_CHANGE_PCT))


def q_f04_model_curve_facts(spark, sf_dir):
    """What must hold of a model's curve, whatever the model."""
    from rateweave.operators import models

    curve = models.model_curve(L(spark, sf_dir), _model(spark, sf_dir, "ridge"))
    per = curve.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n"), F.min("predicted_demand").alias("least"), F.bool_and(
        F.abs(F.col("expected_revenue") - F.col("candidate_price") * F.col("predicted_demand")) <= 1e-3).alias("product"))
    return per.agg(F.count(F.lit(1)).alias("listings"), F.sum("n").alias("options"),
                   F.bool_and(F.col("n") == 15).alias("all_fifteen"), F.bool_and(F.col("least") >= 0).alias("demand_not_negative"),
                   F.bool_and("product").alias("revenue_is_price_times_demand"))


def q_e11_score_facts(spark, sf_dir):
    from rateweave.operators import models

    scored = models.score(L(spark, sf_dir), _model(spark, sf_dir, "ridge"))
    return scored.agg(F.count(F.lit(1)).alias("listings"), F.count("predicted_demand_before").alias("predicted"), F.bool_and(
        F.col("predicted_revenue_before") == F.col("current_price") * F.col("predicted_demand_before")).alias("product"))


# ------------------------------------------------------------------ streaming H-1

def q_s01_stream_inference(spark, sf_dir):
    """H-1 through Structured Streaming: the listings derived from the tables are
    written as stream input under the checkpoint directory, consumed with an
    availableNow trigger, and the report sink is read back."""
    import uuid

    from rateweave.streaming.inference_stream import start_inference_stream

    root = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/stream-{uuid.uuid4().hex}"
    lst = L(spark, sf_dir)
    lst.repartition(4).write.mode("overwrite").parquet(f"{root}/in")
    ref = spark.read.parquet(f"{root}/in")
    q = start_inference_stream(spark, f"{root}/in", ref.schema, ref, f"{root}/out", f"{root}/ckpt", max_files=1)
    q.awaitTermination()
    return round_doubles(spark.read.parquet(f"{root}/out").drop("batch_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
