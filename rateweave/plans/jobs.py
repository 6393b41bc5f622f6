"""End-to-end jobs, each a lazy DataFrame chain ending in one action/write.

H-1 inference      : input contract -> demand (model or target) -> closed-form best price -> report
H-2 recommendation : demand curve -> rules -> one option per listing -> business table + summary
H-3 training       : target -> split -> preprocess -> fit/compare regressors -> best
H-4 batch cleaning : clean + engineer
H-5 encoders/scaler: standalone fit/transform of the preprocessing parts
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import DEFAULT_ELASTICITY
from rateweave.operators import clean, constraints, curves, features, report, select
from rateweave.operators.curves import CURVE_HI, CURVE_LO, CURVE_POINTS


def prediction_frame(df: DataFrame, demand: str = "demand_score", key: str = "listing_id",
                     price: str = "price", carry: list[str] | None = None) -> DataFrame:
    """E-11 output shape: id, current price, demand before, revenue before = price × demand
    (plus ``carry`` columns riding along, e.g. a per-listing elasticity)."""
    return df.select(*(carry or []),
        F.col(key).alias("listing_id"),
        F.col(price).alias("current_price"),
        F.col(demand).alias("predicted_demand_before"),
        (F.col(price) * F.col(demand)).alias("predicted_revenue_before"),
        *[c for c in df.columns if c not in (key, price, demand, "listing_id", "current_price")
          and c in ("room_type", "neighbourhood_group", "competitor_avg_price")],
    )


def target_inference_input(listings: DataFrame) -> DataFrame:
    """Inference input with the demand target standing in for a fitted model:
    B-1..B-4 contract, then D-2 composite demand over the filled input."""
    prepared = clean.prepare_inference_input(listings)
    return features.demand_score(prepared)


def inference_job(listings: DataFrame, model=None, elasticity: float | str = DEFAULT_ELASTICITY,
                  n: int = 10, lo_f: float = 0.7, hi_f: float = 1.3) -> DataFrame:
    """H-1: returns the 10-column report.  With ``model`` (a fitted PipelineModel
    whose output column is ``prediction``) demand comes from the model; else from
    the demand target.  No shuffle after the model/target stage."""
    if model is not None:
        from rateweave.operators.models import score

        pred = score(clean.prepare_inference_input(listings), model)
    else:
        pred = prediction_frame(target_inference_input(listings))
    best = select.best_price_elastic(pred, n=n, lo_f=lo_f, hi_f=hi_f, elasticity=elasticity)
    return report.build_report(best)


def target_curve(listings: DataFrame, n: int = CURVE_POINTS, lo_f: float = CURVE_LO, hi_f: float = CURVE_HI,
                 elasticity: float = DEFAULT_ELASTICITY) -> DataFrame:
    """Demand curve without a fitted model: the demand target at the current price
    scaled by the elasticity rule at each bounded, rounded candidate price.
    Columns follow F-4 plus option_id and the listing attributes."""
    base = features.demand_score(listings).select(
        "listing_id", F.col("price").alias("current_price"), F.col("demand_score").alias("_base"),
        "room_type", "neighbourhood_group", "competitor_avg_price")
    grid = curves.price_grid("current_price", n, lo_f, hi_f)
    cur = curves.explode_grid(base, grid)
    from rateweave.functions.exprs import elastic_demand

    cur = cur.withColumn("predicted_demand", elastic_demand("_base", "current_price", "candidate_price", elasticity))
    cur = curves.curve_columns(cur).drop("_base")
    return cur.select("listing_id", "option_id", "current_price", "candidate_price", "predicted_demand",
                      "expected_revenue", "price_change", "price_change_pct", "room_type",
                      "neighbourhood_group", "competitor_avg_price")


def recommendation_job(curve: DataFrame, change_pct: float | None = None, area_pct: float | None = None,
                       room_band: bool = False, hierarchy: bool = False,
                       competitor_factor: float | None = None, bounds: tuple | None = None,
                       on_infeasible: str = "report", true_before: bool = False) -> DataFrame:
    """H-2: rules as flags -> one option per feasible listing -> business table.

    Rules are evaluated side by side on the whole curve and selection is one
    aggregation over listing id.  Listings left without an allowed option drop
    out of the table (``on_infeasible="report"``; list them with
    ``select.select_best_option(..., feasible=...)``) or fail the job
    (``on_infeasible="error"``, the solver's behaviour).  ``true_before`` takes the demand before
    from the listing's curve point nearest its current price (ties to the lower option, rules
    don't matter), found in the same aggregation."""
    if on_infeasible not in ("report", "error"):
        raise ValueError("on_infeasible must be 'report' or 'error'")
    flagged = constraints.apply_rules(curve, change_pct=change_pct, area_pct=area_pct, room_band=room_band,
                                      hierarchy=hierarchy, competitor_factor=competitor_factor, bounds=bounds)
    nearest = report.NEAREST if true_before else None
    sel = select.optimize_curve(flagged, feasible="feasible", nearest=nearest)
    if on_infeasible == "error":
        select.require_feasible(sel)
    return report.build_recommendations(sel.filter(F.col("feasible")).drop("feasible"), true_before=nearest)


# ---------------------------------------------------------------- runnable jobs (inputs -> sinks)

def run_inference(spark, source, out_dir: str, model_path: str | None = None,
                  elasticity: float | str = DEFAULT_ELASTICITY) -> dict:
    """H-1 end to end: listing input (path, list of candidate paths, or DataFrame)
    -> report CSV + summary JSON under ``out_dir``.  The report is written once and
    the summary is computed from the written table."""
    from rateweave.sources import io

    if isinstance(source, (list, tuple)):
        source = io.resolve_first(spark, list(source))
    listings = io.read_listings(spark, source)
    model = io.load_model(model_path) if model_path else None
    rep = inference_job(listings, model=model, elasticity=elasticity)
    out = out_dir.rstrip("/")
    io.write_report(rep, f"{out}/price_recommendations", fmt="parquet")
    written = spark.read.parquet(f"{out}/price_recommendations")
    io.write_report(written, f"{out}/price_recommendations_csv")
    summary = report.inference_summary(written)
    io.write_summary(summary, f"{out}/inference_summary")
    return summary.first().asDict()


def run_recommendation(spark, listings: DataFrame, out_dir: str, model=None, max_avg_pct: float | None = None,
                       on_infeasible: str = "report", true_before: bool = False, **rules) -> dict:
    """H-2 end to end: curve (model or target) -> rules -> selection (or budgeted
    selection) -> business table CSV + summary JSONs + curve Parquet.

    Rows of one listing id are one listing, with a model, a budget or neither.  Bounds may name
    columns of the listings.
    The rules are the same with and without a budget, and so is ``on_infeasible``; the
    budget's N counts every listing of the curve.  Summaries are read from what was written."""
    from rateweave.operators import budget as budget_op
    from rateweave.plans import options
    from rateweave.session import cut_lineage, intermediates
    from rateweave.sources import io

    if on_infeasible not in ("report", "error"):
        raise ValueError("on_infeasible must be 'report' or 'error'")
    out = out_dir.rstrip("/")
    extra: dict = {}
    carry = options.bound_columns(rules.get("bounds"))
    nearest = report.NEAREST if true_before else None
    with intermediates(spark):
        rows = None
        if model is not None:
            from rateweave.operators.models import model_curve

            io.write_curve(model_curve(listings, model, carry=carry), f"{out}/demand_price_curve")
        else:
            rows = cut_lineage(options.with_options(listings, carry=carry))
            io.write_curve(options.explode_options(rows), f"{out}/demand_price_curve")
        curve = spark.read.parquet(f"{out}/demand_price_curve")
        if max_avg_pct is not None:
            sel, extra = budget_op.select_with_budget(constraints.apply_rules(curve, **rules), max_avg_pct,
                                                      feasible="feasible")
            if on_infeasible == "error" and (extra["num_infeasible"] or extra["status"] == "infeasible"):
                raise RuntimeError("No feasible price option for at least one listing.")
            sel = select.selection_reason(select.selection_metrics(sel.withColumnRenamed("candidate_price",
                                                                                         "recommended_price")))
            if nearest:
                sel = sel.join(select.nearest_demand(curve, nearest), "listing_id", "left")
        else:
            sel = options.optimize(rows, nearest, **rules) if rows is not None else select.optimize_curve(
                constraints.apply_rules(curve, **rules), feasible="feasible", nearest=nearest)
            if on_infeasible == "error":
                select.require_feasible(sel)
            sel = sel.filter(F.col("feasible")).drop("feasible")
        io.write_curve(sel, f"{out}/selection")
        sel = spark.read.parquet(f"{out}/selection")
        recs = report.build_recommendations(sel, true_before=nearest)
        io.write_report(recs, f"{out}/price_recommendations")
        flags = {"avg_price_change": max_avg_pct is not None, "neighborhood": rules.get("area_pct") is not None,
                 "room_type": bool(rules.get("room_band"))}
        io.write_summary(report.selection_summary(curve, sel, flags), f"{out}/selection_summary")
    written = spark.read.option("header", True).schema(recs.schema).csv(f"{out}/price_recommendations")
    summary = report.recommendation_summary(written)
    io.write_summary(summary, f"{out}/optimization_summary")
    result = summary.first().asDict()
    result["budget"] = extra
    result["rows_written"] = result["num_recommendations"]
    return result


def run_profile(spark, df: DataFrame, out_dir: str) -> None:
    """C-6 + A-5: nested profile document as JSON."""
    from rateweave.operators import profile
    from rateweave.sources import io

    io.write_summary(profile.data_summary(df), f"{out_dir.rstrip('/')}/data_summary")


def run_clean_and_engineer(df: DataFrame, out_path: str) -> DataFrame:
    """H-4: clean, engineer, write the feature table (A-6)."""
    from rateweave.sources import io

    out = features.engineer_batch(clean.clean_batch(df))
    io.write_curve(out, out_path)
    return out


# Fixed: columns whose long tail is taken as a logarithm before they are scaled.
LOG_COLUMNS = ["price", "minimum_nights", "number_of_reviews"]


def run_encoders(train: DataFrame, test: DataFrame, one_hot_cols, freq_cols, scale_cols=None,
                 label: str = "demand_score"):
    """H-5: one-hot and frequency encoding, logarithms, non-finite and missing values to the
    train median, and population-std scaling, all fit on train and applied to both sides.

    ``one_hot_cols`` maps a column to its list of values (indicator columns), or names columns
    (a sparse vector over the values of train, at any number of them).  ``scale_cols`` default
    to the numeric columns by type without the label."""
    from rateweave.functions.exprs import log1p_clip
    from rateweave.operators import encoders
    from rateweave.operators.profile import numeric_columns

    listed = dict(one_hot_cols) if isinstance(one_hot_cols, dict) else {}
    for c in one_hot_cols:
        if c in listed:
            train, test = encoders.one_hot(train, c, listed[c]), encoders.one_hot(test, c, listed[c])
        else:
            table = encoders.category_table(train, c)
            train, test = encoders.one_hot_vector(train, c, table), encoders.one_hot_vector(test, c, table)
    for c in freq_cols:
        f = encoders.fit_frequency(train, c)
        train = encoders.apply_frequency(train, f, c, unseen_zero=False, replace=True)
        test = encoders.apply_frequency(test, f, c, unseen_zero=True, replace=True)
    logs = {c: log1p_clip(F.col(c).cast("double")) for c in LOG_COLUMNS if c in train.columns}
    train, test = train.withColumns(logs), test.withColumns(logs)
    cols = list(scale_cols) if scale_cols is not None else numeric_columns(train, exclude=[label])
    fills = encoders.fit_median_imputer(train, cols)
    train, test = fills.apply_fill(train), fills.apply_fill(test)
    st = encoders.fit_std_scaler(train, cols)
    return encoders.apply_std_scaler(train, st, cols), encoders.apply_std_scaler(test, st, cols)
