"""Labels, explanations, report tables and KPI summaries.

Labels and texts are ``when`` chains; summaries are single global
aggregations (partial aggregation, one output row) so they cost one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import KEEP_THRESHOLD, fmt2, lit_double

# Fixed label values and explanation texts of the reports.
INCREASE, DECREASE, KEEP = "increase", "decrease", "keep"
ACTION_UP, ACTION_DOWN, ACTION_KEEP = "Increase Price", "Decrease Price", "Keep Price"
TXT_INCREASE_GAIN = "Increase price because expected revenue improves by {} while demand remains acceptable."
TXT_INCREASE_OTHER = "Increase price due to optimization output."
TXT_DECREASE_GAIN = "Decrease price because lower price is expected to raise demand and improve revenue by {}."
TXT_DECREASE_OTHER = "Decrease price due to optimization output."
TXT_KEEP = "Keep current price because expected improvement is small and current price is already near optimal."
BIZ_LOWER = "Lower price is expected to increase demand and improve occupancy."
BIZ_HIGHER = "Higher price is expected to improve revenue with acceptable demand loss."
BIZ_CLOSE = "Current price appears close to the best feasible price."
BIZ_CONSTRAINED = "Recommendation is constrained by business rules or limited feasible options."
BIZ_DEFAULT = "Selected as the best feasible price under the optimization model."
BIZ_EPS = 1e-6

REPORT_COLUMNS = [
    "listing_id", "current_price", "optimized_price", "predicted_demand_before", "predicted_revenue_before",
    "predicted_demand_after", "predicted_revenue_after", "expected_improvement", "recommendation", "reason",
]
DASHBOARD_COLUMNS = ["listing_id", "current_price", "optimized_price", "expected_improvement",
                     "recommendation", "reason"]
RECOMMENDATION_TAIL = [
    "price_action", "predicted_demand_before", "predicted_demand_after", "expected_revenue_before",
    "expected_revenue_after", "expected_revenue_change", "price_change", "price_change_pct", "reason",
]


def _fill(template: str, value) -> F.Column:
    head, tail = template.split("{}")
    return F.concat(F.lit(head), fmt2(value), F.lit(tail))


def recommend(df: DataFrame, keep: float = KEEP_THRESHOLD, out: str = "recommendation") -> DataFrame:
    """G-1: change ratio above +keep -> increase, below -keep -> decrease, else keep; current 0 -> keep."""
    cur, opt = F.col("current_price"), F.col("optimized_price")
    ratio = F.try_divide(opt - cur, cur)
    label = (F.when(cur == 0, KEEP)
              .when(ratio > lit_double(keep), INCREASE)
              .when(ratio < lit_double(-keep), DECREASE)
              .otherwise(KEEP))
    return df.withColumn(out, label)


def report_reason(df: DataFrame, out: str = "reason") -> DataFrame:
    """G-2: explanation text with the improvement in two decimals."""
    rec, imp = F.col("recommendation"), F.col("expected_improvement")
    txt = (F.when((rec == INCREASE) & (F.col("predicted_revenue_after") > F.col("predicted_revenue_before")),
                  _fill(TXT_INCREASE_GAIN, imp))
            .when(rec == INCREASE, F.lit(TXT_INCREASE_OTHER))
            .when((rec == DECREASE) & (F.col("predicted_demand_after") > F.col("predicted_demand_before")),
                  _fill(TXT_DECREASE_GAIN, imp))
            .when(rec == DECREASE, F.lit(TXT_DECREASE_OTHER))
            .otherwise(F.lit(TXT_KEEP)))
    return df.withColumn(out, txt)


def build_report(df: DataFrame, keep: float = KEEP_THRESHOLD) -> DataFrame:
    """G-6: recommendation + reason + fixed 10-column projection (B-17)."""
    return report_reason(recommend(df, keep)).select(*REPORT_COLUMNS)


def price_action(df: DataFrame, out: str = "price_action") -> DataFrame:
    """G-3."""
    pc = F.col("price_change")
    return df.withColumn(out, F.when(pc > 0, ACTION_UP).when(pc < 0, ACTION_DOWN).otherwise(ACTION_KEEP))


#: Column of a selection: demand at the listing's curve point nearest its current price.
NEAREST = "demand_at_current"


def business_reason(df: DataFrame, out: str = "reason") -> DataFrame:
    """G-4: ordered business explanation rules."""
    cur, rec = F.col("current_price"), F.col("recommended_price")
    dchg = F.col("predicted_demand_after") > F.col("predicted_demand_before")
    rc = F.col("expected_revenue_change")
    txt = (F.when((rec < cur) & dchg, BIZ_LOWER)
            .when((rec > cur) & (rc > 0), BIZ_HIGHER)
            .when(F.abs(rec - cur) < F.lit(BIZ_EPS), BIZ_CLOSE)
            .when(rc <= 0, BIZ_CONSTRAINED)
            .otherwise(BIZ_DEFAULT))
    return df.withColumn(out, txt)


def build_recommendations(sel: DataFrame, true_before: str | None = None) -> DataFrame:
    """G-7: business table from a selection.  Before and after demand are the selected
    option's demand, as the selection carries no baseline of its own; ``true_before`` names a
    column with the demand at the current price to use instead, such as ``NEAREST``: the demand at
    the curve point nearest the current price, which selections add on demand."""
    d = (sel.withColumn("predicted_demand_before", F.col(true_before or "predicted_demand"))
            .withColumn("predicted_demand_after", F.col("predicted_demand"))
            .withColumn("expected_revenue_before", F.col("current_price") * F.col("predicted_demand_before"))
            .withColumn("expected_revenue_after", F.col("recommended_price") * F.col("predicted_demand_after"))
            .withColumn("expected_revenue_change",
                        F.col("expected_revenue_after") - F.col("expected_revenue_before")))
    d = business_reason(price_action(d))
    optional = [c for c in ("room_type", "neighbourhood_group") if c in d.columns]
    return d.select("listing_id", "current_price", "recommended_price", *optional, *RECOMMENDATION_TAIL)


def inference_summary(report: DataFrame) -> DataFrame:
    """G-8: one row of counts by label and improvement statistics."""
    rec, imp = F.col("recommendation"), F.col("expected_improvement")
    return report.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if(rec == INCREASE).alias("increase_count"),
        F.count_if(rec == DECREASE).alias("decrease_count"),
        F.count_if(rec == KEEP).alias("keep_count"),
        F.sum(imp).alias("total_expected_improvement"),
        F.avg(imp).alias("average_expected_improvement"),
        F.max(imp).alias("max_expected_improvement"),
        F.min(imp).alias("min_expected_improvement"),
    )


def recommendation_summary(recs: DataFrame) -> DataFrame:
    """G-9."""
    act = F.col("price_action")
    return recs.agg(
        F.count_distinct("listing_id").alias("num_listings"),
        F.count(F.lit(1)).alias("num_recommendations"),
        F.count_if(act == ACTION_UP).alias("increase_price_count"),
        F.count_if(act == ACTION_DOWN).alias("decrease_price_count"),
        F.count_if(act == ACTION_KEEP).alias("keep_price_count"),
        F.avg("price_change_pct").alias("average_price_change_pct"),
        F.sum("expected_revenue_before").alias("total_expected_revenue_before"),
        F.sum("expected_revenue_after").alias("total_expected_revenue_after"),
        F.sum("expected_revenue_change").alias("total_expected_revenue_change"),
    )


def selection_summary(curve: DataFrame, sel: DataFrame, flags: dict | None = None,
                      key: str = "listing_id", packed: str | None = None) -> DataFrame:
    """G-10: input rows / listings (curve) and totals of the selection, one row.  ``packed``
    names the array of options where a row of ``curve`` is a listing.

    Both sides are one-row global aggregates, combined as scalar subqueries."""
    flags = flags or {}
    rows = F.sum(F.size(packed).cast("long")) if packed else F.count(F.lit(1))
    listing = F.when(F.size(packed) > 0, F.col(key)) if packed else F.col(key)
    cin = curve.agg(F.struct(rows.alias("rows"), F.count_distinct(listing).alias("listings"))).scalar()
    out = sel.agg(
        F.count(F.lit(1)).alias("num_selected_rows"),
        F.sum("expected_revenue").alias("total_expected_revenue_after"),
        F.sum("current_revenue_estimate").alias("total_estimated_revenue_before"),
        F.sum("expected_revenue_change").alias("total_expected_revenue_change"),
        F.avg("price_change_pct").alias("average_price_change_pct"),
    )
    out = (out.withColumn("_cin", cin)
              .select(F.col("_cin.rows").alias("num_input_rows"), F.col("_cin.listings").alias("num_listings"),
                      *out.columns))
    return out.withColumn("optional_constraints", F.struct(
        F.lit(bool(flags.get("avg_price_change", False))).alias("avg_price_change_enabled"),
        F.lit(bool(flags.get("neighborhood", False))).alias("neighborhood_consistency_enabled"),
        F.lit(bool(flags.get("room_type", False))).alias("room_type_fairness_enabled"),
    ))


def dashboard_kpis(report: DataFrame) -> DataFrame:
    """G-11: rows, total gain, mean % price change (NULL when current = 0 skipped), % changed."""
    cur, opt = F.col("current_price"), F.col("optimized_price")
    return report.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.sum("expected_improvement").alias("revenue_increase"),
        (F.avg(F.try_divide(opt - cur, cur)) * F.lit(100.0)).alias("avg_price_change_pct"),
        (F.avg(F.when(F.col("recommendation") != KEEP, 1.0).otherwise(0.0)) * F.lit(100.0)).alias("pct_listings_changed"),
    )


def revenue_impact(report: DataFrame) -> DataFrame:
    """G-12: revenue before / after / gain and label counts, one row."""
    rec = F.col("recommendation")
    return report.agg(
        F.sum("predicted_revenue_before").alias("revenue_before"),
        F.sum("predicted_revenue_after").alias("revenue_after"),
        (F.sum("predicted_revenue_after") - F.sum("predicted_revenue_before")).alias("total_gain"),
        F.count(F.lit(1)).alias("total_listings"),
        F.count_if(rec == INCREASE).alias("increase_count"),
        F.count_if(rec == DECREASE).alias("decrease_count"),
        F.count_if(rec == KEEP).alias("keep_count"),
    )


def filter_recommendations(report: DataFrame, actions: Sequence[str] | None = None,
                           lo: float | None = None, hi: float | None = None) -> DataFrame:
    """B-16: label in ``actions`` and current price within [lo, hi] (inclusive).
    Defaults: every label, observed min/max (i.e. no restriction on non-NULL prices)."""
    out = report
    if actions is not None:
        out = out.filter(F.col("recommendation").isin(list(actions)))
    cur = F.col("current_price")
    if lo is None or hi is None:
        s = report.agg(F.struct(F.min("current_price").alias("lo"), F.max("current_price").alias("hi"))).scalar()
        out = out.withColumn("_rng", s)
        lo_c = F.col("_rng.lo") if lo is None else lit_double(lo)
        hi_c = F.col("_rng.hi") if hi is None else lit_double(hi)
        return out.filter(cur.between(lo_c, hi_c)).drop("_rng")
    return out.filter(cur.between(lit_double(lo), lit_double(hi)))


def dashboard_table(report: DataFrame) -> DataFrame:
    """B-17 dashboard projection."""
    return report.select(*DASHBOARD_COLUMNS)


def listing_row(report: DataFrame, listing_id) -> DataFrame:
    """B-18: first row of one listing (a pushed-down filter).  Of a repeated id that is the least row,
    column by column, NULL first; columns that have no order (maps) don't count."""
    found = report.filter(F.col("listing_id") == F.lit(listing_id))
    order = [f.name for f in report.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return found.orderBy(*order).limit(1)


def listing_insight(report: DataFrame, listing_id) -> DataFrame:
    """G-13: current price, optimised price and gain for one listing."""
    return listing_row(report, listing_id).select(
        "listing_id", "current_price", "optimized_price", F.col("expected_improvement").alias("revenue_gain"))
