"""Feature and target columns (demand scores, engineered features, encoders, scalers).

Fitted statistics (min/max, means, frequencies) are computed with partial
aggregation and attached either as scalar subqueries (global statistics: one
row, size known) or as joins on the group key (AQE turns them into broadcast
joins when the measured size is small, skew-split sort-merge joins otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import (
    availability_bucket,
    finite_or_null,
    log1p_clip,
    safe_div,
)
from rateweave.operators.joins import attach_stats

# Fixed weights and fills of the composite demand score.
DEMAND_WEIGHTS = (0.5, 0.3, 0.2)
MINMAX_EPS = 1e-8
DAYS_PER_YEAR = 365.0


def minmax_expr(c: Column, lo: Column, hi: Column, eps: float = MINMAX_EPS) -> Column:
    """(x - min) / (max - min + eps)."""
    return (c - lo) / (hi - lo + F.lit(eps))


def minmax(df: DataFrame, c: str, out: str | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """D-3: min-max normalisation with statistics of ``fit_on`` (default: df itself)."""
    src = fit_on if fit_on is not None else df
    stats = src.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
    return (df.withColumn("_mm", stats)
              .withColumn(out or f"{c}_minmax", minmax_expr(F.col(c), F.col("_mm.lo"), F.col("_mm.hi")))
              .drop("_mm"))


def demand_score(df: DataFrame, out: str = "demand_score", weights: Sequence[float] = DEMAND_WEIGHTS,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """D-2: w0*minmax(rpm) + w1*minmax(reviews) + w2*(1 - availability/365).

    Missing rpm and reviews count as 0, missing availability as 365.  The
    min/max come from one global aggregate over ``fit_on`` (the whole frame by
    default), evaluated once as a scalar subquery."""
    w0, w1, w2 = (float(w) for w in weights)
    rpm = F.coalesce(F.col("reviews_per_month"), F.lit(0.0))
    nrev = F.coalesce(F.col("number_of_reviews"), F.lit(0.0))
    avail = F.coalesce(F.col("availability_365"), F.lit(DAYS_PER_YEAR))
    src = fit_on if fit_on is not None else df
    stats = src.agg(F.struct(
        F.min(rpm).alias("rpm_lo"), F.max(rpm).alias("rpm_hi"),
        F.min(nrev).alias("rev_lo"), F.max(nrev).alias("rev_hi"),
    )).scalar()
    df = df.withColumn("_dstats", stats)
    s = F.col("_dstats")
    score = (
        F.lit(w0) * minmax_expr(rpm, s["rpm_lo"], s["rpm_hi"])
        + F.lit(w1) * minmax_expr(nrev, s["rev_lo"], s["rev_hi"])
        + F.lit(w2) * (F.lit(1.0) - avail / F.lit(DAYS_PER_YEAR))
    )
    return df.withColumn(out, score).drop("_dstats")


def demand_extremes(df: DataFrame) -> DataFrame:
    """The smallest and largest values that ``demand_score`` needs of ``fit_on``, computed now:
    two rows on the driver that stand for the whole frame."""
    s = df.agg(*[f(F.coalesce(F.col(c), F.lit(0.0))).alias(f"{c}_{k}") for c in ("reviews_per_month", "number_of_reviews")
                 for k, f in (("lo", F.min), ("hi", F.max))]).first()
    rows = [(s[f"reviews_per_month_{k}"], s[f"number_of_reviews_{k}"], None) for k in ("lo", "hi")]
    return df.sparkSession.createDataFrame(rows, "reviews_per_month double, number_of_reviews double, availability_365 double")


def demand_ratio(df: DataFrame, out: str = "demand_score") -> DataFrame:
    """D-1: reviews_per_month / (availability_365 + 1)."""
    return df.withColumn(out, safe_div(F.col("reviews_per_month"), F.col("availability_365") + F.lit(1.0)))


def review_intensity() -> Column:
    """D-4."""
    return safe_div(F.col("reviews_per_month"), F.col("number_of_reviews") + F.lit(1.0))


def price_per_min_night(offset: float = 0.0) -> Column:
    """D-6: price / (minimum_nights + offset); division by zero -> NULL."""
    den = F.col("minimum_nights") + F.lit(float(offset)) if offset else F.col("minimum_nights")
    return safe_div(F.col("price"), den)


def room_area_cross(null_text: str | None = None) -> Column:
    """D-9: room_type + '_' + neighbourhood_group.

    ``null_text=None`` propagates NULL (batch form); a string replaces missing
    parts with it (the pipeline form writes 'nan')."""
    rt, ng = F.col("room_type"), F.col("neighbourhood_group")
    if null_text is None:
        return F.concat(rt, F.lit("_"), ng)
    return F.concat(F.coalesce(rt, F.lit(null_text)), F.lit("_"), F.coalesce(ng, F.lit(null_text)))


def target_mean(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """D-8: mean of ``value`` per ``key`` mapped back to each row; NULL key -> NULL."""
    means = df.groupBy(key).agg(F.avg(value).alias(out)).filter(F.col(key).isNotNull())
    return attach_stats(df, means, key)


def engineer_batch(df: DataFrame) -> DataFrame:
    """H-4 feature block (batch form): ratio demand, intensity, bucket, price
    features, area demand mean, crosses and interactions."""
    out = demand_ratio(df)
    out = (out
           .withColumn("review_intensity", review_intensity())
           .withColumn("availability_bucket", availability_bucket())
           .withColumn("price_per_minimum_night", price_per_min_night(0.0))
           .withColumn("price_log", log1p_clip("price", clip=False)))
    out = target_mean(out, "neighbourhood_group", "demand_score", "neighbourhood_group_demand_avg")
    return (out
            .withColumn("room_type_neighbourhood", room_area_cross(None))
            .withColumn("price_review_interaction", F.col("price") * F.col("reviews_per_month"))
            .withColumn("availability_min_nights", F.col("availability_365") * F.col("minimum_nights")))


def engineer_model_features(df: DataFrame) -> DataFrame:
    """D-12 in expression form: price features recomputed from ``price`` (used on
    every candidate price of a curve).  Absent inputs are skipped."""
    cols = set(df.columns)
    out = df
    if "price" in cols:
        out = out.withColumn("price_log", log1p_clip("price", clip=True))
    if {"price", "minimum_nights"} <= cols:
        out = out.withColumn("price_per_minimum_night", price_per_min_night(1.0))
    if {"room_type", "neighbourhood_group"} <= cols:
        out = out.withColumn("room_type_neighbourhood", room_area_cross("nan"))
    return out


def null_non_finite(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """B-13: NaN / ±inf -> NULL on the given (default: all floating) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.select(*[finite_or_null(c).alias(c) if c in cols else F.col(c) for c in df.columns])


