"""Candidate price grids and demand curves.

Row-local grids are ``array(...)`` expressions unrolled at plan time (n is a
constant), so they stay inside whole-stage codegen; long curves use
``posexplode`` so the option number is the grid index.  The explode multiplies
rows by ``n`` (10-30); ``explode_grid(repartition=...)`` spreads few large input
files over more tasks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import (
    DEFAULT_ELASTICITY,
    col,
    elastic_demand,
    grid_point,
    lit_double,
    round_half_even_fp,
)

# Fixed grid settings: simulation curve, closed-form inference, explorer.
CURVE_POINTS, CURVE_LO, CURVE_HI = 15, 0.80, 1.20
INFERENCE_POINTS, INFERENCE_LO, INFERENCE_HI = 10, 0.7, 1.3
EXPLORER_POINTS = 30


def grid_bounds(price: Column, lo_f: float, hi_f: float, floor: float | None, min_span: float | None):
    lo = price * lit_double(lo_f)
    hi = price * lit_double(hi_f)
    if floor is not None:
        lo = F.greatest(lo, lit_double(floor))
    if min_span is not None:
        hi = F.greatest(hi, lo + lit_double(min_span))
    return lo, hi


def price_grid(price: str | Column, n: int, lo_f: float, hi_f: float, floor: float | None = 1.0,
               min_span: float | None = 1.0, scale: int | None = 2) -> Column:
    """F-1/F-2: array of n evenly spaced prices, ``lo + i*(hi-lo)/(n-1)``, last = hi.

    Bounded form (defaults): lo = max(p*lo_f, 1), hi = max(p*hi_f, lo + 1), 2 dp.
    ``floor=None, min_span=None, scale=None`` gives the unbounded, unrounded grid.
    A NULL price has no grid (NULL, which explodes to no rows)."""
    lo, hi = grid_bounds(col(price), lo_f, hi_f, floor, min_span)
    # n is a plan-time constant: the points are unrolled into one array(...)
    # expression (whole-stage codegen), not a per-row lambda.
    pts = [grid_point(lo, hi, i, n) for i in range(n)]
    if scale is not None:
        pts = [round_half_even_fp(p, scale) for p in pts]
    return F.when(col(price).isNotNull(), F.array(*pts))


def explode_grid(df: DataFrame, grid: Column, price_out: str = "candidate_price",
                 option_out: str = "option_id", repartition: int | None = None) -> DataFrame:
    """One row per (listing, candidate); option_id = 0-based grid position."""
    if repartition:
        df = df.repartition(repartition)
    return df.select("*", F.posexplode(grid).alias(option_out, price_out))


def elastic_curve(df: DataFrame, n: int = EXPLORER_POINTS, lo_f: float = INFERENCE_LO, hi_f: float = INFERENCE_HI,
                  elasticity: float | str = DEFAULT_ELASTICITY, price: str = "current_price",
                  base: str = "predicted_demand_before", floor_demand: bool = False) -> DataFrame:
    """F-5: elasticity curve for every listing (the explorer view: 30 points,
    ×0.7–1.3, demand = base·(p/current)^e, revenue = p·demand)."""
    g = price_grid(price, n, lo_f, hi_f, floor=None, min_span=None, scale=None)
    out = explode_grid(df, g)
    if floor_demand:
        dem = elastic_demand(base, price, "candidate_price", elasticity)
    else:
        e = col(elasticity) if isinstance(elasticity, str) else lit_double(elasticity)
        dem = F.col(base) * F.pow(F.try_divide(F.col("candidate_price"), F.col(price)), e)
    return (out.withColumn("predicted_demand", dem)
               .withColumn("expected_revenue", F.col("candidate_price") * F.col("predicted_demand")))


def curve_columns(df: DataFrame, current: str = "current_price", candidate: str = "candidate_price",
                  demand: str = "predicted_demand") -> DataFrame:
    """F-4 output columns: rounded current/candidate prices, demand (6 dp),
    revenue from unrounded demand (6 dp), change (2 dp), pct (4 dp, 0 when current = 0)."""
    cur, cand, dem = F.col(current), F.col(candidate), F.col(demand)
    pct = F.when(cur != 0, round_half_even_fp((cand - cur) / cur * F.lit(100.0), 4)).otherwise(F.lit(0.0))
    return (df
            .withColumn("expected_revenue", round_half_even_fp(cand * dem, 6))
            .withColumn("price_change", round_half_even_fp(cand - cur, 2))
            .withColumn("price_change_pct", pct)
            .withColumn(demand, round_half_even_fp(dem, 6))
            .withColumn(current, round_half_even_fp(cur, 2))
            .withColumn(candidate, round_half_even_fp(cand, 2)))


def option_ids(curve: DataFrame, key: str = "listing_id", order: str = "candidate_price",
               out: str = "option_id") -> DataFrame:
    """F-6 for curves that arrive without an option number: 0-based rank of the
    candidate within its listing.  Partitioned by listing, so the window never
    holds more than one listing's options."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return curve.withColumn(out, F.row_number().over(w) - F.lit(1))
