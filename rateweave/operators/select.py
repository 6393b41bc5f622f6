"""Price selection.

* ``best_price_elastic`` (F-7): closed form, row-local.  The n candidates are
  unrolled into n struct columns at plan time and reduced with ``greatest``:
  no explode, no shuffle, stays inside whole-stage codegen.
* ``select_best_option`` (F-8/F-9): one option per listing from a long curve,
  a single hash aggregation with ``max_by`` (partial aggregation, so a listing
  id with a huge number of rows is combined map-side).
* ``selection_metrics`` (F-17) and reason text for the chosen rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import (
    DEFAULT_ELASTICITY,
    col,
    elastic_demand,
    lit_double,
    round_half_even_fp,
)
from rateweave.operators.curves import INFERENCE_HI, INFERENCE_LO, INFERENCE_POINTS

# Fixed tolerance and reason texts of the selection output.
SELECTION_EPS = 1e-6
REASON_HIGHER = "Higher price improves expected revenue."
REASON_LOWER = "Lower price improves demand enough to increase expected revenue."
REASON_NEAR = "Current price already appears near-optimal."
REASON_FEASIBLE = "Selected as best feasible option under optimization rules."


def best_price_elastic(df: DataFrame, n: int = INFERENCE_POINTS, lo_f: float = INFERENCE_LO,
                       hi_f: float = INFERENCE_HI, elasticity: float | str = DEFAULT_ELASTICITY,
                       current: str = "current_price", base_demand: str = "predicted_demand_before",
                       base_revenue: str = "predicted_revenue_before") -> DataFrame:
    """F-7: scan n candidates (×lo_f..×hi_f, unrounded) against the incumbent.

    A candidate replaces the incumbent only on strictly higher revenue and the
    first best candidate wins ties: structs compare (revenue, key) with key 1
    for the incumbent and -i for candidate i.  NULL revenue sorts lowest; a
    NULL incumbent revenue keeps the incumbent (nothing compares greater)."""
    cur = F.col(current)
    e = col(elasticity) if isinstance(elasticity, str) else lit_double(elasticity)
    # Each term is its own column: Catalyst keeps a projection that is used
    # more than once instead of inlining it, so every price, demand and
    # revenue is computed once per row and the generated code stays small.
    work = (df.withColumn("_lo", cur * lit_double(lo_f))
              .withColumn("_hi", cur * lit_double(hi_f))
              .withColumn("_e", e))
    work = work.withColumn("_step", (F.col("_hi") - F.col("_lo")) / lit_double(max(n - 1, 1)))
    tmp = ["_lo", "_hi", "_e", "_step"]
    cands = []
    for i in range(n):
        p = F.col("_hi") if (i == n - 1 and n > 1) else F.col("_lo") + lit_double(i) * F.col("_step")
        work = work.withColumn(f"_p{i}", p)
        work = work.withColumn(f"_d{i}", elastic_demand(base_demand, cur, F.col(f"_p{i}"), F.col("_e")))
        work = work.withColumn(f"_r{i}", F.col(f"_p{i}") * F.col(f"_d{i}"))
        tmp += [f"_p{i}", f"_d{i}", f"_r{i}"]
        cands.append(F.struct(F.col(f"_r{i}").alias("r"), F.lit(-i).alias("k"), F.col(f"_p{i}").alias("p"),
                              F.col(f"_d{i}").alias("d")))
    inc = F.struct(F.col(base_revenue).alias("r"), F.lit(1).alias("k"), cur.alias("p"),
                   F.col(base_demand).alias("d"))
    best = F.when(F.col(base_revenue).isNull(), inc).otherwise(F.greatest(inc, *cands))
    df = work.withColumn("_best", best).drop(*tmp)
    return (df
              .withColumn("optimized_price", round_half_even_fp(F.col("_best.p"), 2))
              .withColumn("predicted_demand_after", F.col("_best.d"))
              .withColumn("predicted_revenue_after", F.col("_best.r"))
              .withColumn("expected_improvement", F.col("_best.r") - F.col(base_revenue))
              .drop("_best"))


def choice_order(revenue: Column, option: Column, candidate: Column | None = None, current: Column | None = None) -> Column:
    """What the chosen option is the maximum of: revenue, then the lowest option; of repeated ids the
    lowest candidate, then the lowest current price."""
    return F.struct(revenue.alias("v"), (-option).alias("n"), *[(-c).alias(a) for a, c in (("p", candidate), ("q", current))
                                                                if c is not None])


def nearness(candidate: Column, current: Column, option: Column, demand: Column) -> Column:
    """What the option at the current price is the minimum of: distance, then option number, then (of
    repeated ids) demand; NULL where there is no distance."""
    far = F.abs(candidate - current)
    return F.when(far.isNotNull(), F.struct(far.alias("far"), option.alias("n"), demand.alias("demand")))


def _nearest(out: str, option: str = "option_id") -> Column:
    return F.min(nearness(F.col("candidate_price"), F.col("current_price"), F.col(option), F.col("predicted_demand")))[
        "demand"].alias(out)


def select_best_option(curve: DataFrame, key: str = "listing_id", revenue: str = "expected_revenue",
                       option: str = "option_id", feasible: str | None = None, nearest: str | None = None) -> DataFrame:
    """F-8: exactly one option per listing maximising expected revenue; ties -> lowest option.
    Options without a revenue are never chosen.

    With ``feasible`` (a boolean column) only allowed options compete, and a
    listing without any gets ``feasible = FALSE`` and NULL option columns (F-9)
    instead of failing the run.  ``nearest`` names a column for the demand at the listing's
    option nearest its current price, allowed or not, from the same aggregation."""
    payload_cols = [c for c in curve.columns if c not in (key, feasible)]
    payload = F.struct(*[F.col(c) for c in payload_cols])
    open_ = F.col(revenue).isNotNull() & (F.col(feasible) if feasible is not None else F.lit(True))
    more = [F.col(c) if c in curve.columns else None for c in ("candidate_price", "current_price")]
    order = F.when(open_, choice_order(F.col(revenue), F.col(option), *more))
    agg = curve.groupBy(key).agg(F.max_by(payload, order).alias("_sel"),
                                 *([F.count_if(open_).alias("_n_ok")] if feasible else []),
                                 *([_nearest(nearest, option)] if nearest else []))
    found = [F.col(nearest)] if nearest else []
    if feasible is None:
        return agg.select(key, *[F.col("_sel." + c).alias(c) for c in payload_cols], *found)
    ok = F.col("_n_ok") > 0       # a listing with no allowed option has no selected row values
    return agg.select(key, *[F.when(ok, F.col("_sel." + c)).alias(c) for c in payload_cols], ok.alias("feasible"), *found)


def nearest_demand(curve: DataFrame, out: str, key: str = "listing_id") -> DataFrame:
    """(``key``, ``out``): each listing's demand at the option nearest its current price."""
    return curve.groupBy(key).agg(_nearest(out))


def infeasible_listings(curve: DataFrame, allowed: DataFrame, key: str = "listing_id") -> DataFrame:
    """F-9 for filtered curves: listings of ``curve`` with no row left in ``allowed``."""
    return curve.select(key).distinct().join(allowed.select(key).distinct(), key, "left_anti")


def require_feasible(selection: DataFrame) -> DataFrame:
    """``on_infeasible='error'``: fail when any listing has no allowed option."""
    bad = selection.filter(~F.col("feasible")).limit(1).count()
    if bad:
        raise RuntimeError("No feasible price option for at least one listing.")
    return selection


def selection_metrics(sel: DataFrame, current: str = "current_price", chosen: str = "recommended_price",
                      demand: str = "predicted_demand", revenue: str = "expected_revenue") -> DataFrame:
    """F-17: before-revenue at the *selected* demand, change, price change and pct (0 -> divisor 1)."""
    cur = F.col(current)
    return (sel
            .withColumn("current_revenue_estimate", cur * F.col(demand))
            .withColumn("expected_revenue_change", F.col(revenue) - F.col("current_revenue_estimate"))
            .withColumn("price_change", F.col(chosen) - cur)
            .withColumn("price_change_pct",
                        F.col("price_change") / F.when(cur == 0, F.lit(1.0)).otherwise(cur) * F.lit(100.0)))


def selection_reason(sel: DataFrame, eps: float = SELECTION_EPS, out: str = "reason") -> DataFrame:
    """G-5: explanation of the selected option (four ordered rules)."""
    pc, rc = F.col("price_change"), F.col("expected_revenue_change")
    txt = (F.when((pc > 0) & (rc > 0), REASON_HIGHER)
            .when((pc < 0) & (rc > 0), REASON_LOWER)
            .when(F.abs(pc) <= F.lit(eps), REASON_NEAR)
            .otherwise(REASON_FEASIBLE))
    return sel.withColumn(out, txt)


def optimize_curve(curve: DataFrame, key: str = "listing_id", feasible: str | None = None,
                   nearest: str | None = None) -> DataFrame:
    """Selection output of the solver path: chosen option renamed to
    ``recommended_price`` plus F-17 metrics and G-5 reason."""
    sel = select_best_option(curve, key=key, feasible=feasible, nearest=nearest).withColumnRenamed(
        "candidate_price", "recommended_price")
    return selection_reason(selection_metrics(sel))
