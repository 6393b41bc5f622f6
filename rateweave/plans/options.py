"""H-2 on packed rows: one row for each listing, its options in an array.

The grid of candidates is made from the listing's own row, so nothing needs to be
exploded, sorted or shuffled by listing: rules are predicates on an option, limits of
groups come from the listing table (one row for each listing instead of one for each
option), and the best allowed option is the largest of the array.  Long curves from
elsewhere take the grouped form in ``jobs.recommendation_job``.

Rows of one listing id are one listing, in both forms.  Whether an id repeats is looked up first
(an aggregation of the ids alone); only then are the rows' best options combined by id.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import DEFAULT_ELASTICITY, elastic_demand, lit_double, round_half_even_fp
from rateweave.operators import budget, constraints, curves, features, report, select
from rateweave.operators.curves import CURVE_HI, CURVE_LO, CURVE_POINTS
from rateweave.operators.joins import attach_stats

OPTION = ["option_id", "candidate_price", "predicted_demand", "expected_revenue", "price_change", "price_change_pct"]


def with_options(listings: DataFrame, n: int = CURVE_POINTS, lo_f: float = CURVE_LO, hi_f: float = CURVE_HI,
                 elasticity: float = DEFAULT_ELASTICITY, carry: Sequence[str] = ()) -> DataFrame:
    """The target curve packed: a listing without a price has no options.  ``carry`` names more
    columns of the listings to take along, such as price bounds."""
    more = [c for c in carry if c not in ("listing_id", "room_type", "neighbourhood_group", "competitor_avg_price")]
    base = features.demand_score(listings).select(
        "listing_id", F.col("price").alias("_price"), F.col("demand_score").alias("_base"), "room_type",
        "neighbourhood_group", "competitor_avg_price", *more)
    cur = F.col("_price")
    grid = curves.price_grid("_price", n, lo_f, hi_f)
    priced = F.transform(grid, lambda p, i: F.struct(
        i.cast("int").alias("i"), p.alias("p"), elastic_demand("_base", cur, p, elasticity).alias("d")))
    made = F.transform(priced, lambda x: F.struct(
        x["i"].alias("option_id"), round_half_even_fp(x["p"], 2).alias("candidate_price"),
        round_half_even_fp(x["d"], 6).alias("predicted_demand"),
        round_half_even_fp(x["p"] * x["d"], 6).alias("expected_revenue"),
        round_half_even_fp(x["p"] - cur, 2).alias("price_change"),
        F.when(cur != 0, round_half_even_fp((x["p"] - cur) / cur * F.lit(100.0), 4)).otherwise(F.lit(0.0))
        .alias("price_change_pct")))
    return base.select("listing_id", round_half_even_fp("_price", 2).alias("current_price"), "room_type",
                       "neighbourhood_group", "competitor_avg_price", *more,
                       F.coalesce(made, F.array().cast("array<struct<option_id:int,candidate_price:double,"
                                                       "predicted_demand:double,expected_revenue:double,"
                                                       "price_change:double,price_change_pct:double>>")).alias("options"))


def explode_options(rows: DataFrame) -> DataFrame:
    """The long curve of packed rows."""
    return rows.select(*[c for c in rows.columns if c != "options"], F.inline("options"))


def _band(rows: DataFrame, group: str, lo: float, hi: float, name: str) -> DataFrame:
    limits = rows.where(F.size("options") > 0).groupBy(group).agg(
        (F.min("current_price") * lit_double(lo)).alias(f"_{name}_lo"),
        (F.max("current_price") * lit_double(hi)).alias(f"_{name}_hi")).where(F.col(group).isNotNull())
    return attach_stats(rows, limits, group)


def rules(rows: DataFrame, change_pct: float | None = None, area_pct: float | None = None, room_band: bool = False,
          hierarchy: bool = False, competitor_factor: float | None = None,
          bounds: tuple | None = None) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``rows`` with the limits that the rules need, and the rules as a predicate on a candidate price."""
    out, checks = rows, []
    if change_pct is not None:
        checks.append(lambda p: constraints.changes_too_much(F.col("current_price"), p, change_pct))
    if area_pct is not None:
        d = float(area_pct) / 100.0
        out = _band(out, "neighbourhood_group", 1.0 - d, 1.0 + d, "area")
        checks.append(lambda p: constraints.outside(p, F.col("_area_lo"), F.col("_area_hi")))
    if room_band:
        out = _band(out, "room_type", constraints.ROOM_BAND_LO, constraints.ROOM_BAND_HI, "room")
        checks.append(lambda p: constraints.outside(p, F.col("_room_lo"), F.col("_room_hi")))
    if hierarchy:
        priced = rows.where(F.size("options") > 0)
        out = constraints.with_hierarchy_limit(out, priced, "_above")
        checks.append(lambda p: constraints.above(p, F.col("_above")))
    if competitor_factor is not None:
        checks.append(lambda p: constraints.above(p, F.col("competitor_avg_price") * lit_double(competitor_factor)))
    if bounds is not None:
        checks.append(lambda p: constraints.outside(p, *map(constraints.bound, bounds)))

    def allowed(price: Column) -> Column:
        ok = F.lit(True)
        for c in checks:
            ok = ok & ~c(price)
        return ok
    return out, allowed


def bound_columns(bounds: tuple | None) -> list[str]:
    """Columns that price bounds name."""
    return sorted({b for b in bounds or () if isinstance(b, str)})


def ids_repeat(rows: DataFrame) -> bool:
    """Whether a listing id has more than one row."""
    return not rows.groupBy("listing_id").count().where("count > 1").isEmpty()


def select_best(rows: DataFrame, nearest: str | None = None, unique_ids: bool | None = None, **chosen_rules) -> DataFrame:
    """F-8/F-9 on packed rows: the allowed option of the largest revenue, ties to the lowest; a
    listing without one has ``feasible`` false and null option columns.  ``nearest`` names a column
    for the demand at the option nearest the current price.  ``unique_ids`` says what is known of
    the ids; None looks."""
    limited, allowed = rules(rows, **chosen_rules)
    cur = F.col("current_price")
    open_ = F.filter("options", lambda o: allowed(o["candidate_price"]) & o["expected_revenue"].isNotNull())
    best = F.array_max(F.transform(open_, lambda o: F.struct(
        o["expected_revenue"].alias("v"), (-o["option_id"]).alias("n"), o.alias("o"))))["o"]
    carried = {"_cur": "current_price", "_room": "room_type", "_area": "neighbourhood_group", "_other": "competitor_avg_price"}
    near = F.array_min(F.transform("options", lambda o: select.nearness(
        o["candidate_price"], cur, o["option_id"], o["predicted_demand"])))
    sel = limited.select("listing_id", *[F.col(c).alias(n) for n, c in carried.items()], best.alias("_best"),
                         *([near.alias("_near")] if nearest else []))
    if unique_ids is False or unique_ids is None and ids_repeat(rows):
        order = F.when(F.col("_best").isNotNull(), select.choice_order(
            F.col("_best.expected_revenue"), F.col("_best.option_id"), F.col("_best.candidate_price"), F.col("_cur")))
        one = sel.groupBy("listing_id").agg(F.max_by(F.struct(*carried, "_best"), order).alias("_one"),
                                            *([F.min("_near").alias("_near")] if nearest else []))
        sel = one.select("listing_id", "_one.*", *(["_near"] if nearest else []))
    some = F.col("_best").isNotNull()
    return sel.select("listing_id", *[F.col(f"_best.{c}").alias(c) for c in OPTION],
                      *[F.when(some, F.col(c)).alias(n) for c, n in carried.items()], some.alias("feasible"),
                      *([F.col("_near.demand").alias(nearest)] if nearest else []))


def optimize(rows: DataFrame, nearest: str | None = None, unique_ids: bool | None = None, **chosen_rules) -> DataFrame:
    """Selection output (F-17, G-5) from packed rows."""
    sel = select_best(rows, nearest, unique_ids, **chosen_rules).withColumnRenamed("candidate_price", "recommended_price")
    return select.selection_reason(select.selection_metrics(sel))


def recommend(rows: DataFrame, on_infeasible: str = "report", true_before: bool = False, unique_ids: bool | None = None,
              **chosen_rules) -> DataFrame:
    """H-2 from packed rows; see ``jobs.recommendation_job`` for ``on_infeasible`` and ``true_before``."""
    if on_infeasible not in ("report", "error"):
        raise ValueError("on_infeasible must be 'report' or 'error'")
    nearest = report.NEAREST if true_before else None
    sel = optimize(rows, nearest, unique_ids, **chosen_rules)
    if on_infeasible == "error":
        select.require_feasible(sel)
    return report.build_recommendations(sel.filter(F.col("feasible")).drop("feasible"), true_before=nearest)


def select_with_budget(rows: DataFrame, max_avg_pct: float = budget.DEFAULT_MAX_AVG_PCT, unique_ids: bool | None = None,
                       refine: bool = False, **chosen_rules) -> tuple[DataFrame, dict]:
    """F-10 from packed rows: as ``budget.select_with_budget`` on their long curve, without exploding or
    shuffling options unless ids repeat."""
    limited, allowed = rules(rows, **chosen_rules)
    cost, carried = "abs_price_change_pct", ["current_price", "room_type", "neighbourhood_group", "competitor_avg_price"]
    if unique_ids is False or unique_ids is None and ids_repeat(rows):
        flagged = limited.select("*", F.inline("options")).withColumn("feasible", allowed(F.col("candidate_price")))
        return budget.select_with_budget(flagged.select("listing_id", *OPTION, *carried, "feasible"), max_avg_pct,
                                         feasible="feasible", refine=refine)
    cur = F.col("current_price")
    own = limited.where(F.size("options") > 0).select("listing_id", budget.packed_array(
        F.col("options"), cur, lambda o: allowed(o["candidate_price"]),
        lambda o: F.struct(*[o[c].alias(c) for c in OPTION], *[F.col(c).alias(c) for c in carried],
                           budget.change_percent(cur, o["candidate_price"]).alias(cost))).alias("_s"))
    packed = own.select("listing_id", budget.best_of_each_cost("_s").alias("_o"))
    return budget.select_from_packed(packed, [*OPTION, *carried, cost], max_avg_pct, refine=refine)
