"""F-10: one option per listing under a coupled change budget.

    maximise  Σ expected_revenue(i, j) x(i, j)
    s.t.      Σ_j x(i, j) = 1 for every listing i
              Σ abs_pct(i, j) x(i, j) <= N · max_avg_pct      (N = listings)

A multiple-choice knapsack.  Each listing starts at its cheapest option; its upper hull
(cost against revenue) gives the steps that can be worth their cost, each with an
efficiency, revenue gained per cost, that falls from step to step.  Taking all listings'
steps in the order of their efficiency until the budget is spent is the optimum of the
relaxed problem; stopping before the first step that doesn't fit loses less than that
one step.  Steps of one efficiency are ordered by a hash of their listing, so equal
listings split at the cut and the budget is used to within one step.

The hull is row-local, on the options of a listing packed in one row.  The cut is found
coarse to fine: costs are summed by ranges of efficiency (the ranges are quantiles of the
steps themselves, whatever the unit of revenue), and only the range that holds the cut is
looked at again, until it is small enough to be ordered in one task.  Costs are summed as
decimals, so the cut doesn't depend on how rows are dealt out.

With ``refine`` the ``CORE`` listings nearest the cut are then chosen anew, together and exactly,
from all their options, with what the others leave of the budget: the result is never worse,
and with at most ``CORE`` listings it is the optimum.

Of a listing's options of one (rounded) cost the best one is kept; rows of one listing id are one
listing.  Options without a revenue or a cost, and those that a rule forbids, are never taken.  N
counts every listing of the curve; listings left without an option are counted in the
summary and have no row in the selection.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.functions.exprs import round_half_even_fp
from rateweave.operators.select import choice_order
from rateweave.session import cut_lineage

DEFAULT_MAX_AVG_PCT = 10.0
GATHER = 100_000
RANGES = 64
#: Listings that ``refine`` chooses anew, and the most options that such a listing has.
CORE, CORE_OPTIONS = 8, 16
MONEY = "decimal(38,6)"


def change_cost(curve: DataFrame, current: str = "current_price", candidate: str = "candidate_price",
                out: str = "abs_price_change_pct") -> DataFrame:
    """|candidate - current| / current · 100, current 0 -> divisor 1."""
    return curve.withColumn(out, change_percent(F.col(current), F.col(candidate)))


def change_percent(cur: Column, cand: Column) -> Column:
    """|candidate - current| / current · 100, current 0 -> divisor 1."""
    return F.abs(cand - cur) / F.when(cur == 0, F.lit(1.0)).otherwise(cur) * F.lit(100.0)


def _hull(options: Column) -> Column:
    """Options on the upper hull from the cheapest on, each with the efficiency of the step to it."""
    kind = "array<struct<c:double,v:double,o:bigint,eff:double>>"
    first = F.element_at(options, 1)
    start = F.array(F.struct(first["c"].alias("c"), first["v"].alias("v"), first["o"].alias("o"),
                             F.lit(float("inf")).alias("eff"))).cast(kind)

    def step(hull: Column, _: Column) -> Column:
        cur = F.element_at(hull, -1)
        ahead = F.filter(options, lambda x: (x["c"] > cur["c"]) & (x["v"] > cur["v"]))
        best = F.array_max(F.transform(ahead, lambda x: F.struct(
            ((x["v"] - cur["v"]) / (x["c"] - cur["c"])).alias("slope"), x["c"].alias("c"), (-x["o"]).alias("n"),
            x["v"].alias("v"))))
        # a one-element array binds the step once
        grown = F.transform(F.array(best), lambda b: F.when(b.isNull(), hull).otherwise(F.concat(hull, F.array(F.struct(
            b["c"].alias("c"), b["v"].alias("v"), (-b["n"]).alias("o"), F.least(cur["eff"], b["slope"]).alias("eff"))))))
        return F.element_at(grown, 1).cast(kind)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(options) - 1, F.lit(1))), start, step)


def pack_options(curve: DataFrame, key: str, revenue: str, option: str, cost: str, feasible: str | None) -> DataFrame:
    """One row for each listing: key and its options (c, v, o, payload), cheapest first, one for each
    cost: the one that ``select.choice_order`` would take.  Options are cut to that by partial
    aggregation before a listing's options are gathered, so an id with very many rows is no hot key."""
    payload = F.struct(*[F.col(c) for c in curve.columns if c not in (key, feasible)])
    ok = F.col(revenue).isNotNull() & F.col(cost).isNotNull()
    if feasible:
        ok = ok & F.coalesce(F.col(feasible), F.lit(False))
    more = [F.col(c) if c in curve.columns else None for c in ("candidate_price", "current_price")]
    order = choice_order(F.col(revenue), F.col(option).cast("long"), *more)
    by_cost = curve.groupBy(key, F.when(ok, round_half_even_fp(cost, 6)).alias("_cost")).agg(
        F.max(F.when(ok, F.struct(order.alias("r"), payload.alias("p")))).alias("_b"))
    one = F.when(F.col("_cost").isNotNull(), F.struct(F.col("_cost").alias("c"), F.col("_b.r").alias("r"), F.col("_b.p").alias("p")))
    packed = by_cost.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("_o"))
    return packed.select(key, _with_values(F.col("_o")).alias("_o"))


def _sum(df: DataFrame, c: Column) -> Decimal:
    return df.agg(F.sum(c).alias("s")).first()["s"] or Decimal(0)


def _first_left(steps: DataFrame, room: Decimal, gather: int):
    """The first step in the order (eff desc, tie, k) that no longer fits into ``room``; None if all fit."""
    before, span = Decimal(0), steps
    while True:
        s = span.agg(F.count(F.lit(1)).alias("n"), F.min("eff").alias("lo"), F.max("eff").alias("hi"),
                     F.min("rank").alias("r_lo"), F.max("rank").alias("r_hi")).first()
        if s["n"] <= gather or (s["lo"] == s["hi"] and s["r_lo"] == s["r_hi"]):
            break
        by, low, high = ("eff", s["lo"], s["hi"]) if s["lo"] < s["hi"] else ("rank", s["r_lo"], s["r_hi"])
        asked = [k / RANGES for k in range(1, RANGES)]
        found = span.agg(F.percentile_approx(by, asked, 10_000).alias("b")).first()["b"]
        bounds = sorted({b for b in found if low < b} | {high})
        place = F.lit(0)
        for b in bounds:
            place = place + (F.col(by) >= F.lit(b)).cast("int")
        sums = {r["place"]: r["s"] for r in span.groupBy(place.alias("place")).agg(
            F.sum("dc").alias("s")).collect()}
        for p in sorted(sums, reverse=by == "eff"):
            if before + sums[p] > room:
                break
            before += sums[p]
        else:
            return None
        span = cut_lineage(span.where(place == F.lit(p)))
    order = [F.col("eff").desc(), F.col("rank"), F.col("tie"), F.col("k")]
    total = F.sum("dc").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return span.withColumn("_t", total).where(F.col("_t") > F.lit(room - before)).orderBy(*order).first()


def best_choice(options: Sequence[Sequence[tuple[Decimal, float]]], room: Decimal) -> tuple[int, ...] | None:
    """One option (cost, value) of each listing with the largest value within ``room``, as indexes; of
    equal values the cheapest.  Both halves' choices are listed and the second's are looked up by what
    the first leaves, so n listings of m options take about m ** (n / 2) steps."""
    halves = options[: len(options) // 2], options[len(options) // 2:]
    listed = []
    for half in halves:
        picks = list(itertools.product(*[range(len(o)) for o in half]))
        cost = np.array([sum(int(o[k][0].scaleb(6)) for o, k in zip(half, p)) for p in picks], np.int64)
        value = np.array([sum(o[k][1] for o, k in zip(half, p)) for p in picks], np.float64)
        listed.append((picks, cost, value))
    (picks, cost, value), (picks2, cost2, value2) = listed
    order = np.lexsort((-value2, cost2))
    top = np.maximum.accumulate(value2[order])
    first = np.searchsorted(top, top)                    # the cheapest choice of that value
    at = np.searchsorted(cost2[order], int(room.scaleb(6)) - cost, side="right") - 1
    fits = np.flatnonzero(at >= 0)
    if not len(fits):
        return None
    second = first[at[fits]]
    total, spent = value[fits] + top[second], cost[fits] + cost2[order][second]
    best = np.lexsort((spent, -total))[0]
    return picks[fits[best]] + picks2[order[second[best]]]


def _refined(packed: DataFrame, chosen: Column, room: Decimal, multiplier: float, key: str) -> dict:
    """tie -> cost of the option to take instead, for the listings nearest the cut; ``room`` is what
    the choice so far leaves of the budget."""
    own = packed.withColumn("_c", chosen).where(F.col("tie").isNotNull() & F.col("_c").isNotNull()
                                                & F.size("_o").between(2, CORE_OPTIONS))
    effs = F.transform(F.filter("_h", lambda h: h["eff"] < float("inf")), lambda h: F.abs(h["eff"] - F.lit(multiplier)))
    few = own.withColumn("_d", F.coalesce(F.array_min(effs), F.lit(float("inf")))).orderBy("_d", "tie").limit(CORE).select(
        "tie", "_c", F.transform("_o", lambda x: F.struct(x["c"].cast(MONEY).alias("c"), x["v"].alias("v"))).alias("o")).collect()
    if not few:
        return {}
    cost = lambda c: Decimal(repr(c)).quantize(Decimal("1e-6"))
    options = [[(cost(float(x["c"])), float(x["v"])) for x in r["o"]] for r in few]
    own_room = room + sum((cost(r["_c"]) for r in few), Decimal(0))
    best = best_choice(options, own_room)
    if best is None:
        return {}
    before = sum(v for r, o in zip(few, options) for c, v in o if c == cost(r["_c"]))
    if sum(o[k][1] for o, k in zip(options, best)) <= before:
        return {}
    return {r["tie"]: float(o[k][0]) for r, o, k in zip(few, options, best)}


def select_with_budget(curve: DataFrame, max_avg_pct: float = DEFAULT_MAX_AVG_PCT, key: str = "listing_id",
                       revenue: str = "expected_revenue", option: str = "option_id", feasible: str | None = None,
                       gather: int = GATHER, refine: bool = False) -> tuple[DataFrame, dict]:
    """Returns (selection, summary).  ``selection`` has one row per listing with the
    chosen option's columns plus ``abs_price_change_pct``; ``summary`` holds the budget,
    used cost, multiplier (efficiency of the first step left out), objective, upper bound
    and gap, and how many listings have no allowed option."""
    cost = "abs_price_change_pct"
    costed = change_cost(curve, out=cost)
    names = [c for c in costed.columns if c not in (key, feasible)]
    return select_from_packed(pack_options(costed, key, revenue, option, cost, feasible), names, max_avg_pct, key, revenue,
                              gather, refine)


def packed_array(options: Column, current: Column, allowed, payload) -> Column:
    """``_o`` of ``select_from_packed`` from a listing's own array of options, cheapest first; of one cost
    the last counts (``best_of_each_cost``).  ``allowed`` judges an option, ``payload`` is what to keep."""
    def one(x: Column) -> Column:
        cost = round_half_even_fp(change_percent(current, x["candidate_price"]), 6)
        order = choice_order(x["expected_revenue"], x["option_id"].cast("long"), x["candidate_price"], current)
        return F.struct(cost.alias("c"), order.alias("r"), payload(x).alias("p"))
    open_ = F.filter(options, lambda x: allowed(x) & x["expected_revenue"].isNotNull() & change_percent(current, x["candidate_price"]).isNotNull())
    return _with_values(F.sort_array(F.transform(open_, one)))


def _with_values(options: Column) -> Column:
    return F.transform(options, lambda x: F.struct(
        x["c"].alias("c"), x["r"]["v"].alias("v"), (-x["r"]["n"]).alias("o"), x["r"].alias("r"), x["p"].alias("p")))


def best_of_each_cost(sorted_options: str) -> Column:
    own = F.col(sorted_options)
    return F.filter(own, lambda x, i: F.coalesce(F.try_element_at(own, i + 2)["c"] != x["c"], F.lit(True)))


def select_from_packed(packed: DataFrame, names: Sequence[str], max_avg_pct: float, key: str = "listing_id",
                       revenue: str = "expected_revenue", gather: int = GATHER, refine: bool = False) -> tuple[DataFrame, dict]:
    """``select_with_budget`` on one row for each listing: key and ``_o``, its options (c, v, o, r, p), cheapest
    first, one for each cost; ``names`` are the fields of p."""
    cost = "abs_price_change_pct"
    tie = F.md5(F.col(key).cast("string"))
    packed = cut_lineage(packed.select(key, "_o", F.when(F.size("_o") > 0, _hull(F.col("_o"))).alias("_h"),
                                       tie.alias("tie")))
    free = F.array_max(F.transform("_o", lambda x: F.struct(x["r"].alias("r"), x["c"].alias("c"))))
    money = lambda c: c.cast("decimal(18,6)")
    t = packed.select(F.element_at("_h", 1)["c"].alias("base"), free.alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.count("base").alias("some"), F.sum(money(F.col("base"))).alias("base"),
        F.sum(money(F.col("f.c"))).alias("free")).first()
    budget = float(t["n"]) * float(max_avg_pct)
    limit = Decimal(repr(budget))
    summary = {"num_listings": int(t["n"]), "budget": budget, "num_infeasible": int(t["n"] - t["some"])}
    chosen: Column
    left = None
    if (t["base"] or Decimal(0)) > limit:
        summary.update(status="infeasible", min_cost=float(t["base"]))
        chosen = F.lit(None).cast("double")
    elif (t["free"] or Decimal(0)) <= limit:
        summary.update(status="optimal", multiplier=0.0)
        chosen = free["c"]
    else:
        prior = F.transform(F.sequence(F.lit(1), F.size("_h") - 1), lambda k: F.struct(
            k.alias("k"), F.element_at("_h", k + 1)["eff"].alias("eff"),
            (money(F.element_at("_h", k + 1)["c"]) - money(F.element_at("_h", k)["c"])).alias("dc"),
            (F.element_at("_h", k + 1)["v"] - F.element_at("_h", k)["v"]).alias("dv")))
        steps = packed.where(F.size("_h") > 1).select("tie", F.inline(prior)).withColumn(
            "rank", F.conv(F.substring("tie", 1, 8), 16, 10).cast("long"))
        steps = cut_lineage(steps)
        left = _first_left(steps, limit - t["base"], gather)
        if left is None:                                     # every worthwhile step fits
            chosen = F.element_at("_h", -1)["c"]
            summary.update(status="optimal", multiplier=0.0)
        else:
            e, own, k0 = F.lit(left["eff"]), F.lit(left["tie"]), F.lit(left["k"])
            taken = F.filter(F.transform("_h", lambda h, k: F.struct(h["c"].alias("c"), h["eff"].alias("eff"), k.alias("k"))),
                             lambda h: (h["k"] == 0) | (h["eff"] > e) | ((h["eff"] == e) & (
                                 (F.col("tie") < own) | ((F.col("tie") == own) & (h["k"] < k0)))))
            chosen = F.element_at(taken, -1)["c"]
            summary.update(status="feasible", multiplier=float(left["eff"]))
            plain_choice = chosen
            if refine:
                spent = _sum(packed.withColumn("_c", chosen), money(F.col("_c")))
                again = _refined(packed, chosen, limit - spent, float(left["eff"]), key)
                for own_tie, c in again.items():
                    chosen = F.when(F.col("tie") == F.lit(own_tie), F.lit(c)).otherwise(chosen)
    picked = F.element_at(F.filter("_o", lambda x: x["c"] == F.col("_c")), 1)["p"]
    sel = packed.withColumn("_c", chosen).where("_c is not null").withColumn("_p", picked).select(
        key, *[F.col("_p")[c].alias(c) for c in names])
    if summary["status"] == "infeasible":
        return sel, summary
    sel = cut_lineage(sel)
    tot = sel.agg(F.sum(money(round_half_even_fp(cost, 6))).alias("c"), F.sum(revenue).alias("v")).first()
    used, value = float(tot["c"] or 0), float(tot["v"] or 0.0)
    # the relaxed optimum: what is taken and as much of the next step as fits
    upper = value + (float(limit - (tot["c"] or Decimal(0))) * left["eff"] if left is not None else 0.0)
    if left is not None and refine:
        plain = packed.select(F.element_at(F.filter("_o", lambda x: x["c"] == plain_choice), 1).alias("p")).agg(
            F.sum(money(F.col("p.c"))).alias("c"), F.sum("p.v").alias("v")).first()
        upper = max(value, float(plain["v"]) + float(limit - plain["c"]) * left["eff"])
    summary.update(used_cost=used, objective=value, upper_bound=upper, gap=max(upper - value, 0.0))
    return sel, summary


SUMMARY = ("status string, num_listings long, num_infeasible long, budget double, multiplier double, used_cost double, "
           "objective double, upper_bound double, gap double")


def budget_summary_frame(spark, summary: dict) -> DataFrame:
    """The summary dict as a one-row DataFrame (for the JSON sink)."""
    cols = [c.split(" ")[0] for c in SUMMARY.split(", ")]
    return spark.createDataFrame([tuple(summary.get(k) for k in cols)], SUMMARY)
