"""Business rules over a demand curve (one row per listing × candidate price).

Each rule has two forms:
  * ``*_ok(curve, ...) -> DataFrame`` adds a boolean column (TRUE = option allowed),
    so many rules can be evaluated and the selection can report infeasible
    listings in the same aggregation pass;
  * the plain name filters the curve (the option is removed before selection).

A rule itself is a predicate on the current price, a candidate and limits (``changes_too_much``,
``outside``, ``above``), TRUE where the candidate breaks it; ``plans.options`` calls the same
predicates on packed rows.

Group statistics (band limits, room-type averages) are partial aggregates
attached on the group key with ``joins.attach_stats``: counted first and
broadcast when small, so the exploded curve is never shuffled for them.  Rows whose group key is
NULL are never restricted by a group rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import lit_double
from rateweave.operators.joins import attach_stats

# Fixed defaults of the business rules.
MAX_CHANGE_PCT = 20.0
AREA_DEVIATION_PCT = 25.0
ROOM_BAND_LO, ROOM_BAND_HI = 0.75, 1.25
COMPETITOR_FACTOR = 1.2
ROOM_RANKS = {"Entire home/apt": 3, "Private room": 2, "Shared room": 1}


def changes_too_much(current: Column, candidate: Column, max_pct: float) -> Column:
    """F-11: by more than ``max_pct`` percent; a current price of 0 is exempt."""
    pct = F.abs(candidate - current) / current * F.lit(100.0)
    return F.when(current == 0, F.lit(False)).otherwise(F.coalesce(pct > lit_double(max_pct), F.lit(False)))


def outside(candidate: Column, lo: Column | None, hi: Column | None) -> Column:
    """F-12, F-13, F-16: below ``lo`` or above ``hi``; a NULL or absent limit allows all."""
    parts = [F.coalesce(c, F.lit(False)) for c in (None if lo is None else candidate < lo, None if hi is None else candidate > hi)
             if c is not None]
    return (parts[0] if len(parts) == 1 else parts[0] | parts[1]) if parts else F.lit(False)


def above(candidate: Column, limit: Column) -> Column:
    """F-14, F-15: above a limit; a NULL limit allows all."""
    return F.coalesce(candidate > limit, F.lit(False))


def bound(x: float | str | None) -> Column | None:
    """A limit of F-16: a number, or the name of a column that holds one for each row."""
    return None if x is None else F.col(x) if isinstance(x, str) else lit_double(x)


def _filter(curve: DataFrame, marked: DataFrame, flag: str) -> DataFrame:
    return marked.filter(F.col(flag)).drop(flag)


# ---------------------------------------------------------------- F-11

def limit_change_ok(curve: DataFrame, max_pct: float = MAX_CHANGE_PCT, out: str = "ok_change",
                    current: str = "current_price", candidate: str = "candidate_price") -> DataFrame:
    return curve.withColumn(out, ~changes_too_much(F.col(current), F.col(candidate), max_pct))


def limit_change(curve: DataFrame, max_pct: float = MAX_CHANGE_PCT, **kw) -> DataFrame:
    """Drop options changing the price by more than ``max_pct`` percent (current 0 exempt)."""
    return _filter(curve, limit_change_ok(curve, max_pct, out="_ok", **kw), "_ok")


# ---------------------------------------------------------------- F-12 / F-13

def band_ok(curve: DataFrame, group_col: str, lo_factor: float, hi_factor: float, out: str,
            current: str = "current_price", candidate: str = "candidate_price",
            stats_from: DataFrame | None = None) -> DataFrame:
    """Candidate must lie in [min(current)·lo_factor, max(current)·hi_factor] of its group.
    Absent group column -> rule skipped (all TRUE).  ``stats_from`` (default: the
    curve itself) is the frame the group limits are computed from."""
    if group_col not in curve.columns:
        return curve.withColumn(out, F.lit(True))
    src = stats_from if stats_from is not None else curve
    lim = (src.groupBy(group_col)
           .agg((F.min(current) * lit_double(lo_factor)).alias("_band_lo"),
                (F.max(current) * lit_double(hi_factor)).alias("_band_hi"))
           .filter(F.col(group_col).isNotNull()))
    return (attach_stats(curve, lim, group_col)
            .withColumn(out, ~outside(F.col(candidate), F.col("_band_lo"), F.col("_band_hi")))
            .drop("_band_lo", "_band_hi"))


def area_band_ok(curve: DataFrame, group_col: str = "neighbourhood_group",
                 deviation_pct: float = AREA_DEVIATION_PCT, out: str = "ok_area", **kw) -> DataFrame:
    """F-12 as a flag."""
    d = float(deviation_pct) / 100.0
    return band_ok(curve, group_col, 1.0 - d, 1.0 + d, out, **kw)


def area_band(curve: DataFrame, group_col: str = "neighbourhood_group",
              deviation_pct: float = AREA_DEVIATION_PCT, **kw) -> DataFrame:
    """F-12: keep candidates within the area's current-price band widened by ``deviation_pct``."""
    return _filter(curve, area_band_ok(curve, group_col, deviation_pct, out="_ok", **kw), "_ok")


def room_band_ok(curve: DataFrame, group_col: str = "room_type", lo_factor: float = ROOM_BAND_LO,
                 hi_factor: float = ROOM_BAND_HI, out: str = "ok_room_band", **kw) -> DataFrame:
    return band_ok(curve, group_col, lo_factor, hi_factor, out, **kw)


def room_band(curve: DataFrame, group_col: str = "room_type", lo_factor: float = ROOM_BAND_LO,
              hi_factor: float = ROOM_BAND_HI, **kw) -> DataFrame:
    """F-13: keep candidates within [0.75·min, 1.25·max] of the room type's current prices."""
    return _filter(curve, room_band_ok(curve, group_col, lo_factor, hi_factor, out="_ok", **kw), "_ok")


# ---------------------------------------------------------------- F-14

def with_hierarchy_limit(df: DataFrame, stats_from: DataFrame, out: str, ranks: Mapping[str, int] | None = None,
                         group_col: str = "room_type", current: str = "current_price") -> DataFrame:
    """``df`` with the lowest average current price of the room types ranked above a row's own
    (NULL: no limit).  The per-type averages are one tiny aggregate; the thresholds for every
    rank come out of it as one scalar subquery."""
    ranks = dict(ROOM_RANKS if ranks is None else ranks)
    avgs = stats_from.groupBy(group_col).agg(F.avg(current).alias("_avg"))
    rank_of = F.lit(None).cast("int")
    for name, r in ranks.items():
        rank_of = F.when(F.col(group_col) == name, F.lit(r)).otherwise(rank_of)
    avgs = avgs.withColumn("_rank", rank_of).filter(F.col("_rank").isNotNull())
    levels = sorted(set(ranks.values()))
    thr = avgs.agg(F.struct(*[
        F.min(F.when(F.col("_rank") > F.lit(r), F.col("_avg"))).alias(f"r{r}") for r in levels
    ])).scalar()
    row_thr = F.lit(None).cast("double")
    for name, r in ranks.items():
        row_thr = F.when(F.col(group_col) == name, F.col(f"_thr.r{r}")).otherwise(row_thr)
    return df.withColumn("_thr", thr).withColumn(out, row_thr).drop("_thr")


def room_hierarchy_ok(curve: DataFrame, ranks: Mapping[str, int] | None = None, group_col: str = "room_type",
                      out: str = "ok_hierarchy", current: str = "current_price",
                      candidate: str = "candidate_price", stats_from: DataFrame | None = None) -> DataFrame:
    """A ranked room type may not be priced above the average current price
    (mean over curve rows) of any higher-ranked type present.  Unranked types
    are exempt."""
    if group_col not in curve.columns:
        return curve.withColumn(out, F.lit(True))
    src = stats_from if stats_from is not None else curve
    limited = with_hierarchy_limit(curve, src, "_above", ranks, group_col, current)
    return limited.withColumn(out, ~above(F.col(candidate), F.col("_above"))).drop("_above")


def room_hierarchy(curve: DataFrame, ranks: Mapping[str, int] | None = None, **kw) -> DataFrame:
    """F-14 as a filter."""
    return _filter(curve, room_hierarchy_ok(curve, ranks, out="_ok", **kw), "_ok")


# ---------------------------------------------------------------- F-15 / F-16

def competitor_cap_ok(curve: DataFrame, factor: float = COMPETITOR_FACTOR, out: str = "ok_competitor",
                      competitor: str = "competitor_avg_price", candidate: str = "candidate_price") -> DataFrame:
    if competitor not in curve.columns:
        return curve.withColumn(out, F.lit(True))
    return curve.withColumn(out, ~above(F.col(candidate), F.col(competitor) * lit_double(factor)))


def competitor_cap(curve: DataFrame, factor: float = COMPETITOR_FACTOR, **kw) -> DataFrame:
    """F-15: candidate <= competitor_avg_price · factor (absent or NULL competitor -> no cap)."""
    return _filter(curve, competitor_cap_ok(curve, factor, out="_ok", **kw), "_ok")


def price_bounds_ok(curve: DataFrame, lo: float | str | None = None, hi: float | str | None = None,
                    out: str = "ok_bounds", candidate: str = "candidate_price") -> DataFrame:
    return curve.withColumn(out, ~outside(F.col(candidate), bound(lo), bound(hi)))


def price_bounds(curve: DataFrame, lo: float | str | None = None, hi: float | str | None = None, **kw) -> DataFrame:
    """F-16: hard min/max allowed price (numbers or per-row columns)."""
    return _filter(curve, price_bounds_ok(curve, lo, hi, out="_ok", **kw), "_ok")


def apply_rules(curve: DataFrame, change_pct: float | None = None,
                area_pct: float | None = None, room_band: bool = False, hierarchy: bool = False,
                competitor_factor: float | None = None, bounds: tuple | None = None,
                out: str = "feasible") -> DataFrame:
    """Evaluate the enabled rules as flags and AND them into ``out``.

    Group statistics are taken over the unfiltered input curve (the rules are
    evaluated side by side; each independently forces options to zero), so no
    statistic re-runs another rule's join."""
    flags = []
    c = curve
    if change_pct is not None:
        c = limit_change_ok(c, change_pct); flags.append("ok_change")
    if area_pct is not None:
        c = area_band_ok(c, deviation_pct=area_pct, stats_from=curve); flags.append("ok_area")
    if room_band:
        c = room_band_ok(c, stats_from=curve); flags.append("ok_room_band")
    if hierarchy:
        c = room_hierarchy_ok(c, stats_from=curve); flags.append("ok_hierarchy")
    if competitor_factor is not None:
        c = competitor_cap_ok(c, competitor_factor); flags.append("ok_competitor")
    if bounds is not None:
        c = price_bounds_ok(c, *bounds); flags.append("ok_bounds")
    ok = F.lit(True)
    for f in flags:
        ok = ok & F.col(f)
    return c.withColumn(out, ok).drop(*flags)
