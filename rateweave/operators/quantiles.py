"""Exact quantiles (linear interpolation between order statistics) that scale.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer; a group holding a third of 100 TB cannot work that way.  Here the
order statistics are located by histogram refinement:

1. one aggregation gives n, min, max per group;
2. while the interval that holds a wanted rank has more than
   ``gather_limit`` rows (and min < max), the rows inside it are binned into
   ``bins`` equal-width bins (a partial aggregation: at most ``bins`` rows per
   interval leave each map task) and the interval shrinks to the one bin whose
   cumulative count covers the rank;
3. intervals with at most ``gather_limit`` rows are ranked with a window
   partitioned by interval, so one task sorts at most ``gather_limit`` values.

The per-pass state (one row per wanted rank) is small and is checkpointed to
the shared checkpoint directory, so passes do not stack lineage.  The result
equals ``quantile_cont`` / numpy ``linear``: v[f] + (v[c] - v[f]) * (pos - f),
pos = q * (n - 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

GATHER_LIMIT = 200_000
BINS = 1024
BROADCAST_ROWS = 1_000_000


def _maybe_broadcast(small: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(small) if n_rows <= BROADCAST_ROWS else small


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] | None = None,
                    gather_limit: int = GATHER_LIMIT, bins: int = BINS) -> DataFrame:
    """Long result: by..., ``q`` (double), ``value`` (double).  NULL and non-finite values
    are missing; groups with no value are absent; NULL group keys are a group."""
    by = list(by or [])
    probs = [float(p) for p in probs]
    g = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("_"))
    v = F.col(value).cast("double")
    data = (df.select(g.alias("_g"), v.alias("_v"))
              .filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf"))))

    stats = data.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"),
                                   F.max("_v").alias("_hi"))
    # wanted ranks per (group, q): floor and ceil of q*(n-1)
    plist = F.array(*[F.lit(p) for p in probs])
    wants = (stats.select("*", F.posexplode(plist).alias("_qi", "q"))
                  .withColumn("_pos", F.col("q") * (F.col("_n") - F.lit(1)).cast("double"))
                  .withColumn("_kf", F.floor("_pos").cast("long"))
                  .withColumn("_kc", F.ceil("_pos").cast("long"))
                  .withColumn("_frac", F.col("_pos") - F.col("_kf").cast("double")))
    wants = cut_lineage(wants)
    sizes = wants.agg(F.count(F.lit(1)).alias("w"), F.max("_n").alias("m")).first()
    n_wants, max_n = int(sizes["w"] or 0), int(sizes["m"] or 0)
    ranks = (wants.select("_g", "_n", "_lo", "_hi", F.explode(F.array_distinct(F.array("_kf", "_kc"))).alias("_k"))
                  .distinct())
    # state: rank _k of group lies at rank _r among the _m values in [_lo, _hi]
    state = ranks.select("_g", "_k", "_lo", "_hi", F.col("_k").alias("_r"), F.col("_n").alias("_m"))
    fast = max_n <= gather_limit          # every group is small enough to rank directly
    if not fast:
        state = cut_lineage(state)

    def open_(s: DataFrame):
        return (F.col("_lo") < F.col("_hi")) & (F.col("_m") > F.lit(gather_limit))

    last = None
    while not fast:
        todo = state.filter(open_(state))
        now = todo.agg(F.count(F.lit(1)).alias("n"), F.sum("_m").alias("m"), F.sum(F.col("_hi") - F.col("_lo")).alias("w")).first()
        if now["n"] == 0:
            break
        if now == last:
            raise RuntimeError("quantile refinement made no progress")
        last = now
        intervals = todo.select("_g", "_lo", "_hi").distinct()
        intervals = cut_lineage(intervals)
        n_int = intervals.count()
        half = F.lit(0.5)
        width = F.col("_hi") * half - F.col("_lo") * half
        b = F.least(F.floor((F.col("_v") * half - F.col("_lo") * half) / width * F.lit(float(bins))).cast("int"),
                    F.lit(bins - 1))
        hist = (data.join(_maybe_broadcast(intervals, n_int), "_g")
                    .filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
                    .withColumn("_b", b)
                    .groupBy("_g", "_lo", "_hi", "_b")
                    .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax")))
        w = Window.partitionBy("_g", "_lo", "_hi").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        moved = (todo.join(hist, ["_g", "_lo", "_hi"])
                     .filter((F.col("_r") >= F.col("_before")) & (F.col("_r") < F.col("_before") + F.col("_c")))
                     .select("_g", "_k", F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"),
                             (F.col("_r") - F.col("_before")).alias("_r"), F.col("_c").alias("_m")))
        state = cut_lineage(state.filter(~open_(state)).unionByName(moved))

    # resolve: single-valued intervals directly, small intervals by ranking
    direct = state.filter(F.col("_lo") == F.col("_hi")).select("_g", "_k", F.col("_lo").alias("_val"))
    small = state.filter(F.col("_lo") < F.col("_hi"))
    small_int = small.select("_g", "_lo", "_hi").distinct()
    n_small = 2 * n_wants if fast else small_int.count()
    if n_small:
        rw = Window.partitionBy("_g", "_lo", "_hi").orderBy("_v")
        ranked = (data.join(_maybe_broadcast(small_int, n_small), "_g")
                      .filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
                      .withColumn("_j", F.row_number().over(rw) - F.lit(1)))
        picked = (ranked.join(_maybe_broadcast(small, n_small), ["_g", "_lo", "_hi"])
                        .filter(F.col("_j") == F.col("_r"))
                        .select("_g", "_k", F.col("_v").alias("_val")))
        resolved = direct.unionByName(picked)
    else:
        resolved = direct
    if not fast:
        resolved = cut_lineage(resolved)

    lo_v = resolved.select("_g", F.col("_k").alias("_kf"), F.col("_val").alias("_vf"))
    hi_v = resolved.select("_g", F.col("_k").alias("_kc"), F.col("_val").alias("_vc"))
    out = (wants.join(lo_v, ["_g", "_kf"]).join(hi_v, ["_g", "_kc"])
                .withColumn("value", F.when(F.col("_kf") == F.col("_kc"), F.col("_vf"))
                            .otherwise(F.col("_vf") + (F.col("_vc") - F.col("_vf")) * F.col("_frac"))))
    return out.select(*[F.col("_g")[c].alias(c) for c in by], "q", "value")


def quantile_columns(long: DataFrame, probs: Sequence[float], names: Sequence[str],
                     by: Sequence[str] | None = None) -> DataFrame:
    """Long (by, q, value) -> one row per group with one column per probability."""
    by = list(by or [])
    aggs = [F.max(F.when(F.col("q") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in zip(probs, names)]
    return long.groupBy(*by).agg(*aggs) if by else long.agg(*aggs)


def long_columns(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric columns into (column, value) rows (a narrow, per-row operation)."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), name, value)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int | None = None) -> dict[str, list[float | None]]:
    """Quantiles of several columns, returned to the driver (cols × probs values)."""
    cols = list(cols)
    if not cols:
        return {}
    if accuracy is not None:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                       for c in cols]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    long = exact_quantiles(long_columns(df, cols), "value", probs, by=["column"])
    got: dict[str, dict[float, float]] = {c: {} for c in cols}
    for r in long.collect():
        got[r["column"]][r["q"]] = r["value"]
    return {c: [got[c].get(float(p)) for p in probs] for c in cols}
