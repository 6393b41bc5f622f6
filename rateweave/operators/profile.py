"""Profiling and EDA aggregations.

Every profile is one (or a few) global aggregations over all columns at once
(partial aggregation; results are tiny), returned in long form so the output
width does not depend on the schema.  Quantiles come from the distributed exact
operator; ``accuracy=`` switches to ``percentile_approx`` sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateweave.functions.exprs import finite_or_null
from rateweave.operators.joins import attach_stats
from rateweave.operators.quantiles import exact_quantiles, long_columns, quantile_columns

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)
IQR_K = 1.5


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """D-17: numeric columns by type, minus ``exclude``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long_agg(df: DataFrame, cols: Sequence[str], name: str, exprs) -> DataFrame:
    """One aggregation with a struct per column, exploded to one row per column."""
    row = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), *exprs(c)) for c in cols]).alias("_a"))
    return row.select(F.inline("_a"))


def profile_shape(df: DataFrame) -> DataFrame:
    """C-1: row count, column count and column list."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"))


def profile_missing(df: DataFrame) -> DataFrame:
    """C-2: missing count and percent per column (NaN counts as missing), descending."""
    def exprs(c):
        dt = df.schema[c].dataType
        miss = F.col(c).isNull() | (F.isnan(c) if isinstance(dt, (T.DoubleType, T.FloatType)) else F.lit(False))
        n = F.count_if(miss)
        return [n.alias("missing_count"), (F.try_divide(n, F.count(F.lit(1))) * F.lit(100.0)).alias("missing_pct")]
    return _long_agg(df, df.columns, "missing", exprs).orderBy(F.desc("missing_count"), "column")


def profile_distinct(df: DataFrame, cols: Sequence[str] | None = None, approx_rsd: float | None = None) -> DataFrame:
    """C-3: distinct non-NULL values per (string) column; exact or HyperLogLog++."""
    cols = list(cols) if cols is not None else string_columns(df)
    if approx_rsd is not None:
        return _long_agg(df, cols, "d", lambda c: [F.approx_count_distinct(c, approx_rsd).alias("n_distinct")])
    # exact: unpivot to (column, value) and count distinct pairs -> one shuffle for all columns
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return long.select("column", "value").distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))


def profile_numeric(df: DataFrame, cols: Sequence[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """C-4/C-5: count, mean, std (n-1), min, 25/50/75 %, max per numeric column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = long_columns(df, cols)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    probs, names = [0.25, 0.5, 0.75], ["q25", "q50", "q75"]
    if accuracy is not None:
        qs = long.groupBy("column").agg(F.percentile_approx("value", probs, accuracy).alias("_q")).select(
            "column", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        qs = quantile_columns(exact_quantiles(long, "value", probs, by=["column"]), probs, names, by=["column"])
    return moments.join(qs, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")


def profile_skew(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """C-7: bias-corrected sample skewness: g1 * sqrt(n(n-1)) / (n-2)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = long_columns(df, cols)
    n = F.count("value").cast("double")
    return long.groupBy("column").agg(
        F.when(n > 2, F.skewness("value") * F.sqrt(n * (n - F.lit(1.0))) / (n - F.lit(2.0))).alias("skewness"))


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, k: float = IQR_K) -> DataFrame:
    """C-8: Q1/Q3 (linear interpolation), bounds Q1 - k·IQR / Q3 + k·IQR, count strictly outside."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = long_columns(df, cols)
    q = quantile_columns(exact_quantiles(long, "value", [0.25, 0.75], by=["column"]), [0.25, 0.75],
                         ["q1", "q3"], by=["column"])
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower", F.col("q1") - F.lit(float(k)) * F.col("iqr"))
          .withColumn("upper", F.col("q3") + F.lit(float(k)) * F.col("iqr")))
    names = ["q1", "q3", "iqr", "lower", "upper"]
    # a column without values keeps its row, with NULL bounds and no outlier
    return attach_stats(long, q, "column").groupBy("column").agg(
        *[F.first(n).alias(n) for n in names],
        F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_outliers"))


def histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """C-9: equal-width bins between min and max; the maximum falls in the last bin.
    Output: bin (1..bins), lower/upper edge, count (0 for empty bins); no rows without values.
    NULL and non-finite values are missing."""
    data = df.select(finite_or_null(F.col(c).cast("double")).alias("_v")).filter(F.col("_v").isNotNull())
    s = data.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    v = F.col("_v")
    lo, hi = F.col("_h.lo"), F.col("_h.hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((v - lo) / width).cast("int") + F.lit(1), F.lit(bins)))
    counts = data.withColumn("_h", s.scalar()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).withColumn("_h", s.scalar()) \
        .where("_h.lo is not null")
    return edges.join(F.broadcast(counts), "bin", "left").select(       # at most ``bins`` rows
        "bin", (lo + (F.col("bin") - 1).cast("double") * width).alias("lower"),
        (lo + F.col("bin").cast("double") * width).alias("upper"), F.coalesce("count", F.lit(0)).alias("count"))


def box_stats(df: DataFrame, value: str, by: str | None = None, k: float = IQR_K) -> DataFrame:
    """C-10: five-number summary per category with Tukey whiskers and outlier count.
    Whiskers are the most extreme values within [Q1 - k·IQR, Q3 + k·IQR]."""
    keys = [by] if by else []
    data = df.select(*keys, F.col(value).cast("double").alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value"))
    if by:
        data = data.filter(F.col(by).isNotNull())
    probs = [0.25, 0.5, 0.75]
    q = quantile_columns(exact_quantiles(data, "value", probs, by=keys), probs, ["q1", "median", "q3"], by=keys)
    q = (q.withColumn("_lf", F.col("q1") - F.lit(float(k)) * (F.col("q3") - F.col("q1")))
          .withColumn("_uf", F.col("q3") + F.lit(float(k)) * (F.col("q3") - F.col("q1"))))
    joined = attach_stats(data, q, keys, how="inner") if keys else data.withColumn("_q", q.select(
        F.struct(*q.columns)).scalar()).select("value", "_q.*")
    inside = (F.col("value") >= F.col("_lf")) & (F.col("value") <= F.col("_uf"))
    agg = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.min("value").alias("min"), F.first("q1").alias("q1"),
        F.first("median").alias("median"), F.first("q3").alias("q3"), F.max("value").alias("max"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return agg


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C-11: pairwise-complete Pearson correlation, long form (a, b, corr), one aggregation."""
    cols = list(cols)
    place = {c: k for k, c in enumerate(cols)}
    # (a, b) and (b, a) are written alike, so each pair is aggregated once
    one = lambda a, b: F.corr(*[F.col(c).cast("double") for c in sorted((a, b), key=place.get)])
    row = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), one(a, b).alias("corr"))
                           for a in cols for b in cols]).alias("_p"))
    return row.select(F.inline("_p"))


def bin2d(df: DataFrame, x: str, y: str, bins: int = 20, value: str | None = None) -> DataFrame:
    """C-12: 2-D equal-width binning; count per cell and optional mean of ``value``."""
    s = df.agg(F.struct(F.min(x).alias("xlo"), F.max(x).alias("xhi"),
                        F.min(y).alias("ylo"), F.max(y).alias("yhi"))).scalar()

    def bucket(c, lo, hi):
        w = (hi - lo) / F.lit(float(bins))
        return F.when(hi == lo, F.lit(1)).otherwise(
            F.least(F.floor((F.col(c).cast("double") - lo) / w).cast("int") + F.lit(1), F.lit(bins)))
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_s", s)
    aggs = [F.count(F.lit(1)).alias("count")]
    if value:
        aggs.append(F.avg(value).alias(f"mean_{value}"))
    return d.groupBy(bucket(x, F.col("_s.xlo"), F.col("_s.xhi")).alias("x_bin"),
                     bucket(y, F.col("_s.ylo"), F.col("_s.yhi")).alias("y_bin")).agg(*aggs)


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """C-13: non-NULL value counts, descending."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), c)


def data_summary(df: DataFrame) -> DataFrame:
    """C-6: one nested row: shape, columns, missing counts, distinct counts, numeric describe."""
    shape = profile_shape(df)
    miss = profile_missing(df).agg(F.collect_list(F.struct("column", "missing_count", "missing_pct")).alias("missing"))
    dist = profile_distinct(df).agg(F.collect_list(F.struct("column", "n_distinct")).alias("distinct"))
    desc = profile_numeric(df)
    num = desc.agg(F.collect_list(F.struct(*desc.columns)).alias("numeric"))
    return (shape.withColumn("missing", miss.scalar()).withColumn("distinct", dist.scalar())
                 .withColumn("numeric", num.scalar()))
