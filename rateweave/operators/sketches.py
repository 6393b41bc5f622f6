"""Approximate profiles as mergeable state (C-3, C-4 for tables that grow).

The state of a table is a small table of its own: (column, kind, bucket, n).

* ``distinct``: registers of a HyperLogLog sketch with 2**``BITS`` buckets.  A value's hash names the
  bucket, n is the largest rank of a first set bit seen there.  Registers merge by maximum.  The
  standard error of the estimate is 1.04 / sqrt(2**BITS).
* ``quantile``: counts of values by logarithmic buckets, each as wide as ``ALPHA`` allows, signs
  apart.  Counts merge by sum.  A quantile's estimate differs from the value of that rank by at
  most the part ``ALPHA`` of it.
* ``rows`` and ``missing``: plain counts (NULL, and for numbers NaN and infinities, are missing).

As merging is a maximum or a sum, the state of files profiled one by one and merged is the very
state of one pass over all of them, in any order.  A column has at most 2**BITS registers and some
thousand buckets, whatever its rows; all of it is partial aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateweave.functions.exprs import finite_or_null

BITS = 12
ALPHA = 0.01
#: Absolute values below this count as 0.
LEAST = 1e-300
STATE = "column string, kind string, bucket long, n long"


def _bucket(value: Column, alpha: float) -> Column:
    """Place on the line: 0 for 0, else the logarithmic bucket moved to be positive, with the sign."""
    gamma = (1 + alpha) / (1 - alpha)
    shift = math.ceil(-math.log(LEAST) / math.log(gamma)) + 1
    at = F.ceil(F.log(F.abs(value)) / F.lit(math.log(gamma))) + F.lit(shift)
    return F.when(F.abs(value) < LEAST, F.lit(0)).otherwise(F.signum(value) * at).cast("long")


def _value(bucket: Column, alpha: float) -> Column:
    """The value in the middle of a bucket."""
    gamma = (1 + alpha) / (1 - alpha)
    shift = math.ceil(-math.log(LEAST) / math.log(gamma)) + 1
    return F.when(bucket == 0, F.lit(0.0)).otherwise(
        F.signum(bucket.cast("double")) * F.pow(F.lit(gamma), F.abs(bucket) - F.lit(shift)) * F.lit(2 / (1 + gamma)))


def profile_state(df: DataFrame, numeric: Sequence[str] = (), texts: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """The state of a table: quantiles of ``numeric`` columns, distinct values of ``texts`` (any type)."""
    pairs = [F.struct(F.lit(c).alias("column"), F.lit("quantile").alias("kind"), finite_or_null(F.col(c).cast("double")).alias("x"),
                      F.lit(None).cast("long").alias("h")) for c in numeric]
    pairs += [F.struct(F.lit(c).alias("column"), F.lit("distinct").alias("kind"), F.lit(None).cast("double").alias("x"),
                       F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("h")) for c in texts]
    long = df.select(F.inline(F.array(*pairs)))
    rest = F.shiftleft("h", BITS)
    # the first set bit of the rest, in 52 bits; all of them 0: one more
    rank = F.when(rest == 0, F.lit(64 - BITS + 1)).otherwise(F.lit(65) - F.length(F.bin(rest))).cast("long")
    missing = F.when(F.col("kind") == "quantile", F.col("x").isNull()).otherwise(F.col("h").isNull())
    bucket = F.when(F.col("kind") == "quantile", _bucket(F.col("x"), alpha)).otherwise(F.shiftrightunsigned("h", 64 - BITS))
    own = long.select("column", F.when(missing, "missing").otherwise(F.col("kind")).alias("kind"),
                      F.when(missing, F.lit(0).cast("long")).otherwise(bucket).alias("bucket"), rank.alias("rank"))
    counted = own.groupBy("column", "kind", "bucket").agg(F.when(F.first("kind") == "distinct", F.max("rank")).otherwise(
        F.count(F.lit(1))).alias("n"))
    rows = df.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[F.lit(c) for c in [*numeric, *texts]])).alias("column"),
                                                       F.lit("rows").alias("kind"), F.lit(0).cast("long").alias("bucket"), "n")
    return counted.unionByName(rows)


def merge_states(state: DataFrame) -> DataFrame:
    """One state from the rows of several."""
    return state.groupBy("column", "kind", "bucket").agg(F.when(F.first("kind") == "distinct", F.max("n")).otherwise(
        F.sum("n")).alias("n"))


def add_to_state(state_path: str, df: DataFrame, numeric: Sequence[str] = (), texts: Sequence[str] = ()) -> None:
    """Profile new rows only and append their state to the table at ``state_path``."""
    profile_state(df, numeric, texts).write.mode("append").parquet(state_path)


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """The merged state of all that was added."""
    return merge_states(spark.read.schema(STATE).parquet(state_path))


def distinct_estimates(state: DataFrame) -> DataFrame:
    """(column, n_distinct) of each column with registers: linear counting while registers are empty and
    the estimate is small, the harmonic mean beyond."""
    m = 1 << BITS
    sums = state.where("kind = 'distinct'").groupBy("column").agg(
        F.count(F.lit(1)).alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("n"))).alias("s"))
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("s") + (F.lit(m) - F.col("used")))
    small = F.lit(float(m)) * F.log(F.lit(float(m)) / (F.lit(m) - F.col("used")))
    return sums.select("column", F.round(F.when((F.col("used") < m) & (raw <= 2.5 * m), small).otherwise(raw)).cast("long")
                       .alias("n_distinct"))


def quantile_estimates(state: DataFrame, probs: Sequence[float], alpha: float = ALPHA) -> DataFrame:
    """(column, p, value): about the value of rank floor(p (n - 1)) of each column with counts."""
    own = state.where("kind = 'quantile'")
    line = Window.partitionBy("column").orderBy("bucket")
    upto = own.withColumn("upto", F.sum("n").over(line)).withColumn("all", F.sum("n").over(Window.partitionBy("column")))
    asked = upto.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    rank = F.floor(F.col("p") * (F.col("all") - 1))
    return asked.where((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)).select(
        "column", "p", _value(F.col("bucket"), alpha).alias("value"))
