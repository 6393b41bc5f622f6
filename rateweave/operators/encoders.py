"""Fitted preprocessing: split, frequency / one-hot encoding, median imputation,
standard scaling and the full Spark ML preprocessor.

Fitted state is small (one row per category, one value per column) and is
kept as a DataFrame or a saved ``PipelineModel``; applying it is a join on the
category (AQE broadcasts it when small) or a per-row expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.functions.exprs import finite_or_null
from rateweave.operators.joins import attach_stats
from rateweave.session import cut_lineage

# Fixed split settings (20 % test, seed 42).
TEST_FRACTION = 0.2
SPLIT_SEED = 42


# ---------------------------------------------------------------- D-19

def split_bucket(key: str | Column, seed: int = SPLIT_SEED) -> Column:
    """First 8 hex digits of md5('<key>:<seed>'): a uniform 32-bit value, stable
    under repartitioning and reproducible in any engine with md5."""
    k = F.col(key) if isinstance(key, str) else key
    return F.substring(F.md5(F.concat(k.cast("string"), F.lit(f":{seed}"))), 1, 8)


def split_threshold(frac: float) -> str:
    return format(int(frac * (1 << 32)), "08x")


def is_test(key: str | Column, frac: float = TEST_FRACTION, seed: int = SPLIT_SEED) -> Column:
    return split_bucket(key, seed) < F.lit(split_threshold(frac))


def split(df: DataFrame, key: str = "listing_id", frac: float = TEST_FRACTION,
          seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """80/20 train/test split by a hash of the key (deterministic per row)."""
    t = is_test(key, frac, seed)
    return df.filter(~t), df.filter(t)


# ---------------------------------------------------------------- D-13

def fit_frequency(train: DataFrame, c: str) -> DataFrame:
    """Relative frequency of each non-NULL value of ``c`` in train (NULL excluded)."""
    counts = train.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_cnt"))
    total = train.agg(F.count(c).alias("_t")).scalar()
    return counts.withColumn("_tot", total).select(c, (F.col("_cnt") / F.col("_tot")).alias(f"{c}_freq"))


def apply_frequency(df: DataFrame, freq: DataFrame, c: str, unseen_zero: bool = True,
                    replace: bool = False) -> DataFrame:
    """Map values to their train frequency.  ``unseen_zero`` (test side): values
    not in train, and NULL, become 0; otherwise unmatched stays NULL."""
    out_col = f"{c}_freq"
    j = attach_stats(df, freq, c)
    val = F.coalesce(F.col(out_col), F.lit(0.0)) if unseen_zero else F.col(out_col)
    j = j.withColumn(out_col, val)
    return j.drop(c).withColumnRenamed(out_col, c) if replace else j


# ---------------------------------------------------------------- D-14

def category_table(train: DataFrame, c: str) -> DataFrame:
    """(``c``, ``<c>_index``): the distinct values in order with their positions, at any number
    of values.  Ranges of values are numbered one by one, after the counts of those before."""
    own = train.filter(F.col(c).isNotNull()).select(c).distinct().repartitionByRange(c)
    own = cut_lineage(own.withColumn("_p", F.spark_partition_id()))
    counts = own.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_b"))   # a row per range
    return own.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(c)) - 1).join(before, "_p").select(
        c, (F.col("_b") + F.col("_r")).cast("int").alias(f"{c}_index"))


def fit_categories(train: DataFrame, c: str) -> list[str]:
    """Sorted distinct values as a list, for columns that the caller knows to have few:
    indicator columns must be known when planning.  For others there is ``category_table``."""
    return [r[0] for r in category_table(train, c).orderBy(f"{c}_index").collect()]


def one_hot(df: DataFrame, c: str, categories: Sequence[str], drop_input: bool = True) -> DataFrame:
    """``<c>_<value>`` indicator columns; unseen values and NULL -> all zeros."""
    inds = [F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}") for v in categories]
    out = df.select("*", *inds)
    return out.drop(c) if drop_input else out


def category_index(df: DataFrame, c: str, categories: Sequence[str] | DataFrame, out: str | None = None) -> DataFrame:
    """Position of the value in the sorted train categories (0-based); unseen/NULL -> NULL."""
    name = out or f"{c}_index"
    if isinstance(categories, DataFrame):
        return attach_stats(df, categories.withColumnRenamed(f"{c}_index", name), c)
    m = F.create_map(*[x for i, v in enumerate(categories) for x in (F.lit(v), F.lit(i))])
    return df.withColumn(name, F.when(F.col(c).isNotNull(), m[F.col(c)]))


def one_hot_vector(df: DataFrame, c: str, table: DataFrame, drop_input: bool = True) -> DataFrame:
    """``<c>_onehot``: a sparse indicator vector over ``category_table``'s values, at any number
    of them; unseen values and NULL -> all zeros."""
    from pyspark.ml.feature import OneHotEncoder

    n = table.count()
    indexed = category_index(df, c, table, "_idx").withColumn("_idx", F.coalesce(F.col("_idx"), F.lit(n)).cast("double"))
    sizes = df.sparkSession.range(n, n + 1).select(F.col("id").cast("double").alias("_idx"))
    coded = OneHotEncoder(inputCol="_idx", outputCol=f"{c}_onehot", dropLast=True).fit(sizes).transform(indexed)
    return coded.drop("_idx", *([c] if drop_input else []))


# ---------------------------------------------------------------- D-15 / D-16

@dataclass
class ColumnStats:
    values: dict

    def apply_fill(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.coalesce(finite_or_null(F.col(c)), F.lit(self.values[c])).alias(c)
                           if c in self.values else F.col(c) for c in df.columns])


def fit_median_imputer(train: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> ColumnStats:
    """Train medians (exact by default); an all-NULL column gets 0."""
    from rateweave.operators.quantiles import column_quantiles

    q = column_quantiles(train.select(*[finite_or_null(F.col(c)).alias(c) for c in cols]), cols, [0.5], accuracy)
    return ColumnStats({c: (q[c][0] if q[c][0] is not None else 0.0) for c in cols})


def fit_std_scaler(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and *population* std per column in one aggregation (one row)."""
    return train.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols],
                     *[F.stddev_pop(c).alias(f"{c}__std") for c in cols])


def apply_std_scaler(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / std, std 0 -> 1.  Statistics join as one scalar subquery."""
    s = stats.select(F.struct(*stats.columns)).scalar()
    d = df.withColumn("_sc", s)
    exprs = []
    for c in df.columns:
        if c in cols:
            std = F.col(f"_sc.{c}__std")
            exprs.append(((F.col(c) - F.col(f"_sc.{c}__mean")) /
                          F.when(std == 0, F.lit(1.0)).otherwise(std)).alias(c))
        else:
            exprs.append(F.col(c))
    return d.select(*exprs)


# ---------------------------------------------------------------- D-18

def feature_columns(df: DataFrame, label: str = "demand_score", exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical inputs by type (text and booleans are categories), without the
    label and ``exclude`` (ids and raw text that is no category)."""
    from rateweave.operators.profile import numeric_columns

    numeric = numeric_columns(df, exclude=[label, *exclude])
    kinds = ("string", "boolean")
    return numeric, [f.name for f in df.schema.fields if f.dataType.typeName() in kinds and f.name not in exclude]


def build_preprocessor(numeric: Sequence[str], categorical: Sequence[str], label: str = "demand_score",
                       features_out: str = "features"):
    """Spark ML pipeline: listing features -> (numeric: finite, exact median, population scale) +
    (categorical: text, 'missing', one-hot in sorted order, unseen -> zeros) -> one vector, the
    numeric columns first.  Fits with distributed aggregates only."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    from rateweave.operators.stages import CategoryTexts, ListingFeatures, MedianScaler

    num = [c for c in numeric if c != label]
    stages = [ListingFeatures(), CategoryTexts(inputCols=list(categorical)), MedianScaler(inputCols=num)]
    for c in categorical:
        stages.append(StringIndexer(inputCol=f"{c}__c", outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", dropLast=True,
                                    handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*[f"{c}__z" for c in num], *[f"{c}__oh" for c in categorical]],
                                  outputCol=features_out))
    return Pipeline(stages=stages)
