"""Schema handling, predicates and cleaning (names, contracts, types, fills, imputation).

Imputation statistics are global aggregates evaluated once as scalar
subqueries; exact medians come from the distributed quantile operator
(``quantiles.exact_quantiles``), which never gathers a column into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import finite_or_null, parse_money, parse_number, std_text
from rateweave.sources.io import INFERENCE_SCHEMA

# Fixed values used by the cleaning steps.
ID_ALIASES = {"id": "listing_id"}
CATEGORICAL_FILL = "Unknown"
NUMERICAL_FILL = 0.0
MISSING_CATEGORY = "missing"
DROPPED_RAW_COLUMNS = ["license", "house_rules", "host_name", "name", "country_code", "construction_year"]
LEAKAGE_COLUMNS = ["reviews_per_month", "availability_365"]
AVAILABILITY_RANGE = (0.0, 366.0)
DEFAULT_COUNTRY = "United States"


def normalize_name(name: str, aliases: Mapping[str, str] | None = None) -> str:
    n = name.strip().lower().replace(" ", "_")
    return dict(ID_ALIASES if aliases is None else aliases).get(n, n)


def normalize_columns(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """B-1: trim, lower-case, spaces -> '_', then alias (``id`` -> ``listing_id``)."""
    return df.toDF(*[normalize_name(c, aliases) for c in df.columns])


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-2: raise listing every missing column (in the order given)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError("input lacks columns: " + ", ".join(missing))
    return df


def enforce_types(df: DataFrame, schema: Mapping[str, str] = INFERENCE_SCHEMA) -> DataFrame:
    """B-3: numerical -> double (unparseable -> NULL), categorical -> string."""
    exprs = []
    for c in df.columns:
        role = schema.get(c)
        if role == "numerical":
            text = df.schema[c].dataType.typeName() == "string"
            exprs.append((parse_number(c) if text else finite_or_null(F.col(c).cast("double"))).alias(c))
        elif role == "categorical":
            exprs.append(F.col(c).cast("string").alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def fill_missing(df: DataFrame, schema: Mapping[str, str] = INFERENCE_SCHEMA) -> DataFrame:
    """B-4: numerical NULL -> 0, categorical NULL -> 'Unknown'."""
    num = {c: NUMERICAL_FILL for c, r in schema.items() if r == "numerical" and c in df.columns}
    cat = {c: CATEGORICAL_FILL for c, r in schema.items() if r == "categorical" and c in df.columns}
    return df.na.fill(num).na.fill(cat)


def prepare_inference_input(df: DataFrame, schema: Mapping[str, str] = INFERENCE_SCHEMA,
                            keep_extra: bool = True) -> DataFrame:
    """B-1..B-4 chain of the inference input stage."""
    out = require_columns(normalize_columns(df), list(schema))
    out = fill_missing(enforce_types(out, schema), schema)
    return out if keep_extra else out.select(*schema)


def parse_money_columns(df: DataFrame, cols: Sequence[str] = ("price", "service_fee"),
                        strict: bool = False) -> DataFrame:
    """B-5: '$1,234' -> 1234.0 on the given columns."""
    return df.select(*[parse_money(c, strict).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str] = DROPPED_RAW_COLUMNS) -> DataFrame:
    """B-6 / B-14: drop the columns that exist (absent names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_leakage(df: DataFrame, cols: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return drop_columns(df, cols)


def impute_median(df: DataFrame, cols: Sequence[str], approx_accuracy: int | None = None) -> DataFrame:
    """B-7: NULL -> median of the column.  Exact by default (distributed
    selection), or ``percentile_approx`` with the given accuracy."""
    from rateweave.operators.quantiles import column_quantiles

    med = column_quantiles(df, list(cols), [0.5], accuracy=approx_accuracy)
    fills = {c: med[c][0] for c in cols if med[c][0] is not None}
    # as double: the median of an integer column can lie between two integers
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c) if c in fills else F.col(c)
                       for c in df.columns])


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value of each column (ties -> smallest), as text.

    All columns are counted in one aggregation by (column, value), with partial counts per
    task; the pick is ``min_by`` over (-count, value), so no task holds more than its share
    of distinct values.  One row for each column comes to the driver."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in
               ("double", "float", "integer", "long", "short", "byte", "decimal")}
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(
        F.lit(c).alias("c"), F.col(c).cast("string").alias("v"),
        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("x")) for c in cols]))
    counts = df.select(pairs.alias("_p")).select("_p.*").where("v is not null").groupBy("c", "v", "x").agg(
        F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("x"), F.col("v"))).alias("v")).collect()
    return {c: None for c in cols} | {r["c"]: r["v"] for r in found}


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-8: NULL -> most frequent value; ties -> smallest value."""
    modes = mode_values(df, cols)
    return df.select(*[F.coalesce(F.col(c), F.lit(modes[c]).cast(df.schema[c].dataType)).alias(c)
                       if modes.get(c) is not None else F.col(c) for c in df.columns])


def impute_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """B-9: NULL -> constant per column."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def standardize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-10: lower(trim(x))."""
    return df.select(*[std_text(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def filter_range(df: DataFrame, c: str = "availability_365", lo: float = AVAILABILITY_RANGE[0],
                 hi: float = AVAILABILITY_RANGE[1]) -> DataFrame:
    """B-11: keep lo <= c <= hi; NULL rows are dropped."""
    return df.filter(F.col(c).between(lo, hi))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """B-12: drop rows with a NULL in ``subset`` (all columns by default)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def prep_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-15: to string, NULL -> 'missing'."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


# Fixed steps of the batch cleaning: which column is filled with what.
MEDIAN_COLUMNS = ["availability_365", "minimum_nights", "review_rate_number", "calculated_host_listings_count",
                  "price", "service_fee"]
MODE_COLUMNS = ["instant_bookable", "neighbourhood_group", "cancellation_policy"]
ZERO_COLUMNS = ["reviews_per_month", "number_of_reviews"]


def clean_batch(df: DataFrame) -> DataFrame:
    """H-4 cleaning block, on the columns that are there: drop raw columns, parse money, fill
    with median, mode (the policy after its text is standardised), country and 0, then keep
    valid availability.

    Where the original computes a fill without keeping it (the first four medians and the
    country), the fill is made, as its text says it should be."""
    has = lambda cols: [c for c in cols if c in out.columns]
    out = drop_columns(df)
    out = parse_money_columns(out, has(("price", "service_fee")))
    out = impute_median(out, has(MEDIAN_COLUMNS))
    out = standardize_text(out, has(("cancellation_policy",)))
    out = impute_mode(out, has(MODE_COLUMNS))
    out = impute_const(out, {c: v for c, v in ({"country": DEFAULT_COUNTRY} | {z: 0.0 for z in ZERO_COLUMNS}).items()
                             if c in out.columns})
    return filter_range(out)
