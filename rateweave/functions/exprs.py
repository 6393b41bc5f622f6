"""Column-level building blocks.  Everything here returns a ``Column`` built from
JVM-side built-in functions, so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_double(x: float) -> Column:
    return F.lit(float(x)).cast("double")


# ---------------------------------------------------------------- numerics

def safe_div(num: str | Column, den: str | Column) -> Column:
    """x / y with NULL instead of an error or ±inf when y is 0 (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def finite_or_null(c: str | Column) -> Column:
    """NaN and ±inf become NULL (the library's single missing-value convention)."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def clip_lower(c: str | Column, lo: float) -> Column:
    """``greatest`` that keeps NULL (``greatest(NULL, 0)`` would return 0)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def round_half_even_fp(c: str | Column, digits: int = 2) -> Column:
    """Rounding the way numpy rounds floats: ``rint(x * 10^d) / 10^d``.

    Spark's ``round``/``bround`` round the shortest decimal string instead, which
    differs on values such as 6.335 (numpy: 6.34)."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def fmt2(c: str | Column) -> Column:
    """Two-decimal text of the double's exact value, ties to even (C's ``%.2f``).

    The JVM formats the shortest decimal instead, half up, which differs for 0.125 or
    2.675.  x * 100 is split into a rounded product and its exact error, so the side of
    the tie is known; what is formatted then has two decimals already."""
    x = F.abs(col(c))
    p = x * F.lit(100.0)
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    error = (high * F.lit(100.0) - p) + (x - high) * F.lit(100.0)
    whole = F.floor(p).cast("double")
    rest = p - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    cents = F.when(up, whole + F.lit(1.0)).otherwise(whole)
    exact = F.when(x < F.lit(1e13), cents / F.lit(100.0)).otherwise(x)      # beyond, doubles have no cents
    return F.concat(F.when(col(c).cast("string").startswith("-"), F.lit("-")).otherwise(F.lit("")), F.format_string("%.2f", exact))


# ---------------------------------------------------------------- text

# Decimal notation only: the JVM's parser also takes suffixes ('5d') and 'Infinity'.
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def parse_number(c: str | Column, strict: bool = False) -> Column:
    """Text in decimal notation -> finite double; other text -> NULL, or an error when strict."""
    text = F.trim(col(c).cast("string"))
    other = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double") if strict else F.lit(None).cast("double")
    return F.when(text.rlike(NUMBER), finite_or_null(text.try_cast("double"))).when(text.isNotNull(), other)


def parse_money(c: str | Column, strict: bool = False) -> Column:
    """'$1,234' -> 1234.0.  Non-numeric text -> NULL, or a runtime error when strict."""
    return parse_number(F.regexp_replace(col(c).cast("string"), r"[$,]", ""), strict)


def std_text(c: str | Column) -> Column:
    return F.lower(F.trim(col(c)))


# ---------------------------------------------------------------- features

def availability_bucket(c: str | Column = "availability_365", low: float = 120, mid: float = 240) -> Column:
    """<=120 low, <=240 medium, else high.  NULL compares false everywhere -> high."""
    c = col(c)
    return F.when(c <= low, "low").when(c <= mid, "medium").otherwise("high")


def log1p_clip(c: str | Column = "price", clip: bool = True) -> Column:
    c = col(c)
    return F.log1p(clip_lower(c, 0.0) if clip else c)


# ---------------------------------------------------------------- pricing

# Fixed values that must equal the reference's for identical results.
DEFAULT_ELASTICITY = -1.2
KEEP_THRESHOLD = 0.02


def elastic_demand(base: str | Column, current: str | Column, new: str | Column,
                   elasticity: float | str | Column = DEFAULT_ELASTICITY) -> Column:
    """base * (new / current) ^ e, floored at 0.  current = 0 -> NULL (never chosen)."""
    e = col(elasticity) if isinstance(elasticity, (str, Column)) else lit_double(elasticity)
    raw = col(base) * F.pow(safe_div(new, current), e)
    return clip_lower(raw, 0.0)


def grid_point(lo: Column, hi: Column, i: int, n: int) -> Column:
    """i-th of n evenly spaced points from lo to hi, last point exactly hi."""
    if n == 1:
        return lo
    if i == n - 1:
        return hi
    return lo + F.lit(float(i)) * ((hi - lo) / F.lit(float(n - 1)))

