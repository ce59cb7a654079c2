"""Numeric semantics of the reference's SQL, expressed with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def int_div(a: str | Column, b: str | Column) -> Column:
    """Integer division truncating toward zero (``bigint / bigint`` in the reference)."""
    return F.call_function("div", _c(a), _c(b))


def round_half_away(col: str | Column, digits: int) -> Column:
    """``ROUND(x, d)`` half away from zero, on the value's first ten decimals.

    The DOUBLE becomes a DECIMAL first, so 2.675 that a sum left a few ulps short is a tie again, while
    1.0049999999 is not.  Values that don't fit (NaN, infinities, over 28 digits) stay as they are.
    """
    c = _c(col).cast("double")
    return F.coalesce(F.round(c.try_cast("decimal(38,10)"), digits).cast("double"), c)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / NULLIF(den, 0)`` in double arithmetic (NULL when den is 0 or NULL)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def settle_doubles(df: DataFrame, bits: int = 20) -> DataFrame:
    """Snap every DOUBLE column to the nearest multiple of ``2**-bits`` (about 1e-6).

    For comparing results across engines whose floating-point sums differ in the last bits; operators
    and the command line return full precision.  A binary grid is used on purpose: no terminating
    decimal (money, averages of money over 2^k rows) lies exactly on a half-way point of it.  All in
    DOUBLE arithmetic, so large values, NaN and infinities pass unchanged.
    """
    k = float(2 ** bits)
    return df.select(*[(F.rint(F.col(f.name) * k) / k).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])
