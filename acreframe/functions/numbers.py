"""Numeric column functions that hold under ANSI mode."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def short(c: str | Column) -> Column:
    """Cut towards zero to 16 bits; what doesn't fit, and what isn't a number, becomes null."""
    return col(c).try_cast("double").try_cast("bigint").try_cast("smallint")


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def _spread(n: Column, xy: Column, x: Column, y: Column) -> Column:
    """n * sum(x y) - sum(x) * sum(y), exact."""
    n, xy, x, y = (c.cast("decimal(19,0)") for c in (n, xy, x, y))
    return n * xy - x * y


def whole_slope(y: Column, x: Column) -> Column:
    """Least squares slope of whole y over whole x, both small (sums of products fit 64 bits), cut towards zero: an aggregate without rounding.

    In floating point a slope that is whole comes out above or below, by the order of the rows.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x).cast("bigint"), F.when(both, y).cast("bigint")
    n = F.count(x)
    over, under = _spread(n, F.sum(x * y), F.sum(x), F.sum(y)), _spread(n, F.sum(x * x), F.sum(x), F.sum(x))
    return F.call_function("div", over, F.nullif(under, F.lit(0).cast("decimal(38,0)")))


def whole_deviation(x: Column) -> tuple[Column, Column]:
    """Aggregates whose quotient is the population's standard deviation of small whole numbers: the first is whole wherever the deviation is a fraction."""
    x = x.cast("bigint")
    n = F.count(x)
    return F.sqrt(_spread(n, F.sum(x * x), F.sum(x), F.sum(x)).cast("double")), n


def wrapped_day(day: Column, start_day: int) -> Column:
    """Day of year that goes on counting past 31 December, for seasons that begin on start_day."""
    return F.when(day >= start_day, day).otherwise(day + 365)


def cyclic_day(day: Column) -> Column:
    """100 (cos(2 pi day / 365) + 1), cut to a whole number: near for days on either side of New Year."""
    return short(100 * (F.cos(2 * math.pi * day / 365) + 1))


def valid(c: str | Column, above: float | None = 0, below: float = 10000) -> Column:
    """The value where it lies strictly between the bounds, else null."""
    c = col(c)
    return F.when((c < below) & ((c > above) if above is not None else F.lit(True)), c)


def shift_length(x: str | Column, y: str | Column) -> Column:
    return F.hypot(col(x), col(y))


def stretch(c: Column, low: Column, high: Column) -> Column:
    """Where c lies between low (at least zero) and high, from 0 to 1; negative values count as zero."""
    low = F.greatest(low, F.lit(0))
    return ratio(F.greatest(c, F.lit(0)) - low, high - low)


def gamma(c: Column, g: float) -> Column:
    return F.pow(F.greatest(c, F.lit(0)).cast("double"), F.lit(1 / g))


def cropped_area(c: str | Column) -> Column:
    """Areas that ran over 16 bits and became negative count as the largest."""
    c = col(c)
    return F.when(c < 0, 32767).otherwise(c)


def filled_short(c: str | Column) -> Column:
    """Model input: 16 bits, zero for what is missing."""
    return F.coalesce(short(c), F.lit(0).cast("smallint"))
