"""Season filters on dated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def start_day(start_month: int) -> int:
    """First day of a crop year that begins in the month."""
    return int(30.5 * start_month) - 30


def crop_year(date: Column, year: int, start_month: int) -> Column:
    """From the start day of the year up to that of the next."""
    first, day = start_day(start_month), F.dayofyear(date)
    return ((F.year(date) == year) & (day >= first)) | ((F.year(date) == year + 1) & (day < first))


def season(name: str, date: Column, year: int, start_month: int) -> Column:
    """yr: the crop year; wet: its days after 306 or before 61; dry: days 184 to 258 of the year itself, whatever the crop year."""
    day = F.dayofyear(date)
    if name == "yr":
        return crop_year(date, year, start_month)
    if name == "wet":
        return crop_year(date, year, start_month) & ((day > 306) | (day < 61))
    if name == "dry":
        return (F.year(date) == year) & (day > 183) & (day < 259)
    raise ValueError(f"unknown season {name}")


def phenology_season(name: str, date: Column, year: int, pad: tuple[int, int] = (0, 0), start: int = 305, turn: int = 122) -> Column:
    """dry and wet halves of a year by fixed days, with days of padding on the left and right; yr is both."""
    left, right = pad
    y, day = F.year(date), F.dayofyear(date)
    dry = (y == year) & (day >= turn - right) & (day < start + left)
    wet = ((y == year) & (day >= start - left)) | ((y == year + 1) & ((day < turn + right) if right else (day <= turn)))
    if name == "dry":
        return dry
    if name == "wet":
        return wet
    if name == "yr":
        return dry | wet
    raise ValueError(f"unknown season {name}")


def series_window(date: Column, first_year: int, last_year: int) -> Column:
    """From day 150 of the first year to day 150 of the last, both included."""
    return (date >= F.date_add(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), 149)) & (date <= F.date_add(F.make_date(F.lit(last_year), F.lit(1), F.lit(1)), 149))


def monthly_series(series: DataFrame, month: int) -> DataFrame:
    """Rows of one month, with the key YYYYDDD."""
    return series.where(F.month("img_date") == month).withColumn("yyyyddd", F.date_format("img_date", "yyyyDDD"))


def days_of_year(series: DataFrame, year: int, first: int, last: int) -> DataFrame:
    return series.where((F.year("img_date") == year) & F.dayofyear("img_date").between(first, last))
