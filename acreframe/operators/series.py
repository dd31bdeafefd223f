"""Point time series, long and wide."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreframe.functions.indices import whole_ndvi


def row_statistics(series: DataFrame) -> DataFrame:
    """ALL, the mean over points per date, and stdv over points and that mean with one degree of freedom less: the population deviation.

    series(point_id, img_date, value); nulls don't count.
    """
    return series.groupBy("img_date").agg(F.avg("value").alias("ALL"), F.stddev_pop("value").alias("stdv"))


def long_series(wide: DataFrame, date: str = "date", drop: tuple[str, ...] = ("ALL", "stdv")) -> DataFrame:
    """(img_date, point_id, value) from a column per point."""
    points = [c for c in wide.columns if c not in (date, *drop)]
    return wide.select(F.col(date).alias("img_date"), *[F.col(f"`{c}`").cast("double").alias(c) for c in points]).unpivot("img_date", [f"`{c}`" for c in points], "point_id", "value")


def wide_series(series: DataFrame, points: list[str]) -> DataFrame:
    """A column per listed point, with ALL and stdv, in order of date: for export.  Several values of a point on a date are averaged."""
    return series.groupBy("img_date").pivot("point_id", points).agg(F.avg("value")).join(row_statistics(series), "img_date").orderBy("img_date")


def filled(series: DataFrame, key: list[str], column: str = "value") -> DataFrame:
    """Forward and then backward fill in order of date, and the step from the date before."""
    line = Window.partitionBy(*key).orderBy("img_date")
    ahead = F.last(column, True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    behind = F.first(column, True).over(line.rowsBetween(0, Window.unboundedFollowing))
    out = series.withColumn("filled", F.coalesce(ahead, behind))
    return out.withColumn("step", F.col("filled") - F.lag("filled").over(line))


def point_sample(series: DataFrame, cls: str | None = None) -> DataFrame:
    """Points of one class."""
    return series if cls is None else series.where(F.col("Class") == cls)


def monthly_ndvi(images: DataFrame) -> DataFrame:
    """(key, month, ndvi, n): the mean of whole ndvi over the images(cell_id, row, col, img_date, bands) of each pixel and month."""
    month = F.trunc("img_date", "month").alias("month")
    return images.groupBy("cell_id", "row", "col", month).agg(F.avg(whole_ndvi()).alias("ndvi"), F.count(whole_ndvi()).alias("n"))
