"""Seasonal features of pixel series: one aggregate for all that are asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, ShortType

from acreframe.functions.numbers import cyclic_day, ratio, short, whole_deviation, whole_slope, wrapped_day
from acreframe.operators.seasons import season, start_day

KEY = ("cell_id", "row", "col", "spec_index")
STATISTICS = ("maxv", "minv", "amp", "avg", "med", "sd", "cv", "maxd", "maxdc", "mind", "mindc", "slp")
#: Days of the year that stand for the 20th of each month, in common and in leap years.
MONTH_DAYS = {"Jan": (20,), "Feb": (51,), "Mar": (79, 80), "Apr": (110, 111), "May": (140, 141), "Jun": (171, 172), "Jul": (201, 202), "Aug": (232, 233), "Sep": (263, 264), "Oct": (293, 294), "Nov": (324, 325), "Dec": (354, 355)}


def _epoch(date: Column) -> Column:
    return F.unix_date(date)


def _statistic(name: str, inside: Column, first_day: int, year: int, whole: bool) -> Column:
    """An aggregate of the rows inside the season; of whole values without rounding before the cut to 16 bits."""
    v, d = F.when(inside, F.col("value")), F.col("img_date")
    high = F.max_by(d, F.when(inside, F.struct("value", -_epoch(d))))
    low = F.min_by(d, F.when(inside, F.struct("value", _epoch(d))))
    avg16 = short(F.avg(v))
    over, under = whole_deviation(v) if whole else (F.stddev_pop(v), F.lit(1))
    day = F.when(inside, F.date_diff(d, F.make_date(F.lit(year), F.lit(1), F.lit(1))))
    return {
        "maxv": lambda: F.max(v),
        "minv": lambda: F.min(v),
        "amp": lambda: F.max(v) - F.min(v),
        "avg": lambda: avg16,
        "med": lambda: short(F.median(v)),
        "sd": lambda: ratio(over, under),
        "cv": lambda: short(ratio(over * 1000, under * avg16.cast("double"))),
        "maxd": lambda: wrapped_day(F.dayofyear(high), first_day),
        "maxdc": lambda: cyclic_day(F.dayofyear(high)),
        "mind": lambda: wrapped_day(F.dayofyear(low), first_day),
        "mindc": lambda: cyclic_day(F.dayofyear(low)),
        "slp": lambda: short(whole_slope(v, day) if whole else F.regr_slope(v.cast("double"), day.cast("double"))),
    }[name]()


def _month(name: str, year: int, start_month: int) -> Column:
    """The value at the 20th of a month; December only in the first year."""
    month, days = list(MONTH_DAYS).index(name) + 1, MONTH_DAYS[name]
    of = year if start_month <= month or name == "Dec" else year + 1
    d = F.col("img_date")
    at = (F.year(d) == of) & F.dayofyear(d).isin(*days)
    return F.max_by("value", F.when(at, d))


def seasonal_features(pixels: DataFrame, names: list[str], year: int, start_month: int) -> DataFrame:
    """Features such as maxv_yr, cv_wet, mind_dry or Jan_20, in the order asked for, per pixel and index.

    pixels(cell_id, row, col, spec_index, img_date, value).  One scan, one exchange on the pixel, one aggregate.  A pixel without a row
    in any of the seasons isn't returned; a feature without rows is null.  Unknown names raise.
    """
    d, first = F.col("img_date"), start_day(start_month)
    whole = isinstance(pixels.schema["value"].dataType, (ByteType, ShortType, IntegerType))
    columns, needed = [], F.lit(False)
    for name in names:
        kind, _, when = name.rpartition("_")
        if when == "20" and kind in MONTH_DAYS:
            columns.append(_month(kind, year, start_month).alias(name))
            needed = needed | F.year(d).isin(year, year + 1)
        elif kind in STATISTICS and when in ("yr", "wet", "dry"):
            inside = season(when, d, year, start_month)
            columns.append(_statistic(kind, inside, first, year, whole).alias(name))
            needed = needed | inside
        else:
            raise ValueError(f"unknown feature {name}")
    return pixels.where(needed).groupBy(*KEY).agg(*columns)


def packed(pixels: DataFrame) -> DataFrame:
    """One row per pixel and index with its observations in order: a layout for pixels whose features are computed again and again."""
    return pixels.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(F.col("img_date").alias("d"), F.col("value").alias("v")))).alias("obs"))


def packed_features(series: DataFrame, year: int, start_month: int) -> DataFrame:
    """maxv, minv, amp and avg of the crop year from the packed layout, without an exchange."""
    first = start_day(start_month)

    def inside(o: Column) -> Column:
        y, day = F.year(o["d"]), F.dayofyear(o["d"])
        return ((y == year) & (day >= first)) | ((y == year + 1) & (day < first))

    values = F.transform(F.filter("obs", inside), lambda o: o["v"])
    total = F.aggregate(F.col("vs"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    out = series.select(*KEY, values.alias("vs")).where(F.size("vs") > 0)
    return out.select(*KEY, F.array_max("vs").alias("maxv_yr"), F.array_min("vs").alias("minv_yr"), (F.array_max("vs") - F.array_min("vs")).alias("amp_yr"), short(ratio(total, F.size("vs"))).alias("avg_yr"))


def valid_counts(raw: DataFrame) -> DataFrame:
    """Valid observations of each pixel over time."""
    return raw.groupBy("cell_id", "row", "col").agg(F.count_if(F.col("nir") < 10000).alias("n_valid"))


def valid_share(raw: DataFrame) -> DataFrame:
    """Share of valid pixels of each image, zero for an empty one."""
    return raw.groupBy("image_id").agg(F.coalesce(F.try_divide(F.count_if(F.col("nir") < 10000), F.count(F.lit(1))), F.lit(0.0)).alias("valid_share"))


def valid_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whole per cent of valid pixels of each image before and after correction."""
    a = valid_share(before).select("image_id", (F.col("valid_share") * 100).cast("int").alias("before"))
    return a.join(valid_share(after).select("image_id", (F.col("valid_share") * 100).cast("int").alias("after")), "image_id", "left")


def window_errors(pixels: DataFrame, start_by: str, end_from: str, block: int = 256) -> DataFrame:
    """Cells and indices whose last image has empty blocks, or whose series begins late or ends early: (cell_id, spec_index, error)."""
    span = pixels.groupBy("cell_id", "spec_index").agg(F.min("img_date").alias("first"), F.max("img_date").alias("last"))
    blocks = pixels.join(span.select("cell_id", "spec_index", F.col("last").alias("img_date")), ["cell_id", "spec_index", "img_date"]).groupBy("cell_id", "spec_index", F.floor(F.col("row") / block).alias("r"), F.floor(F.col("col") / block).alias("c")).agg(F.avg("value").alias("mean"))
    empty = blocks.where("mean = 0").select("cell_id", "spec_index", F.lit("empty block").alias("error")).distinct()
    late = span.where(F.col("first") > F.lit(start_by).cast("date")).select("cell_id", "spec_index", F.lit("starts late").alias("error"))
    early = span.where(F.col("last") < F.lit(end_from).cast("date")).select("cell_id", "spec_index", F.lit("ends early").alias("error"))
    return empty.union(late).union(early)
