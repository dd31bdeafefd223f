"""File and scene names, and dates in them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acreframe.functions.numbers import col


def part(name: str | Column, n: int) -> Column:
    """n-th part between underscores, from 1; empty beyond the last."""
    return F.split_part(col(name), F.lit("_"), F.lit(n))


def day_of(year: str | Column, day: str | Column) -> Column:
    """Date of a day of a year; days past its end run on into the next."""
    return F.date_add(F.make_date(col(year).cast("int"), F.lit(1), F.lit(1)), col(day).cast("int") - 1)


def date_of_yyyyddd(text: str | Column) -> Column:
    text = col(text).cast("string")
    year, day = F.substring(text, 1, 4).try_cast("int"), F.substring(text, 5, 3).try_cast("int")
    return F.when(F.length(text) >= 7, day_of(year, day))


def date_of_yyyymmdd(text: str | Column) -> Column:
    """Null where the text isn't a date."""
    return F.try_to_timestamp(col(text), F.lit("yyyyMMdd")).cast("date")


def image_date(name: str | Column, image_type: str = "smooth") -> Column:
    """Date of an image from its file name.

    smooth: the first seven characters are YYYYDDD; raw: part 4 holds YYYYMMDD; raw_sentinel: part 3 does.
    """
    if image_type == "smooth":
        return date_of_yyyyddd(F.substring(col(name), 1, 7))
    if image_type in ("raw", "raw_sentinel"):
        return date_of_yyyymmdd(F.substring(part(name, 4 if image_type == "raw" else 3), 1, 8))
    raise ValueError(f"unknown image type {image_type}")


def stac_fields(name: str | Column) -> dict[str, Column]:
    """sensor, date, base, quality, yr and yrmo of a catalogue-style file name."""
    name, when = col(name), F.substring(part(name, 4), 1, 8)
    return {
        "sensor": F.substring(part(name, 1), 1, 4),
        "date": when,
        "base": F.substring_index(name, "_", 4),
        "quality": F.when(name.endswith("X.nc"), "low_quality").otherwise("image_used"),
        "yr": F.substring(when, 1, 4),
        "yrmo": F.substring(when, 1, 6),
    }


def export_fields(name: str | Column) -> dict[str, Column]:
    """sensor and date of an exported file name, whose date stands further right behind L1C_."""
    name = col(name)
    return {"sensor": F.substring(name, 1, 4), "date": F.when(name.contains("L1C_"), F.substring(name, 20, 8)).otherwise(F.substring(name, 18, 8))}


def scene_fields(scene: str | Column) -> dict[str, Column]:
    """sensor (lower case), date and yr of a scene id: in part 4 for Landsat, in part 3 for Sentinel."""
    scene = col(scene)
    sensor = F.lower(F.substring(scene, 1, 4))
    when = F.substring(F.when(sensor.startswith("l"), part(scene, 4)).otherwise(part(scene, 3)), 1, 8)
    return {"sensor": sensor, "date": when, "yr": F.substring(when, 1, 4)}


def scene_of_product(product: str | Column) -> Column:
    """Scene id of a corrected product: Landsat keeps sensor, path/row, date and tier parts, Sentinel sensor, tile, date and number."""
    landsat = F.concat_ws("_", part(product, 1), F.lit("L2SP"), part(product, 2), part(product, 3), F.lit("02"), F.lit("T1"))
    sentinel = F.concat_ws("_", part(product, 1), part(product, 2), part(product, 3), F.lit("0"), F.lit("L2A"))
    return F.when(F.lower(F.substring(part(product, 1), 1, 1)) == "l", landsat).otherwise(sentinel)


def bandpass(product: str | Column) -> Column:
    """Whether a product name says that bands were adjusted: true for L3B, false for L3A, else null."""
    name = col(product)
    return F.when(name.contains("L3B"), True).when(name.contains("L3A"), False)


def other_catalogue_id(scene: str | Column) -> Column:
    """A Sentinel id in the form of the other provider: mission_tile_date_0_level."""
    level = F.substring(part(scene, 2), 4, 3)
    return F.concat_ws("_", part(scene, 1), F.substring(part(scene, 5), 2, 5), F.substring(part(scene, 3), 1, 8), F.lit("0"), level)


def cell_name(cell: str | Column) -> Column:
    return F.lpad(col(cell).cast("string"), 6, "0")


def train_years(years: list[int]) -> str:
    """Last two digits of the year, or of the first and the last of several."""
    last = [f"{y % 100:02d}" for y in sorted(years)]
    return last[0] if len(last) == 1 else last[0] + last[-1]


def model_name(features: str, sample: str, class_col: str, years: list[int], year: int | None = None) -> str:
    return "_".join([features, sample, class_col, train_years(years), "RF", *([str(year)] if year else [])])


def sample_parts(name: str | Column) -> dict[str, Column]:
    """Base and mix of a sample name such as bal300mix8."""
    return {"base": F.regexp_extract(col(name), r"^(.*?)(mix\d+)?$", 1), "mix": F.regexp_extract(col(name), r"mix(\d+)$", 1).try_cast("int")}


def late_l7(sensor: str | Column, date: str | Column, year: int = 2017) -> Column:
    """Landsat 7 images from the drift of its orbit on."""
    return (F.upper(col(sensor)) == "LE07") & (F.year(col(date)) >= year)
