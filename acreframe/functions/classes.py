"""Class schemes of the lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The column of the lookup table for each class scheme.
SCHEMES = {
    "all": "LC25", "max": "LC32", "cropNoCrop": "LC2", "crop_nocrop_medcrop": "LC3", "crop_nocrop_medcrop_tree": "LC4",
    "crop_nocrop_mixcrop": "LC3sm", "veg": "LC5", "veg_with_crop": "LC8", "veg_with_cropType": "LC10", "cropType": "LC_crops", "trans_cats": "LCTrans",
}
#: Classes of which more samples are kept, and names of those that smallholders grow.
MIXED = ("Mixed-VegEdge", "Mixed-path", "Crops-mix")
SMALL_CODES = (23, 24, 25, 26, 32, 34, 35, 36, 39)
BIG_CODES = (22, 31, 33, 37, 38)


def class_column(scheme: str, lut: DataFrame) -> str:
    """Column of the lookup table for a scheme; raises if the table lacks it."""
    name = SCHEMES.get(scheme)
    if name is None:
        raise ValueError(f"unknown class scheme {scheme}")
    if name not in lut.columns:
        raise ValueError(f"the lookup table has no column {name} for {scheme}")
    return name


def one_against_rest(lut: DataFrame, name: str) -> DataFrame:
    """lut with LC1: the name for the one class whose USE_NAME contains it in any case, no_<name> for the others; raises unless there's exactly one."""
    hit = F.lower("USE_NAME").contains(name.lower())
    n = lut.where(hit).count()
    if n != 1:
        raise ValueError(f"{n} classes match {name}")
    return lut.withColumn("LC1", F.when(F.coalesce(hit, F.lit(False)), name).otherwise(f"no_{name}"))


def smallholder(columns: list[str], limit: int, names: tuple[str, ...]) -> Column:
    """1 for crops on small fields: by area (where poly_area is a column), by width, or by class name."""
    crop = F.col("LC2") == 30
    terms = [crop & (F.col("Width") <= limit), F.col("LC25_name").isin(*names)]
    if "var_poly_area" in columns:
        terms.append((F.col("var_poly_area") < limit) & crop & (F.col("LC25") < 40))
    out = F.lit(False)
    for t in terms:
        out = out | F.coalesce(t, F.lit(False))
    return out.cast("int")


def holdout_type(code: str = "LC_UNQ", lc2: str = "LC2") -> Column:
    """smallCrop, bigCrop or noCrop of a fixed holdout, null for the rest."""
    c, two = F.col(code), F.col(lc2)
    return F.when(c.isin(*SMALL_CODES), "smallCrop").when(c.isin(*BIG_CODES) & (two == 30), "bigCrop").when((two == 98) & (c != 19), "noCrop")
