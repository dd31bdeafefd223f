"""Class maps rolled up by zone, joined into mosaics, and described."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.functions.numbers import gamma, stretch


def product_classes(products: DataFrame) -> DataFrame:
    """(product, grp, class) of products(product, classes MAP<group, codes>)."""
    groups = products.select("product", F.explode("classes").alias("grp", "codes"))
    return groups.select("product", "grp", F.explode("codes").alias("class"))


def zonal_shares(zoned: DataFrame, groups: DataFrame, twice: tuple[int, ...] = ()) -> DataFrame:
    """(zone_id, grp, n, share, numpix): per cent of a zone's pixels in each group of classes, to one place.

    zoned(zone_id, class), groups(class, grp): a class belongs to one group, but for those listed in `twice`, which are
    counted in each.  Classes without a group make the group other, missing shares are null.  Pixels are counted by zone and class
    before the groups are joined.
    """
    counts = zoned.groupBy("zone_id", "class").agg(F.count("*").alias("n"))
    first = groups.where(F.col("class").isin(*twice)) if twice else groups.where(F.lit(False))
    single = groups.where(~F.col("class").isin(*twice) if twice else F.lit(True)).groupBy("class").agg(F.min("grp").alias("grp"))
    side = single.unionByName(first.select("class", "grp"))
    by = counts.join(F.broadcast(side), "class", "left").groupBy("zone_id", F.coalesce("grp", F.lit("other")).alias("grp")).agg(F.sum("n").alias("n"))
    total = counts.groupBy("zone_id").agg(F.sum("n").alias("numpix"))
    return by.join(total, "zone_id").select("zone_id", "grp", "n", F.round(F.try_divide(100.0 * F.col("n"), F.col("numpix")), 1).alias("share"), "numpix")


def district_errors(shares: DataFrame, districts: DataFrame, group: str) -> DataFrame:
    """Difference of a group's share to the census estimate, per district: diff, its size and the per cent found."""
    found = shares.where(F.col("grp") == group).select("zone_id", "share")
    out = districts.join(found, "zone_id", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return out.withColumns({"diff": F.col("share") - F.col("estimate"), "absdiff": F.abs(F.col("share") - F.col("estimate")), "found": F.round(100 * F.try_divide(F.col("share"), F.col("estimate")), 2)})


def error_summary(errors: DataFrame, size: str = "avg_farm", small: float = 5, large: float = 20) -> DataFrame:
    """Mean absolute error and mean difference over all districts, those of small and those of large farms, in one pass."""
    few, many = F.col(size) < small, F.col(size) > large
    out = []
    for name, cond in (("all", F.lit(True)), ("small", few), ("large", many)):
        out += [F.round(F.avg(F.when(cond, F.col("absdiff"))), 2).alias(f"mae_{name}"), F.round(F.avg(F.when(cond, F.col("diff"))), 2).alias(f"bias_{name}")]
    return errors.agg(*out)


def mean_by_class(frame: DataFrame, features: list[str], low: int, high: int) -> DataFrame:
    return frame.where(F.col("LC_UNQ").between(low, high)).groupBy("Class").agg(*[F.avg(f).alias(f) for f in features])


def external_recall(samples: DataFrame) -> DataFrame:
    """Share of each stratum that an outside map marks: samples(ho_type, map_val)."""
    return samples.groupBy("ho_type").agg(F.try_divide(F.sum("map_val"), F.count("*")).alias("recall"), F.count("*").alias("n"))


def histogram(pixels: DataFrame, bins: int, low: float, high: float) -> DataFrame:
    """(spec_index, bin, n, n_valid): bins from 1; values beyond the bounds fall into 0 and bins + 1."""
    valid = (F.col("value") > 0) & (F.col("value") < 10000)
    return pixels.where("value is not null").groupBy("spec_index", F.width_bucket(F.col("value").cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"), F.count_if(valid).alias("n_valid"))


def mosaic(pixels: DataFrame, priority: DataFrame, nodata: int = 0) -> DataFrame:
    """One value per place (x, y): that of the first cell in priority(cell_id, rank) with data there."""
    ranked = pixels.where(F.col("value") != nodata).join(priority, "cell_id")
    return ranked.groupBy("x", "y").agg(F.min_by("value", F.struct("rank", "value")).alias("value"))


def stretched(pixels: DataFrame, g: float = 1.5) -> DataFrame:
    """Values of each band after gamma, between 0 and 1 over the band's range; what is broadcast is a row for each spectral index."""
    v = gamma(F.col("value"), g)
    bands = pixels.groupBy("spec_index").agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    return pixels.join(F.broadcast(bands), "spec_index").withColumn("stretched", stretch(v, F.col("lo"), F.col("hi"))).drop("lo", "hi")
