"""Samples: balancing, holdouts and filters, all by uniform columns stored with the points, so that they can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.functions.classes import MIXED
from acreframe.operators.ranks import beside, sums_before


def prevalence(lut: DataFrame, compat: bool = False) -> DataFrame:
    """(LC25_name, share): of several shares of one class the largest; compat keeps one class of each share instead."""
    known = lut.where("perLC25E is not null and LC25_name is not null")
    if compat:
        return known.groupBy("perLC25E").agg(F.min("LC25_name").alias("LC25_name")).select("LC25_name", F.col("perLC25E").alias("share"))
    return known.groupBy("LC25_name").agg(F.max("perLC25E").alias("share"))


def balance_ratios(points: DataFrame, lut: DataFrame, cutoff: int, mix_factor: float, compat: bool = False) -> DataFrame:
    """(LC25_name, n, ratio): the share of each class's samples to keep.

    Samples go by prevalence, measured against the most prevalent class, but never below cutoff; mixed classes are kept mix_factor
    times as often.  Classes are few whatever the points, so the ratios are small.
    """
    shares = prevalence(lut, compat)
    shares = shares.join(points.groupBy("LC25_name").agg(F.count("*").alias("n")), "LC25_name", "left")
    top = shares.agg(F.max("share").alias("top"), F.max_by("n", F.struct("share", "LC25_name")).alias("most"))
    part = F.col("share") / F.col("top") * F.col("most")
    ratio = F.when(F.col("n") < cutoff, 1.0).when(part < F.col("n"), F.greatest(F.lit(float(cutoff)) / F.col("n"), part / F.col("n"))).otherwise(1.0)
    mixed = F.when(F.col("LC25_name").isin(*MIXED), float(mix_factor)).otherwise(1.0)
    return shares.join(F.broadcast(top)).where("n is not null").select("LC25_name", "n", (ratio * mixed).alias("ratio"))  # one row is joined


def balance(points: DataFrame, lut: DataFrame, cutoff: int, mix_factor: float, compat: bool = False) -> DataFrame:
    """Points whose `rand` is below the ratio of their class; classes without a ratio stay (compat: go)."""
    ratios = balance_ratios(points, lut, cutoff, mix_factor, compat).select("LC25_name", "ratio")
    keep = F.col("rand") < F.col("ratio")
    return points.join(ratios, "LC25_name", "left").where(keep if compat else F.coalesce(keep, F.lit(True))).drop("ratio")


def stable_sets(points: DataFrame, percent: float) -> DataFrame:
    """points with `set`: smallCrop, bigCrop or noCrop for rows whose rand2 lies in the last `percent`, else train."""
    late = F.col("rand2") > (100 - percent) / 100
    mix = F.coalesce(F.col("LC25_name") == "Crops-mix", F.lit(False))
    narrow = F.coalesce(F.col("FieldWidth") <= 100, F.lit(False))
    big = ~mix & (F.col("LC3_name") == "crop") & ~narrow
    return points.withColumn("set", F.when(late & mix, "smallCrop").when(late & big, "bigCrop").when(late & (F.col("LC2_name") == "nocrop"), "noCrop").otherwise("train"))


def test_flags(points: DataFrame) -> DataFrame:
    return points.withColumn("TESTSET10", (F.col("rand2") > 0.91).cast("int")).withColumn("TESTSET20", (F.col("rand2") > 0.82).cast("int"))


def train_test(points: DataFrame, percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """By the stored flag; with 0 all rows are for training."""
    if not percent:
        return points, points.where(F.lit(False))
    return points.where(f"TESTSET{percent} = 0"), points.where(f"TESTSET{percent} = 1")


def split_by_field(points: DataFrame, fields: DataFrame, key: str = "field_id") -> DataFrame:
    """points with `set`: HOLDOUT for those in a listed field, else TRAINING (also without a field)."""
    listed = fields.where(F.col(key).isNotNull()).select(key).distinct().withColumn("__in", F.lit(True))
    return points.join(listed, key, "left").withColumn("set", F.when(F.col("__in"), "HOLDOUT").otherwise("TRAINING")).drop("__in")


def training_rest(points: DataFrame, holdout: DataFrame, key: str = "OID_") -> DataFrame:
    return points.join(holdout.select(key), key, "left_anti")


def clear_classes(points: DataFrame, class_col: str) -> DataFrame:
    return points.where(F.col(class_col) < 98)


def confident(points: DataFrame, no_crop: bool = False) -> DataFrame:
    """Rows entered with confidence (entry_lev > 1, where there is one); for noCrop neither class 19 nor smallholders."""
    out = points.where("entry_lev > 1") if "entry_lev" in points.columns else points
    if no_crop:
        out = out.where("LC != 19") if "LC" in points.columns else out
        out = out.where("smlhld_1ha = 0") if "smlhld_1ha" in points.columns else out
        out = out.where("label != 19") if "label" in points.columns else out
    return out


def thin_methods(points: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Of each listed sampling method only rows with rand above its threshold; other rows stay."""
    keep = F.lit(True)
    for method, t in thresholds.items():
        keep = keep & ((F.col("rand") > t) | ~F.col("SampMethod").eqNullSafe(method))
    return points.where(keep)


def prebalance(points: DataFrame, cls: str, method: str, target: int) -> DataFrame:
    """Thin one method's rows of a class so that the class comes to about `target`: p = (target - other methods) / method's."""
    of = F.col("Class") == cls
    n = points.agg(F.count_if(of & ~F.col("SampMethod").eqNullSafe(method)).alias("__ground"), F.count_if(of & F.col("SampMethod").eqNullSafe(method)).alias("__all"))
    p = F.try_divide(target - F.col("__ground"), F.col("__all"))
    keep = ~F.coalesce(of & F.col("SampMethod").eqNullSafe(method), F.lit(False)) | F.coalesce(F.col("rand") < p, F.lit(True))
    return points.join(F.broadcast(n)).where(keep).drop("__ground", "__all")  # one row is joined


def increments(points: DataFrame, step: int, steps: int, mixed: str = "Crops-mix") -> DataFrame:
    """(n, row): for each n from 0 to steps, all other rows, the mixed ones with rand up to step n / all of them, and edge classes with rand below n / 100."""
    total = points.agg(F.count_if(F.col("LC25_name") == mixed).alias("__mix"))
    rows = points.join(F.broadcast(total)).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(steps))))  # one row is joined
    is_mix, edge = F.col("LC25_name").eqNullSafe(mixed), F.coalesce(F.col("LC25_name").isin("Mixed-VegEdge", "Mixed-path"), F.lit(False))
    keep = F.when(is_mix, F.col("rand") <= F.try_divide(F.lit(step) * F.col("n"), F.col("__mix"))).when(edge, F.col("rand") < F.col("n") / 100).otherwise(True)
    return rows.where(keep).drop("__mix")


def without_classes(points: DataFrame, classes: list[str]) -> DataFrame:
    return points.where(~F.coalesce(F.col("Class").isin(classes), F.lit(False)))


def inside_polygons(points: DataFrame, inside: bool = True) -> DataFrame:
    return points.where("areaSeg > 0") if inside else points.where("areaSeg is null")


def stratified(points: DataFrame, class_col: str, share: float, key: str, seed: int = 0) -> DataFrame:
    """points with `inner_test`: the same share of each class, by a hash of the key, rounded up; rows with one key go together.

    The hash that ends the share is found from counts by hash, so no task ranks a class.
    """
    placed = points.withColumns({"__g": F.xxhash64(class_col), "__h": F.xxhash64(key, F.lit(seed))})
    counts = placed.groupBy("__g", "__h").agg(F.count("*").alias("__n"))
    need = counts.groupBy("__g").agg(F.ceil(F.sum("__n") * share).alias("__need"))
    found = beside(sums_before(counts, "__g", "__h", ["__n"]), need, "__g", "__h")
    end = found.where("__n_before < __need and __need <= __n_before + __n").select("__g", F.col("__h").alias("__end"))
    return beside(placed, end, "__g", "__h", "left").withColumn("inner_test", F.coalesce(F.col("__h") <= F.col("__end"), F.lit(False)).cast("int")).drop("__g", "__h", "__end")


def sweep_sample(points: DataFrame, lut: DataFrame, cutoff: int, cls: str, method: str, target: int, mix_factor: float = 10, drop: tuple[str, ...] = ()) -> DataFrame:
    """Points balanced for a sweep: classes of the lookup table, one method's rows of a class thinned to the target, then all classes by prevalence."""
    joined = with_lut(points.drop("LC_UNQ", "LC2", "LC3", "LC4", "LC5"), lut, columns=("LC_UNQ", "LC25", "LC25_name", "LC2", "LC2_name"))
    return balance(prebalance(joined, cls, method, target), lut, cutoff, mix_factor).drop(*drop)


def with_lut(points: DataFrame, lut: DataFrame, on: str = "Class", columns: tuple[str, ...] = ("LC25", "LC25_name", "LC2", "LC2_name")) -> DataFrame:
    """Columns of the lookup table (some sixty rows), by class name or by LC_UNQ; names already there give way."""
    key = "USE_NAME" if on == "Class" else "LC_UNQ"
    side = lut.where(F.col("LC_UNQ").isNotNull()).select(F.col(key).alias(on), *columns).dropDuplicates([on])
    return points.drop(*columns).join(F.broadcast(side), on, "left")


def years_together(frames: dict[int, DataFrame], column: str = "year") -> DataFrame:
    """Frames of several years as one, with the year as a column."""
    out: DataFrame | None = None
    for year, f in frames.items():
        tagged = f.withColumn(column, F.lit(year))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames")
    return out


def set_column(flag: Column, yes: str, no: str) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), yes).otherwise(no)
