"""Which images were seen, ingested, corrected and used, by cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.functions.names import bandpass, late_l7, scene_fields, scene_of_product
from acreframe.functions.numbers import shift_length
from acreframe.operators.ranks import medians

#: Sensors as scene ids name them.
SENSORS = ("lt05", "le07", "lc08", "lc09", "s2")


def not_true(c: str) -> Column:
    """Null counts as not true."""
    return ~F.coalesce(F.col(c), F.lit(False))


def unique_scenes(files: DataFrame) -> DataFrame:
    """One file per base, one that was used rather than one of low quality: files(base, quality, file)."""
    return files.groupBy("base").agg(F.min(F.struct(F.when(F.col("quality") == "image_used", 0).otherwise(1).alias("__q"), "file", "quality")).alias("s")).select("base", "s.file", "s.quality")


def first_cells(scenes: DataFrame) -> DataFrame:
    """Each scene id once, with its first cell."""
    others = [c for c in scenes.columns if c not in ("scene_id", "cell_id")]
    first = scenes.groupBy("scene_id").agg(F.min(F.struct("cell_id", *others)).alias("__s"))
    return first.select("scene_id", "__s.*").select(scenes.columns)


def closest_image(requests: DataFrame, images: DataFrame) -> DataFrame:
    """For each request(req_id, cell_id, year, day): the image of that cell and year nearest to the day; ties by earlier day, larger file, name.

    A cell's year has at most 366 days with images, of each the best one; these are packed into one row, so requests meet a row each and never all
    images.
    """
    days = images.groupBy("cell_id", F.year("img_date").alias("year"), F.dayofyear("img_date").alias("img_day")).agg(F.min(F.struct((-F.col("size")).alias("__s"), "file")).alias("b"))
    packed = days.groupBy("cell_id", "year").agg(F.collect_list(F.struct("img_day", "b.file")).alias("days"))
    near = F.array_min(F.transform("days", lambda d: F.struct(F.abs(d["img_day"] - F.col("day")).alias("off"), d["img_day"].alias("img_day"), d["file"].alias("file"))))
    found = requests.join(packed, ["cell_id", "year"]).select("req_id", near.alias("n"))
    return found.groupBy("req_id").agg(F.min("n").alias("n")).select("req_id", "n.off", "n.img_day", "n.file")


def missing_files(scenes: DataFrame, files: DataFrame) -> DataFrame:
    return scenes.join(files.select("cell_id", "file"), ["cell_id", "file"], "left_anti")


def existing_files(scenes: DataFrame, files: DataFrame) -> DataFrame:
    return scenes.join(files.select("cell_id", "file"), ["cell_id", "file"], "left_semi")


def cells_with_file(files: DataFrame, sub_dir: str, name: str, without: bool = False) -> DataFrame:
    """Cells that have the sub-directory and in it the file (or <cell>_<file>), or those that lack it; in order."""
    there = files.where(F.col("sub_dir") == sub_dir)
    hit = (F.col("file") == name) | (F.col("file") == F.concat(F.lpad(F.col("cell_id").cast("string"), 6, "0"), F.lit("_" + name)))
    cells = there.groupBy("cell_id").agg(F.bool_or(hit).alias("has"))
    return cells.where(~F.col("has") if without else F.col("has")).select("cell_id").orderBy("cell_id")


def set_differences(a: DataFrame, b: DataFrame, key: str = "scene_id") -> DataFrame:
    """(key, only_in): ids that only one of two catalogues has."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.exceptAll(right).withColumn("only_in", F.lit("a")).union(right.exceptAll(left).withColumn("only_in", F.lit("b")))


def match_products(scenes: DataFrame, products: DataFrame) -> DataFrame:
    """scenes with the corrected product of the same sensor, tile (path and row) and date, as its name has them; the last by name."""
    part = F.split("product", "_")
    p = products.groupBy(F.lower(F.substring("product", 1, 4)).alias("sensor"), F.get(part, F.lit(1)).alias("tile"), "date").agg(F.max("product").alias("product"))
    return scenes.join(p, ["sensor", "tile", "date"], "left").select(*scenes.columns, "product")


def rebuild(downloads: DataFrame, products: DataFrame) -> DataFrame:
    """A lost scene table from listings: scenes of products, then downloads (scene_id) that no product stands for."""
    made = products.select("cell_id", scene_of_product("product").alias("scene_id"), F.col("product").alias("brdf_id"), bandpass("product").alias("bandpass"), F.lit(True).alias("brdf"))
    made = made.groupBy("cell_id", "scene_id").agg(F.max("brdf_id").alias("brdf_id"), F.max_by("bandpass", "brdf_id").alias("bandpass"), F.max("brdf").alias("brdf"))
    more = downloads.select("cell_id", "scene_id").distinct().join(made, ["cell_id", "scene_id"], "left_anti")
    return made.unionByName(more, allowMissingColumns=True)


def scenes_between(scenes: DataFrame, first: int, last: int, sensor: str | None = None) -> DataFrame:
    """Scenes (id, sensor, date yyyymmdd) from the first year on and before the last, of one sensor or of those that begin with a letter."""
    out = scenes.where((F.col("date").cast("int") >= first * 10000 + 101) & (F.col("date").cast("int") < last * 10000 + 101))
    if sensor is None:
        return out
    return out.where(F.col("sensor").startswith(sensor) if len(sensor) == 1 else F.col("sensor") == sensor)


def catalogue(table: DataFrame, start: str, end: str, cloud: float, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Rows of a catalogue export observed within the dates, with less cloud, and whose box overlaps."""
    out = table.where((F.col("obs") >= F.lit(start).cast("timestamp")) & (F.col("obs") < F.lit(end).cast("timestamp")) & (F.col("cloudcov") < cloud))
    if box:
        out = out.where((F.col("xmin") < box[2]) & (F.col("xmax") > box[0]) & (F.col("ymin") < box[3]) & (F.col("ymax") > box[1]))
    return out


def read_scenes(scenes: DataFrame) -> DataFrame:
    """scenes with sensor, date and yr taken from scene_id."""
    return scenes.withColumns(scene_fields("scene_id"))


def why_missing(missing: DataFrame, allowed: int) -> DataFrame:
    """Per cell and sensor: missing images without late Landsat 7, and whether few enough are left to call it complete."""
    left = F.count_if(~F.coalesce(late_l7("sensor", "img_date"), F.lit(False)))
    return missing.groupBy("cell_id", "sensor").agg(F.count("*").alias("n_missing"), left.alias("n_unexplained"), (left <= allowed).alias("complete"))


def counts_by(frame: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of rows by one column, with a column per listed value of another."""
    return frame.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def by_month(frame: DataFrame, date: str = "img_date") -> DataFrame:
    """(month, n) over every month from the first to the last, zero where there's none."""
    month = F.trunc(F.col(date), "month")
    counts = frame.groupBy(month.alias("month")).agg(F.count("*").alias("n"))
    axis = counts.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a is not null").select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    return axis.join(counts, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))


def cell_status(scenes: DataFrame, years: list[int]) -> DataFrame:
    """One row per cell: what was seen, skipped, failed, ingested and used by year and sensor, and the shifts of coregistered images.

    scenes(cell_id, scene_id, sensor, yr, skip, error, brdf_error, brdf, coreg, shift_x, shift_y, used, and redownload where there is one).
    Excluded are those seen but not ingested, low_quality those ingested but not used; an image to be downloaded again isn't
    ingested.  One aggregate; a null flag counts as false.
    """
    again = F.coalesce(F.col("redownload"), F.lit(False)) if "redownload" in scenes.columns else F.lit(False)
    ok = not_true("skip") & F.col("error").isNull() & ~again
    used = F.coalesce(F.col("used"), F.lit(False))
    shift = F.when(F.coalesce(F.col("coreg"), F.lit(False)), shift_length("shift_x", "shift_y"))
    out = [F.count("*").alias("seen"), F.count_if(F.coalesce(F.col("skip"), F.lit(False))).alias("skipped"), F.count_if(F.col("error").isNotNull()).alias("dl_errors"), F.count_if(F.col("brdf_error").isNotNull()).alias("brdf_errors"), F.count_if(again).alias("to_redownload")]
    for y in years:
        out += [F.count_if(ok & (F.col("yr") == y)).alias(f"images_ingested_{y}"), F.count_if(used & (F.col("yr") == y)).alias(f"images_used_{y}")]
    for s in SENSORS:
        is_s = F.col("sensor").startswith(s)
        out.append(F.count_if(is_s & F.coalesce(F.col("brdf"), F.lit(False))).alias(f"num_processed_{s}"))
    out += [F.count_if(F.coalesce(F.col("brdf"), F.lit(False))).alias("num_brdf"), F.count_if(F.coalesce(F.col("coreg"), F.lit(False))).alias("num_coreged")]
    for s in ("s2", "lt05", "le07"):
        v = F.when(F.col("sensor").startswith(s), shift)
        out += [f(v).alias(f"{n}_shift_{s}") for f, n in ((F.avg, "avg"), (F.max, "max"), (F.median, "med"))]
    out += [F.count_if(ok).alias("ingested"), F.count_if(used).alias("used")]
    g = scenes.groupBy("cell_id").agg(*out)
    return g.withColumns({"excluded": F.col("seen") - F.col("ingested"), "low_quality": F.col("ingested") - F.col("used"), "per_coreg": F.round(F.try_divide(F.col("num_coreged"), F.col("num_brdf")), 3)})


def index_coverage(files: DataFrame) -> DataFrame:
    """firstyear-lastyear of each index per cell: files(cell_id, spec_index, yr)."""
    g = files.groupBy("cell_id", "spec_index").agg(F.min("yr").alias("first"), F.max("yr").alias("last"))
    return g.withColumn("years", F.concat_ws("-", "first", "last"))


def complete_cells(coverage: DataFrame, first: int, last: int, indices: int) -> DataFrame:
    """Per cell: indices that cover the years, whether all do, and whether one was begun but doesn't."""
    covers = (F.col("first") <= first) & (F.col("last") >= last)
    return coverage.groupBy("cell_id").agg(F.count_if(covers).alias("n_complete"), (F.count_if(covers) >= indices).alias("complete"), F.bool_or(~covers).alias("started"))


def shift_statistics(scenes: DataFrame) -> DataFrame:
    """Shifts of coregistered images by sensor.  The median comes from counts by value, so no task holds a sensor's shifts."""
    shift = F.when(F.coalesce(F.col("coreg"), F.lit(False)), shift_length("shift_x", "shift_y"))
    g = scenes.groupBy("sensor").agg(F.count("*").alias("n"), F.count(shift).alias("n_coreg"), F.avg(shift).alias("mean_shift"), F.max(shift).alias("max_shift"))
    return g.join(medians(scenes.select("sensor", shift.alias("med_shift")), "sensor", "med_shift"), "sensor", "left").select("sensor", "n", "n_coreg", "mean_shift", "med_shift", "max_shift")


def mean_cloud_cover(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean cloud cover of a catalogue, to two places, over all or by columns."""
    return table.groupBy(*(by or [])).agg(F.round(F.avg("cloudcov"), 2).alias("cloudcov"), F.count("*").alias("n"))


def images_to_merge(images: DataFrame, start: str, end: str, other: DataFrame | None = None) -> DataFrame:
    """Images dated after start and before end, put to those of another set whose dates they don't have."""
    chosen = images.where((F.col("img_date") > F.lit(start).cast("date")) & (F.col("img_date") < F.lit(end).cast("date")))
    return chosen if other is None else other.unionByName(chosen.join(other.select("cell_id", "img_date").distinct(), ["cell_id", "img_date"], "left_anti"), allowMissingColumns=True)


def scenes_per_year(scenes: DataFrame) -> DataFrame:
    """Mean number of unique scenes a year: all, Landsat and Sentinel."""
    per = scenes.dropDuplicates(["scene_id"]).groupBy("yr").agg(F.count("*").alias("n"), F.count_if(F.col("sensor").startswith("l")).alias("landsat"), F.count_if(F.col("sensor").startswith("s")).alias("sentinel"))
    return per.agg(*[F.avg(c).alias(f"avg_{c}") for c in ("n", "landsat", "sentinel")])


def scene_estimate(status: DataFrame, columns: list[str], cells_per_scene: int = 80) -> DataFrame:
    """Whole scenes that the sums over cells stand for."""
    return status.agg(*[F.expr(f"sum({c}) div {cells_per_scene}").alias(c) for c in columns])


def grid_totals(scenes: DataFrame) -> DataFrame:
    return scenes.agg(F.count("*").alias("n"), F.sum("numpix").alias("numpix"), F.array_sort(F.collect_set("skip_reason")).alias("skip_reasons"))


def undersized(files: DataFrame, least: int = 906_770_000) -> DataFrame:
    return files.where(F.col("size") < least)


def upsert(old: DataFrame, new: DataFrame, key: str = "cell_id") -> DataFrame:
    """Rows of both by key: values of new where there are any, else those of old; columns of either."""
    a, b = old.select([F.col(c).alias("__a_" + c) if c != key else F.col(c) for c in old.columns]), new.select([F.col(c).alias("__b_" + c) if c != key else F.col(c) for c in new.columns])
    names = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c != key]
    values = [F.coalesce(*[F.col(p + c) for p, cols in (("__b_", new.columns), ("__a_", old.columns)) if c in cols]).alias(c) for c in names]
    return a.join(b, key, "full").select(key, *values)
