"""Readers of points, lookup tables, series, logs and registries, and writers of results."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreframe.functions.classes import holdout_type
from acreframe.functions.names import date_of_yyyyddd
from acreframe.operators.seasons import crop_year
from acreframe.operators.stack import FeatureModel

POINTS = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("OID_", T.LongType()), ("PID", T.StringType()), ("XCoord", T.DoubleType()), ("YCoord", T.DoubleType()), ("Class", T.StringType()), ("LC_UNQ", T.IntegerType()),
            ("rand", T.DoubleType()), ("rand2", T.DoubleType()), ("SampMethod", T.StringType()), ("PurePixel", T.StringType()), ("Width", T.DoubleType()), ("FieldWidth", T.DoubleType()),
            ("entry_lev", T.IntegerType()), ("LC", T.IntegerType()), ("year", T.IntegerType()),
        )
    ]
)


def as_cells(x: int | str | Iterable[int], spark: SparkSession) -> DataFrame:
    """cell_id rows from a number, a list, text such as "[3,4]", or the path of a file with a cell per line."""
    if isinstance(x, str) and x.strip().startswith("["):
        x = [int(v) for v in x.strip()[1:-1].split(",") if v.strip()]
    if isinstance(x, str):
        return spark.read.schema("cell_id int").csv(x) if not x.strip().isdigit() else as_cells(int(x), spark)
    return spark.createDataFrame([(int(v),) for v in ([x] if isinstance(x, int) else x)], "cell_id int")


def index_series(pixels: DataFrame, cells: DataFrame | None, index: str, year: int, start_month: int) -> DataFrame:
    """Rows of an index and of the cells (numbers from 0) in a crop year; both prune partitions of a table that write_pixels has laid out.

    The cells' numbers are broadcast: a project's grid has some thousands at most.
    """
    out = pixels.where((F.col("spec_index") == index) & crop_year(F.col("img_date"), year, start_month))
    return out if cells is None else out.join(F.broadcast(cells.where("cell_id >= 0")), "cell_id", "left_semi")  # Spark prunes by a side with a filter


def write_pixels(pixels: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """The pixels as table `name` at path: partitions by index and cell, in each `buckets` files by row and column.

    Scans of an index or of some cells read their partitions only, and whatever groups by pixel or has windows over one reads it without an exchange.
    """
    laid = pixels.repartition(buckets, "row", "col").sortWithinPartitions("spec_index", "cell_id", "row", "col", "img_date")
    laid.write.partitionBy("spec_index", "cell_id").bucketBy(buckets, "row", "col").option("path", path).mode("overwrite").saveAsTable(name)
    return pixels.sparkSession.table(name)


def raw_images(raw: DataFrame, sensors: tuple[str, ...]) -> DataFrame:
    """Rows of sensors by the first two letters: S2, LT, LE, LC."""
    return raw.where(F.substring("sensor", 1, 2).isin(*sensors))


def listing(files: DataFrame, suffix: str) -> DataFrame:
    return files.where(F.col("file").endswith(suffix) & ~F.col("file").contains("angles"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, file, size) of files below a folder; their contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line_no, line) of text logs; line_no rises within a file, in steps of one or more.

    A large log is read in blocks: a line's number is where its block starts plus its place among the rows of the task, which is
    smaller than a block has bytes.
    """
    lines = spark.read.text(folder).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("n"), F.col("value").alias("line"))
    return lines.select("file", (F.col("at") + F.col("n")).alias("line_no"), "line")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINTS).option("enforceSchema", "false").csv(path, header=True)


def read_lut(spark: SparkSession, path: str) -> DataFrame:
    """Keyed rows of a class lookup table; the rows behind them have no key."""
    return spark.read.csv(path, header=True, inferSchema=True, quote='"', escape='"').where(F.col("LC_UNQ").isNotNull())


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """A saved wide series, by date; NaN is missing."""
    wide = spark.read.csv(path, header=True, nullValue="NaN")
    names = [c for c in wide.columns if c != "date"]
    return wide.select(F.to_date("date").alias("date"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in names]).orderBy("date")


def monthly_files(spark: SparkSession, folder: str, kind: str, area: str, year: int, months: tuple[int, int], band: str) -> DataFrame:
    """Wide series of files named MMYYYY..., with kind, band and area in the name ("All": any area), of the months, as one.

    The day column imDay (yyyyddd) becomes `date`; ALL is the mean of a row's points, stdv their deviation with that mean among them.
    The driver lists names and unites files, of which there are a few for each month.
    """
    listed = [r.path for r in list_files(spark, folder, "*.csv").where(F.col("file").rlike(r"^\d{6}")).select("path", "file").collect() if months[0] <= int(r.file[:2]) <= months[1] and all(x in r.file for x in (str(year), kind, band, "" if area == "All" else area))]
    if not listed:
        raise ValueError("no file matches")
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.csv(p, header=True, nullValue="NaN") for p in sorted(listed)])
    points = [c for c in wide.columns if c != "imDay"]
    values = F.filter(F.array(*[F.col(f"`{c}`").try_cast("double") for c in points]), lambda v: v.isNotNull())
    mean = lambda v: F.try_divide(F.aggregate(v, F.lit(0.0), lambda s, x: s + x), F.size(v))
    out = wide.select(date_of_yyyyddd("imDay").alias("date"), *[F.col(f"`{c}`").try_cast("double").alias(c) for c in points], values.alias("__v"))
    out = out.withColumn("ALL", mean(F.col("__v")))
    return out.withColumn("stdv", F.sqrt(mean(F.transform("__v", lambda v: (v - F.col("ALL")) * (v - F.col("ALL")))))).drop("__v")


def fixed_holdout(spark: SparkSession, folder: str, features: str, year: str, lut: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """A fixed holdout with ho_type: the file <features>_..._all_<year>*, split by class, or else one file for each type, with features joined where given.

    Files of types are called <features or GENERAL>_HOLDOUT_<type>_<year>.csv; those that aren't there are left out.
    """
    known = {r.file: r.path for r in list_files(spark, folder, "*.csv").select("path", "file").collect()}
    read = lambda f: spark.read.csv(known[f], header=True, inferSchema=True, nullValue="NaN")
    whole = sorted(f for f in known if (p := f.split("_"))[0] == features and len(p) > 2 and p[-2] == "all" and p[-1].startswith(year))
    if whole:
        rows = read(whole[0]).withColumn("ho_type", holdout_type()).where(F.col("ho_type").isNotNull())
    else:
        parts = [(t, f) for t in ("noCrop", "smallCrop", "medCrop", "bigCrop") for f in (f"{features}_HOLDOUT_{t}_{year}.csv", f"GENERAL_HOLDOUT_{t}_{year}.csv") if f in known]
        if not parts:
            raise ValueError("no fixed holdout")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read(f).withColumn("ho_type", F.lit(t)) for t, f in dict(reversed(parts)).items()])
    if "LC2" not in rows.columns:
        rows = rows.join(F.broadcast(lut.where(F.col("LC_UNQ").isNotNull()).select("LC_UNQ", "LC2")), "LC_UNQ", "left")
    return rows if values is None else rows.join(values.drop(*[c for c in values.columns if c in rows.columns and c != "OID_"]), "OID_")


def read_registry(text: str) -> dict[str, FeatureModel]:
    """Feature models from JSON; raises for what isn't JSON, or where a list is a string."""
    fields = FeatureModel.__dataclass_fields__
    return {name: FeatureModel(**{k: v for k, v in parts.items() if k in fields}) for name, parts in json.loads(text).items()}


def write_registry(models: dict[str, FeatureModel]) -> str:
    return json.dumps({name: {**vars(m), "band_names": m.band_names} for name, m in models.items()}, indent=1)


def map_products(spark: SparkSession, text: str) -> DataFrame:
    """(product, loc, classes) from JSON {product: {loc, classes: {group: [codes]}}}."""
    rows = [(p, v.get("loc"), v.get("classes", {})) for p, v in json.loads(text).items()]
    return spark.createDataFrame(rows, "product string, loc string, classes map<string, array<int>>")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("nullValue", "NaN").csv(path, header=True)


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("nullValue", "NaN").csv(path, header=True)


def write_stack(stack: DataFrame, path: str, bands: list[str]) -> None:
    """Bands by name, in order; rows of a cell and block of pixels together."""
    block = [F.col("cell_id"), F.floor(F.col("row") / 256), F.floor(F.col("col") / 256)]
    stack.select("cell_id", "row", "col", *bands).repartition(*block).sortWithinPartitions("cell_id", "row", "col").write.mode("overwrite").parquet(path)
