"""Feature stacks: blocks of features side by side, and the names of their bands."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIXEL = ("cell_id", "row", "col")
#: What polygon features may also be called, and the class codes of their composite band.
POLYGON_ALIASES = {"NovDecGCVI_FieldStd": "AvgNovDec_FieldStd"}
POLYGON_CODES = {"dst": 1, "cropbnds": 2, "ext": 3}


@dataclass
class FeatureModel:
    """What a model's stack is made of; missing parts are empty."""

    spec_indices: list[str] = field(default_factory=list)
    si_vars: list[str] = field(default_factory=list)
    combo_bands: list[str] = field(default_factory=list)
    spec_indices_pheno: list[str] = field(default_factory=list)
    pheno_vars: list[str] = field(default_factory=list)
    singleton_vars: list[str] = field(default_factory=list)
    poly_vars: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        for name, value in vars(self).items():
            if isinstance(value, str):
                raise ValueError(f"{name} is a string, not a list")

    @property
    def band_names(self) -> list[str]:
        """Index by variable, then combinations, phenology, sing_ and poly_ bands."""
        bands = [f"{i}_{v}" for i in self.spec_indices for v in self.si_vars] + list(self.combo_bands)
        bands += [f"{i}_{v}" for i in self.spec_indices_pheno for v in self.pheno_vars]
        return bands + [f"sing_{v}" for v in self.singleton_vars] + [f"poly_{v}" for v in self.poly_vars]


def index_stack(features: DataFrame, indices: list[str]) -> DataFrame:
    """One row per pixel, columns <index>_<variable>, from features in long form by spec_index: one aggregate with given pivot values."""
    names = [c for c in features.columns if c not in (*PIXEL, "spec_index")]
    return features.groupBy(*PIXEL).agg(*[F.max(F.when(F.col("spec_index") == i, F.col(v))).alias(f"{i}_{v}") for i in indices for v in names])


def attach(*blocks: DataFrame) -> DataFrame:
    """Blocks of features side by side by pixel; pixels that a block lacks get nulls."""
    return reduce(lambda a, b: a.join(b, list(PIXEL), "full"), blocks)


def select_bands(stack: DataFrame, bands: list[str], keep: tuple[str, ...] = PIXEL) -> DataFrame:
    """The bands in a model's order; sing_x and poly_x may be called x.  A missing band raises."""

    def resolve(band: str) -> Column:
        for name in (band, band.removeprefix("sing_").removeprefix("poly_")):
            if name in stack.columns:
                return F.col(f"`{name}`").alias(band)
        raise ValueError(f"the stack has no band {band}")

    return stack.select(*keep, *[resolve(b) for b in bands])


def polygon_feature(stack: DataFrame, name: str) -> Column:
    """A polygon feature by its name, else by its alias, else from the composite band `poly`; null where none is there."""
    given = [F.col(n) for n in (name, POLYGON_ALIASES.get(name)) if n in stack.columns]
    if "poly" in stack.columns and name in POLYGON_CODES:
        given.append((F.col("poly") == POLYGON_CODES[name]).cast("int"))
    return F.coalesce(*given) if given else F.lit(None)


def drop_features(frame: DataFrame, indices: tuple[str, ...] = (), variables: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> DataFrame:
    """Without the var_<index>_<variable> columns of the indices and variables, and without the names."""

    def goes(c: str) -> bool:
        if not c.startswith("var_"):
            return c in names
        index, _, variable = c[4:].partition("_")
        return index in indices or variable in variables or c in names or c[4:] in names

    return frame.drop(*[c for c in frame.columns if goes(c)])


def reduced_model(frame: DataFrame, models: dict[str, FeatureModel], name: str, new: str, indices: tuple[str, ...] = (), variables: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, FeatureModel]]:
    """A frame without some features, and the models with what is left of `name` as a new one, its bands in the frame's order."""
    kept = drop_features(frame, indices, variables, names)
    bands = [c.removeprefix("var_") for c in kept.columns if c.startswith("var_")]
    plain = [b for b in bands if not b.startswith(("sing_", "poly_"))]
    of = lambda kind: [b.removeprefix(kind) for b in bands if b.startswith(kind)]
    if name not in models:
        raise ValueError(f"no feature model {name}")
    return kept, models | {new: FeatureModel(combo_bands=plain, singleton_vars=of("sing_"), poly_vars=of("poly_"))}


def without_polygons(frame: DataFrame) -> DataFrame:
    return frame.drop(*[c for c in frame.columns if c.startswith("var_poly")])


def without_features(frame: DataFrame) -> DataFrame:
    """No var columns; of clashing columns of a merge the left one, under its own name."""
    kept = [c for c in frame.columns if not c.startswith("var") and not c.endswith("_y")]
    return frame.select([F.col(f"`{c}`").alias(c.removesuffix("_x")) for c in kept])


def append_features(points: DataFrame, *features: DataFrame, on: str = "OID_") -> DataFrame:
    """Points with the columns of feature tables; a column that is there already keeps its values."""
    for f in features:
        points = points.join(f.drop(*[c for c in f.columns if c in points.columns and c != on]), on, "left")
    return points


def features_of_points(points: DataFrame, features: DataFrame, on: str = "OID_") -> DataFrame:
    """Points that have features, with them; a column of both keeps the point's values."""
    return points.join(features.drop(*[c for c in features.columns if c in points.columns and c != on]), on)


def constant(frame: DataFrame, name: str, value: object) -> DataFrame:
    """frame with a column that is the same everywhere."""
    return frame.withColumn(name, F.lit(value))


def missing_values(frame: DataFrame, only_features: bool = False) -> DataFrame:
    """(column, n) of the columns with missing values, in one pass."""
    names = [c for c in frame.columns if not only_features or c.startswith("var_")]
    if not names:
        return frame.sparkSession.createDataFrame([], "column string, n long")
    counts = frame.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return counts.unpivot([], [f"`{c}`" for c in names], "column", "n").where("n > 0")
