"""Confusion matrices in long form, and the measures made from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreframe.functions.numbers import ratio
from acreframe.operators.ranks import sums_before

#: Weights of crop classes in alphabetical order, the last for the row of totals.
CROP_TYPE_WEIGHTS = (1, 1, 1, 1, 2, 1, 1, 1, 0)
#: Weights of the recalls of big crops, no crops and small crops, and what a lost no-crop counts.
BIG, NO, SMALL, LOST = 0.22, 0.75, 0.03, 15


def class_counts(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count("*").alias("n"))


def regroup(scores: DataFrame, lut: DataFrame, scheme: str) -> DataFrame:
    """pred and obs through a scheme of the lookup table: (pred, obs) names of that scheme."""
    side = lut.where(F.col("LC_UNQ").isNotNull()).select("LC_UNQ", F.col(f"{scheme}_name").alias("name"))
    a = F.broadcast(side.select(F.col("LC_UNQ").alias("pred"), F.col("name").alias("__p")))
    b = F.broadcast(side.select(F.col("LC_UNQ").alias("obs"), F.col("name").alias("__o")))
    return scores.join(a, "pred", "left").join(b, "obs", "left").drop("pred", "obs").withColumnsRenamed({"__p": "pred", "__o": "obs"})


def confusion(scores: DataFrame) -> DataFrame:
    """(pred, obs, n) with margins `All`; rows that lack either class are dropped."""
    known = scores.where("pred is not null and obs is not null").select(F.col("pred").cast("string").alias("pred"), F.col("obs").cast("string").alias("obs"))
    cube = known.cube("pred", "obs").agg(F.count("*").alias("n"))
    return cube.select(F.coalesce("pred", F.lit("All")).alias("pred"), F.coalesce("obs", F.lit("All")).alias("obs"), "n")


def generic_confusion(samples: DataFrame, map_lut: DataFrame, valid_lut: DataFrame, out: str, nodata: int = 0) -> DataFrame:
    """Confusion of samples(pred, obs) with a lookup table (code, <out>) of its own for each; nodata predictions are dropped."""
    a = F.broadcast(map_lut.select(F.col("code").alias("pred"), F.col(out).alias("__p")))
    b = F.broadcast(valid_lut.select(F.col("code").alias("obs"), F.col(out).alias("__o")))
    joined = samples.where(F.col("pred") != nodata).join(a, "pred", "left").join(b, "obs", "left")
    return confusion(joined.select(F.col("__p").alias("pred"), F.col("__o").alias("obs")))


def accuracies(matrix: DataFrame) -> DataFrame:
    """Per class: UA, PA and the F measures made from them as rounded; the row All has the overall accuracy OA.

    A class that is predicted but never observed has none right and no PA; names follow the weights, not the usual betas.
    """
    right = F.sum(F.when(F.col("pred") == F.col("obs"), F.col("n")).otherwise(0))
    cells = matrix.where("pred != 'All' and obs != 'All'")
    rows = cells.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("row"), right.alias("right"))
    cols = cells.groupBy(F.col("obs").alias("class")).agg(F.sum("n").alias("column"))
    both = rows.join(cols, "class", "full").withColumn("right", F.coalesce("right", F.lit(0)))
    u, p = F.round(ratio("right", "row"), 3), F.round(ratio("right", "column"), 3)
    out = both.select("class", u.alias("UA"), p.alias("PA"))
    u, p = F.col("UA"), F.col("PA")
    out = out.select("*", F.round(ratio(2 * u * p, u + p), 3).alias("F1"), F.round(ratio(1.5 * u * p, 0.5 * u + p), 3).alias("F_5"), F.round(ratio(1.25 * u * p, 0.25 * u + p), 3).alias("F_25"), F.lit(None).cast("double").alias("OA"))
    none = F.lit(None).cast("double")
    total = cells.agg(F.round(ratio(right, F.sum("n")), 3).alias("OA")).select(F.lit("All").alias("class"), *[none.alias(x) for x in ("UA", "PA", "F1", "F_5", "F_25")], "OA")
    return out.union(total)


def accuracy_table(scores: DataFrame, lut: DataFrame, schemes: tuple[str, ...] = ("LC2", "LC3", "LC25")) -> DataFrame:
    """Accuracies of the same scores in several schemes of the lookup table: (scheme, class, UA, PA, F1, F_5, F_25, OA)."""
    out: DataFrame | None = None
    for scheme in schemes:
        part = accuracies(confusion(regroup(scores, lut, scheme))).select(F.lit(scheme).alias("scheme"), "*")
        out = part if out is None else out.union(part)
    if out is None:
        raise ValueError("no schemes")
    return out


def kappa(scores: DataFrame, positive: object) -> DataFrame:
    """Kappa of two classes, in one pass."""
    p, o = F.col("pred") == F.lit(positive), F.col("obs") == F.lit(positive)
    g = scores.where("pred is not null and obs is not null").agg(F.count_if(p & o).alias("tp"), F.count_if(p & ~o).alias("fp"), F.count_if(~p & o).alias("fn"), F.count_if(~p & ~o).alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    return g.select("*", F.round(ratio(2 * (tp * tn - fn * fp), (tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)), 3).alias("kappa"))


def smallholder_confusion(scores: DataFrame, flag: str) -> DataFrame:
    """Of rows flagged as smallholders or predicted as class 35."""
    return confusion(scores.where((F.col(flag) == 1) | (F.col("pred") == 35)))


def weighted_mean(table: DataFrame, metric: str, weights: tuple[float, ...] | None = None) -> Column | DataFrame:
    """Mean of metric x weight over the classes where it is above zero; weights go by the order of class names."""
    ranked = table.withColumn("__k", F.row_number().over(Window.orderBy("class")))  # one row per class
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("__k")) if weights else F.lit(1.0)
    product = F.col(metric) * w
    return ranked.agg(F.avg(F.when(product > 0, product)).alias(metric))


def combined_score(crop: float, types: float) -> float:
    return (2 * crop + types) / 3


def combined_scores(crop: DataFrame, types: DataFrame, points: DataFrame, model: str) -> DataFrame:
    """One row for a model: UA, PA and F1 of crop against the rest, twice, and of the crop types, weighted; the smallholders' own
    measures; and counts of points and of smallholders among them.

    crop(UA, PA, F1, and 1ha_ and halfha_ ones) has one row, types(class, UA, PA, F1) one for each class, points the smallholder flags.
    """
    weighted = [weighted_mean(types, m, CROP_TYPE_WEIGHTS).withColumnRenamed(m, f"__{m}") for m in ("UA", "PA", "F1")]
    known = points.agg(F.count("LC25_name").alias("Num_obs"), F.sum("smlhld_1ha").alias("Num_sm_1ha"), F.sum("smlhd_halfha").alias("Num_sm_halfha"))
    joined = reduce(lambda a, b: a.crossJoin(b), [crop, *weighted, known])  # one row each
    both = [combined_score(F.col(m), F.col(f"__{m}")).alias(m) for m in ("UA", "PA", "F1")]
    small = [F.col(f"`{size}_{m}`") for size in ("1ha", "halfha") for m in ("UA", "PA", "F1")]
    return joined.select(F.lit(model).alias("Model"), *both, *small, "Num_obs", "Num_sm_1ha", "Num_sm_halfha")


def recall_by_holdout(scores: DataFrame, lut: DataFrame, by: list[str]) -> DataFrame:
    """Share of each holdout type predicted right: crop (LC2 = 30) for the crop types, not crop for noCrop."""
    side = F.broadcast(lut.where(F.col("LC_UNQ").isNotNull()).select(F.col("LC_UNQ").alias("pred"), F.when(F.col("LC2") == 30, 30).otherwise(0).alias("two")))
    right = (F.col("two") == 30) == (F.col("ho_type") != "noCrop")
    return scores.join(side, "pred", "left").groupBy(*by).agg(F.round(F.avg(F.coalesce(right, F.lit(False)).cast("double")), 3).alias("recall"))


def roc_auc(scores: DataFrame, score: str, label: str) -> DataFrame:
    """Areas under the ROC curve by rank sums over distinct scores, ties counting half, and under the precision-recall curve by
    trapezoids between distinct scores, from the highest on.  Scores are counted by value first; no task sees all values.
    """
    known = scores.where(f"{label} is not null and {score} is not null").select(F.col(score).cast("double").alias("s"), F.col(label).alias("y"))
    by = known.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("p"), F.count_if(F.col("y") == 0).alias("n"))
    total = by.agg(F.sum("p").alias("all_p"), F.sum("n").alias("all_n"))
    placed = sums_before(by, None, "s", ["p", "n"]).join(F.broadcast(total))  # one row is joined
    # positives and negatives from a score on, and from the next higher one on
    tp, fp = F.col("all_p") - F.col("p_before"), F.col("all_n") - F.col("n_before")
    tp0, fp0 = tp - F.col("p"), fp - F.col("n")
    here = ratio(tp, tp + fp)
    above = F.when(tp0 + fp0 == 0, here).otherwise(ratio(tp0, tp0 + fp0))
    wins = F.sum(F.col("p") * (F.col("n_before") + F.col("n") / 2))
    return placed.agg(ratio(wins, F.max(F.col("all_p") * F.col("all_n"))).alias("auc"), ratio(F.sum(F.col("p") * (here + above) / 2), F.max("all_p")).alias("pr_auc"))


def run_scores(scores: DataFrame, metrics: list[str], by: tuple[str, ...] = ("F", "S", "C", "A")) -> DataFrame:
    """Mean and sample deviation of each metric over runs."""
    return scores.groupBy(*by).agg(*[f(m).alias(f"{m}_{n}") for m in metrics for f, n in ((F.avg, "mean"), (F.stddev_samp, "sd"))])


def array_mean(c: str) -> Column:
    """Mean of an array of runs, to three places."""
    return F.round(F.try_divide(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), F.size(c)), 3)


def best_models(scores: DataFrame, by: list[str], metric: str = "F1", name: str = "model") -> DataFrame:
    line = Window.partitionBy(*by).orderBy(F.desc(metric), name)
    return scores.withColumn("__k", F.row_number().over(line)).where("__k = 1").drop("__k")


def accuracy_gains(scores: DataFrame) -> DataFrame:
    """avgacc, its weighted form, and what the noCrop class loses against the first n, times 15, per model."""
    first = F.first("acc_noCrop").over(Window.partitionBy("model").orderBy("n"))
    big, no, small = F.col("acc_bigCrop"), F.col("acc_noCrop"), F.col("acc_smallCrop")
    return scores.withColumns({"avgacc": big + no, "avgacc_w": BIG * big + NO * no + SMALL * small, "lost": LOST * (first - no)})


def log_scores(log: DataFrame, new: DataFrame, key: str = "model") -> DataFrame:
    """Runs of both; of a model that is in new, its new runs only."""
    return log.join(new.select(key).distinct(), key, "left_anti").unionByName(new)
