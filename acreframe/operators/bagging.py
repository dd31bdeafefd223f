"""Forests of bagged trees, whose training rows are scored by the trees that haven't seen them."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreframe.operators.model import feature_columns, model_input

#: How often a row is drawn: the distribution function of Poisson(1), up to where 52 bits tell no more.
DRAWN = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(18)]


class Bagged(NamedTuple):
    """Trees, the features they look at, the labels of their predictions, and the seed of their samples."""

    trees: list[RandomForestClassificationModel]
    features: list[str]
    labels: list[str]
    seed: int


def bag_weight(key: Column, tree: Column, seed: int) -> Column:
    """How often a tree's bootstrap sample has a row: Poisson(1) by a hash of the row's key and the tree, so it depends on nothing else."""
    name = F.md5(F.concat_ws(":", key.cast("string"), tree.cast("string"), F.lit(str(seed))))
    drawn = F.conv(F.substring(name, 1, 13), 16, 10).cast("double") / float(1 << 52)
    return F.size(F.filter(F.array(*map(F.lit, DRAWN)), lambda p: p <= drawn))


def left_out(predictions: Column, key: Column, seed: int) -> Column:
    """Of an array of predictions, one by each tree in order, those of the trees whose sample lacks the row."""
    return F.filter(predictions, lambda p, t: (bag_weight(key, t, seed) == 0) & p.isNotNull())


def most_voted(votes: Column, classes: int) -> Column:
    """The class, a number from 0, that most of the votes name; of equal ones the least, null without votes."""
    counts = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: F.size(F.filter(votes, lambda v: v == c)))
    return F.when(F.size(votes) > 0, F.array_position(counts, F.array_max(counts)).cast("int") - 1)


def fit_bagged(train: DataFrame, class_col: str, key: str = "OID_", trees: int = 500, depth: int = 10, seed: int = 88, at_once: int = 4) -> Bagged:
    """A forest on the var_ columns: each tree is fitted to all rows by its own weights, with a random part of the features at each split.

    `at_once` trees are fitted side by side, so that small jobs fill the cluster; the trees are the same for any number.
    """
    features = feature_columns(train)
    rows = model_input(train, features).where(F.col(class_col).isNotNull()).withColumn("__label", F.col(class_col).cast("string"))
    indexer = StringIndexer(inputCol="__label", outputCol="__index", stringOrderType="alphabetAsc").fit(rows)
    ready = VectorAssembler(inputCols=features, outputCol="__features").transform(indexer.transform(rows)).select(F.col(key).alias("__key"), "__index", "__features").cache()

    def fit(tree: int) -> RandomForestClassificationModel:
        weighted = ready.withColumn("__w", bag_weight(F.col("__key"), F.lit(tree), seed).cast("double")).where("__w > 0")
        one = RandomForestClassifier(labelCol="__index", featuresCol="__features", weightCol="__w", numTrees=1, bootstrap=False, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed + tree)
        return one.fit(weighted)

    try:
        with ThreadPoolExecutor(at_once) as pool:
            fitted = list(pool.map(inheritable_thread_target(train.sparkSession)(fit), range(trees)))
    finally:
        ready.unpersist()
    return Bagged(fitted, features, list(indexer.labels), seed)


def with_votes(rows: DataFrame, forest: Bagged, column: str = "votes") -> DataFrame:
    """rows with the predictions of all trees as an array, in order: a narrow job."""
    out = VectorAssembler(inputCols=forest.features, outputCol="__features").transform(model_input(rows, forest.features))
    names = []
    for i, tree in enumerate(forest.trees):
        names.append(f"__p{i}")
        out = tree.copy().setRawPredictionCol("").setProbabilityCol("").setPredictionCol(names[-1]).transform(out)
    return out.select(*rows.columns, F.array(*names).alias(column))


def _once(rows: DataFrame, value: Column, column: str) -> DataFrame:
    """rows with a value that is computed once a row: a filter on what is made of a plain column has Spark compute the column anew for each use, a class each."""
    return rows.select("*", F.explode(F.array(value)).alias(column))


def classify_bagged(rows: DataFrame, forest: Bagged) -> DataFrame:
    """rows with `pred`, the label that most trees name."""
    labels = F.array(*map(F.lit, forest.labels))
    voted = _once(with_votes(rows, forest, "__all"), F.col("__all"), "__votes")
    return voted.withColumn("pred", F.get(labels, most_voted(F.col("__votes"), len(forest.labels)))).drop("__all", "__votes")


def out_of_bag(train: DataFrame, forest: Bagged, key: str = "OID_") -> DataFrame:
    """The training rows with `pred` by the trees whose samples lack them, and how many these are (`voters`); no shuffle."""
    labels = F.array(*map(F.lit, forest.labels))
    voted = _once(with_votes(train, forest, "__all"), left_out(F.col("__all"), F.col(key), forest.seed), "__votes")
    return voted.withColumns({"pred": F.get(labels, most_voted(F.col("__votes"), len(forest.labels))), "voters": F.size("__votes")}).drop("__all", "__votes")


def out_of_bag_score(train: DataFrame, forest: Bagged, class_col: str, key: str = "OID_") -> float | None:
    """The share of rows that their out-of-bag trees get right; rows that every sample has don't count."""
    scored = out_of_bag(train.where(F.col(class_col).isNotNull()), forest, key).where("pred is not null")
    return scored.agg(F.avg((F.col("pred") == F.col(class_col).cast("string")).cast("double"))).first()[0]
