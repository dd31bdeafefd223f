"""Random forests on feature frames with MLlib."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreframe.functions.classes import class_column
from acreframe.functions.names import model_name
from acreframe.functions.numbers import filled_short
from acreframe.operators.accuracy import accuracies, array_mean, confusion, kappa
from acreframe.operators.sample import balance, clear_classes, confident, increments, stratified, train_test, with_lut
from acreframe.operators.stack import POLYGON_ALIASES, POLYGON_CODES, FeatureModel, polygon_feature, select_bands


def feature_columns(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c.startswith("var_")]


def model_input(frame: DataFrame, features: list[str]) -> DataFrame:
    """frame with its features as 16-bit numbers, zero for what is missing."""
    return frame.withColumns({f: filled_short(f"`{f}`") for f in features})


def train_forest(train: DataFrame, class_col: str, key: str = "OID_", trees: int = 500, depth: int = 10, seed: int = 88, inner: float = 0.1) -> tuple[PipelineModel, float]:
    """A forest on the var_ columns, and its accuracy on a stratified inner test set; out-of-bag scores have no equivalent."""
    features = feature_columns(train)
    rows = stratified(model_input(train, features).where(F.col(class_col).isNotNull()).withColumn("__label", F.col(class_col).cast("string")), "__label", inner, key, seed)
    indexer = StringIndexer(inputCol="__label", outputCol="__index", stringOrderType="alphabetAsc", handleInvalid="keep").fit(rows)
    forest = RandomForestClassifier(labelCol="__index", featuresCol="__features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed)
    stages = [VectorAssembler(inputCols=features, outputCol="__features"), forest, IndexToString(inputCol="prediction", outputCol="pred", labels=indexer.labels)]
    fitted = Pipeline(stages=stages).fit(indexer.transform(rows.where("inner_test = 0")))
    tested = indexer.transform(rows.where("inner_test = 1"))
    return fitted, accuracy(fitted.transform(tested))


def accuracy(scored: DataFrame) -> float:
    return MulticlassClassificationEvaluator(labelCol="__index", predictionCol="prediction", metricName="accuracy").evaluate(scored)


def importances(model: PipelineModel, top: int | None = None) -> list[tuple[str, float]]:
    """Features by impurity importance, highest first; the first `top` of them if given."""
    names = model.stages[0].getInputCols()
    return sorted(zip(names, map(float, model.stages[1].featureImportances.toArray()), strict=True), key=lambda x: (-x[1], x[0]))[:top]


def permutation_importances(model: PipelineModel, test: DataFrame, class_col: str, key: str, repeats: int = 10, seed: int = 0, bucket: int = 10_000) -> list[tuple[str, float, float]]:
    """Mean and deviation of the loss of accuracy when one feature's values are moved between rows of the inner test set.

    Values are moved within buckets of about `bucket` rows that a hash deals, by joining the rows of each in two hashed orders; so no
    task holds all rows.  All repeats of a feature are one job; the driver loops over features.
    """
    features = model.stages[0].getInputCols()
    rows = model_input(test, list(features))
    many = max(1, rows.count() // bucket)

    def right(frame: DataFrame, *by: str) -> list:
        hits = F.avg((F.col("pred") == F.col(class_col).cast("string")).cast("double")).alias("right")
        return model.transform(frame).groupBy(*by).agg(hits).collect()

    base, out = right(rows)[0].right, []
    dealt = rows.withColumn("__b", F.pmod(F.xxhash64(key, F.lit(seed - 1)), F.lit(many))).withColumn("__r", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    own = dealt.withColumn("__k", F.row_number().over(Window.partitionBy("__b", "__r").orderBy(key)))
    for f in features:
        line = Window.partitionBy("__b", "__r").orderBy(F.xxhash64(key, F.col("__r") + seed), key)
        moved = dealt.select("__b", "__r", F.col(f).alias("__v"), F.row_number().over(line).alias("__k"))
        losses = [base - r.right for r in right(own.join(moved, ["__b", "__r", "__k"]).drop(f).withColumnRenamed("__v", f), "__r")]
        mean = sum(losses) / repeats
        out.append((f, mean, (sum((x - mean) ** 2 for x in losses) / repeats) ** 0.5))
    return sorted(out, key=lambda x: (-x[1], x[0]))


def score_holdout(holdout: DataFrame, model: PipelineModel, class_col: str, no_crop: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(features, pred, label, OID, keep...) of the rows entered with confidence; flags stay with their rows."""
    features = model.stages[0].getInputCols()
    scored = model.transform(model_input(confident(holdout, no_crop), list(features)))
    return scored.select(*features, "pred", F.col(class_col).cast("string").alias("label"), F.col("OID_").alias("OID"), *keep)


def classify(stack: DataFrame, model: PipelineModel, keep: tuple[str, ...] = ("cell_id", "row", "col")) -> DataFrame:
    """The class of every pixel: a narrow job without a shuffle; missing features count as zero."""
    features = list(model.stages[0].getInputCols())
    return model.transform(model_input(stack, features)).select(*keep, F.col("pred").alias("class"))


def probability_of(scored: DataFrame, index: int) -> DataFrame:
    return scored.withColumn("score", vector_to_array("probability")[index])


def auc(scored: DataFrame, label: str, positive: str = "30") -> dict[str, float]:
    """Areas under the ROC and the precision-recall curves of `score` for the positive label."""
    frame = scored.select(F.col("score").cast("double").alias("rawPrediction"), (F.col(label) == positive).cast("double").alias("label"))
    return {m: BinaryClassificationEvaluator(metricName=m).evaluate(frame) for m in ("areaUnderROC", "areaUnderPR")}


def _exists(spark, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def load_or_train(spark, path: str | None, train: Callable[[], PipelineModel]) -> PipelineModel:
    """The model at path, or a new one, saved there."""
    if path and _exists(spark, path):
        return PipelineModel.load(path)
    model = train()
    if path:
        model.write().overwrite().save(path)
    return model


def model_stack(stacks: dict[str, DataFrame], model: FeatureModel, name: str) -> tuple[DataFrame, list[str]]:
    """The stack of a feature model and its bands in order.

    A NoPoly model may use the stack of its Poly6 namesake.  A model with polygon features whose stack has none of them is
    taken without them.
    """
    stack = stacks.get(name)
    if stack is None and "NoPoly" in name:
        stack = stacks.get(name.replace("NoPoly", "Poly6"))
    if stack is None:
        raise ValueError(f"no stack for {name}")
    filled = stack.withColumns({v: polygon_feature(stack, v) for v in model.poly_vars if v not in stack.columns and f"poly_{v}" not in stack.columns})
    has = lambda v: f"poly_{v}" in stack.columns or v in stack.columns or POLYGON_ALIASES.get(v) in stack.columns or ("poly" in stack.columns and v in POLYGON_CODES)
    if model.poly_vars and not any(map(has, model.poly_vars)):
        return stack, replace(model, poly_vars=[]).band_names
    return filled, model.band_names


def classification_job(stack: DataFrame, train: Callable[[], tuple[PipelineModel, float]], path: str, out: str, bands: list[str] | None = None) -> DataFrame:
    """Load the model at path, or train and save it; classify the stack (of the bands in order, as var_ columns) and write the map."""
    spark = stack.sparkSession
    model = load_or_train(spark, path, lambda: train()[0])
    if bands is not None:
        stack = select_bands(stack, bands).withColumnsRenamed({b: f"var_{b}" for b in bands})
    classify(stack, model).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def train_and_score(points: DataFrame, holdout: DataFrame, class_col: str, **options) -> tuple[PipelineModel, DataFrame, dict[str, float]]:
    """A forest on the training rows, its scores on the holdout by type, and its inner accuracy.

    points and holdout hold var_ columns, OID_ and the class; holdout also ho_type.  Returns the model, the scored rows
    (pred, label, OID, ho_type) and {"inner": accuracy, "holdout": accuracy}.
    """
    model, inner = train_forest(points, class_col, **options)
    scored = score_holdout(holdout, model, class_col, keep=("ho_type",)).select("pred", "label", "OID", "ho_type")
    right = scored.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    return model, scored, {"inner": inner, "holdout": right or 0.0}


def crop_scores(scored: DataFrame, lut: DataFrame, scheme: str) -> dict[str, float | None]:
    """Recall of each holdout type, and kappa, F measures and overall accuracy of crop against the rest, of scored(pred, label, ho_type).

    pred is a class of the scheme's column, label a code of LC2.
    """
    column = class_column(scheme, lut)
    two = lut.where(F.col("LC_UNQ").isNotNull()).groupBy(F.col(column).cast("string").alias("pred")).agg(F.max(F.when(F.col("LC2") == 30, 30).otherwise(98)).alias("__two"))
    both = scored.join(F.broadcast(two), "pred", "left").select("ho_type", F.when(F.col("__two") == 30, "crop").otherwise("nocrop").alias("pred"), F.when(F.col("label") == "30", "crop").otherwise("nocrop").alias("obs"))
    right = (F.col("pred") == "crop") == (F.col("ho_type") != "noCrop")
    out: dict[str, float | None] = {f"recall_{r.ho_type}": r.recall for r in both.groupBy("ho_type").agg(F.round(F.avg(right.cast("double")), 3).alias("recall")).collect()}
    table = {r["class"]: r for r in accuracies(confusion(both)).collect()}  # two classes and the total
    crop = table.get("crop")
    out |= {f"{m}_cnc": crop[m] if crop else None for m in ("F1", "F_5", "F_25")}
    return out | {"OA_cnc": table["All"].OA, "Kappa_cnc": kappa(both, "crop").first().kappa}


def model_run(points: DataFrame, lut: DataFrame, features: str, sample: str, scheme: str, years: list[int], percent: int = 0, fixed: DataFrame | None = None, path: str | None = None, seed: int = 88, **options) -> tuple[PipelineModel, dict[str, object]]:
    """One model end to end: classes from the lookup table, its name, training rows, a model that is trained or loaded, and its scores.

    percent: of the stable holdout by the stored flags, 0 for none.  fixed: a fixed holdout(ho_type, LC2, var_..., and year), which
    adds recalls by type (with several years also by year) and the measures of crop against the rest.  Unclear classes go, but in
    LC2, where their code is that of no crop.
    """
    spark, column = points.sparkSession, class_column(scheme, lut)
    rows = points if column in points.columns else with_lut(points, lut, columns=(column,))
    train, test = train_test(rows if column == "LC2" else clear_classes(rows, column), percent)
    name = model_name(features, sample, column, years)
    model = load_or_train(spark, path, lambda: train_forest(train, column, seed=seed, **options)[0])
    scores: dict[str, object] = {"model": name, "F": features, "S": sample, "C": column, "A": "RF"}
    if percent:
        scored = score_holdout(test, model, column)
        scores["holdout"] = scored.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    if fixed is not None:
        keep = ("ho_type", *(["year"] if "year" in fixed.columns else []))
        scored = model.transform(model_input(fixed, list(model.stages[0].getInputCols()))).select("pred", F.col("LC2").cast("string").alias("label"), *keep)
        scores |= crop_scores(scored, lut, scheme)
        if len(years) > 1 and "year" in keep:
            for y in sorted(years):
                scores |= {f"{k}_{y}": v for k, v in crop_scores(scored.where(F.col("year") == y), lut, scheme).items() if k.startswith("recall")}
    return model, scores


def side_by_side(spark, jobs: dict[str, Callable[[], list[dict]]], at_once: int = 4, log: str | None = None) -> list[dict]:
    """The rows of all jobs, in order; `at_once` jobs run side by side, so that small fits fill the cluster.

    log: a folder where each job's rows are written when it ends; jobs whose rows are there aren't run again, so a sweep that broke goes on where it ended.
    """

    def one(name: str) -> list[dict]:
        path = f"{log}/{name}"
        if log and _exists(spark, f"{path}/_SUCCESS"):
            return json.loads(spark.read.text(path).first()[0])
        rows = jobs[name]()
        if log:
            spark.createDataFrame([(json.dumps(rows),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return rows

    with ThreadPoolExecutor(at_once) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(one), name) for name in jobs]
        try:
            return [row for f in found for row in f.result()]
        except BaseException:
            pool.shutdown(cancel_futures=True)
            raise


def sweep(samples: dict[str, DataFrame], score: Callable[[DataFrame, int], dict[str, float]], runs: int, spark, at_once: int = 4, log: str | None = None) -> DataFrame:
    """One row of scores per sample and run; run i has the seed 1 + 23 i.  Runs are jobs of side_by_side."""
    job = lambda name, i: lambda: [{"model": name, "run": i, **score(samples[name], 1 + 23 * i)}]
    return spark.createDataFrame(side_by_side(spark, {f"{name}-{i}": job(name, i) for name in samples for i in range(runs)}, at_once, log))


def _averaged(runs: DataFrame, by: list[str]) -> DataFrame:
    """Each measure's runs as an array, and their mean to three places."""
    measures = [c for c in runs.columns if c.startswith(("recall_", "OA_", "Kappa_", "F1_", "F_5_", "F_25_")) and not c[-4:].isdigit()]
    g = runs.groupBy(*by).agg(*[F.transform(F.array_sort(F.collect_list(F.struct("run", F.round(c, 3).alias("v")))), lambda r: r["v"]).alias(c) for c in measures])  # a row for each run
    return g.select("*", *[array_mean(c).alias(f"avg{c}") for c in measures])


def learning_curve(training: DataFrame, holdout: DataFrame, lut: DataFrame, features: str, sample: str, scheme: str, years: list[int], runs: int = 3, stop: int = 1000, step: int = 10, at_once: int = 4, log: str | None = None, **options) -> DataFrame:
    """Models on samples with more and more mixed crops, each in several runs: (n, n_small, a column of runs and of their mean for each measure).

    Sample n has about n steps of mixed crops, and edge classes with rand below n / 100; run i has the seed 1 + 23 i.  Samples are jobs of side_by_side.
    """
    spark, grown = training.sparkSession, increments(training, step, stop // step - 1)

    def one(n: int) -> list[dict]:
        part, rows = grown.where(F.col("n") == n).drop("n").cache(), []
        small = part.where(F.col("LC25_name") == "Crops-mix").count()
        for i in range(runs):
            _, scores = model_run(part, lut, features, sample, scheme, years, fixed=holdout, seed=1 + 23 * i, **options)
            rows.append({"n": n, "n_small": small, "run": i} | {k: v for k, v in scores.items() if isinstance(v, float)})
        part.unpersist()
        return rows

    rows = side_by_side(spark, {f"{sample}-{n}": lambda n=n: one(n) for n in range(stop // step)}, at_once, log)
    schema = ", ".join(["n long", "n_small long", "run long", *(f"`{c}` double" for c in sorted({k for r in rows for k in r} - {"n", "n_small", "run"}))])
    return _averaged(spark.createDataFrame(rows, schema), ["n", "n_small"]).orderBy("n")


def sample_grid(points: DataFrame, holdout: DataFrame, lut: DataFrame, features: str, scheme: str, years: list[int], cutoffs: list[int], mixes: list[int], runs: int = 3, at_once: int = 4, log: str | None = None, **options) -> DataFrame:
    """Models on samples bal<cutoff>mix<factor> of every pair, each in several runs: scores(model, S, run, measures), to be logged.  Samples are jobs of side_by_side."""
    spark = points.sparkSession

    def one(name: str, cutoff: int, mix: int) -> list[dict]:
        part, rows = balance(points, lut, cutoff, mix).cache(), []
        for i in range(runs):
            _, scores = model_run(part, lut, features, name, scheme, years, fixed=holdout, seed=1 + 23 * i, **options)
            rows.append({"run": i} | {k: v for k, v in scores.items() if k in ("model", "S") or isinstance(v, float)})
        part.unpersist()
        return rows

    rows = side_by_side(spark, {name: lambda a=(name, c, m): one(*a) for c in cutoffs for m in mixes for name in [f"bal{c}mix{m}"]}, at_once, log)
    schema = ", ".join(["model string", "S string", "run long", *(f"`{c}` double" for c in sorted({k for r in rows for k in r} - {"model", "S", "run"}))])
    return spark.createDataFrame(rows, schema)
