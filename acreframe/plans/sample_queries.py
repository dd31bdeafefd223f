"""Queries of samples, accuracy and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreframe.functions import classes as cl
from acreframe.functions.names import sample_parts
from acreframe.operators import accuracy as ac
from acreframe.operators import bagging as ba
from acreframe.operators import model as mo
from acreframe.operators import sample as sa
from acreframe.plans.views import cte, table, view


def _points(spark, sf):
    return sa.with_lut(view(spark, sf, "points"), view(spark, sf, "lut"), columns=("LC25", "LC25_name", "LC2", "LC2_name", "LC3_name"))


_P = "p AS (SELECT points.*, LC25, LC25_name, LC2, LC2_name, LC3_name FROM points LEFT JOIN lut ON Class = USE_NAME)"


def with_lut(spark, sf):
    return _points(spark, sf).select("OID_", "Class", "LC25", "LC25_name", "LC2", "LC2_name", "LC3_name")


LUT_SQL = f"{cte('points', 'lut')}, {_P} SELECT OID_, Class, LC25, LC25_name, LC2, LC2_name, LC3_name FROM p"

_RATIOS = """n AS (SELECT LC25_name, count(*) AS n FROM p GROUP BY 1), sh AS (SELECT LC25_name, max(perLC25E) AS share FROM lut GROUP BY 1),
 j AS (SELECT sh.LC25_name, share, n FROM sh LEFT JOIN n USING (LC25_name)), top AS (SELECT max(share) AS top, arg_max(n, share) AS most FROM j),
 k AS (SELECT LC25_name, n, CASE WHEN n < 60 THEN 1.0e0 WHEN share / top * most < n THEN greatest(60.0e0 / n, share / top * most / n) ELSE 1.0e0 END AS ratio FROM j, top WHERE n IS NOT NULL)"""


def balance(spark, sf):
    return sa.balance(_points(spark, sf), view(spark, sf, "lut"), 60, 8).select("OID_", "LC25_name", "rand")


BALANCE_SQL = f"{cte('points', 'lut')}, {_P}, {_RATIOS} SELECT OID_, p.LC25_name, rand FROM p LEFT JOIN k ON p.LC25_name = k.LC25_name WHERE coalesce(rand < ratio, true)"


def balance_ratios(spark, sf):
    return sa.balance_ratios(_points(spark, sf), view(spark, sf, "lut"), 60, 8).withColumn("ratio", F.round("ratio", 6))


RATIOS_SQL = f"{cte('points', 'lut')}, {_P}, {_RATIOS} SELECT LC25_name, n, round(ratio, 6) AS ratio FROM k"


def stable_sets(spark, sf):
    points = _points(spark, sf).withColumn("LC25_name", F.when(F.col("OID_") % 7 == 0, "Crops-mix").otherwise(F.col("LC25_name")))
    return sa.test_flags(sa.stable_sets(points, 20)).select("OID_", "set", "TESTSET10", "TESTSET20")


SETS_SQL = f"""{cte('points', 'lut')}, {_P}, q AS (SELECT *, CASE WHEN OID_ % 7 = 0 THEN 'Crops-mix' ELSE LC25_name END AS nm FROM p)
SELECT OID_, CASE WHEN rand2 > 0.8e0 AND nm = 'Crops-mix' THEN 'smallCrop' WHEN rand2 > 0.8e0 AND nm != 'Crops-mix' AND LC3_name = 'crop' AND NOT coalesce(FieldWidth <= 100, false) THEN 'bigCrop' WHEN rand2 > 0.8e0 AND LC2_name = 'nocrop' THEN 'noCrop' ELSE 'train' END AS "set",
 CAST(rand2 > 0.91e0 AS INT) AS TESTSET10, CAST(rand2 > 0.82e0 AS INT) AS TESTSET20 FROM q"""


def train_test(spark, sf):
    train, test = sa.train_test(sa.clear_classes(sa.test_flags(_points(spark, sf)), "LC2"), 20)
    return sa.years_together({0: train, 1: test}, "part").groupBy("part", "LC25_name").agg(F.count("*").alias("n"))


TRAIN_SQL = f"{cte('points', 'lut')}, {_P} SELECT CAST(rand2 > 0.82e0 AS INT) AS part, LC25_name, count(*) AS n FROM p WHERE LC2 < 98 GROUP BY 1, 2"


def fields_split(spark, sf):
    points = view(spark, sf, "points")
    return sa.split_by_field(points, points.where("OID_ % 97 = 0")).select("OID_", "set")


FIELDS_SQL = f"""{cte('points')}, h AS (SELECT DISTINCT field_id FROM points WHERE OID_ % 97 = 0) SELECT OID_, CASE WHEN h.field_id IS NULL THEN 'TRAINING' ELSE 'HOLDOUT' END AS "set" FROM points LEFT JOIN h USING (field_id)"""


def training_rest(spark, sf):
    points = view(spark, sf, "points")
    return sa.training_rest(points, points.where("rand2 > 0.8")).select("OID_")


REST_SQL = f"{cte('points')} SELECT OID_ FROM points WHERE NOT rand2 > 0.8e0"


def thinned(spark, sf):
    return sa.thin_methods(sa.confident(view(spark, sf, "points")), {"poly": 0.8, "ground": 0.5}).select("OID_", "SampMethod", "rand")


THIN_SQL = f"{cte('points')} SELECT OID_, SampMethod, rand FROM points WHERE entry_lev > 1 AND (rand > 0.8e0 OR SampMethod IS DISTINCT FROM 'poly') AND (rand > 0.5e0 OR SampMethod IS DISTINCT FROM 'ground')"


def prebalance(spark, sf):
    return sa.prebalance(view(spark, sf, "points"), "NATION_7", "poly", 40).select("OID_", "Class", "SampMethod")


PREBALANCE_SQL = f"""{cte('points')}, n AS (SELECT count(*) FILTER (WHERE Class = 'NATION_7' AND SampMethod IS DISTINCT FROM 'poly') AS g, count(*) FILTER (WHERE Class = 'NATION_7' AND SampMethod = 'poly') AS a FROM points)
SELECT OID_, Class, SampMethod FROM points, n WHERE NOT coalesce(Class = 'NATION_7' AND SampMethod = 'poly', false) OR coalesce(rand < CAST(40 - g AS DOUBLE) / nullif(a, 0), true)"""


def increments(spark, sf):
    points = _points(spark, sf).withColumn("LC25_name", F.when(F.col("OID_") % 7 == 0, "Crops-mix").when(F.col("OID_") % 7 == 1, "Mixed-path").otherwise(F.col("LC25_name")))
    return sa.increments(points, 10, 12).groupBy("n", "LC25_name").agg(F.count("*").alias("rows"))


INCREMENTS_SQL = f"""{cte('points', 'lut')}, {_P}, q AS (SELECT rand, CASE WHEN OID_ % 7 = 0 THEN 'Crops-mix' WHEN OID_ % 7 = 1 THEN 'Mixed-path' ELSE LC25_name END AS LC25_name FROM p), t AS (SELECT count(*) AS m FROM q WHERE LC25_name = 'Crops-mix'), s AS (SELECT CAST(unnest(range(0, 13)) AS INT) AS n)
SELECT n, LC25_name, count(*) AS "rows" FROM q, t, s WHERE CASE WHEN LC25_name = 'Crops-mix' THEN rand <= CAST(10 * n AS DOUBLE) / m WHEN LC25_name = 'Mixed-path' THEN rand < CAST(n AS DOUBLE) / 100 ELSE true END GROUP BY 1, 2"""


def smallholders(spark, sf):
    points = _points(spark, sf).withColumn("var_poly_area", (F.col("OID_") % 400).cast("int"))
    out = points.withColumn("smlhld_1ha", cl.smallholder(points.columns, 100, ("ASIA",))).withColumn("smlhd_halfha", cl.smallholder(points.columns, 50, ("ASIA",))).withColumn("ho_type", cl.holdout_type())
    return sa.without_classes(out, ["NATION_7"]).select("OID_", "smlhld_1ha", "smlhd_halfha", "ho_type")


def _small_sql(t: int) -> str:
    return f"CAST(coalesce(OID_ % 400 < {t} AND LC2 = 30 AND LC25 < 40, false) OR coalesce(Width <= {t} AND LC2 = 30, false) OR coalesce(LC25_name = 'ASIA', false) AS INT)"


SMALL_SQL = f"""{cte('points', 'lut')}, {_P} SELECT OID_, {_small_sql(100)} AS smlhld_1ha, {_small_sql(50)} AS smlhd_halfha,
 CASE WHEN LC_UNQ IN (23, 24, 25, 26, 32, 34, 35, 36, 39) THEN 'smallCrop' WHEN LC_UNQ IN (22, 31, 33, 37, 38) AND LC2 = 30 THEN 'bigCrop' WHEN LC2 = 98 AND LC_UNQ != 19 THEN 'noCrop' END AS ho_type FROM p WHERE Class != 'NATION_7'"""


def _regrouped(spark, sf):
    return ac.regroup(view(spark, sf, "scores"), view(spark, sf, "lut"), "LC25")


_CM = "g AS (SELECT a.LC25_name AS pred, b.LC25_name AS obs, small FROM scores LEFT JOIN lut a ON pred = a.LC_UNQ LEFT JOIN lut b ON obs = b.LC_UNQ), kn AS (SELECT * FROM g WHERE pred IS NOT NULL AND obs IS NOT NULL)"


def confusion(spark, sf):
    return ac.confusion(_regrouped(spark, sf))


CONFUSION_SQL = f"{cte('scores', 'lut')}, {_CM} SELECT coalesce(pred, 'All') AS pred, coalesce(obs, 'All') AS obs, count(*) AS n FROM kn GROUP BY CUBE (pred, obs)"


def accuracies(spark, sf):
    return ac.accuracies(ac.confusion(_regrouped(spark, sf)))


_ACC = """rw AS (SELECT pred AS class, count(*) AS rw, count(*) FILTER (WHERE pred = obs) AS rt FROM kn GROUP BY 1), cw AS (SELECT obs AS class, count(*) AS cw FROM kn GROUP BY 1),
 up AS (SELECT class, round(coalesce(rt, 0) / CAST(rw AS DOUBLE), 3) AS u, round(coalesce(rt, 0) / CAST(cw AS DOUBLE), 3) AS p FROM rw FULL JOIN cw USING (class))"""
ACCURACY_SQL = f"""{cte('scores', 'lut')}, {_CM}, {_ACC}
SELECT class, u AS "UA", p AS "PA", round(2 * u * p / nullif(u + p, 0), 3) AS "F1", round(1.5e0 * u * p / nullif(0.5e0 * u + p, 0), 3) AS "F_5", round(1.25e0 * u * p / nullif(0.25e0 * u + p, 0), 3) AS "F_25", CAST(NULL AS DOUBLE) AS "OA" FROM up
UNION ALL SELECT 'All', NULL, NULL, NULL, NULL, NULL, round(count(*) FILTER (WHERE pred = obs) / CAST(count(*) AS DOUBLE), 3) FROM kn"""


def accuracy_table(spark, sf):
    return ac.accuracy_table(view(spark, sf, "scores"), view(spark, sf, "lut"), ("LC2", "LC3"))


def _table_part(scheme: str) -> str:
    kn = f"(SELECT a.{scheme}_name AS pred, b.{scheme}_name AS obs FROM scores JOIN lut a ON pred = a.LC_UNQ JOIN lut b ON obs = b.LC_UNQ)"
    classes = f"""SELECT class, round(coalesce(rt, 0) / CAST(rw AS DOUBLE), 3) AS u, round(coalesce(rt, 0) / CAST(cw AS DOUBLE), 3) AS p FROM (SELECT pred AS class, count(*) AS rw, count(*) FILTER (WHERE pred = obs) AS rt FROM {kn} k GROUP BY 1) r FULL JOIN (SELECT obs AS class, count(*) AS cw FROM {kn} k GROUP BY 1) c USING (class)"""
    return f"""SELECT '{scheme}' AS scheme, class, u AS "UA", p AS "PA", round(2 * u * p / nullif(u + p, 0), 3) AS "F1", round(1.5e0 * u * p / nullif(0.5e0 * u + p, 0), 3) AS "F_5", round(1.25e0 * u * p / nullif(0.25e0 * u + p, 0), 3) AS "F_25", CAST(NULL AS DOUBLE) AS "OA" FROM ({classes}) q
 UNION ALL SELECT '{scheme}', 'All', NULL, NULL, NULL, NULL, NULL, round(count(*) FILTER (WHERE pred = obs) / CAST(count(*) AS DOUBLE), 3) FROM {kn} k"""


TABLE_SQL = f"{cte('scores', 'lut')} {_table_part('LC2')} UNION ALL {_table_part('LC3')}"


def weighted(spark, sf):
    return ac.weighted_mean(ac.accuracies(ac.confusion(_regrouped(spark, sf))), "UA", ac.CROP_TYPE_WEIGHTS).withColumn("UA", F.round("UA", 5))


WEIGHTED_SQL = f"""{cte('scores', 'lut')}, {_CM}, {_ACC}, v AS (SELECT class, u FROM up UNION ALL SELECT 'All', NULL), k AS (SELECT u * list_extract([1, 1, 1, 1, 2, 1, 1, 1, 0], row_number() OVER (ORDER BY class)) AS w FROM v)
SELECT round(avg(w) FILTER (WHERE w > 0), 5) AS "UA" FROM k"""


def kappa(spark, sf):
    return ac.kappa(ac.regroup(view(spark, sf, "scores"), view(spark, sf, "lut"), "LC2"), "crop")


KAPPA_SQL = f"""{cte('scores', 'lut')}, g AS (SELECT a.LC2 = 30 AS p, b.LC2 = 30 AS o FROM scores JOIN lut a ON pred = a.LC_UNQ JOIN lut b ON obs = b.LC_UNQ),
 q AS (SELECT count(*) FILTER (WHERE p AND o) AS tp, count(*) FILTER (WHERE p AND NOT o) AS fp, count(*) FILTER (WHERE NOT p AND o) AS fn, count(*) FILTER (WHERE NOT p AND NOT o) AS tn FROM g)
SELECT tp, fp, fn, tn, round(2.0e0 * (CAST(tp AS DOUBLE) * tn - CAST(fn AS DOUBLE) * fp) / (CAST(tp + fp AS DOUBLE) * (fp + tn) + CAST(tp + fn AS DOUBLE) * (fn + tn)), 3) AS kappa FROM q"""


def label_kappa(spark, sf):
    return ac.kappa(table(spark, sf, "labels").select(F.col("quality").alias("pred"), (1 - F.col("toxic")).alias("obs")), 1)


LABEL_KAPPA_SQL = """WITH q AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality = 1 AND toxic != 0) AS fp, count(*) FILTER (WHERE quality != 1 AND toxic = 0) AS fn, count(*) FILTER (WHERE quality != 1 AND toxic != 0) AS tn FROM labels)
SELECT tp, fp, fn, tn, round(2.0e0 * (tp * tn - fn * fp) / ((tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)), 3) AS kappa FROM q"""


def generic_confusion(spark, sf):
    lut = view(spark, sf, "lut")
    fine = lut.select(F.col("LC_UNQ").alias("code"), F.col("LC2_name").alias("grp"))
    coarse = lut.select(F.col("LC_UNQ").alias("code"), F.col("LC3_name").alias("grp"))
    return ac.generic_confusion(view(spark, sf, "scores"), fine, coarse, "grp")


GENERIC_SQL = f"""{cte('scores', 'lut')}, kn AS (SELECT a.LC2_name AS pred, b.LC3_name AS obs FROM scores JOIN lut a ON pred = a.LC_UNQ JOIN lut b ON obs = b.LC_UNQ WHERE pred != 0)
SELECT coalesce(pred, 'All') AS pred, coalesce(obs, 'All') AS obs, count(*) AS n FROM kn GROUP BY CUBE (pred, obs)"""


def smallholder_confusion(spark, sf):
    return ac.smallholder_confusion(view(spark, sf, "scores"), "small")


SMALL_CM_SQL = f"""{cte('scores')}, kn AS (SELECT CAST(pred AS VARCHAR) AS pred, CAST(obs AS VARCHAR) AS obs FROM scores WHERE (small = 1 OR pred = 35) AND obs IS NOT NULL)
SELECT coalesce(pred, 'All') AS pred, coalesce(obs, 'All') AS obs, count(*) AS n FROM kn GROUP BY CUBE (pred, obs)"""


def recall(spark, sf):
    return ac.recall_by_holdout(view(spark, sf, "scores"), view(spark, sf, "lut"), ["ho_type", "yr"])


RECALL_SQL = f"{cte('scores', 'lut')} SELECT ho_type, yr, round(avg(CASE WHEN (LC2 = 30) = (ho_type != 'noCrop') THEN 1.0e0 ELSE 0.0e0 END), 3) AS recall FROM scores LEFT JOIN lut ON pred = LC_UNQ GROUP BY 1, 2"


def roc(spark, sf):
    frame = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return ac.roc_auc(frame, "n_chars", "quality").select(F.round("auc", 6).alias("auc"), F.round("pr_auc", 6).alias("pr_auc"))


ROC_SQL = """WITH j AS (SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)), b AS (SELECT n_chars, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality = 0) AS n FROM j GROUP BY 1),
 w AS (SELECT p, n, p * (coalesce(sum(n) OVER (ORDER BY n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n / 2.0e0) AS w, sum(p) OVER (ORDER BY n_chars DESC) AS tp, sum(n) OVER (ORDER BY n_chars DESC) AS fp FROM b),
 q AS (SELECT *, tp / CAST(tp + fp AS DOUBLE) AS here, CASE WHEN tp - p + fp - n = 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE (tp - p) / CAST(tp - p + fp - n AS DOUBLE) END AS above FROM w)
SELECT round(sum(w) / CAST(sum(p) * sum(n) AS DOUBLE), 6) AS auc, round(sum(p * (here + above) / 2) / sum(p), 6) AS pr_auc FROM q"""


def run_scores(spark, sf):
    runs = view(spark, sf, "scores").groupBy(F.col("ho_type").alias("F"), (F.col("pred") % 5).alias("S"), F.col("yr").alias("run")).agg(F.avg((F.col("pred") == F.col("obs")).cast("double")).alias("F1"), F.sum("small").cast("double").alias("OA"))
    out = ac.run_scores(runs, ["F1", "OA"], ("F", "S"))
    return out.select("F", "S", *[F.round(c, 5).alias(c) for c in out.columns[2:]])


_RUNS = """r AS (SELECT ho_type AS "F", pred % 5 AS "S", yr AS run, avg(CASE WHEN pred = obs THEN 1.0e0 WHEN pred != obs THEN 0.0e0 END) AS f1, CAST(sum(small) AS DOUBLE) AS oa FROM scores GROUP BY 1, 2, 3)"""
RUNS_SQL = f'{cte("scores")}, {_RUNS} SELECT "F", "S", round(avg(f1), 5) AS "F1_mean", round(stddev_samp(f1), 5) AS "F1_sd", round(avg(oa), 5) AS "OA_mean", round(stddev_samp(oa), 5) AS "OA_sd" FROM r GROUP BY 1, 2'


def best_models(spark, sf):
    runs = view(spark, sf, "scores").groupBy(F.col("ho_type").alias("F"), (F.col("pred") % 5).alias("S")).agg(F.count_if(F.col("pred") == F.col("obs")).alias("F1"))
    return ac.best_models(runs.withColumn("model", F.concat_ws("_", "F", "S")), ["F"])


BEST_SQL = f"""{cte('scores')}, r AS (SELECT ho_type AS "F", pred % 5 AS "S", count(*) FILTER (WHERE pred = obs) AS "F1", concat(ho_type, '_', pred % 5) AS model FROM scores GROUP BY 1, 2, 4)
SELECT "F", "S", "F1", model FROM (SELECT *, row_number() OVER (PARTITION BY "F" ORDER BY "F1" DESC, model) AS k FROM r) WHERE k = 1"""


def accuracy_gains(spark, sf):
    s = view(spark, sf, "scores")
    right = F.col("pred") == F.col("obs")
    runs = s.groupBy((F.col("pred") % 3).alias("model"), F.col("yr").alias("n")).agg(*[F.coalesce(F.avg(F.when(F.col("ho_type") == h, right.cast("double"))), F.lit(0.0)).alias(f"acc_{h}") for h in ("smallCrop", "bigCrop", "noCrop")])
    out = ac.accuracy_gains(runs)
    return out.select("model", "n", *[F.round(c, 5).alias(c) for c in ("avgacc", "avgacc_w", "lost")])


def _acc(h: str) -> str:
    return f"coalesce(avg(CASE WHEN pred = obs THEN 1.0e0 WHEN pred != obs THEN 0.0e0 END) FILTER (WHERE ho_type = '{h}'), 0)"


GAINS_SQL = f"""{cte('scores')}, a AS (SELECT pred % 3 AS model, yr AS n, {_acc('smallCrop')} AS s, {_acc('bigCrop')} AS b, {_acc('noCrop')} AS o FROM scores GROUP BY 1, 2)
SELECT model, n, round(b + o, 5) AS avgacc, round(0.22e0 * b + 0.75e0 * o + 0.03e0 * s, 5) AS avgacc_w, round(15 * (first_value(o) OVER (PARTITION BY model ORDER BY n) - o), 5) AS lost FROM a"""


def array_means(spark, sf):
    runs = view(spark, sf, "scores").where("obs is not null").groupBy("yr").agg(F.array_sort(F.collect_list((F.col("pred") - F.col("obs")).cast("double"))).alias("runs"))
    return runs.select("yr", ac.array_mean("runs").alias("mean"), F.size("runs").alias("n"))


MEANS_SQL = f"{cte('scores')} SELECT yr, round(avg(pred - obs), 3) AS mean, CAST(count(*) AS INT) AS n FROM scores WHERE obs IS NOT NULL GROUP BY 1"


def log_scores(spark, sf):
    s = view(spark, sf, "scores").select(F.col("pred").alias("model"), "yr", "small")
    return ac.log_scores(s.where("yr < 1998"), s.where("yr >= 1998 and model < 12")).groupBy("model", "yr").agg(F.count("*").alias("n"))


LOG_SQL = f"{cte('scores')} SELECT pred AS model, yr, count(*) AS n FROM scores WHERE (yr >= 1998 AND pred < 12) OR (yr < 1998 AND pred NOT IN (SELECT pred FROM scores WHERE yr >= 1998 AND pred < 12)) GROUP BY 1, 2"


def class_counts(spark, sf):
    return ac.class_counts(cl.one_against_rest(view(spark, sf, "lut"), "nation_17").join(view(spark, sf, "points").drop("LC_UNQ"), F.col("USE_NAME") == F.col("Class")), "LC1")


COUNTS_SQL = f"{cte('points')} SELECT CASE WHEN Class = 'NATION_17' THEN 'nation_17' ELSE 'no_nation_17' END AS LC1, count(*) AS n FROM points GROUP BY 1"


def sample_names(spark, sf):
    names = view(spark, sf, "points").select("OID_", F.concat(F.lit("bal"), F.col("field_id"), F.when(F.col("OID_") % 3 > 0, F.concat(F.lit("mix"), F.col("entry_lev"))).otherwise("")).alias("name"))
    parts = sample_parts("name")
    return names.select("OID_", parts["base"].alias("base"), parts["mix"].alias("mix"))


NAMES_SQL = f"{cte('points')} SELECT OID_, concat('bal', field_id) AS base, CASE WHEN OID_ % 3 > 0 THEN entry_lev END AS mix FROM points"


def stratified(spark, sf):
    marked = sa.stratified(_points(spark, sf), "LC25_name", 0.1, "OID_", 3)
    return marked.groupBy("LC25_name").agg(F.sum("inner_test").alias("n_test"), F.count("*").alias("n"))


STRATIFIED_SQL = f"{cte('points', 'lut')}, {_P} SELECT LC25_name, CAST(ceil(count(*) * 0.1e0) AS BIGINT) AS n_test, count(*) AS n FROM p GROUP BY 1"


def _embedding_frame(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("OID_"), F.col("label"), *[(F.col("embedding")[i] * 10000).cast("int").alias(f"var_e_{i}") for i in range(64)])


def forest(spark, sf):
    """Train on four fifths of the embeddings, score the rest: a confusion matrix."""
    frame = _embedding_frame(spark, sf)
    model, _ = mo.train_forest(frame.where("OID_ % 5 > 0"), "label", trees=20, depth=5)
    scored = mo.score_holdout(frame.where("OID_ % 5 = 0"), model, "label")
    return ac.confusion(scored.select("pred", F.col("label").alias("obs")))


def bag_weights(spark, sf):
    """How often each of ten bootstrap samples has its rows: rows left out, rows and draws."""
    drawn = table(spark, sf, "embeddings").select(F.col("vec_id"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("tree")).withColumn("w", ba.bag_weight(F.col("vec_id"), F.col("tree"), 88))
    return drawn.groupBy("tree").agg(F.count_if(F.col("w") == 0).alias("n_out"), F.count("*").alias("n"), F.sum("w").alias("draws"), F.max("w").alias("most"))


_DRAW = "CAST('0x' || substr(md5(concat(vec_id, ':', tree, ':88')), 1, 13) AS BIGINT) / 4503599627370496.0e0"
BAG_WEIGHTS_SQL = f"""WITH d AS (SELECT vec_id, unnest(range(0, 10))::INT AS tree FROM embeddings), u AS (SELECT *, {_DRAW} AS u FROM d), w AS (SELECT tree, len(list_filter([{', '.join(f'{p!r}::DOUBLE' for p in ba.DRAWN)}], lambda p: p <= u)) AS w FROM u)
SELECT tree, count(*) FILTER (WHERE w = 0) AS n_out, count(*) AS n, sum(w)::BIGINT AS draws, max(w)::INT AS most FROM w GROUP BY 1"""


def bag_votes(spark, sf):
    """Out-of-bag votes of twenty trees of one split each: whether a vector's component is positive."""
    votes = F.array(*[(F.col("embedding")[i] > 0).cast("double") for i in range(20)])
    out = table(spark, sf, "embeddings").withColumn("votes", ba.left_out(votes, F.col("vec_id"), 88))
    return out.select("vec_id", ba.most_voted(F.col("votes"), 2).alias("pred"), F.size("votes").alias("voters"))


BAG_VOTES_SQL = f"""WITH d AS (SELECT vec_id, embedding, unnest(range(0, 20))::INT AS tree FROM embeddings), u AS (SELECT vec_id, tree, embedding[tree + 1] > 0 AS yes, {_DRAW} < {ba.DRAWN[0]!r}::DOUBLE AS out FROM d),
 v AS (SELECT vec_id, count(*) FILTER (WHERE out AND yes) AS ones, count(*) FILTER (WHERE out) AS voters FROM u GROUP BY 1) SELECT vec_id, CASE WHEN voters = 0 THEN NULL WHEN 2 * ones > voters THEN 1 ELSE 0 END AS pred, voters::INT AS voters FROM v"""


def bagged(spark, sf):
    """A forest of bagged trees on the embeddings, and the confusion matrix of its out-of-bag votes."""
    frame = _embedding_frame(spark, sf)
    forest = ba.fit_bagged(frame, "label", trees=20, depth=5)
    return ac.confusion(ba.out_of_bag(frame, forest).where("pred is not null").select("pred", F.col("label").alias("obs")))


def classified(spark, sf):
    """Classify every pixel's seasonal features by a forest trained on the return flag of the pixels of even rows."""
    from acreframe.operators.features import seasonal_features

    stack = seasonal_features(view(spark, sf, "pixels"), ["maxv_yr", "minv_yr", "avg_yr", "med_yr"], 1998, 7)
    stack = stack.select("cell_id", "row", "col", "spec_index", F.xxhash64("cell_id", "row", "col", "spec_index").alias("OID_"), *[F.col(c).alias("var_" + c) for c in ("maxv_yr", "minv_yr", "avg_yr", "med_yr")])
    model, _ = mo.train_forest(stack.where("row % 2 = 0"), "spec_index", trees=10, depth=4)
    return mo.classify(stack, model, ("cell_id", "row", "col", "spec_index"))


QUERIES = {
    "class_lookup": (with_lut, LUT_SQL), "balanced_sample": (balance, BALANCE_SQL), "balance_ratios": (balance_ratios, RATIOS_SQL), "stable_sets": (stable_sets, SETS_SQL), "train_test": (train_test, TRAIN_SQL), "field_split": (fields_split, FIELDS_SQL), "training_rest": (training_rest, REST_SQL),
    "thinned_sample": (thinned, THIN_SQL), "prebalanced_sample": (prebalance, PREBALANCE_SQL), "sample_increments": (increments, INCREMENTS_SQL), "smallholders": (smallholders, SMALL_SQL), "confusion": (confusion, CONFUSION_SQL), "accuracies": (accuracies, ACCURACY_SQL),
    "accuracy_table": (accuracy_table, TABLE_SQL), "weighted_accuracy": (weighted, WEIGHTED_SQL), "kappa": (kappa, KAPPA_SQL), "label_kappa": (label_kappa, LABEL_KAPPA_SQL), "generic_confusion": (generic_confusion, GENERIC_SQL), "smallholder_confusion": (smallholder_confusion, SMALL_CM_SQL), "holdout_recall": (recall, RECALL_SQL), "roc_auc": (roc, ROC_SQL),
    "run_scores": (run_scores, RUNS_SQL), "best_models": (best_models, BEST_SQL), "accuracy_gains": (accuracy_gains, GAINS_SQL), "array_means": (array_means, MEANS_SQL), "score_log": (log_scores, LOG_SQL), "class_counts": (class_counts, COUNTS_SQL), "sample_names": (sample_names, NAMES_SQL), "stratified_sample": (stratified, STRATIFIED_SQL),
    "forest_scores": (forest, None), "classified_map": (classified, None), "bag_weights": (bag_weights, BAG_WEIGHTS_SQL), "bag_votes": (bag_votes, BAG_VOTES_SQL), "out_of_bag": (bagged, None),
}
