"""Queries of scans, selections and scores that the other modules don't hold."""

from __future__ import annotations

from pyspark.sql import functions as F


from acreframe.operators import accuracy as ac
from acreframe.operators import inventory as iv
from acreframe.operators import logs as lg
from acreframe.operators import sample as sa
from acreframe.operators import series as se
from acreframe.operators import spatial as sp
from acreframe.operators import stack as st
from acreframe.plans.map_queries import _LAND, _LOG, _land, _log_lines
from acreframe.plans.views import cte, table, view
from acreframe.sources import tables as tb


def index_series(spark, sf):
    """Rows of an index in a crop year of the cells on a list."""
    cells = view(spark, sf, "pixels").groupBy("cell_id").agg(F.count("*").alias("n")).where("n > 300").select("cell_id")
    return tb.index_series(view(spark, sf, "pixels"), cells, "N", 1998, 7).select("cell_id", "row", "col", "img_date", "value")


INDEX_SQL = f"""{cte('pixels')} SELECT cell_id, r AS "row", c AS "col", img_date, value FROM pixels WHERE spec_index = 'N' AND cell_id IN (SELECT cell_id FROM pixels GROUP BY 1 HAVING count(*) > 300)
 AND ((year(img_date) = 1998 AND dayofyear(img_date) >= 183) OR (year(img_date) = 1999 AND dayofyear(img_date) < 183))"""


def raw_images(spark, sf):
    return tb.raw_images(view(spark, sf, "raw_pixels"), ("S2", "LC")).groupBy("sensor", "image_id").agg(F.count("*").alias("n"))


RAW_SQL = f"{cte('raw_pixels')} SELECT sensor, image_id, count(*) AS n FROM raw_pixels WHERE sensor LIKE 'S2%' OR sensor LIKE 'LC%' GROUP BY 1, 2"


def read_scenes(spark, sf):
    """Sensor, date and year from the ids of a processing table."""
    tile, day = F.lpad(F.col("cell_id").cast("string"), 6, "0"), F.date_format("img_date", "yyyyMMdd")
    landsat = F.concat_ws("_", F.upper("sensor"), F.lit("L2SP"), tile, day, F.lit("02"), F.lit("T1"))
    sentinel = F.concat_ws("_", F.lit("S2A"), F.concat(F.lit("T"), tile), day, F.lit("0"), F.lit("L2A"))
    s = view(spark, sf, "scenes").select("cell_id", F.when(F.col("sensor") == "s2a", sentinel).otherwise(landsat).alias("scene_id"))
    return iv.read_scenes(s).groupBy("cell_id", "sensor", "yr").agg(F.count("*").alias("n"), F.max("date").alias("last"))


SCENES_SQL = f"{cte('scenes')} SELECT cell_id, CASE WHEN sensor = 's2a' THEN 's2a_' ELSE sensor END AS sensor, CAST(yr AS VARCHAR) AS yr, count(*) AS n, max(strftime(img_date, '%Y%m%d')) AS last FROM scenes GROUP BY 1, 2, 3"


def cloud_cover(spark, sf):
    t = view(spark, sf, "scenes").withColumn("cloudcov", (F.col("numpix") % 101).cast("double"))
    return iv.mean_cloud_cover(t, ["sensor"])


CLOUD_SQL = f"{cte('scenes')} SELECT sensor, round(avg(CAST(numpix % 101 AS DOUBLE)), 2) AS cloudcov, count(*) AS n FROM scenes GROUP BY 1"


def merged_images(spark, sf):
    """Images of one sensor between two dates put to those of another."""
    s = view(spark, sf, "scenes").select("cell_id", "img_date", "sensor").distinct()
    return iv.images_to_merge(s.where("sensor = 'lt05'"), "1996-03-01", "1997-03-01", s.where("sensor = 'lc08'"))


MERGE_IMAGES_SQL = f"""{cte('scenes')}, s AS (SELECT DISTINCT cell_id, img_date, sensor FROM scenes), b AS (SELECT * FROM s WHERE sensor = 'lc08')
SELECT * FROM b UNION ALL SELECT * FROM s WHERE sensor = 'lt05' AND img_date > DATE '1996-03-01' AND img_date < DATE '1997-03-01' AND NOT EXISTS (SELECT 1 FROM b WHERE b.cell_id = s.cell_id AND b.img_date = s.img_date)"""


def pixel_coordinates(spark, sf):
    """Where the pixels of a row and column lie, of each image."""
    p = view(spark, sf, "raw_pixels").select("image_id", "row", "col", (F.col("col") * 10.0 + 5).alias("x"), (F.col("row") * 10.0 + 5).alias("y"), F.col("red").alias("value"))
    return sp.pixel_at(p, 7, 2)


AT_SQL = f"{cte('raw_pixels')} SELECT c * 10.0e0 + 5 AS x, r * 10.0e0 + 5 AS y, red AS value FROM raw_pixels WHERE r = 7 AND c = 2"


def resampled(spark, sf):
    """Rasters of 10 m at 25 m, by weights of what is covered."""
    p = view(spark, sf, "pixels").groupBy("cell_id", "row", "col").agg(F.max("value").alias("value"))
    return sp.resample(p, 10.0, 25.0).select("cell_id", "row", "col", F.round("value", 3).alias("value"))


RESAMPLED_SQL = f"""{cte('pixels')}, p AS (SELECT cell_id, r, c, max(value) AS value FROM pixels GROUP BY 1, 2, 3), h AS (SELECT cell_id, floor((max(r) + 1) * 10.0e0 / 25) AS h, floor((max(c) + 1) * 10.0e0 / 25) AS w FROM p GROUP BY 1),
 o AS (SELECT cell_id, CAST(unnest(range(0, CAST(h AS BIGINT))) AS INT) AS i, w FROM h), q AS (SELECT cell_id, i, CAST(unnest(range(0, CAST(w AS BIGINT))) AS INT) AS j FROM o),
 k AS (SELECT q.cell_id, i, j, value, (least((r + 1) * 0.4e0, i + 1) - greatest(r * 0.4e0, i)) * (least((c + 1) * 0.4e0, j + 1) - greatest(c * 0.4e0, j)) AS a FROM q JOIN p ON p.cell_id = q.cell_id AND (r + 1) * 0.4e0 > i AND r * 0.4e0 < i + 1 AND (c + 1) * 0.4e0 > j AND c * 0.4e0 < j + 1)
SELECT cell_id, i AS "row", j AS "col", round(sum(a * value) / sum(a), 3) AS value FROM k GROUP BY 1, 2, 3"""


def features_of_points(spark, sf):
    """Points joined to the pixel features of their place; those without are left out."""
    values = sp.sample_pixels(view(spark, sf, "points"), _land(spark, sf), 50.0).where("value is not null").select("OID_", "x", F.col("value").alias("var_land"))
    return st.features_of_points(view(spark, sf, "points").select("OID_", "x", "Class"), values)


JOINED_SQL = f"{cte('points')}, {_LAND} SELECT OID_, x, Class, value AS var_land FROM points JOIN land ON r = floor(y / 50) AND c = floor(x / 50)"


def combined_scores(spark, sf):
    """Crop scores and weighted scores of the crop types as one row."""
    s, lut = view(spark, sf, "scores"), view(spark, sf, "lut")
    types = ac.accuracies(ac.confusion(ac.regroup(s, lut, "LC25")))
    rows = ac.accuracies(ac.confusion(ac.regroup(s, lut, "LC3"))).where("class = 'crop'")
    crop = rows.select("UA", "PA", "F1", *[F.col(m).alias(f"{size}_{m}") for size in ("1ha", "halfha") for m in ("UA", "PA", "F1")])
    points = sa.with_lut(view(spark, sf, "points"), lut).withColumns({"smlhld_1ha": (F.col("Width") < 100).cast("int"), "smlhd_halfha": (F.col("Width") < 50).cast("int")})
    out = ac.combined_scores(crop, types, points, "m")
    return out.select("Model", *[F.round(F.col(f"`{m}`"), 5).alias(m) for m in ("UA", "PA", "F1", "1ha_UA", "halfha_F1")], "Num_obs", "Num_sm_1ha", "Num_sm_halfha")


def _acc_sql(name: str, scheme: str) -> str:
    return f"""{name}c AS (SELECT a.{scheme}_name AS pred, b.{scheme}_name AS obs FROM scores LEFT JOIN lut a ON pred = a.LC_UNQ LEFT JOIN lut b ON obs = b.LC_UNQ WHERE a.{scheme}_name IS NOT NULL AND b.{scheme}_name IS NOT NULL),
 {name}u AS (SELECT pred AS class, round(avg(CAST(pred = obs AS DOUBLE)), 3) AS UA FROM {name}c GROUP BY 1), {name}p AS (SELECT obs AS class, round(avg(CAST(pred = obs AS DOUBLE)), 3) AS PA FROM {name}c GROUP BY 1),
 {name} AS (SELECT class, UA, PA, round(2 * UA * PA / nullif(UA + PA, 0), 3) AS F1 FROM {name}u FULL JOIN {name}p USING (class))"""


_WEIGHTED = "(SELECT avg({0} * w) FILTER (WHERE {0} * w > 0) FROM tw)"
COMBINED_SQL = f"""{cte('scores', 'lut', 'points')}, {_acc_sql('t', 'LC25')}, {_acc_sql('k', 'LC3')}, ta AS (SELECT class, UA, PA, F1 FROM t UNION ALL SELECT 'All', NULL, NULL, NULL), tw AS (SELECT *, list_extract([1, 1, 1, 1, 2, 1, 1, 1, 0], CAST(row_number() OVER (ORDER BY class) AS INT)) AS w FROM ta)
SELECT 'm' AS "Model", round((2 * UA + {_WEIGHTED.format('UA')}) / 3, 5) AS "UA", round((2 * PA + {_WEIGHTED.format('PA')}) / 3, 5) AS "PA", round((2 * F1 + {_WEIGHTED.format('F1')}) / 3, 5) AS "F1", UA AS "1ha_UA", F1 AS "halfha_F1",
 (SELECT count(*) FROM points JOIN lut ON Class = USE_NAME) AS "Num_obs", (SELECT CAST(count(*) FILTER (WHERE Width < 100) AS BIGINT) FROM points) AS "Num_sm_1ha", (SELECT CAST(count(*) FILTER (WHERE Width < 50) AS BIGINT) FROM points) AS "Num_sm_halfha" FROM k WHERE class = 'crop'"""


def class_points(spark, sf):
    """Points of one class, inside and outside polygons, and a name for each."""
    p = se.point_sample(view(spark, sf, "points"), "NATION_7").withColumn("areaSeg", F.when(F.col("SampMethod") == "poly", F.col("Width") + 1))
    both = sa.inside_polygons(p).withColumn("where", F.lit("in")).union(sa.inside_polygons(p, False).withColumn("where", F.lit("out")))
    return st.constant(both.select("OID_", "where", sa.set_column(F.col("FieldWidth") > 100, "wide", "narrow").alias("field")), "grid", 0)


CLASS_SQL = f"{cte('points')} SELECT OID_, CASE WHEN SampMethod = 'poly' THEN 'in' ELSE 'out' END AS \"where\", CASE WHEN FieldWidth > 100 THEN 'wide' ELSE 'narrow' END AS field, 0 AS grid FROM points WHERE Class = 'NATION_7'"


def clipped(spark, sf):
    return sp.clip_to_box(view(spark, sf, "points"), 100, -500, 600, 4000).groupBy("Class").agg(F.count("*").alias("n"))


CLIPPED_SQL = f"{cte('points')} SELECT Class, count(*) AS n FROM points WHERE x BETWEEN 100 AND 600 AND y BETWEEN -500 AND 4000 GROUP BY 1"


def observed_between(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM").alias("Acquired"))
    return sp.observed_between(o, 1996, 1999).select("o_orderkey").union(sp.observed_between(o, 0, 1995).select("o_orderkey"))


OBSERVED_SQL = "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 UNION ALL SELECT o_orderkey FROM orders WHERE year(o_orderdate) <= 1995"


def pending_cells(spark, sf):
    return lg.pending(lg.roll_up(_log_lines(spark, sf), "1995-01-01", "2001-12-31")).select("cell_id", F.element_at("dllog_gaps", 1)["start"].alias("first"), F.element_at("dllog_gaps", -1)["end"].alias("last"))


PENDING_SQL = f"""WITH {_LOG}, w AS (SELECT cell_id, d, e, max(e) OVER (PARTITION BY cell_id ORDER BY d, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached, count(*) OVER (PARTITION BY cell_id) AS n FROM o),
 s AS (SELECT cell_id, min(d) AS a, max(e) AS b FROM o GROUP BY 1 HAVING count(*) > 1), g AS (SELECT cell_id, reached AS a, d AS b FROM w WHERE n > 1 AND d > reached AND NOT (month(reached) = 12 AND day(reached) = 31 AND d = reached + 1)
 UNION ALL SELECT cell_id, DATE '1995-01-01', a FROM s WHERE a > DATE '1995-01-01' UNION ALL SELECT cell_id, b, DATE '2001-12-31' FROM s WHERE b < DATE '2001-12-31'),
 q AS (SELECT cell_id, min(a) AS first, max(b) AS last FROM g GROUP BY 1), x AS (SELECT DISTINCT cell_id FROM o WHERE o_orderkey % 9 = 0) SELECT cell_id, first, last FROM q FULL JOIN x USING (cell_id)"""


def monthly_ndvi(spark, sf):
    return se.monthly_ndvi(view(spark, sf, "raw_pixels")).groupBy("month").agg(F.round(F.sum("ndvi"), 3).alias("ndvi"), F.sum("n").alias("n"))


_NDVI = "CAST(trunc(10000 * (CAST(nir AS DOUBLE) - red) / (CAST(nir AS DOUBLE) + red + 1e-9)) AS INT)"
NDVI_SQL = f"""{cte('raw_pixels')}, k AS (SELECT cell_id, r, c, CAST(date_trunc('month', img_date) AS DATE) AS month, CASE WHEN nir < 10000 AND red < 10000 THEN {_NDVI} END AS v FROM raw_pixels),
 g AS (SELECT month, avg(v) AS ndvi, count(v) AS n FROM k GROUP BY cell_id, r, c, month) SELECT month, round(sum(ndvi), 3) AS ndvi, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY 1"""


QUERIES = {
    "index_series": (index_series, INDEX_SQL), "raw_images": (raw_images, RAW_SQL), "read_scenes": (read_scenes, SCENES_SQL), "cloud_cover": (cloud_cover, CLOUD_SQL), "merged_images": (merged_images, MERGE_IMAGES_SQL),
    "pixel_coordinates": (pixel_coordinates, AT_SQL), "resampled": (resampled, RESAMPLED_SQL), "features_of_points": (features_of_points, JOINED_SQL), "combined_scores": (combined_scores, COMBINED_SQL), "class_points": (class_points, CLASS_SQL),
    "clipped": (clipped, CLIPPED_SQL), "observed_between": (observed_between, OBSERVED_SQL), "pending_cells": (pending_cells, PENDING_SQL), "monthly_ndvi": (monthly_ndvi, NDVI_SQL),
}
