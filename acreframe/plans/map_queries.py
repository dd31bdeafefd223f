"""Queries of places, zones, stacks, inventories and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from acreframe.functions import names as nm
from acreframe.functions import numbers as nu
from acreframe.operators import features as fe
from acreframe.operators import inventory as iv
from acreframe.operators import logs as lg
from acreframe.operators import maps as mp
from acreframe.operators import sample as sa
from acreframe.operators import spatial as sp
from acreframe.operators import stack as st
from acreframe.plans.series_queries import KEY_SQL
from acreframe.plans.views import cte, table, view

# --- names and dates ---


def _names(spark, sf):
    o = table(spark, sf, "orders")
    sensor = F.when(F.col("o_orderkey") % 3 == 0, "LC08").when(F.col("o_orderkey") % 3 == 1, "LE07").otherwise("S2A")
    day, tile = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMMdd"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 6, "0")
    sentinel = F.concat_ws("_", sensor, F.concat(F.lit("T"), tile), day, F.lit("0"), F.lit("L2A"))
    landsat = F.concat_ws("_", sensor, F.lit("L2SP"), tile, day, F.lit("02"), F.lit("T1"))
    name = F.concat(F.when(sensor == "S2A", sentinel).otherwise(landsat), F.when(F.col("o_orderkey") % 4 == 0, "X.nc").otherwise(".nc"))
    return o.select("o_orderkey", name.alias("file"), F.date_format(F.col("o_orderdate").cast("date"), "yyyyDDD").alias("smooth"), F.col("o_orderdate").cast("date").alias("d"))


def _landsat(spark, sf):
    return _names(spark, sf).where(~F.col("file").startswith("S2A"))


_NAMES = """nm AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, strftime(o_orderdate, '%Y%j') AS smooth, strftime(o_orderdate, '%Y%m%d') AS ymd, lpad(CAST(o_custkey % 1000 AS VARCHAR), 6, '0') AS tile,
 CASE WHEN o_orderkey % 3 = 0 THEN 'LC08' WHEN o_orderkey % 3 = 1 THEN 'LE07' ELSE 'S2A' END AS sensor, CASE WHEN o_orderkey % 4 = 0 THEN 'X.nc' ELSE '.nc' END AS suffix FROM orders)"""


def image_names(spark, sf):
    """Fields of file names, and dates by three conventions."""
    n = _names(spark, sf)
    fields = nm.stac_fields("file")
    scene = nm.scene_fields(F.split_part("file", F.lit("."), F.lit(1)))
    smooth = nm.image_date(F.concat("smooth", F.lit(".tif")))
    raw = F.when(F.col("file").startswith("S2A"), nm.image_date("file", "raw_sentinel")).otherwise(nm.image_date("file", "raw"))
    return n.select(
        "o_orderkey", *[fields[k].alias(k) for k in ("base", "quality")], *[scene[k].alias(k) for k in ("sensor", "date", "yr")], smooth.alias("smooth_date"), raw.alias("raw_date"),
        nm.date_of_yyyyddd("smooth").alias("series_date"), nm.cell_name(F.col("o_orderkey") % 5000).alias("cell"), nm.late_l7(F.substring("file", 1, 4), "d", 1998).alias("late"),
    )


NAMES_SQL = f"""WITH {_NAMES}, f AS (SELECT *, CASE WHEN sensor = 'S2A' THEN concat(sensor, '_T', tile, '_', ymd, '_0') ELSE concat(sensor, '_L2SP_', tile, '_', ymd) END AS base FROM nm)
SELECT o_orderkey, base, CASE WHEN suffix = 'X.nc' THEN 'low_quality' ELSE 'image_used' END AS quality, CASE WHEN sensor = 'S2A' THEN 's2a_' ELSE lower(sensor) END AS sensor, ymd AS date, substr(ymd, 1, 4) AS yr,
 d AS smooth_date, d AS raw_date, d AS series_date, lpad(CAST(o_orderkey % 5000 AS VARCHAR), 6, '0') AS cell, sensor = 'LE07' AND year(d) >= 1998 AS late FROM f"""


def product_ids(spark, sf):
    n = _landsat(spark, sf)
    product = F.concat_ws("_", F.substring("file", 1, 4), F.substring("file", 11, 6), F.substring("file", 18, 8), F.when(F.col("o_orderkey") % 2 == 0, "L3A").otherwise("L3B"))
    return n.select("o_orderkey", nm.scene_of_product(product).alias("scene_id"), nm.bandpass(product).alias("bandpass"))


PRODUCT_SQL = f"WITH {_NAMES} SELECT o_orderkey, concat(sensor, '_L2SP_', tile, '_', ymd, '_02_T1') AS scene_id, o_orderkey % 2 = 1 AS bandpass FROM nm WHERE sensor != 'S2A'"


def export_names(spark, sf):
    """Names of the other export convention, where the date stands further right behind L1C_."""
    n = _names(spark, sf)
    mid = F.when(F.col("o_orderkey") % 2 == 0, "_L1C_T21HUB_A00123_").otherwise("_L2A_T21HUB_A0012_")
    file = F.concat(F.lit("S2A"), F.rpad(mid, 16, "0"), F.date_format("d", "yyyyMMdd"))
    fields = nm.export_fields(file)
    return n.select("o_orderkey", fields["sensor"].alias("sensor"), fields["date"].alias("date"))


EXPORT_SQL = f"""WITH {_NAMES}, f AS (SELECT o_orderkey, concat('S2A', rpad(CASE WHEN o_orderkey % 2 = 0 THEN '_L1C_T21HUB_A00123_' ELSE '_L2A_T21HUB_A0012_' END, 16, '0'), ymd) AS file, ymd FROM nm)
SELECT o_orderkey, substr(file, 1, 4) AS sensor, CASE WHEN contains(file, 'L1C_') THEN substr(file, 20, 8) ELSE substr(file, 18, 8) END AS date FROM f"""


def day_rollover(spark, sf):
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    day = nu.wrapped_day(F.dayofyear(d), 183)
    return o.select("o_orderkey", day.alias("day"), nm.day_of(F.year(d), day).alias("back"), nu.cyclic_day(F.dayofyear(d)).alias("cyclic"), F.round(nu.shift_length(F.col("o_orderkey") % 7, F.col("o_orderkey") % 11), 4).alias("shift"), nu.cropped_area(F.col("o_orderkey") % 50 - 25).alias("area"), nu.filled_short(F.col("o_totalprice")).alias("filled"))


ROLLOVER_SQL = """WITH q AS (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d FROM orders), w AS (SELECT *, CAST(CASE WHEN dayofyear(d) >= 183 THEN dayofyear(d) ELSE dayofyear(d) + 365 END AS INT) AS day FROM q)
SELECT o_orderkey, day, make_date(year(d), 1, 1) + CAST(day - 1 AS INT) AS back, CAST(trunc(100 * (cos(2 * pi() * dayofyear(d) / 365) + 1)) AS SMALLINT) AS cyclic, round(sqrt((o_orderkey % 7) * (o_orderkey % 7) + (o_orderkey % 11) * (o_orderkey % 11)), 4) AS shift,
 CASE WHEN o_orderkey % 50 < 25 THEN 32767 ELSE o_orderkey % 50 - 25 END AS area, CAST(CASE WHEN trunc(o_totalprice) <= 32767 THEN trunc(o_totalprice) ELSE 0 END AS SMALLINT) AS filled FROM w"""

# --- places ---


def _grid(spark):
    return sp.project_grid((0, -1000, 900, 9000), 100, spark)


_GRID = """gi AS (SELECT CAST(unnest(range(0, 10)) AS INT) AS i), gj AS (SELECT CAST(unnest(range(0, 101)) AS INT) AS j), grid AS (SELECT i * 101 + j + 1 AS cell_id, i * 100.0e0 - 100 AS xmin, -1000.0e0 + j * 100 AS ymin, i * 100.0e0 AS xmax, -900.0e0 + j * 100 AS ymax FROM gi, gj)"""


def points_in_cells(spark, sf):
    """Points strictly inside the cells of a project grid."""
    return sp.points_in_boxes(view(spark, sf, "points"), _grid(spark), 100.0).select("OID_", "cell_id")


IN_CELLS_SQL = f"{cte('points')}, {_GRID} SELECT OID_, cell_id FROM points JOIN grid ON x > xmin AND x < xmax AND y > ymin AND y < ymax"


def _zones(spark, sf):
    """A five-cornered ring in each zone's box of 180 by 2000."""
    z = view(spark, sf, "zones")
    corner = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    return z.select("zone_id", "estimate", "avg_farm", F.array(corner(0, 0), corner(180, 0), corner(180, 1000), corner(90, 2000), corner(0, 1000), corner(0, 0)).alias("ring"))


_IN_ZONE = "x > x0 AND x < x0 + 180 AND y > y0 AND y < y0 + 2000 AND (y < y0 + 1000 OR (x - x0 > 90 * (y - y0 - 1000) / 1000 AND x - x0 < 180 - 90 * (y - y0 - 1000) / 1000))"


def cells_over_zones(spark, sf):
    """Cells whose box overlaps a zone's box, with the area of the zone within the cell."""
    zones = _zones(spark, sf).withColumns(sp.ring_box(F.col("ring")))
    met = sp.boxes_overlap(_grid(spark), zones, 200.0)
    area = sp.clipped_area(F.col("ring_b"), tuple(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    return met.groupBy("zone_id_b").agg(F.count("*").alias("cells"), F.round(F.sum(area), 3).alias("area")).withColumnRenamed("zone_id_b", "zone_id")


#: Areas of a whole zone, of one that the grid covers up to 100 of its width or 1300 of its height, and of one with both.
OVERLAP_SQL = f"""{cte('zones')}, {_GRID}, o AS (SELECT zone_id, count(*) AS cells FROM grid JOIN zones ON greatest(xmin, x0) < least(xmax, x0 + 180) AND greatest(ymin, y0) < least(ymax, y0 + 2000) GROUP BY 1)
SELECT zone_id, cells, CASE WHEN zone_id % 5 = 4 AND zone_id >= 20 THEN 125950.0e0 WHEN zone_id % 5 = 4 THEN 154444.444e0 WHEN zone_id >= 20 THEN 225900.0e0 ELSE 270000.0e0 END AS area FROM o"""


def zone_cell_areas(spark, sf):
    """Areas that zones and cells of the grid, both as rings, have in common."""
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))
    cells = _grid(spark).select(F.col("cell_id").alias("zone_id"), F.array(ring).alias("rings"))
    zones = _zones(spark, sf).select("zone_id", F.array("ring").alias("rings"))
    met = sp.overlap_areas(zones, cells, 200.0)
    return met.groupBy("zone_id").agg(F.round(F.sum("area"), 3).alias("area"))


ZONE_CELLS_SQL = f"SELECT zone_id, area FROM ({OVERLAP_SQL})"


def catalogue_ids(spark, sf):
    """Sentinel ids of one provider in the form of the other."""
    n = _names(spark, sf).where(F.col("file").startswith("S2A"))
    level = F.when(F.col("o_orderkey") % 2 == 0, "MSIL2A").otherwise("MSIL1C")
    scene = F.concat_ws("_", F.lit("S2A"), level, F.concat(F.date_format("d", "yyyyMMdd"), F.lit("T135101")), F.lit("R024"), F.concat(F.lit("T21H"), F.lpad((F.col("o_orderkey") % 90).cast("string"), 2, "0")), F.lit("20200115"))
    return n.select("o_orderkey", nm.other_catalogue_id(scene).alias("scene_id"))


CATALOGUE_IDS_SQL = f"WITH {_NAMES} SELECT o_orderkey, concat('S2A_21H', lpad(CAST(o_orderkey % 90 AS VARCHAR), 2, '0'), '_', ymd, '_0_', CASE WHEN o_orderkey % 2 = 0 THEN 'L2A' ELSE 'L1C' END) AS scene_id FROM nm WHERE sensor = 'S2A'"


def zone_points(spark, sf):
    return sp.pixels_in_zones(view(spark, sf, "points"), _zones(spark, sf), 200.0).select("OID_", "zone_id")


ZONE_POINTS_SQL = f"{cte('points', 'zones')} SELECT OID_, zone_id FROM points JOIN zones ON {_IN_ZONE}"


def _zonal(spark, sf):
    zoned = sp.pixels_in_zones(view(spark, sf, "points"), _zones(spark, sf), 200.0).select("zone_id", F.col("LC_UNQ").alias("class"))
    groups = view(spark, sf, "lut").where("LC_UNQ < 20").select(F.col("LC_UNQ").alias("class"), F.col("LC3_name").alias("grp"))
    return mp.zonal_shares(zoned, groups)


_ZONAL = f"zc AS (SELECT zone_id, coalesce(LC3_name, 'other') AS grp FROM points JOIN zones ON {_IN_ZONE} LEFT JOIN lut ON points.LC_UNQ = lut.LC_UNQ AND lut.LC_UNQ < 20), zt AS (SELECT zone_id, count(*) AS numpix FROM zc GROUP BY 1), zs AS (SELECT zone_id, grp, count(*) AS n, round(100.0e0 * count(*) / any_value(numpix), 1) AS share, CAST(any_value(numpix) AS BIGINT) AS numpix FROM zc JOIN zt USING (zone_id) GROUP BY 1, 2)"
ZONAL_SQL = f"{cte('points', 'zones', 'lut')}, {_ZONAL} SELECT zone_id, grp, n, share, numpix FROM zs"


def district_errors(spark, sf):
    return mp.error_summary(mp.district_errors(_zonal(spark, sf), view(spark, sf, "zones").select("zone_id", "estimate", "avg_farm"), "crop"))


DISTRICT_SQL = f"""{cte('points', 'zones', 'lut')}, {_ZONAL}, e AS (SELECT avg_farm, coalesce(share, 0) - estimate AS d FROM zones LEFT JOIN (SELECT * FROM zs WHERE grp = 'crop') s USING (zone_id))
SELECT round(avg(abs(d)), 2) AS mae_all, round(avg(d), 2) AS bias_all, round(avg(abs(d)) FILTER (WHERE avg_farm < 5), 2) AS mae_small, round(avg(d) FILTER (WHERE avg_farm < 5), 2) AS bias_small, round(avg(abs(d)) FILTER (WHERE avg_farm > 20), 2) AS mae_large, round(avg(d) FILTER (WHERE avg_farm > 20), 2) AS bias_large FROM e"""


def _land(spark, sf):
    """A table of pixels of 50 by 50: one value for each that holds a supplier."""
    p = table(spark, sf, "supplier").select("s_suppkey", ((F.col("s_suppkey") * 37) % 1000 + 0.5).alias("x"), (F.floor("s_acctbal") + 0.25).alias("y"))
    row, col = sp.pixel_key(F.col("x"), F.col("y"), 50.0)
    return p.groupBy(row, col).agg(F.max("s_suppkey").alias("value")).withColumns({"px": (F.col("col") + 0.5) * 50, "py": (F.col("row") + 0.5) * 50})


_LAND = "land AS (SELECT CAST(floor((floor(s_acctbal) + 0.25e0) / 50) AS INT) AS r, CAST(floor(((s_suppkey * 37) % 1000 + 0.5e0) / 50) AS INT) AS c, max(s_suppkey) AS value FROM supplier GROUP BY 1, 2)"


def sampled_pixels(spark, sf):
    return sp.sample_pixels(view(spark, sf, "points"), _land(spark, sf), 50.0).select("OID_", "row", "col", "value")


SAMPLED_SQL = f"""{cte('points')}, {_LAND} SELECT OID_, CAST(floor(y / 50) AS INT) AS "row", CAST(floor(x / 50) AS INT) AS "col", value FROM points LEFT JOIN land ON r = floor(y / 50) AND c = floor(x / 50)"""


def nearest_pixels(spark, sf):
    """The nearest pixel of 50 within 120."""
    out = sp.nearest_pixels(view(spark, sf, "points").select("OID_", "x", "y"), _land(spark, sf), 50.0, 120.0, "OID_")
    return out.select("OID_", "row", "col", "value", F.round("distance", 4).alias("distance"))


NEAREST_SQL = f"""{cte('points')}, {_LAND}, k AS (SELECT OID_, r, c, value, sqrt(((c + 0.5e0) * 50 - x) * ((c + 0.5e0) * 50 - x) + ((r + 0.5e0) * 50 - y) * ((r + 0.5e0) * 50 - y)) AS d FROM points JOIN land ON abs(r - floor(y / 50)) <= 3 AND abs(c - floor(x / 50)) <= 3),
 b AS (SELECT *, row_number() OVER (PARTITION BY OID_ ORDER BY d, r, c) AS n FROM k WHERE d <= 120) SELECT OID_, r AS "row", c AS "col", value, round(d, 4) AS distance FROM points LEFT JOIN (SELECT * FROM b WHERE n = 1) USING (OID_)"""


def point_patches(spark, sf):
    return sp.patches(view(spark, sf, "points").select("OID_", "x", "y"), _land(spark, sf), 50.0).select("OID_", "row", "col", "value")


PATCHES_SQL = f"""{cte('points')}, {_LAND} SELECT OID_, r AS "row", c AS "col", value FROM points JOIN land ON abs(r - floor(y / 50)) <= 1 AND abs(c - floor(x / 50)) <= 1"""


def random_points(spark, sf):
    """Ten repeatable random points in each zone."""
    return sp.random_points(_zones(spark, sf), 10, 7).select("zone_id", "point_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_UNIFORM = "CAST('0x' || substr(md5(concat(zone_id, ':', i, ':{}7')), 1, 13) AS BIGINT) / 4503599627370496.0e0"
#: The three triangles of a zone, from its lower left corner: thirds of the way along their areas, 90000, 135000 and 45000.
RANDOM_SQL = f"""{cte('zones')}, k AS (SELECT *, CAST(unnest(range(0, 10)) AS INT) AS i FROM zones),
 u AS (SELECT zone_id, i, x0, y0, {_UNIFORM.format('t')} * 270000.0e0 AS t, {_UNIFORM.format('x')} AS a, {_UNIFORM.format('y')} AS b FROM k),
 f AS (SELECT zone_id, i, x0, y0, t, CASE WHEN a + b > 1 THEN 1 - a ELSE a END AS a, CASE WHEN a + b > 1 THEN 1 - b ELSE b END AS b FROM u)
 SELECT zone_id, concat(zone_id, '_', i) AS point_id, round(x0 + a * (CASE WHEN t < 90000 THEN 180 WHEN t < 225000 THEN 180 ELSE 90 END) + b * (CASE WHEN t < 90000 THEN 180 WHEN t < 225000 THEN 90 ELSE 0 END), 6) AS x,
 round(y0 + a * (CASE WHEN t < 90000 THEN 0 WHEN t < 225000 THEN 1000 ELSE 2000 END) + b * (CASE WHEN t < 90000 THEN 1000 WHEN t < 225000 THEN 2000 ELSE 1000 END), 6) AS y FROM f"""


def grid_cells(spark, sf):
    """Points in each cell of the grid, and the cell's box."""
    counts = sp.points_in_boxes(view(spark, sf, "points"), _grid(spark), 100.0).groupBy("cell_id").agg(F.count("*").alias("n"))
    return _grid(spark).join(counts, "cell_id", "left").na.fill(0, ["n"])


GRID_SQL = f"{cte('points')}, {_GRID}, k AS (SELECT cell_id, count(*) AS n FROM points JOIN grid ON x > xmin AND x < xmax AND y > ymin AND y < ymax GROUP BY 1) SELECT cell_id, xmin, ymin, xmax, ymax, coalesce(n, 0) AS n FROM grid LEFT JOIN k USING (cell_id)"

# --- maps ---


def downsampled(spark, sf):
    """Means of blocks of three by three pixels, over all their images."""
    return sp.downsample(view(spark, sf, "pixels"), 3).withColumn("value", F.round("value", 4))


DOWN_SQL = f"""{cte('pixels')} SELECT cell_id, CAST(floor(r / 3) AS INT) AS "row", CAST(floor(c / 3) AS INT) AS "col", round(avg(value), 4) AS value FROM pixels GROUP BY 1, 2, 3"""


def cropped(spark, sf):
    """Values of the pixels within a window of rows and columns."""
    return sp.crop(view(spark, sf, "pixels"), 0, 2, 1, 12).groupBy("cell_id", "spec_index").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("total"))


CROPPED_SQL = f"""{cte('pixels')} SELECT cell_id, spec_index, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM pixels WHERE r BETWEEN 1 AND 12 AND c BETWEEN 0 AND 2 GROUP BY 1, 2"""


def decimated(spark, sf):
    return sp.decimate(view(spark, sf, "pixels"), 2).groupBy("cell_id", "row", "col").agg(F.count("*").alias("n"))


DECIMATED_SQL = f"""{cte('pixels')} SELECT cell_id, r AS "row", c AS "col", count(*) AS n FROM pixels WHERE r % 2 = 0 AND c % 2 = 0 GROUP BY 1, 2, 3"""


def mosaicked(spark, sf):
    p = view(spark, sf, "points")
    tiles = p.select((F.col("OID_") % 6).cast("int").alias("cell_id"), F.floor(F.col("x") / 10).alias("x"), F.floor(F.col("y") / 100).alias("y"), (F.col("OID_") % 9).alias("value"))
    priority = tiles.select("cell_id").distinct().withColumn("rank", (F.col("cell_id") * 5) % 6)
    return mp.mosaic(tiles, priority)


MOSAIC_SQL = f"""{cte('points')}, t AS (SELECT CAST(OID_ % 6 AS INT) AS cell_id, CAST(floor(x / 10) AS BIGINT) AS x, CAST(floor(y / 100) AS BIGINT) AS y, OID_ % 9 AS value FROM points)
SELECT x, y, arg_min(value, ((cell_id * 5) % 6) * 100 + value) AS value FROM t WHERE value != 0 GROUP BY 1, 2"""


def histograms(spark, sf):
    return mp.histogram(view(spark, sf, "pixels"), 50, 0, 9000)


HISTOGRAM_SQL = f"""{cte('pixels')} SELECT spec_index, CAST(least(floor(value * 50.0e0 / 9000) + 1, 51) AS BIGINT) AS bin, count(*) AS n, count(*) FILTER (WHERE value > 0 AND value < 10000) AS n_valid FROM pixels GROUP BY 1, 2"""


def stretched(spark, sf):
    out = mp.stretched(view(spark, sf, "pixels"))
    return out.select("cell_id", "row", "col", "spec_index", "img_date", F.round("stretched", 5).alias("stretched"))


STRETCHED_SQL = f"""{cte('pixels')}, g AS (SELECT *, pow(CAST(value AS DOUBLE), 1 / 1.5e0) AS v FROM pixels), b AS (SELECT spec_index, min(v) AS lo, max(v) AS hi FROM g GROUP BY 1)
SELECT {KEY_SQL}, img_date, round((v - lo) / (hi - lo), 5) AS stretched FROM g JOIN b USING (spec_index)"""


def image_bounds(spark, sf):
    return sp.image_bounds(view(spark, sf, "points").withColumn("image_id", F.col("field_id")))


BOUNDS_SQL = f"{cte('points')} SELECT field_id AS image_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy FROM points GROUP BY 1"


def class_means(spark, sf):
    return mp.mean_by_class(view(spark, sf, "points"), ["Width", "rand"], 3, 12).select("Class", F.round("Width", 4).alias("Width"), F.round("rand", 5).alias("rand"))


CLASS_MEANS_SQL = f"{cte('points')} SELECT Class, round(avg(Width), 4) AS \"Width\", round(avg(rand), 5) AS rand FROM points WHERE LC_UNQ BETWEEN 3 AND 12 GROUP BY 1"


def external_recall(spark, sf):
    return mp.external_recall(view(spark, sf, "scores").withColumn("map_val", (F.col("pred") < 12).cast("int"))).withColumn("recall", F.round("recall", 6))


EXTERNAL_SQL = f"{cte('scores')} SELECT ho_type, round(sum(CAST(pred < 12 AS INT)) / CAST(count(*) AS DOUBLE), 6) AS recall, count(*) AS n FROM scores GROUP BY 1"

# --- stacks ---


def feature_stack(spark, sf):
    """Features of all indices side by side, in a model's order, with a singleton and a polygon feature; missing values of each counted."""
    features = fe.seasonal_features(view(spark, sf, "pixels"), ["maxv_yr", "amp_dry"], 1998, 7)
    single = view(spark, sf, "pixels").groupBy("cell_id", "row", "col").agg(F.count("*").alias("obs"))
    stack = st.attach(st.index_stack(features, ["A", "N", "R"]), single, single.where("obs > 600").select("cell_id", "row", "col", F.lit(2).alias("poly")))
    stack = stack.withColumn("cropbnds", st.polygon_feature(stack, "cropbnds"))
    model = st.FeatureModel(spec_indices=["A", "N", "R"], si_vars=["maxv_yr", "amp_dry"], singleton_vars=["obs"], poly_vars=["cropbnds"])
    return st.select_bands(stack, model.band_names)


_IX = ", ".join(f"max(m) FILTER (WHERE spec_index = '{i}') AS \"{i}_maxv_yr\", max(a) FILTER (WHERE spec_index = '{i}') AS \"{i}_amp_dry\"" for i in "ANR")
STACK_SQL = f"""{cte('pixels')}, y AS (SELECT *, (year(img_date) = 1998 AND dayofyear(img_date) >= 183) OR (year(img_date) = 1999 AND dayofyear(img_date) < 183) AS yr, year(img_date) = 1998 AND dayofyear(img_date) > 183 AND dayofyear(img_date) < 259 AS dry FROM pixels),
 f AS (SELECT cell_id, r, c, spec_index, max(value) FILTER (WHERE yr) AS m, (max(value) FILTER (WHERE dry)) - (min(value) FILTER (WHERE dry)) AS a FROM y WHERE yr OR dry GROUP BY 1, 2, 3, 4), w AS (SELECT cell_id, r, c, {_IX} FROM f GROUP BY 1, 2, 3), o AS (SELECT cell_id, r, c, count(*) AS obs FROM pixels GROUP BY 1, 2, 3)
SELECT cell_id, r AS "row", c AS "col", w.* EXCLUDE (cell_id, r, c), obs AS sing_obs, CASE WHEN obs > 600 THEN 1 END AS poly_cropbnds FROM w FULL JOIN o USING (cell_id, r, c)"""


def missing_values(spark, sf):
    frame = sa.with_lut(view(spark, sf, "points"), view(spark, sf, "lut").where("LC_UNQ % 2 = 0"))
    return st.missing_values(st.append_features(frame, frame.where("OID_ % 4 = 0").select("OID_", F.col("x").alias("var_A_x"), F.col("y").alias("var_poly_y"))))


MISSING_SQL = f"""{cte('points', 'lut')}, j AS (SELECT points.*, LC25, LC25_name FROM points LEFT JOIN (SELECT * FROM lut WHERE LC_UNQ % 2 = 0) l ON Class = USE_NAME), k AS (
 SELECT 'SampMethod' AS "column", count(*) FILTER (WHERE SampMethod IS NULL) AS n FROM j UNION ALL SELECT 'FieldWidth', count(*) FILTER (WHERE FieldWidth IS NULL) FROM j UNION ALL SELECT unnest(['LC25', 'LC25_name', 'LC2', 'LC2_name']), n FROM (SELECT count(*) FILTER (WHERE LC25 IS NULL) AS n FROM j) UNION ALL
 SELECT unnest(['var_A_x', 'var_poly_y']), n FROM (SELECT count(*) FILTER (WHERE OID_ % 4 != 0) AS n FROM j)) SELECT "column", n FROM k WHERE n > 0"""


def reduced_features(spark, sf):
    """A frame without an index, a variable and polygon features."""
    p = view(spark, sf, "points")
    frame = p.select("OID_", *[F.col(c).alias(f"var_{i}_{v}") for i, c in (("A", "x"), ("N", "y")) for v in ("maxv", "minv")], F.col("Width").alias("var_poly_area"))
    return st.without_polygons(st.drop_features(frame, indices=("A",), variables=("minv",)))


REDUCED_SQL = f'{cte("points")} SELECT OID_, y AS "var_N_maxv" FROM points'

# --- inventories ---


def unique_files(spark, sf):
    f = view(spark, sf, "files").where(~F.col("file").contains("angles"))
    named = f.select(F.concat_ws("_", "cell_id", F.regexp_replace("file", r"X?\.nc$", "")).alias("base"), F.when(F.col("file").endswith("X.nc"), "low_quality").otherwise("image_used").alias("quality"), "file")
    return iv.unique_scenes(named)


UNIQUE_SQL = f"""{cte('files')}, f AS (SELECT concat(cell_id, '_', regexp_replace(file, 'X?\\.nc$', '')) AS base, CASE WHEN file LIKE '%X.nc' THEN 1 ELSE 0 END AS q, file FROM files WHERE file NOT LIKE '%angles%'),
 k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY q, file) AS n FROM f) SELECT base, file, CASE WHEN q = 1 THEN 'low_quality' ELSE 'image_used' END AS quality FROM k WHERE n = 1"""


def first_cells(spark, sf):
    return iv.first_cells(view(spark, sf, "scenes").groupBy("scene_id", "cell_id").agg(F.count("*").alias("n"))).select("scene_id", "cell_id", "n")


FIRST_SQL = f"{cte('scenes')}, g AS (SELECT scene_id, cell_id, count(*) AS n FROM scenes GROUP BY 1, 2) SELECT scene_id, min(cell_id) AS cell_id, arg_min(n, cell_id) AS n FROM g GROUP BY 1"


def closest_images(spark, sf):
    s = view(spark, sf, "scenes").select("cell_id", "img_date", F.col("numpix").alias("size"), F.col("scene_id").alias("file"))
    requests = s.select("cell_id", F.year("img_date").alias("year")).distinct().withColumn("day", ((F.col("cell_id") * 7) % 365 + 1)).withColumn("req_id", F.concat_ws("-", "cell_id", "year"))
    return iv.closest_image(requests, s)


CLOSEST_SQL = f"""{cte('scenes')}, q AS (SELECT DISTINCT cell_id, year(img_date) AS y FROM scenes), k AS (SELECT concat(q.cell_id, '-', y) AS req_id, CAST(abs(dayofyear(img_date) - ((q.cell_id * 7) % 365 + 1)) AS INT) AS gap, CAST(dayofyear(img_date) AS INT) AS img_day, numpix, scene_id FROM q JOIN scenes ON q.cell_id = scenes.cell_id AND year(img_date) = y),
 b AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY gap, img_day, numpix DESC, scene_id) AS n FROM k) SELECT req_id, gap AS off, img_day, scene_id AS file FROM b WHERE n = 1"""


def missing_files(spark, sf):
    f = view(spark, sf, "files")
    left = iv.missing_files(f.where("sub_dir = 'en'").select("cell_id", "file").distinct(), f.where("sub_dir != 'en'")).withColumn("state", F.lit("missing"))
    return left.union(iv.existing_files(f.where("sub_dir = 'en'").select("cell_id", "file").distinct(), f.where("sub_dir != 'en'")).withColumn("state", F.lit("there")))


MISSING_FILES_SQL = f"""{cte('files')}, e AS (SELECT DISTINCT cell_id, file FROM files WHERE sub_dir = 'en'), o AS (SELECT DISTINCT cell_id, file FROM files WHERE sub_dir != 'en')
SELECT e.cell_id, e.file, CASE WHEN o.file IS NULL THEN 'missing' ELSE 'there' END AS state FROM e LEFT JOIN o USING (cell_id, file)"""


def cells_with_file(spark, sf):
    f = view(spark, sf, "files")
    return iv.cells_with_file(f, "en", "src3.nc").withColumn("has", F.lit(True)).union(iv.cells_with_file(f, "en", "src3.nc", True).withColumn("has", F.lit(False)))


CELLS_SQL = f"{cte('files')} SELECT cell_id, bool_or(file = 'src3.nc' OR file = concat(lpad(CAST(cell_id AS VARCHAR), 6, '0'), '_src3.nc')) AS has FROM files WHERE sub_dir = 'en' GROUP BY 1"


def catalogue_differences(spark, sf):
    s = view(spark, sf, "scenes")
    return iv.set_differences(s.where("yr = 1998"), s.where("yr = 1999"))


DIFFERENCES_SQL = f"""{cte('scenes')}, a AS (SELECT DISTINCT scene_id FROM scenes WHERE yr = 1998), b AS (SELECT DISTINCT scene_id FROM scenes WHERE yr = 1999)
SELECT scene_id, 'a' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT scene_id, 'b' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""


def matched_products(spark, sf):
    n = _landsat(spark, sf)
    s = n.select(F.col("o_orderkey").alias("scene_id"), F.lower(F.substring("file", 1, 4)).alias("sensor"), F.substring("file", 18, 8).alias("date"), F.substring("file", 11, 6).alias("tile"))
    products = n.where("o_orderkey % 5 < 3").select(F.concat_ws("_", F.substring("file", 1, 4), F.substring("file", 11, 6), F.substring("file", 18, 8), F.concat(F.lit("L3"), F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B"))).alias("product"), F.substring("file", 18, 8).alias("date"))
    return iv.match_products(s, products)


MATCHED_SQL = f"""WITH {_NAMES}, s AS (SELECT * FROM nm WHERE sensor != 'S2A'), p AS (SELECT DISTINCT sensor, ymd, concat(sensor, '_', tile, '_', ymd, '_L3', CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END) AS product FROM s WHERE o_orderkey % 5 < 3)
SELECT o_orderkey AS scene_id, lower(s.sensor) AS sensor, s.ymd AS date, s.tile, max(product) AS product FROM s LEFT JOIN p ON s.sensor = p.sensor AND s.ymd = p.ymd AND split_part(product, '_', 2) = s.tile GROUP BY 1, 2, 3, 4"""


def rebuilt(spark, sf):
    n = _landsat(spark, sf).withColumn("cell_id", (F.col("o_orderkey") % 20).cast("int"))
    products = n.where("o_orderkey % 5 < 3").select("cell_id", F.concat_ws("_", F.substring("file", 1, 4), F.substring("file", 11, 6), F.substring("file", 18, 8), F.concat(F.lit("L3"), F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B"))).alias("product"))
    return iv.rebuild(n.select("cell_id", F.regexp_replace("file", r"X?\.nc$", "").alias("scene_id")), products)


REBUILT_SQL = f"""WITH {_NAMES}, s AS (SELECT *, CAST(o_orderkey % 20 AS INT) AS cell_id, concat(sensor, '_L2SP_', tile, '_', ymd, '_02_T1') AS scene_id FROM nm WHERE sensor != 'S2A'),
 p AS (SELECT cell_id, scene_id, max(concat(sensor, '_', tile, '_', ymd, '_L3', CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END)) AS brdf_id FROM s WHERE o_orderkey % 5 < 3 GROUP BY 1, 2)
SELECT cell_id, scene_id, brdf_id, brdf_id LIKE '%L3B' AS bandpass, CASE WHEN brdf_id IS NOT NULL THEN true END AS brdf FROM (SELECT DISTINCT cell_id, scene_id FROM s) LEFT JOIN p USING (cell_id, scene_id)"""


def scenes_between(spark, sf):
    s = view(spark, sf, "scenes").withColumn("date", F.date_format("img_date", "yyyyMMdd"))
    return iv.scenes_between(s, 1997, 1999, "l").groupBy("sensor", "yr").agg(F.count("*").alias("n"))


BETWEEN_SQL = f"{cte('scenes')} SELECT sensor, yr, count(*) AS n FROM scenes WHERE img_date >= DATE '1997-01-01' AND img_date < DATE '1999-01-01' AND sensor LIKE 'l%' GROUP BY 1, 2"


def catalogue(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("obs"), (F.col("o_custkey") % 100).cast("double").alias("cloudcov"), (F.col("o_orderkey") % 360 - 180).alias("xmin"), (F.col("o_orderkey") % 360 - 170).alias("xmax"), (F.col("o_custkey") % 180 - 90).alias("ymin"), (F.col("o_custkey") % 180 - 80).alias("ymax"))
    return iv.catalogue(o, "1997-01-01", "1998-01-01", 40, (-60, -30, 20, 10)).select("id", "cloudcov")


CATALOGUE_SQL = """SELECT o_orderkey AS id, CAST(o_custkey % 100 AS DOUBLE) AS cloudcov FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey % 100 < 40
 AND o_orderkey % 360 - 180 < 20 AND o_orderkey % 360 - 170 > -60 AND o_custkey % 180 - 90 < 10 AND o_custkey % 180 - 80 > -30"""


def why_missing(spark, sf):
    return iv.why_missing(view(spark, sf, "scenes").where("not used"), 30)


WHY_SQL = f"""{cte('scenes')} SELECT cell_id, sensor, count(*) AS n_missing, count(*) FILTER (WHERE NOT (sensor = 'le07' AND year(img_date) >= 2017)) AS n_unexplained, count(*) FILTER (WHERE NOT (sensor = 'le07' AND year(img_date) >= 2017)) <= 30 AS complete FROM scenes WHERE NOT used GROUP BY 1, 2"""


def images_by_year(spark, sf):
    return iv.counts_by(view(spark, sf, "scenes"), "yr", "sensor", ["lt05", "le07", "lc08", "lc09", "s2a"])


BY_YEAR_SQL = f"{cte('scenes')} SELECT yr, {', '.join(f'''count(*) FILTER (WHERE sensor = '{s}') AS {s}''' for s in ('lt05', 'le07', 'lc08', 'lc09', 's2a'))} FROM scenes GROUP BY 1"


def images_by_month(spark, sf):
    """Failed images by month; there are months without any."""
    return iv.by_month(view(spark, sf, "scenes").where("error is not null and brdf_error is not null"))


BY_MONTH_SQL = f"""{cte('scenes')}, k AS (SELECT CAST(date_trunc('month', img_date) AS DATE) AS m, count(*) AS n FROM scenes WHERE error IS NOT NULL AND brdf_error IS NOT NULL GROUP BY 1),
 a AS (SELECT CAST(unnest(generate_series(CAST(min(m) AS TIMESTAMP), CAST(max(m) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM k) SELECT month, coalesce(n, 0) AS n FROM a LEFT JOIN k ON month = m"""


def cell_status(spark, sf):
    out = iv.cell_status(view(spark, sf, "scenes").withColumn("redownload", F.col("numpix") % 50 < F.month("img_date")), [1997, 1998])
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.startswith(("avg_shift", "med_shift", "max_shift"))})


def _status_sql() -> str:
    again = "numpix % 50 < month(img_date)"
    ok = f"NOT coalesce(skip, false) AND error IS NULL AND NOT ({again})"
    shift = "sqrt(shift_x * shift_x + shift_y * shift_y)"
    cols = ["count(*) AS seen", "count(*) FILTER (WHERE skip) AS skipped", "count(*) FILTER (WHERE error IS NOT NULL) AS dl_errors", "count(*) FILTER (WHERE brdf_error IS NOT NULL) AS brdf_errors", f"count(*) FILTER (WHERE {again}) AS to_redownload"]
    for y in (1997, 1998):
        cols += [f"count(*) FILTER (WHERE {ok} AND yr = {y}) AS images_ingested_{y}", f"count(*) FILTER (WHERE used AND yr = {y}) AS images_used_{y}"]
    cols += [f"count(*) FILTER (WHERE sensor LIKE '{s}%' AND brdf) AS num_processed_{s}" for s in iv.SENSORS] + ["count(*) FILTER (WHERE brdf) AS num_brdf", "count(*) FILTER (WHERE coreg) AS num_coreged"]
    for s in ("s2", "lt05", "le07"):
        cols += [f"round({f}({shift}) FILTER (WHERE coreg AND sensor LIKE '{s}%'), 4) AS {n}_shift_{s}" for f, n in (("avg", "avg"), ("max", "max"), ("median", "med"))]
    cols += [f"count(*) FILTER (WHERE {ok}) AS ingested", "count(*) FILTER (WHERE used) AS used", f"count(*) - count(*) FILTER (WHERE {ok}) AS excluded", f"count(*) FILTER (WHERE {ok}) - count(*) FILTER (WHERE used) AS low_quality", "round(count(*) FILTER (WHERE coreg) / CAST(count(*) FILTER (WHERE brdf) AS DOUBLE), 3) AS per_coreg"]
    return f"{cte('scenes')} SELECT cell_id, {', '.join(cols)} FROM scenes GROUP BY 1"


def index_coverage(spark, sf):
    files = view(spark, sf, "scenes").select("cell_id", F.col("sensor").alias("spec_index"), "yr").where("yr != 1995 or cell_id % 3 > 0")
    coverage = iv.index_coverage(files)
    return coverage.join(iv.complete_cells(coverage, 1995, 2001, 5), "cell_id").select("cell_id", "spec_index", "years", "n_complete", "complete", "started")


COVERAGE_SQL = f"""{cte('scenes')}, g AS (SELECT cell_id, sensor AS spec_index, min(yr) AS a, max(yr) AS b FROM scenes WHERE yr != 1995 OR cell_id % 3 > 0 GROUP BY 1, 2),
 k AS (SELECT cell_id, count(*) FILTER (WHERE a <= 1995 AND b >= 2001) AS n_complete, count(*) FILTER (WHERE a <= 1995 AND b >= 2001) >= 5 AS complete, bool_or(NOT (a <= 1995 AND b >= 2001)) AS started FROM g GROUP BY 1) SELECT cell_id, spec_index, concat(a, '-', b) AS years, n_complete, complete, started FROM g JOIN k USING (cell_id)"""


def shift_statistics(spark, sf):
    out = iv.shift_statistics(view(spark, sf, "scenes"))
    return out.withColumns({c: F.round(c, 4) for c in ("mean_shift", "med_shift", "max_shift")})


SHIFT_SQL = f"""{cte('scenes')}, s AS (SELECT sensor, CASE WHEN coreg THEN sqrt(shift_x * shift_x + shift_y * shift_y) END AS d FROM scenes) SELECT sensor, count(*) AS n, count(d) AS n_coreg, round(avg(d), 4) AS mean_shift, round(median(d), 4) AS med_shift, round(max(d), 4) AS max_shift FROM s GROUP BY 1"""


def scenes_per_year(spark, sf):
    s = view(spark, sf, "scenes").groupBy("scene_id", "sensor").agg(F.min("yr").alias("yr")).withColumn("scene_id", F.concat_ws("_", "scene_id", "sensor"))
    return iv.scenes_per_year(s).select(*[F.round(c, 4).alias(c) for c in ("avg_n", "avg_landsat", "avg_sentinel")])


PER_YEAR_SQL = f"""{cte('scenes')}, u AS (SELECT scene_id, sensor, min(yr) AS yr FROM scenes GROUP BY 1, 2), g AS (SELECT yr, count(*) AS n, count(*) FILTER (WHERE sensor LIKE 'l%') AS l, count(*) FILTER (WHERE sensor LIKE 's%') AS s FROM u GROUP BY 1)
SELECT round(avg(n), 4) AS avg_n, round(avg(l), 4) AS avg_landsat, round(avg(s), 4) AS avg_sentinel FROM g"""


def grid_totals(spark, sf):
    s = view(spark, sf, "scenes")
    return iv.grid_totals(s).crossJoin(iv.scene_estimate(iv.cell_status(s, [1998]), ["images_ingested_1998", "images_used_1998"])).withColumn("skip_reasons", F.array_join("skip_reasons", ","))  # one row each


TOTALS_SQL = f"""{cte('scenes')} SELECT count(*) AS n, CAST(sum(numpix) AS BIGINT) AS numpix, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT skip_reason AS x FROM scenes WHERE skip_reason IS NOT NULL)) AS skip_reasons,
 CAST(floor(count(*) FILTER (WHERE NOT coalesce(skip, false) AND error IS NULL AND yr = 1998) / 80) AS BIGINT) AS images_ingested_1998, CAST(floor(count(*) FILTER (WHERE used AND yr = 1998) / 80) AS BIGINT) AS images_used_1998 FROM scenes"""


def undersized(spark, sf):
    return iv.undersized(view(spark, sf, "files"), 800).groupBy("cell_id").agg(F.count("*").alias("n"))


UNDERSIZED_SQL = f"{cte('files')} SELECT cell_id, count(*) AS n FROM files WHERE size < 800 GROUP BY 1"


def upserted(spark, sf):
    s = view(spark, sf, "scenes")
    old = s.where("yr < 1999 and cell_id < 40").groupBy("cell_id").agg(F.count("*").alias("n"), F.max("numpix").alias("most"))
    new = s.where("yr >= 1999 and cell_id >= 20").groupBy("cell_id").agg(F.count("*").alias("n"), F.min("numpix").alias("least"))
    return iv.upsert(old, new)


UPSERT_SQL = f"""{cte('scenes')}, a AS (SELECT cell_id, count(*) AS n, max(numpix) AS most FROM scenes WHERE yr < 1999 AND cell_id < 40 GROUP BY 1), b AS (SELECT cell_id, count(*) AS n, min(numpix) AS least FROM scenes WHERE yr >= 1999 AND cell_id >= 20 GROUP BY 1)
SELECT cell_id, coalesce(b.n, a.n) AS n, most, least FROM a FULL JOIN b USING (cell_id)"""

# --- logs ---


def date_gaps(spark, sf):
    return lg.date_gaps(view(spark, sf, "ranges"), "1995-01-01", "2001-12-31")


GAPS_SQL = f"""{cte('ranges')}, w AS (SELECT *, max("end") OVER (PARTITION BY cell_id ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached, count(*) OVER (PARTITION BY cell_id) AS n FROM ranges),
 s AS (SELECT cell_id, min("start") AS a, max("end") AS b FROM ranges GROUP BY 1 HAVING count(*) > 1)
SELECT cell_id, reached AS "start", "start" AS "end" FROM w WHERE n > 1 AND "start" > reached AND NOT (month(reached) = 12 AND day(reached) = 31 AND "start" = reached + 1) UNION ALL SELECT cell_id, DATE '1995-01-01', a FROM s WHERE a > DATE '1995-01-01' UNION ALL SELECT cell_id, b, DATE '2001-12-31' FROM s WHERE b < DATE '2001-12-31'"""


def _log_lines(spark, sf):
    """Lines of a log for each customer's file: the cell, then a period, sometimes an error, a runtime and cores per order."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    file = F.concat(F.lit("stacdl_"), F.col("o_custkey") % 400, F.lit(".err"))
    no = F.unix_date("d").cast("long") * 1_000_000 + (F.col("o_orderkey") % 100_000) * 10
    made = [
        o.select(file.alias("file"), F.lit(0).cast("long").alias("line_no"), F.concat(F.lit("cell_id = "), F.col("o_custkey") % 400 + 7).alias("line")).distinct(),
        o.select(file, no, F.concat(F.lit("\\ Working on "), F.col("d"), F.lit(" to "), F.date_add("d", (F.col("o_orderkey") % 40).cast("int")))),
        o.where("o_orderkey % 9 = 0").select(file, no + 1, F.when(F.col("o_orderkey") % 2 == 0, "TimeoutError: no answer").when(F.col("o_orderkey") % 3 == 0, "  raise pystac_client.exceptions.APIError").otherwise("download failed: urllib.error.HTTPError: 502")),
        o.where("o_orderkey % 7 = 0").select(file, no + 4, F.lit("a warning, no error")),
        o.where("o_orderkey % 4 = 0").select(file, no + 2, F.concat(F.lit("full process took: "), F.col("o_orderkey") % 90, F.lit(" minutes"))),
        o.where("o_orderkey % 8 = 0").select(file, no + 3, F.concat(F.lit("core used: "), F.col("o_custkey") % 120)),
    ]
    return reduce(lambda a, b: a.union(b), made)


_LOG = """o AS (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(o_custkey % 400 + 7 AS INT) AS cell_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS e, o_custkey % 400 AS f FROM orders)"""


def log_status(spark, sf):
    """Download status by cell from log lines."""
    out = lg.roll_up(_log_lines(spark, sf))
    return out.select("cell_id", "dllog_start", "dllog_end", "dltime", "dlcoremin", F.size("dllog_gaps").alias("n_gaps"), F.size("dl_fix_now").alias("n_fix"), F.size("dllog_errors").alias("n_errors"))


LOG_SQL = f"""WITH {_LOG}, p AS (SELECT cell_id, min(d) AS dllog_start, max(e) AS dllog_end FROM o GROUP BY 1), c AS (SELECT f, any_value(cell_id) AS cell_id, CAST(sum(o_orderkey % 90) FILTER (WHERE o_orderkey % 4 = 0) AS INT) AS m, max(o_custkey % 120) FILTER (WHERE o_orderkey % 8 = 0) AS k FROM o GROUP BY 1),
 r AS (SELECT cell_id, m AS dltime, CAST(m * CASE WHEN k IS NULL OR k > 90 THEN 4 ELSE k END AS INT) AS dlcoremin FROM c),
 w AS (SELECT cell_id, d, e, max(e) OVER (PARTITION BY cell_id ORDER BY d, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached, count(*) OVER (PARTITION BY cell_id) AS n FROM o),
 g AS (SELECT cell_id, reached AS a, d AS b FROM w WHERE n > 1 AND d > reached AND NOT (month(reached) = 12 AND day(reached) = 31 AND d = reached + 1)), x AS (SELECT DISTINCT cell_id, d AS a, e AS b FROM o WHERE o_orderkey % 9 = 0),
 gc AS (SELECT cell_id, count(*) AS n FROM g GROUP BY 1), xc AS (SELECT cell_id, count(*) AS n FROM x GROUP BY 1), fc AS (SELECT cell_id, count(*) AS n FROM (SELECT * FROM g UNION SELECT * FROM x) GROUP BY 1)
SELECT p.cell_id, dllog_start, dllog_end, dltime, dlcoremin, CAST(coalesce(gc.n, 0) AS INT) AS n_gaps, CAST(coalesce(fc.n, 0) AS INT) AS n_fix, CAST(coalesce(xc.n, 0) AS INT) AS n_errors FROM p JOIN r USING (cell_id) LEFT JOIN gc USING (cell_id) LEFT JOIN xc USING (cell_id) LEFT JOIN fc USING (cell_id)"""


def merged_status(spark, sf):
    """Status of the logs up to 1997 with those behind merged in."""
    lines = _log_lines(spark, sf)
    late = F.col("line_no") >= 10_227 * 1_000_000  # 1998-01-01
    cells = F.col("line_no") == 0
    out = lg.merge_status(lg.roll_up(lines.where(cells | ~late)), lg.roll_up(lines.where(cells | late)))
    text = F.array_join(F.transform("dllog_gaps", lambda g: F.concat_ws(":", g["start"], g["end"])), ",")
    return out.select("cell_id", "dllog_start", "dllog_end", "dltime", "archivable", F.size("dllog_errors").alias("n_errors"), F.size("dl_fix_now").alias("n_fix"), text.alias("gaps"))


MERGED_SQL = f"""WITH {_LOG}, x AS (SELECT DISTINCT cell_id, d AS a, e AS b, d >= DATE '1998-01-01' AS late FROM o WHERE o_orderkey % 9 = 0), c AS (SELECT cell_id, min(d) AS lo, max(e) AS hi FROM o WHERE d >= DATE '1998-01-01' GROUP BY 1),
 k AS (SELECT DISTINCT x.cell_id, a, b FROM x LEFT JOIN c USING (cell_id) WHERE late OR a < coalesce(lo, DATE '9999-12-31') OR b > coalesce(hi, DATE '0001-01-01')), n AS (SELECT cell_id, CAST(count(*) AS INT) AS n FROM k GROUP BY 1),
 p AS (SELECT cell_id, min(d) AS dllog_start, max(e) AS dllog_end, CAST(coalesce(sum(o_orderkey % 90) FILTER (WHERE o_orderkey % 4 = 0), 0) AS INT) AS dltime, count(*) FILTER (WHERE d >= DATE '1998-01-01') AS late FROM o GROUP BY 1),
 w AS (SELECT cell_id, d, max(e) OVER (PARTITION BY cell_id ORDER BY d, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM o),
 g AS (SELECT DISTINCT cell_id, reached AS a, d AS b FROM w WHERE d > reached AND NOT (month(reached) = 12 AND day(reached) = 31 AND d = reached + 1)),
 gt AS (SELECT cell_id, string_agg(concat(a, ':', b), ',' ORDER BY a, b) AS gaps FROM g GROUP BY 1), f AS (SELECT cell_id, CAST(count(*) AS INT) AS n FROM (SELECT cell_id, a, b FROM k UNION SELECT cell_id, a, b FROM g) GROUP BY 1)
SELECT p.cell_id, dllog_start, dllog_end, dltime, coalesce(f.n, 0) = 0 AS archivable, coalesce(n.n, 0) AS n_errors, coalesce(f.n, 0) AS n_fix, coalesce(gaps, '') AS gaps FROM p LEFT JOIN n USING (cell_id) LEFT JOIN f USING (cell_id) LEFT JOIN gt USING (cell_id)"""

QUERIES = {
    "image_names": (image_names, NAMES_SQL), "product_ids": (product_ids, PRODUCT_SQL), "export_names": (export_names, EXPORT_SQL), "day_rollover": (day_rollover, ROLLOVER_SQL), "points_in_cells": (points_in_cells, IN_CELLS_SQL), "cells_over_zones": (cells_over_zones, OVERLAP_SQL), "zone_points": (zone_points, ZONE_POINTS_SQL),
    "zonal_shares": (_zonal, ZONAL_SQL), "district_errors": (district_errors, DISTRICT_SQL), "sampled_pixels": (sampled_pixels, SAMPLED_SQL), "nearest_pixels": (nearest_pixels, NEAREST_SQL), "point_patches": (point_patches, PATCHES_SQL), "random_points": (random_points, RANDOM_SQL), "grid_cells": (grid_cells, GRID_SQL),
    "zone_cell_areas": (zone_cell_areas, ZONE_CELLS_SQL), "catalogue_ids": (catalogue_ids, CATALOGUE_IDS_SQL), "downsampled": (downsampled, DOWN_SQL), "cropped": (cropped, CROPPED_SQL), "decimated": (decimated, DECIMATED_SQL), "mosaic": (mosaicked, MOSAIC_SQL), "histogram": (histograms, HISTOGRAM_SQL), "stretched": (stretched, STRETCHED_SQL), "image_bounds": (image_bounds, BOUNDS_SQL), "class_means": (class_means, CLASS_MEANS_SQL), "external_recall": (external_recall, EXTERNAL_SQL),
    "feature_stack": (feature_stack, STACK_SQL), "missing_values": (missing_values, MISSING_SQL), "reduced_features": (reduced_features, REDUCED_SQL), "unique_files": (unique_files, UNIQUE_SQL), "first_cells": (first_cells, FIRST_SQL), "closest_images": (closest_images, CLOSEST_SQL), "missing_files": (missing_files, MISSING_FILES_SQL),
    "cells_with_file": (cells_with_file, CELLS_SQL), "catalogue_differences": (catalogue_differences, DIFFERENCES_SQL), "matched_products": (matched_products, MATCHED_SQL), "rebuilt_scenes": (rebuilt, REBUILT_SQL), "scenes_between": (scenes_between, BETWEEN_SQL), "catalogue": (catalogue, CATALOGUE_SQL), "why_missing": (why_missing, WHY_SQL),
    "images_by_year": (images_by_year, BY_YEAR_SQL), "images_by_month": (images_by_month, BY_MONTH_SQL), "cell_status": (cell_status, _status_sql()), "index_coverage": (index_coverage, COVERAGE_SQL), "shift_statistics": (shift_statistics, SHIFT_SQL), "scenes_per_year": (scenes_per_year, PER_YEAR_SQL), "grid_totals": (grid_totals, TOTALS_SQL),
    "undersized_files": (undersized, UNDERSIZED_SQL), "upserted_status": (upserted, UPSERT_SQL), "date_gaps": (date_gaps, GAPS_SQL), "log_status": (log_status, LOG_SQL), "merged_status": (merged_status, MERGED_SQL),
}
