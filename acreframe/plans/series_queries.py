"""Queries of pixel series: seasons, features, phenology, indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from acreframe.functions.indices import spectral_index
from acreframe.functions.numbers import valid
from acreframe.operators import features as fe
from acreframe.operators import phenology as ph
from acreframe.operators import seasons as se
from acreframe.operators import series as sr
from acreframe.plans.views import cte, view

KEY_SQL = 'cell_id, r AS "row", c AS "col", spec_index'
_SEASONS = {
    "yr": "((year(img_date) = 1998 AND dayofyear(img_date) >= 183) OR (year(img_date) = 1999 AND dayofyear(img_date) < 183))",
    "wet": "(((year(img_date) = 1998 AND dayofyear(img_date) >= 183) OR (year(img_date) = 1999 AND dayofyear(img_date) < 183)) AND (dayofyear(img_date) > 306 OR dayofyear(img_date) < 61))",
    "dry": "(year(img_date) = 1998 AND dayofyear(img_date) > 183 AND dayofyear(img_date) < 259)",
}
_DAY = "date_diff('day', DATE '1970-01-01', img_date)"


def _short(x: str) -> str:
    return f"CASE WHEN abs(trunc({x})) <= 32767 THEN CAST(trunc({x}) AS SMALLINT) END"


def _wrap(d: str, start: int) -> str:
    return f"CAST(CASE WHEN dayofyear({d}) >= {start} THEN dayofyear({d}) ELSE dayofyear({d}) + 365 END AS INT)"


def _feature_sql(name: str) -> str:
    kind, when = name.split("_")
    f = f"FILTER (WHERE {_SEASONS[when]})"
    high, low = f"arg_max(img_date, CAST(value AS BIGINT) * 1000000 - {_DAY}) {f}", f"arg_min(img_date, CAST(value AS BIGINT) * 1000000 + {_DAY}) {f}"
    avg = _short(f"(avg(value) {f})")
    cyclic = lambda d: _short(f"(100 * (cos(2 * pi() * dayofyear({d}) / 365) + 1))")
    return {
        "maxv": f"max(value) {f}", "minv": f"min(value) {f}", "amp": f"(max(value) {f}) - (min(value) {f})", "avg": avg, "med": _short(f"(median(value) {f})"),
        "sd": f"round(stddev_pop(value) {f}, 4)", "cv": _short(f"((stddev_pop(value) {f}) * 1000 / nullif({avg}, 0))"),
        "maxd": _wrap(f"({high})", 183), "maxdc": cyclic(f"({high})"), "mind": _wrap(f"({low})", 183), "mindc": cyclic(f"({low})"), "slp": _short(f"(regr_slope(value, {_DAY}) {f})"),
    }[kind]


FEATURES = [f"{k}_{s}" for s in ("yr", "wet", "dry") for k in fe.STATISTICS]


def seasonal_features(spark, sf):
    out = fe.seasonal_features(view(spark, sf, "pixels"), FEATURES, 1998, 7)
    return out.withColumns({f"sd_{s}": F.round(f"sd_{s}", 4) for s in _SEASONS})


SEASONAL_SQL = f"""{cte('pixels')} SELECT {KEY_SQL}, {', '.join(f'{_feature_sql(f)} AS {f}' for f in FEATURES)}
FROM pixels WHERE {_SEASONS['yr']} OR {_SEASONS['wet']} OR {_SEASONS['dry']} GROUP BY cell_id, r, c, spec_index"""


def monthly_features(spark, sf):
    return fe.seasonal_features(view(spark, sf, "pixels"), [f"{m}_20" for m in fe.MONTH_DAYS], 1998, 7)


def _month_sql(m: str) -> str:
    month = list(fe.MONTH_DAYS).index(m) + 1
    y = 1998 if month >= 7 or m == "Dec" else 1999
    return f"arg_max(value, img_date) FILTER (WHERE year(img_date) = {y} AND dayofyear(img_date) IN ({', '.join(map(str, fe.MONTH_DAYS[m]))})) AS {m}_20"


MONTHLY_SQL = f"{cte('pixels')} SELECT {KEY_SQL}, {', '.join(map(_month_sql, fe.MONTH_DAYS))} FROM pixels WHERE year(img_date) IN (1998, 1999) GROUP BY cell_id, r, c, spec_index"


def packed_features(spark, sf):
    return fe.packed_features(fe.packed(view(spark, sf, "pixels")), 1998, 7)


PACKED_SQL = f"""{cte('pixels')} SELECT {KEY_SQL}, max(value) AS maxv_yr, min(value) AS minv_yr, max(value) - min(value) AS amp_yr, CAST(trunc(avg(value)) AS SMALLINT) AS avg_yr
FROM pixels WHERE {_SEASONS['yr']} GROUP BY cell_id, r, c, spec_index"""


def _extremes_sql(rows: str, inside: str) -> str:
    """CTEs that end in e: rows with med, inside, peak and trough."""
    w = "PARTITION BY cell_id, r, c, spec_index ORDER BY img_date"
    return f"""s0 AS (SELECT *, {inside} AS inside FROM pixels WHERE {rows}),
 s1 AS (SELECT *, CAST(trunc(median(value) FILTER (WHERE inside) OVER (PARTITION BY cell_id, r, c, spec_index)) AS INT) AS med FROM s0),
 s2 AS (SELECT *, CASE WHEN inside THEN CASE WHEN value > med THEN value ELSE 1 END END AS p, CASE WHEN inside THEN CASE WHEN value < med THEN value ELSE 10000 END END AS t FROM s1),
 s3 AS (SELECT *, CASE WHEN p - coalesce(lead(p) OVER ({w}), 0) >= 0 OR p = 1 THEN p WHEN p IS NOT NULL THEN 0 END AS p1, CASE WHEN t - coalesce(lead(t) OVER ({w}), 32767) <= 0 OR t = 10000 THEN t WHEN t IS NOT NULL THEN 32767 END AS t1 FROM s2),
 s4 AS (SELECT *, CASE WHEN p1 - coalesce(lag(p1) OVER ({w}), 0) >= 0 OR p1 = 1 THEN p1 WHEN p1 IS NOT NULL THEN 0 END AS p2, CASE WHEN t1 - coalesce(lag(t1) OVER ({w}), 32767) <= 0 OR t1 = 10000 THEN t1 WHEN t1 IS NOT NULL THEN 32767 END AS t2 FROM s3),
 e AS (SELECT *, coalesce(p2 >= med + 500, false) AS peak, coalesce(t2 <= med - 500, false) AS trough FROM s4)"""


def peaks(spark, sf):
    pixels = view(spark, sf, "pixels")
    return ph.peak_table(pixels, se.season("yr", F.col("img_date"), 1998, 7))


PEAKS_SQL = f"""{cte('pixels')}, {_extremes_sql('true', _SEASONS['yr'])}
SELECT {KEY_SQL}, count(*) FILTER (WHERE peak) AS n_peak, min(img_date) FILTER (WHERE peak) AS first_peak, arg_min(value, img_date) FILTER (WHERE peak) AS first_peak_value, max(img_date) FILTER (WHERE peak) AS last_peak, arg_max(value, img_date) FILTER (WHERE peak) AS last_peak_value,
 count(*) FILTER (WHERE trough) AS n_trough, min(img_date) FILTER (WHERE trough) AS first_trough, arg_min(value, img_date) FILTER (WHERE trough) AS first_trough_value, max(img_date) FILTER (WHERE trough) AS last_trough, arg_max(value, img_date) FILTER (WHERE trough) AS last_trough_value
FROM e WHERE inside GROUP BY cell_id, r, c, spec_index"""

WET = "((year(img_date) = 1998 AND dayofyear(img_date) >= 305) OR (year(img_date) = 1999 AND dayofyear(img_date) <= 122))"
WET_PAD = "((year(img_date) = 1998 AND dayofyear(img_date) >= 285) OR (year(img_date) = 1999 AND dayofyear(img_date) < 142))"


def phenology(spark, sf):
    return ph.phenology_features(view(spark, sf, "pixels"), list(ph.MEASURES), "wet", 1998, 500, (20, 20))


PHENOLOGY_SQL = f"""{cte('pixels')}, {_extremes_sql(f'({WET_PAD} OR {WET})', WET)},
 f AS (SELECT *, coalesce(min(img_date) FILTER (WHERE peak) OVER k, max(img_date) FILTER (WHERE inside) OVER k) AS fp FROM e WINDOW k AS (PARTITION BY cell_id, r, c, spec_index)),
 g AS (SELECT cell_id, r, c, spec_index, count(*) FILTER (WHERE inside) AS n, max(med) AS med, max(value) FILTER (WHERE inside) AS maxv, min(value) FILTER (WHERE inside) AS minv, regr_slope(value, {_DAY}) FILTER (WHERE inside) AS slope,
  count(*) FILTER (WHERE peak) AS np, min(img_date) FILTER (WHERE peak) AS pd, arg_min(value, img_date) FILTER (WHERE peak) AS pv, count(*) FILTER (WHERE trough) AS nt, max(img_date) FILTER (WHERE trough) AS td, arg_max(value, img_date) FILTER (WHERE trough) AS tv,
  coalesce(max(img_date) FILTER (WHERE img_date < fp AND value < 2000), min(img_date)) AS sd, coalesce(arg_max(value, img_date) FILTER (WHERE img_date < fp AND value < 2000), arg_min(value, img_date)) AS sv,
  coalesce(min(img_date) FILTER (WHERE img_date > fp AND value < 2000), max(img_date)) AS ed, coalesce(arg_min(value, img_date) FILTER (WHERE img_date > fp AND value < 2000), arg_max(value, img_date)) AS ev
  FROM f GROUP BY cell_id, r, c, spec_index),
 h AS (SELECT *, CASE WHEN np > 0 THEN pv ELSE med END AS posv, CASE WHEN nt > 0 THEN tv ELSE med END AS tosv, CASE WHEN np > 0 THEN {_wrap('pd', 305)} ELSE 0 END AS posd, CASE WHEN nt > 0 THEN {_wrap('td', 305)} ELSE 0 END AS tosd,
  CASE WHEN np > 0 THEN {_wrap('sd', 265)} ELSE 0 END AS sosd, CASE WHEN np > 0 THEN {_wrap('ed', 305)} ELSE 0 END AS eosd FROM g WHERE n > 0),
 i AS (SELECT *, CASE WHEN nt > 0 THEN CASE WHEN np > 0 THEN posv - tosv ELSE med - tosv END ELSE posv - med END AS st FROM h)
SELECT {KEY_SQL}, maxv AS maxv_wet, minv AS minv_wet, maxv - minv AS amp_wet, med AS med_wet, {_short('slope')} AS slp_wet, np AS numrot_wet, posd AS posd_wet, posv AS posv_wet, nt AS numlow_wet, tosd AS tosd_wet, tosv AS tosv_wet,
 CASE WHEN st > 0 AND (np > 0 OR nt > 0) THEN st ELSE 0 END AS p1amp_wet, sosd AS sosd_wet, sv AS sosv_wet, eosd AS eosd_wet, ev AS eosv_wet,
 CASE WHEN np > 0 THEN CAST(trunc((posv - sv) / nullif(CAST(posd - sosd AS DOUBLE), 0)) AS SMALLINT) ELSE 0 END AS rog_wet, CASE WHEN np > 0 THEN CAST(trunc((posv - ev) / nullif(CAST(posd - eosd AS DOUBLE), 0)) AS SMALLINT) ELSE 0 END AS ros_wet,
 CASE WHEN np > 0 THEN eosd - sosd ELSE 0 END AS los_wet FROM i"""


def simple_peaks(spark, sf):
    return ph.simple_peak(view(spark, sf, "pixels"))


SIMPLE_SQL = f"{cte('pixels')} SELECT {KEY_SQL}, arg_max(img_date, CAST(value AS BIGINT) * 1000000 - {_DAY}) FILTER (WHERE value >= 3000) AS peak_date FROM pixels GROUP BY cell_id, r, c, spec_index"

_DERIVATIVE = f"""d0 AS (SELECT *, CAST({_DAY} AS DOUBLE) AS t FROM pixels WHERE year(img_date) = 1998),
 d1 AS (SELECT *, lag(value) OVER w AS v0, lead(value) OVER w AS v2, t - lag(t) OVER w AS hd, lead(t) OVER w - t AS hs FROM d0 WINDOW w AS (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date)),
 d2 AS (SELECT *, (value - v0) / hd AS lft, (v2 - value) / hs AS rgt FROM d1), d3 AS (SELECT *, coalesce((lft * hs + rgt * hd) / (hs + hd), rgt, lft) AS deriv FROM d2)"""


def derivative_peaks(spark, sf):
    return ph.derivative_peaks(view(spark, sf, "pixels").where(F.year("img_date") == 1998), 6000, 3000)


DERIVATIVE_SQL = f"""{cte('pixels')}, {_DERIVATIVE},
 d4 AS (SELECT *, lag(deriv) OVER w AS last FROM d3 WINDOW w AS (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date)),
 d5 AS (SELECT *, coalesce(deriv < 0 AND last > 0 AND value >= 6000, false) AS high, CASE WHEN (deriv < 0 AND last > 0 AND value >= 6000) OR (deriv > 0 AND last < 0 AND value <= 3000) THEN value END AS mark FROM d4),
 d6 AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(mark IGNORE NULLS) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS lvl FROM d5),
 d7 AS (SELECT *, lvl - lag(lvl) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date) AS step FROM d6),
 d8 AS (SELECT *, coalesce(high AND (abs(step) >= 3000 OR step = 0), false) AS tr FROM d7),
 d9 AS (SELECT cell_id, r, c, spec_index, count(*) FILTER (WHERE tr) AS n, min(img_date) FILTER (WHERE tr) AS fd, arg_max(img_date, CAST(value AS BIGINT) * 1000000 - {_DAY}) FILTER (WHERE value >= 3000) AS simple FROM d8 GROUP BY ALL)
SELECT {KEY_SQL}, CASE WHEN n > 0 THEN fd ELSE simple END AS peak_date, CASE WHEN n > 0 THEN n WHEN simple IS NOT NULL THEN 1 ELSE 0 END AS n_peaks FROM d9"""


def _turn(method: str, side: str):
    def query(spark, sf):
        year = view(spark, sf, "pixels").where(F.year("img_date") == 1998)
        return ph.season_turn(year, ph.simple_peak(year), method, side)

    return query


def _turn_sql(method: str, side: str) -> str:
    start = side == "start"
    head = f"""{cte('pixels')}, p AS (SELECT cell_id, r, c, spec_index, arg_max(img_date, CAST(value AS BIGINT) * 1000000 - {_DAY}) FILTER (WHERE value >= 3000) AS pk FROM pixels WHERE year(img_date) = 1998 GROUP BY ALL),
 s AS (SELECT pixels.* FROM pixels JOIN p USING (cell_id, r, c, spec_index) WHERE year(img_date) = 1998 AND img_date {'<' if start else '>'} pk)"""
    if method == "deriv":
        rows = "d AS (SELECT * FROM s)," + _DERIVATIVE.replace("FROM pixels WHERE year(img_date) = 1998", "FROM d") + f", u AS (SELECT * FROM d3 WHERE deriv {'>' if start else '<'} 0), v AS (SELECT *, abs(value - median(value) OVER (PARTITION BY cell_id, r, c, spec_index)) AS gap FROM u)"
        turn = f"arg_min(img_date, gap * 1000000 + {_DAY})"
    else:
        rows = f"v AS (SELECT *, coalesce(value {'<' if start else '>'} lag(value) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date), false) AS turns FROM s)"
        fallback = "min(img_date)" if start else "max(img_date)"
        turn = f"coalesce({'max' if start else 'min'}(img_date) FILTER (WHERE value < 2000), {fallback})" if method == "thresh" else f"coalesce(min(img_date) FILTER (WHERE turns), {fallback})"
    return f"""{head}, {rows}, t AS (SELECT cell_id, r, c, spec_index, {turn} AS turn_date FROM v GROUP BY ALL)
SELECT cell_id, r AS "row", c AS "col", spec_index, turn_date, value AS turn_value FROM t JOIN pixels USING (cell_id, r, c, spec_index) WHERE img_date = turn_date"""


def row_statistics(spark, sf):
    series = view(spark, sf, "pixels").select("img_date", F.concat_ws("_", "cell_id", "row", "col", "spec_index").alias("point_id"), "value")
    return sr.row_statistics(series).select("img_date", F.round("ALL", 4).alias("ALL"), F.round("stdv", 4).alias("stdv"))


ROW_SQL = f"""{cte('pixels')} SELECT img_date, round(avg(value), 4) AS "ALL", round(stddev_pop(value), 4) AS stdv FROM pixels GROUP BY img_date"""


def wide_series(spark, sf):
    series = view(spark, sf, "pixels").groupBy("img_date", F.col("spec_index").alias("point_id")).agg(F.max("value").cast("double").alias("value"))
    out = sr.wide_series(series, ["A", "N", "R"])
    return out.withColumns({"ALL": F.round("ALL", 4), "stdv": F.round("stdv", 4)})


WIDE_SQL = f"""{cte('pixels')}, s AS (SELECT img_date, spec_index, max(value) AS v FROM pixels GROUP BY ALL)
SELECT img_date, CAST(max(v) FILTER (WHERE spec_index = 'A') AS DOUBLE) AS "A", CAST(max(v) FILTER (WHERE spec_index = 'N') AS DOUBLE) AS "N", CAST(max(v) FILTER (WHERE spec_index = 'R') AS DOUBLE) AS "R", round(avg(v), 4) AS "ALL", round(stddev_pop(v), 4) AS stdv FROM s GROUP BY img_date"""


def long_series(spark, sf):
    series = view(spark, sf, "pixels").groupBy("img_date", F.col("spec_index").alias("point_id")).agg(F.max("value").cast("double").alias("value"))
    return sr.long_series(sr.wide_series(series, ["A", "N", "R"]).withColumnRenamed("img_date", "date")).where("value is not null")


LONG_SQL = f"{cte('pixels')} SELECT img_date, spec_index AS point_id, CAST(max(value) AS DOUBLE) AS value FROM pixels GROUP BY ALL"


def monthly_series(spark, sf):
    return se.monthly_series(view(spark, sf, "pixels"), 3).groupBy("yyyyddd").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


MONTH_SERIES_SQL = f"{cte('pixels')} SELECT strftime(img_date, '%Y%j') AS yyyyddd, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM pixels WHERE month(img_date) = 3 GROUP BY 1"


def series_window(spark, sf):
    out = view(spark, sf, "pixels").where(se.series_window(F.col("img_date"), 1997, 1999))
    return se.days_of_year(out, 1998, 100, 200).groupBy("img_date").agg(F.count("*").alias("n"), F.max("value").alias("maxv"))


WINDOW_SQL = f"""{cte('pixels')} SELECT img_date, count(*) AS n, max(value) AS maxv FROM pixels
WHERE img_date BETWEEN DATE '1997-05-30' AND DATE '1999-05-30' AND year(img_date) = 1998 AND dayofyear(img_date) BETWEEN 100 AND 200 GROUP BY 1"""


def filled(spark, sf):
    rows = view(spark, sf, "pixels").withColumn("value", valid("value", 2000, 7000))
    return sr.filled(rows, ["cell_id", "row", "col", "spec_index"])


FILLED_SQL = f"""{cte('pixels')}, p AS (SELECT cell_id, r, c, spec_index, img_date, CASE WHEN value > 2000 AND value < 7000 THEN value END AS value FROM pixels),
 q AS (SELECT *, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(value IGNORE NULLS) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM p)
SELECT {KEY_SQL}, img_date, value, filled, filled - lag(filled) OVER (PARTITION BY cell_id, r, c, spec_index ORDER BY img_date) AS step FROM q"""

_INDICES = ("evi2", "ndvi", "ndmi", "ndwi", "savi", "wi", "nbr", "gcvi", "msavi", "kndvi", "red")


def indices(spark, sf):
    raw = view(spark, sf, "raw_pixels")
    return raw.select("row", "col", *[F.round(spectral_index(i), 3).alias(i) for i in _INDICES])


def _nd(b: str) -> str:
    return f"(n - {b}) / (n + {b} + 1e-9)"


INDICES_SQL = f"""{cte('raw_pixels')}, b AS (SELECT r, c, red, CAST(CASE WHEN nir < 10000 THEN nir END AS DOUBLE) AS n, CAST(red AS DOUBLE) AS rd, CAST(green AS DOUBLE) AS g, CAST(swir1 AS DOUBLE) AS s1, CAST(swir2 AS DOUBLE) AS s2 FROM raw_pixels)
SELECT r AS "row", c AS "col", round(10000 * (2.5e0 * (n - rd) / 10000) / (n / 10000 + 1 + 2.4e0 * rd / 10000), 3) AS evi2, round(10000 * ({_nd('rd')}), 3) AS ndvi, round(10000 * ({_nd('s1')}), 3) AS ndmi, round(10000 * -({_nd('g')}), 3) AS ndwi,
 round(10000 * (1.5e0 * (n - rd)) / (n + rd + 0.5e0), 3) AS savi, round(CASE WHEN s1 + rd > 5000 THEN 1 ELSE 10000 * (1 - (s1 + rd) / 5000) END, 3) AS wi, round(10000 * ({_nd('s2')}), 3) AS nbr, round(10000 * (n / nullif(g, 0) - 1), 3) AS gcvi,
 round(10000 * ((2 * n / 10000 + 1) - sqrt((2 * n / 10000 + 1) * (2 * n / 10000 + 1) - 8 * (n - rd) / 10000)) / 2, 3) AS msavi, round(10000 * tanh(({_nd('rd')}) * ({_nd('rd')})), 3) AS kndvi, CAST(red AS INT) AS red FROM b"""


def valid_pixels(spark, sf):
    return fe.valid_counts(view(spark, sf, "raw_pixels"))


VALID_SQL = f"""{cte('raw_pixels')} SELECT cell_id, r AS "row", c AS "col", count(*) FILTER (WHERE nir < 10000) AS n_valid FROM raw_pixels GROUP BY cell_id, r, c"""


def valid_change(spark, sf):
    raw = view(spark, sf, "raw_pixels")
    return fe.valid_change(raw, raw.withColumn("nir", F.col("nir") + F.when(F.col("red") > 4000, 5000).otherwise(0)))


CHANGE_SQL = f"""{cte('raw_pixels')} SELECT image_id, CAST(trunc(100 * (count(*) FILTER (WHERE nir < 10000) / CAST(count(*) AS DOUBLE))) AS INT) AS before,
 CAST(trunc(100 * (count(*) FILTER (WHERE nir + CASE WHEN red > 4000 THEN 5000 ELSE 0 END < 10000) / CAST(count(*) AS DOUBLE))) AS INT) AS after FROM raw_pixels GROUP BY image_id"""


def window_errors(spark, sf):
    return fe.window_errors(view(spark, sf, "pixels").withColumn("value", F.when(F.col("row") % 4 == 0, 0).otherwise(F.col("value"))), "1995-01-05", "2001-10-20", 4)


ERRORS_SQL = f"""{cte('pixels')}, s AS (SELECT cell_id, spec_index, min(img_date) AS a, max(img_date) AS b FROM pixels GROUP BY ALL),
 k AS (SELECT p.cell_id, p.spec_index, floor(r / 4) AS br, floor(c / 4) AS bc, avg(CASE WHEN r % 4 = 0 THEN 0 ELSE value END) AS m FROM pixels p JOIN s ON p.cell_id = s.cell_id AND p.spec_index = s.spec_index AND img_date = b GROUP BY ALL)
SELECT DISTINCT cell_id, spec_index, 'empty block' AS error FROM k WHERE m = 0 UNION ALL SELECT cell_id, spec_index, 'starts late' FROM s WHERE a > DATE '1995-01-05' UNION ALL SELECT cell_id, spec_index, 'ends early' FROM s WHERE b < DATE '2001-10-20'"""

QUERIES = {
    "seasonal_features": (seasonal_features, SEASONAL_SQL), "monthly_features": (monthly_features, MONTHLY_SQL), "packed_features": (packed_features, PACKED_SQL), "peaks": (peaks, PEAKS_SQL), "phenology": (phenology, PHENOLOGY_SQL),
    "simple_peaks": (simple_peaks, SIMPLE_SQL), "derivative_peaks": (derivative_peaks, DERIVATIVE_SQL), "row_statistics": (row_statistics, ROW_SQL), "wide_series": (wide_series, WIDE_SQL), "long_series": (long_series, LONG_SQL),
    "monthly_series": (monthly_series, MONTH_SERIES_SQL), "series_window": (series_window, WINDOW_SQL), "filled_series": (filled, FILLED_SQL), "spectral_indices": (indices, INDICES_SQL), "valid_pixels": (valid_pixels, VALID_SQL),
    "valid_change": (valid_change, CHANGE_SQL), "window_errors": (window_errors, ERRORS_SQL),
    **{f"season_{s}_{m}": (_turn(m, s), _turn_sql(m, s)) for m in ("thresh", "step", "deriv") for s in ("start", "end")},
}
