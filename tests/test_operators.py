"""Operators against plain versions and at their edges."""

from __future__ import annotations

import datetime as dt
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from acreframe.functions import classes, names, numbers
from acreframe.functions.indices import spectral_index
from acreframe.operators import accuracy, features, inventory, logs, phenology, ranks, sample, seasons, series, spatial, stack
from acreframe.sources import tables
from acreframe.streaming.log_updates import apply_batch, current_status, file_status, watch_files, watch_logs

SCHEMA = "cell_id int, row int, col int, spec_index string, img_date date, value int"


def make_series(seed: int, n: int = 40) -> dict[int, list[tuple[dt.date, int]]]:
    """Series across a New Year: random, with plateaus, flat, rising, low, of one date."""
    rng = random.Random(seed)
    day = lambda k: dt.date(2019, 11, 1) + dt.timedelta(days=k)
    places = sorted(rng.sample(range(0, 182), n))
    out = {k: [(day(p), rng.randint(0, 9000)) for p in places] for k in range(6)}
    out |= {k: [(day(p), rng.choice([500, 2500, 2500, 6000])) for p in places] for k in range(6, 12)}
    out[12] = [(day(p), 3000) for p in places]
    out[13] = [(day(p), 100 * i) for i, p in enumerate(places)]
    out[14] = [(day(p), 100 + i % 3) for i, p in enumerate(places)]
    out[15] = [(day(3), 4000)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(1, k, 0, "evi2", d, v) for k, rows in data.items() for d, v in rows], SCHEMA)


def plain_extremes(values: list[int], difference: int = 500, steps: int = 1) -> tuple[list[bool], list[bool]]:
    med = int(statistics.median(values))
    flags = []
    for sign, mark, fill in ((1, 1, 0), (-1, 10000, 32767)):
        p = [v if sign * (v - med) > 0 else mark for v in values]
        for t in range(1, steps + 1):
            for way in (1, -1):
                at = lambda i, p=p: p[i] if 0 <= i < len(p) else fill  # noqa: B023, E731
                p = [v if sign * (v - at(i + way * t)) >= 0 or v == mark or (t > 1 and at(i + way * (t - 1)) == mark) else fill for i, v in enumerate(p)]
        flags.append([v >= med + difference for v in p] if sign == 1 else [v <= med - difference for v in p])
    return flags[0], flags[1]


def test_extremes(spark):
    data = make_series(1)
    out = phenology.extremes(frame(spark, data), F.lit(True)).orderBy("row", "img_date").collect()
    for k, rows in data.items():
        mine = [r for r in out if r.row == k]
        peaks, troughs = plain_extremes([v for _, v in rows])
        assert [r.peak for r in mine] == peaks and [r.trough for r in mine] == troughs
    out = phenology.extremes(frame(spark, data), F.lit(True), revise=True).orderBy("row", "img_date").collect()
    for k, rows in data.items():
        mine = [r for r in out if r.row == k]
        assert ([r.peak for r in mine], [r.trough for r in mine]) == plain_extremes([v for _, v in rows], steps=9)


def test_phenology(spark):
    data = make_series(2)
    got = {r.row: r for r in phenology.phenology_features(frame(spark, data), list(phenology.MEASURES), "wet", 2019, 500, (20, 20)).collect()}
    assert set(got) == set(data)
    for k, rows in data.items():
        values = [v for _, v in rows]
        med = int(statistics.median(values))
        peaks, troughs = plain_extremes(values)
        pk = next((r for r, p in zip(rows, peaks, strict=True) if p), None)
        tr = next((r for r, t in zip(reversed(rows), reversed(troughs), strict=True) if t), None)
        wrap = lambda d, s: d.timetuple().tm_yday + (0 if d.timetuple().tm_yday >= s else 365)
        g = got[k]
        assert (g.maxv_wet, g.minv_wet, g.amp_wet, g.med_wet) == (max(values), min(values), max(values) - min(values), med)
        assert (g.numrot_wet, g.posd_wet, g.posv_wet) == (sum(peaks), wrap(pk[0], 305) if pk else 0, pk[1] if pk else med)
        assert (g.numlow_wet, g.tosd_wet, g.tosv_wet) == (sum(troughs), wrap(tr[0], 305) if tr else 0, tr[1] if tr else med)
        at = pk[0] if pk else rows[-1][0]
        sos = next((r for r in reversed(rows) if r[0] < at and r[1] < 2000), rows[0])
        eos = next((r for r in rows if r[0] > at and r[1] < 2000), rows[-1])
        assert (g.sosd_wet, g.sosv_wet) == (wrap(sos[0], 265) if pk else 0, sos[1])
        assert (g.eosd_wet, g.eosv_wet, g.los_wet) == (wrap(eos[0], 305) if pk else 0, eos[1], wrap(eos[0], 305) - wrap(sos[0], 265) if pk else 0)
        assert g.p1amp_wet >= 0
    with pytest.raises(ValueError):
        phenology.phenology_features(frame(spark, data), ["height"], "wet", 2019)


def test_seasonal_features(spark):
    data = make_series(3)
    got = {r.row: r for r in features.seasonal_features(frame(spark, data), ["maxv_yr", "maxd_yr", "med_wet", "cv_yr", "Jan_20", "maxv_dry"], 2019, 11).collect()}
    for k, rows in data.items():
        top = max(v for _, v in rows)
        day = next(d for d, v in rows if v == top).timetuple().tm_yday
        assert got[k].maxv_yr == top and got[k].maxd_yr == (day if day >= 305 else day + 365) and got[k].maxv_dry is None
        assert got[k].Jan_20 == dict(rows).get(dt.date(2020, 1, 20))
    packed = {r.row: r for r in features.packed_features(features.packed(frame(spark, data)), 2019, 11).collect()}
    long = {r.row: r for r in features.seasonal_features(frame(spark, data), ["maxv_yr", "minv_yr", "amp_yr", "avg_yr"], 2019, 11).collect()}
    assert {k: (r.maxv_yr, r.minv_yr, r.amp_yr, r.avg_yr) for k, r in packed.items()} == {k: (r.maxv_yr, r.minv_yr, r.amp_yr, r.avg_yr) for k, r in long.items()}
    with pytest.raises(ValueError):
        features.seasonal_features(frame(spark, data), ["maxv_summer"], 2019, 11)


def test_season_bounds(spark):
    days = spark.sql("select explode(sequence(date'2019-01-01', date'2021-12-31', interval 1 day)) d")
    count = lambda c: days.where(c).count()
    assert [seasons.start_day(m) for m in (1, 7, 11)] == [0, 183, 305]
    assert count(seasons.season("yr", F.col("d"), 2019, 11)) == 365 - 304 + 304
    assert count(seasons.season("dry", F.col("d"), 2020, 11)) == 258 - 183
    assert count(seasons.phenology_season("wet", F.col("d"), 2019)) == 61 + 122
    assert count(seasons.phenology_season("dry", F.col("d"), 2019, (10, 5))) == 305 + 10 - (122 - 5)
    assert count(phenology.union_of_seasons(F.col("d"), 2019, (10, 5))) == 365 - 116 + 126
    with pytest.raises(ValueError):
        seasons.season("spring", F.col("d"), 2019, 1)


def test_numbers(spark):
    row = spark.range(1).select(numbers.short(F.lit(-3.9)).alias("a"), numbers.short(F.lit(70000.0)).alias("b"), numbers.ratio(F.lit(1), F.lit(0)).alias("c"), numbers.filled_short(F.lit(None).cast("double")).alias("d"), numbers.wrapped_day(F.lit(20), 183).alias("e"), numbers.cyclic_day(F.lit(365)).alias("f"), numbers.short(F.lit(float("nan"))).alias("g")).first()
    assert tuple(row) == (-3, None, None, 0, 385, 200, None)


def test_names(spark):
    f = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert f(names.image_date(F.lit("2019366.tif"))) == dt.date(2020, 1, 1)
    assert f(names.image_date(F.lit("LC08_L2SP_001002_20200229_02_T1.nc"), "raw")) == dt.date(2020, 2, 29)
    assert f(names.image_date(F.lit("nothing"), "raw")) is None
    assert f(names.other_catalogue_id(F.lit("S2A_MSIL2A_20200102T1_R1_T21HUB_x"))) == "S2A_21HUB_20200102_0_L2A"
    assert names.model_name("base4", "bal100", "LC2", [2021, 2019, 2020], 2022) == "base4_bal100_LC2_1921_RF_2022"


def test_indices(spark):
    bands = spark.createDataFrame([(300, 500, 600, 3000, 1500, 900), (300, 500, 600, 10000, 1500, 900), (0, 0, 0, 0, 0, 0)], "blue int, green int, red int, nir int, swir1 int, swir2 int")
    rows = bands.select(spectral_index("evi2").alias("evi2"), spectral_index("ndvi").alias("ndvi"), spectral_index("gcvi").alias("gcvi"), spectral_index("wi").alias("wi")).collect()
    assert abs(rows[0].evi2 - 10000 * 2.5 * 0.24 / (1.3 + 2.4 * 0.06)) < 1e-6 and abs(rows[0].gcvi - 50000) < 1e-6 and rows[0].wi == 10000 * (1 - 2100 / 5000)
    assert rows[1].evi2 is None and rows[1].ndvi is None and rows[2].ndvi == 0 and rows[2].gcvi is None
    with pytest.raises(ValueError):
        spectral_index("none")


def test_series(spark):
    rows = [(dt.date(2020, 1, d), p, None if (d + i) % 4 == 0 else float(d * i)) for d in range(1, 9) for i, p in enumerate("abc")]
    long = spark.createDataFrame(rows, "img_date date, point_id string, value double")
    wide = series.wide_series(long, ["a", "b", "c"])
    for r in wide.collect():
        own = [v for v in (r.a, r.b, r.c) if v is not None]
        assert abs(r.ALL - statistics.mean(own)) < 1e-9 and abs(r.stdv - statistics.stdev([*own, statistics.mean(own)])) < 1e-9
    back = series.long_series(wide.withColumnRenamed("img_date", "date"))
    assert sorted(map(str, back.collect())) == sorted(map(str, long.select("img_date", "point_id", "value").collect()))


def test_rings(spark):
    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 4.0), (0.0, 10.0), (0.0, 0.0)]
    zones = spark.createDataFrame([(1, ring)], "zone_id int, ring array<struct<x double, y double>>")
    rng = random.Random(8)
    points = [(i, rng.uniform(-1, 11), rng.uniform(-1, 11)) for i in range(400)]

    def inside(x, y):
        out = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                out = not out
        return out

    got = {r.id for r in spatial.pixels_in_zones(spark.createDataFrame(points, "id int, x double, y double"), zones, 5.0).collect()}
    assert got == {i for i, x, y in points if inside(x, y)}
    box = lambda *b: spark.range(1).select(spatial.clipped_area(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring]), tuple(F.lit(float(v)) for v in b)).alias("a")).first().a
    assert abs(box(-1, -1, 11, 11) - 70) < 1e-9 and abs(box(0, 0, 5, 4) - 20) < 1e-9 and box(20, 20, 30, 30) == 0
    made = spatial.random_points(zones, 5, 3).collect()
    assert len(made) == 5 and all(inside(p.x, p.y) for p in made) and made == spatial.random_points(zones, 5, 3).collect()
    thin = spark.createDataFrame([(7, [(0.0, 0.0), (1000.0, 1000.0), (1000.0, 1001.0), (0.0, 1.0), (0.0, 0.0)]), (8, [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)])], "zone_id int, ring array<struct<x double, y double>>")
    many = spatial.random_points(thin, 50, 1).collect()
    assert sorted(p.point_id for p in many) == sorted(f"7_{i}" for i in range(50)) and all(0 <= p.y - p.x <= 1 for p in many)
    pixels = spark.createDataFrame([(i, j, i * 100 + j, j * 10 + 5.0, i * 10 + 5.0) for i in range(12) for j in range(12) if (i + j) % 3], "row int, col int, value int, px double, py double")
    places = [(k, rng.uniform(-20, 140), rng.uniform(-20, 140)) for k in range(60)]
    for tolerance in (3.0, 15.0, 47.0):
        got = {r.k: r for r in spatial.nearest_pixels(spark.createDataFrame(places, "k int, x double, y double"), pixels, 10.0, tolerance, "k").collect()}
        for k, x, y in places:
            near = min((((r.px - x) ** 2 + (r.py - y) ** 2) ** 0.5, r.row, r.col) for r in pixels_of(pixels))
            assert (got[k].row, got[k].col) == (near[1:] if near[0] <= tolerance else (None, None))
    edge = spark.createDataFrame([(5.0, 5.0), (10.0, 5.0)], "x double, y double")
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)], "cell_id int, xmin double, ymin double, xmax double, ymax double")
    assert [r.cell_id for r in spatial.points_in_boxes(edge, boxes, 10.0).collect()] == [1]
    assert "NestedLoop" not in spatial.points_in_boxes(edge, boxes, 10.0)._jdf.queryExecution().toString()


_held: list = []


def pixels_of(pixels):
    if not _held:
        _held.extend(pixels.collect())
    return _held


def test_ranks(spark):
    """Medians and sums over an order where values crowd at one end."""
    rng = random.Random(4)
    rows = [("a", rng.gauss(0, 1) if i % 50 else 1e9 * i) for i in range(1001)] + [("b", float(i % 7)) for i in range(100)] + [("c", 3.0)]
    frame_ = spark.createDataFrame([*rows, ("a", None)], "g string, v double")
    assert {r.g: r.v for r in ranks.medians(frame_, "g", "v").collect()} == {g: statistics.median(v for h, v in rows if h == g) for g in "abc"}
    counts = frame_.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
    for r in ranks.sums_before(counts, "g", "v", ["n"]).where("g = 'b'").collect():
        assert r.n_before == sum(1 for g, v in rows if g == "b" and v < r.v)


def test_gaps(spark):
    d = dt.date
    rows = [(1, d(2019, 1, 1), d(2019, 12, 31)), (1, d(2020, 1, 1), d(2020, 2, 1)), (1, d(2020, 3, 1), d(2020, 4, 1)), (2, d(2020, 1, 1), d(2020, 2, 1)), (3, d(2020, 1, 1), d(2020, 6, 1)), (3, d(2020, 2, 1), d(2020, 3, 1)), (4, None, d(2020, 1, 1))]
    got = logs.date_gaps(spark.createDataFrame(rows, "cell_id int, start date, end date"), "2018-12-01", "2020-07-01").collect()
    assert {tuple(r) for r in got} == {(1, d(2020, 2, 1), d(2020, 3, 1)), (1, d(2018, 12, 1), d(2019, 1, 1)), (1, d(2020, 4, 1), d(2020, 7, 1)), (3, d(2018, 12, 1), d(2020, 1, 1)), (3, d(2020, 6, 1), d(2020, 7, 1))}


LOG = ["cell_id = 3001", "\\ Working on 2020-01-01 to 2020-02-01", "TimeoutError: x", "\\ Working on 2020-02-15 to 2020-03-01", "full process took: 30 minutes", "core used: 95"]


def test_logs(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "stacdl_1.err").write_text("\n".join(LOG))
    (folder / "stacdl_7.err").write_text("\n".join(LOG[1:5]))
    lines = tables.log_lines(spark, str(folder))
    got = {r.cell_id: r for r in logs.roll_up(lines).collect()}
    assert set(got) == {3001, 4007}
    r = got[3001]
    assert (r.dltime, r.dlcoremin, r.dllog_start, r.dllog_end) == (30, 120, dt.date(2020, 1, 1), dt.date(2020, 3, 1))
    assert [tuple(e) for e in r.dllog_errors] == [(dt.date(2020, 1, 1), dt.date(2020, 2, 1))] and [tuple(g) for g in r.dllog_gaps] == [(dt.date(2020, 2, 1), dt.date(2020, 2, 15))]
    store = str(tmp_path / "store")
    apply_batch(store, lines)
    again = [LOG[0], "\\ Working on 2020-01-01 to 2020-03-10", LOG[4]]
    (tmp_path / "new").mkdir()
    (tmp_path / "new" / "stacdl_1.err").write_text("\n".join(again))
    status = {r.cell_id: r for r in spark.read.parquet(apply_batch(store, tables.log_lines(spark, str(tmp_path / "new")))).collect()}
    assert set(status) == {3001, 4007} and status[3001].dltime == 60 and not status[3001].dllog_errors and status[3001].dllog_end == dt.date(2020, 3, 10)
    assert not status[3001].dllog_gaps and len(status[4007].dllog_gaps) == 1


def test_merged_gaps(spark):
    """A gap between the spans of two logs is one of the merged status; an ignored period is no fix; three kinds of errors count."""
    lines = lambda *periods: spark.createDataFrame([("a_1.err", 0, "cell_id = 3")] + [("a_1.err", i, x) for i, x in enumerate(periods, 1)], "file string, line_no long, line string")
    work = "\\ Working on {} to {}".format
    old = logs.roll_up(lines(work("2000-01-01", "2000-09-01"), work("2000-08-01", "2001-06-01")))
    new = logs.roll_up(lines(work("2010-01-01", "2010-03-01"), "x urllib.error.HTTPError: 1", work("2010-02-01", "2010-06-01"), "pystac_client.exceptions.APIError", work("2010-05-01", "2010-07-01"), "TimeoutError"), ignore=("2010-05-01", "2010-07-01"))
    assert new.first().dllog_gaps == [] and len(new.first().dllog_errors) == 3 and len(new.first().dl_fix_now) == 2
    both = logs.merge_status(old, new, "1999-01-01", "2010-07-01").first()
    d = dt.date
    assert [tuple(g) for g in both.dllog_gaps] == [(d(1999, 1, 1), d(2000, 1, 1)), (d(2001, 6, 1), d(2010, 1, 1))] and not both.archivable
    assert [tuple(g) for g in logs.merge_status(old, new).first().dllog_gaps] == [(d(2001, 6, 1), d(2010, 1, 1))]


def test_batches_again(spark, tmp_path):
    """A batch that comes again changes nothing; one that died leaves the table as it was."""
    frame_ = spark.createDataFrame([("a_1.err", i, x) for i, x in enumerate(LOG)], "file string, line_no long, line string")
    store = str(tmp_path / "s")
    first = apply_batch(store, frame_, batch=4)
    assert apply_batch(store, frame_, batch=4) == first and spark.read.parquet(first).first().dltime == 30
    spark.range(1).write.parquet(f"{store}/version-5")
    (tmp_path / "s" / "version-5" / "_SUCCESS").unlink()
    assert current_status(spark, store).first().dltime == 30
    assert spark.read.parquet(apply_batch(store, frame_, batch=5)).first().dltime == 60


def test_log_stream(spark, tmp_path):
    rows = [("stacdl_1.err", i, line) for i, line in enumerate(LOG)]
    spark.createDataFrame(rows, "file string, line_no long, line string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("file string, line_no long, line string").parquet(str(tmp_path / "in"))
    watch_logs(stream, str(tmp_path / "store"), str(tmp_path / "cp"), "2019-01-01").awaitTermination(120)
    status = current_status(spark, str(tmp_path / "store")).first()
    assert status.cell_id == 3001 and [tuple(g)[0] for g in status.dllog_gaps] == [dt.date(2019, 1, 1), dt.date(2020, 2, 1)]


def test_random_points_spread(spark):
    """Points of concave, turned and very thin rings lie inside, as evenly as the area; rings that are null or flat have none."""
    hook = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (3.0, 4.0), (3.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    thin = [(0.0, 0.0), (1e6, 1e6), (1e6, 1e6 + 1e-3), (0.0, 1e-3)]
    star = [(10.0, 0.0), (2.0, 1.0), (0.0, 10.0), (-2.0, 1.0), (-10.0, 0.0), (-2.0, -1.0), (0.0, -10.0), (2.0, -1.0)]
    rings = [(1, hook), (2, hook[::-1]), (3, thin), (4, None), (5, [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]), (6, star), (7, [])]
    got = spatial.random_points(spark.createDataFrame(rings, "zone_id int, ring array<struct<x double, y double>>"), 2000, 5).collect()
    assert {z: sum(r.zone_id == z for r in got) for z in range(1, 8)} == {1: 2000, 2: 2000, 3: 2000, 4: 0, 5: 0, 6: 2000, 7: 0}
    for z in (1, 2):
        own = [r for r in got if r.zone_id == z]
        assert all(0 <= r.x <= 4 and 0 <= r.y <= 4 and not (1 < r.x < 3 and r.y > 1) for r in own)
        assert abs(sum(r.x < 1 for r in own) / 2000 - 0.4) < 0.04 and abs(sum(r.y > 1 for r in own) / 2000 - 0.6) < 0.04
    assert all(-1e-6 < r.y - r.x < 1.1e-3 for r in got if r.zone_id == 3)
    assert abs(sum(r.x > 0 for r in got if r.zone_id == 6) / 2000 - 0.5) < 0.04
    for ring in (hook, hook[::-1], star):
        area = lambda p: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1], strict=True))) / 2
        assert abs(sum(area([t[:2], t[2:4], t[4:]]) for t in spatial.triangles(ring)) - area(ring)) < 1e-9


def test_cover_spares_ring_tests(spark):
    """Inside tiles need no ring test: a large ring's tests are those of the tiles along its outline."""
    ring = [(0.0, 0.0), (1000.0, 0.0), (1000.0, 600.0), (500.0, 1000.0), (0.0, 600.0), (0.0, 0.0)]
    zones = spark.createDataFrame([(1, ring)], "zone_id int, ring array<struct<x double, y double>>")
    tiles = spatial.cover(zones, 100.0, 3).collect()
    assert {t["__inside"] for t in tiles} == {True, False} and all((t.ring is None) == t["__inside"] for t in tiles)
    area = lambda t: (100.0 / 2 ** t["__level"]) ** 2
    assert sum(area(t) for t in tiles if not t["__inside"]) < 0.2 * 800_000 and sum(area(t) for t in tiles if t["__inside"]) > 0.85 * 800_000
    rng = random.Random(2)
    points = [(i, rng.uniform(-50, 1050), rng.uniform(-50, 1050)) for i in range(2000)]
    frame_ = spark.createDataFrame(points, "id int, x double, y double")
    plain = {r.id for r in frame_.crossJoin(zones).where(spatial.in_ring(F.col("x"), F.col("y"), F.col("ring"))).collect()}
    for tile, levels in ((100.0, 3), (37.0, 1), (2000.0, 4)):
        assert {r.id for r in spatial.pixels_in_zones(frame_, zones, tile, levels).collect()} == plain


def test_overlap_areas(spark):
    """Concave polygons, turned ones, with holes and of several parts, against pixels."""
    hook = [(0, 0), (8, 0), (8, 8), (6, 8), (6, 2), (2, 2), (2, 8), (0, 8)]
    frame_ring, hole = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (3, 7), (7, 7), (7, 3)]
    wedge = [(1, -1), (9, 5), (1, 9), (4, 5)]
    polygons = {1: [[hook]], 2: [[frame_ring, hole]], 3: [[wedge]], 4: [[[(20, 20), (22, 20), (22, 22)]], [hook[::-1]]], 5: [[[(4, 4), (6, 4), (6, 6), (4, 6)]]]}
    rows = [(k, [[(float(x), float(y)) for x, y in ring] for ring in part]) for k, parts in polygons.items() for part in parts]
    frame_ = spark.createDataFrame(rows, "zone_id int, rings array<array<struct<x double, y double>>>")

    def inside(x: float, y: float, ring: list) -> bool:
        return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1

    holds = lambda k, x, y: any(sum(inside(x, y, r) for r in part) % 2 for part in polygons[k])
    step = 0.1
    grid = [(x * step + 0.05, y * step + 0.05) for x in range(-20, 230) for y in range(-20, 230)]
    held = {k: {p for p in grid if holds(k, *p)} for k in polygons}
    got = {(r.zone_id, r.zone_id_b): r.area for r in spatial.overlap_areas(frame_, frame_, 5.0).collect()}
    assert set(got) == {(a, b) for a in held for b in held if held[a] & held[b]} and (2, 5) not in got
    assert all(abs(got[a, b] - len(held[a] & held[b]) * step * step) < 0.7 for a, b in got)
    assert abs(got[1, 1] - 40) < 1e-9 and abs(got[2, 2] - 84) < 1e-9 and abs(got[1, 2] - 36) < 1e-9 and abs(got[4, 4] - 42) < 1e-9


def test_pixels_laid_out(spark, tmp_path):
    """Features of a table in its layout read it without an exchange, and a list of cells prunes its partitions at run time."""
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=10 * k) for k in range(12)]
    rows = [(c, r, k, i, d, 100 * r + d.day) for c in range(3) for r in range(4) for k in range(4) for i in ("evi2", "kndvi") for d in days]
    pixels = spark.createDataFrame(rows, SCHEMA)
    laid = tables.write_pixels(pixels, "acreframe_laid", str(tmp_path / "laid"), 4)
    try:
        cells = tables.as_cells([1, 2], spark)
        series_ = tables.index_series(laid, cells, "evi2", 2020, 1)
        found = features.seasonal_features(series_, ["maxv_yr", "avg_yr"], 2020, 1)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = plan[: plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan
        assert "dynamicpruning" in plan and "Exchange hashpartitioning" not in scan, plan
        want = features.seasonal_features(tables.index_series(pixels, cells, "evi2", 2020, 1), ["maxv_yr", "avg_yr"], 2020, 1)
        assert sorted(map(tuple, found.select(want.columns).collect())) == sorted(map(tuple, want.collect())) and want.count() == 32
    finally:
        spark.sql("drop table acreframe_laid")


def test_sweep_goes_on(spark, tmp_path):
    """Runs side by side give the same table as one by one, and those that are logged aren't run again."""
    from acreframe.operators import model

    frames = {k: spark.range(n) for k, n in (("a", 3), ("b", 5))}
    ran = []

    def score(frame_, seed):
        ran.append(seed)
        if len(ran) == 5 and len(frames) == 2 and not (tmp_path / "again").exists():
            (tmp_path / "again").mkdir()
            raise RuntimeError("broken")
        return {"n": float(frame_.count() + seed)}

    with pytest.raises(RuntimeError):
        model.sweep(frames, score, 3, spark, 1, str(tmp_path / "log"))
    table = model.sweep(frames, score, 3, spark, 3, str(tmp_path / "log"))
    assert len(ran) == 7
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, model.sweep(frames, score, 3, spark, 1).collect())) and table.count() == 6


def test_out_of_bag(spark):
    """The out-of-bag score is near that of rows held out, and the same for any partitioning; weights are those of Poisson(1)."""
    from acreframe.operators import bagging

    rng = random.Random(10)
    rows = [(i, "ab"[i % 2], (i % 2) * 60 + rng.randint(0, 70), rng.randint(0, 9), rng.randint(0, 9)) for i in range(900)]
    points = spark.createDataFrame(rows, "OID_ long, cls string, var_x int, var_y int, var_z int")
    train, rest = points.where("OID_ % 3 > 0"), points.where("OID_ % 3 = 0")
    forest = bagging.fit_bagged(train, "cls", trees=15, depth=4, seed=3, at_once=3)
    score = bagging.out_of_bag_score(train, forest, "cls")
    held = bagging.classify_bagged(rest, forest).agg(F.avg((F.col("pred") == F.col("cls")).cast("double"))).first()[0]
    assert score > 0.85 and abs(score - held) < 0.04
    voted = {r.OID_: (r.pred, r.voters) for r in bagging.out_of_bag(train, forest).collect()}
    assert voted == {r.OID_: (r.pred, r.voters) for r in bagging.out_of_bag(train.repartition(7, "var_y"), forest).collect()}
    assert 3 < sum(v for _, v in voted.values()) / len(voted) < 8
    drawn = spark.range(20_000).select(bagging.bag_weight(F.col("id"), F.lit(1), 3).alias("w")).groupBy("w").count().collect()
    share = {r.w: r["count"] / 20_000 for r in drawn}
    assert abs(share[0] - 0.3679) < 0.02 and abs(share[2] - 0.1839) < 0.02 and abs(sum(w * p for w, p in share.items()) - 1) < 0.03


def test_votes_once(spark):
    """A filter on what the votes say has no tree predict a row more than once; labels without votes stay null."""
    from acreframe.operators import bagging

    points = spark.createDataFrame([(i, "abc"[i % 3], i % 3 * 5 + i % 4, i % 7) for i in range(60)], "OID_ long, cls string, var_x int, var_y int")
    forest = bagging.fit_bagged(points, "cls", trees=3, depth=2, seed=3)
    for scored in (bagging.out_of_bag(points, forest), bagging.classify_bagged(points, forest)):
        plan = scored.where("pred is not null")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("UDF(") == 1 + len(forest.trees), plan
    rows = bagging.out_of_bag(points, forest).collect()
    assert len(rows) == 60 and {r.voters == 0 for r in rows if r.pred is None} == {True} and all(r.voters for r in rows if r.pred)


def test_ranks_without_hot_groups(spark):
    """Rank sums, medians and stratified shares neither meet by group nor by a product."""
    rows = spark.range(300).select(F.col("id"), (F.col("id") % 2).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("v"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame_ in (ranks.medians(rows, "g", "v"), accuracy.roc_auc(rows, "v", "y"), sample.stratified(rows, "g", 0.1, "id")):
            plan = frame_._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and not re.search(r"SortMergeJoin \[(g|__g)#\d+L?\], ", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.g: r.v for r in ranks.medians(rows, "g", "v").collect()} == {k: statistics.median([i * 7 % 101 for i in range(300) if i % 2 == k]) for k in (0, 1)}


def test_products_by_tile(spark):
    """A tile that stands in a product's date isn't the product's tile."""
    scenes = spark.createDataFrame([(1, "le07", "000012", "20000120"), (2, "le07", "000238", "20000120")], "scene_id int, sensor string, tile string, date string")
    products = spark.createDataFrame([("LE07_000238_20000120_L3A", "20000120")], "product string, date string")
    assert {r.scene_id: r["product"] for r in inventory.match_products(scenes, products).collect()} == {1: None, 2: "LE07_000238_20000120_L3A"}


def test_log_state(spark, tmp_path):
    """Lines of many logs, dealt to micro-batches anyhow and some twice, give the roll-up of all; a restart adds nothing."""
    rng = random.Random(6)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 700))
    rows = []
    for f in range(18):
        file = f"stacdl_{f + 90}.err"
        for no in range(rng.randint(5, 30)):
            line = rng.choice([f"cell_id = {f % 5}", f"\\ Working on {day()} to {day()}", f"Working on {day()} to {day()}", "x TimeoutError", "nothing", f"full process took: {rng.randint(1, 9)} minutes", f"core used: {rng.randint(1, 120)}", "urllib.error.HTTPError"])
            rows.append((file, no, line if f % 7 else line.replace("cell_id", "id")))
    schema = "file string, line_no long, line string"
    whole = logs.roll_up(spark.createDataFrame(rows, schema), "2019-01-01", "2022-06-01")
    plain = lambda frame: sorted(((r.cell_id, r.dllog_start, r.dllog_end, r.dllog_ranges, r.n_ranges, r.dllog_errors, r.dltime, r.dlcoremin, r.dllog_gaps, r.dl_fix_now) for r in frame.collect()), key=str)
    rng.shuffle(rows)
    for k in range(3):
        spark.createDataFrame(rows[k::3] + rows[:5], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        watch_files(stream, str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination(120)
    want = plain(whole)
    assert len(want) > 4 and plain(file_status(spark, str(tmp_path / "store"), "2019-01-01", "2022-06-01")) == want
    watch_files(stream, str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination(120)
    assert plain(file_status(spark, str(tmp_path / "store"), "2019-01-01", "2022-06-01")) == want


def test_models_and_stacks(spark):
    with pytest.raises(ValueError):
        tables.read_registry('{"m": {"singleton_vars": "forest"}}')
    with pytest.raises(ValueError):
        tables.read_registry('{"m": {} "n": {}}')
    models = tables.read_registry('{"m": {"spec_indices": ["evi2"], "si_vars": ["maxv_yr", "amp_yr"], "poly_vars": ["area"]}}')
    assert models["m"].band_names == ["evi2_maxv_yr", "evi2_amp_yr", "poly_area"]
    assert tables.read_registry(tables.write_registry(models)) == models
    frame_ = spark.createDataFrame([(1, 1, 1, 5, 6, 7)], "cell_id int, row int, col int, evi2_maxv_yr int, evi2_amp_yr int, area int")
    assert stack.select_bands(frame_, models["m"].band_names).columns[3:] == models["m"].band_names
    with pytest.raises(ValueError):
        stack.select_bands(frame_, ["sing_none"])
    clash = spark.createDataFrame([(1, 2, 3, 4)], "a_x int, a_y int, var_1 int, b int")
    assert stack.without_features(clash).columns == ["a", "b"]


def test_sources(spark, tmp_path):
    assert [r.cell_id for r in tables.as_cells("[3, 4]", spark).collect()] == [3, 4] and tables.as_cells(7, spark).count() == 1
    (tmp_path / "cells.csv").write_text("5\n6\n")
    assert [r.cell_id for r in tables.as_cells(str(tmp_path / "cells.csv"), spark).collect()] == [5, 6]
    (tmp_path / "lut.csv").write_text('LC_UNQ,USE_NAME,Description\n1,Corn,"maize, all"\n2,Soy,x\n,,rest\n')
    assert tables.read_lut(spark, str(tmp_path / "lut.csv")).count() == 2
    (tmp_path / "s.csv").write_text("date,1,2,ALL\n2020-01-02,NaN,4,4\n2020-01-01,1,2,1.5\n")
    rows = tables.read_series(spark, str(tmp_path / "s.csv")).collect()
    assert [r["1"] for r in rows] == [1.0, None]
    products = tables.map_products(spark, '{"p": {"loc": "x", "classes": {"mono": [1, 2], "tree": [3]}}}')
    from acreframe.operators.maps import product_classes

    assert {tuple(r) for r in product_classes(products).collect()} == {("p", "mono", 1), ("p", "mono", 2), ("p", "tree", 3)}
    tables.append_metrics(products.select("product"), str(tmp_path / "m"))
    tables.append_metrics(products.select("product"), str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).count() == 2
    files = tables.list_files(spark, str(tmp_path), "*.csv")
    assert {r.file for r in files.where("file in ('lut.csv', 's.csv')").collect()} == {"lut.csv", "s.csv"}
    assert tables.listing(spark.createDataFrame([("a.nc",), ("a_angles.nc",)], "file string"), ".nc").count() == 1


def test_balance_keeps_shares(spark):
    lut = spark.createDataFrame([(1, "a", 0.6), (2, "b", 0.3), (3, "Crops-mix", 0.1), (4, "a", 0.5)], "LC_UNQ int, LC25_name string, perLC25E double")
    points = spark.createDataFrame([(i, "a" if i < 1000 else "b" if i < 1800 else "Crops-mix" if i < 1900 else "none", (i * 37 % 1000) / 1000) for i in range(1950)], "id int, LC25_name string, rand double")
    ratios = {r.LC25_name: r.ratio for r in sample.balance_ratios(points, lut, 100, 2).collect()}
    assert ratios["a"] == 1 and abs(ratios["b"] - 0.5 * 1000 / 800) < 1e-9 and ratios["Crops-mix"] == 2
    kept = {r.LC25_name: r.n for r in sample.balance(points, lut, 100, 2).groupBy("LC25_name").agg(F.count("*").alias("n")).collect()}
    assert kept["a"] == 1000 and kept["none"] == 50 and kept["Crops-mix"] == 100


def test_accuracy_edges(spark):
    scores = spark.createDataFrame([("a", "a")] * 8 + [("a", "b")] * 2 + [("b", "b")] * 4 + [("c", "a"), (None, "a")], "pred string, obs string")
    matrix = accuracy.confusion(scores)
    assert matrix.where("pred = 'All' and obs = 'All'").first().n == 15
    got = {r["class"]: r for r in accuracy.accuracies(matrix).collect()}
    assert (got["a"].UA, got["a"].PA, got["c"].UA, got["c"].PA) == (0.8, 0.889, 0.0, None) and got["All"].OA == 0.8
    with pytest.raises(ValueError):
        classes.class_column("crop_nocrop_mixcrop", scores)


def test_upsert_keeps_old(spark):
    old = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "cell_id int, a int, b string")
    new = spark.createDataFrame([(2, 21, True), (3, None, False)], "cell_id int, a int, c boolean")
    assert {tuple(r) for r in inventory.upsert(old, new).collect()} == {(1, 10, "x", None), (2, 21, "y", True), (3, None, None, False)}


def test_forest(spark, tmp_path):
    from acreframe.operators import model

    rng = random.Random(9)
    rows = [(i, 1, i // 20, i % 20, "ab"[i % 2], (i % 2) * 100 + rng.randint(0, 60), rng.randint(0, 9), "bigCrop" if i % 3 else "noCrop") for i in range(400)]
    points = spark.createDataFrame(rows, "OID_ long, cell_id int, row int, col int, cls string, var_x int, var_y int, ho_type string")
    fitted, scored, accuracy_ = model.train_and_score(points.where("OID_ % 4 > 0"), points.where("OID_ % 4 = 0"), "cls", trees=10, depth=3, seed=1)
    assert accuracy_["inner"] > 0.9 and accuracy_["holdout"] > 0.9 and scored.count() == 100
    assert model.importances(fitted)[0][0] == "var_x" and model.permutation_importances(fitted, points.limit(100), "cls", "OID_", 2)[0][0] == "var_x"
    made = model.classification_job(points, lambda: (fitted, 1.0), str(tmp_path / "model"), str(tmp_path / "map"))
    again = model.classification_job(points, lambda: 1 / 0, str(tmp_path / "model"), str(tmp_path / "map2"))
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, again.collect())) and made.count() == 400
    curve = model.auc(points.select("cls", F.col("var_x").alias("score")), "cls", "b")
    exact = accuracy.roc_auc(points.select((F.col("cls") == "b").cast("int").alias("y"), F.col("var_x").alias("score")), "score", "y").first().auc
    assert abs(curve["areaUnderROC"] - exact) < 1e-6
    flat = model.permutation_importances(fitted, points.limit(100), "cls", "OID_", 2, bucket=20)
    assert flat[0][0] == "var_x" and {f for f, *_ in flat} == {"var_x", "var_y"} and len(model.importances(fitted, 1)) == 1
    assert abs(curve["areaUnderPR"] - accuracy.roc_auc(points.select((F.col("cls") == "b").cast("int").alias("y"), F.col("var_x").alias("score")), "score", "y").first().pr_auc) < 1e-3
    table = model.sweep({"all": points}, lambda f, seed: {"n": float(f.count() + seed)}, 2, spark)
    assert sorted(r.n for r in table.collect()) == [401.0, 424.0]


def test_model_runs(spark, tmp_path):
    """The whole chain, a learning curve and a grid of samples, from classes of a lookup table on."""
    from acreframe.operators import model

    lut = spark.createDataFrame([(1, "Corn", 11, "Corn", 30, "crop", 0.5), (2, "Trees", 12, "Trees", 98, "nocrop", 0.3), (3, "Mix", 13, "Crops-mix", 30, "crop", 0.2)], "LC_UNQ int, USE_NAME string, LC25 int, LC25_name string, LC2 int, LC2_name string, perLC25E double")
    rng = random.Random(3)
    rows = [(i, ["Corn", "Trees", "Mix"][i % 3], rng.random(), (0 if i % 3 == 1 else 100) + rng.randint(0, 60), rng.randint(0, 9), [30, 98, 30][i % 3], ["bigCrop", "noCrop", "smallCrop"][i % 3], 2021 + i % 2, int(i % 5 == 0), ["Corn", "Trees", "Crops-mix"][i % 3]) for i in range(600)]
    points = spark.createDataFrame(rows, "OID_ long, Class string, rand double, var_x int, var_y int, LC2 int, ho_type string, year int, TESTSET20 int, LC25_name string")
    free = points.drop("LC2", "ho_type", "year")
    path = str(tmp_path / "rf")
    options = {"trees": 5, "depth": 3}
    fitted, scores = model.model_run(free, lut, "base", "bal10mix1", "cropNoCrop", [2021, 2022], percent=20, fixed=points, path=path, **options)
    assert scores["model"] == "base_bal10mix1_LC2_2122_RF" and scores["holdout"] > 0.9 and scores["recall_noCrop"] > 0.9 and scores["OA_cnc"] > 0.9 and scores["Kappa_cnc"] > 0.8
    assert {"recall_smallCrop_2021", "recall_bigCrop_2022"} <= scores.keys()
    _, again = model.model_run(free, lut, "base", "bal10mix1", "cropNoCrop", [2021, 2022], percent=20, fixed=points, path=path, trees=-1)
    assert again == scores
    curve = model.learning_curve(free, points, lut, "base", "bal10", "cropNoCrop", [2021], runs=2, stop=40, step=20, **options).collect()
    assert [r.n for r in curve] == [0, 1] and curve[0].n_small == 0 < curve[1].n_small and all(len(r.OA_cnc) == 2 and abs(r.avgOA_cnc - sum(r.OA_cnc) / 2) < 6e-4 for r in curve)
    grid = model.sample_grid(free, points, lut, "base", "cropNoCrop", [2021], [50], [1, 2], runs=1, **options).collect()
    assert {r.S for r in grid} == {"bal50mix1", "bal50mix2"} and all(r.OA_cnc > 0.8 for r in grid)
    sampled = sample.sweep_sample(points.withColumn("SampMethod", F.lit("sat")).drop("LC25_name"), lut, 10, "Corn", "sat", 50, drop=("year",))
    assert "year" not in sampled.columns and sampled.where("Class = 'Corn'").count() < 120
    stack_ = spark.createDataFrame([(1, 1, 1, 5, 7)], "cell_id int, row int, col int, evi2_maxv_yr int, sing_h int")
    with_poly = stack.FeatureModel(spec_indices=["evi2"], si_vars=["maxv_yr"], singleton_vars=["h"], poly_vars=["area"])
    assert model.model_stack({"base4Poly6": stack_}, with_poly, "base4NoPoly")[1] == ["evi2_maxv_yr", "sing_h"]
    held, bands = model.model_stack({"m": stack_.withColumn("area", F.lit(3))}, with_poly, "m")
    assert stack.select_bands(held, bands).first()[3:] == (5, 7, 3)
    with pytest.raises(ValueError):
        model.model_stack({}, with_poly, "other")
    frame_ = spark.createDataFrame([(1, 2, 3, 4)], "OID_ int, var_evi2_maxv_yr int, var_evi2_amp int, var_poly_area int")
    kept, models = stack.reduced_model(frame_, {"m": with_poly}, "m", "small", variables=("amp",))
    assert models["small"].band_names == ["evi2_maxv_yr", "poly_area"] and kept.columns == ["OID_", "var_evi2_maxv_yr", "var_poly_area"]


def test_more_sources(spark, tmp_path):
    d = tmp_path / "ts"
    d.mkdir()
    (d / "012021_NoDLs_AOI1_N.csv").write_text("imDay,1,2\n2021003,4,NaN\n2021009,1,2\n")
    (d / "022021_NoDLs_AOI1_N.csv").write_text("imDay,1,3\n2021040,5,7\n")
    (d / "032021_NoDLs_AOI1_N.csv").write_text("imDay,1\n2021070,5\n")
    (d / "012021_NoDLs_AOI2_N.csv").write_text("imDay,9\n2021005,5\n")
    got = {str(r.date): r for r in tables.monthly_files(spark, str(d), "NoDLs", "AOI1", 2021, (1, 2), "N").collect()}
    assert set(got) == {"2021-01-03", "2021-01-09", "2021-02-09"} and got["2021-02-09"].ALL == 6 and got["2021-02-09"].stdv == statistics.stdev([5, 7, 6]) and got["2021-01-03"]["2"] is None
    assert tables.monthly_files(spark, str(d), "NoDLs", "All", 2021, (1, 1), "N").count() == 3
    lut = spark.createDataFrame([(22, 30), (23, 30), (60, 98)], "LC_UNQ int, LC2 int")
    h = tmp_path / "ho"
    h.mkdir()
    (h / "GENERAL_HOLDOUT_noCrop_2021.csv").write_text("OID_,LC_UNQ\n1,60\n")
    (h / "base_HOLDOUT_bigCrop_2021.csv").write_text("OID_,LC_UNQ\n2,22\n")
    values = spark.createDataFrame([(1, 5), (2, 6)], "OID_ int, var_x int")
    assert {(r.OID_, r.ho_type, r.LC2, r.var_x) for r in tables.fixed_holdout(spark, str(h), "base", "2021", lut, values).collect()} == {(1, "noCrop", 98, 5), (2, "bigCrop", 30, 6)}
    (h / "base_x_all_2021.csv").write_text("OID_,LC_UNQ,LC2\n1,60,98\n2,22,30\n3,23,30\n4,19,98\n")
    assert {(r.OID_, r.ho_type) for r in tables.fixed_holdout(spark, str(h), "base", "2021", lut).collect()} == {(1, "noCrop"), (2, "bigCrop"), (3, "smallCrop")}
    tables.write_csv(lut.orderBy("LC_UNQ"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3
    (tmp_path / "p.csv").write_text("OID_,PID\n1,a\n")
    tables.write_stack(spark.createDataFrame([(1, 1, 1, 5, 6)], "cell_id int, row int, col int, b int, a int"), str(tmp_path / "st"), ["a", "b"])
    assert spark.read.parquet(str(tmp_path / "st")).columns == ["cell_id", "row", "col", "a", "b"]


def test_whole_slopes_and_deviations(spark):
    """Slopes and shares that are whole numbers aren't cut to the next one, in whatever order rows come."""
    rng, rows, want = random.Random(5), [], {}
    for i in range(300):
        slope, days = rng.choice((-1, 1)) * rng.randint(1, 60), sorted(rng.sample(range(310, 365), rng.randint(3, 9)))
        rows += [(0, i, 0, "evi2", dt.date(1998, 1, 1) + dt.timedelta(days=d - 1), 4000 + slope * (d - 337)) for d in days]
        own = [4000 + slope * (d - 337) for d in days]
        spread = len(own) * sum(v * v for v in own) - sum(own) ** 2
        mean = sum(own) // len(own)
        want[i] = (slope, math.isqrt(spread * 1000000 // (len(own) * mean) ** 2))
    rng.shuffle(rows)
    pixels = spark.createDataFrame(rows, "cell_id int, row int, col int, spec_index string, img_date date, value int").repartition(7)
    got = {r.row: (r.slp_wet, r.cv_wet) for r in features.seasonal_features(pixels, ["slp_wet", "cv_wet"], 1998, 7).collect()}
    assert got == want
    assert {r.row: r.slp_wet for r in phenology.phenology_features(pixels, ["slp"], "wet", 1998).collect()} == {i: w[0] for i, w in want.items()}
    ones = pixels.where("row < 3").groupBy("cell_id", "row", "col", "spec_index").agg(F.min("img_date").alias("img_date"), F.max("value").alias("value"))
    assert all(r.slp_wet is None for r in features.seasonal_features(ones, ["slp_wet"], 1998, 7).collect())


def test_nearest_pixels_without_exchange_of_points(spark):
    """Points aren't grouped by their key: each row gets its own pixel, repeated keys and pixels included, and no task sorts points."""
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 100.0, 100.0), (None, 0.0, 1.0), (3, None, 0.0), (4, 5000.0, 0.0)], "k int, x double, y double")
    pixels = spark.createDataFrame([(0, 0, 2.0, 0.0, 7), (0, 0, 2.0, 0.0, 5), (10, 10, 101.0, 101.0, 9)], "row int, col int, px double, py double, value int")
    out = spatial.nearest_pixels(points, pixels, 10.0, 20.0, "k")
    assert sorted((r.k, r.x, r.value) for r in out.where("k = 1").collect()) == [(1, 0.0, 5), (1, 100.0, 9)]
    assert sorted((r.k or 0, r.value) for r in out.where("k is null or k > 1").collect() if r.k or r.value) == [(0, 5), (3, None), (4, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" not in plan
