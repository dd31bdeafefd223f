"""Points, boxes, rings and pixels on one projected plane: joins by computed keys, never by nested loops."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def project_grid(bounds: tuple[float, float, float, float], size: float, spark) -> DataFrame:
    """Cells of one size over the bounds (xmin, ymin, xmax, ymax), numbered from 1 by columns; a box reaches left of its corner and up.

    One step beyond the bounds is included on each axis.
    """
    xmin, ymin, xmax, ymax = bounds
    nx, ny = (int(-(-(b - a + size) // size)) for a, b in ((xmin, xmax), (ymin, ymax)))
    grid = spark.range(nx * ny).select((F.col("id") + 1).cast("int").alias("cell_id"), F.floor(F.col("id") / ny).alias("i"), (F.col("id") % ny).alias("j"))
    x, y = F.lit(float(xmin)) + F.col("i") * size, F.lit(float(ymin)) + F.col("j") * size
    return grid.select("cell_id", (x - size).alias("xmin"), y.alias("ymin"), x.alias("xmax"), (y + size).alias("ymax"))


def _tiles(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def points_in_boxes(points: DataFrame, boxes: DataFrame, tile: float, x: str = "x", y: str = "y") -> DataFrame:
    """points with the columns of each box they lie strictly within: an equi-join on tiles of the plane, then the bounds.

    Choose tiles about as large as a box, so that a box covers few of them.
    """
    laid = boxes.withColumn("__tx", F.explode(_tiles(F.col("xmin"), F.col("xmax"), tile))).withColumn("__ty", F.explode(_tiles(F.col("ymin"), F.col("ymax"), tile)))
    keyed = points.withColumn("__tx", F.floor(F.col(x) / tile)).withColumn("__ty", F.floor(F.col(y) / tile))
    inside = (F.col(x) > F.col("xmin")) & (F.col(x) < F.col("xmax")) & (F.col(y) > F.col("ymin")) & (F.col(y) < F.col("ymax"))
    return keyed.join(laid, ["__tx", "__ty"]).where(inside).drop("__tx", "__ty")


def ring_box(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting over the edges of a closed ring; points on its upper or right edges are outside."""
    edges = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1)), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    crossed = F.filter(edges, lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"]))
    return F.size(crossed) % 2 == 1


def boxes_overlap(a: DataFrame, b: DataFrame, tile: float, suffix: str = "_b") -> DataFrame:
    """Pairs of boxes that overlap: each pair is made in the one tile that holds the lower left corner of the overlap."""
    named = b.select([F.col(c).alias(c + suffix) for c in b.columns])

    def lay(df: DataFrame, s: str) -> DataFrame:
        return df.withColumn("__tx", F.explode(_tiles(F.col("xmin" + s), F.col("xmax" + s), tile))).withColumn("__ty", F.explode(_tiles(F.col("ymin" + s), F.col("ymax" + s), tile)))

    x, y = F.greatest("xmin", "xmin" + suffix), F.greatest("ymin", "ymin" + suffix)
    meets = (x < F.least("xmax", "xmax" + suffix)) & (y < F.least("ymax", "ymax" + suffix))
    once = (F.floor(x / tile) == F.col("__tx")) & (F.floor(y / tile) == F.col("__ty"))
    return lay(a, "").join(lay(named, suffix), ["__tx", "__ty"]).where(meets & once).drop("__tx", "__ty")


def _edges(ring: Column) -> Column:
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often it's used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cut(axis: str, bound: Column, low: bool):
    """What an edge leaves of itself on the inner side of a line: where it meets the line, and its end."""
    other = "y" if axis == "x" else "x"

    def cut(e: Column) -> Column:
        a, b = e["a"], e["b"]
        a_in, b_in = (a[axis] >= bound, b[axis] >= bound) if low else (a[axis] <= bound, b[axis] <= bound)
        place = {axis: bound.cast("double"), other: a[other] + F.try_divide(bound - a[axis], b[axis] - a[axis]) * (b[other] - a[other])}
        met = F.struct(place["x"].alias("x"), place["y"].alias("y"))
        return F.when(a_in & b_in, F.array(b)).when(a_in, F.array(met)).when(b_in, F.array(met, b)).otherwise(F.slice(F.array(met), 1, 0))

    return cut


def _cutter(cut):
    return lambda r: F.flatten(F.transform(_edges(r), cut))


def clip_ring(ring: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """The ring within a box (xmin, ymin, xmax, ymax), cut by each side in turn; empty where they don't meet."""
    for axis, bound, low in (("x", box[0], True), ("x", box[2], False), ("y", box[1], True), ("y", box[3], False)):
        ring = _once(ring, _cutter(_cut(axis, bound, low)))
    return ring


def clipped_area(ring: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Area of a ring within a box, by the shoelace rule."""

    def area(r: Column) -> Column:
        crosses = F.transform(_edges(r), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
        return F.abs(F.aggregate(crosses, F.lit(0.0), lambda s, c: s + c)) / 2

    return _once(clip_ring(ring, box), area)


def pixel_key(x: Column, y: Column, size: float, x0: float = 0.0, y0: float = 0.0) -> list[Column]:
    """Row and column of the pixel that holds a point; y grows upwards, rows too."""
    return [F.floor((y - y0) / size).cast("int").alias("row"), F.floor((x - x0) / size).cast("int").alias("col")]


def sample_pixels(points: DataFrame, pixels: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """All columns of the pixel that holds each point, in one equi-join; points without a pixel keep nulls.  pixels(row, col, ...)."""
    row, column = pixel_key(F.col(x), F.col(y), size)
    return points.withColumn("row", row).withColumn("col", column).join(pixels, ["row", "col"], "left")


def nearest_pixels(points: DataFrame, pixels: DataFrame, size: float, tolerance: float, key: str) -> DataFrame:
    """The pixel whose centre (px, py) is nearest to each point (x, y), null beyond the tolerance; ties go to the lower row, then column.

    Pixels are laid, each once, as an array on tiles as large as the tolerance, on their own and the eight around it.  So a point meets one row, that
    of its own tile, and points are neither multiplied nor grouped; few tiles are broadcast.  size: of a pixel, the least a tile measures.
    """
    tile = float(max(size, tolerance))
    steps = F.sequence(F.lit(-1), F.lit(1))
    once = pixels.groupBy("px", "py", "row", "col").agg(F.min(F.struct("value"))["value"].alias("value"))
    laid = once.select("*", F.explode(steps).alias("__dr")).select("*", F.explode(steps).alias("__dc"))
    laid = laid.withColumns({"__r": F.floor(F.col("py") / tile) + F.col("__dr"), "__c": F.floor(F.col("px") / tile) + F.col("__dc")})
    near = laid.groupBy("__r", "__c").agg(F.collect_list(F.struct("px", "py", "row", "col", "value")).alias("__near"))
    met = points.withColumns({"__r": F.floor(F.col("y") / tile), "__c": F.floor(F.col("x") / tile)}).join(near, ["__r", "__c"], "left")
    off = F.transform("__near", lambda p: F.struct(F.hypot(p["px"] - F.col("x"), p["py"] - F.col("y")).alias("distance"), p["row"], p["col"], p["value"]))
    best = met.withColumn("__b", F.array_min(F.filter(off, lambda p: p["distance"] <= tolerance)))
    return best.select(*points.columns, "__b.row", "__b.col", "__b.value", "__b.distance")


def pixel_at(pixels: DataFrame, row: int, col: int) -> DataFrame:
    """Coordinates and value of the pixel at a row and column."""
    return pixels.where((F.col("row") == row) & (F.col("col") == col)).select("x", "y", "value")


def patches(points: DataFrame, pixels: DataFrame, size: float, reach: int = 1) -> DataFrame:
    """Pixels within `reach` rows and columns of each point's own, tagged with the point's columns."""
    row, column = pixel_key(F.col("x"), F.col("y"), size)
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    around = points.withColumn("__r", row).withColumn("__c", column).withColumn("__dr", F.explode(steps)).withColumn("__dc", F.explode(steps))
    return around.withColumn("row", F.col("__r") + F.col("__dr")).withColumn("col", F.col("__c") + F.col("__dc")).join(pixels, ["row", "col"]).drop("__r", "__c", "__dr", "__dc")


def _edge_meets(edges: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Whether an edge touches a box: their bounds do, and the box's corners aren't all on one side of the edge's line."""

    def meets(e: Column) -> Column:
        (ax, ay), (bx, by) = ((e[p]["x"], e[p]["y"]) for p in "ab")
        bounds = (F.least(ax, bx) <= xmax) & (F.greatest(ax, bx) >= xmin) & (F.least(ay, by) <= ymax) & (F.greatest(ay, by) >= ymin)
        sides = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (xmin, xmax) for y in (ymin, ymax)]
        return bounds & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(edges, meets)


def cover(zones: DataFrame, tile: float, levels: int = 3) -> DataFrame:
    """zones(zone_id, ring, ...), a row for each tile (__level, __tx, __ty) of a quadtree over its ring, and whether the tile lies inside.

    Tiles measure `tile` at level 0 and half as much at each further one.  Only tiles that an edge meets are divided; those of the last level that an
    edge meets are the ring's boundary and keep the ring, inside tiles don't, tiles outside are left out.
    """
    boxed = zones.withColumns(ring_box(F.col("ring")))
    at = boxed.withColumns({"__tx": F.explode(_tiles(F.col("xmin"), F.col("xmax"), tile))}).withColumn("__ty", F.explode(_tiles(F.col("ymin"), F.col("ymax"), tile)))
    out: DataFrame | None = None
    for level in range(levels):
        size = tile / (1 << level)
        x, y = F.col("__tx") * size, F.col("__ty") * size
        at = at.withColumns({"__level": F.lit(level), "__met": _edge_meets(_edges(F.col("ring")), x, y, x + size, y + size)})
        inside = at.where(~F.col("__met")).where(in_ring(x + size / 2, y + size / 2, F.col("ring"))).withColumns({"__inside": F.lit(True), "ring": F.when(F.lit(False), F.col("ring"))})
        met = at.where("__met")
        last = inside if level + 1 < levels else inside.unionByName(met.withColumn("__inside", F.lit(False)))
        out = last if out is None else out.unionByName(last)
        half = lambda c: F.explode(F.array(2 * F.col(c), 2 * F.col(c) + 1))
        at = met.withColumn("__tx", half("__tx")).withColumn("__ty", half("__ty"))
    return out.drop("__met")


def pixels_in_zones(pixels: DataFrame, zones: DataFrame, tile: float, levels: int = 3) -> DataFrame:
    """pixels(x, y, ...) with the columns of each zone(zone_id, ring, ...) that holds their centre; the ring is left out.

    An equi-join on the tiles of the zones' covers, of which only those at a boundary test the ring: a pixel has a key for each level,
    so large rings cost no more tests than their outlines are long.
    """
    place = lambda c: F.floor(F.col(c) / (F.lit(float(tile)) / F.pow(F.lit(2.0), F.col("__level"))))
    keyed = pixels.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).withColumns({"__tx": place("x"), "__ty": place("y")})
    box = (F.col("x") > F.col("xmin")) & (F.col("x") < F.col("xmax")) & (F.col("y") > F.col("ymin")) & (F.col("y") < F.col("ymax"))
    met = keyed.join(cover(zones, tile, levels), ["__level", "__tx", "__ty"])
    return met.where(F.col("__inside") | (box & in_ring(F.col("x"), F.col("y"), F.col("ring")))).drop("__level", "__tx", "__ty", "__inside", "ring", "xmin", "ymin", "xmax", "ymax")


def clip_to_box(pixels: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    return pixels.where(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))


def crop(pixels: DataFrame, x1: int, x2: int, y1: int, y2: int) -> DataFrame:
    """Rows y1 to y2 and columns x1 to x2, both included."""
    return pixels.where(F.col("row").between(y1, y2) & F.col("col").between(x1, x2))


def decimate(pixels: DataFrame, n: int) -> DataFrame:
    return pixels.where((F.col("row") % n == 0) & (F.col("col") % n == 0))


def downsample(pixels: DataFrame, k: int) -> DataFrame:
    """Means of blocks of k by k pixels (an approximation of bilinear resampling)."""
    return pixels.groupBy("cell_id", F.floor(F.col("row") / k).cast("int").alias("row"), F.floor(F.col("col") / k).cast("int").alias("col")).agg(F.avg("value").alias("value"))


def resample(pixels: DataFrame, old: float, new: float) -> DataFrame:
    """pixels(cell_id, row, col, value) of one size at another, larger one: each of int(n old / new) rows and columns is the mean of
    the pixels it covers, weighted by how much of each it covers.  Pixels that lack a value don't count."""
    if new < old:
        raise ValueError("the new size is smaller than the old")
    shape = pixels.groupBy("cell_id").agg(F.floor((F.max("row") + 1) * old / new).alias("__h"), F.floor((F.max("col") + 1) * old / new).alias("__w"))
    parts = pixels.where("value is not null")
    for axis in ("row", "col"):
        low, high = F.col(axis) * old / new, (F.col(axis) + 1) * old / new
        first, last = F.floor(low), F.greatest(F.floor(low), F.ceil(high) - 1)  # one new pixel or two
        parts = parts.withColumn(f"__{axis}", F.explode(F.sequence(first, last))).withColumn(f"__w_{axis}", F.least(high, F.col(f"__{axis}") + 1) - F.greatest(low, F.col(f"__{axis}")))
    weight = F.col("__w_row") * F.col("__w_col")
    made = parts.groupBy("cell_id", F.col("__row").cast("int").alias("row"), F.col("__col").cast("int").alias("col")).agg((F.sum(weight * F.col("value")) / F.sum(weight)).alias("value"))
    return made.join(shape, "cell_id").where("row < __h and col < __w").drop("__h", "__w")


def _uniform(seed: int, what: str) -> Column:
    """A number from 0 to 1 for zone_id and i, by the first 52 bits of an MD5."""
    name = F.concat_ws(":", F.col("zone_id").cast("string"), F.col("i").cast("string"), F.lit(f"{what}{seed}"))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / float(1 << 52)


def triangles(ring: list[tuple[float, float]]) -> list[tuple[float, ...]]:
    """The triangles (ax, ay, bx, by, cx, cy) of a simple ring, by cutting off ears, the first one in order each time."""
    points = [p for k, p in enumerate(ring) if p != ring[k - 1] or k == 0]
    points = points[:-1] if len(points) > 1 and points[0] == points[-1] else points
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1], strict=True)) < 0:
        points = points[:1] + points[:0:-1]
    out = []
    while len(points) > 2:
        corners = [(points[k - 1], points[k % len(points)], points[(k + 1) % len(points)]) for k in range(1, len(points) + 1)]
        clear = lambda a, b, c: not any(p not in (a, b, c) and min(turn(a, b, p), turn(b, c, p), turn(c, a, p)) >= 0 for p in points)
        ears = (k for k, (a, b, c) in enumerate(corners) if turn(a, b, c) > 0 and clear(a, b, c))
        k = next(ears, None)
        if k is None:  # no corner but flat ones, or a ring that crosses itself: the flattest corner goes
            k = min(range(len(corners)), key=lambda k: abs(turn(*corners[k])))
        else:
            out.append(tuple(v for p in corners[k] for v in p))
        del points[(k + 1) % len(points)]
    return out


def _triangulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for ring in batch.column(1).to_pylist():
            total, own = 0.0, []
            for ax, ay, bx, by, cx, cy in triangles([(p["x"], p["y"]) for p in ring or () if p]):
                total += abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax)) / 2
                own.append({"ax": ax, "ay": ay, "ux": bx - ax, "uy": by - ay, "vx": cx - ax, "vy": cy - ay, "upto": total})
            found.append(own)
        parts = pa.array(found, pa.list_(pa.struct([(k, pa.float64()) for k in ("ax", "ay", "ux", "uy", "vx", "vy", "upto")])))
        yield pa.RecordBatch.from_arrays([batch.column(0), parts], names=["zone_id", "parts"])


def _both(one: tuple[float, ...], two: tuple[float, ...]) -> float:
    """The area that two triangles, both turning left, have in common: the first is cut by each side of the second."""
    points = [(one[i], one[i + 1]) for i in (0, 2, 4)]
    for i in (0, 2, 4):
        ax, ay, bx, by = two[i], two[i + 1], two[(i + 2) % 6], two[(i + 3) % 6]
        side = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in points]
        kept = []
        for k, (p, s) in enumerate(zip(points, side, strict=True)):
            q, t = points[k - 1], side[k - 1]
            if (s >= 0) != (t >= 0):
                kept.append((q[0] + t / (t - s) * (p[0] - q[0]), q[1] + t / (t - s) * (p[1] - q[1])))
            if s >= 0:
                kept.append(p)
        points = kept
        if not points:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1], strict=True))) / 2


def _signed(rings: list | None) -> list[tuple[int, tuple[float, ...]]]:
    """The triangles of a polygon, its outer ring first; those of holes count against it."""
    return [(-1 if k else 1, t) for k, ring in enumerate(rings or ()) for t in triangles([(p["x"], p["y"]) for p in ring or () if p])]


def overlap_areas(a: DataFrame, b: DataFrame, tile: float, key: str = "zone_id") -> DataFrame:
    """(key, key_b, area) of polygons a and b (key, rings: the outer ring, then holes) that have an area in common; a polygon of several parts is
    as many rows of one key.

    Boxes of outer rings meet on tiles of the plane, then triangles of the one are cut by triangles of the other, so rings may be concave.
    """
    boxed = lambda df: df.select(F.col(key).alias("key"), "rings").withColumns(ring_box(F.get("rings", F.lit(0))))
    met = boxes_overlap(boxed(a), boxed(b), tile).select("key", "key_b", "rings", "rings_b")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sum(s * t * _both(x, y) for s, x in _signed(one) for t, y in _signed(two)) for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["key", "key_b", "area"])

    types = dict(met.dtypes)
    areas = met.mapInArrow(cut, f"key {types['key']}, key_b {types['key_b']}, area double")
    return areas.groupBy("key", "key_b").agg(F.sum("area").alias("area")).where("area > 1e-9").toDF(key, f"{key}_b", "area")


def random_points(zones: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n points in each zone(zone_id, ring), id <zone>_<i>, spread evenly: in a triangle of the ring, drawn by its share of the area.

    The same seed gives the same points.  Rings may be concave and as thin as they like; one without an area, or null, has no points.
    """
    schema = StructType([zones.schema["zone_id"]]).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ", 1)
    parts = zones.select("zone_id", "ring").mapInArrow(_triangulated, f"{schema}, parts array<struct<ax:double,ay:double,ux:double,uy:double,vx:double,vy:double,upto:double>>")
    total = F.try_element_at("parts", F.lit(-1))["upto"]
    drawn = parts.where(total > 0).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) if n > 0 else parts.limit(0).withColumn("i", F.lit(0))
    drawn = drawn.withColumns({"__u": _uniform(seed, "t") * total, "__a": _uniform(seed, "x"), "__b": _uniform(seed, "y")})
    # the other half of the parallelogram is turned over
    over = F.col("__a") + F.col("__b") > 1
    drawn = drawn.withColumns({"__t": F.get(F.filter("parts", lambda t: t["upto"] > F.col("__u")), F.lit(0)), "__a": F.when(over, 1 - F.col("__a")).otherwise(F.col("__a")), "__b": F.when(over, 1 - F.col("__b")).otherwise(F.col("__b"))})
    at = lambda c: F.col("__t")[f"a{c}"] + F.col("__a") * F.col("__t")[f"u{c}"] + F.col("__b") * F.col("__t")[f"v{c}"]
    return drawn.select("zone_id", F.concat_ws("_", "zone_id", "i").alias("point_id"), at("x").alias("x"), at("y").alias("y"))


def observed_between(polygons: DataFrame, oldest: int, newest: int) -> DataFrame:
    """Polygons by year of observation, from the first of FirstYrObs, ObsYr, Year and Acquired that is a column; a bound of 0 is off."""
    for name in ("FirstYrObs", "ObsYr", "Year", "Acquired"):
        if name in polygons.columns:
            year = F.substring(F.col(name).cast("string"), 1, 4).try_cast("int")
            low, high = (F.lit(True) if not oldest else year >= oldest), (F.lit(True) if not newest else year <= newest)
            return polygons.where(low & high)
    return polygons


def image_bounds(pixels: DataFrame) -> DataFrame:
    """Bounds and centre of each image(image_id, x, y)."""
    g = pixels.groupBy("image_id").agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    return g.withColumns({"cx": (F.col("xmin") + F.col("xmax")) / 2, "cy": (F.col("ymin") + F.col("ymax")) / 2})
