"""Centroid clustering with lower bounds that loosen by geometry: by less than the full drift of the centroids.

A vector keeps its cluster and a lower bound of its distance to any other centroid.  After centroids have moved, a cluster's vectors lie in a
sphere around its centroid.  How much nearer a moved centroid can have come to any point of the sphere is a matter of the plane through the
sphere's centre and the centroid's two places (see `loosened`); the bound loosens by the most of these.  Vectors that are nearer
to their own centroid than their bound keep their cluster; the others are ambiguous and are compared with all centroids, in whole numbers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import discard, table_path

#: Components beyond this bound are set to it, so that squared distances fit 63 bits; it's that of a value of 524288.
LARGEST = 1 << 27
#: Relative slack of bounds, which are floating-point numbers, against rounding.
SLACK = 1e-9

#: State of a vector (kind 0: digest to distance), and what a task's vectors of a cluster add up to (kind 1: from many on).
_STATE = pa.schema([
    ("digest", pa.binary()), ("cluster", pa.int32()), ("lower", pa.float64()), ("distance", pa.int64()),
    ("many", pa.int64()), ("sums", pa.list_(pa.int64())), ("farthest", pa.int64()), ("inertia", pa.decimal128(38, 0)), ("scanned", pa.int64()), ("kind", pa.int32()),
])
_STATE_SQL = "digest binary, cluster int, lower double, distance long, many long, sums array<long>, farthest long, inertia decimal(38, 0), scanned long, kind int"


def quantised(rows: DataFrame, dims: int, scale: int = 256) -> DataFrame:
    """(vec_id, vector) of the rows whose embedding has `dims` components, all finite: each as the integer floor(scale x), packed as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            whole = np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in whole], pa.binary())], names=["vec_id", "vector"])

    values = F.col("embedding").cast("array<double>")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("x")).where((F.size("x") == dims) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return kept.mapInArrow(run, "vec_id long, vector binary")


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The squared distances of whole vectors from whole centroids, exact: as products of matrices where 53 bits hold all sums."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (c * c).sum(1) - 2 * (a @ c.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def loosened(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the most by which a moved centroid of another cluster can have come nearer to any point of the cluster's sphere.

    A point x comes nearer by |x-c| - |x-c'| = 2 (x-m)d / (|x-c| + |x-c'|), where c moved by d to c' and m lies halfway.  The sum is 2 |x-m| at
    least, so that is |d| cos t at most, t being the angle between x-m and d.  In the plane through the sphere's centre s, c and c', the
    sphere is a disc that is seen from m under the angle asin(r / |s-m|) to either side, so t is at least the angle of s less that; with m inside the
    disc nothing is gained, and the full drift counts.  Where all the sphere lies behind, no point comes nearer.
    """
    out = np.zeros(len(old))
    for j, d in enumerate(new - old):
        drift = np.sqrt(d @ d)
        if drift == 0:
            continue
        from_middle = old - (old[j] + new[j]) / 2
        away = np.maximum(np.sqrt((from_middle * from_middle).sum(1)), 1e-300)
        angle = np.arccos(np.clip(from_middle @ d / (away * drift), -1, 1)) - np.arcsin(np.minimum(1, radius * (1 + SLACK) / away))
        nearer = np.where(away <= radius * (1 + SLACK), drift, drift * np.clip(np.cos(np.maximum(angle, 0)), 0, 1))
        nearer[j] = 0  # the bound isn't about a vector's own centroid
        out = np.maximum(out, nearer + SLACK * drift)
    return out


def _state(size: int, **columns: np.ndarray | pa.Array | list) -> pa.RecordBatch:
    """Rows of _STATE; columns that aren't given are null."""
    return pa.RecordBatch.from_arrays([pa.nulls(size, f.type) if f.name not in columns else x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in _STATE], schema=_STATE)


class _Sums:
    """What the vectors of a task add up to, by cluster."""

    def __init__(self, k: int, dims: int):
        self.many, self.scanned, self.farthest = np.zeros(k, np.int64), np.zeros(k, np.int64), np.full(k, -1, np.int64)
        self.sums, self.inertia = np.zeros((k, dims), np.int64), [0] * k

    def add(self, x: np.ndarray, n: np.ndarray, cluster: np.ndarray, distance: np.ndarray, scanned: np.ndarray) -> None:
        order = np.argsort(cluster, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(cluster[order]) > 0)))
        own = cluster[order[first]]
        self.many[own] += np.add.reduceat(n[order], first)
        self.sums[own] += np.add.reduceat((x * n[:, None])[order], first)
        self.farthest[own] = np.maximum(self.farthest[own], np.maximum.reduceat(distance[order], first))
        np.add.at(self.scanned, cluster[scanned], 1)

    def rows(self, digest: bytes) -> pa.RecordBatch:
        full = np.flatnonzero(self.many)
        return _state(
            len(full), digest=[digest] * len(full), cluster=full.astype(np.int32), many=self.many[full], sums=self.sums[full].tolist(),
            farthest=self.farthest[full], inertia=[Decimal(self.inertia[c]) for c in full], scanned=self.scanned[full], kind=np.ones(len(full), np.int32),
        )


def _assigned(pairs: DataFrame, centroids: np.ndarray, loosen: np.ndarray | None, last: bool) -> DataFrame:
    """The new state of vectors (digest, vector, n, and if there's a state, cluster, lower), and what they add up to."""
    held = pairs.sparkSession.sparkContext.broadcast((centroids, loosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, loosen = held.value
        k, dims = centroids.shape
        total, some = _Sums(k, dims), None
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4").reshape(size, dims).astype(np.int64)
            cluster, lower = np.zeros(size, np.int64), np.full(size, -1.0)
            if loosen is not None:
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                lower = batch.column("lower").to_numpy() - loosen[cluster]
            distance = ((x - centroids[cluster]) ** 2).sum(1)
            ambiguous = np.flatnonzero(np.sqrt(distance) * (1 + SLACK) >= lower)
            for at in range(0, len(ambiguous), 4096):
                part = ambiguous[at : at + 4096]
                every = np.arange(len(part))
                to = squared(x[part], centroids)
                cluster[part] = to.argmin(1)  # of equal ones the first
                distance[part] = to[every, cluster[part]]
                to[every, cluster[part]] = np.iinfo(np.int64).max
                lower[part] = np.sqrt(to.min(1)) * (1 - SLACK)
            n = batch.column("n").to_numpy()
            total.add(x, n, cluster, distance, ambiguous)
            some = some or batch.column("digest")[0].as_py()
            if last:
                for c, d, w in zip(cluster.tolist(), distance.tolist(), n.tolist(), strict=True):
                    total.inertia[c] += d * w
            yield _state(size, digest=batch.column("digest"), cluster=cluster.astype(np.int32), lower=lower, kind=np.zeros(size, np.int32), **({"distance": distance} if last else {}))
        if some is not None:
            yield total.rows(some)

    return pairs.mapInArrow(run, _STATE_SQL)


class _Bucketed:
    """A table in the shared folder, dealt into buckets by digest, so that tables of equal buckets are joined where they lie."""

    def __init__(self, df: DataFrame, buckets: int, *by: str):
        self.spark, self.name = df.sparkSession, f"acreframe_{uuid.uuid4().hex}"
        self.path = table_path(self.spark, "clusters")
        df.write.partitionBy(*by).bucketBy(buckets, "digest").option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"drop table {self.name}")
        discard(self.spark, self.path)


def starts(vectors: DataFrame, clusters: int, seed: int, dims: int) -> np.ndarray:
    """The vectors of the `clusters` least SHA-256 of `seed:vec_id`; of equal ids the lesser bytes, null ids last."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(by.alias("by"), "vector").orderBy(F.asc_nulls_last("by"), "vector").limit(clusters).collect()
    return np.array([np.frombuffer(r.vector, "<i4") for r in rows], np.int64).reshape(len(rows), dims)


def _moved(centroids: np.ndarray, sums: list) -> tuple[np.ndarray, np.ndarray]:
    """The floors of the means, empty clusters staying; and the radius of each cluster's sphere.  A row for each cluster comes in."""
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for row in sums:
        new[row.cluster] = [int(s) // row.many for s in row.sums]
        radius[row.cluster] = np.sqrt(float(row.farthest))
    return new, radius


def _gathered(state: DataFrame, dims: int) -> list:
    """A row for each cluster: many, sums, farthest, inertia and scanned of all tasks."""
    parts = state.where("kind = 1")
    whole = F.array(*[F.sum(F.col("sums")[i].cast("decimal(38, 0)")) for i in range(dims)])
    return parts.groupBy("cluster").agg(F.sum("many").alias("many"), whole.alias("sums"), F.max("farthest").alias("farthest"), F.sum("inertia").alias("inertia"), F.sum("scanned").alias("scanned")).collect()


def cluster_vectors(rows: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2, report: list | None = None) -> DataFrame:
    """For each row of embeddings(vec_id, embedding) with `dims` components, none null or non-finite: vec_id, cluster, distance, cluster_inertia,
    inertia and centroid_sha256, after `rounds` rounds of assignment and means and a last assignment.

    Components count as floor(256 x), kept within LARGEST; centroids start as the vectors that `starts` names (fewer rows: as many centroids) and
    are floors of means; the nearest wins, of equally near ones that with the smaller number.  Other rows are left out; repeated rows come back as
    often as they came, and weigh as much; vectors without an id are clustered too.  Sums of distances beyond 63 bits are null.  An empty table gives an
    empty one.  `report` gets how many distinct vectors each pass compared with all centroids.

    Equal vectors are merged before they meet, so a common one costs a row.  Vectors are dealt once into buckets by digest; each pass joins them with the state of
    the last, which is dealt alike, without an exchange, and writes the new state: some 30 bytes a vector.
    """
    spark = rows.sparkSession
    vectors = quantised(rows, dims)
    own = vectors.select("vec_id", F.unhex(F.md5("vector")).alias("digest"))
    centroids = starts(vectors, clusters, seed, dims)
    if not len(centroids):
        return own.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]).where("false")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = vectors.groupBy("vector").agg(F.count("*").alias("n")).select(F.unhex(F.md5("vector")).alias("digest"), "vector", "n")
    table = _Bucketed(distinct.repartition(buckets, "digest"), buckets)
    state, loosen = None, None
    for turn in range(rounds + 1):
        pairs = table.read() if state is None else table.read().join(state.read().where("kind = 0").select("digest", "cluster", "lower").hint("shuffle_hash"), "digest")
        new = _Bucketed(_assigned(pairs, centroids, loosen, turn == rounds), buckets, "kind")
        if state is not None:
            state.drop()
        state = new
        sums = _gathered(state.read(), dims)
        if report is not None:
            report.append(sum(r.scanned for r in sums))
        if turn < rounds:
            after, radius = _moved(centroids, sums)
            loosen, centroids = loosened(centroids.astype(float), after.astype(float), radius), after
    table.drop()
    inertia = {r.cluster: r.inertia for r in sums}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    totals = spark.createDataFrame([(c, Decimal(n), Decimal(sum(inertia.values())), names[c]) for c, n in inertia.items()], "cluster int, own decimal(38, 0), every decimal(38, 0), centroid_sha256 string")
    ended = spark.read.parquet(state.path).where("kind = 0").select("digest", "cluster", "distance")
    long = lambda c: F.expr(f"try_cast({c} as long)")
    found = own.join(ended, "digest").join(F.broadcast(totals), "cluster")  # a row for each cluster
    return found.select("vec_id", "cluster", "distance", long("own").alias("cluster_inertia"), long("every").alias("inertia"), "centroid_sha256")


def _clusters_sql(clusters: int, rounds: int, dims: int, seed: int) -> str:
    """The same by comparing every vector with every centroid in each round."""
    steps = [f"""
with v as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x
  from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as c, x from v qualify c < {clusters}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
  select rid, vec_id, v.x, c, list_sum(list_transform(list_zip(v.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
  from v, c{i} qualify row_number() over (partition by rid order by distance, c) = 1
)""")
        if i < rounds:
            steps.append(f"""s{i} as (
  select c, d, sum(x[d])::hugeint as s, count(*)::hugeint as n from a{i}, range(1, {dims + 1}) t(d) group by all
), c{i + 1} as materialized (
  select o.c, coalesce(m.x, o.x) as x from c{i} o left join (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by d) as x from s{i} group by c) m on m.c = o.c
)""")
    return ", ".join(steps) + f"""
select vec_id, a.c::int as cluster, distance, sum(distance) over (partition by a.c)::bigint as cluster_inertia, sum(distance) over ()::bigint as inertia,
  sha256(array_to_string(k.x, ',')) as centroid_sha256
from a{rounds} a join c{rounds} k on k.c = a.c
"""


CLUSTERS_SQL = _clusters_sql(40, 5, 64, 2)
