"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import digest, free_name, materialise, row_key, slices
from acreframe.llm.components import components

BITS = 64
#: Fingerprints of a bucket up to which all its pairs are compared; larger buckets are split by further masks.
BUCKET = 64


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The majority bits of the XXH64 of the word shingles, repeats included; zero where there is no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -shingle] + 1))
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)), np.uint64, len(starts))
    return majority(hashes)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(key, digest, doc_id, fp) for each row; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle, seed) for part in slices(batch) for t in part.column("text").to_pylist()]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], fp], names=["key", "digest", "doc_id", "fp"])

    rows = docs.select(row_key().alias("key"), digest().alias("digest"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, digest binary, doc_id long, fp long")


def covering_masks(radius: int, kept: int = 0) -> list[int]:
    """2^(radius+1) - 1 masks that hold the bits of `kept` and such others that any `radius` bits beside `kept` lie outside one of them.

    Each bit that isn't kept carries a vector of radius+1 bits; the mask of a non-zero v adds the bits whose vectors have an odd
    inner product with v.  The vectors of `radius` bits don't span the space, so some v is orthogonal to all of them: its mask leaves
    them out.
    """
    size = 1 << (radius + 1)
    vectors = sorted(range(1, size), key=lambda v: (v.bit_count() > 1, v))  # unit vectors first: a few bits span the space
    free = [i for i in range(BITS) if not kept >> i & 1]
    return [kept | sum(1 << i for k, i in enumerate(free) if (vectors[k % len(vectors)] & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Pairs (u, v) of the distinct fingerprints `fp` that differ in `radius` bits at most, each as often as it collides.

    One table for each covering mask: every pair within the radius has the same masked value in one of them.  Pairs of a bucket
    of up to BUCKET are compared; the members of a larger one go to tables of further masks, which cover the bits that are left
    in the same way.  Each round leaves about half of the free bits, so after a few no bucket can be larger than BUCKET.
    """
    if not 0 <= radius <= 5:
        raise ValueError("radius from 0 to 5")
    spark = prints.sparkSession
    rows = prints.select("fp", F.lit(0).cast("long").alias("mask"))
    parents, out = [0], None
    while parents:
        # as many rows as there are masks, whatever the input
        children = [(_signed(p), _signed(m)) for p in parents for m in covering_masks(radius, p)]
        table = rows.join(F.broadcast(spark.createDataFrame(children, "mask long, child long")), "mask").select("fp", F.col("child").alias("mask")).distinct()
        table = table.withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = table.groupBy("mask", "part").agg(F.count("*").alias("n")).where("n > 1")
        held = materialise(table.join(sizes, ["mask", "part"]), "buckets")
        few = held.where(F.col("n") <= BUCKET).select("mask", "part", "fp")
        met = few.withColumnRenamed("fp", "u").join(few.withColumnRenamed("fp", "v"), ["mask", "part"])
        pairs = met.where((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")
        out = pairs if out is None else out.union(pairs)
        rows = held.where(F.col("n") > BUCKET).select("fp", "mask")
        crowded = {r.mask & (1 << BITS) - 1 for r in rows.select("mask").distinct().collect()}  # as many as masks at most
        parents = sorted(crowded)
    return out


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """Group documents(doc_id, text) whose fingerprints are linked by steps of at most `radius` bits.

    Returns key, digest, doc_id, fingerprint (16 hex digits) and component_id, the least doc_id of the group.  Equal fingerprints are
    merged first, so copies cost one row each.  Null and empty texts have the fingerprint zero and are linked like others;
    a row without doc_id is grouped too, and never names its group unless all its group's ids are null (then null).
    Repeated rows come back as often as they came.  Other columns are ignored; an empty table gives an empty one.
    """
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = materialise(components(links(least.select("fp"), radius)), "roots")
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = materialise(named.join(groups, "root").select("fp", "component_id"), "groups")
    return prints.join(of, "fp").select("key", "digest", "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """The rows of docs whose doc_id names their group; of a group without ids, by the column `group`, rows with the least key."""
    nameless = groups.where("component_id is null").groupBy(group).agg(F.min_by(F.struct("key", "digest"), F.struct("key", "digest")).alias("k")).select("k.*")
    keep = groups.where("doc_id = component_id").select("key", "digest").union(nameless).distinct()
    key, name = free_name(docs, "__key"), free_name(docs, "__digest")
    # merged by key at every size, so that the plan and what it moves don't change with the input
    return docs.withColumns({key: row_key(), name: digest()}).join(keep.toDF(key, name).hint("merge"), [key, name], "left_semi").select(docs.columns)


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """The rows of docs, all columns, whose doc_id names its group.  Rows with the same id and text stay or go together; of a group without ids, those with the least hash stay."""
    return keep_first(docs, simhash_groups(docs, shingle, radius, seed), "fingerprint")
