"""Connected components by alternating stars, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import discard, materialise, table_path


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
    return out.select("e.u", F.col("e.m").alias("v")).where("u != v").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """edges(u, v): longs.  Returns (node, root) for each node that has an edge; root: the least node reachable.

    Each round writes its edges to the shared folder and removes those of the last, so neither the plan, a recomputation nor the disk grows with the rounds.
    Stars of a hub are made by a partial minimum and a join; a hub's links never meet in one group.
    """
    pairs = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    spark, path = edges.sparkSession, table_path(edges.sparkSession, "links")
    pairs = materialise(pairs, "links", path)
    before = _state(pairs)
    for _ in range(rounds):
        last, path = path, table_path(spark, "stars")
        pairs = materialise(_small(_large(pairs)), "stars", path)
        discard(spark, last)
        now = _state(pairs)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
