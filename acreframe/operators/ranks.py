"""Sums over an order, and medians, without a task that holds all values of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets that the values of a group are dealt to, by its own quantiles, and parts that a group's rows are joined in.
BUCKETS, PARTS = 256, 64


def beside(rows: DataFrame, side: DataFrame, group: str, by: str, how: str = "inner") -> DataFrame:
    """rows joined with side, a row for each group, without any group's rows meeting in one task.

    The rows of a group are dealt to PARTS parts by a hash of `by`, and each part has the side's row; so neither a broadcast nor a count of the
    groups is needed.  Null groups don't match.
    """
    part = F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int")
    each = side.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return rows.withColumn("__part", part).join(each, [group, "__part"], how).drop("__part")


def sums_before(counts: DataFrame, group: str | None, value: str, weights: list[str]) -> DataFrame:
    """counts(group, value, weights), a row for each value, with the sum of each weight over smaller values as <weight>_before.

    Sums are added up in two steps, over the buckets of a group and within each.  Buckets are bounded by quantiles of the distinct
    values, so values far off don't crowd the others into one.  group None: all rows are one group.
    """
    own = [group] if group else []
    cuts = F.percentile_approx(value, [i / BUCKETS for i in range(1, BUCKETS)], 20 * BUCKETS)
    bounds = counts.groupBy(*own).agg(F.array_distinct(cuts).alias("__cuts"))
    held = beside(counts, bounds, group, value) if group else counts.join(F.broadcast(bounds))  # one row is joined
    placed = held.withColumn("__b", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts")
    line = Window.partitionBy(*own).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*own, "__b").agg(*[F.sum(w).alias(f"__{w}") for w in weights])
    sums = sums.select(*own, "__b", *[F.coalesce(F.sum(f"__{w}").over(line), F.lit(0)).alias(f"__{w}_below") for w in weights])  # BUCKETS rows for each group
    inside = Window.partitionBy(*own, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumns({f"__{w}_in": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights})
    return within.join(sums, [*own, "__b"]).select(*counts.columns, *[(F.col(f"__{w}_in") + F.col(f"__{w}_below")).alias(f"{w}_before") for w in weights])


def medians(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value): the exact median of each group, the mean of the middle two where they're even in number."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__n"))
    placed = beside(sums_before(counts, group, value, ["__n"]), counts.groupBy(group).agg(F.sum("__n").alias("__all")), group, value)
    at = lambda k: F.max(F.when((F.col("__n_before") <= k) & (k < F.col("__n_before") + F.col("__n")), F.col(value)))
    return placed.groupBy(group).agg(((at(F.expr("(__all - 1) div 2")) + at(F.expr("__all div 2"))) / 2).alias(value))
