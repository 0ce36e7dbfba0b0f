"""Joins that keep nulls, coverage, members that are missing, set algebra."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys; a hash join in Spark."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def coverage(dim: DataFrame, dim_key: str, facts: DataFrame, fact_key: str, date: str, distinct: dict[str, str] | None = None, when: dict[str, Column] | None = None) -> DataFrame:
    """Every row of dim with the count of facts, first and last date, distinct counts and conditional counts.

    Facts are aggregated before the join, so it moves a row per key and can't fan out; members without facts have zeros.
    """
    aggs = [F.count(F.lit(1)).alias("facts"), F.min(date).alias("first_date"), F.max(date).alias("last_date")]
    aggs += [F.countDistinct(c).alias(name) for name, c in (distinct or {}).items()]
    aggs += [F.count_if(c).alias(name) for name, c in (when or {}).items()]
    per = facts.groupBy(F.col(fact_key).alias("_k")).agg(*aggs)
    counts = ["facts", *(distinct or {}), *(when or {})]
    out = dim.join(per, dim[dim_key] == per["_k"], "left").drop("_k")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def missing_members(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of expected whose key isn't in actual, null-safe."""
    return expected.join(actual.select(*on).distinct(), same(expected, actual, on), "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child that name a parent that isn't there; null names none."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias("_p")), F.col(child_key) == F.col("_p"), "left_anti")


def latest_for(wanted: DataFrame, key: str, facts: DataFrame, fact_key: str, date: str, limit: str | None = None) -> DataFrame:
    """The latest date of each wanted member, null if none; with a limit the latest not after it."""
    near = facts if limit is None else facts.filter(F.col(date) <= F.lit(limit).cast("date"))
    per = near.groupBy(F.col(fact_key).alias("_k")).agg(F.max(date).alias("latest"))
    return wanted.join(per, wanted[key] == per["_k"], "left").drop("_k")


def set_algebra(expected: DataFrame, parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with in_expected, in_parsed and class both / missing / unexpected."""
    a = expected.select(*keys).distinct().withColumn("_e", F.lit(True))
    b = parsed.select(*keys).distinct().withColumn("_p", F.lit(True))
    out = a.union(b.withColumnRenamed("_p", "_e").withColumn("_e", F.lit(False))).groupBy(*keys).agg(F.bool_or("_e").alias("in_expected"), F.bool_or(~F.col("_e")).alias("in_parsed"))
    return out.withColumn("class", F.when(F.col("in_expected") & F.col("in_parsed"), "both").when(F.col("in_expected"), "missing").otherwise("unexpected"))


def pair_by_rank(stored: DataFrame, expected: DataFrame, key: Sequence[str], stored_order: str, expected_order: str) -> DataFrame:
    """The n-th expected row of a key with its n-th stored row; expected rows left over have no stored one."""
    rank = lambda df, by: df.withColumn("position", F.row_number().over(Window.partitionBy(*key).orderBy(by)))
    a = rank(expected, expected_order)
    b = rank(stored, stored_order).select(*[F.col(k).alias(f"_{k}") for k in key], F.col("position").alias("_n"), F.col(stored_order).alias("stored_id"))
    on = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in key]) & (a["position"] == b["_n"])
    return a.join(b, on, "left").drop(*[f"_{k}" for k in key], "_n").withColumn("action", F.when(F.col("stored_id").isNull(), "insert").otherwise("update"))


def unique_lookup(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Keys that stand for exactly one row, with its id."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias(id_col)).filter("n = 1").drop("n")


def first_hit(wanted: DataFrame, evidence: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Each wanted row with the first evidence of its key in that order, or nulls."""
    per = evidence.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n").withColumnRenamed(key, "_k")
    return wanted.join(per, wanted[key].eqNullSafe(per["_k"]), "left").drop("_k")


def numbered(df: DataFrame, bucket: Column, order: Sequence[str | Column], out: str) -> DataFrame:
    """df with numbers 1, 2, ... in an order, without a task that sees all rows.

    bucket grows with the order (rows of lower buckets come first); rows are numbered within theirs, and a bucket begins
    after the rows of all lower ones. There is one row for each bucket in the window over the counts.
    """
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)))
    return inside.join(starts, F.col("_bucket").eqNullSafe(F.col("_of"))).withColumn(out, F.col("_start") + F.col("_at")).drop("_bucket", "_of", "_start", "_at")
