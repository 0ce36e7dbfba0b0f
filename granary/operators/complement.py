"""Filling missing prices from a secondary feed (X1), as joins: unique targets, first feed row wins, fallback by scope."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Complement(NamedTuple):
    #: id, price: the targets that the feed fills
    updates: DataFrame
    #: market, day, product, unit, price, destination: feed rows of a known market and day under a key not saved before
    inserts: DataFrame
    metrics: DataFrame


def complement(saved: DataFrame, feed: DataFrame, own: Column | None = None) -> Complement:
    """own: a condition on saved rows that came from the feed itself (F10); they neither are targets nor hold keys. saved: id, market, day, product, unit, price (null: a target), destination. feed: ordinal, market, day, product, unit, price.

    Saved rows without a market or unit can't be matched (unmapped). A key that several targets share is ambiguous and never
    filled. Feed rows lacking a part are skipped; of the rows with one key the first counts. Every mapped saved key, matched
    or ambiguous, keeps its feed rows from the fallback; the destination of a fallback is the least id of its market and day.
    """
    key = ["market", "day", "product", "unit"]
    dated = saved.filter(F.col("day").isNotNull() if own is None else F.col("day").isNotNull() & ~F.coalesce(own, F.lit(False)))
    mapped = dated.filter(F.col("market").isNotNull() & F.col("unit").isNotNull())
    targets = dated.filter(F.col("price").isNull())
    per = mapped.filter(F.col("price").isNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    rows = feed.filter(F.col("day").isNotNull() & F.col("price").isNotNull() & F.col("unit").isNotNull() & (F.col("product") != ""))
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy("ordinal"))).filter("_n = 1").drop("_n")
    # the keys are never null on either side here, so plain equality joins
    updates = first.join(per.filter("n = 1").drop("n"), key).select("id", "price")
    unknown = first.join(mapped.select(*key).distinct(), key, "left_anti")
    scopes = mapped.groupBy("market", "day").agg(F.min(F.struct("id", "destination")).alias("s")).select("market", "day", F.col("s.destination").alias("destination"))
    inserts = unknown.join(scopes, ["market", "day"]).select(*key, "price", "destination")
    one = lambda df, **aggs: df.agg(*[c.alias(n) for n, c in aggs.items()])
    unmapped = F.col("market").isNull() | F.col("unit").isNull()
    metrics = one(targets, candidates=F.count(F.lit(1)), unmapped=F.count_if(unmapped))
    metrics = metrics.crossJoin(one(per, ambiguous=F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))))
    metrics = metrics.crossJoin(one(scopes, scopes=F.count(F.lit(1)))).crossJoin(one(feed, scanned=F.count(F.lit(1))))
    metrics = metrics.crossJoin(one(updates, updated=F.count(F.lit(1)))).crossJoin(one(inserts, inserted=F.count(F.lit(1))))
    return Complement(updates, inserts, metrics)


def fill(quotes: DataFrame, updates: DataFrame, price: str) -> DataFrame:
    """Quotes with the updates filled in where the price is null."""
    new = updates.select(F.col("id").alias("_id"), F.col("price").alias("_price"))
    return quotes.join(new, F.col("id") == F.col("_id"), "left").withColumn(price, F.coalesce(price, "_price")).drop("_id", "_price")


def complement_log(quotes: DataFrame, updates: DataFrame, price: str, field: str) -> DataFrame:
    """A row for every price that was filled: quote_id, field, old_value (null), new_value."""
    q = quotes.filter(F.col(price).isNull()).select("id").join(updates, "id")
    return q.select(F.col("id").alias("quote_id"), F.lit(field).alias("field"), F.lit(None).cast("string").alias("old_value"), F.col("price").cast("string").alias("new_value"))
