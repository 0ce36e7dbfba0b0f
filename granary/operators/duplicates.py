"""Exact and canonical duplicates, and provenance. Group keys treat null as a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relations import same


def duplicate_groups(df: DataFrame, keys: Sequence[str], least: int = 2, *more: Column) -> DataFrame:
    """Keys that stand for at least so many rows, with occurrences and further aggregates."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"), *more).filter(F.col("occurrences") >= least)


def duplicate_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: one row with groups, occurrences and excess (occurrences beyond the first of each group)."""
    g = duplicate_groups(df, keys)
    return g.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("occurrences"), F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("excess"))


def joined_ids(c: str) -> Column:
    """The values in order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x.cast("string")), ",")


def duplicate_detail(df: DataFrame, keys: Sequence[str], id_col: str, collection: str, digest: str, at: str) -> DataFrame:
    """A2: for each group also collections, raw hashes, class of origin, first and last time and id. Its ids are those of id_pages."""
    g = duplicate_groups(
        df, keys, 2, F.countDistinct(collection).alias("collections"), F.countDistinct(digest).alias("raws"), F.bool_or(F.col(digest).isNull()).alias("no_raw"),
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"),
    )
    origin = F.when(F.col("collections") == 1, "same_collection").when(~F.col("no_raw") & (F.col("raws") == 1), "same_raw").otherwise("different_raw")
    return g.withColumn("origin_class", origin).drop("no_raw")


def id_pages(df: DataFrame, keys: Sequence[str], id_col: str, groups: DataFrame, span: int) -> DataFrame:
    """The ids of each of the groups in order, in pages of so wide a range of ids, so that no list grows with a group: keys, page, ids."""
    pages = df.groupBy(*keys, F.floor(F.col(id_col) / span).alias("page")).agg(joined_ids(id_col).alias("ids"))
    return pages.join(groups.select(*keys), same(pages, groups, keys), "left_semi")


def duplicate_summary(detail: DataFrame, by: Sequence[str]) -> DataFrame:
    """A3: the groups of duplicate_detail summed up for each value of by."""
    c = F.col
    return detail.groupBy(*by).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("occurrences").alias("rows_involved"), F.sum(c("occurrences") - 1).alias("excess"), F.count_if(c("collections") == 1).alias("single_collection"),
        F.count_if(c("collections") > 1).alias("multi_collection"), F.count_if(c("origin_class") == "same_raw").alias("same_raw"), F.count_if(c("origin_class") == "different_raw").alias("different_raw"),
        F.max("occurrences").alias("biggest"), F.max("last_at").alias("last_repetition"),
    )


def with_canonical(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """canonical_id (least id of the group), group_size, position. One shuffle serves the three."""
    g = Window.partitionBy(*keys)
    return df.withColumns({"canonical_id": F.min(id_col).over(g), "group_size": F.count(F.lit(1)).over(g), "position": F.row_number().over(g.orderBy(id_col))})


def duplicate_manifest(df: DataFrame, keys: Sequence[str], id_col: str, blockers: Sequence[tuple[str, Column]], otherwise: str = "manual") -> DataFrame:
    """A4: every row of every group with its canonical id and why the group can't be merged: the first blocker that holds.

    Blockers may use columns of the row and windows over `group_window(keys)`.
    """
    rows = with_canonical(df, keys, id_col).filter(F.col("group_size") > 1)
    reason = F.lit(otherwise)
    for name, holds in reversed(list(blockers)):
        reason = F.when(holds, name).otherwise(reason)
    return rows.withColumn("blocker", reason)


def conflicts(df: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """A5: groups of duplicates whose rows differ in parts (null is a value)."""
    # nulls inside the struct count as values: countDistinct skips only null structs
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"), F.size(F.collect_set(F.struct(*parts))).alias("variants"))
    return g.filter((F.col("occurrences") > 1) & (F.col("variants") > 1))


def semantic_candidates(df: DataFrame, exact: Sequence[str], canonical: Sequence[str], key: str) -> DataFrame:
    """Exact duplicates collapse first; then canonical groups that cover several keys."""
    once = df.groupBy(*exact, *[c for c in canonical if c not in exact], *([key] if key not in exact else [])).agg(F.count(F.lit(1)).alias("n"))
    return once.groupBy(*canonical).agg(F.countDistinct(key).alias("keys"), F.sum("n").alias("observations")).filter("keys > 1")


def semantic_variations(df: DataFrame, identity: Sequence[str], content: Column) -> DataFrame:
    """Identities with several contents: a row for each content, its times, and the identity's versions and observations."""
    once = df.groupBy(*identity, content.alias("content")).agg(F.count(F.lit(1)).alias("n"))
    g = once.groupBy(*identity).agg(F.count(F.lit(1)).alias("versions"), F.sum("n").alias("observations")).filter("versions > 1")
    named = g.select(*[F.col(k).alias(f"_{k}") for k in identity], "versions", "observations")
    hit = [once[k].eqNullSafe(named[f"_{k}"]) for k in identity]
    return once.join(named, hit).select(*identity, "content", "n", "versions", "observations")


def logical_contents(df: DataFrame, source: str, date: str, keys: Sequence[str]) -> DataFrame:
    """For each source and date: observations, logical contents, repeated, groups and occurrences of duplicates."""
    per = df.groupBy(source, date, *[k for k in keys if k not in (source, date)]).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(source, date).agg(
        F.sum("n").alias("observations"), F.count(F.lit(1)).alias("contents"), F.sum(F.col("n") - 1).alias("repeated"), F.count_if(F.col("n") > 1).alias("dup_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup_occurrences")
    )


def ordered_hash(df: DataFrame, line: Column, order: Sequence[str | Column], bucket: Column | None = None) -> DataFrame:
    """One SHA-256 of a table's lines in order.

    Lines are hashed in buckets that follow one another in that order (bucket: a number that grows with it), then the
    buckets' hashes in order; so no task holds more than a bucket, and the driver none. Without bucket all lines are one.
    """
    b = F.lit(0) if bucket is None else bucket
    rows = df.select(b.alias("b"), F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], line.alias("line")).alias("r"))
    per = rows.groupBy("b").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["line"]), "\n"), 256).alias("h"), F.count(F.lit(1)).alias("n"))
    return per.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), "\n"), 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def build_provenance(df: DataFrame, keys: Sequence[str], id_col: str, upto: int) -> DataFrame:
    """For each row up to an id: origin_id and the canonical quote it stands for."""
    rows = df.filter(F.col(id_col) <= upto)
    return with_canonical(rows, keys, id_col).select(F.col(id_col).alias("origin_id"), F.col("canonical_id").alias("quote_id"), "group_size", "position")


def ambiguous_groups(df: DataFrame, prov: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Groups whose originals aren't each covered, or whose targets (0, 1 or 2: several) aren't the one canonical row."""
    met = df.join(prov.select("origin_id", "quote_id"), F.col(id_col) == F.col("origin_id"), "left")
    # an id is covered by all of its provenance rows, so ids are counted once each and no distinct counts are needed for them
    once = met.groupBy(*keys, id_col).agg(F.max("origin_id").alias("origin_id"), F.min("quote_id").alias("low"), F.max("quote_id").alias("high"))
    g = once.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("originals"), F.count("origin_id").alias("covered"), F.min("low").alias("target"), F.max("high").alias("last"), F.min(id_col).alias("canonical")
    )
    one = F.when(F.col("target").isNull(), 0).when(F.col("target") == F.col("last"), 1).otherwise(2)
    g = g.withColumn("targets", one.cast("long")).drop("last")
    return g.filter((F.col("originals") != F.col("covered")) | (F.col("targets") != 1) | (F.col("target") != F.col("canonical")))


def provenance_metrics(df: DataFrame, prov: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """One row of counts."""
    rows = with_canonical(df, keys, id_col)
    met = rows.join(prov.select("origin_id", "quote_id"), rows[id_col] == F.col("origin_id"), "left")
    c = F.col
    return met.agg(
        F.countDistinct(id_col).alias("rows"), F.count("origin_id").alias("provenances"), F.countDistinct("origin_id").alias("covered"), F.count_if(c("origin_id").isNull()).alias("missing"),
        F.countDistinct("canonical_id").alias("canonical"), F.count_if((c("position") == 1) & (c("group_size") > 1)).alias("groups"), F.count_if(c("group_size") > 1).alias("occurrences"),
        F.count_if(c("position") > 1).alias("excess"),
    )


def invalid_provenance(df: DataFrame, prov: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Provenance rows without origin, with an unknown origin or target, or whose target isn't the canonical row."""
    rows = with_canonical(df, keys, id_col).select(F.col(id_col).alias("_id"), "canonical_id")
    there = df.select(F.col(id_col).alias("_target"))
    out = prov.join(rows, F.col("origin_id") == F.col("_id"), "left").join(there, F.col("quote_id") == F.col("_target"), "left")
    problem = F.when(F.col("origin_id").isNull(), "no_origin").when(F.col("_id").isNull(), "unknown_origin").when(F.col("_target").isNull(), "unknown_target").when(F.col("quote_id") != F.col("canonical_id"), "not_canonical")
    return out.withColumn("problem", problem).filter("problem is not null").select("origin_id", "quote_id", "problem")


def invalid_history(df: DataFrame, prov: DataFrame, collections: DataFrame, keys: Sequence[str], id_col: str, collection: str, checkpoint: int, prefix: str) -> DataFrame:
    """The first of eight faults of each historical provenance row (origin_id, quote_id, a collection, key); sound rows are left out.

    collections: id. The origin lies in 1 to the checkpoint, the key is the prefix and it, target and collection are known,
    and of a known origin the collection is its own and the target its group's canonical row.
    """
    rows = with_canonical(df, keys, id_col).select(F.col(id_col).alias("_id"), F.col(collection).alias("_of"), "canonical_id")
    there, known = df.select(F.col(id_col).alias("_target")), collections.select(F.col("id").alias("_known"))
    o, c = F.col("origin_id"), F.col
    out = prov.join(rows, o == c("_id"), "left").join(there, c("quote_id") == c("_target"), "left").join(known, c(collection) == c("_known"), "left")
    problem = (
        F.when(o.isNull(), "no_origin").when(o < 1, "origin_below_one").when(o > checkpoint, "origin_beyond_checkpoint").when(~c("key").eqNullSafe(F.concat(F.lit(prefix), o.cast("string"))), "key").when(c("_target").isNull(), "unknown_target")
        .when(c("_known").isNull(), "unknown_collection").when(c("_id").isNotNull() & ~c(collection).eqNullSafe(c("_of")), "other_collection").when(c("_id").isNotNull() & ~c("quote_id").eqNullSafe(c("canonical_id")), "not_canonical")
    )
    return out.withColumn("problem", problem).filter("problem is not null").select("origin_id", "quote_id", collection, "key", "problem")


def baseline(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """The first row of each group."""
    return with_canonical(df, keys, id_col).filter("position = 1").drop("canonical_id", "group_size", "position")


def occurrence_ordinals(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """1, 2, ... within each key."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def first_origin(prov: DataFrame, quote: str, order: str) -> DataFrame:
    """Origin recorded by the first provenance of a quote only; null in later ones."""
    first = F.row_number().over(Window.partitionBy(quote).orderBy(order)) == 1
    return prov.withColumn("recorded_origin", F.when(first, F.col(quote)))


def preferred(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each key, the first in that order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def insert_new(existing: DataFrame, arriving: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Of the arriving rows the first of each key, if the key isn't there yet (null-safe)."""
    first = preferred(arriving, keys, [F.col(ordinal)])
    return first.join(existing.select(*keys).distinct(), same(first, existing, keys), "left_anti")


def logical_delta(df: DataFrame, id_col: str, baseline_id: int, keys: Sequence[str]) -> DataFrame:
    """Rows beyond an id: inserted, logical_new (groups not seen up to it), repeated. One aggregation, no self join."""
    new = F.col(id_col) > baseline_id
    g = df.groupBy(*keys).agg(F.count_if(new).alias("n"), F.bool_or(~new).alias("known")).filter("n > 0")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return g.agg(zero(F.sum("n")).alias("inserted"), F.count_if(~F.col("known")).alias("logical_new"), zero(F.sum(F.col("n") - (~F.col("known")).cast("int"))).alias("repeated"))
