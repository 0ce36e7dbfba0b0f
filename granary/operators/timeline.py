"""Gaps, freshness, backfill cursors, watermarks, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relations import numbered


def date_gaps(df: DataFrame, scope: Sequence[str], date: str, least: int, inclusive: bool = True) -> DataFrame:
    """W4 (inclusive: days between two dates), W5 (not: days without data between them): gaps of at least that many days."""
    days = df.select(*scope, date).filter(F.col(date).isNotNull()).distinct()
    before = F.lag(date).over(Window.partitionBy(*scope).orderBy(date))
    gap = F.date_diff(F.col(date), F.col("previous")) - (0 if inclusive else 1)
    return days.withColumn("previous", before).withColumn("gap_days", gap.cast("long")).filter(F.col("gap_days") >= least)


def freshness(latest: DataFrame, date: str, most: Column, today: str) -> DataFrame:
    """age_days and current / stale / future / no_data / not_configured."""
    age = F.date_diff(F.lit(today).cast("date"), F.col(date)).cast("long")
    status = F.when(F.col(date).isNull(), "no_data").when(age < 0, "future").when(most.isNull(), "not_configured").when(age <= most, "current").otherwise("stale")
    return latest.withColumns({"age_days": age, "freshness": status})


def next_cursor(df: DataFrame, download: str, persistence: str, oldest_before: str, oldest_now: str, misses: str, today: str, pause: int = 30) -> DataFrame:
    """Status, cursor, no_progress and next_check after a backfill run: partial, failed, complete (older found) or paused."""
    moved = F.col(oldest_now).isNotNull() & (F.col(oldest_before).isNull() | (F.col(oldest_now) < F.col(oldest_before)))
    bad = (F.col(download) == "failed") | (F.col(persistence) == "failed")
    status = F.when(F.col(download) == "partial", "partial").when(bad, "failed").when(moved, "complete").otherwise("paused")
    paused = F.col("status") == "paused"
    out = df.withColumn("status", status)
    return out.withColumns(
        {
            "cursor": F.least(oldest_before, oldest_now),
            "no_progress": F.when(paused, F.col(misses) + 1).when(F.col("status") == "complete", 0).otherwise(F.col(misses)),
            "next_check": F.when(paused, F.date_add(F.lit(today).cast("date"), pause)),
        }
    )


def deferred(status: Column, next_check: Column, today: str) -> Column:
    """A paused scope whose next check lies ahead."""
    return F.coalesce((status == "paused") & (next_check > F.lit(today).cast("date")), F.lit(False))


def start_cursor(oldest_store: Column, oldest_raw: Column) -> Column:
    """The day before the oldest known one."""
    return F.date_sub(F.least(oldest_store, oldest_raw), 1)


def plan_retention(files: DataFrame, layer: str, date: str, days: dict[str, int], today: str, proven: DataFrame | None = None, staging: str = "staging") -> DataFrame:
    """Keep, protected or expired for each file of each layer.

    Expired is what is dated before today - (days - 1), in the staging layer only if its date is proven consolidated. If all
    files of a layer would expire, the newest is protected.
    """
    keep = F.create_map(*[x for k, v in days.items() for x in (F.lit(k), F.lit(v))])
    cutoff = F.date_sub(F.lit(today).cast("date"), keep[F.col(layer)] - 1)
    rows = files.withColumn("cutoff", cutoff)
    if proven is not None:
        seen = proven.select(F.col(date).alias("_proven")).distinct()
        rows = rows.join(seen, F.col(date) == F.col("_proven"), "left")
        sure = (F.col(layer) != staging) | F.col("_proven").isNotNull()
    else:
        sure = F.col(layer) != staging
    rows = rows.withColumn("old", F.coalesce((F.col(date) < F.col("cutoff")) & sure, F.lit(False))).drop("_proven")
    g = Window.partitionBy(layer)
    newest = (F.col(date) == F.max(date).over(g)) & F.bool_and("old").over(g)
    return rows.withColumn("action", F.when(~F.col("old"), "keep").when(newest, "protected").otherwise("expired")).drop("old")


def log_retention(files: DataFrame, at: str, days: int, most: int, today: str, ties: Sequence[str] = ()) -> DataFrame:
    """Files past an age or beyond a rank by age go; files of one time rank by ties."""
    age = F.date_diff(F.lit(today).cast("date"), F.col(at))
    old = age > days
    return numbered(files, age, [F.col(at).desc(), *ties], "rank").withColumn("action", F.when(old | (F.col("rank") > most), "expired").otherwise("keep"))


def select_per_day(files: DataFrame, day: str, order: Sequence[Column], cutoff: str, today: str) -> DataFrame:
    """Of each day's files the first in that order is selected, others are duplicates; older ones and future ones marked."""
    n = F.row_number().over(Window.partitionBy(day).orderBy(*order))
    rows = files.withColumn("rank", n)
    state = F.when(F.col(day) > F.lit(today).cast("date"), "future").when(F.col(day) < F.lit(cutoff).cast("date"), "too_old").when(F.col("rank") == 1, "selected").otherwise("duplicate")
    return rows.withColumn("state", state)


def inventory_diff(before: DataFrame, after: DataFrame, path: str, size: str, digest: str) -> DataFrame:
    """For each path: kept, changed, lost or new."""
    a = before.select(F.col(path).alias("path"), F.col(size).alias("s0"), F.col(digest).alias("d0"), F.lit(True).alias("was"))
    b = after.select(F.col(path).alias("_path"), F.col(size).alias("s1"), F.col(digest).alias("d1"), F.lit(True).alias("now"))
    out = a.join(b, F.col("path") == F.col("_path"), "full_outer").withColumn("path", F.coalesce("path", "_path"))
    equal = (F.col("s0") == F.col("s1")) & (F.col("d0").isNull() | F.col("d1").isNull() | (F.col("d0") == F.col("d1")))
    return out.withColumn("state", F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "lost").when(equal, "kept").otherwise("changed")).select("path", "state")


def contiguous_batches(df: DataFrame, bucket: Column, order: Sequence[str], k: int) -> DataFrame:
    """K ordered batches, the first ones with one more. bucket grows with the order, so that no task numbers all rows."""
    n = df.agg(F.count(F.lit(1)).alias("_all"))
    least, more = F.floor(F.col("_all") / k), F.col("_all") % k
    at = F.col("_i") - 1
    long = more * (least + 1)
    batch = F.when(at < long, F.floor(at / (least + 1))).otherwise(more + F.floor((at - long) / F.greatest(least, F.lit(1)))) + 1
    return numbered(df, bucket, order, "_i").crossJoin(F.broadcast(n)).withColumn("batch", batch.cast("int")).drop("_i", "_all")


def incremental(df: DataFrame, id_col: str, watermark: int | None, reference: bool = False) -> DataFrame:
    """Rows after the watermark; reference tables whole. One filter that reaches the scan."""
    return df if reference or watermark is None else df.filter(F.col(id_col) > watermark)
