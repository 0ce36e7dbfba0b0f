"""Alert roll-up, totals, run metrics, health and publication gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Codes that make a run inadequate. Fixed values.
INADEQUATE = ("database_unavailable", "run_failed", "insufficient_completed_sources", "persistence_failures", "future_quote_dates", "database_id_regression", "database_without_quotes")


def alert_rollup(events: DataFrame, level: str, message: str, order: str, examples: int = 3) -> DataFrame:
    """(level, reason) with count and the first distinct scopes in order of events; errors first, then most frequent.

    Reason is the text after the last ' | ' of a message, scope the text before the first.
    """
    rows = events.select(F.col(level).alias("level"), F.col(order).alias("at"), F.substring_index(message, " | ", -1).alias("reason"), F.substring_index(message, " | ", 1).alias("scope"))
    per = rows.groupBy("level", "reason", "scope").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    per = per.withColumn("rank", F.row_number().over(Window.partitionBy("level", "reason").orderBy("first", "scope")))
    shown = F.array_sort(F.collect_list(F.when(F.col("rank") <= examples, F.struct("rank", "scope"))))
    out = per.groupBy("level", "reason").agg(F.sum("n").alias("events"), F.array_join(F.transform(shown, lambda x: x["scope"]), ", ").alias("scopes"))
    return out.orderBy(F.col("level") != "error", F.col("events").desc(), "reason")


def label_totals(rows: DataFrame, label: str, value: str, order: str) -> DataFrame:
    """Sums of the values that are whole numbers, labels in order of first sight."""
    number = F.when(F.col(value).rlike(r"^\s*[+-]?\d+\s*$"), F.col(value)).try_cast("bigint")
    return rows.groupBy(F.col(label).alias("label")).agg(F.coalesce(F.sum(number), F.lit(0)).alias("total"), F.min(order).alias("first_seen"))


def persistence_repeated(parsed: Column, rejected: Column, inserted: Column) -> Column:
    """X21."""
    return F.greatest(F.lit(0), parsed - rejected - inserted)


def span_metrics(df: DataFrame, start: str, end: str, queued: str | None = None) -> list[Column]:
    """Aggregates in seconds: span from first start to last end, sum of times, gain by overlap, items per minute."""
    s, e = F.col(start).cast("double"), F.col(end).cast("double")
    span, total = F.max(e) - F.min(s), F.sum(e - s)
    wait = [F.sum(s - F.col(queued).cast("double")).alias("queue_wait")] if queued else []
    return [span.alias("span"), total.alias("accumulated"), F.greatest(F.lit(0.0), total - span).alias("overlap_gain"), F.when(span > 0, F.count(F.lit(1)) * 60 / span).alias("per_minute"), *wait]


def health(sources: DataFrame, run: dict[str, object]) -> DataFrame:
    """Reason codes in order, each with a count, and the status healthy / partial / inadequate.

    sources: download (completed, partial, failed, not_run), persistence (ok, failed, skipped, not_run), freshness. run: run_failed,
    complement_unavailable, database_available, delta (measured, regressed, unavailable).
    """
    n = lambda c, v: F.count_if(F.col(c) == v)
    total, done = F.count(F.lit(1)), n("download", "completed")
    lit = lambda x: F.lit(int(bool(x)))
    reasons: Sequence[tuple[str, Column]] = [
        ("run_failed", lit(run.get("run_failed"))), ("complement_unavailable", lit(run.get("complement_unavailable"))), ("database_unavailable", lit(not run.get("database_available", True))),
        ("insufficient_completed_sources", F.when((total > 0) & (done < F.floor(total / 2) + 1), done + 1).otherwise(0)), ("persistence_failures", n("persistence", "failed")),
        ("future_quote_dates", n("freshness", "future")), ("database_id_regression", lit(run.get("delta") == "regressed")), ("logical_delta_unavailable", lit(run.get("delta") == "unavailable")),
        ("download_failures", n("download", "failed")), ("partial_downloads", n("download", "partial")), ("sources_not_run", n("download", "not_run")), ("persistence_skipped", n("persistence", "skipped")),
        ("persistence_not_run", n("persistence", "not_run")), ("stale_sources", n("freshness", "stale")), ("sources_without_data", n("freshness", "no_data")),
        ("database_without_quotes", F.when((total > 0) & (n("freshness", "no_data") == total), 1).otherwise(0)),
    ]
    out = sources.agg(*[c.cast("long").alias(k) for k, c in reasons])
    codes = F.array_compact(F.array(*[F.when(F.col(k) > 0, F.lit(k)) for k, _ in reasons]))
    out = out.withColumn("reasons", codes)
    bad = F.arrays_overlap("reasons", F.array(*map(F.lit, INADEQUATE)))
    return out.select(F.when(bad, "inadequate").when(F.size("reasons") > 0, "partial").otherwise("healthy").alias("status"), F.array_join("reasons", ",").alias("reasons"))


def gate(sources: DataFrame, now: dict[str, int], before: dict[str, int]) -> DataFrame:
    """Blocking and warning reasons of a snapshot, a row each: scope, code, blocking.

    sources: source, policy (required, optional, ...), download, persistence, latest, previous_latest (dates), today's check in
    `future` (boolean). now and before: total, max_id. A failed download never blocks; failed persistence blocks required
    sources only after a completed download; a latest date that went back always blocks.
    """
    watched = sources.filter(~F.col("policy").isin("disabled", "backfill_only", "unsupported"))
    required = F.col("policy") == "required"
    rule = lambda code, holds, blocking: F.when(holds, F.struct(F.lit(code).alias("code"), blocking.alias("blocking")))
    found = F.array_compact(
        F.array(
            rule("date_regression", F.col("latest") < F.col("previous_latest"), F.lit(True)),
            rule("date_missing", F.col("latest").isNull() & F.col("previous_latest").isNotNull(), F.lit(True)),
            rule("download_failed", F.col("download") == "failed", F.lit(False)),
            rule("persistence_failed", (F.col("persistence") == "failed") & (F.col("download") == "completed"), required),
            rule("no_data", F.col("latest").isNull(), required),
            rule("future_date", F.col("future"), required),
        )
    )
    out = watched.select(F.col("source").alias("scope"), F.explode(found).alias("r")).select("scope", "r.code", "r.blocking")
    whole = [("total_regression", now["total"] < before["total"]), ("id_regression", now["max_id"] < before["max_id"])]
    spark = sources.sparkSession
    rows = [("store", code, True) for code, bad in whole if bad]
    return out.union(spark.createDataFrame(rows, "scope string, code string, blocking boolean"))
