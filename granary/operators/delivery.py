"""What decides over publication and what leaves the store: gate reasons, layers, date walks, page texts, reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Least version of a health report, and its reasons that block publication. Fixed values.
HEALTH_VERSION = 2
HEALTH_BLOCKS = ("database_unavailable", "database_id_regression", "health_assessment_failed", "run_failed")
#: Days without data after which an open walk back ends, and the attempts of one for n dates. Fixed values.
MISSES = 366
ATTEMPTS = (4, 30)


def _reasons(rules: Mapping[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.lit(code)) for code, holds in rules.items()]))


def store_reasons(stores: DataFrame) -> DataFrame:
    """Scope, code, blocking of stores (scope, status, quick_check, violations, quotes). An unavailable store has that reason only."""
    there = F.col("status") == "available"
    codes = F.when(~F.coalesce(there, F.lit(False)), F.array(F.lit("database_unavailable"))).otherwise(
        _reasons({"database_quick_check_failed": ~(F.size("quick_check") == 1) | (F.get("quick_check", F.lit(0)) != "ok"), "database_foreign_key_violations": F.col("violations") > 0, "database_without_quotes": F.col("quotes") == 0})
    )
    return stores.select("scope", F.explode(codes).alias("code"), F.lit(True).alias("blocking"))


def health_contract(reports: DataFrame, least: int = HEALTH_VERSION) -> DataFrame:
    """Scope, code, blocking of health reports (scope, body: JSON with schema_version and reasons with codes)."""
    body = F.from_json("body", "schema_version int, reasons string")
    listed = F.from_json("b.reasons", "array<struct<code:string>>")
    r = reports.withColumn("b", body).withColumn("listed", F.when(F.col("b.reasons").startswith("["), listed))
    old = F.when(F.col("b.schema_version").isNull() | (F.col("b.schema_version") < least), F.array(F.lit("health_schema_unsupported"))).otherwise(F.array().cast("array<string>"))
    blocking = F.transform(F.filter("listed", lambda x: x["code"].isin(*HEALTH_BLOCKS)), lambda x: F.concat(F.lit("health_"), x["code"]))
    codes = F.concat(old, F.when(F.col("listed").isNull(), F.array(F.lit("health_reasons_invalid"))).otherwise(blocking))
    return r.select("scope", F.explode(codes).alias("code"), F.lit(True).alias("blocking"))


def walk_dates(available: DataFrame, scope: Sequence[str], day: str, target: str, back: int | None) -> DataFrame:
    """The dates that a walk back from the target day by day finds in each scope: place (1 is the latest), attempt.

    Dates beyond the target are rejected. For a number of earlier dates the walk ends with them or after so many attempts; without
    one it ends after MISSES days in a row without data.
    """
    end = F.lit(target).cast("date")
    days = available.select(*scope, day).filter(F.col(day) <= end).distinct()
    order = Window.partitionBy(*scope).orderBy(F.col(day).desc())
    days = days.withColumns({"place": F.row_number().over(order), "attempt": F.date_diff(end, F.col(day)) + 1, "missed": F.date_diff(F.coalesce(F.lag(day).over(order), F.date_add(end, 1)), F.col(day)) - 1})
    if back is None:
        days = days.withColumn("over", F.max("missed").over(order.rowsBetween(Window.unboundedPreceding, 0)) >= MISSES).filter("not over").drop("over")
    else:
        times, least = ATTEMPTS
        days = days.filter((F.col("place") <= back + 1) & (F.col("attempt") <= max(times * (back + 1), least)))
    return days.drop("missed")


def layer_status(targets: DataFrame, inventory: DataFrame, proofs: DataFrame) -> DataFrame:
    """Day, path, state, day_state. targets: day, path, size; inventory: path; proofs: path, size.

    A target is missing, validated_existing (a proof of its size) or existing_unverified; a day is blocked if one of its
    targets is unverified, else pending if one is missing, else completed.
    """
    there = inventory.select("path").distinct().withColumn("there", F.lit(True))
    proven = proofs.select("path", "size").distinct().withColumn("proven", F.lit(True))
    rows = targets.join(there, "path", "left").join(proven, ["path", "size"], "left")
    rows = rows.withColumn("state", F.when(F.col("there").isNull(), "missing").when(F.col("proven"), "validated_existing").otherwise("existing_unverified"))
    of_day = Window.partitionBy("day")
    some = lambda s: F.max((F.col("state") == s).cast("int")).over(of_day) == 1
    return rows.select("day", "path", "state", F.when(some("existing_unverified"), "blocked").when(some("missing"), "pending").otherwise("completed").alias("day_state"))


def allowed_url(c: Column, hosts: Sequence[str], prefix: str = "/") -> Column:
    """An http or https address of one of the hosts whose path begins so; false for null."""
    parts = [F.regexp_extract(c, r"^(https?)://(?:[^/@]*@)?([^/:?#]+)(?::\d+)?(/[^?#]*)?", k) for k in (1, 2, 3)]
    path = F.when(parts[2] == "", "/").otherwise(parts[2])
    return F.coalesce((parts[0] != "") & F.lower(parts[1]).isin(*hosts) & path.startswith(prefix) & ~F.array_contains(F.split(path, "/"), ".."), F.lit(False))


def encoded_url(base: Column, **parameters: Column) -> Column:
    """Base with parameters, names and values encoded; those that are null are left out."""
    pairs = F.array_compact(F.array(*[F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), F.url_encode(v))) for k, v in parameters.items()]))
    return F.when(F.size(pairs) > 0, F.concat(base, F.lit("?"), F.array_join(pairs, "&"))).otherwise(base)


def report_rows(report: DataFrame) -> DataFrame:
    """Id, source, path, sha256 of a report of missing raw files, read back as text columns; other statuses and rows without a path are left out."""
    named = report.toDF(*[c.strip().lower() for c in report.columns])
    lost = sorted({"id", "source", "path", "sha256", "status"} - set(named.columns))
    if lost:
        raise ValueError(f"the report has no column {', '.join(lost)}")
    return named.filter((F.trim("status") == "missing") & (F.trim("path") != "")).select(F.trim("id").try_cast("bigint").alias("id"), F.trim("source").alias("source"), F.trim("path").alias("path"), F.lower(F.trim("sha256")).alias("sha256"))


def text_pages(content: bytes) -> list[str]:
    """Pages of plain text, parted by form feeds; bytes that aren't UTF-8 are read as Latin-1."""
    try:
        text = content.decode("utf-8")
    except UnicodeDecodeError:
        text = content.decode("latin-1")
    return text.split("\f")


def document_pages(docs: DataFrame, extract: Callable[[bytes], list[str]] = text_pages) -> DataFrame:
    """Docs (content: binary) with pages (array of text) and page_error. extract turns one document's bytes into pages.

    Equal contents are extracted once: by their hash. What can't be extracted has null pages and the error's text.
    """

    @F.pandas_udf(T.StructType([T.StructField("pages", T.ArrayType(T.StringType())), T.StructField("page_error", T.StringType())]))
    def pages(s: pd.Series) -> pd.DataFrame:
        out = []
        for content in s:
            try:
                out.append((None, "no content") if content is None else (extract(content), None))
            except Exception as e:  # noqa: BLE001 - a broken document is a finding
                out.append((None, str(e)[:200] or type(e).__name__))
        return pd.DataFrame(out, columns=["pages", "page_error"])

    each = docs.select(F.sha2("content", 256).alias("_h"), "content").dropDuplicates(["_h"]).select("_h", pages("content").alias("_p"))
    out = docs.withColumn("_h2", F.sha2("content", 256)).join(each, F.col("_h2").eqNullSafe(F.col("_h")), "left")
    return out.select(*docs.columns, F.col("_p.pages").alias("pages"), F.col("_p.page_error").alias("page_error"))


def write_report(df: DataFrame, path: str, kind: str = "csv", summary: Mapping[str, object] | None = None) -> None:
    """A report's rows as csv, json or parquet, whole or not at all: the committer renames finished files and marks success.

    summary goes beside the rows as one line of JSON, in the same way.
    """
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(f"{path}/rows")
    if summary is not None:
        line = df.sparkSession.createDataFrame([(json.dumps(dict(summary), ensure_ascii=False, sort_keys=True),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{path}/summary")
