"""Audit checks: tables of problems with numbers of occurrences. Checks of single rows of a table share one scan of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Check(NamedTuple):
    code: str
    severity: str  # error, alert or info
    problems: DataFrame
    #: Occurrences that one row stands for.
    occurrences: Column


def check(code: str, severity: str, problems: DataFrame, occurrences: Column | None = None) -> Check:
    return Check(code, severity, problems, F.lit(1) if occurrences is None else occurrences)


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """code, severity, groups (rows of the check's table), occurrences."""
    one = lambda c: c.problems.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(c.occurrences), F.lit(0)).cast("long").alias("occurrences")).select(F.lit(c.code).alias("code"), F.lit(c.severity).alias("severity"), "groups", "occurrences")
    return reduce(DataFrame.unionByName, [one(c) for c in checks])


def row_checks(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Findings, as of run_checks, of checks that look at single rows: (code, severity, condition; null is no problem)."""
    counts = df.agg(*[F.count_if(F.coalesce(holds, F.lit(False))).alias(code) for code, _, holds in rules])
    each = F.explode(F.array(*[F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.col(code).alias("groups"), F.col(code).alias("occurrences")) for code, severity, _ in rules]))
    return counts.select(each.alias("x")).select("x.*")


def verdict(findings: DataFrame) -> DataFrame:
    """Findings by severity, and inconsistent / consistent_with_alerts / consistent."""
    hit = F.col("occurrences") > 0
    out = findings.agg(*[F.count_if(hit & (F.col("severity") == s)).alias(f"{s}s") for s in ("error", "alert", "info")])
    return out.withColumn("verdict", F.when(F.col("errors") > 0, "inconsistent").when(F.col("alerts") > 0, "consistent_with_alerts").otherwise("consistent"))


def sample_by(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """L1, L3: up to n rows of each kind with the size of the kind; all are counted."""
    g = Window.partitionBy(*by)
    return df.withColumns({"kind_rows": F.count(F.lit(1)).over(g), "sample_no": F.row_number().over(g.orderBy(*order))}).filter(F.col("sample_no") <= n)


def each_problem(df: DataFrame, rules: Sequence[tuple[str, Column]], out: str = "problem") -> DataFrame:
    """A row for every rule that a row breaks (null is not broken), as UNION ALL of filters would give, in one scan."""
    return df.withColumn(out, F.explode(F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in rules]))))


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """the first rule that holds, null if none."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(list(rules)):
        reason = F.when(holds, F.lit(name)).otherwise(reason)
    return reason


def price_rejects(low: str, common: str, high: str, date: str) -> Column:
    prices = [F.col(c) for c in (low, common, high)]
    return first_reason(
        [("missing_date", F.col(date).isNull()), ("no_price", F.coalesce(*prices).isNull()), ("negative_price", reduce(lambda a, b: a | b, [F.coalesce(p < 0, F.lit(False)) for p in prices]))]
    )


def text_problems(df: DataFrame, id_col: str, columns: Sequence[str], delimiter: str = "|") -> DataFrame:
    """Id, column, problem (blank or delimiter) for every text column; one scan, unpivoted."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    out = df.select(F.col(id_col).alias("id"), pairs.alias("p")).select("id", "p.column", "p.value")
    problem = F.when(F.trim("value") == "", "blank").when(F.instr("value", delimiter) > 0, "delimiter")
    return out.withColumn("problem", problem).filter("problem is not null").select("id", "column", "problem")


def price_order(low: str, common: str, high: str) -> list[tuple[str, Column]]:
    """D9."""
    a, b, c = F.col(low), F.col(common), F.col(high)
    return [("min_above_max", a > c), ("common_below_min", b < a), ("common_above_max", b > c)]


def null_count(*columns: str) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def partial_prices(low: str, common: str, high: str) -> Column:
    """one or two of the three are null."""
    return null_count(low, common, high).between(1, 2)


def suspicious(low: str, common: str, high: str, date: str, today: str, exempt: Column) -> list[tuple[str, Column]]:
    """D8, with decimal division."""
    a, b, c = F.col(low), F.col(common), F.col(high)
    zero = reduce(lambda x, y: x | y, [F.coalesce(p == 0, F.lit(False)) for p in (a, b, c)])
    return [("zero_price", zero), ("incomplete", partial_prices(low, common, high) & ~exempt), ("wide_range", (a > 0) & (c / a > 100)), ("future_date", F.col(date) > F.lit(today).cast("date"))]


def metadata_checks(props: DataFrame, asked: dict[str, tuple[str, str | None]]) -> DataFrame:
    """C14: name, holds of properties (name, value) that must be there, with that value unless it is None."""
    want = props.sparkSession.createDataFrame([(k, name, value) for k, (name, value) in asked.items()], "check string, name string, want string")
    met = want.join(props, "name", "left")
    there = F.col("value").isNotNull() & (F.col("want").isNull() | (F.col("value") == F.col("want")))
    return met.select(F.col("check").alias("name"), there.alias("holds"))
