"""Reports, late rows of streams, numbering without one task."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from granary.operators import delivery, relations, timeline
from granary.streaming import ingest


def test_reports_are_written_and_read_back(spark, tmp_path):
    rows = [(1, "go", "raw/a/b", "ab", "missing"), (2, "go", "raw/c/d", "cd", "found")]
    df = spark.createDataFrame(rows, "id long, source string, path string, sha256 string, status string")
    for _ in range(2):
        delivery.write_report(df, str(tmp_path / "r"), summary={"n": 2, "name": "março"})
    back = spark.read.csv(str(tmp_path / "r" / "rows"), header=True)
    assert [tuple(r) for r in delivery.report_rows(back).collect()] == [(1, "go", "raw/a/b", "ab")]
    assert json.loads(spark.read.text(str(tmp_path / "r" / "summary")).first()[0]) == {"n": 2, "name": "março"}
    with pytest.raises(ValueError):
        delivery.report_rows(df.drop("status"))


def test_late_and_unordered_rows(spark, tmp_path):
    """Rows within the watermark count whatever their order; later ones are dropped, and a document comes once."""
    place = str(tmp_path / "in")
    put = lambda n, rows: spark.createDataFrame(rows, "source string, digest string, at string").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{place}/{n}")
    schema = "source string, digest string, at timestamp"
    counts = lambda: ingest.daily_counts(ingest.raw_stream(spark, f"{place}/*", schema), "at", "source")
    go = lambda: ingest.run_available(counts(), str(tmp_path / "out"), str(tmp_path / "state"))
    put(1, [("a", "1", "2026-08-05 10:00:00"), ("a", "2", "2026-08-04 10:00:00"), ("a", "3", "2026-08-05 09:00:00")])
    go()
    put(2, [("a", "4", "2026-08-04 23:00:00"), ("a", "5", "2026-08-12 10:00:00")])
    go()
    put(3, [("a", "6", "2026-08-04 11:00:00"), ("a", "7", "2026-08-20 10:00:00")])
    go()
    got = {(r["day"]["start"].date(), r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(date(2026, 8, 4), 2), (date(2026, 8, 5), 2), (date(2026, 8, 12), 1)}


def test_numbered(spark):
    df = spark.createDataFrame([(k * 7 % 101,) for k in range(101)], "v long")
    got = {r["v"]: r["n"] for r in relations.numbered(df, F.floor(F.col("v") / 10), ["v"], "n").collect()}
    assert got == {v: v + 1 for v in range(101)}
    for k in (1, 3, 7, 101, 150):
        batches = sorted((r["v"], r["batch"]) for r in timeline.contiguous_batches(df, F.floor(F.col("v") / 10), ["v"], k).collect())
        sizes = [sum(b == i for _, b in batches) for i in range(1, k + 1)]
        assert [b for _, b in batches] == sorted(b for _, b in batches) and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_log_retention(spark):
    df = spark.createDataFrame([(n, f"2026-08-{day:02d}") for n, day in ((1, 5), (2, 4), (3, 4), (4, 1))], "id long, at string").withColumn("at", F.col("at").cast("date"))
    got = {r["id"]: (r["rank"], r["action"]) for r in timeline.log_retention(df, "at", 3, 2, "2026-08-05", ["id"]).collect()}
    assert got == {1: (1, "keep"), 2: (2, "keep"), 3: (3, "expired"), 4: (4, "expired")}
