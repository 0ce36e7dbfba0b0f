"""Streams: documents arrive once per (source, hash); tables are copied past a watermark (U5, U8, U9, 2.11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files of a folder as they come, oldest first."""
    return spark.readStream.schema(schema).format("parquet").load(path)


def once_per_document(stream: DataFrame, source: str, digest: str, at: str, late: str = "30 days") -> DataFrame:
    """U5 on a stream: the first of each (source, hash); state is dropped once the event time is `late` past."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([source, digest])


def daily_counts(stream: DataFrame, at: str, key: str, late: str = "2 days") -> DataFrame:
    """Rows of each key and day; a day is complete when the watermark passes it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("day"), key).agg(F.count(F.lit(1)).alias("n"))


def run_available(stream: DataFrame, out: str, state: str) -> None:
    """Writes what there is now to a folder of Parquet and stops; the state folder makes the next call go on from there."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).outputMode("append").start().awaitTermination()


def run_to_table(stream: DataFrame, name: str, state: str) -> DataFrame:
    """All groups of an aggregating stream over what there is now, as a table of the session; for results of few rows."""
    stream.writeStream.format("memory").queryName(name).option("checkpointLocation", state).trigger(availableNow=True).outputMode("complete").start().awaitTermination()
    return stream.sparkSession.table(name)


def sync(spark: SparkSession, source: DataFrame, name: str, id_col: str, target: str, marks: str, reference: bool = False) -> int:
    """Copies the rows past a table's watermark to target/name, then moves the watermark; reference tables are rewritten.

    Marks are one small JSON folder per table, written after the rows: a crash in between copies the rows again, so the batch
    goes to a folder named after its watermarks and overwrites itself. Returns the number of rows copied.
    """
    if reference:
        source.write.mode("overwrite").parquet(f"{target}/{name}")
        return source.count()
    try:
        last = spark.read.schema("last long").json(f"{marks}/{name}").first()["last"]
    except Exception as e:  # no mark yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    new = source if last is None else source.filter(F.col(id_col) > last)
    top = new.agg(F.max(id_col).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if not top["n"]:
        return 0
    new.filter(F.col(id_col) <= top["m"]).write.mode("overwrite").parquet(f"{target}/{name}/batch={top['m']}")
    spark.createDataFrame([(int(top["m"]),)], "last long").coalesce(1).write.mode("overwrite").json(f"{marks}/{name}")
    return top["n"]
