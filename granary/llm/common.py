"""What the training-data operators share: column helpers, the word definition, durable checkpoints."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that ends a word: U+0020 and U+0009 to U+000D. Fixed value.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """The top-level column of that exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, so that extra columns can't clash with working ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def words(text: Column) -> Column:
    """The runs of non-space characters of a text, in order; none for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


#: Rows, and bytes, of a batch between Spark and Python at most. Texts are long, and both sides hold a batch or two for each task.
ARROW_ROWS = 500
ARROW_BYTES = 4 << 20


def lean(spark: SparkSession) -> None:
    """Bounds the batches that the session's Python stages take from now on, unless they are bounded lower; Spark's default of 10,000 rows is made for narrow ones."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(name, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where it is unset, as in tests, a session on one machine uses a temporary folder; any other is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="granary-")
    return found.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """df written to the folder of spark.checkpoint.dir, so that losing an executor loses no rows."""
    spark = df.sparkSession
    lean(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def let_go(spark: SparkSession) -> None:
    """Has the driver clear what no plan needs any more, such as the shuffle files below a checkpoint, before the next large step."""
    import gc

    gc.collect()
    for _ in range(2):  # what the first pass frees may be all that held the rest
        spark.sparkContext._jvm.java.lang.System.gc()
        time.sleep(0.5)


def heaps_let_go(spark: SparkSession) -> None:
    """Has each executor collect its garbage, so that its JVM gives the heap it doesn't use back to the system.

    A heap that an earlier shuffle grew stays so until then, beside Python workers that need the room. As many tasks as cores, so
    that idle executors all get one; one without loses nothing but that.
    """
    n = spark.sparkContext.defaultParallelism
    collected = spark.range(0, n, 1, n).select(F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc")).alias("done"))
    collected.write.format("noop").mode("overwrite").save()


#: A key of more rows than these, and than a HOT_KEYS-th of all, is hot; there are fewer than HOT_KEYS such keys.
HOT_ROWS = 100_000
HOT_KEYS = 200_000


def looked_up(rows: DataFrame, table: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """rows joined with a table of one row a key, without its column that tells how many of the rows, total in all, have it.

    The table's rows of hot keys are sent to all tasks, as there are few, so no task gathers a hot key's rows. Keys aren't null.
    """
    bar = max(HOT_ROWS, total // HOT_KEYS)
    if total <= bar:
        return rows.join(table.drop(count), key)
    hot = durable(table.filter(F.col(count) > bar).drop(count))
    if hot.isEmpty():
        return rows.join(table.drop(count), key)
    cold = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(table.filter(F.col(count) <= bar).drop(count), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def _held() -> dict:
    """What this Python process holds from task to task."""
    import sys
    import types

    # functions travel to workers by value, so a module of theirs would be new for each task
    return vars(sys.modules.setdefault("granary_held", types.ModuleType("granary_held"))).setdefault("held", {})


def held(name: str, make):
    """make(), once in this Python process and as long as its tasks are of functions trimmed to keep that name."""
    if name not in _held():
        _held()[name] = make()
    return _held()[name]


def trimmed(run, keeps: str = ""):
    """The function of a mapInArrow that gives its worker's free memory back to the system at the end of each task.

    Workers stay for the tasks of other stages, and would hold the most that any of their tasks took. What tasks of other
    functions held for their next ones goes at the start, but for the name that this function keeps.
    """

    def wrapped(batches):
        import ctypes

        import pyarrow as pa

        for name in [n for n in _held() if n != keeps]:
            del _held()[name]
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim:
                trim(0)

    return wrapped


def map_arrow(df: DataFrame, run, added: Sequence[T.StructField], names: Sequence[str] | None = None, keeps: str = "") -> DataFrame:
    """df.mapInArrow(run) where run returns df's columns and then the added ones, in that order.

    Columns travel under plain names, as Spark can't pass on names with dots; names renames the result (df's and the added).
    """
    lean(df.sparkSession)
    plain = [f"c{i}" for i in range(len(df.columns))]
    fields = [T.StructField(n, f.dataType) for n, f in zip(plain, df.schema.fields, strict=True)]
    new = [T.StructField(f"a{i}", f.dataType) for i, f in enumerate(added)]
    return df.toDF(*plain).mapInArrow(trimmed(run, keeps), T.StructType([*fields, *new])).toDF(*(names or [*df.columns, *(f.name for f in added)]))


def extended(batch, *arrays):
    """A record batch with more columns, named as map_arrow expects."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *(f"a{i}" for i in range(len(arrays)))])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")
