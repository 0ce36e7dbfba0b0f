"""Canonical exact digests of documents.

A text is normalised (NFKC, case folded, NFKC again, runs of white space as one space, trimmed) and hashed to 128 bits. Equal
hashes put texts into one bucket; where a bucket holds several, their canonical texts are compared byte by byte, and a bucket
of unequal ones (a collision) is told apart by a SHA-256 part in the fingerprint. Copies of a text collapse before they move.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, documents, durable, looked_up, trimmed

#: Rows that leave a worker at a time.
SLICE = 512
#: Lists of up to so many keys are broadcast (about 60 bytes each); longer ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


def canonical(text: str) -> str:
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(text: str) -> tuple[str, str]:
    """(bucket: 128-bit hash in hex, part of the SHA-256) of the canonical text."""
    import xxhash

    data = canonical(text).encode("utf-8", "surrogatepass")
    return xxhash.xxh3_128_hexdigest(data), hashlib.sha256(data).hexdigest()[:16]


def _added(df: DataFrame, fields: list[T.StructField], drop: list[str], function) -> DataFrame:
    """df without `drop`, with the string columns that function makes of a batch's columns (lists, by name)."""
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, *fields])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                new = [pa.array(v, type=pa.string()) for v in function(lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist())]  # noqa: B023
                old = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*old, *new], names=[f.name for f in schema.fields])

    return df.mapInArrow(trimmed(run), schema)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def collisions(texts: DataFrame, bucket: str, text: str) -> DataFrame:
    """The buckets whose texts differ in their canonical bytes. texts: rows of buckets with more than one row.

    Equal texts collapse in each task before the shuffle, so a large group of copies moves once per task.
    """
    whole = _added(texts.select(col(bucket).alias("bucket"), col(text).alias("text")), _strings("canonical"), ["text"], lambda c: [[canonical(t or "") for t in c("text")]])
    return whole.groupBy("bucket", "canonical").count().groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > 1).select("bucket")


def several(base: DataFrame, keys: DataFrame) -> DataFrame:
    """bucket, text of the rows of base (k, text) that keys (k, bucket) names; texts stay where they are if the list is short."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    keys = keys.select(F.col("k").alias("named"), "bucket")
    return base.join(keys, F.col("k").eqNullSafe(F.col("named"))).select("bucket", "text")


def _shared(rows: DataFrame) -> DataFrame:
    """k, bucket of the rows (k, bucket) of buckets with several."""
    counts = durable(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    return looked_up(rows.select("k", "bucket"), counts, ["bucket"], "n", rows.count()).select("k", "bucket").distinct()


def fingerprint(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, fingerprint of each row; null text counts as ''.

    Equal texts, and texts equal after folding, have equal fingerprints and no others do. Rows are kept as they are, repeated
    ones too; an empty table gives an empty table; other columns are ignored.
    """
    base = df.select(col(key).alias("k"), F.coalesce(col(text), F.lit("")).alias("text"))
    light = durable(_added(base.withColumn("n_chars", F.char_length("text").cast("long")), _strings("bucket", "part"), ["text"], lambda c: list(zip(*[digest(t) for t in c("text")], strict=True)) or [[], []]))
    clash = collisions(several(base, _shared(light)), "bucket", "text").withColumn("clash", F.lit(True))
    return light.join(clash, "bucket", "left").select(F.col("k").alias(key), "n_chars", F.when(F.col("clash"), F.concat_ws("-", "bucket", "part")).otherwise(F.col("bucket")).alias("fingerprint"))


def _edit(text: str, following: str) -> str:
    """text with its last quarter replaced by the start of the following text."""
    taken = len(text) // 4
    return text[: len(text) - taken] + following[:taken]


#: Columns of a row on its way: key, hash of the text, compressed text, code points, digest.
_ROW = "range int, k long, th long, z binary, n_chars long, bucket string, part string"
_OUT = "k long, n_chars long, edited_sha256 string, bucket string, part string, edited_bucket string, edited_part string, next_bucket string, next_part string, same_edited boolean, same_next boolean"


def _edited_row(row: dict, following: dict) -> tuple:
    import zstandard

    text, after = (zstandard.decompress(r["z"]).decode("utf-8", "surrogatepass") if r["n_chars"] else "" for r in (row, following))
    new = _edit(text, after)
    edited = digest(new)
    # equal hashes count for texts that are equal byte by byte only
    same = lambda bucket, other: bucket == row["bucket"] and canonical(other) == canonical(text)
    return (row["k"], row["n_chars"], hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), row["bucket"], row["part"], *edited, following["bucket"], following["part"], same(edited[0], new), same(following["bucket"], after))


def _table(rows: list[tuple], schema: T.StructType):
    import pyarrow as pa

    kinds = {"boolean": pa.bool_(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=kinds[f.dataType.simpleString()]) for k, f in enumerate(schema.fields)], names=schema.names)


def _joined(batches: list):
    """Small record batches as one."""
    import pyarrow as pa

    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


#: Stands for a null key in the order of keys.
NULL = -(2**63)


def places(keys: list[int | None], hashes: list[int], bounds: np.ndarray) -> list[int]:
    """The range of each row: the number of bounds below its key. A key that is several bounds is spread over as many ranges by its hashes, in their order."""
    k = np.array([NULL if x is None else x for x in keys], dtype=np.int64)
    low, high = np.searchsorted(bounds, k, side="left"), np.searchsorted(bounds, k, side="right")
    part = np.array([(h + 2**63) >> 32 for h in hashes], dtype=np.int64)
    return (low + ((part * np.maximum(high - low, 1)) >> 32) * (high > low)).tolist()


def compare_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: fingerprint of its text, of the edited text, and likeness to that and to the next row's.

    Edited text: the last floor(n_chars / 4) code points are replaced by the first as many (or all) of the next row's text
    in ascending order of the key (an integer), null keys first, ties by a hash of the text; after the last row comes the
    first. Rows equal in key and text count once in that order and get equal results. A single row is its own next. Null
    texts are empty.

    Rows go to ranges of the key once, with their texts compressed; a task walks along its ranges with one row in hand. A key
    that many rows share takes several ranges, by the hashes of its texts. Only
    the first and the last row of each range meet those of other ranges.
    """
    spark = df.sparkSession
    base = df.select(col(key).cast("long").alias("k"), F.coalesce(col(text), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = [i / ranges for i in range(1, ranges)]
    bounds = np.array(sorted(base.agg(F.percentile_approx(F.coalesce("k", F.lit(NULL)), share, 20 * ranges).alias("b")).first()["b"] or []), dtype=np.int64)
    row = T.StructType.fromDDL(_ROW)
    schema = T.StructType([*row.fields])

    def pack(batches: Iterator) -> Iterator:
        import zstandard

        small = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                ks, ths, texts = (c.to_pylist() for c in whole.slice(start, SLICE).columns)
                yield _table([(r, k, h, small.compress(t.encode("utf-8", "surrogatepass")), len(t), *digest(t)) for r, k, h, t in zip(places(ks, ths, bounds), ks, ths, texts, strict=True)], schema)

    packed = base.select("k", F.xxhash64("text").alias("th"), "text").mapInArrow(trimmed(pack), schema)
    dealt = packed.repartition("range").sortWithinPartitions("range", F.col("k").asc_nulls_first(), "th")
    walked = T.StructType([T.StructField("role", T.StringType()), *row.fields, *[f for f in T.StructType.fromDDL(_OUT).fields if f.name not in row.names]])
    names = row.names
    result = T.StructType.fromDDL(_OUT).names
    blank = len(walked.fields) - 1 - len(names)

    def walk(batches: Iterator) -> Iterator:
        # the last row, and how often it stands there
        held: dict | None = None
        times = 0

        def let_go(following: dict | None) -> Iterator:
            if following is None:
                done = ("last", *[held[n] for n in names], *[None] * blank)
            else:
                made = dict(zip(result, _edited_row(held, following), strict=True))
                done = ("done", *[made.get(n) if n not in ("range", "th", "z") else held["range"] if n == "range" else None for n in names], *[made[n] for n in result if n not in names])
            for start in range(0, times, SLICE):
                yield _table([done] * min(SLICE, times - start), walked)

        out: list = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and (held["k"], held["th"], held["range"]) == (r["k"], r["th"], r["range"]):
                    times += 1
                    continue
                inside = bool(held) and held["range"] == r["range"]
                if held:
                    out += let_go(r if inside else None)
                if not inside:
                    out.append(_table([("first", *[r[n] for n in names], *[None] * blank)], walked))
                held, times = r, 1
                if len(out) >= SLICE:
                    yield _joined(out)
                    out = []
        if held:
            out += let_go(None)
        if out:
            yield _joined(out)

    rows = durable(dealt.mapInArrow(trimmed(walk), walked))
    # the range after each: one row for every range that has rows, keys and texts aside
    present = rows.filter("role = 'first'").select("range").distinct()
    order = Window.orderBy("range")
    after = present.select("range", F.coalesce(F.lead("range").over(order), F.min("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("then"))
    last = rows.filter("role = 'last'").select("range", F.struct(*names).alias("row"))
    first = rows.filter("role = 'first'").select(F.col("range").alias("then"), F.struct(*names).alias("following"))
    meet = last.join(after, "range").join(first, "then").select("row", "following")
    end = T.StructType.fromDDL(_OUT)

    def edit(batches: Iterator) -> Iterator:
        for batch in batches:
            yield _table([_edited_row(r["row"], r["following"]) for r in batch.to_pylist()], end)

    out = rows.filter("role = 'done'").select(*end.names).union(meet.mapInArrow(trimmed(edit), end))
    out = durable(out)
    clash = durable(collisions(several(base, _shared(out)), "bucket", "text"))
    none = clash.isEmpty()
    for name in ("", "edited_", "next_"):
        mark = clash.select(F.col("bucket").alias(f"{name}bucket"), F.lit(True).alias("clash"))
        marked = out.withColumn("clash", F.lit(False)) if none else out.join(mark, f"{name}bucket", "left")
        apart = F.col("clash") if not name else F.col("clash") | ((F.col("bucket") == F.col(f"{name}bucket")) & ~F.col(f"same_{name[:-1]}"))
        out = marked.withColumn(f"{name}fingerprint", F.when(apart, F.concat_ws("-", f"{name}bucket", f"{name}part")).otherwise(F.col(f"{name}bucket"))).drop("clash")
    return out.select(F.col("k").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("same_edited").cast("double").alias("near_edited"), F.col("same_next").cast("double").alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir).select("doc_id", "text"))
