"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a score -ln(u) / weight, u uniform from a hash of the pair; the record goes to the shard with
the least score. A shard that joins can only win records for itself, and a shard that leaves only gives up its own, so that
a change of the shard count moves the fewest records. All that is one projection, kept as a narrow table; slots need one
shuffle of it. Equal rows that fill a run of slots by themselves are dealt to several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, documents, durable, fresh

#: Hex digits of md5 that make u: 52 bits, exact in a double.
DIGITS = 13
#: Rows that one slot-numbering task sorts, about; and the equal rows from which on, beside a share of all, they are dealt to PARTS parts.
ROWS_PER_RUN = 20_000
TIES_SHARE = 100_000
PARTS = 256


def score(key: Column, shard: Column, weight: Column) -> Column:
    """The lower the better. key: text; weight above 0."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string"))), 1, DIGITS), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(16**DIGITS)) / weight


def key_text(key: str) -> Column:
    return F.coalesce(col(key).cast("string"), F.lit("\\N"))


def rendezvous(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(score, shard) of the winner among shards first, first + 1, ... with these weights."""
    if not weights or min(weights) <= 0:
        raise ValueError("a shard's weight must be above 0")
    table = F.array(*[F.lit(float(w)) for w in weights])
    each = F.transform(table, lambda w, i: F.struct(score(key, i + first, w).alias("score"), (i + first).alias("shard")))
    return F.array_min(each)


def assign(df: DataFrame, key: str, text: str, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """Each row's size, checksum, shard, slot within the shard, and shard once a further shard of grown_weight has joined.

    Returns key, size (UTF-8 bytes of text, 0 for null, plus 16), text_crc32, law ('key'), shard, slot, grown_shard.
    A null key counts as the key \\N. Null text has size 16 and the checksum of no bytes. Rows with one key share a shard;
    repeated rows get a slot each. Slots are gapless from 0 in the order of a hash of key and content, so they depend on
    neither the number of tasks nor the order of the input. An empty table gives no rows; other columns are ignored.
    """
    k, size, crc, order, run, won, part = fresh(df, "key", "size", "crc", "order", "run", "won", "part")
    body = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = df.count()
    runs = max(1, 2 ** math.ceil(math.log2(max(1.0, rows / (len(weights) * ROWS_PER_RUN)))))
    runs = min(runs, 16**6)
    base = df.select(col(key), key_text(key).alias(k), (F.octet_length(body) + 16).cast("long").alias(size), F.crc32(body).alias(crc))
    placed = base.select(
        col(key), col(k), col(size), col(crc), rendezvous(col(k), weights).alias(won), F.md5(F.concat(col(k), F.lit(":"), col(crc).cast("string"), F.lit(":"), col(size).cast("string"))).alias(order)
    ).select(
        col(key), size, crc, order, F.col(won)["shard"].alias("shard"),
        F.when(score(col(k), F.lit(len(weights)), F.lit(float(grown_weight))) < F.col(won)["score"], len(weights)).otherwise(F.col(won)["shard"]).cast("int").alias("grown_shard"),
        # the leading digits of the order: runs follow one another in that order
        F.floor(F.conv(F.substring(order, 1, 6), 16, 10).cast("long") * runs / 16**6).cast("int").alias(run),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int").alias(part),
    )
    placed = durable(placed)
    counts = placed.groupBy("shard", run).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = _numbered(placed, counts, run, order, part, max(ROWS_PER_RUN, rows // TIES_SHARE), [order, col(key)])
    return numbered.join(starts, ["shard", run]).select(
        col(key), col(size).alias("size"), col(crc).cast("long").alias("text_crc32"), F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("at") - 1).cast("long").alias("slot"), "grown_shard",
    )


def _numbered(placed: DataFrame, counts: DataFrame, run: str, order: str, part: str, bar: int, by: list) -> DataFrame:
    """placed with `at`: 1, 2, ... within each run in that order. Orders of more than bar rows are numbered part by part."""
    where = ["shard", run]
    plain = lambda df: df.withColumn("at", F.row_number().over(Window.partitionBy(*where).orderBy(*by)))
    big = counts.filter(F.col("n") > 4 * bar).select(*where)
    if big.isEmpty():
        return plain(placed)
    ties = durable(placed.join(F.broadcast(big), where).groupBy(*where, order).agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > bar))
    if ties.isEmpty():
        return plain(placed)
    # rows of ties with a lower order, of the run's few
    lists = F.broadcast(ties.groupBy(*where).agg(F.collect_list(F.struct(F.col(order).alias("o"), "m")).alias("ties")))
    before = F.aggregate(F.filter(F.coalesce("ties", F.array().cast("array<struct<o:string,m:bigint>>")), lambda t: t["o"] < F.col(order)), F.lit(0).cast("long"), lambda x, t: x + t["m"])
    calm = placed.join(F.broadcast(ties.select(*where, order)), [*where, order], "left_anti")
    out = plain(calm).join(lists, where, "left").withColumn("at", F.col("at") + before).drop("ties")
    below = calm.select(*where, F.col(order).alias("mine")).join(F.broadcast(ties), where).filter(F.col("mine") < F.col(order)).groupBy(*where, order).agg(F.count(F.lit(1)).alias("below"))
    equal = placed.join(F.broadcast(ties.select(*where, order)), [*where, order], "left_semi")
    parts = equal.groupBy(*where, order, part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*where, order).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begin = parts.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    begin = begin.join(below, [*where, order], "left").join(lists, where).withColumn("begin", F.col("begin") + F.coalesce("below", F.lit(0)) + before).drop("below", "ties")
    inside = equal.withColumn("at", F.row_number().over(Window.partitionBy(*where, order, part).orderBy(F.lit(0))))
    dealt = inside.join(begin, [*where, order, part]).withColumn("at", F.col("at") + F.col("begin")).drop("begin")
    return out.unionByName(dealt)


SHARDS = 40


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir), "doc_id", "text", [1.0] * SHARDS)


SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, b)) AS t
), base AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(CAST(doc_id AS VARCHAR), '\\N') AS k FROM documents
), sized AS (
  SELECT doc_id, k, CAST(octet_length(encode(body)) + 16 AS BIGINT) AS size,
         xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS text_crc32
  FROM base, crc_table
), scored AS (
  SELECT doc_id, k, s, -ln((CAST('0x' || substr(md5(k || ':' || s), 1, {DIGITS}) AS BIGINT) + 0.5) / {16**DIGITS}.0::DOUBLE) AS score
  FROM (SELECT DISTINCT doc_id, k FROM base), range({SHARDS + 1}) AS r(s)
), won AS (
  SELECT doc_id, k, arg_min(s, score) FILTER (WHERE s < {SHARDS}) AS shard, arg_min(s, score) AS grown FROM scored GROUP BY doc_id, k
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(k || ':' || text_crc32 || ':' || size), doc_id) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM sized JOIN won USING (doc_id, k)
"""
