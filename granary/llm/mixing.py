"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source is cut into blocks by a hash of its documents' keys; the blocks are drawn in permuted order: as many whole passes
as the target holds, then blocks up to the rest, of which the last is cut between documents. The numbers of blocks drawn are
exact quotas; a tree over the output shards splits the vector of quotas at every node by a multivariate hypergeometric draw
seeded by the node. A shard so gets so many blocks of each source, disjoint runs of the permuted order, shuffled by a hash.

What a row needs to know of all that are a few thresholds of its source, so texts never move: only (source, block) sums do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, documents, durable, fresh, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: A target's most, as a multiple of its source's size.
MOST = 3.0
#: Documents of a block, about, and the most blocks of all sources together, but for one a source (blocks grow beyond that).
BLOCK_ROWS = 256
MOST_BLOCKS = 524_288
#: Words of a part of a shard that one task shuffles, about.
PART_WORDS = 500_000
SHARDS = 16
#: Above so many sources the thresholds are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 10_000
SEED = 17


class Source(NamedTuple):
    name: str | None
    size: int
    rows: int


def targets(sources: Sequence[Source], weights: Sequence[float] = WEIGHTS, most: float = MOST) -> list[float]:
    """The water-filling shares of the sum of sizes: least(most * size, level * weight), the level such that all is shared.

    sources stand in the order in which weights go around. The level is the largest of those that arise if the first k of
    the sources by most * size / weight stop at their most.
    """
    w = [weights[i % len(weights)] for i in range(len(sources))]
    stop = [most * s.size for s in sources]
    total, held, level = float(sum(s.size for s in sources)), 0.0, 0.0
    free = sum(w)
    for i in sorted(range(len(sources)), key=lambda i: (stop[i] / w[i], i)):
        level = max(level, (total - held) / free)
        held, free = held + stop[i], free - w[i]
    return [min(stop[i], level * w[i]) for i in range(len(sources))]


#: A prime, and multipliers below it, of the permutations that the tree draws by.
PRIME = 2**31 - 1
TIMES = (1_103_515_245, 1_664_525, 214_013)


def _drawn(draw: np.ndarray, node: int, seed: int) -> np.ndarray:
    """The place of each draw in the node's permutation: a bijection below PRIME, twice a line and its fifth power."""
    x = draw
    for step in (0, 1):
        x = (x * TIMES[step] + node * TIMES[2] + seed + step) % PRIME
        square = x * x % PRIME
        x = square * square % PRIME * x % PRIME
    return x


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """(shards, sources) counts of blocks: columns sum to quotas, rows to equal totals up to one.

    Each node permutes the blocks that it holds and gives its left half of the shards the first of them, as many as their
    share: how many of each source these are is a multivariate hypergeometric draw.
    """
    quotas = np.asarray(quotas, dtype=np.int64)
    source = np.repeat(np.arange(len(quotas)), quotas)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(node: int, first: int, last: int, held: np.ndarray) -> None:
        if last - first == 1:
            out[first] = np.bincount(source[held], minlength=len(quotas))
            return
        mid = (first + last) // 2
        order = held[np.argsort(_drawn(held, node, seed))]
        take = len(held) * (mid - first) // (last - first)
        split(2 * node, first, mid, order[:take])
        split(2 * node + 1, mid, last, order[take:])

    split(1, 0, shards, np.arange(quotas.sum()))
    return out


def _hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("\\N"))))


def _block(h: Column, blocks: Column) -> Column:
    return F.floor(F.conv(F.substring(h, 1, 8), 16, 10).cast("long") * blocks / 2**32).cast("long")


def _permuted(source: Column, block: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\\N")), F.lit(":"), block.cast("string")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, dict[str, str]]:
    """docs with more columns, and their names by role: size, source_size, target, draws.

    draws is an array of struct(copy, shard, shuffle), one for each time that the mix takes the document: none to `MOST`;
    sorting a shard's draws by shuffle is the local shuffle. Size is the number of words, 0 for null. Null is a source of
    its own, last in order. Rows with equal key stand together in the permuted order, a null key counts as \\N; at the cut
    they are taken or left together. A source of size 0 and an empty table are taken 0 times. The same rows, weights and
    seed give the same mix whatever the order and partitions of the input. Extra columns pass through whatever their names.
    The driver holds one row per source and shards thresholds for each.
    """
    size, ssize, target, draws, h, sid, info, block, perm = fresh(docs, "size", "source_size", "target", "draws", "hash", "sid", "info", "block", "perm")
    spark = docs.sparkSession
    src = col(source).cast("string")
    light = durable(docs.select(src.alias("source"), _hash(col(key), seed).alias("h"), word_count(col(text)).alias("size")))
    stats = [Source(r["source"], int(r["size"]), int(r["n"])) for r in light.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()]
    stats.sort(key=lambda s: (s.name is None, s.name or ""))
    goal = targets(stats, weights)
    whole = [min(int(MOST), int(g // s.size)) if s.size else 0 for s, g in zip(stats, goal, strict=True)]
    rest = [g - e * s.size if s.size else 0.0 for s, g, e in zip(stats, goal, whole, strict=True)]
    rows_of_all = sum(s.rows for s in stats)
    cuts = [min(max(1, math.floor(float(MOST_BLOCKS) * s.rows / rows_of_all)), math.ceil(s.rows / BLOCK_ROWS)) for s in stats]

    plan = spark.createDataFrame([(i, s.name, c, float(r)) for i, (s, c, r) in enumerate(zip(stats, cuts, rest, strict=True))], "sid long, source string, cuts long, rest double")
    if len(stats) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    placed = light.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("block", _block(F.col("h"), F.col("cuts")))
    sums = placed.groupBy("sid", "source", "cuts", "rest", "block").agg(F.sum("size").alias("n")).withColumn("p", _permuted(F.col("source"), F.col("block"), seed + 1))
    order = Window.partitionBy("sid").orderBy("p")
    ranked = durable(sums.select("sid", "block", "rest", "p", (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"), "n", (F.row_number().over(order) - 1).alias("rank")))
    # the block in which the rest ends; before it whole blocks are drawn, in it a prefix of its documents
    last = ranked.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
    inside = placed.join(last.select("sid", "block", "before", "p"), ["sid", "block"]).groupBy("sid", "before", "rest", "p", "h").agg(F.sum("size").alias("n"))
    run = Window.partitionBy("sid").orderBy("h")
    taken = inside.withColumn("end", F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("before") + F.col("end") - F.col("n") / 2 <= F.col("rest"))
    cut = {r["sid"]: (r["p"], r["h"]) for r in taken.groupBy("sid").agg(F.max("p").alias("p"), F.max("h").alias("h")).collect()}
    ends = {r["sid"]: r["p"] for r in last.select("sid", "p").collect()}
    counts = {r["sid"]: (r["all"], r["part"]) for r in ranked.groupBy("sid").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("before") < F.col("rest")).alias("part")).collect()}

    ids = range(len(stats))
    quotas = np.array([whole[i] * counts[i][0] + counts[i][1] for i in ids], dtype=np.int64)
    upto = np.cumsum(split_quotas(quotas, shards, seed), axis=0)[:-1] if len(stats) else np.zeros((0, 0), dtype=np.int64)
    # a boundary between shards stands before draw number d of its source: copy d // blocks, block of rank d % blocks
    asked = [(i, int(d) % counts[i][0], k, int(d) // counts[i][0]) for i in ids for k, d in enumerate(upto[:, i])]
    at = spark.createDataFrame(asked, "sid long, rank long, k int, copy int")
    bounds: dict[int, list] = {i: [] for i in ids}
    for r in at.join(ranked.select("sid", F.col("rank").cast("long").alias("rank"), "p"), ["sid", "rank"]).select("sid", "k", "copy", "p").collect():
        bounds[r["sid"]].append((r["k"], r["copy"], r["p"]))
    rows = []
    for i in ids:
        # blocks before `full` in permuted order are drawn once more; in block `cut` the documents up to a hash are
        p, upper = cut.get(i, (ends.get(i, "g" if rest[i] > 0 else ""), ""))
        rows.append((stats[i].name, stats[i].size, float(goal[i]), whole[i], cuts[i], p, upper, [(c, q) for _, c, q in sorted(bounds[i])]))
    table = spark.createDataFrame(rows, "source string, source_size long, target double, whole int, cuts long, p string, h string, bounds array<struct<copy:int,p:string>>")
    told = table.select(F.struct(*table.columns).alias(info))
    if len(stats) <= BROADCAST_SOURCES:
        told = F.broadcast(told)
    of = lambda name: F.col(info)[name]
    out = docs.withColumn(sid, src).join(told, F.col(sid).eqNullSafe(of("source")))
    out = out.withColumn(size, word_count(col(text))).withColumn(h, _hash(col(key), seed)).withColumn(perm, _permuted(F.col(sid), _block(F.col(h), of("cuts")), seed + 1))
    more = (F.col(perm) < of("p")) | ((F.col(perm) == of("p")) & (F.col(h) <= of("h")))
    copies = of("whole") + more.cast("int")
    draw = lambda c: F.struct(c.alias("copy"), F.size(F.filter(of("bounds"), lambda b: F.struct(b["copy"], b["p"]) <= F.struct(c, F.col(perm)))).alias("shard"), F.xxhash64(F.col(h), c).alias("shuffle"))
    out = out.withColumn(draws, F.when(copies > 0, F.transform(F.sequence(F.lit(0), copies - 1), draw)).otherwise(F.array().cast("array<struct<copy:int,shard:int,shuffle:bigint>>")))
    out = out.select(*[col(c) for c in docs.columns], size, of("source_size").alias(ssize), of("target").alias(target), draws)
    return out, {"size": size, "source_size": ssize, "target": target, "draws": draws}


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: docs' columns, a row for each draw, dealt out and shuffled by shard.

    A shard is cut into parts by a hash, as many as keep a part at some PART_WORDS words; a part is in one task and in the order of shuffle.
    """
    mixed, name = mix(docs, **options)
    draw, part = fresh(mixed, "draw", "part")
    # the words of a mix are as many as those of its documents
    words = docs.agg(F.sum(F.octet_length(col(options.get("text", "text"))))).first()[0] or 0
    shards = options.get("shards", SHARDS)
    parts = max(1, math.ceil(words / 6 / shards / PART_WORDS))
    rows = mixed.withColumn(draw, F.explode(name["draws"])).withColumn(part, F.pmod(F.xxhash64(F.col(draw)["shuffle"]), F.lit(parts)))
    rows = rows.repartition(shards * parts, F.col(draw)["shard"], F.col(part)).sortWithinPartitions(F.col(draw)["shard"], F.col(part), F.col(draw)["shuffle"])
    return rows.select(*[col(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, name = mix(documents(spark, sf_dir).select("doc_id", "source", "text"))
    size = F.col(name["size"])
    return mixed.select(
        "doc_id", size.alias("size"), F.col(name["source_size"]).alias("source_size"), F.col(name["target"]).alias("target"), (size * F.size(name["draws"])).cast("long").alias("taken"),
        # the output shard of each draw, in the order of copies
        F.array_join(F.transform(name["draws"], lambda d: d["shard"].cast("string")), ",").alias("shards"),
    )


def _level(level: int) -> str:
    """SQL of one level of the tree: draws(node) of the level, from those of the level above."""
    line = lambda x, step: f"({x} * {TIMES[step]} + node * {TIMES[2]} + {SEED + step}) % {PRIME}"
    power = lambda x: f"(({x} * {x} % {PRIME}) * ({x} * {x} % {PRIME}) % {PRIME} * {x} % {PRIME})"
    return f"""
), level{level} AS (
  SELECT sid, d, draw, 2 * node + CASE WHEN row_number() OVER (PARTITION BY node ORDER BY place) <= count(*) OVER (PARTITION BY node) // 2 THEN 0 ELSE 1 END AS node
  FROM (SELECT *, {power("y")} AS place FROM (SELECT *, {line(power("x"), 1)} AS y FROM (SELECT *, {line("draw", 0)} AS x FROM level{level - 1})))"""


SQL = f"""
WITH light AS (
  SELECT doc_id, source, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '\\N')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), stats AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM light GROUP BY source
), weighed AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END::DOUBLE AS w, {MOST}::DOUBLE * s AS stop FROM stats
), levels AS (
  SELECT *, (sum(s) OVER () - coalesce(sum(stop) OVER (ORDER BY stop / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY stop / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), goals AS (
  SELECT *, least(stop, max(level) OVER () * w) AS target FROM levels
), plan AS (
  SELECT *, CASE WHEN s > 0 THEN CAST(least({int(MOST)}, floor(target / s)) AS BIGINT) ELSE 0 END AS whole, CAST(least(greatest(1, floor({MOST_BLOCKS}.0::DOUBLE * n / sum(n) OVER ())), ceil(n / {BLOCK_ROWS}.0)) AS BIGINT) AS cuts FROM goals
), rests AS (
  SELECT *, CASE WHEN s > 0 THEN target - whole * s ELSE 0 END AS rest FROM plan
), placed AS (
  SELECT l.doc_id, l.h, l.size, r.*, CAST(floor(CAST('0x' || substr(l.h, 1, 8) AS BIGINT) * cuts / 4294967296.0) AS BIGINT) AS block
  FROM light l JOIN rests r ON l.source IS NOT DISTINCT FROM r.source
), sums AS (
  SELECT sid, block, any_value(rest) AS rest, md5('{SEED + 1}:' || coalesce(any_value(source), '\\N') || ':' || block) AS p, sum(size) AS n FROM placed GROUP BY sid, block
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY sid ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before,
         row_number() OVER (PARTITION BY sid ORDER BY p) - 1 AS rank, count(*) OVER (PARTITION BY sid) AS blocks FROM sums
), keyed AS (
  SELECT sid, block, h, sum(size) AS hn FROM placed GROUP BY sid, block, h
), marked AS (
  SELECT k.*, r.before, r.n, r.rest, sum(hn) OVER (PARTITION BY sid, block ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hend FROM keyed k JOIN ranked r USING (sid, block)
), more AS (
  SELECT sid, block, h, CASE WHEN before >= rest THEN 0 WHEN before + n < rest THEN 1 WHEN before + hend - hn / 2.0 <= rest THEN 1 ELSE 0 END AS extra FROM marked
), quotas AS (
  SELECT r.sid, any_value(r.blocks * w.whole) + count(*) FILTER (r.before < r.rest) AS quota FROM ranked r JOIN rests w USING (sid) GROUP BY r.sid
), level0 AS (
  SELECT sid, d, row_number() OVER (ORDER BY sid, d) - 1 AS draw, 1 AS node FROM (SELECT sid, unnest(range(quota)) AS d FROM quotas)
{"".join(_level(k) for k in range(1, SHARDS.bit_length())).lstrip()}
), dealt AS (
  SELECT sid, node - {SHARDS} AS shard, count(*) AS n FROM level{SHARDS.bit_length() - 1} GROUP BY ALL
), bounds AS (
  SELECT q.sid, r.shard, coalesce(sum(n) OVER (PARTITION BY q.sid ORDER BY r.shard), 0) AS upto
  FROM quotas q CROSS JOIN (SELECT unnest(range({SHARDS})) AS shard) r LEFT JOIN dealt d ON d.sid = q.sid AND d.shard = r.shard
), rows AS (
  SELECT p.*, m.extra, r.rank, r.blocks, row_number() OVER () AS row FROM placed p JOIN more m USING (sid, block, h) JOIN ranked r USING (sid, block)
), copies AS (
  SELECT row, sid, copy, copy * blocks + rank AS d FROM (SELECT row, sid, blocks, rank, unnest(range(whole + extra)) AS copy FROM rows)
), placed_copies AS (
  SELECT row, copy, (SELECT count(*) FROM bounds b WHERE b.sid = c.sid AND b.shard < {SHARDS - 1} AND b.upto <= c.d) AS shard FROM copies c
), listed AS (
  SELECT row, string_agg(CAST(shard AS VARCHAR), ',' ORDER BY copy) AS shards FROM placed_copies GROUP BY row
)
SELECT doc_id, size, s AS source_size, target, CAST(size * (whole + extra) AS BIGINT) AS taken, coalesce(shards, '') AS shards
FROM rows LEFT JOIN listed USING (row)
"""
