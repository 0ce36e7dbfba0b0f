"""N-gram Jaccard join: MinHash banding, then verification on the full sets of word shingles.

Texts with equal shingle sets collapse to one representative first, so copies cost nothing more. Bands of minimum hashes
are shuffled; representatives that share a band are candidates. A pair is looked at in the first band that it shares only, so
each is verified and counted once. Small buckets give pairs; a large bucket is cut into chunks, and each pair of chunks is
one task that counts intersections by a matrix product and puts out counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, documents, durable, fresh, looked_up, trimmed
from .components import components
from .shingles import many, shingle_hashes

THRESHOLD = 0.8
#: Probability that a pair exactly at the threshold becomes a candidate.
RECALL = 0.9999
#: Share of pairs at half the threshold that may become candidates.
NOISE = 0.4
#: Buckets of up to so many representatives give pairs, larger ones go by chunks of so many, or of so many shingles.
SMALL = 32
CHUNK = 512
CHUNK_SHINGLES = 1_000_000
#: Id lists of up to so many rows are broadcast to filter texts (16 bytes each); longer ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: The same for lists of ids with hashes of texts (some 100 bytes each).
BROADCAST_MARKS = 150_000
SEED = 11
#: Stands for a null key.
NULL = -(2**63)
ROWS = 512


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, noise: float = NOISE) -> tuple[int, int]:
    """(bands, rows of a band): the fewest hashes whose candidates have that recall, and that noise at half the threshold."""
    for rows in range(1, 17):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))
        if 1 - (1 - (threshold / 2) ** rows) ** bands <= noise:
            return bands, rows
    raise ValueError("no band count has that recall and noise")


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(sets x bands) keys, as signed integers; sets must not be empty."""
    flip, times = _constants(bands * rows)
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.empty((len(sets), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(sets), b, dtype=np.uint64)
        for r in range(rows):
            k = b * rows + r
            key = key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((flat ^ flip[k]) * times[k], at)
        keys[:, b] = key ^ (key >> np.uint64(31))
    return keys.view(np.int64)


def sets_of(texts: list[bytes | None]) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(w)) for w in many(texts)]


def _batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            yield batch.column(0), batch.column(1).cast(pa.binary()).to_pylist(), *batch.columns[2:]


def sketched(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """id, mark (hash of the text), n (shingles), whole (128-bit hash of the set in hex), keys (one per band); rows without words have n 0."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for ids, texts, marks in _batches(batches):
            sets = sets_of(texts)
            full = [s for s in sets if len(s)]
            keys = sketches(full, bands, rows).ravel() if full else np.zeros(0, dtype=np.int64)
            ends = np.cumsum([0] + [bands * (len(s) > 0) for s in sets]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, marks, pa.array([len(s) for s in sets], type=pa.int64()), pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], type=pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
                names=["id", "mark", "n", "whole", "keys"],
            )

    return docs.select("id", "text", F.md5("text").alias("mark")).mapInArrow(trimmed(run), "id long, mark string, n long, whole string, keys array<long>")


def only(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of docs whose id is (left_semi) or isn't (left_anti) in ids; texts move only if the list is too long to send."""
    ids = ids.select("id").distinct()
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return docs.join(ids, "id", how)


def enough(both, x, y, threshold: float):
    """Whether sets of x and y members with so many in common reach the similarity; in integers, so exactly."""
    bound = Fraction(str(threshold))
    return bound.denominator * both >= bound.numerator * (x + y - both)


def alike(a: bytes, b: bytes, threshold: float) -> bool:
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    return bool(enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), threshold))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each node's component, for edges a-b: labels fall until nothing changes."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def chunk_links(threshold: float):
    """A function of the rows of two chunks of a bucket (or of one): per row its links, and its root among the rows."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "id"], ignore_index=True)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in rows["set"]]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        values, place, df = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.cumsum(df > 1) - 1  # a shingle of one row is in no intersection
        row = np.repeat(np.arange(len(sets)), sizes)
        keep = df[place] > 1
        both = np.zeros((len(sets), len(sets)), dtype=np.int64)
        r, c = row[keep], shared[place[keep]]
        order = np.argsort(c, kind="stable")
        r, c = r[order], c[order]
        for low in range(0, int(c[-1]) + 1 if len(c) else 0, 4096):
            a, b = np.searchsorted(c, [low, low + 4096])
            x = np.zeros((len(sets), 4096), dtype=np.float32)
            x[r[a:b], c[a:b] - low] = 1
            both += (x @ x.T).astype(np.int64)  # exact: at most 4,096
        link = enough(both, sizes[:, None], sizes[None, :], threshold)
        side, band = rows["side"].to_numpy(), int(rows["band"].iloc[0])
        keys = np.stack(rows["keys"].to_numpy())
        for b in range(band):
            link &= keys[:, b][:, None] != keys[:, b][None, :]
        link &= np.triu(np.ones_like(link), 1)
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            link &= side[:, None] != side[None, :]
        a, b = np.nonzero(link)
        weight = rows["copies"].to_numpy()
        n = np.bincount(a, weight[b], len(sets)) + np.bincount(b, weight[a], len(sets))
        ids = rows["id"].to_numpy()
        out = pd.DataFrame({"id": ids, "links": n.astype(np.int64), "root": ids[_roots(len(sets), a, b)]})
        return out[out["links"] > 0]

    return run


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """For each row: key, copy_of, class_id, n_links.

    copy_of is the least key among the rows with the same set of five-word shingles; n_links the number of other rows whose
    set has a Jaccard similarity of at least the threshold, copies included; class_id the least key that a chain of links
    reaches. Texts of one to four words are one shingle; null and blank texts have none and link to nothing. Keys are integers;
    a null key counts as one less than all others and comes back as null. Rows that repeat a key and a text are copies of
    each other; rows that repeat a key with other texts get the class of their own text. An empty table gives an empty table;
    other columns are ignored.
    """
    out = members(df, key, text, threshold)
    back = lambda c: F.nullif(F.coalesce(c, F.col("id")), F.lit(NULL))
    return out.select(F.nullif("id", F.lit(NULL)).alias(key), back(F.col("rep")).alias("copy_of"), back(F.col("class")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def members(df: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """For each row: id, mark (together they tell rows apart), rep, class, n_links, and group, which is one for each class.

    Classes of different texts may have the same least key, where keys repeat or are null. Rows without words have no group.
    """
    bands, rows = bands_for(threshold)
    docs = df.select(F.coalesce(col(key).cast("long"), F.lit(NULL)).alias("id"), col(text).alias("text"))
    light = durable(sketched(docs, bands, rows))
    # one representative for each set, named by the set's 128-bit hash, as keys may repeat
    named = durable(light.filter("n > 0").groupBy(F.col("whole").alias("node")).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("keys").alias("keys"), F.any_value("n").alias("n")))
    total = named.agg(F.count(F.lit(1)).alias("sets"), F.sum("copies").alias("rows")).first()
    exploded = named.select("node", "n", F.posexplode("keys").alias("band", "bucket"))
    counts = exploded.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).filter("size > 1").withColumn("rows", F.col("size"))
    member = durable(looked_up(exploded.drop("n"), counts, ["band", "bucket"], "rows", bands * total["sets"]))
    facts = named.select("node", "copies", "keys")
    inside = member.join(facts, "node")

    small = inside.filter(F.col("size") <= SMALL).groupBy("band", "bucket").agg(F.sort_array(F.collect_list(F.struct("node", "keys", "copies"))).alias("m"))
    one = small.select("band", "m", F.posexplode("m").alias("i", "x"))
    pairs = one.select("band", F.col("x").alias("x"), F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
    before = lambda c: F.slice(c, F.lit(1), F.col("band"))
    pairs = pairs.filter(~F.exists(F.arrays_zip(before(F.col("x.keys")).alias("p"), before(F.col("y.keys")).alias("q")), lambda z: z["p"] == z["q"]))
    pairs = durable(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.copies").alias("na"), F.col("y.copies").alias("nb")))

    # full sets, of representatives that have candidates
    wanted = member.select("node").distinct().join(named.select("node", F.col("rep").alias("id")), "node")
    sets = shingled(only(docs, wanted))
    sets = durable(sets.join(wanted.select("node"), "node").groupBy("node").agg(F.any_value("set").alias("set")))

    side = lambda name: sets.select(F.col("node").alias(name), F.col("set").alias(f"s{name}"))
    similar = F.pandas_udf(lambda x, y: pd.Series([alike(a, b, threshold) for a, b in zip(x, y, strict=True)], dtype="bool"), T.BooleanType())
    linked = durable(pairs.join(side("a"), "a").join(side("b"), "b").filter(similar("sa", "sb")).select("a", "b", "na", "nb"))

    chunks = F.greatest(F.ceil(F.col("size") / CHUNK), F.least(F.col("size"), F.ceil(F.col("shingles") / CHUNK_SHINGLES))).cast("int")
    chunk = inside.filter(F.col("size") > SMALL).withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")).cast("int"))
    met = chunk.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    met = met.select("node", "copies", "keys", "band", "bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), (F.col("chunk") > F.col("other")).cast("int").alias("side"))
    met = met.join(sets, "node").select(F.col("node").alias("id"), "copies", "keys", "band", "bucket", "i", "j", "side", "set")
    dense = durable(met.groupBy("band", "bucket", "i", "j").applyInPandas(chunk_links(threshold), "id string, links long, root string"))

    links = linked.select(F.col("a").alias("node"), F.col("nb").alias("links")).union(linked.select("b", "na")).union(dense.select("id", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    edges = linked.select("a", "b").union(dense.select("id", "root"))
    found = components(edges)
    owner = found.join(named.select(F.col("node").alias("id"), "rep"), "id")
    least = owner.groupBy("root").agg(F.min("rep").alias("class"), F.count(F.lit(1)).alias("nodes"))
    classed = looked_up(owner, least, ["root"], "nodes", total["sets"]).select(F.col("id").alias("node"), "root", "class")
    known = named.join(links, "node", "left").join(classed, "node", "left")
    known = durable(known.select(F.col("node").alias("whole"), "rep", F.coalesce("class", "rep").alias("class"), F.coalesce("root", "node").alias("group"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies"))
    names = ["id", "mark", "rep", "class", "n_links", "group"]
    out = looked_up(light.filter("whole is not null").select("id", "mark", "whole"), known, ["whole"], "copies", total["rows"] or 0).select(*names)
    return out.unionByName(light.filter("whole is null").select("id", "mark"), allowMissingColumns=True)


def shingled(docs: DataFrame) -> DataFrame:
    """node (the 128-bit hash of the set), set of each row with words."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        for _, texts in _batches(batches):
            sets = [s.tobytes() for s in sets_of(texts) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_hexdigest(s) for s in sets], type=pa.string()), pa.array(sets, type=pa.binary())], names=["node", "set"])

    return docs.select("id", "text").mapInArrow(trimmed(run), "node string, set binary")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """df with one row of each class, one that has its least key; rows without words are in no class and stay.

    Rows are told apart by key and text, so other texts of a key that repeats, or is null, stay or go by their own class.
    """
    found = durable(members(df, key, text, threshold).filter("group is not null").select("id", "mark", "group"))
    row = F.struct("id", "mark")
    kept = durable(found.groupBy("group").agg(F.min(row).alias("first"), F.max(row).alias("last"), F.count(F.lit(1)).alias("rows")).filter("rows > 1"))
    several = durable(looked_up(found, kept, ["group"], "rows", found.count()))
    gone = several.filter("first != last").filter(row != F.col("first")).select("id", "mark").distinct()
    place, mark = fresh(df, "id", "mark")
    rows = df.withColumn(place, F.coalesce(col(key).cast("long"), F.lit(NULL))).withColumn(mark, F.md5(col(text)))
    listed = lambda x: (F.broadcast(x) if x.limit(BROADCAST_MARKS + 1).count() <= BROADCAST_MARKS else x).toDF(place, mark)
    rows = rows.join(listed(durable(gone)), [place, mark], "left_anti")
    again = durable(several.filter(row == F.col("first")).groupBy("id", "mark").count().filter("count > 1").select("id", "mark"))
    if not again.isEmpty():
        twice = rows.join(listed(again), [place, mark], "left_semi").dropDuplicates([place, mark])
        rows = rows.join(listed(again), [place, mark], "left_anti").unionByName(twice)
    return rows.select(*[col(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))
