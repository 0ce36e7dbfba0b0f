"""Connected components of a graph by alternating stars, on DataFrames; nothing but a changed flag reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, looked_up


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every end of an edge (a, b); root is the least id of its component.

    Rounds go on until nothing changes; their number grows with the logarithm of the size of a component. A node's neighbours
    are reduced to their minimum before they move, and the minimum of a hub is sent to all tasks, so that its edges stay where
    they are. Edges from a node to itself or with a null end, and repeated ones, change nothing; no edges give no rows.
    """
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    u, v = F.col("u"), F.col("v")
    e = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(u != v).distinct())
    last = None
    total = e.count()
    while True:
        # every node's larger neighbours move to the least of its neighbourhood
        both = e.select(F.explode(F.array(pair(u, v), pair(v, u))).alias("e")).select("e.x", "e.y")
        least = both.groupBy("x").agg(F.min("y").alias("m"), F.count(F.lit(1)).alias("n")).select("x", F.least("x", "m").alias("m"), "n")
        big = looked_up(both, least, ["x"], "n", 2 * total).filter(F.col("y") > F.col("x")).select(F.col("y").alias("u"), F.col("m").alias("v"))
        e = durable(big.filter(u != v).distinct())
        # every node's smaller neighbours and itself move to the least of them
        least = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        met = looked_up(e, least, ["u"], "n", total).select(F.explode(F.array(pair(v, F.col("m")), pair(u, F.col("m")))).alias("e"))
        e = durable(met.select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).filter(u != v).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last, total = now, now[0]
    return e.select(F.explode(F.array(pair(u, v), pair(v, v))).alias("e")).select(F.col("e.x").alias("id"), F.col("e.y").alias("root")).distinct()
