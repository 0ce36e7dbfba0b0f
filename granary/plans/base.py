"""Quotes, collections and sources as views of the driver tables, in Spark and in SQL, and the register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: The order that numbers the lines of an order; rows equal in all are alike, so ties don't matter.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    """One row per lineitem as a price quote. id is unique and grows with the order; some dimensions and prices are null."""
    lines = table(spark, sf, "lineitem")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    money = F.col("l_extendedprice").cast("decimal(12,2)")
    part = lambda c: F.col(c).cast("decimal(4,2)")
    price = lambda when, c: F.when(~when, c).cast("decimal(18,4)")
    quantity = F.col("l_quantity").cast("int")
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("source_id"))
    goods = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    one = F.lit(1).cast("decimal(4,2)")
    rows = lines.withColumn("id", F.col("l_orderkey") * 1000 + n).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(goods, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        "id", F.col("l_orderkey").alias("collection_id"), F.col("l_linenumber").alias("line"), "source_id", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("market_id"),
        F.col("l_partkey").alias("product_id"), F.col("p_name").alias("alias"), F.when(F.col("p_size") % 10 != 0, F.col("p_brand")).alias("category"), F.when(F.col("l_partkey") % 11 != 0, F.col("p_type")).alias("presentation"),
        F.col("l_shipdate").cast("date").alias("quote_date"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("variety"), F.col("l_linestatus").alias("market_status"),
        price(F.col("l_linenumber") == 7, money * (one - part("l_discount"))).alias("p_min"), price(quantity % 5 == 0, money).alias("p_common"), price(quantity % 25 == 0, money * (one + part("l_tax"))).alias("p_max"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


QUOTES = f"""quotes AS (
  SELECT l_orderkey * 1000 + n AS id, l_orderkey AS collection_id, l_linenumber AS line, CAST(s_nationkey AS BIGINT) AS source_id,
         CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS market_id, l_partkey AS product_id, p_name AS alias,
         CASE WHEN p_size % 10 <> 0 THEN p_brand END AS category, CASE WHEN l_partkey % 11 <> 0 THEN p_type END AS presentation,
         CAST(l_shipdate AS DATE) AS quote_date, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS variety, l_linestatus AS market_status,
         CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) END AS p_min,
         CASE WHEN CAST(l_quantity AS INT) % 5 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) END AS p_common,
         CASE WHEN CAST(l_quantity AS INT) % 25 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) END AS p_max,
         CAST(l_quantity AS INT) AS quantity
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS n FROM lineitem)
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
)"""


def collections(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order as a download attempt: status, path, hash, times; some rows break the rules on purpose."""
    o = table(spark, sf, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(key % 13 == 0, "duplicate").when(F.col("o_orderstatus") == "F", "processed").when(F.col("o_orderstatus") == "O", "pending").when(key % 2 == 0, "download_error").otherwise("processing_error")
    started = F.col("o_orderdate").cast("date")
    rows = o.withColumn("status", status).join(table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("source_id")), cust == F.col("c_custkey"))
    return rows.select(
        key.alias("id"), "source_id", F.when(F.col("status") == "duplicate", key - key % 26).alias("duplicate_of"),
        F.when((F.col("status") != "download_error") & (key % 29 != 0), F.concat(F.lit("raw/"), (key % 4000).cast("string"), F.lit(".html"))).alias("raw_path"),
        F.when(key % 17 == 0, F.concat(F.lit("X"), cust.cast("string"))).when(key % 19 != 0, F.sha2(cust.cast("string"), 256)).alias("sha256"),
        started.alias("started_at"), F.when(F.col("status") != "download_error", started).alias("downloaded_at"),
        F.when((F.col("status") == "processed") & (key % 23 != 0), F.date_add(started, 1)).alias("processed_at"), "status",
        F.when(F.col("status").endswith("error") & (key % 5 != 0), F.col("o_orderpriority")).alias("error"),
    )


COLLECTIONS = """collections AS (
  SELECT o_orderkey AS id, source_id, CASE WHEN status = 'duplicate' THEN o_orderkey - o_orderkey % 26 END AS duplicate_of,
         CASE WHEN status <> 'download_error' AND o_orderkey % 29 <> 0 THEN 'raw/' || (o_orderkey % 4000) || '.html' END AS raw_path,
         CASE WHEN o_orderkey % 17 = 0 THEN 'X' || o_custkey WHEN o_orderkey % 19 <> 0 THEN sha256(CAST(o_custkey AS VARCHAR)) END AS sha256,
         CAST(o_orderdate AS DATE) AS started_at, CASE WHEN status <> 'download_error' THEN CAST(o_orderdate AS DATE) END AS downloaded_at,
         CASE WHEN status = 'processed' AND o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) + 1 END AS processed_at, status,
         CASE WHEN status LIKE '%error' AND o_orderkey % 5 <> 0 THEN o_orderpriority END AS error
  FROM (SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN 'duplicate' WHEN o_orderstatus = 'F' THEN 'processed' WHEN o_orderstatus = 'O' THEN 'pending'
                       WHEN o_orderkey % 2 = 0 THEN 'download_error' ELSE 'processing_error' END AS status FROM orders)
  JOIN (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS source_id FROM customer) ON o_custkey = c_custkey
)"""


def sources(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("source_id"), F.col("n_name").alias("source"), F.col("n_regionkey").cast("long").alias("region_id"))


SOURCES = "sources AS (SELECT CAST(n_nationkey AS BIGINT) AS source_id, n_name AS source, CAST(n_regionkey AS BIGINT) AS region_id FROM nation)"
WITH_QUOTES = f"WITH {QUOTES}, {SOURCES}"
WITH_ALL = f"WITH {QUOTES}, {COLLECTIONS}, {SOURCES}"
#: The days on which assessments are made, so that results don't depend on the clock. Within the tables' range.
TODAY = "2001-12-31"
