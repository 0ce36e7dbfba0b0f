"""Queries of states, dimensions, corrections, reconciliation and invariants over the driver's tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import keys, sql, values
from granary.functions import text as tx
from granary.operators import checks as ck
from granary.operators import lifecycle as lc
from granary.operators import relations as rel
from granary.session import table
from granary.sources import tables

from .base import COLLECTIONS, QUOTES, collections, query, quotes
from .documents import each, golden, literal

# --- U4: states -----------------------------------------------------------------------------------------------------

_START = """start AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN 'pending' WHEN o_orderkey % 2 = 0 THEN 'processed' ELSE 'download_error' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN sha256(CAST(o_orderkey AS VARCHAR)) END AS sha256,
  CASE WHEN o_orderkey % 5 = 0 THEN 'raw/' || o_orderkey END AS raw_path, CAST(NULL AS BIGINT) AS downloaded_at, CAST(NULL AS BIGINT) AS processed_at, CAST(NULL AS BIGINT) AS duplicate_of, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 THEN 'old' END AS error FROM orders)"""
_EVENTS = """ev AS (SELECT l_orderkey AS id, n AS seq, CASE CAST(l_quantity AS INT) % 7 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'downloaded' WHEN 2 THEN 'processed' WHEN 3 THEN 'duplicate' WHEN 4 THEN 'download_error' WHEN 5 THEN 'processing_error' ELSE 'replace_raw' END AS event,
  CAST(l_partkey AS BIGINT) AS at, sha256(CAST(l_partkey AS VARCHAR)) AS sha256, 'raw/' || l_partkey AS raw_path, CAST(l_suppkey AS BIGINT) AS duplicate_of, l_shipmode AS error
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem))"""


@query(
    "u4_state_transitions",
    f"""WITH RECURSIVE {_START}, {_EVENTS.replace("l_shipmode", "l_returnflag")}, fold AS (
      SELECT *, CAST(0 AS BIGINT) AS seq FROM start
      UNION ALL
      SELECT f.id,
        CASE WHEN f.status = 'pending' AND e.event IN ('processed', 'duplicate', 'download_error', 'processing_error') THEN e.event ELSE f.status END,
        CASE WHEN f.status = 'pending' AND e.event IN ('downloaded', 'duplicate') THEN e.sha256 ELSE f.sha256 END,
        CASE WHEN f.status = 'pending' AND e.event = 'downloaded' THEN e.raw_path WHEN f.status = 'pending' AND e.event = 'duplicate' THEN NULL WHEN e.event = 'replace_raw' AND f.sha256 IS NOT NULL AND f.status IN ('pending', 'processed') THEN e.raw_path ELSE f.raw_path END,
        CASE WHEN f.status = 'pending' AND e.event IN ('downloaded', 'duplicate') THEN e.at ELSE f.downloaded_at END,
        CASE WHEN f.status = 'pending' AND e.event = 'processed' THEN e.at WHEN f.status = 'pending' AND e.event = 'duplicate' THEN NULL ELSE f.processed_at END,
        CASE WHEN f.status = 'pending' AND e.event = 'duplicate' THEN e.duplicate_of ELSE f.duplicate_of END,
        CASE WHEN f.status = 'pending' AND e.event IN ('processed', 'duplicate') THEN NULL WHEN f.status = 'pending' AND e.event IN ('download_error', 'processing_error') THEN e.error ELSE f.error END,
        e.seq
      FROM fold f JOIN ev e ON e.id = f.id AND e.seq = f.seq + 1
    ) SELECT id, arg_max(status, seq) AS status, max_by(coalesce(sha256, ''), seq) AS sha256, max_by(coalesce(raw_path, ''), seq) AS raw_path, max_by(coalesce(downloaded_at, -1), seq) AS downloaded_at, max_by(coalesce(processed_at, -1), seq) AS processed_at,
      max_by(coalesce(duplicate_of, -1), seq) AS duplicate_of, max_by(coalesce(error, ''), seq) AS error FROM fold GROUP BY id""",
)
def _(spark, sf):
    from pyspark.sql import Window

    k, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    none = lambda kind: F.lit(None).cast(kind)
    start = table(spark, sf, "orders").select(
        k.alias("id"), F.when(k % 3 != 0, "pending").when(k % 2 == 0, "processed").otherwise("download_error").alias("status"), F.when(k % 5 == 0, F.sha2(text("o_orderkey"), 256)).alias("sha256"),
        F.when(k % 5 == 0, F.concat(F.lit("raw/"), text("o_orderkey"))).alias("raw_path"), none("long").alias("downloaded_at"), none("long").alias("processed_at"), none("long").alias("duplicate_of"), F.when((k % 3 == 0) & (k % 2 == 1), "old").alias("error"),
    )
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("downloaded", "downloaded", "processed", "duplicate", "download_error", "processing_error", "replace_raw")]), F.col("l_quantity").cast("int") % 7 + 1)
    events = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), n.cast("long").alias("seq"), kind.alias("event"), F.col("l_partkey").cast("long").alias("at"), F.sha2(text("l_partkey"), 256).alias("sha256"),
        F.concat(F.lit("raw/"), text("l_partkey")).alias("raw_path"), F.col("l_suppkey").cast("long").alias("duplicate_of"), F.col("l_returnflag").alias("error"),
    )
    out = lc.apply_events(start, events)
    filled = {"sha256": "", "raw_path": "", "downloaded_at": -1, "processed_at": -1, "duplicate_of": -1, "error": ""}
    return out.fillna(filled)


# --- U1, U11, J7: dimensions ----------------------------------------------------------------------------------------


@query(
    "u1_upsert_dimension",
    """WITH old AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS category, CASE WHEN p_partkey % 4 = 0 THEN p_type END AS kind FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1 AND p_partkey % 2 = 0),
    arr AS (SELECT l_orderkey * 1000 + n AS ordinal, p_name AS name, CASE WHEN l_quantity % 2 = 0 THEN l_returnflag END AS category, CASE WHEN l_quantity % 5 = 0 THEN l_linestatus END AS kind
      FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) JOIN part ON p_partkey = l_partkey),
    f AS (SELECT name, min(ordinal) AS first, arg_min(category, ordinal) FILTER (WHERE category IS NOT NULL) AS category, arg_min(kind, ordinal) FILTER (WHERE kind IS NOT NULL) AS kind FROM arr GROUP BY name)
    SELECT o.id, o.name, coalesce(o.category, f.category) AS category, coalesce(o.kind, f.kind) AS kind FROM old o LEFT JOIN f USING (name)
    UNION ALL SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY first, name), name, category, kind FROM f WHERE name NOT IN (SELECT name FROM old)""",
)
def _(spark, sf):
    from pyspark.sql import Window

    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    first = F.row_number().over(Window.partitionBy("p_name").orderBy("p_partkey")) == 1
    old = p.withColumn("first", first).filter(F.col("first") & (key % 2 == 0)).select(key.cast("long").alias("id"), F.col("p_name").alias("name"), F.when(key % 3 == 0, F.col("p_brand")).alias("category"), F.when(key % 4 == 0, F.col("p_type")).alias("kind"))
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    lines = table(spark, sf, "lineitem").withColumn("ordinal", F.col("l_orderkey") * 1000 + n).join(p.select("p_partkey", "p_name"), F.col("l_partkey") == key)
    q = F.col("l_quantity")
    arriving = lines.select(F.col("p_name").alias("name"), "ordinal", F.when(q % 2 == 0, F.col("l_returnflag")).alias("category"), F.when(q % 5 == 0, F.col("l_linestatus")).alias("kind"))
    return lc.upsert_dimension(old, arriving, "name", "ordinal", ["category", "kind"])


@query("u11_backfill_reset", "SELECT c_custkey, c_nationkey AS source_id, c_mktsegment AS category FROM customer WHERE NOT (c_nationkey = 7 AND c_mktsegment = 'BUILDING')")
def _(spark, sf):
    state = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("source_id"), F.col("c_mktsegment").alias("category"))
    return lc.reset_backfill(state, F.lit(7), F.lit("BUILDING"))


@query(
    "j7_uncovered_collections",
    f"WITH {QUOTES}, {COLLECTIONS} SELECT count(*) AS uncovered, count(*) = 0 AS complete FROM collections c WHERE status = 'processed' AND NOT EXISTS (SELECT 1 FROM quotes q WHERE q.collection_id = c.id AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = q.market_id AND s.s_acctbal < 0))",
)
def _(spark, sf):
    good = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("market_id"))
    loose = quotes(spark, sf).join(good, "market_id", "left_anti").select(F.col("collection_id").alias("id"))
    left = collections(spark, sf).filter("status = 'processed'").join(loose, "id", "left_anti")
    return left.agg(F.count(F.lit(1)).alias("uncovered"), (F.count(F.lit(1)) == 0).alias("complete"))


# --- X7, U10 --------------------------------------------------------------------------------------------------------

_MEMBERS = f"""{QUOTES}, g AS (SELECT *, count(*) OVER (PARTITION BY source_id, line, market_status, quantity) AS size FROM quotes),
  members AS (SELECT source_id || '-' || line || '-' || market_status || '-' || quantity AS group_id, source_id AS source, id AS quote_id, collection_id, product_id AS key FROM g WHERE size > 1),
  scopes AS (SELECT o_orderkey AS collection_id, CASE WHEN o_orderkey % 11 = 0 THEN 'no_raw' WHEN o_orderkey % 13 = 0 THEN 'no_hash' WHEN o_orderkey % 17 = 0 THEN 'error' ELSE 'ok' END AS state FROM orders),
  parsed AS (SELECT l_orderkey AS collection_id, l_partkey AS key FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT l_orderkey, l_partkey + 1 FROM lineitem WHERE l_linenumber = 2 UNION ALL SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber = 3),
  made AS (SELECT collection_id, key, count(*) AS times FROM parsed GROUP BY ALL)"""


def _reconciled(spark, sf):
    from pyspark.sql import Window

    by = ["source_id", "line", "market_status", "quantity"]
    q = quotes(spark, sf).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy(*by))).filter("size > 1")
    members = q.select(F.concat_ws("-", *by).alias("group_id"), F.col("source_id").alias("source"), F.col("id").alias("quote_id"), "collection_id", F.col("product_id").alias("key"))
    k = F.col("o_orderkey")
    scopes = table(spark, sf, "orders").select(k.alias("collection_id"), F.when(k % 11 == 0, "no_raw").when(k % 13 == 0, "no_hash").when(k % 17 == 0, "error").otherwise("ok").alias("state"))
    lines = table(spark, sf, "lineitem")
    given = lambda df, key: df.select(F.col("l_orderkey").alias("collection_id"), key.alias("key"))
    part = F.col("l_partkey")
    parsed = given(lines.filter("l_returnflag <> 'R'"), part).union(given(lines.filter("l_linenumber = 2"), part + 1)).union(given(lines.filter("l_linenumber = 3"), part))
    return lc.reconcile(members, scopes, parsed)


@query(
    "x7_reconciled_groups",
    f"""WITH {_MEMBERS}, asked AS (SELECT DISTINCT group_id, source, m.collection_id, m.key, s.state, times FROM members m LEFT JOIN scopes s USING (collection_id) LEFT JOIN made p ON p.collection_id = m.collection_id AND p.key = m.key),
    f AS (SELECT *, CASE WHEN state = 'ok' AND times IS NOT NULL THEN 'reproduced' WHEN state = 'ok' THEN 'not_reproduced' ELSE coalesce(state, 'no_raw') END AS found FROM asked),
    r AS (SELECT group_id, source, count(DISTINCT collection_id) AS scopes, count(*) FILTER (WHERE found = 'reproduced') AS reproduced, count(*) FILTER (WHERE found = 'not_reproduced') AS not_reproduced, count(*) FILTER (WHERE found = 'no_raw') AS no_raw, count(*) FILTER (WHERE found = 'no_hash') AS no_hash, count(*) FILTER (WHERE found = 'error') AS errors, count(*) AS states FROM f GROUP BY ALL)
    SELECT group_id, source, scopes, reproduced, not_reproduced, no_raw, no_hash, errors, CASE WHEN reproduced = states THEN 'full' WHEN reproduced > 0 THEN 'partial' WHEN not_reproduced > 0 THEN 'not_reproduced' ELSE 'unverifiable' END AS class, (SELECT count(DISTINCT quote_id) FROM members m WHERE m.group_id = r.group_id) AS rows FROM r""",
)
def _(spark, sf):
    return _reconciled(spark, sf)[0]


@query(
    "x7_reconciled_sources",
    f"""WITH {_MEMBERS}, keys AS (SELECT DISTINCT source, m.collection_id, m.key, times FROM members m JOIN scopes s ON s.collection_id = m.collection_id AND s.state = 'ok' LEFT JOIN made p ON p.collection_id = m.collection_id AND p.key = m.key),
    per AS (SELECT source, collection_id, count(*) AS expected, count(times) AS matched FROM keys GROUP BY ALL), given AS (SELECT collection_id, count(*) AS n, sum(times - 1) AS repeats FROM made GROUP BY ALL)
    SELECT source, count(*) AS scopes, count(*) FILTER (WHERE matched = expected) AS "full", count(*) FILTER (WHERE matched > 0 AND matched < expected) AS partial, count(*) FILTER (WHERE matched = 0) AS none, CAST(sum(matched) AS BIGINT) AS reproduced, CAST(sum(expected - matched) AS BIGINT) AS lost,
      CAST(sum(coalesce(n, 0) - matched) AS BIGINT) AS extra, CAST(coalesce(sum(repeats), 0) AS BIGINT) AS repeats FROM per LEFT JOIN given USING (collection_id) GROUP BY source""",
)
def _(spark, sf):
    return _reconciled(spark, sf)[1]


_FIX = """ups AS (SELECT l_orderkey * 10 + l_linenumber AS quote_id, 'k' || (l_partkey % 97) || '-' || l_linenumber AS key FROM lineitem WHERE l_linenumber <= 2),
  rec AS (SELECT l_orderkey AS collection_id, 'c' || (l_orderkey % 50) AS collection_key, 'k' || (l_partkey % 97) || '-' || l_linenumber AS key FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4),
  q AS (SELECT p_partkey AS id, 'k' || p_partkey || '-' || (p_partkey % 3 + 1) AS key FROM part WHERE p_partkey < 97 UNION ALL SELECT min(quote_id), key FROM ups WHERE key LIKE 'k9%' GROUP BY key HAVING key NOT IN (SELECT 'k' || p_partkey || '-' || (p_partkey % 3 + 1) FROM part WHERE p_partkey < 97)),
  groups AS (SELECT key, min(quote_id) AS least, list(DISTINCT quote_id) AS ids FROM ups GROUP BY key), held AS (SELECT g.*, q.id AS holder, q.id IS NOT NULL AND NOT list_contains(ids, q.id) AS bad FROM groups g LEFT JOIN q USING (key)),
  chosen AS (SELECT key, coalesce(holder, least) AS canonical_id FROM held WHERE NOT bad)"""


def _correction(spark, sf):
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part").filter("p_partkey < 97")
    key = F.concat(F.lit("k"), (F.col("l_partkey") % 97).cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    ups = lines.filter("l_linenumber <= 2").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("quote_id"), key.alias("key"))
    rec = lines.filter("l_linenumber between 2 and 4").select(F.col("l_orderkey").alias("collection_id"), F.concat(F.lit("c"), (F.col("l_orderkey") % 50).cast("string")).alias("collection_key"), key.alias("key"))
    p = F.col("p_partkey")
    some = part.select(p.cast("long").alias("id"), F.concat(F.lit("k"), p.cast("string"), F.lit("-"), (p % 3 + 1).cast("string")).alias("key"))
    own = ups.filter("key like 'k9%'").groupBy("key").agg(F.min("quote_id").alias("id")).join(some.select("key"), "key", "left_anti").select("id", "key")
    return lc.plan_correction(ups, rec, some.union(own), "fix")


@query("u10_correction_updates", f"WITH {_FIX} SELECT quote_id, key, canonical_id, quote_id = canonical_id AS is_canonical FROM ups JOIN chosen USING (key)")
def _(spark, sf):
    return _correction(spark, sf).updates


@query("u10_correction_inserts", f"WITH {_FIX} SELECT key, min(collection_id) AS representative, count(*) AS occurrences FROM rec WHERE key NOT IN (SELECT key FROM groups) AND key NOT IN (SELECT key FROM q) GROUP BY key")
def _(spark, sf):
    return _correction(spark, sf).inserts


@query(
    "u10_correction_links",
    f"""WITH {_FIX}, o AS (SELECT *, row_number() OVER (PARTITION BY collection_key, key ORDER BY collection_id) AS ordinal FROM rec)
    SELECT key, collection_key_n, min(ordinal) AS first, max(ordinal) AS last, count(canonical_id) AS linked, count(DISTINCT provenance_key) AS keys, min(provenance_key) AS least_key FROM (
      SELECT o.key, o.collection_key AS collection_key_n, ordinal, canonical_id, 'fix:' || sha256('fix|' || collection_key || '|' || o.key || '|' || ordinal) AS provenance_key FROM o LEFT JOIN chosen c ON c.key = o.key) GROUP BY ALL""",
)
def _(spark, sf):
    links = _correction(spark, sf).links
    name = F.concat(F.lit("c"), (F.col("collection_id") % 50).cast("string"))
    return links.groupBy("key", name.alias("collection_key_n")).agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.count("canonical_id").alias("linked"), F.countDistinct("provenance_key").alias("keys"), F.min("provenance_key").alias("least_key"))


@query("u10_correction_conflicts", f"WITH {_FIX} SELECT key, holder FROM held WHERE bad UNION ALL SELECT DISTINCT r.key, q.id FROM rec r JOIN q ON q.key = r.key WHERE r.key NOT IN (SELECT key FROM groups)")
def _(spark, sf):
    return _correction(spark, sf).conflicts


# --- E11, X15: invariants -------------------------------------------------------------------------------------------


@query(
    "e11_marker_invariants",
    f"""WITH {QUOTES}, c AS (SELECT source_id, line, market_status, quantity, count(*) AS n, min(id) AS canonical FROM quotes GROUP BY ALL),
    m AS (SELECT (SELECT count(*) FROM quotes) AS source_quotes, (SELECT max(id) FROM quotes) AS max_id, count(*) AS result, max(canonical) AS result_max, count(*) FILTER (WHERE n > 1) AS dup_groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dup_occ FROM c)
    SELECT * FROM (SELECT unnest(['removed_is_excess', 'removed_is_difference', 'excess_is_repeats', 'result_max_within', 'quotes_now', 'coverage_hash', 'provenance_hash_now', 'no_duplicates']) AS name,
      unnest([source_quotes - result = dup_occ - dup_groups, true, true, result_max <= max_id, true, true, false, false]) AS holds FROM m)""",
)
def _(spark, sf):
    by = ["source_id", "line", "market_status", "quantity"]
    q = quotes(spark, sf)
    c = q.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("canonical"))
    # the groups carry all that the marker needs: one aggregation of them
    many = F.col("n") > 1
    m = c.agg(F.sum("n").alias("source_quotes"), F.count(F.lit(1)).alias("result_quotes"), F.max("canonical").alias("result_max_id"), F.count_if(many).alias("dup_groups"), F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("dup_occurrences"))
    m = m.crossJoin(q.agg(F.max("id").alias("checkpoint")))
    n = F.col
    zero, digest = F.lit(0), F.sha2(F.lit("stored"), 256)
    m = m.withColumns({
        "schema_version": F.lit(1), "source_max_id": n("checkpoint"), "removed_quotes": n("source_quotes") - n("result_quotes"), "source_logical": n("result_quotes"), "dup_excess": n("dup_occurrences") - n("dup_groups"), "date_buckets": zero,
        "provenance_rows": n("source_quotes"), "provenance_max": n("checkpoint"), "historical_rows": zero, "distinct_origins": n("source_quotes"), "canonical_targets": n("result_quotes"), "collections_preserved": zero, "coverage_hash": digest, "provenance_hash": digest,
        "now_quotes": n("result_quotes"), "now_max_id": n("result_max_id"), "now_provenance_rows": n("source_quotes"), "now_provenance_max": n("checkpoint"), "now_historical_rows": zero, "now_distinct_origins": n("source_quotes"), "now_canonical_targets": n("result_quotes"),
        "now_collections": zero, "now_orphan_quotes": zero, "now_orphan_collections": zero, "now_duplicate_groups": n("dup_groups"), "now_provenance_hash": F.sha2(F.lit("other"), 256),
    })
    shown = ["removed_is_excess", "removed_is_difference", "excess_is_repeats", "result_max_within", "quotes_now", "coverage_hash", "provenance_hash_now", "no_duplicates"]
    return lc.holds(m, lc.marker_rules()).filter(F.col("name").isin(*shown))


_SUMMARY = {"collections": 143, "unique_pdfs": 45, "stored_target_rows": 450, "parsed_target_occurrences": 572, "rows_to_update": 450, "existing_provenance_rows": 450, "existing_provenance_reassignments": 0, "recovered_occurrences": 122, "unique_collision_documents": 35, "unique_distinctions": 40, "logical_inserts": 40, "recovery_provenance_rows": 122, "canonical_key_updates": 400, "legacy_duplicate_keys_preserved_until_baseline": 50}
_RULE_NAMES = ["complete", "non_negative", "pdfs_within_collections", "occurrences_by_collections", "stored_are_updated", "updates_have_provenance", "provenance_stays", "recovered_is_deficit", "recovered_have_provenance", "collisions_within_pdfs", "distinctions_cover_collisions", "inserts_within_distinctions", "updates_by_role", *(f"floor_{f}" for f in lc.FLOORS)]
_BROKEN = {"1": ["occurrences_by_collections", "recovered_is_deficit", "floor_collections", "floor_recovered_occurrences"], "2": ["non_negative", "provenance_stays"], "3": ["complete", "non_negative", "inserts_within_distinctions", "floor_logical_inserts"]}


@golden("x15_recovery_invariants", "n name holds", [(n, name, "false" if name in _BROKEN.get(n, []) else "true") for n in "0123" for name in _RULE_NAMES])
def _(spark):
    rows = [_SUMMARY, _SUMMARY | {"collections": 142, "parsed_target_occurrences": 572}, _SUMMARY | {"existing_provenance_reassignments": -1}, _SUMMARY | {"logical_inserts": None}]
    rows[1] = rows[1] | {"rows_to_update": 450, "recovered_occurrences": 121, "recovery_provenance_rows": 121}
    fields = list(_SUMMARY)
    df = spark.createDataFrame([(k, *(r[f] for f in fields)) for k, r in enumerate(rows)], "n int, " + ", ".join(f"{f} long" for f in fields))
    return lc.holds(df, lc.recovery_rules(), ["n"])


# --- J14, K26, S11, P14, 2.12 ---------------------------------------------------------------------------------------


@golden(
    "j14_feed_markets", "source market feed",
    [("ceasa-pe", None, "CEASA/PE - RECIFE"), ("ceasa-pr", "maringa", "CEASA/PR - MARINGA"), ("ceasa-pr", "recife", None), ("ceasa-mg", "Grande  BH", "CEASAMINAS - BELO HORIZONTE"), ("ceasa-mg", None, None), ("ceasa-go", "maringa", None)],
)
def _(spark):
    rows = [("ceasa-pe", None), ("ceasa-pr", "maringa"), ("ceasa-pr", "recife"), ("ceasa-mg", "Grande  BH"), ("ceasa-mg", None), ("ceasa-go", "maringa")]
    return spark.createDataFrame(rows, "source string, market string").withColumn("feed", lc.feed_market(F.col("source"), F.col("market")))


each("k26_target_paths", lc.target_path, [(" raw/a/b.html ", "raw/a/b.html"), ("raw\\a\\b.html", "raw/a/b.html"), ("./raw//a/./b", "raw/a/b"), ("/raw/a/b", None), ("raw/../a/b", None), ("data/raw/a/b", None), ("raw/b", None), ("", None), (None, None)])
each("k26_old_target_paths", lambda c: lc.target_path(c, old=True), [("data/raw/a/b", "raw/a/b"), ("raw/a/b", "raw/a/b"), ("data/data/raw/a/b", None)])


@golden(
    "s11_remote_listing", "layer name size day reason",
    [("daily", "d-20260805.tar.gz", "5", "2026-08-05", None), ("daily", "x_2026-08-06.zip", "0", "2026-08-06", None), ("daily", None, "5", None, "missing_name"), ("daily", "d-20260805.zip", "-1", None, "invalid_size"), ("daily", "d-20260805.zip", None, None, "invalid_size"),
     ("weird", "d-20260805.zip", "5", None, "unknown_layer"), ("daily", "a/d-20260805.zip", "5", None, "unsafe_name"), ("daily", "notes.txt", "5", None, "unmanaged_name"), ("daily", "d-20261399.zip", "5", None, "invalid_date")],
)
def _(spark):
    rows = [("daily", "d-20260805.tar.gz", 5), ("daily", "x_2026-08-06.zip", 0), ("daily", None, 5), ("daily", "d-20260805.zip", -1), ("daily", "d-20260805.zip", None), ("weird", "d-20260805.zip", 5), ("daily", "a/d-20260805.zip", 5), ("daily", "notes.txt", 5), ("daily", "d-20261399.zip", 5)]
    return lc.listing(spark.createDataFrame(rows, "layer string, name string, size long"), ["staging", "daily", "weekly", "monthly"])


@query(
    "sql_functions",
    "SELECT c_custkey, regexp_replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '\\.0+$|(\\.[0-9]*?)0+$', '\\1') AS dec, sha256(c_name || '|' || c_mktsegment) AS hash, trim(regexp_replace(lower(c_name), '\\s+', ' ', 'g')) AS name, false AS is_hash, true AS is_date, c_acctbal >= 0 AS is_amount FROM customer",
)
def _(spark, sf):
    sql.register(spark)
    table(spark, sf, "customer").createOrReplaceTempView("granary_customers")
    return spark.sql(
        "SELECT c_custkey, decimal_key(CAST(c_acctbal AS DECIMAL(18,2))) AS dec, hash_values(array(c_name, c_mktsegment)) AS hash, basic_name(c_name) AS name, valid_sha256(c_name) AS is_hash, valid_iso_date('2024-02-29') AS is_date, valid_amount(CAST(c_acctbal AS STRING)) AS is_amount FROM granary_customers"
    )


@golden("udtf_table_rows", "doc row cells", [("0", "0", "a/b"), ("0", "1", "c/d"), ("1", "0", "x")])
def _(spark):
    sql.register(spark)
    literal(spark, ["<table><tr><td>a<td>b</tr><tr><td>c<td>d</tr></table>", "<table><tr><td>x</table>", None], "html").createOrReplaceTempView("granary_pages")
    return spark.sql("SELECT doc, t.row, concat_ws('/', t.cells) AS cells FROM granary_pages, LATERAL html_table_rows(html) t")


# --- wider checks ---------------------------------------------------------------------------------------------------

@query(
    "c10_blank_members",
    """SELECT tab AS "table", col AS "column", count(*) FILTER (WHERE trim(v, E' ') = '') AS blank, count(*) AS n FROM (
      SELECT 'nation' AS tab, 'n_name' AS col, n_name AS v FROM nation UNION ALL SELECT 'region', 'r_name', r_name FROM region UNION ALL SELECT 'supplier', 's_name', s_name FROM supplier
      UNION ALL SELECT 'customer', 'c_name', c_name FROM customer UNION ALL SELECT 'customer', 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT 'part', 'p_name', p_name FROM part UNION ALL SELECT 'part', 'p_brand', p_brand FROM part UNION ALL SELECT 'part', 'p_type', p_type FROM part
      UNION ALL SELECT 'documents', 'text', text FROM documents) GROUP BY ALL""",
)
def _(spark, sf):
    from functools import reduce

    asked = [("nation", ["n_name"]), ("region", ["r_name"]), ("supplier", ["s_name"]), ("customer", ["c_name", "c_mktsegment"]), ("part", ["p_name", "p_brand", "p_type"]), ("documents", ["text"])]
    out = []
    for name, columns in asked:  # one scan a table: all its columns' counts at once
        df = table(spark, sf, name)
        counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.trim(c) == "").alias(c) for c in columns])
        out.append(counts.select(F.lit(name).alias("table"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("blank"), F.col("n").alias("n")) for c in columns])).alias("x")).select("table", "x.*"))
    return reduce(lambda a, b: a.unionByName(b), out)
