"""Coverage, integrity and domain checks (B, C, D, F, J, L, X13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions import keys, values
from granary.functions import text as tx
from granary.operators import checks as ck
from granary.operators import duplicates as dup
from granary.operators import relations as rel
from granary.operators import timeline as tl
from granary.session import table

from .base import COLLECTIONS, QUOTES, SOURCES, WITH_ALL, WITH_QUOTES, collections, query, quotes, sources

_SHA = "^[0-9a-f]{64}$"


@query(
    "b1_source_coverage_full",
    f"""{WITH_QUOTES} SELECT s.source_id, s.source, s.region_id, count(q.id) AS facts, min(quote_date) AS first_date, max(quote_date) AS last_date, count(DISTINCT q.collection_id) AS collections, count(DISTINCT q.product_id) AS products,
    count(DISTINCT q.quote_date) AS dates, count(*) FILTER (WHERE q.id IS NOT NULL AND coalesce(p_min, p_common, p_max) IS NULL) AS without_price, count(*) FILTER (WHERE q.id IS NOT NULL AND market_id IS NULL) AS without_market
    FROM sources s LEFT JOIN quotes q USING (source_id) GROUP BY ALL""",
)
def _(spark, sf):
    when = {"without_price": F.coalesce("p_min", "p_common", "p_max").isNull(), "without_market": F.col("market_id").isNull()}
    return rel.coverage(sources(spark, sf), "source_id", quotes(spark, sf), "source_id", "quote_date", {"collections": "collection_id", "products": "product_id", "dates": "quote_date"}, when)


@query("b2_missing_sources", f"WITH {SOURCES}, present AS (SELECT DISTINCT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0) SELECT source_id, source, CASE WHEN region_id < 3 THEN 'alert' ELSE 'info' END AS severity FROM sources WHERE source_id NOT IN (SELECT s_nationkey FROM present)")
def _(spark, sf):
    present = table(spark, sf, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_nationkey").cast("long").alias("source_id"))
    return rel.missing_members(sources(spark, sf), present, ["source_id"]).select("source_id", "source", F.when(F.col("region_id") < 3, "alert").otherwise("info").alias("severity"))


@query(
    "b3_source_coverage",
    f"""{WITH_ALL}, c AS (SELECT source_id, count(*) AS collections, count(*) FILTER (WHERE status = 'processed') AS processed, count(*) FILTER (WHERE status = 'duplicate') AS duplicated, count(*) FILTER (WHERE status LIKE '%error') AS errored FROM collections GROUP BY source_id),
    q AS (SELECT source_id, count(*) AS facts, min(quote_date) AS first_date, max(quote_date) AS last_date FROM quotes GROUP BY source_id)
    SELECT s.source, coalesce(facts, 0) AS facts, first_date, last_date, coalesce(collections, 0) AS collections, coalesce(processed, 0) AS processed, coalesce(duplicated, 0) AS duplicated, coalesce(errored, 0) AS errored
    FROM sources s LEFT JOIN c USING (source_id) LEFT JOIN q USING (source_id)""",
)
def _(spark, sf):
    status = F.col("status")
    per = collections(spark, sf).groupBy(F.col("source_id").alias("_s")).agg(
        F.count(F.lit(1)).alias("collections"), F.count_if(status == "processed").alias("processed"), F.count_if(status == "duplicate").alias("duplicated"), F.count_if(status.endswith("error")).alias("errored")
    )
    out = rel.coverage(sources(spark, sf), "source_id", quotes(spark, sf), "source_id", "quote_date")
    out = out.join(per, F.col("source_id") == F.col("_s"), "left")
    return out.select("source", "facts", "first_date", "last_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("collections", "processed", "duplicated", "errored")])


@query("b4_date_summary", f"{WITH_QUOTES} SELECT source, count(q.id) AS facts, min(quote_date) AS first_date, max(quote_date) AS last_date FROM sources LEFT JOIN quotes q USING (source_id) GROUP BY source")
def _(spark, sf):
    return rel.coverage(sources(spark, sf), "source_id", quotes(spark, sf), "source_id", "quote_date").select("source", "facts", "first_date", "last_date")


_TABLES = "region nation customer supplier part orders lineitem events documents labels conversations".split()


@query("b5_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _TABLES))
def _(spark, sf):
    from functools import reduce

    return reduce(DataFrame.union, [table(spark, sf, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in _TABLES])


@query("b6_latest_dates", f"{WITH_QUOTES}, wanted AS (SELECT * FROM (VALUES (0), (3), (7), (99)) AS w(source_id)) SELECT CAST(w.source_id AS BIGINT) AS source_id, max(quote_date) AS latest FROM wanted w LEFT JOIN quotes q ON q.source_id = w.source_id GROUP BY w.source_id")
def _(spark, sf):
    wanted = spark.createDataFrame([(0,), (3,), (7,), (99,)], "source_id long")
    return rel.latest_for(wanted, "source_id", quotes(spark, sf).select(F.col("source_id").alias("s"), "quote_date"), "s", "quote_date")


@query("b7_oldest_dates", f"{WITH_QUOTES} SELECT source_id, min(quote_date) AS oldest, min(quote_date) FILTER (WHERE category = 'Brand#11') AS oldest_in_category FROM quotes GROUP BY source_id")
def _(spark, sf):
    return quotes(spark, sf).groupBy("source_id").agg(F.min("quote_date").alias("oldest"), F.min(F.when(F.col("category") == "Brand#11", F.col("quote_date"))).alias("oldest_in_category"))


@query("b8_latest_id", f"WITH {QUOTES} SELECT max(id) AS latest_id, count(*) AS total FROM quotes")
def _(spark, sf):
    return quotes(spark, sf).agg(F.max("id").alias("latest_id"), F.count(F.lit(1)).alias("total"))


@query(
    "b9_collections_without_raw",
    f"{WITH_ALL} SELECT c.source_id, count(DISTINCT c.id) AS collections, count(q.id) AS quotes, min(c.processed_at) AS first_at, max(c.processed_at) AS last_at FROM collections c LEFT JOIN quotes q ON q.collection_id = c.id WHERE c.raw_path IS NULL GROUP BY c.source_id",
)
def _(spark, sf):
    per = quotes(spark, sf).groupBy("collection_id").agg(F.count(F.lit(1)).alias("n"))
    c = collections(spark, sf).filter("raw_path is null").join(per, F.col("id") == F.col("collection_id"), "left")
    return c.groupBy("source_id").agg(F.count(F.lit(1)).alias("collections"), F.coalesce(F.sum("n"), F.lit(0)).alias("quotes"), F.min("processed_at").alias("first_at"), F.max("processed_at").alias("last_at"))


_NULLS = "(CASE WHEN p_min IS NULL THEN 1 ELSE 0 END + CASE WHEN p_common IS NULL THEN 1 ELSE 0 END + CASE WHEN p_max IS NULL THEN 1 ELSE 0 END)"


@query("b10_partial_prices", f"WITH {QUOTES} SELECT source_id, CASE WHEN line = 7 THEN 'no_minimum' ELSE 'no_common' END AS reason, count(*) AS n FROM quotes WHERE {_NULLS} BETWEEN 1 AND 2 AND (line = 7 OR quantity % 5 = 0) GROUP BY ALL")
def _(spark, sf):
    q = quotes(spark, sf).filter(ck.partial_prices("p_min", "p_common", "p_max") & ((F.col("line") == 7) | (F.col("quantity") % 5 == 0)))
    return q.groupBy("source_id", F.when(F.col("line") == 7, "no_minimum").otherwise("no_common").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b11_key_formats",
    f"WITH {COLLECTIONS} SELECT source_id, count(*) AS total, count(*) FILTER (WHERE ok) AS current, count(*) FILTER (WHERE NOT ok) AS other, min(id) FILTER (WHERE ok) AS first_current, max(id) FILTER (WHERE NOT ok) AS last_other FROM (SELECT *, coalesce(regexp_matches(sha256, '{_SHA}'), false) AS ok FROM collections) GROUP BY source_id",
)
def _(spark, sf):
    ok = values.valid_sha256(F.col("sha256"))
    c = collections(spark, sf).withColumn("ok", ok)
    return c.groupBy("source_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("current"), F.count_if(~F.col("ok")).alias("other"), F.min(F.when(F.col("ok"), F.col("id"))).alias("first_current"), F.max(F.when(~F.col("ok"), F.col("id"))).alias("last_other"))


# --- integrity of collections and quotes -----------------------------------------------------------------------------


def bad_status():
    """Fields that don't go with the status, or times that are none."""
    f = F.col
    none = lambda x: f(x).isNull()
    there = lambda x: f(x).isNotNull()
    status = f("status")
    bad = (
        ((status == "duplicate") & (none("duplicate_of") | none("sha256")))
        | ((status != "duplicate") & there("duplicate_of"))
        | ((status == "processed") & (none("processed_at") | none("downloaded_at") | none("raw_path") | none("sha256")))
        | ((status == "pending") & (there("processed_at") | there("error")))
        | ((status == "download_error") & (there("downloaded_at") | none("error")))
        | ((status == "processing_error") & (none("downloaded_at") | none("error")))
        | F.coalesce(f("processed_at") < f("downloaded_at"), F.lit(False))
    )
    time = lambda x: values.valid_time(F.concat(f(x).cast("string"), F.lit("T00:00:00")))
    return bad | ~time("started_at") | (there("downloaded_at") & ~time("downloaded_at")) | (there("processed_at") & ~time("processed_at"))


_C1 = """status = 'duplicate' AND (duplicate_of IS NULL OR sha256 IS NULL) OR status <> 'duplicate' AND duplicate_of IS NOT NULL
 OR status = 'processed' AND (processed_at IS NULL OR downloaded_at IS NULL OR raw_path IS NULL OR sha256 IS NULL) OR status = 'pending' AND (processed_at IS NOT NULL OR error IS NOT NULL)
 OR status = 'download_error' AND (downloaded_at IS NOT NULL OR error IS NULL) OR status = 'processing_error' AND (downloaded_at IS NULL OR error IS NULL) OR coalesce(processed_at < downloaded_at, false) OR started_at IS NULL"""


def bad_duplicate(c: DataFrame) -> DataFrame:
    """A duplicate that names a missing original, another source's or hash's, another duplicate, or one without raw."""
    o = c.select(F.col("id").alias("o_id"), F.col("source_id").alias("o_source"), F.col("sha256").alias("o_sha"), F.col("status").alias("o_status"), F.col("raw_path").alias("o_path"))
    met = c.filter("status = 'duplicate'").join(o, F.col("duplicate_of") == F.col("o_id"), "left")
    bad = F.col("o_id").isNull() | (F.col("o_source") != F.col("source_id")) | ~F.col("o_sha").eqNullSafe(F.col("sha256")) | (F.col("o_status") == "duplicate") | F.col("o_path").isNull()
    return met.filter(bad)


_C4 = "collections c LEFT JOIN collections o ON o.id = c.duplicate_of WHERE c.status = 'duplicate' AND (o.id IS NULL OR o.source_id <> c.source_id OR o.sha256 IS DISTINCT FROM c.sha256 OR o.status = 'duplicate' OR o.raw_path IS NULL)"
_C8_KEY = ["collection_id", "market_id", "product_id", "presentation", "quote_date", "variety", "category", "alias", "p_min", "p_common", "p_max", "market_status"]


#: code, severity, problems in SQL with the occurrences n of each row
_RULES = [
    ("c1_status_fields", "error", f"SELECT 1 AS n FROM collections WHERE {_C1}"),
    ("c2_sha256", "error", f"SELECT 1 AS n FROM collections WHERE NOT regexp_matches(sha256, '{_SHA}')"),
    ("c3_canonical_documents", "error", "SELECT count(*) - 1 AS n FROM collections WHERE status <> 'duplicate' AND raw_path IS NOT NULL AND sha256 IS NOT NULL GROUP BY source_id, sha256 HAVING count(*) > 1"),
    ("c4_duplicate_reference", "error", f"SELECT 1 AS n FROM {_C4}"),
    ("c5_repeated_path", "error", "SELECT count(*) - 1 AS n FROM collections WHERE raw_path IS NOT NULL GROUP BY raw_path HAVING count(*) > 1"),
    ("c6_pending", "alert", "SELECT 1 AS n FROM collections WHERE status = 'pending'"),
    ("c7_quote_outside_processed", "error", "SELECT 1 AS n FROM quotes JOIN collections c ON c.id = collection_id WHERE c.status <> 'processed'"),
    ("c8_identical_in_collection", "error", f"SELECT count(*) - 1 AS n FROM quotes GROUP BY {', '.join(_C8_KEY)} HAVING count(*) > 1"),
    ("c9_values", "error", "SELECT 1 AS n FROM quotes WHERE quote_date IS NULL OR coalesce(p_min, p_common, p_max) IS NULL OR coalesce(p_min < 0, false) OR coalesce(p_common < 0, false) OR coalesce(p_max < 0, false)"),
]


def findings(spark, sf) -> DataFrame:
    """C1 to C9 over the collection model: one scan of collections and one of quotes for single rows, one aggregation a group check."""
    c, q = collections(spark, sf), quotes(spark, sf)
    severity = {code: s for code, s, _ in _RULES}
    rule = lambda code, holds: (code, severity[code], holds)
    rows = ck.row_checks(c, [rule("c1_status_fields", bad_status()), rule("c2_sha256", F.col("sha256").isNotNull() & ~values.valid_sha256(F.col("sha256"))), rule("c6_pending", F.col("status") == "pending")])
    dated = q.join(c.select(F.col("id").alias("c_id"), "status"), F.col("collection_id") == F.col("c_id"), "left")
    reject = ck.price_rejects("p_min", "p_common", "p_max", "quote_date").isNotNull()
    of_quotes = ck.row_checks(dated, [rule("c7_quote_outside_processed", F.col("status") != "processed"), rule("c9_values", reject)])
    excess = F.col("occurrences") - 1
    groups = {
        "c3_canonical_documents": (dup.duplicate_groups(c.filter("status <> 'duplicate' and raw_path is not null and sha256 is not null"), ["source_id", "sha256"]), excess),
        "c4_duplicate_reference": (bad_duplicate(c), None),
        "c5_repeated_path": (dup.duplicate_groups(c.filter("raw_path is not null"), ["raw_path"]), excess),
        "c8_identical_in_collection": (dup.duplicate_groups(q, _C8_KEY), excess),
    }
    return rows.unionByName(of_quotes).unionByName(ck.run_checks([ck.check(code, severity[code], *x) for code, x in groups.items()]))


_COUNT = " UNION ALL ".join(f"SELECT '{code}' AS code, '{severity}' AS severity, count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS occurrences FROM ({sql})" for code, severity, sql in _RULES)
_FINDINGS = f"{WITH_ALL}, findings AS ({_COUNT})"


@query("c_checks_run", f"{_FINDINGS} SELECT * FROM findings")
def _(spark, sf):
    return findings(spark, sf)


@query(
    "x13_verdict",
    f"{_FINDINGS}, n AS (SELECT count(*) FILTER (WHERE occurrences > 0 AND severity = 'error') AS errors, count(*) FILTER (WHERE occurrences > 0 AND severity = 'alert') AS alerts, count(*) FILTER (WHERE occurrences > 0 AND severity = 'info') AS infos FROM findings) SELECT *, CASE WHEN errors > 0 THEN 'inconsistent' WHEN alerts > 0 THEN 'consistent_with_alerts' ELSE 'consistent' END AS verdict FROM n",
)
def _(spark, sf):
    return ck.verdict(findings(spark, sf))


@query("c1_status_fields", f"WITH {COLLECTIONS} SELECT id, status FROM collections WHERE {_C1}")
def _(spark, sf):
    return collections(spark, sf).filter(bad_status()).select("id", "status")


@query("c4_duplicate_reference", f"WITH {COLLECTIONS} SELECT c.id, c.duplicate_of FROM {_C4}")
def _(spark, sf):
    return bad_duplicate(collections(spark, sf)).select("id", "duplicate_of")


@query(
    "c10_blank_texts",
    """SELECT doc_id AS id, col AS "column", problem FROM (SELECT doc_id, col, CASE WHEN trim(v) = '' THEN 'blank' WHEN instr(v, '|') > 0 THEN 'delimiter' END AS problem FROM (
    SELECT doc_id, 'lang' AS col, lang AS v FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents UNION ALL SELECT doc_id, 'text', text FROM documents)) WHERE problem IS NOT NULL""",
)
def _(spark, sf):
    return ck.text_problems(table(spark, sf, "documents"), "doc_id", ["lang", "source", "text"])


@query(
    "c11_invalid_complements",
    f"""{WITH_ALL}, k AS (SELECT id AS quote_id, CASE WHEN id % 4 = 0 THEN 'p_min' ELSE 'p_common' END AS field, CASE WHEN id % 6 = 0 THEN '1' END AS old_value, CASE WHEN id % 9 = 0 THEN ' ' WHEN id % 10 = 1 THEN '-3' ELSE CAST(p_common AS VARCHAR) END AS new_value, collection_id, p_common FROM quotes)
    SELECT quote_id FROM k LEFT JOIN collections c ON c.id = k.collection_id WHERE field <> 'p_common' OR old_value IS NOT NULL OR new_value IS NULL OR trim(new_value) = '' OR NOT coalesce(TRY_CAST(new_value AS DECIMAL(38,10)) >= 0, false)
    OR p_common IS NULL OR p_common IS DISTINCT FROM TRY_CAST(new_value AS DECIMAL(18,4)) OR c.status IS DISTINCT FROM 'processed'""",
)
def _(spark, sf):
    i = F.col("id")
    k = quotes(spark, sf).select(
        i.alias("quote_id"), F.when(i % 4 == 0, "p_min").otherwise("p_common").alias("field"), F.when(i % 6 == 0, "1").alias("old_value"),
        F.when(i % 9 == 0, " ").when(i % 10 == 1, "-3").otherwise(F.col("p_common").cast("string")).alias("new_value"), "collection_id", "p_common",
    )
    met = k.join(collections(spark, sf).select(F.col("id").alias("c_id"), "status"), F.col("collection_id") == F.col("c_id"), "left")
    v = F.col("new_value")
    bad = (F.col("field") != "p_common") | F.col("old_value").isNotNull() | v.isNull() | (F.trim(v) == "") | ~values.valid_amount(v) | F.col("p_common").isNull() | ~F.col("p_common").eqNullSafe(v.try_cast("decimal(18,4)")) | ~F.col("status").eqNullSafe(F.lit("processed"))
    return met.filter(bad).select("quote_id")


_STATE = """state AS (SELECT c_custkey AS id, c_nationkey AS source_id, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS category, CASE c_custkey % 5 WHEN 0 THEN 'paused' WHEN 1 THEN 'complete' WHEN 2 THEN 'failed' WHEN 3 THEN 'partial' ELSE 'odd' END AS status,
 CASE WHEN c_custkey % 7 <> 0 THEN DATE '2001-01-01' + CAST(c_custkey % 100 AS INT) END AS next_check, CAST(c_custkey % 4 AS INT) - 1 AS no_progress, CASE WHEN c_custkey % 11 = 0 THEN 'broken' END AS error FROM customer)"""


def _state(spark, sf):
    k = F.col("c_custkey")
    five = k % 5
    return table(spark, sf, "customer").select(
        k.alias("id"), F.col("c_nationkey").alias("source_id"), F.when(k % 3 != 0, F.col("c_mktsegment")).alias("category"),
        F.when(five == 0, "paused").when(five == 1, "complete").when(five == 2, "failed").when(five == 3, "partial").otherwise("odd").alias("status"),
        F.when(k % 7 != 0, F.date_add(F.lit("2001-01-01").cast("date"), (k % 100).cast("int"))).alias("next_check"), ((k % 4).cast("int") - 1).alias("no_progress"), F.when(k % 11 == 0, "broken").alias("error"),
    )


@query("c12_backfill_state", f"WITH {_STATE} SELECT id FROM state WHERE status NOT IN ('complete', 'paused', 'failed', 'partial') OR no_progress < 0 OR status = 'paused' AND next_check IS NULL OR status = 'failed' AND error IS NULL")
def _(spark, sf):
    s = F.col("status")
    bad = ~s.isin("complete", "paused", "failed", "partial") | (F.col("no_progress") < 0) | ((s == "paused") & F.col("next_check").isNull()) | ((s == "failed") & F.col("error").isNull())
    return _state(spark, sf).filter(bad).select("id")


@query("c13_backfill_scopes", f"WITH {_STATE} SELECT source_id, category, count(*) AS occurrences FROM state GROUP BY source_id, category HAVING count(*) > 1")
def _(spark, sf):
    return dup.duplicate_groups(_state(spark, sf), ["source_id", "category"])


@query(
    "c15_foreign_keys",
    f"""{WITH_ALL} SELECT 'quotes.collection' AS link, count(*) AS orphans FROM quotes WHERE collection_id IS NOT NULL AND collection_id NOT IN (SELECT id FROM collections)
    UNION ALL SELECT 'collections.duplicate_of', count(*) FROM collections WHERE duplicate_of IS NOT NULL AND duplicate_of NOT IN (SELECT id FROM collections)
    UNION ALL SELECT 'labels.document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def _(spark, sf):
    c = collections(spark, sf)
    links = [
        ("quotes.collection", rel.orphans(quotes(spark, sf), c, "collection_id", "id")), ("collections.duplicate_of", rel.orphans(c, c, "duplicate_of", "id")),
        ("labels.document", rel.orphans(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", "doc_id")),
    ]
    from functools import reduce

    return reduce(DataFrame.union, [df.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(n).alias("link"), "orphans") for n, df in links])


# --- keys and domain ------------------------------------------------------------------------------------------------


@query("d1_ownership", f"{WITH_ALL} SELECT q.id, q.source_id, c.source_id AS collection_source FROM quotes q JOIN collections c ON c.id = q.collection_id WHERE q.source_id IS DISTINCT FROM c.source_id")
def _(spark, sf):
    c = collections(spark, sf).select(F.col("id").alias("c_id"), F.col("source_id").alias("collection_source"))
    q = quotes(spark, sf).join(c, F.col("collection_id") == F.col("c_id"))
    return q.filter(~F.col("source_id").eqNullSafe(F.col("collection_source"))).select("id", "source_id", "collection_source")


_DEC = lambda c: f"coalesce(regexp_replace(CAST({c} AS VARCHAR), '\\.0+$|(\\.[0-9]*?)0+$', '\\1'), '')"
_TXT = lambda c: f"coalesce(CAST({c} AS VARCHAR), '')"
_IDENTITY = ["source_id", "market_id", "category", "alias", "presentation", "variety", "line", "quote_date"]
_IDENTITY_SQL = "sha256(concat_ws('|', " + ", ".join(_TXT(c) for c in _IDENTITY) + "))"


def _identity():
    return keys.identity_key(*[F.col(c) for c in _IDENTITY])


@query("d4_identity_keys", f"{WITH_QUOTES}, k AS (SELECT id, {_IDENTITY_SQL} AS identity, p_min, p_common, p_max, market_status FROM quotes) SELECT id, identity, sha256(concat_ws('|', identity, {_DEC('p_min')}, {_DEC('p_common')}, {_DEC('p_max')}, {_TXT('market_status')})) AS content FROM k")
def _(spark, sf):
    q = quotes(spark, sf).withColumn("identity", _identity())
    return q.select("id", "identity", keys.content_key(F.col("identity"), F.col("p_min"), F.col("p_common"), F.col("p_max"), F.col("market_status")).alias("content"))


@query("d5_collection_keys", f"WITH {COLLECTIONS} SELECT id, sha256(concat_ws('|', {_TXT('source_id')}, {_TXT('raw_path')}, {_TXT('sha256')}, 'u', {_TXT('coalesce(downloaded_at, processed_at)')})) AS key FROM collections")
def _(spark, sf):
    return collections(spark, sf).select("id", keys.collection_key(F.col("source_id"), F.col("raw_path"), F.col("sha256"), F.lit("u"), F.coalesce("downloaded_at", "processed_at")).alias("key"))


@query("d2_presentation_keys", f"{WITH_QUOTES} SELECT DISTINCT presentation, sha256(concat_ws('|', presentation, lower(presentation), 'kg', '', {_DEC('CAST(quantity AS DECIMAL(18,4))')}, '', '')) AS key, quantity FROM quotes WHERE presentation IS NOT NULL")
def _(spark, sf):
    p = F.col("presentation")
    none = F.lit(None).cast("string")
    key = keys.presentation_key(p, F.lower(p), F.lit("kg"), none, F.col("quantity").cast("decimal(18,4)"), F.lit(None).cast("decimal(18,4)"), none)
    return quotes(spark, sf).filter(p.isNotNull()).select("presentation", key.alias("key"), "quantity").distinct()


@query("d3_key_formats", f"WITH {COLLECTIONS} SELECT id, CASE WHEN sha256 IS NULL THEN 'missing' ELSE 'malformed' END AS problem FROM collections WHERE NOT coalesce(regexp_matches(sha256, '{_SHA}'), false)")
def _(spark, sf):
    s = F.col("sha256")
    return collections(spark, sf).filter(~values.valid_sha256(s)).select("id", F.when(s.isNull(), "missing").otherwise("malformed").alias("problem"))


@query("d6_alias_names", "SELECT c_custkey, c_name FROM customer WHERE trim(regexp_replace(lower(c_name), '\\s+', ' ', 'g')) <> c_name")
def _(spark, sf):
    return table(spark, sf, "customer").filter(tx.basic_name(F.col("c_name")) != F.col("c_name")).select("c_custkey", "c_name")


@query(
    "d7_objective_problems",
    f"""WITH {QUOTES} SELECT id, 'no_price' AS problem FROM quotes WHERE coalesce(p_min, p_common, p_max) IS NULL UNION ALL SELECT id, 'negative' FROM quotes WHERE p_min < 0 OR p_common < 0 OR p_max < 0
    UNION ALL SELECT id, 'no_market' FROM quotes WHERE market_id IS NULL UNION ALL SELECT id, 'no_category' FROM quotes WHERE category IS NULL""",
)
def _(spark, sf):
    rules = [("no_price", F.coalesce("p_min", "p_common", "p_max").isNull()), ("negative", (F.col("p_min") < 0) | (F.col("p_common") < 0) | (F.col("p_max") < 0)), ("no_market", F.col("market_id").isNull()), ("no_category", F.col("category").isNull())]
    return ck.each_problem(quotes(spark, sf), rules).select("id", "problem")


@query(
    "d8_suspicious_values",
    f"""WITH {QUOTES} SELECT id, 'zero_price' AS problem FROM quotes WHERE p_min = 0 OR p_common = 0 OR p_max = 0 UNION ALL SELECT id, 'incomplete' FROM quotes WHERE {_NULLS} BETWEEN 1 AND 2 AND NOT line = 7
    UNION ALL SELECT id, 'wide_range' FROM quotes WHERE p_min > 0 AND p_max / p_min > 100 UNION ALL SELECT id, 'future_date' FROM quotes WHERE quote_date > DATE '2001-06-01'""",
)
def _(spark, sf):
    return ck.each_problem(quotes(spark, sf), ck.suspicious("p_min", "p_common", "p_max", "quote_date", "2001-06-01", F.col("line") == 7)).select("id", "problem")


@query("d9_price_order", f"WITH {QUOTES}, x AS (SELECT id, p_min, p_common * (1 - 0.05 * (quantity % 3)) AS p_common, p_max FROM quotes) SELECT id, 'min_above_max' AS problem FROM x WHERE p_min > p_max UNION ALL SELECT id, 'common_below_min' FROM x WHERE p_common < p_min UNION ALL SELECT id, 'common_above_max' FROM x WHERE p_common > p_max")
def _(spark, sf):
    factor = F.lit(1).cast("decimal(4,2)") - F.lit("0.05").cast("decimal(4,2)") * (F.col("quantity") % 3).cast("decimal(4,0)")
    q = quotes(spark, sf).withColumn("p_common", F.col("p_common") * factor)
    return ck.each_problem(q, ck.price_order("p_min", "p_common", "p_max")).select("id", "problem")


#: Text columns that keys are made of, by table and its key.
_PARTS = {
    "nation": ("n_nationkey", ["n_name"]), "region": ("r_regionkey", ["r_name"]), "supplier": ("s_suppkey", ["s_name"]), "customer": ("c_custkey", ["c_name", "c_mktsegment"]), "part": ("p_partkey", ["p_name", "p_brand", "p_type"]),
    "orders": ("o_orderkey", ["o_orderstatus", "o_orderpriority"]), "events": ("event_id", ["event_type", "props"]), "documents": ("doc_id", ["lang", "source"]), "pages": ("page_id", ["url"]), "conversations": ("conv_id", ["role", "text"]), "benchmark": ("item_id", ["text"]),
}
_PARTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS tab, CAST({k} AS BIGINT) AS id, '{c}' AS col, {c} AS v FROM {t}" for t, (k, cs) in _PARTS.items() for c in cs)


@query("d10_key_parts", f"SELECT tab AS \"table\", id, col AS \"column\", problem FROM (SELECT *, CASE WHEN trim(v) = '' THEN 'blank' WHEN instr(v, '#') > 0 THEN 'delimiter' END AS problem FROM ({_PARTS_SQL})) WHERE problem IS NOT NULL")
def _(spark, sf):
    from functools import reduce

    one = lambda t, k, cs: ck.text_problems(table(spark, sf, t), k, cs, "#").select(F.lit(t).alias("table"), F.col("id").cast("long").alias("id"), "column", "problem")
    return reduce(DataFrame.unionByName, [one(t, k, cs) for t, (k, cs) in _PARTS.items()])


_D_RULES = [
    # code, severity, table, condition in SQL
    ("malformed_hash", "error", "collections", f"sha256 IS NOT NULL AND NOT regexp_matches(sha256, '{_SHA}')"), ("missing_hash", "alert", "collections", "sha256 IS NULL"), ("no_price", "error", "quotes", "coalesce(p_min, p_common, p_max) IS NULL"),
    ("negative_price", "error", "quotes", "coalesce(p_min < 0, false) OR coalesce(p_common < 0, false) OR coalesce(p_max < 0, false)"), ("min_above_max", "error", "quotes", "p_min > p_max"), ("common_below_min", "alert", "quotes", "p_common < p_min"),
    ("common_above_max", "alert", "quotes", "p_common > p_max"), ("wide_range", "alert", "quotes", "p_min > 0 AND p_max / p_min > 100"), ("no_market", "info", "quotes", "market_id IS NULL"), ("no_category", "info", "quotes", "category IS NULL"),
    ("identity_formula", "alert", "quotes", "market_id IS NULL AND variety IS NULL"),
]


@query("d11_domain_findings", f"WITH {QUOTES}, {COLLECTIONS} " + " UNION ALL ".join(f"SELECT '{code}' AS code, '{severity}' AS severity, count(*) AS groups, count(*) AS occurrences FROM {t} WHERE {sql}" for code, severity, t, sql in _D_RULES))
def _(spark, sf):
    s, c = F.col("sha256"), F.col
    # an identity written without its null parts has another key than the one by rule; both parts null make two keys
    written = keys.hash_values(*[F.col(x) for x in _IDENTITY if x not in ("market_id", "variety")])
    by_rule = F.when(c("market_id").isNull() & c("variety").isNull(), _identity()).otherwise(written)
    holds = {
        "malformed_hash": s.isNotNull() & ~values.valid_sha256(s), "missing_hash": s.isNull(), "no_price": F.coalesce("p_min", "p_common", "p_max").isNull(), "negative_price": F.least("p_min", "p_common", "p_max") < 0,
        "wide_range": (c("p_min") > 0) & (c("p_max") / c("p_min") > 100), "no_market": c("market_id").isNull(), "no_category": c("category").isNull(), "identity_formula": written != by_rule, **dict(ck.price_order("p_min", "p_common", "p_max")),
    }
    of = lambda t: [(code, severity, holds[code]) for code, severity, where, _ in _D_RULES if where == t]
    return ck.row_checks(collections(spark, sf), of("collections")).unionByName(ck.row_checks(quotes(spark, sf), of("quotes")))


@query("c14_metadata", "SELECT * FROM (VALUES ('index', true), ('marker', true), ('version', false)) t(name, holds)")
def _(spark, sf):
    # C14 on a table of properties: the store's version, a migration's marker, an index
    props = spark.createDataFrame([("user_version", "3"), ("marker:history", "done"), ("index:quotes_by_source", "")], "name string, value string")
    return ck.metadata_checks(props, {"version": ("user_version", "4"), "marker": ("marker:history", "done"), "index": ("index:quotes_by_source", None)})


@query("l9_report_order", f"WITH {QUOTES}, g AS (SELECT source_id, line, count(*) AS n, max(quote_date) AS last FROM quotes GROUP BY ALL) SELECT *, row_number() OVER (ORDER BY n DESC, last, source_id, line) AS place FROM g ORDER BY n DESC, last, source_id, line LIMIT 40")
def _(spark, sf):
    from pyspark.sql import Window

    g = quotes(spark, sf).groupBy("source_id", "line").agg(F.count(F.lit(1)).alias("n"), F.max("quote_date").alias("last"))
    order = [F.col("n").desc(), F.col("last"), F.col("source_id"), F.col("line")]
    top = g.orderBy(*order).limit(40)  # the report is a top list; its places are numbered within it
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))


@query("f1_f2_rejections", f"WITH {QUOTES} SELECT CASE WHEN quote_date IS NULL THEN 'missing_date' WHEN coalesce(p_min, p_common, p_max) IS NULL THEN 'no_price' WHEN coalesce(p_min < 0, false) OR coalesce(p_common < 0, false) OR coalesce(p_max < 0, false) THEN 'negative_price' END AS reason, count(*) AS n FROM quotes GROUP BY 1")
def _(spark, sf):
    return quotes(spark, sf).groupBy(ck.price_rejects("p_min", "p_common", "p_max", "quote_date").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_DOUBTFUL = "CASE WHEN line % 2 = 0 THEN -p_min ELSE p_min END"


@query(
    "f3_rejected_collections",
    f"""WITH {QUOTES}, d AS (SELECT collection_id, CASE WHEN line % 5 <> 3 THEN quote_date END AS quote_date, {_DOUBTFUL} AS p_min FROM quotes),
    r AS (SELECT collection_id, CASE WHEN quote_date IS NULL THEN 'missing_date' WHEN p_min IS NULL THEN 'no_price' WHEN p_min < 0 THEN 'negative_price' END AS reason FROM d)
    SELECT collection_id, count(*) AS rejected, count(*) FILTER (WHERE reason = 'missing_date') AS missing_date, count(*) FILTER (WHERE reason = 'no_price') AS no_price, count(*) FILTER (WHERE reason = 'negative_price') AS negative_price FROM r GROUP BY collection_id HAVING count(*) = count(reason)""",
)
def _(spark, sf):
    # prices of every second line are made negative, dates of every fifth are lost; a collection is rejected with all of its quotes
    q = quotes(spark, sf).select("collection_id", F.when(F.col("line") % 5 != 3, F.col("quote_date")).alias("quote_date"), F.when(F.col("line") % 2 == 0, -F.col("p_min")).otherwise(F.col("p_min")).alias("p_min"))
    reason = ck.price_rejects("p_min", "p_min", "p_min", "quote_date")
    n = lambda r: F.count_if(F.col("reason") == r).alias(r)
    g = q.withColumn("reason", reason).groupBy("collection_id").agg(F.count(F.lit(1)).alias("rejected"), F.count("reason").alias("with_reason"), n("missing_date"), n("no_price"), n("negative_price"))
    return g.filter("rejected = with_reason").drop("with_reason")


@query("f7_processed_raws", f"WITH {COLLECTIONS} SELECT id, raw_path FROM collections WHERE raw_path IN (SELECT raw_path FROM collections WHERE status = 'processed')")
def _(spark, sf):
    c = collections(spark, sf)
    return c.join(c.filter("status = 'processed'").select(F.col("raw_path").alias("p")), F.col("raw_path") == F.col("p"), "left_semi").select("id", "raw_path")


@query("j1_j2_wide_quotes", f"{WITH_ALL} SELECT q.id, s.source, r.r_name AS region, q.alias, q.category, q.market_id, m.s_name AS market, c.status, q.quote_date, q.p_common FROM quotes q JOIN sources s USING (source_id) LEFT JOIN region r ON r.r_regionkey = s.region_id LEFT JOIN supplier m ON m.s_suppkey = q.market_id JOIN collections c ON c.id = q.collection_id")
def _(spark, sf):
    # dimensions are small tables whose size the planner knows; it broadcasts what is below its threshold
    q = quotes(spark, sf).join(sources(spark, sf), "source_id")
    q = q.join(table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("region")), F.col("region_id") == F.col("r_regionkey"), "left")
    q = q.join(table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("market")), F.col("market_id") == F.col("s_suppkey"), "left")
    q = q.join(collections(spark, sf).select(F.col("id").alias("c_id"), "status"), F.col("collection_id") == F.col("c_id"))
    return q.select("id", "source", "region", "alias", "category", "market_id", "market", "status", "quote_date", "p_common")


@query("j4_null_safe_join", f"WITH {QUOTES}, g AS (SELECT category, variety, presentation, count(*) AS n FROM quotes GROUP BY ALL HAVING count(*) > 20) SELECT q.id, g.n FROM quotes q JOIN g ON q.category IS NOT DISTINCT FROM g.category AND q.variety IS NOT DISTINCT FROM g.variety AND q.presentation IS NOT DISTINCT FROM g.presentation")
def _(spark, sf):
    k = ["category", "variety", "presentation"]
    q = quotes(spark, sf)
    g = q.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).filter("n > 20")
    return q.join(g, rel.same(q, g, k)).select("id", "n")


@query("j12_unique_lookup", f"WITH {QUOTES} SELECT product_id, quote_date, min(id) AS id FROM quotes GROUP BY product_id, quote_date HAVING count(*) = 1")
def _(spark, sf):
    return rel.unique_lookup(quotes(spark, sf), ["product_id", "quote_date"], "id")


@query(
    "j15_set_algebra",
    f"WITH {QUOTES}, e AS (SELECT DISTINCT product_id, CAST(line AS BIGINT) AS line FROM quotes), p AS (SELECT p_partkey AS product_id, CAST(p_size % 9 AS BIGINT) AS line FROM part) SELECT coalesce(e.product_id, p.product_id) AS product_id, coalesce(e.line, p.line) AS line, e.line IS NOT NULL AS in_expected, p.line IS NOT NULL AS in_parsed, CASE WHEN e.line IS NULL THEN 'unexpected' WHEN p.line IS NULL THEN 'missing' ELSE 'both' END AS class FROM e FULL JOIN p ON e.product_id = p.product_id AND e.line = p.line",
)
def _(spark, sf):
    line = lambda c: c.cast("long").alias("line")
    expected = quotes(spark, sf).select("product_id", line(F.col("line")))
    return rel.set_algebra(expected, table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), line(F.col("p_size") % 9)), ["product_id", "line"])


@query("j16_latest_not_after", f"{WITH_QUOTES} SELECT s.source_id, max(quote_date) FILTER (WHERE quote_date <= DATE '1998-06-15') AS latest FROM sources s LEFT JOIN quotes USING (source_id) GROUP BY s.source_id")
def _(spark, sf):
    return rel.latest_for(sources(spark, sf).select("source_id"), "source_id", quotes(spark, sf).select(F.col("source_id").alias("s"), "quote_date"), "s", "quote_date", "1998-06-15")


@query(
    "j17_pair_by_rank",
    f"WITH {QUOTES}, x AS (SELECT id AS expected_id, product_id, CASE WHEN market_status = 'O' THEN 'N' ELSE variety END AS variety FROM quotes), e AS (SELECT *, row_number() OVER (PARTITION BY product_id, variety ORDER BY expected_id) AS position FROM x), s AS (SELECT id AS stored_id, product_id, variety, row_number() OVER (PARTITION BY product_id, variety ORDER BY id) AS position FROM quotes) SELECT expected_id, e.product_id, e.variety, e.position, stored_id, CASE WHEN stored_id IS NULL THEN 'insert' ELSE 'update' END AS action FROM e LEFT JOIN s ON e.product_id = s.product_id AND e.variety IS NOT DISTINCT FROM s.variety AND e.position = s.position",
)
def _(spark, sf):
    q = quotes(spark, sf)
    e = q.select(F.col("id").alias("expected_id"), "product_id", F.when(F.col("market_status") == "O", "N").otherwise(F.col("variety")).alias("variety"))
    return rel.pair_by_rank(q.select("id", "product_id", "variety"), e, ["product_id", "variety"], "id", "expected_id")


@query(
    "j18_first_evidence",
    f"WITH {COLLECTIONS}, e AS (SELECT sha256 AS digest, id AS evidence_id, started_at AS day FROM collections WHERE status <> 'pending' AND sha256 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY started_at, id) = 1) SELECT c.id, e.evidence_id, e.day FROM collections c LEFT JOIN e ON e.digest = c.sha256",
)
def _(spark, sf):
    c = collections(spark, sf)
    e = c.filter("status <> 'pending' and sha256 is not null").select("sha256", F.col("id").alias("evidence_id"), F.col("started_at").alias("day"))
    return rel.first_hit(c.select("id", "sha256"), e, "sha256", ["day", "evidence_id"]).select("id", "evidence_id", "day")


@query("l1_l3_samples", f"WITH {COLLECTIONS} SELECT status, id, count(*) OVER (PARTITION BY status) AS kind_rows, row_number() OVER (PARTITION BY status ORDER BY id) AS sample_no FROM collections QUALIFY sample_no <= 50")
def _(spark, sf):
    return ck.sample_by(collections(spark, sf).select("status", "id"), ["status"], ["id"], 50)


@query("l4_keyset_batch", f"WITH {QUOTES} SELECT id FROM quotes WHERE id > 3000000 ORDER BY id LIMIT 5000")
def _(spark, sf):
    return tl.incremental(quotes(spark, sf).select("id"), "id", 3_000_000).orderBy("id").limit(5000)

