"""Time, health, gate, backfill, retention, complement, reports, scalars (W4-W6, X, K, U)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.functions import keys, values
from granary.functions import text as tx
from granary.operators import complement as cp
from granary.operators import raw, reporting
from granary.operators import timeline as tl
from granary.session import table

from .base import COLLECTIONS, QUOTES, TODAY, WITH_QUOTES, collections, query, quotes, sources


@query("w4_gaps_inclusive", f"WITH {QUOTES}, d AS (SELECT DISTINCT source_id, quote_date FROM quotes WHERE quote_date IS NOT NULL), g AS (SELECT *, lag(quote_date) OVER (PARTITION BY source_id ORDER BY quote_date) AS previous FROM d) SELECT *, CAST(quote_date - previous AS BIGINT) AS gap_days FROM g WHERE quote_date - previous >= 3")
def _(spark, sf):
    return tl.date_gaps(quotes(spark, sf), ["source_id"], "quote_date", 3)


@query("w5_gaps_exclusive", f"WITH {QUOTES}, d AS (SELECT DISTINCT source_id, market_id, category, quote_date FROM quotes), g AS (SELECT *, lag(quote_date) OVER (PARTITION BY source_id, market_id, category ORDER BY quote_date) AS previous FROM d) SELECT *, CAST(quote_date - previous AS BIGINT) - 1 AS gap_days FROM g WHERE quote_date - previous - 1 >= 14")
def _(spark, sf):
    return tl.date_gaps(quotes(spark, sf), ["source_id", "market_id", "category"], "quote_date", 14, inclusive=False)


@query("w6_carry_forward", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS asked FROM conversations")
def _(spark, sf):
    c = table(spark, sf, "conversations")
    upto = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return c.select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.md5("text")), ignorenulls=True).over(upto).alias("asked"))


_FRESH = f"""{WITH_QUOTES}, latest AS (SELECT s.source_id, s.region_id, max(quote_date) FILTER (WHERE s.source_id % 6 <> 5) AS latest FROM sources s LEFT JOIN quotes USING (source_id) GROUP BY ALL),
limits AS (SELECT *, CASE WHEN region_id <> 4 THEN 25 + CAST(source_id AS INT) END AS most FROM latest),
fresh AS (SELECT source_id, latest, CAST(DATE '{TODAY}' - latest AS BIGINT) AS age_days, CASE WHEN latest IS NULL THEN 'no_data' WHEN DATE '{TODAY}' < latest THEN 'future' WHEN most IS NULL THEN 'not_configured' WHEN DATE '{TODAY}' - latest <= most THEN 'current' ELSE 'stale' END AS freshness FROM limits)"""


def _fresh(spark, sf):
    per = quotes(spark, sf).groupBy(F.col("source_id").alias("s")).agg(F.max("quote_date").alias("l"))
    rows = sources(spark, sf).join(per, F.col("source_id") == F.col("s"), "left").select("source_id", "region_id", F.when(F.col("source_id") % 6 != 5, F.col("l")).alias("latest"))
    most = F.when(F.col("region_id") != 4, 25 + F.col("source_id").cast("int"))
    return tl.freshness(rows, "latest", most, TODAY).select("source_id", "latest", "age_days", "freshness")


@query("x3_freshness", f"{_FRESH} SELECT * FROM fresh")
def _(spark, sf):
    return _fresh(spark, sf)


_RUN = """run AS (SELECT *, CASE source_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'partial' ELSE 'completed' END AS download, CASE WHEN source_id % 7 = 0 THEN 'failed' WHEN source_id % 7 = 1 THEN 'skipped' ELSE 'ok' END AS persistence FROM fresh)"""


def _run(spark, sf):
    s = F.col("source_id")
    download = F.when(s % 5 == 0, "failed").when(s % 5 == 1, "partial").otherwise("completed")
    persistence = F.when(s % 7 == 0, "failed").when(s % 7 == 1, "skipped").otherwise("ok")
    return _fresh(spark, sf).withColumns({"download": download, "persistence": persistence})


@query(
    "x3_health",
    f"""{_FRESH}, {_RUN}, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE download = 'completed') AS done, count(*) FILTER (WHERE persistence = 'failed') AS pf, count(*) FILTER (WHERE freshness = 'future') AS fu, count(*) FILTER (WHERE download = 'failed') AS df,
      count(*) FILTER (WHERE download = 'partial') AS dp, count(*) FILTER (WHERE persistence = 'skipped') AS ps, count(*) FILTER (WHERE freshness = 'stale') AS st, count(*) FILTER (WHERE freshness = 'no_data') AS nd FROM run),
    r AS (SELECT concat_ws(',', CASE WHEN done < total // 2 + 1 THEN 'insufficient_completed_sources' END, CASE WHEN pf > 0 THEN 'persistence_failures' END, CASE WHEN fu > 0 THEN 'future_quote_dates' END, CASE WHEN df > 0 THEN 'download_failures' END,
      CASE WHEN dp > 0 THEN 'partial_downloads' END, CASE WHEN ps > 0 THEN 'persistence_skipped' END, CASE WHEN st > 0 THEN 'stale_sources' END, CASE WHEN nd > 0 THEN 'sources_without_data' END, CASE WHEN nd = total THEN 'database_without_quotes' END) AS reasons FROM n)
    SELECT CASE WHEN regexp_matches(reasons, 'insufficient_completed_sources|persistence_failures|future_quote_dates|database_without_quotes') THEN 'inadequate' WHEN reasons <> '' THEN 'partial' ELSE 'healthy' END AS status, reasons FROM r""",
)
def _(spark, sf):
    return reporting.health(_run(spark, sf), {"database_available": True, "delta": "measured"})


@query(
    "x4_publication_gate",
    f"""{_FRESH}, {_RUN}, g AS (SELECT source_id AS scope, CASE source_id % 4 WHEN 0 THEN 'optional' WHEN 3 THEN 'disabled' ELSE 'required' END AS policy, download, persistence, latest, DATE '2001-11-20' AS before, coalesce(latest > DATE '{TODAY}', false) AS future FROM run),
    w AS (SELECT * FROM g WHERE policy <> 'disabled')
    SELECT CAST(scope AS VARCHAR) AS scope, 'date_regression' AS code, true AS blocking FROM w WHERE latest < before UNION ALL SELECT CAST(scope AS VARCHAR), 'date_missing', true FROM w WHERE latest IS NULL UNION ALL SELECT CAST(scope AS VARCHAR), 'download_failed', false FROM w WHERE download = 'failed'
    UNION ALL SELECT CAST(scope AS VARCHAR), 'persistence_failed', policy = 'required' FROM w WHERE persistence = 'failed' AND download = 'completed' UNION ALL SELECT CAST(scope AS VARCHAR), 'no_data', policy = 'required' FROM w WHERE latest IS NULL
    UNION ALL SELECT CAST(scope AS VARCHAR), 'future_date', policy = 'required' FROM w WHERE future UNION ALL SELECT 'store', 'id_regression', true""",
)
def _(spark, sf):
    s = F.col("source_id")
    rows = _run(spark, sf).select(
        s.cast("string").alias("source"), F.when(s % 4 == 0, "optional").when(s % 4 == 3, "disabled").otherwise("required").alias("policy"), "download", "persistence", "latest",
        F.lit("2001-11-20").cast("date").alias("previous_latest"), F.coalesce(F.col("latest") > F.lit(TODAY).cast("date"), F.lit(False)).alias("future"),
    )
    return reporting.gate(rows, {"total": 10, "max_id": 5}, {"total": 10, "max_id": 6})


_BACK = """b AS (SELECT c_custkey AS id, CASE c_custkey % 6 WHEN 0 THEN 'partial' WHEN 1 THEN 'failed' ELSE 'completed' END AS download, CASE WHEN c_custkey % 10 = 3 THEN 'failed' ELSE 'ok' END AS persistence,
 CASE WHEN c_custkey % 9 <> 0 THEN DATE '2000-01-01' + CAST(c_custkey % 50 AS INT) END AS old, CASE WHEN c_custkey % 8 <> 0 THEN DATE '2000-01-01' + CAST(c_custkey % 40 AS INT) END AS new, CAST(c_custkey % 4 AS INT) AS misses FROM customer)"""


def _back(spark, sf):
    k = F.col("c_custkey")
    day = lambda n: F.date_add(F.lit("2000-01-01").cast("date"), (k % n).cast("int"))
    return table(spark, sf, "customer").select(
        k.alias("id"), F.when(k % 6 == 0, "partial").when(k % 6 == 1, "failed").otherwise("completed").alias("download"), F.when(k % 10 == 3, "failed").otherwise("ok").alias("persistence"),
        F.when(k % 9 != 0, day(50)).alias("old"), F.when(k % 8 != 0, day(40)).alias("new"), (k % 4).cast("int").alias("misses"),
    )


@query(
    "x5_backfill_cursor",
    f"""WITH {_BACK}, s AS (SELECT *, CASE WHEN download = 'partial' THEN 'partial' WHEN download = 'failed' OR persistence = 'failed' THEN 'failed' WHEN new IS NOT NULL AND (old IS NULL OR new < old) THEN 'complete' ELSE 'paused' END AS status FROM b)
    SELECT id, status, least(old, new) AS cursor, CASE status WHEN 'paused' THEN misses + 1 WHEN 'complete' THEN 0 ELSE misses END AS no_progress, CASE WHEN status = 'paused' THEN DATE '{TODAY}' + 30 END AS next_check, status = 'paused' AS is_deferred, least(old, new) - 1 AS start FROM s""",
)
def _(spark, sf):
    rows = tl.next_cursor(_back(spark, sf), "download", "persistence", "old", "new", "misses", TODAY)
    return rows.select("id", "status", "cursor", "no_progress", "next_check", tl.deferred(F.col("status"), F.col("next_check"), TODAY).alias("is_deferred"), tl.start_cursor(F.col("old"), F.col("new")).alias("start"))


_FILES = """files AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'staging' WHEN 1 THEN 'daily' WHEN 2 THEN 'weekly' ELSE 'monthly' END AS layer, CAST(o_orderdate AS DATE) AS day FROM orders)"""


def _files(spark, sf):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    layer = F.when(k % 4 == 0, "staging").when(k % 4 == 1, "daily").when(k % 4 == 2, "weekly").otherwise("monthly")
    return table(spark, sf, "orders").select(k.alias("id"), layer.alias("layer"), day.alias("day"))


@query(
    "x9_retention",
    f"""WITH {_FILES}, proven AS (SELECT DISTINCT day FROM files WHERE layer = 'daily'),
    c AS (SELECT f.*, DATE '2002-07-01' - (CASE layer WHEN 'staging' THEN 2 WHEN 'daily' THEN 7 WHEN 'weekly' THEN 30 ELSE 365 END - 1) AS cutoff, p.day IS NOT NULL AS sure FROM files f LEFT JOIN proven p USING (day)),
    o AS (SELECT *, day < cutoff AND (layer <> 'staging' OR sure) AS old FROM c), w AS (SELECT *, day = max(day) OVER (PARTITION BY layer) AND bool_and(old) OVER (PARTITION BY layer) AS newest FROM o)
    SELECT id, layer, day, CASE WHEN NOT old THEN 'keep' WHEN newest THEN 'protected' ELSE 'expired' END AS action FROM w""",
)
def _(spark, sf):
    f = _files(spark, sf)
    proven = f.filter("layer = 'daily'")
    return tl.plan_retention(f, "layer", "day", {"staging": 2, "daily": 7, "weekly": 30, "monthly": 365}, "2002-07-01", proven).select("id", "layer", "day", "action")


@query("x10_x18_select_per_day", f"WITH {_FILES} SELECT id, day, CASE WHEN day > DATE '2001-07-01' THEN 'future' WHEN day < DATE '2000-01-01' THEN 'too_old' WHEN row_number() OVER (PARTITION BY day ORDER BY layer DESC, id DESC) = 1 THEN 'selected' ELSE 'duplicate' END AS state FROM files")
def _(spark, sf):
    return tl.select_per_day(_files(spark, sf), "day", [F.col("layer").desc(), F.col("id").desc()], "2000-01-01", "2001-07-01").select("id", "day", "state")


@query("x19_contiguous_batches", "SELECT s_suppkey, ntile(7) OVER (ORDER BY s_suppkey) AS batch FROM supplier")
def _(spark, sf):
    return tl.contiguous_batches(table(spark, sf, "supplier").select("s_suppkey"), F.floor(F.col("s_suppkey") / 1000), ["s_suppkey"], 7)


@query(
    "x20_inventory_diff",
    "WITH a AS (SELECT doc_id AS path, n_chars AS size, md5(text) AS digest FROM documents WHERE doc_id % 10 <> 1), b AS (SELECT doc_id AS path, n_chars + CASE WHEN doc_id % 10 = 4 THEN 1 ELSE 0 END AS size, CASE WHEN doc_id % 10 = 5 THEN 'x' WHEN doc_id % 10 <> 6 THEN md5(text) END AS digest FROM documents WHERE doc_id % 10 <> 2) SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN 'new' WHEN b.path IS NULL THEN 'lost' WHEN a.size = b.size AND (a.digest IS NULL OR b.digest IS NULL OR a.digest = b.digest) THEN 'kept' ELSE 'changed' END AS state FROM a FULL JOIN b ON a.path = b.path",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("size"), F.md5("text").alias("digest"))
    ten = F.col("path") % 10
    after = d.filter(ten != 2).select("path", (F.col("size") + F.when(ten == 4, 1).otherwise(0)).alias("size"), F.when(ten == 5, "x").when(ten != 6, F.col("digest")).alias("digest"))
    return tl.inventory_diff(d.filter(ten != 1), after, "path", "size", "digest")


@query(
    "x14_run_metrics",
    "SELECT event_type, date_diff('second', min(ts), max(ts + to_seconds(CAST(floor(value) AS BIGINT) % 60)))::DOUBLE AS span, CAST(sum(CAST(floor(value) AS BIGINT) % 60) AS DOUBLE) AS accumulated FROM (SELECT event_type, date_trunc('second', ts) AS ts, abs(value) AS value FROM events) GROUP BY event_type",
)
def _(spark, sf):
    start = F.date_trunc("second", F.col("ts").cast("timestamp_ntz")).cast("timestamp").cast("long")
    e = table(spark, sf, "events").select("event_type", start.alias("start"), (F.floor(F.abs("value")) % 60).alias("took")).withColumn("end", F.col("start") + F.col("took"))
    span, total, *_ = reporting.span_metrics(e, "start", "end")
    return e.groupBy("event_type").agg(span, total)


@query(
    "x16_alert_rollup",
    """WITH e AS (SELECT event_id AS eid, CASE WHEN value > 50 THEN 'error' ELSE 'warning' END AS level, 'user' AS scope0, 'user ' || user_id AS scope, event_type AS reason FROM events),
    p AS (SELECT level, reason, scope, count(*) AS n, min(eid) AS f FROM e GROUP BY level, reason, scope), r AS (SELECT *, row_number() OVER (PARTITION BY level, reason ORDER BY f, scope) AS k FROM p)
    SELECT level, reason, CAST(sum(n) AS BIGINT) AS events, string_agg(scope, ', ' ORDER BY k) FILTER (WHERE k <= 3) AS scopes FROM r GROUP BY level, reason""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("at"), F.when(F.col("value") > 50, "error").otherwise("warning").alias("level"), F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" | "), F.col("event_type")).alias("message"))
    return reporting.alert_rollup(e, "level", "message", "at")


@query("x17_label_totals", "SELECT label, CAST(coalesce(sum(TRY_CAST(v AS BIGINT)) FILTER (WHERE regexp_matches(v, '^\\s*[+-]?\\d+\\s*$')), 0) AS BIGINT) AS total, min(event_id) AS first_seen FROM (SELECT event_type AS label, CASE WHEN event_id % 3 = 0 THEN 'n/a' WHEN event_id % 3 = 1 THEN CAST(user_id AS VARCHAR) ELSE '1.5' END AS v, event_id FROM events) GROUP BY label")
def _(spark, sf):
    i = F.col("event_id")
    v = F.when(i % 3 == 0, "n/a").when(i % 3 == 1, F.col("user_id").cast("string")).otherwise("1.5")
    return reporting.label_totals(table(spark, sf, "events").select(F.col("event_type").alias("label"), v.alias("v"), "event_id"), "label", "v", "event_id")


@query("x21_persistence_accounting", "SELECT o_orderkey AS id, greatest(0, o_orderkey % 50 - o_custkey % 20 - o_orderkey % 9) AS repeated FROM orders")
def _(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("id"), reporting.persistence_repeated(k % 50, F.col("o_custkey") % 20, k % 9).alias("repeated"))


# a feed of the same products: every second quote again, under another product every fifth time, some rows lacking a part
_SAVED = f"""saved AS (SELECT id, CASE WHEN market_id % 5 <> 0 THEN 'm' || market_id END AS market, quote_date AS day, 'p' || (product_id % 40) AS product, CASE WHEN quantity % 9 <> 0 THEN 'KG' END AS unit, p_common AS price, market_id AS destination FROM quotes),
feed AS (SELECT id AS ordinal, 'm' || market_id AS market, CASE WHEN id % 23 <> 0 THEN quote_date END AS day, CASE WHEN id % 5 = 0 THEN 'new' || line ELSE 'p' || (product_id % 40) END AS product, CASE WHEN id % 31 <> 0 THEN 'KG' END AS unit, coalesce(p_max, p_min) AS price FROM quotes),
mapped AS (SELECT * FROM saved WHERE day IS NOT NULL AND market IS NOT NULL AND unit IS NOT NULL),
per AS (SELECT market, day, product, unit, count(*) AS n, min(id) AS id FROM mapped WHERE price IS NULL GROUP BY ALL),
first AS (SELECT * FROM feed WHERE day IS NOT NULL AND price IS NOT NULL AND unit IS NOT NULL QUALIFY row_number() OVER (PARTITION BY market, day, product, unit ORDER BY ordinal) = 1),
updates AS (SELECT per.id, first.price FROM first JOIN per USING (market, day, product, unit) WHERE n = 1),
scopes AS (SELECT market, day, arg_min(destination, id) AS destination FROM mapped GROUP BY market, day),
inserts AS (SELECT f.market, f.day, f.product, f.unit, f.price, s.destination FROM first f JOIN scopes s USING (market, day) WHERE NOT EXISTS (SELECT 1 FROM mapped m WHERE m.market = f.market AND m.day = f.day AND m.product = f.product AND m.unit = f.unit))"""


def _complement(spark, sf):
    q = quotes(spark, sf)
    m, i = F.col("market_id"), F.col("id")
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    product = text("p", F.col("product_id") % 40)
    saved = q.select("id", F.when(m % 5 != 0, text("m", m)).alias("market"), F.col("quote_date").alias("day"), product.alias("product"), F.when(F.col("quantity") % 9 != 0, "KG").alias("unit"), F.col("p_common").alias("price"), m.alias("destination"))
    feed = q.select(
        i.alias("ordinal"), text("m", m).alias("market"), F.when(i % 23 != 0, F.col("quote_date")).alias("day"), F.when(i % 5 == 0, text("new", F.col("line"))).otherwise(product).alias("product"),
        F.when(i % 31 != 0, "KG").alias("unit"), F.coalesce("p_max", "p_min").alias("price"),
    )
    return saved, cp.complement(saved, feed)


@query("x1_complement_updates", f"WITH {QUOTES}, {_SAVED} SELECT * FROM updates")
def _(spark, sf):
    return _complement(spark, sf)[1].updates


@query("x1_u7_complement_inserts", f"WITH {QUOTES}, {_SAVED} SELECT * FROM inserts")
def _(spark, sf):
    return _complement(spark, sf)[1].inserts


@query(
    "x1_complement_metrics",
    f"WITH {QUOTES}, {_SAVED} SELECT (SELECT count(*) FROM saved WHERE price IS NULL AND day IS NOT NULL) AS candidates, (SELECT count(*) FROM saved WHERE price IS NULL AND day IS NOT NULL AND (market IS NULL OR unit IS NULL)) AS unmapped, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM per WHERE n > 1) AS ambiguous, (SELECT count(*) FROM scopes) AS scopes, (SELECT count(*) FROM feed) AS scanned, (SELECT count(*) FROM updates) AS updated, (SELECT count(*) FROM inserts) AS inserted",
)
def _(spark, sf):
    return _complement(spark, sf)[1].metrics


@query("u6_fill_prices", f"WITH {QUOTES}, {_SAVED} SELECT s.id, coalesce(s.price, u.price) AS price FROM saved s LEFT JOIN updates u USING (id)")
def _(spark, sf):
    saved, c = _complement(spark, sf)
    return cp.fill(saved, c.updates, "price").select("id", "price")


@query("u8_u9_incremental", f"WITH {QUOTES} SELECT 'quotes' AS name, count(*) AS n, max(id) AS watermark FROM quotes WHERE id > 5000000 UNION ALL SELECT 'regions', count(*), max(r_regionkey) FROM region")
def _(spark, sf):
    new = tl.incremental(quotes(spark, sf), "id", 5_000_000).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("watermark"))
    ref = tl.incremental(table(spark, sf, "region"), "r_regionkey", 5_000_000, reference=True).agg(F.count(F.lit(1)).alias("n"), F.max("r_regionkey").cast("long").alias("watermark"))
    return new.select(F.lit("quotes").alias("name"), "n", "watermark").union(ref.select(F.lit("regions"), "n", "watermark"))


_TRACE = """reg AS (SELECT doc_id AS id, CASE WHEN doc_id % 31 = 0 THEN '../d' WHEN doc_id % 29 <> 0 THEN 'raw/d' || doc_id || '.html' END AS path, CASE WHEN doc_id % 23 <> 0 THEN sha256(text) END AS digest FROM documents),
found AS (SELECT 'raw/d' || doc_id || '.html' AS path, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'other' ELSE sha256(text) END AS digest FROM documents WHERE doc_id % 7 <> 0
  UNION ALL SELECT 'old/d' || doc_id || '.html', sha256(text) FROM documents WHERE doc_id % 14 = 0 UNION ALL SELECT 'older/d' || doc_id || '.html', sha256(text) FROM documents WHERE doc_id % 28 = 0),
places AS (SELECT reg.id, count(DISTINCT f.path) AS places FROM reg JOIN found f ON f.digest = reg.digest AND split_part(f.path, '/', 2) = split_part(reg.path, '/', 2) GROUP BY reg.id)"""


def _trace(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("s"))
    k = F.col("doc_id")
    path = lambda where: F.concat(F.lit(f"{where}/d"), k.cast("string"), F.lit(".html"))
    registered = d.select(k.alias("id"), F.when(k % 31 == 0, "../d").when(k % 29 != 0, path("raw")).alias("path"), F.when(k % 23 != 0, F.col("s")).alias("digest"))
    found = d.filter(k % 7 != 0).select(path("raw").alias("path"), F.when(k % 13 == 0, None).when(k % 11 == 0, "other").otherwise(F.col("s")).alias("digest"))
    found = found.union(d.filter(k % 14 == 0).select(path("old"), "s")).union(d.filter(k % 28 == 0).select(path("older"), "s"))
    return registered, found


@query(
    "x6_raw_traceability",
    f"""WITH {_TRACE} SELECT reg.id, CASE WHEN reg.path IS NULL THEN 'no_path' WHEN reg.path LIKE '/%' OR reg.path LIKE '%..%' THEN 'unsafe_path' WHEN reg.digest IS NULL THEN 'missing_hash' WHEN f.path IS NOT NULL AND f.digest IS NULL THEN 'unreadable'
    WHEN f.digest = reg.digest THEN 'exact_match' WHEN f.path IS NOT NULL THEN 'hash_mismatch' WHEN p.places = 1 THEN 'relocated_match' WHEN p.places > 1 THEN 'ambiguous_candidates' ELSE 'missing' END AS state
    FROM reg LEFT JOIN found f ON f.path = reg.path LEFT JOIN places p ON p.id = reg.id""",
)
def _(spark, sf):
    return raw.trace(*_trace(spark, sf))


_PLAN = f"""{COLLECTIONS}, miss AS (SELECT id, raw_path AS path, sha256 AS digest FROM collections WHERE sha256 IS NOT NULL), ev AS (SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS digest, 'b' || s_nationkey AS backup, DATE '2001-01-01' + CAST(s_suppkey % 30 AS INT) AS day FROM supplier UNION ALL SELECT sha256(CAST(c_nationkey AS VARCHAR)), 'c' || (c_custkey % 10), DATE '2001-01-01' + CAST(c_custkey % 9 AS INT) FROM customer),
f AS (SELECT digest, arg_min(backup, (day, backup)) AS backup, min(day) AS day FROM ev GROUP BY digest), plan AS (SELECT id, m.digest, CASE WHEN path IS NULL THEN 'invalid_target' WHEN f.backup IS NOT NULL THEN 'found' ELSE 'not_found' END AS state, f.backup, f.day FROM miss m LEFT JOIN f USING (digest))"""


def _plan(spark, sf):
    c = collections(spark, sf).filter("sha256 is not null")
    missing = c.select("id", F.col("raw_path").alias("path"), F.col("sha256").alias("digest"))
    text = lambda c: F.col(c).cast("string")
    day = lambda c: F.date_add(F.lit("2001-01-01").cast("date"), c.cast("int")).alias("day")
    evidence = table(spark, sf, "supplier").select(F.sha2(text("s_suppkey"), 256).alias("digest"), F.concat(F.lit("b"), text("s_nationkey")).alias("backup"), day(F.col("s_suppkey") % 30))
    k = F.col("c_custkey")
    evidence = evidence.union(table(spark, sf, "customer").select(F.sha2(text("c_nationkey"), 256), F.concat(F.lit("c"), (k % 10).cast("string")), day(k % 9)))
    return raw.plan_recovery(missing, evidence)


@query("x8_recovery_plan", f"WITH {_PLAN} SELECT id, digest, state, CASE WHEN state = 'found' THEN backup END AS backup, CASE WHEN state = 'found' THEN day END AS day FROM plan")
def _(spark, sf):
    return _plan(spark, sf)


@query("x23_recovery_counters", f"WITH {_PLAN} SELECT count(*) AS missing, count(DISTINCT digest) AS hashes, count(*) FILTER (WHERE state = 'found') AS found, count(*) FILTER (WHERE state = 'not_found') AS not_found, count(*) FILTER (WHERE state = 'invalid_target') AS invalid_target FROM plan")
def _(spark, sf):
    return raw.recovery_counters(_plan(spark, sf))


@query("s6_json_props", "SELECT event_type, count(*) AS n, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type")
def _(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.from_json("props", "k long")["k"]).alias("total"))


@query("k1_k2_keys", "SELECT p_partkey, regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS VARCHAR), '\\.0+$|(\\.[0-9]*?)0+$', '\\1') AS price_key, sha256(p_name || '|' || coalesce(nullif(p_brand, 'Brand#11'), '') || '|' || p_size) AS hashed FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", keys.decimal_key(F.col("p_retailprice").cast("decimal(18,4)")).alias("price_key"), keys.hash_values(F.col("p_name"), F.nullif("p_brand", F.lit("Brand#11")), F.col("p_size")).alias("hashed"))


@query("k5_k11_k13_text", "SELECT p_partkey, trim(regexp_replace(lower('  ' || p_name || '  X'), '\\s+', ' ', 'g')) AS basic, regexp_replace(regexp_replace(lower(p_brand || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, trim(regexp_replace(lower(p_brand || ' / ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS match_text, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS match_key FROM part")
def _(spark, sf):
    both = F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", tx.basic_name(F.concat(F.lit("  "), F.col("p_name"), F.lit("  X"))).alias("basic"), tx.slug(both).alias("slug"), tx.match_text(both).alias("match_text"), tx.match_key(F.col("p_brand")).alias("match_key"))


@query("k14_strip_accents", "SELECT doc_id, md5(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')) AS plain FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.strip_accents(F.col("text"))).alias("plain"))


@query(
    "k7_k10_validity",
    "SELECT event_id, regexp_full_match(d, '\\d{4}-\\d{2}-\\d{2}') AND TRY_CAST(d AS DATE) IS NOT NULL AS good_date, coalesce(TRY_CAST(v AS DECIMAL(38,10)) >= 0, false) AS good_amount FROM (SELECT event_id, '2024-' || (event_id % 14) || '-' || (10 + event_id % 25) AS d, CASE event_id % 4 WHEN 0 THEN '1.5' WHEN 1 THEN '-2' WHEN 2 THEN 'x' ELSE '0' END AS v FROM events)",
)
def _(spark, sf):
    i = F.col("event_id")
    d = F.concat(F.lit("2024-"), (i % 14).cast("string"), F.lit("-"), (10 + i % 25).cast("string"))
    v = F.when(i % 4 == 0, "1.5").when(i % 4 == 1, "-2").when(i % 4 == 2, "x").otherwise("0")
    return table(spark, sf, "events").select("event_id", values.valid_date(d).alias("good_date"), values.valid_amount(v).alias("good_amount"))


@query("k17_k21_values", "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS price, DATE '2024-01-01' + CAST(p_partkey % 28 AS INT) AS day FROM part")
def _(spark, sf):
    # written the Brazilian way, then read back
    p = F.col("p_retailprice").cast("decimal(18,2)")
    shown = F.concat(F.lit("R$ "), F.translate(F.format_number(p, 2), ",.", ".,"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 28).cast("int")), "dd/MM/yyyy")
    return table(spark, sf, "part").select("p_partkey", values.money_br(shown).alias("price"), values.date_br(day).alias("day"))


@query("k28_mask_secrets", "SELECT doc_id, md5(regexp_replace(regexp_replace(text || ' ?token=abc&x=1 postgres://u:pw@h/d', '(?i)\\b(postgres|postgresql)://([^\\s/:]+):[^\\s/@]+@', '\\1://\\2:***@', 'g'), '(?i)([?&])(api-key|api_key|apikey|password|secret|token)=[^\\s&]+', '\\1\\2=***', 'g')) AS masked FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.mask_secrets(F.concat(F.col("text"), F.lit(" ?token=abc&x=1 postgres://u:pw@h/d")))).alias("masked"))


@query("k32_urls", "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.parse_url("url", F.lit("PATH")).alias("path"))
