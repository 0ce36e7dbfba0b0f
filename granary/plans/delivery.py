"""Queries of publication, layers, walks and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as tx
from granary.operators import delivery as dv
from granary.operators import duplicates as dup
from granary.operators import reporting
from granary.session import table
from granary.sources import tables

from .base import QUOTES, query, quotes
from .documents import each, golden, literal


@golden(
    "x4_store_reasons", "scope code blocking",
    [("a", "database_unavailable", "true"), ("b", "database_quick_check_failed", "true"), ("b", "database_foreign_key_violations", "true"), ("c", "database_without_quotes", "true"), ("e", "database_unavailable", "true")],
)
def _(spark):
    rows = [("a", "missing", None, None, None), ("b", "available", ["row 1 missing", "row 2 missing"], 3, 10), ("c", "available", ["ok"], 0, 0), ("d", "available", ["ok"], 0, 5), ("e", None, ["ok"], 0, 5)]
    return dv.store_reasons(spark.createDataFrame(rows, "scope string, status string, quick_check array<string>, violations int, quotes int"))


@golden(
    "x4_health_contract", "scope code blocking",
    [("b", "health_schema_unsupported", "true"), ("b", "health_run_failed", "true"), ("c", "health_reasons_invalid", "true"), ("d", "health_schema_unsupported", "true"), ("d", "health_reasons_invalid", "true"), ("e", "health_database_unavailable", "true"), ("e", "health_database_id_regression", "true")],
)
def _(spark):
    rows = [("a", '{"schema_version": 2, "reasons": [{"code": "stale_sources"}]}'), ("b", '{"schema_version": 1, "reasons": [{"code": "run_failed"}]}'), ("c", '{"schema_version": 3, "reasons": "none"}'), ("d", "broken"), ("e", '{"schema_version": 2, "reasons": [{"code": "database_unavailable"}, {"code": "x"}, {"code": "database_id_regression"}]}')]
    return dv.health_contract(spark.createDataFrame(rows, "scope string, body string"))


@query(
    "x5_date_walk",
    f"""WITH {QUOTES}, d AS (SELECT DISTINCT source_id, quote_date FROM quotes WHERE quote_date <= DATE '2000-06-01'), r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY quote_date DESC) AS place, date_diff('day', quote_date, DATE '2000-06-01') + 1 AS attempt FROM d)
    SELECT source_id, quote_date, place, attempt FROM r WHERE place <= 6 AND attempt <= 30""",
)
def _(spark, sf):
    return dv.walk_dates(quotes(spark, sf), ["source_id"], "quote_date", "2000-06-01", 5)


@query(
    "x5_open_walk",
    f"""WITH {QUOTES}, d AS (SELECT DISTINCT product_id, quote_date FROM quotes WHERE quote_date <= DATE '2000-06-01'), r AS (SELECT *, row_number() OVER w AS place, date_diff('day', quote_date, DATE '2000-06-01') + 1 AS attempt, date_diff('day', quote_date, coalesce(lag(quote_date) OVER w, DATE '2000-06-02')) - 1 AS missed FROM d WINDOW w AS (PARTITION BY product_id ORDER BY quote_date DESC)),
    m AS (SELECT *, max(missed) OVER (PARTITION BY product_id ORDER BY place) AS most FROM r) SELECT product_id, quote_date, place, attempt FROM m WHERE most < {dv.MISSES}""",
)
def _(spark, sf):
    return dv.walk_dates(quotes(spark, sf), ["product_id"], "quote_date", "2000-06-01", None)


@query(
    "x18_layer_status",
    """WITH t AS (SELECT CAST(o_orderdate AS DATE) AS day, 'f' || o_orderkey AS path, o_custkey AS size FROM orders), inv AS (SELECT 'f' || l_orderkey AS path FROM lineitem WHERE l_linenumber = 2), pr AS (SELECT DISTINCT 'f' || o_orderkey AS path, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 END AS size FROM orders),
    s AS (SELECT t.*, CASE WHEN t.path NOT IN (SELECT path FROM inv) THEN 'missing' WHEN pr.path IS NOT NULL THEN 'validated_existing' ELSE 'existing_unverified' END AS state FROM t LEFT JOIN pr ON pr.path = t.path AND pr.size = t.size)
    SELECT day, path, state, CASE WHEN bool_or(state = 'existing_unverified') OVER d THEN 'blocked' WHEN bool_or(state = 'missing') OVER d THEN 'pending' ELSE 'completed' END AS day_state FROM s WINDOW d AS (PARTITION BY day)""",
)
def _(spark, sf):
    o, name = table(spark, sf, "orders"), lambda c: F.concat(F.lit("f"), F.col(c).cast("string")).alias("path")
    targets = o.select(F.col("o_orderdate").cast("date").alias("day"), name("o_orderkey"), F.col("o_custkey").alias("size"))
    proofs = o.select(name("o_orderkey"), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-1).alias("size"))
    return dv.layer_status(targets, table(spark, sf, "lineitem").filter("l_linenumber = 2").select(name("l_orderkey")), proofs)


@query(
    "x11_tree_hash",
    "WITH f AS (SELECT source || '/' || doc_id AS path, n_chars AS size, md5(text) AS digest, doc_id // 100 AS b, doc_id FROM documents), l AS (SELECT b, sha256(string_agg(path || chr(9) || size || chr(9) || digest, chr(10) ORDER BY doc_id)) AS h, count(*) AS n FROM f GROUP BY b) SELECT sha256(string_agg(h, chr(10) ORDER BY b)) AS digest, CAST(sum(n) AS BIGINT) AS rows FROM l",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    line = F.concat_ws("\t", F.concat_ws("/", "source", F.col("doc_id").cast("string")), F.col("n_chars").cast("string"), F.md5("text"))
    return dup.ordered_hash(d, line, ["doc_id"], F.floor(F.col("doc_id") / 100))


@query(
    "x14_pipeline_metrics",
    """WITH e AS (SELECT event_type, epoch(date_trunc('second', ts))::DOUBLE AS start, (CAST(floor(abs(value)) AS BIGINT) % 60)::DOUBLE AS took, (user_id % 7)::DOUBLE AS waited FROM events)
    SELECT event_type, max(start + took) - min(start) AS span, sum(took) AS accumulated, greatest(0, sum(took) - (max(start + took) - min(start))) AS overlap_gain, round(count(*) * 60 / (max(start + took) - min(start)), 6) AS per_minute, sum(waited) AS queue_wait FROM e GROUP BY event_type""",
)
def _(spark, sf):
    start = F.date_trunc("second", F.col("ts").cast("timestamp_ntz")).cast("timestamp").cast("double")
    e = table(spark, sf, "events").select("event_type", start.alias("start"), (F.floor(F.abs("value")) % 60).cast("double").alias("took"), (F.col("user_id") % 7).cast("double").alias("waited"))
    e = e.withColumns({"end": F.col("start") + F.col("took"), "queued": F.col("start") - F.col("waited")})
    out = e.groupBy("event_type").agg(*reporting.span_metrics(e, "start", "end", "queued"))
    return out.withColumn("per_minute", F.round("per_minute", 6))


each("k32_allowed_urls", lambda c: dv.allowed_url(c, ["example.org", "www.example.org"], "/quotes"), [("https://example.org/quotes/a", "true"), ("http://WWW.example.org:8080/quotes?x=1", "true"), ("https://example.org/other", "false"), ("https://evil.org/quotes", "false"), ("https://example.org@evil.org/quotes", "false"), ("ftp://example.org/quotes", "false"), ("https://example.org/quotes/../x", "false"), (None, "false")])


@golden("k32_encoded_urls", "url", [("https://example.org/q?day=05%2F08%2F2026&name=ma%C3%A7%C3%A3+%26+uva",), ("https://example.org/q?name=a",), ("https://example.org/q",)])
def _(spark):
    df = spark.createDataFrame([("05/08/2026", "maçã & uva"), (None, "a"), (None, None)], "day string, name string")
    return df.select(dv.encoded_url(F.lit("https://example.org/q"), day=F.col("day"), name=F.col("name")).alias("url"))


@golden("s7_report_rows", "id source path sha256", [("7", "go", "raw/a/b.html", "ab"), (None, "df", "raw/c/d.html", "cd")])
def _(spark):
    rows = [("7 ", "go", " raw/a/b.html", "AB", "missing"), ("8", "go", "raw/x/y.html", "ef", "found"), ("x", "df", "raw/c/d.html", "cd", " missing"), ("9", "df", " ", "cd", "missing")]
    return dv.report_rows(spark.createDataFrame(rows, "ID string, Source string, ` path` string, sha256 string, status string"))


@golden("s12_document_pages", "name n first page_error", [("a", "2", "one", None), ("b", "2", "one", None), ("c", "1", "olá", None), ("d", None, None, "no content")])
def _(spark):
    rows = [("a", bytearray(b"one\ftwo")), ("b", bytearray(b"one\ftwo")), ("c", bytearray("olá".encode("latin-1"))), ("d", None)]
    pages = dv.document_pages(spark.createDataFrame(rows, "name string, content binary"))
    return pages.select("name", F.when(F.col("pages").isNotNull(), F.size("pages")).alias("n"), F.get("pages", F.lit(0)).alias("first"), "page_error")


@golden("p11_page_problems", "doc problem", [("1", "unavailable"), ("2", "layout"), ("3", "wrong_category"), ("4", "wrong_date"), ("5", "no_rows"), ("6", "layout")])
def _(spark):
    page = lambda head, rows="<tr><td>Uva<td>A<td>KG<td>1<td>2<td>3<td>4</tr>": f"<table class=contacao_lista><tr><th colspan=7>{head}</th></tr>{rows}</table>"
    html = [page("FRUTAS 05/08/2026"), "<p>Service Unavailable</p>", "<p>other</p>", page("FLORES 05/08/2026"), page("FRUTAS 06/08/2026"), page("FRUTAS 05/08/2026", ""), None]
    return tables.seven_cell_problems(literal(spark, html, "html"), F.lit("Frutas"), F.lit("2026-08-05").cast("date"))


each("k28_masked_settings", lambda c: tx.mask_settings(c, ["s3cr3t", "pw"]), [("login s3cr3t and pw", "login *** and ***"), ("nothing", "nothing"), (None, None)])


def _shared(spark) -> str:
    """A new folder that executors share; a temporary one only on one machine."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='granary-')).rstrip('/')}/{uuid.uuid4().hex}"


@query("stream_daily_counts", "SELECT date_trunc('day', ts)::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    from granary.streaming import ingest

    state = _shared(spark)
    stream = ingest.raw_stream(spark, f"{sf}/events.parque[t]", "event_id long, ts timestamp, event_type string")  # a pattern, as the table may be one file
    counts = ingest.run_to_table(ingest.daily_counts(stream, "ts", "event_type"), "stream_" + state.rsplit("/", 1)[-1], state)
    return counts.select(F.col("day.start").cast("date").alias("day"), "event_type", "n")


@golden(
    "s1_raw_files", "name size sha256 category text",
    [("frutas_2026-08-05_20260806_101500.html", "3", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", "frutas", "abc"), ("x.pdf", "3", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", None, "abc")],
)
def _(spark):
    from granary.sources import files

    folder = _shared(spark)
    # three files by way of the text writer's folders, then renamed by Hadoop's file system, so that any shared store does
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, content in (("frutas_2026-08-05_20260806_101500.html", "abc"), ("x.pdf", "abc"), ("notes.txt", "x")):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        out = path.getFileSystem(conf).create(path)
        out.write(bytearray(content.encode()))
        out.close()
    found = files.decoded(files.with_name_parts(files.scan_raw(spark, folder)))
    return found.withColumn("size", F.octet_length("content"))


@query(
    "x8_backup_candidates",
    """WITH inv AS (SELECT 'd' || doc_id AS path, n_chars AS size, DATE '2001-01-01' + CAST(doc_id % 30 AS INT) AS day, source AS layer FROM documents),
    ev AS (SELECT CASE WHEN lang = 'fr' THEN 'other' ELSE 'd' || doc_id END AS path, md5(text) AS sha256, n_chars + CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END AS size FROM documents UNION ALL SELECT 'd' || doc_id, 'q' || quality, CAST(toxic AS BIGINT) FROM labels),
    p AS (SELECT path, count(DISTINCT (sha256, size)) AS signatures, min(sha256) AS sha256, min(size) AS proven FROM ev GROUP BY path),
    b AS (SELECT inv.*, p.sha256, CASE WHEN p.path IS NULL THEN 'no_manifest' WHEN signatures > 1 THEN 'conflict' WHEN inv.size IS DISTINCT FROM proven THEN 'size_mismatch' END AS bad FROM inv LEFT JOIN p USING (path))
    SELECT path, sha256, day, layer, coalesce(bad, CASE WHEN row_number() OVER (PARTITION BY bad, sha256 ORDER BY day, layer NULLS FIRST, path) = 1 THEN 'candidate' ELSE 'represented' END) AS state FROM b""",
)
def _(spark, sf):
    from granary.operators import raw

    d, k = table(spark, sf, "documents"), F.col("doc_id")
    path = F.concat(F.lit("d"), k.cast("string"))
    inventory = d.select(path.alias("path"), F.col("n_chars").alias("size"), F.date_add(F.lit("2001-01-01").cast("date"), (k % 30).cast("int")).alias("day"), F.col("source").alias("layer"))
    evidence = d.select(F.when(F.col("lang") == "fr", "other").otherwise(path).alias("path"), F.md5("text").alias("sha256"), (F.col("n_chars") + F.when(k % 13 == 0, 1).otherwise(0)).alias("size"))
    labels = table(spark, sf, "labels").select(path.alias("path"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("sha256"), F.col("toxic").cast("long").alias("size"))
    return raw.select_candidates(inventory, evidence.union(labels))
