"""Duplicates, canonical rows, provenance (A, E, W, U, X2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import keys
from granary.functions import text as tx
from granary.operators import duplicates as dup
from granary.session import table

from .base import COLLECTIONS, WITH_ALL, WITH_QUOTES, collections, query, quotes

#: What makes two quotes the same content: their identity (order and line) and their market status.
CONTENT = ["source_id", "line", "market_status", "quantity"]
_K = ", ".join(CONTENT)
#: A single column made of rows of the content, for functions that compare groups.
BASELINE = 2_000_000


def _facts(spark, sf):
    c = collections(spark, sf).select(F.col("id").alias("collection_id"), "sha256", "processed_at", "started_at", F.col("source_id").alias("collection_source"))
    return quotes(spark, sf).join(c, "collection_id")


_FACTS = f"{WITH_ALL}, facts AS (SELECT q.*, c.sha256, c.processed_at, c.started_at, c.source_id AS collection_source FROM quotes q JOIN collections c ON c.id = q.collection_id)"


@query("a1_duplicate_groups", f"{WITH_QUOTES} SELECT {_K}, count(*) AS occurrences FROM quotes GROUP BY {_K} HAVING count(*) > 1")
def _(spark, sf):
    return dup.duplicate_groups(quotes(spark, sf), CONTENT)


_DETAIL = f"""{_FACTS}, detail AS (
  SELECT {_K}, count(*) AS occurrences, count(DISTINCT collection_id) AS collections, count(DISTINCT sha256) AS raws, bool_or(sha256 IS NULL) AS no_raw,
         min(started_at) AS first_at, max(started_at) AS last_at, min(id) AS first_id, max(id) AS last_id
  FROM facts GROUP BY {_K} HAVING count(*) > 1
), classed AS (
  SELECT * EXCLUDE (no_raw), CASE WHEN collections = 1 THEN 'same_collection' WHEN NOT no_raw AND raws = 1 THEN 'same_raw' ELSE 'different_raw' END AS origin_class FROM detail
)"""


def _detail(spark, sf):
    return dup.duplicate_detail(_facts(spark, sf), CONTENT, "id", "collection_id", "sha256", "started_at")


@query("a2_duplicate_detail", f"{_DETAIL} SELECT * FROM classed")
def _(spark, sf):
    return _detail(spark, sf)


#: Range of ids of a page, as wide as a thousand orders.
PAGE = 1_000_000


@query(
    "a2_k31_duplicate_ids",
    f"""{_DETAIL}, pages AS (SELECT {_K}, id // {PAGE} AS page, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM facts GROUP BY {_K}, page)
    SELECT p.* FROM pages p JOIN classed c ON {' AND '.join(f'p.{k} IS NOT DISTINCT FROM c.{k}' for k in CONTENT)}""",
)
def _(spark, sf):
    facts = _facts(spark, sf)
    return dup.id_pages(facts, CONTENT, "id", dup.duplicate_groups(facts, CONTENT), PAGE)


@query(
    "a3_duplicate_summary",
    f"""{_DETAIL} SELECT source_id, count(*) AS groups, CAST(sum(occurrences) AS BIGINT) AS rows_involved, CAST(sum(occurrences - 1) AS BIGINT) AS excess,
    count(*) FILTER (WHERE collections = 1) AS single_collection, count(*) FILTER (WHERE collections > 1) AS multi_collection, count(*) FILTER (WHERE origin_class = 'same_raw') AS same_raw,
    count(*) FILTER (WHERE origin_class = 'different_raw') AS different_raw, max(occurrences) AS biggest, max(last_at) AS last_repetition FROM classed GROUP BY source_id""",
)
def _(spark, sf):
    return dup.duplicate_summary(_detail(spark, sf), ["source_id"])


@query(
    "a4_duplicate_manifest",
    f"""{_FACTS}, f AS (SELECT *, sha256(concat_ws('|', source_id, coalesce(CAST(market_id AS VARCHAR), ''), alias)) AS key, coalesce(regexp_matches(sha256, '^[0-9a-f]{{64}}$'), false) AS valid, collection_source IS NOT DISTINCT FROM source_id AS owned, instr(alias, 'x') > 0 AS unclear FROM facts),
    m AS (SELECT id, collection_id, {_K}, key, valid, owned, unclear, min(id) OVER g AS canonical_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY {_K} ORDER BY id) AS position,
             (count(DISTINCT line % 2) OVER g) > 1 OR (count(DISTINCT product_id // 50) OVER g) > 1 AS diverges, bool_or(NOT valid) OVER g AS invalid, bool_or(NOT owned) OVER g AS strange, bool_or(unclear) OVER g AS ambiguous, (count(DISTINCT coalesce(variety, '')) OVER g) > 1 AS extra, (count(DISTINCT collection_id) OVER g) > 1 AS several FROM f WINDOW g AS (PARTITION BY {_K})
    ) SELECT id, {_K}, key, valid, owned, unclear, canonical_id, group_size, position,
      CASE WHEN diverges THEN 'divergent_identity' WHEN invalid THEN 'invalid_key' WHEN strange THEN 'foreign_market' WHEN ambiguous THEN 'ambiguous_serialization' WHEN extra THEN 'complement_divergence' WHEN several THEN 'several_collections' ELSE 'manual' END AS blocker
    FROM m WHERE group_size > 1""",
)
def _(spark, sf):
    from pyspark.sql import Window

    from granary.functions.values import valid_sha256

    g = Window.partitionBy(*CONTENT)
    # distinct counts over a window as the difference of the least and the greatest
    differ = lambda c: F.min(c).over(g) != F.max(c).over(g)
    any_ = lambda c: F.bool_or(c).over(g)
    rows = _facts(spark, sf).withColumns({"key": keys.hash_values(F.col("source_id"), F.col("market_id"), F.col("alias")), "valid": valid_sha256(F.col("sha256")), "owned": F.col("collection_source").eqNullSafe(F.col("source_id")), "unclear": F.col("alias").contains("x")})
    blockers = [
        ("divergent_identity", differ(F.floor(F.col("product_id") / 50))), ("invalid_key", any_(~F.col("valid"))), ("foreign_market", any_(~F.col("owned"))), ("ambiguous_serialization", any_(F.col("unclear"))),
        ("complement_divergence", differ(F.coalesce("variety", F.lit("")))), ("several_collections", differ(F.col("collection_id"))),
    ]
    rows = rows.withColumns({name: holds for name, holds in blockers})
    return dup.duplicate_manifest(rows, CONTENT, "id", [(name, F.col(name)) for name, _ in blockers]).select("id", *CONTENT, "key", "valid", "owned", "unclear", "canonical_id", "group_size", "position", "blocker")


@query(
    "a5_complement_conflicts",
    f"{WITH_QUOTES} SELECT {_K}, count(*) AS occurrences, count(DISTINCT coalesce(variety, '~') || '/' || coalesce(presentation, '~')) AS variants FROM quotes GROUP BY {_K} HAVING count(*) > 1 AND variants > 1",
)
def _(spark, sf):
    return dup.conflicts(quotes(spark, sf), CONTENT, ["variety", "presentation"]).withColumn("variants", F.col("variants").cast("long"))


@query(
    "a6_repeated_raw",
    "SELECT source, sha256(text) AS digest, count(*) AS occurrences, count(DISTINCT doc_id) AS collections, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents WHERE text IS NOT NULL GROUP BY source, sha256(text) HAVING count(DISTINCT doc_id) > 1",
)
def _(spark, sf):
    d = table(spark, sf, "documents").filter("text is not null").select("source", F.sha2("text", 256).alias("digest"), "doc_id")
    ids = [F.countDistinct("doc_id").alias("collections"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")]
    return dup.duplicate_groups(d, ["source", "digest"], 2, *ids).filter("collections > 1")


@query(
    "a7_semantic_candidates",
    """WITH d AS (SELECT p_brand, CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN '  ' || p_type ELSE lower(p_type) END AS name FROM part),
    once AS (SELECT p_brand, name, trim(regexp_replace(lower(name), '\\s+', ' ', 'g')) AS canon, count(*) AS n FROM d GROUP BY ALL)
    SELECT p_brand, canon, count(DISTINCT name) AS keys, CAST(sum(n) AS BIGINT) AS observations FROM once GROUP BY p_brand, canon HAVING count(DISTINCT name) > 1""",
)
def _(spark, sf):
    kind, three = F.col("p_type"), F.col("p_partkey") % 3
    d = table(spark, sf, "part").select("p_brand", F.when(three == 0, F.upper(kind)).when(three == 1, F.concat(F.lit("  "), kind)).otherwise(F.lower(kind)).alias("name"))
    return dup.semantic_candidates(d.withColumn("canon", tx.canonical(F.col("name"))), ["p_brand", "name", "canon"], ["p_brand", "canon"], "name")


_PRICE = lambda c: f"coalesce(regexp_replace(CAST({c} AS VARCHAR), '\\.0+$|(\\.[0-9]*?)0+$', '\\1'), '-')"


@query(
    "a8_semantic_variations",
    f"""{WITH_QUOTES}, once AS (SELECT product_id, line, quantity, concat_ws('/', {_PRICE('p_min')}, {_PRICE('p_common')}, {_PRICE('p_max')}, market_status) AS content, count(*) AS n FROM quotes GROUP BY ALL)
    SELECT * FROM (SELECT *, count(*) OVER w AS versions, CAST(sum(n) OVER w AS BIGINT) AS observations FROM once WINDOW w AS (PARTITION BY product_id, line, quantity)) WHERE versions > 1""",
)
def _(spark, sf):
    shown = lambda c: F.coalesce(keys.decimal_key(F.col(c)), F.lit("-"))
    return dup.semantic_variations(quotes(spark, sf), ["product_id", "line", "quantity"], F.concat_ws("/", shown("p_min"), shown("p_common"), shown("p_max"), F.col("market_status")))


_LOGICAL = f"""{WITH_QUOTES}, per AS (SELECT {_K}, quote_date, count(*) AS n FROM quotes GROUP BY {_K}, quote_date),
logical AS (SELECT source_id, quote_date, CAST(sum(n) AS BIGINT) AS observations, count(*) AS contents, CAST(sum(n - 1) AS BIGINT) AS repeated, count(*) FILTER (WHERE n > 1) AS dup_groups,
  CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dup_occurrences FROM per GROUP BY source_id, quote_date)"""


@query("a9_logical_contents", f"{_LOGICAL} SELECT * FROM logical")
def _(spark, sf):
    return dup.logical_contents(quotes(spark, sf), "source_id", "quote_date", CONTENT)


@query(
    "a9_coverage_hash",
    f"""{_LOGICAL}, lines AS (SELECT source_id, date_trunc('month', quote_date) AS m, sha256(string_agg(source_id || '|' || quote_date || '|' || contents, chr(10) ORDER BY quote_date)) AS h, count(*) AS n FROM logical GROUP BY source_id, m)
    SELECT sha256(string_agg(h, chr(10) ORDER BY source_id, m)) AS digest, CAST(sum(n) AS BIGINT) AS rows FROM lines""",
)
def _(spark, sf):
    logical = dup.logical_contents(quotes(spark, sf), "source_id", "quote_date", CONTENT)
    line = F.concat_ws("|", F.col("source_id").cast("string"), F.col("quote_date").cast("string"), F.col("contents").cast("string"))
    # a source's month is one bucket
    return dup.ordered_hash(logical, line, ["source_id", "quote_date"], F.struct("source_id", F.trunc("quote_date", "month").alias("m")))


@query(
    "a10_duplicate_totals",
    f"{WITH_QUOTES}, g AS (SELECT count(*) AS n FROM quotes GROUP BY {_K} HAVING count(*) > 1) SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS occurrences, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM g",
)
def _(spark, sf):
    return dup.duplicate_totals(quotes(spark, sf), CONTENT)


_CANON = f"{WITH_QUOTES}, canon AS (SELECT id, {_K}, min(id) OVER g AS canonical_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY {_K} ORDER BY id) AS position FROM quotes WINDOW g AS (PARTITION BY {_K}))"


@query("w1_w2_w3_canonical", f"{_CANON} SELECT * FROM canon")
def _(spark, sf):
    return dup.with_canonical(quotes(spark, sf).select("id", *CONTENT), CONTENT, "id")


# a provenance with gaps and errors: built up to an id, every 50th row lost, every 70th pointed at its own origin
_PROV = f"""{_CANON}, upto AS (SELECT id, min(id) OVER (PARTITION BY {_K}) AS c FROM quotes WHERE id <= {BASELINE}),
prov AS (SELECT CASE WHEN id % 91 = 0 THEN id + 500 ELSE id END AS origin_id, CASE WHEN id % 77 = 0 THEN id ELSE c END AS quote_id FROM upto WHERE id % 53 <> 0)"""


def _prov(spark, sf):
    p = dup.build_provenance(quotes(spark, sf).select("id", *CONTENT), CONTENT, "id", BASELINE)
    i = F.col("origin_id")
    return p.filter(i % 53 != 0).select(F.when(i % 91 == 0, i + 500).otherwise(i).alias("origin_id"), F.when(i % 77 == 0, i).otherwise(F.col("quote_id")).alias("quote_id"))


@query(
    "e1_build_provenance",
    f"{WITH_QUOTES} SELECT id AS origin_id, min(id) OVER (PARTITION BY {_K}) AS quote_id, count(*) OVER (PARTITION BY {_K}) AS group_size, row_number() OVER (PARTITION BY {_K} ORDER BY id) AS position FROM quotes WHERE id <= {BASELINE}",
)
def _(spark, sf):
    return dup.build_provenance(quotes(spark, sf), CONTENT, "id", BASELINE)


@query(
    "e2_provenance_metrics",
    f"""{_PROV} SELECT count(DISTINCT id) AS rows, count(origin_id) AS provenances, count(DISTINCT origin_id) AS covered, count(*) FILTER (WHERE origin_id IS NULL) AS missing, count(DISTINCT canonical_id) AS canonical,
    count(*) FILTER (WHERE position = 1 AND group_size > 1) AS groups, count(*) FILTER (WHERE group_size > 1) AS occurrences, count(*) FILTER (WHERE position > 1) AS excess FROM canon LEFT JOIN prov ON origin_id = id""",
)
def _(spark, sf):
    return dup.provenance_metrics(quotes(spark, sf).select("id", *CONTENT), _prov(spark, sf), CONTENT, "id")


@query(
    "e3_ambiguous_groups",
    f"""{_PROV} SELECT {_K}, count(DISTINCT id) AS originals, count(DISTINCT origin_id) AS covered, least(count(DISTINCT quote_id), 2) AS targets, min(quote_id) AS target, min(canonical_id) AS canonical
    FROM canon LEFT JOIN prov ON origin_id = id GROUP BY {_K} HAVING originals <> covered OR targets <> 1 OR target <> canonical""",
)
def _(spark, sf):
    return dup.ambiguous_groups(quotes(spark, sf).select("id", *CONTENT), _prov(spark, sf), CONTENT, "id")


@query(
    "e4_invalid_provenance",
    f"""{_PROV}, x AS (SELECT p.origin_id, p.quote_id, CASE WHEN p.origin_id IS NULL THEN 'no_origin' WHEN c.id IS NULL THEN 'unknown_origin' WHEN t.id IS NULL THEN 'unknown_target' WHEN p.quote_id <> c.canonical_id THEN 'not_canonical' END AS problem
    FROM prov p LEFT JOIN canon c ON c.id = p.origin_id LEFT JOIN quotes t ON t.id = p.quote_id) SELECT * FROM x WHERE problem IS NOT NULL""",
)
def _(spark, sf):
    return dup.invalid_provenance(quotes(spark, sf).select("id", *CONTENT), _prov(spark, sf), CONTENT, "id")


@query(
    "e4_invalid_history",
    f"""{_PROV}, {COLLECTIONS}, hist AS (SELECT origin_id, quote_id, CASE WHEN origin_id % 59 = 0 THEN origin_id // 1000 + 1 WHEN origin_id % 67 = 0 THEN -5 ELSE origin_id // 1000 END AS collection_id, CASE WHEN origin_id % 61 = 0 THEN 'x' ELSE 'history:' || origin_id END AS key
      FROM (SELECT CASE WHEN origin_id % 71 = 0 THEN NULL WHEN origin_id % 73 = 0 THEN -origin_id WHEN origin_id % 79 = 0 THEN origin_id + {BASELINE} ELSE origin_id END AS origin_id, CASE WHEN origin_id % 83 = 0 THEN -1 ELSE quote_id END AS quote_id FROM prov)),
    ranked AS (SELECT id, collection_id, min(id) OVER (PARTITION BY {_K}) AS canonical_id FROM quotes),
    x AS (SELECT h.origin_id, h.quote_id, CASE WHEN h.origin_id IS NULL THEN 'no_origin' WHEN h.origin_id < 1 THEN 'origin_below_one' WHEN h.origin_id > {BASELINE} THEN 'origin_beyond_checkpoint' WHEN h.key IS DISTINCT FROM 'history:' || h.origin_id THEN 'key'
      WHEN t.id IS NULL THEN 'unknown_target' WHEN c.id IS NULL THEN 'unknown_collection' WHEN o.id IS NOT NULL AND h.collection_id IS DISTINCT FROM o.collection_id THEN 'other_collection' WHEN o.id IS NOT NULL AND h.quote_id IS DISTINCT FROM o.canonical_id THEN 'not_canonical' END AS problem
      FROM hist h LEFT JOIN ranked o ON o.id = h.origin_id LEFT JOIN quotes t ON t.id = h.quote_id LEFT JOIN collections c ON c.id = h.collection_id)
    SELECT problem, count(*) AS n, count(DISTINCT quote_id) AS targets FROM x WHERE problem IS NOT NULL GROUP BY problem""",
)
def _(spark, sf):
    o = F.col("origin_id")
    p = _prov(spark, sf).select(F.when(o % 71 == 0, None).when(o % 73 == 0, -o).when(o % 79 == 0, o + BASELINE).otherwise(o).alias("origin_id"), F.when(o % 83 == 0, -1).otherwise(F.col("quote_id")).alias("quote_id"))
    home = F.expr("origin_id div 1000")
    p = p.select("origin_id", "quote_id", F.when(o % 59 == 0, home + 1).when(o % 67 == 0, -5).otherwise(home).alias("collection_id"), F.when(o % 61 == 0, "x").otherwise(F.concat(F.lit("history:"), o.cast("string"))).alias("key"))
    q = quotes(spark, sf).select("id", "collection_id", *CONTENT)
    bad = dup.invalid_history(q, p, collections(spark, sf).select("id"), CONTENT, "id", "collection_id", BASELINE, "history:")
    return bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("quote_id").alias("targets"))


@query("e5_missing_provenance", f"{_PROV} SELECT id FROM quotes WHERE NOT EXISTS (SELECT 1 FROM prov WHERE origin_id = quotes.id)")
def _(spark, sf):
    from granary.operators.relations import orphans

    return orphans(quotes(spark, sf).select("id"), _prov(spark, sf), "id", "origin_id")


@query(
    "e6_provenance_manifest",
    f"{_PROV} SELECT c.id, c.canonical_id, c.group_size, p.quote_id FROM canon c JOIN prov p ON p.origin_id = c.id WHERE c.group_size > 1",
)
def _(spark, sf):
    rows = dup.with_canonical(quotes(spark, sf).select("id", *CONTENT), CONTENT, "id").filter("group_size > 1")
    return rows.join(_prov(spark, sf), F.col("origin_id") == F.col("id")).select("id", "canonical_id", "group_size", "quote_id")


@query("e7_baseline", f"{_CANON} SELECT id, {_K} FROM canon WHERE position = 1")
def _(spark, sf):
    return dup.baseline(quotes(spark, sf).select("id", *CONTENT), CONTENT, "id")


@query(
    "e8_content_hash",
    f"""{_PROV}, lines AS (SELECT origin_id // 100000 AS b, sha256(string_agg('[' || origin_id || ',' || quote_id || ']', chr(10) ORDER BY origin_id, quote_id)) AS h, count(*) AS n FROM prov GROUP BY b)
    SELECT sha256(string_agg(h, chr(10) ORDER BY b)) AS digest, CAST(sum(n) AS BIGINT) AS rows FROM lines""",
)
def _(spark, sf):
    line = F.concat(F.lit("["), F.col("origin_id").cast("string"), F.lit(","), F.col("quote_id").cast("string"), F.lit("]"))
    return dup.ordered_hash(_prov(spark, sf), line, ["origin_id", "quote_id"], F.floor(F.col("origin_id") / 100000))


@query("e9_occurrence_ordinals", f"{WITH_QUOTES} SELECT id, row_number() OVER (PARTITION BY collection_id, line ORDER BY id) AS ordinal FROM quotes")
def _(spark, sf):
    return dup.occurrence_ordinals(quotes(spark, sf).select("id", "collection_id", "line"), ["collection_id", "line"], "id").select("id", "ordinal")


@query("e10_first_origin", f"{_PROV} SELECT origin_id, quote_id, CASE WHEN row_number() OVER (PARTITION BY quote_id ORDER BY origin_id) = 1 THEN quote_id END AS recorded_origin FROM prov")
def _(spark, sf):
    return dup.first_origin(_prov(spark, sf), "quote_id", "origin_id")


@query(
    "w7_preferred_original",
    f"WITH {COLLECTIONS} SELECT source_id, sha256, id, status FROM collections WHERE sha256 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, sha256 ORDER BY CASE WHEN status = 'processed' THEN 0 ELSE 1 END, id) = 1",
)
def _(spark, sf):
    c = collections(spark, sf).filter("sha256 is not null").select("source_id", "sha256", "id", "status")
    return dup.preferred(c, ["source_id", "sha256"], [F.when(F.col("status") == "processed", 0).otherwise(1), F.col("id")])


@query("w8_latest_collection", f"WITH {COLLECTIONS} SELECT source_id, raw_path, max(id) AS id FROM collections WHERE status = 'pending' AND raw_path IS NOT NULL GROUP BY source_id, raw_path")
def _(spark, sf):
    return collections(spark, sf).filter("status = 'pending' and raw_path is not null").groupBy("source_id", "raw_path").agg(F.max("id").alias("id"))


@query(
    "u1_new_dimension_members",
    "WITH old AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 97 = 0) SELECT p_name, min(p_partkey) AS p_partkey FROM part WHERE p_partkey % 97 <> 0 AND p_name NOT IN (SELECT p_name FROM old) GROUP BY p_name",
)
def _(spark, sf):
    p = table(spark, sf, "part").select("p_name", "p_partkey")
    return dup.insert_new(p.filter("p_partkey % 97 = 0"), p.filter("p_partkey % 97 <> 0"), ["p_name"], "p_partkey")


@query(
    "u2_insert_new_contents",
    f"""{WITH_QUOTES}, first AS (SELECT * FROM quotes WHERE id > {BASELINE} QUALIFY row_number() OVER (PARTITION BY {_K}, variety ORDER BY id) = 1)
    SELECT id, {_K}, variety FROM first f WHERE NOT EXISTS (SELECT 1 FROM quotes q WHERE q.id <= {BASELINE} AND {' AND '.join(f'q.{k} IS NOT DISTINCT FROM f.{k}' for k in [*CONTENT, 'variety'])})""",
)
def _(spark, sf):
    q = quotes(spark, sf).select("id", *CONTENT, "variety")
    return dup.insert_new(q.filter(F.col("id") <= BASELINE), q.filter(F.col("id") > BASELINE), [*CONTENT, "variety"], "id")


@query(
    "u3_first_in_collection",
    f"{WITH_QUOTES} SELECT id, collection_id, line FROM quotes QUALIFY row_number() OVER (PARTITION BY collection_id, line, product_id, market_id, variety, presentation, p_min, p_common, p_max, market_status ORDER BY id) = 1",
)
def _(spark, sf):
    key = ["collection_id", "line", "product_id", "market_id", "variety", "presentation", "p_min", "p_common", "p_max", "market_status"]
    return dup.baseline(quotes(spark, sf), key, "id").select("id", "collection_id", "line")


@query(
    "u5_document_dedup",
    f"""WITH {COLLECTIONS}, best AS (SELECT source_id, sha256, id AS original_id, raw_path AS original_path FROM collections WHERE sha256 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id, sha256 ORDER BY CASE WHEN status = 'processed' THEN 0 ELSE 1 END, id) = 1)
    SELECT c.id, b.original_id, CASE WHEN c.id = b.original_id THEN 'process' WHEN b.original_path IS NULL AND c.raw_path IS NOT NULL THEN 'replace_raw' ELSE 'discard' END AS action FROM collections c JOIN best b USING (source_id, sha256)""",
)
def _(spark, sf):
    c = collections(spark, sf).filter("sha256 is not null").select("id", "source_id", "sha256", "status", "raw_path")
    best = dup.preferred(c, ["source_id", "sha256"], [F.when(F.col("status") == "processed", 0).otherwise(1), F.col("id")])
    best = best.select("source_id", "sha256", F.col("id").alias("original_id"), F.col("raw_path").alias("original_path"))
    action = F.when(F.col("id") == F.col("original_id"), "process").when(F.col("original_path").isNull() & F.col("raw_path").isNotNull(), "replace_raw").otherwise("discard")
    return c.join(best, ["source_id", "sha256"]).select("id", "original_id", action.alias("action"))


@query(
    "x2_logical_delta",
    f"""{WITH_QUOTES}, g AS (SELECT count(*) FILTER (WHERE id > {BASELINE}) AS n, bool_or(id <= {BASELINE}) AS known FROM quotes GROUP BY {_K})
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS inserted, count(*) FILTER (WHERE NOT known) AS logical_new, CAST(coalesce(sum(n - CASE WHEN known THEN 0 ELSE 1 END), 0) AS BIGINT) AS repeated FROM g WHERE n > 0""",
)
def _(spark, sf):
    return dup.logical_delta(quotes(spark, sf), "id", BASELINE, CONTENT)


