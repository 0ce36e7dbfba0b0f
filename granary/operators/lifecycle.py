"""States and dimensions over time (U1, U4, U10, U11), reconciliation of reparsed documents (X7), invariants (E11, X15), listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.keys import hash_values
from granary.functions.values import valid_sha256

#: Events that end a collection's pending state, and the states they lead to. Fixed values.
ENDS = {"duplicate": "duplicate", "processed": "processed", "download_error": "download_error", "processing_error": "processing_error"}


def apply_events(collections: DataFrame, events: DataFrame) -> DataFrame:
    """U4: collections after their events, as one fold by id instead of guarded updates one by one.

    collections: id, status, sha256, raw_path, downloaded_at, processed_at, duplicate_of, error. events: id, seq (unique for
    an id), event, at, sha256, raw_path, duplicate_of, error. downloaded and the events of ENDS count only while the state is
    pending, so the first of the latter counts and nothing of them after it; replace_raw counts where a hash is known and the
    state is pending or processed. Events of unknown ids change nothing; collections without events stay as they are.
    """
    given = collections.select("id", F.col("status").alias("was"), F.col("sha256").alias("had"))
    each = Window.partitionBy("id")
    e = events.join(given, "id")
    pending = F.col("was") == "pending"
    e = e.withColumn("end", F.min(F.when(pending & F.col("event").isin(*ENDS), F.col("seq"))).over(each))
    open_ = pending & (F.col("end").isNull() | (F.col("seq") < F.col("end")))
    e = e.withColumn("down", (F.col("event") == "downloaded") & open_)
    e = e.withColumns({"known": F.col("had").isNotNull() | F.coalesce(F.min(F.when(F.col("down"), F.col("seq"))).over(each) < F.col("seq"), F.lit(False)), "ending": F.max(F.when(F.col("seq") == F.col("end"), F.col("event"))).over(each)})
    state = F.when(open_ | F.col("end").isNull(), F.col("was")).otherwise(F.col("ending"))
    e = e.withColumn("moved", F.col("down") | ((F.col("event") == "replace_raw") & F.col("known") & state.isin("pending", "processed")))
    last = lambda c, when: F.max_by(c, F.when(when, F.col("seq")))
    ends = F.col("seq") == F.col("end")
    new = e.groupBy("id").agg(
        F.max("ending").alias("ending"), F.bool_or("down").alias("down"), F.bool_or("moved").alias("moved"), last("sha256", F.col("down") | (ends & (F.col("event") == "duplicate"))).alias("n_sha"), last("raw_path", F.col("moved")).alias("n_path"),
        last("at", F.col("down") | (ends & (F.col("event") == "duplicate"))).alias("n_down"), last("at", ends).alias("n_at"), last("duplicate_of", ends).alias("n_of"), last("error", ends).alias("n_error"),
    )
    c, end = F.col, F.col("ending")
    out = collections.join(new, "id", "left")
    return out.select(
        "id", F.coalesce(end, c("status")).alias("status"), F.coalesce("n_sha", "sha256").alias("sha256"), F.when(end == "duplicate", None).when(c("moved"), c("n_path")).otherwise(c("raw_path")).alias("raw_path"),
        F.coalesce("n_down", "downloaded_at").alias("downloaded_at"), F.when(end == "duplicate", None).when(end == "processed", c("n_at")).otherwise(c("processed_at")).alias("processed_at"),
        F.when(end == "duplicate", c("n_of")).otherwise(c("duplicate_of")).alias("duplicate_of"), F.when(end.isin("duplicate", "processed"), None).when(end.isNotNull(), c("n_error")).otherwise(c("error")).alias("error"),
    )


def upsert_dimension(existing: DataFrame, arriving: DataFrame, name: str, ordinal: str, fills: Sequence[str]) -> DataFrame:
    """Id, name and fills of a dimension after rows arrive: get or create, and of each fill the first value known wins.

    existing: id, name, fills; arriving: name, ordinal, fills. New names get the next ids in the order of their first arrival;
    a null name creates nothing.
    """
    first = arriving.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(ordinal).alias("_first"), *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(f"_{c}") for c in fills])
    old = existing.join(first, name, "left").select("id", name, *[F.coalesce(c, f"_{c}").alias(c) for c in fills])
    new = first.join(existing.select(name), name, "left_anti")
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    # a dimension's new members are few beside the facts; numbers follow from counts of arrivals by bucket
    from .relations import numbered

    new = numbered(new, F.floor(F.col("_first") / 100_000), ["_first"], "_n").crossJoin(F.broadcast(top))
    return old.unionByName(new.select((F.col("_top") + F.col("_n")).alias("id"), name, *[F.col(f"_{c}").alias(c) for c in fills]))


def reset_backfill(state: DataFrame, source: Column, category: Column | None = None) -> DataFrame:
    """The states that a reset leaves: all but those of the source (and category)."""
    gone = F.col("source_id").eqNullSafe(source)
    return state.filter(~(gone if category is None else gone & F.col("category").eqNullSafe(category)))


class Correction(NamedTuple):
    #: quote_id, key, canonical_id, is_canonical: every quote to correct and the one that holds its corrected key
    updates: DataFrame
    #: key, representative, occurrences: contents that no quote holds yet
    inserts: DataFrame
    #: collection_id, key, canonical_id (null: the insert's), ordinal, provenance_key: a row for every recovered occurrence
    links: DataFrame
    #: key, holder: corrected keys that another quote holds already, which forbids the correction
    conflicts: DataFrame


def plan_correction(updates: DataFrame, recovered: DataFrame, quotes: DataFrame, label: str) -> Correction:
    """U10. updates: quote_id, key (corrected content key); recovered: collection_id, collection_key, key; quotes: id, key.

    A corrected key belongs to the quote that holds it, or else to the least of those corrected to it. Of recovered
    occurrences of a key that no corrected quote gets, the first by collection becomes a quote.
    """
    holder = quotes.select("key", F.col("id").alias("holder"))
    groups = updates.groupBy("key").agg(F.min("quote_id").alias("least"), F.collect_set("quote_id").alias("ids"))
    held = groups.join(holder, "key", "left")
    foreign = F.col("holder").isNotNull() & ~F.array_contains("ids", F.col("holder"))
    conflicts = held.filter(foreign).select("key", "holder")
    chosen = held.filter(~foreign).select("key", F.coalesce("holder", "least").alias("canonical_id"))
    ups = updates.join(chosen, "key").select("quote_id", "key", "canonical_id", (F.col("quote_id") == F.col("canonical_id")).alias("is_canonical"))
    loose = recovered.join(groups.select("key"), "key", "left_anti")
    taken = loose.join(holder, "key").select("key", "holder").distinct()
    inserts = loose.join(holder.select("key"), "key", "left_anti").groupBy("key").agg(F.min("collection_id").alias("representative"), F.count(F.lit(1)).alias("occurrences"))
    order = F.row_number().over(Window.partitionBy("collection_key", "key").orderBy("collection_id"))
    links = recovered.withColumn("ordinal", order).join(chosen, "key", "left")
    key = F.concat(F.lit(f"{label}:"), hash_values(F.lit(label), F.col("collection_key"), F.col("key"), F.col("ordinal")))
    return Correction(ups, inserts, links.select("collection_id", "key", "canonical_id", "ordinal", key.alias("provenance_key")), conflicts.unionByName(taken))


def reconcile(members: DataFrame, scopes: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, sources). What re-parsing the raw files of duplicates gives again.

    members: group_id, source, quote_id, collection_id, key; scopes: collection_id, state (ok, no_raw, no_hash, error); parsed:
    collection_id, key, a row for each quote that the parser gives now. A group's key in a collection is reproduced if the
    parser gives it there. groups: rows, scopes by state, and class: full, partial, not_reproduced or unverifiable.
    sources: scopes processed, fully, partly and not reproduced, keys reproduced, lost and extra, and repeats of the parser.
    """
    made = parsed.groupBy("collection_id", "key").agg(F.count(F.lit(1)).alias("times"))
    asked = members.select("group_id", "source", "collection_id", "key").distinct().join(scopes, "collection_id", "left").join(made, ["collection_id", "key"], "left")
    ok = F.col("state") == "ok"
    state = F.when(ok & F.col("times").isNotNull(), "reproduced").when(ok, "not_reproduced").otherwise(F.coalesce("state", F.lit("no_raw")))
    asked = asked.withColumn("found", state)
    n = lambda s: F.count_if(F.col("found") == s)
    groups = asked.groupBy("group_id", "source").agg(F.countDistinct("collection_id").alias("scopes"), n("reproduced").alias("reproduced"), n("not_reproduced").alias("not_reproduced"), n("no_raw").alias("no_raw"), n("no_hash").alias("no_hash"), n("error").alias("errors"), F.count(F.lit(1)).alias("states"))
    kind = F.when(F.col("reproduced") == F.col("states"), "full").when(F.col("reproduced") > 0, "partial").when(F.col("not_reproduced") > 0, "not_reproduced").otherwise("unverifiable")
    rows = members.groupBy("group_id").agg(F.countDistinct("quote_id").alias("rows"))
    groups = groups.withColumn("class", kind).drop("states").join(rows, "group_id")
    keys = asked.filter(ok).select("source", "collection_id", "key", "times").distinct()
    per = keys.groupBy("source", "collection_id").agg(F.count(F.lit(1)).alias("expected"), F.count("times").alias("matched"))
    given = made.groupBy("collection_id").agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("times") - 1).alias("repeats"))
    per = per.join(given, "collection_id", "left").withColumn("extra", F.coalesce("keys", F.lit(0)) - F.col("matched"))
    c = F.col
    sources = per.groupBy("source").agg(
        F.count(F.lit(1)).alias("scopes"), F.count_if(c("matched") == c("expected")).alias("full"), F.count_if((c("matched") > 0) & (c("matched") < c("expected"))).alias("partial"), F.count_if(c("matched") == 0).alias("none"),
        F.sum("matched").alias("reproduced"), F.sum(c("expected") - c("matched")).alias("lost"), F.sum("extra").alias("extra"), F.coalesce(F.sum("repeats"), F.lit(0)).alias("repeats"),
    )
    return groups, sources


def holds(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """A row for every rule and row: name, holds (false where a part is null)."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.coalesce(v, F.lit(False)).alias("holds")) for k, v in rules.items()]))
    return df.select(*keep, each.alias("_r")).select(*keep, "_r.name", "_r.holds")


#: Fields of a recovery's summary, the target classes that a document has, and the historical least values. Fixed values.
RECOVERY_FIELDS = "collections unique_pdfs stored_target_rows parsed_target_occurrences rows_to_update existing_provenance_rows existing_provenance_reassignments recovered_occurrences unique_collision_documents unique_distinctions logical_inserts recovery_provenance_rows canonical_key_updates legacy_duplicate_keys_preserved_until_baseline".split()
TARGET_CLASSES = 4
FLOORS = {
    "collections": 143, "unique_pdfs": 45, "stored_target_rows": 450, "parsed_target_occurrences": 572, "rows_to_update": 450,
    "existing_provenance_rows": 450, "recovered_occurrences": 122, "unique_collision_documents": 35, "unique_distinctions": 40, "logical_inserts": 40,
}


def recovery_rules() -> dict[str, Column]:
    """The arithmetic of a recovery's summary, and its floors."""
    c = F.col
    complete, positive = F.lit(True), F.lit(True)
    for f in RECOVERY_FIELDS:
        complete, positive = complete & c(f).isNotNull(), positive & (c(f) >= 0)
    rules = {
        "complete": complete, "non_negative": positive,
        "pdfs_within_collections": (c("unique_pdfs") > 0) & (c("unique_pdfs") <= c("collections")),
        "occurrences_by_collections": c("parsed_target_occurrences") == c("collections") * TARGET_CLASSES,
        "stored_are_updated": c("stored_target_rows") == c("rows_to_update"),
        "updates_have_provenance": c("existing_provenance_rows") == c("rows_to_update"),
        "provenance_stays": c("existing_provenance_reassignments") == 0,
        "recovered_is_deficit": c("recovered_occurrences") == c("parsed_target_occurrences") - c("rows_to_update"),
        "recovered_have_provenance": c("recovery_provenance_rows") == c("recovered_occurrences"),
        "collisions_within_pdfs": c("unique_collision_documents") <= c("unique_pdfs"),
        "distinctions_cover_collisions": c("unique_distinctions") >= c("unique_collision_documents"),
        "inserts_within_distinctions": (c("logical_inserts") > 0) & (c("logical_inserts") <= c("unique_distinctions")),
        "updates_by_role": c("canonical_key_updates") + c("legacy_duplicate_keys_preserved_until_baseline") == c("rows_to_update"),
    }
    return rules | {f"floor_{f}": c(f) >= least for f, least in FLOORS.items()}


def marker_rules() -> dict[str, Column]:
    """What a baseline's marker must agree with: itself, and the store as it is (columns now_*)."""
    c = F.col
    numbers = "schema_version checkpoint source_max_id result_max_id source_quotes result_quotes removed_quotes source_logical dup_groups dup_occurrences dup_excess date_buckets provenance_rows historical_rows distinct_origins canonical_targets collections_preserved".split()
    positive = F.lit(True)
    for f in numbers:
        positive = positive & (c(f) >= 0)
    return {
        "schema_version": c("schema_version") == 1, "non_negative": positive, "checkpoint": c("checkpoint") >= 0, "source_max_is_checkpoint": c("source_max_id") == c("checkpoint"),
        "result_max_within": c("result_max_id") <= c("checkpoint"), "removed_is_difference": c("source_quotes") - c("result_quotes") == c("removed_quotes"), "removed_is_excess": c("removed_quotes") == c("dup_excess"),
        "logical_is_result": c("source_logical") == c("result_quotes"), "excess_is_repeats": c("dup_occurrences") - c("dup_groups") == c("dup_excess"), "date_buckets": c("date_buckets") >= 0, "coverage_hash": valid_sha256(c("coverage_hash")),
        "quotes_now": c("now_quotes") == c("result_quotes"), "max_id_now": c("now_max_id") == c("result_max_id"), "provenance_now": c("now_provenance_rows") == c("provenance_rows"), "provenance_max_now": c("now_provenance_max") == c("provenance_max"),
        "historical_now": c("now_historical_rows") == c("historical_rows"), "origins_now": c("now_distinct_origins") == c("distinct_origins"), "targets_now": c("now_canonical_targets") == c("canonical_targets"),
        "collections_now": c("now_collections") == c("collections_preserved"), "origins_are_source": c("distinct_origins") == c("source_quotes"), "targets_are_result": c("canonical_targets") == c("result_quotes"),
        "no_orphan_quotes": c("now_orphan_quotes") == 0, "no_orphan_collections": c("now_orphan_collections") == 0, "no_duplicates": c("now_duplicate_groups") == 0, "provenance_hash": valid_sha256(c("provenance_hash")), "provenance_hash_now": c("now_provenance_hash") == c("provenance_hash"),
    }


#: Names of the feed's markets: by source, by market of a source, by origin of a source. Fixed values.
FEED_BY_SOURCE = {"ceasa-pe": "CEASA/PE - RECIFE", "ceasa-campinas": "CEASA/SP - CAMPINAS"}
FEED_BY_MARKET = {"curitiba": "CEASA/PR - CURITIBA", "cascavel": "CEASA/PR - CASCAVEL", "foz-do-iguacu": "CEASA/PR - FOZ DO IGUACU", "londrina": "CEASA/PR - LONDRINA", "maringa": "CEASA/PR - MARINGA"}
FEED_BY_ORIGIN = {"grande bh": "CEASAMINAS - BELO HORIZONTE", "barbacena": "CEASAMINAS - BARBACENA"}


def feed_market(source: Column, market: Column) -> Column:
    """The feed's name of a source's market, null where it has none."""
    from granary.functions.text import match_text

    table = lambda d: F.create_map(*[F.lit(x) for pair in d.items() for x in pair])
    at = lambda d, k: F.try_element_at(table(d), k)
    return F.coalesce(at(FEED_BY_SOURCE, source), F.when(source == "ceasa-pr", at(FEED_BY_MARKET, market)), F.when((source == "ceasa-mg") & (F.coalesce(market, F.lit("")) != ""), at(FEED_BY_ORIGIN, match_text(market))))


def target_path(c: Column, old: bool = False) -> Column:
    """A stored path as raw/..., null if it is blank, absolute, goes up or lies elsewhere; old paths may begin with data/."""
    p = F.regexp_replace(F.replace(F.trim(c), F.lit("\\"), F.lit("/")), r"(?:^|(?<=/))\.(?:/+|$)|(?<=/)/+|/+$", "")
    p = F.regexp_replace(p, "^data/", "") if old else p
    bad = F.trim(c).rlike(r"^[/\\]") | F.array_contains(F.split(p, "/"), "..")
    return F.when(~bad & p.rlike(r"^raw/[^/]+/.+"), p)


#: Names of the managed files of each backup layer: name-yyyymmdd or name-yyyy-mm-dd and an archive's ending. Fixed value.
LISTED = r"^[\w.-]*?(\d{4})-?(\d{2})-?(\d{2})[\w.-]*\.(?:tar\.gz|tgz|tar\.zst|zip|zpaq)$"


def listing(entries: DataFrame, layers: Sequence[str]) -> DataFrame:
    """Layer, name, size, day, reason of a remote listing (layer, name, size, mod_time): the first reason to ignore an entry, null if valid."""
    part = lambda k: F.regexp_extract("name", LISTED, k)
    day = F.try_to_date(F.concat_ws("-", part(1), part(2), part(3)), "yyyy-MM-dd")
    reason = (
        F.when(F.col("name").isNull(), "missing_name").when(F.col("size").isNull() | (F.col("size") < 0), "invalid_size").when(~F.col("layer").isin(*layers), "unknown_layer")
        .when(F.col("name").contains("/"), "unsafe_name").when(~F.col("name").rlike(LISTED), "unmanaged_name").when(day.isNull(), "invalid_date")
    )
    return entries.select("layer", "name", "size", F.when(reason.isNull(), day).alias("day"), reason.alias("reason"))
