"""Raw documents: where registered files are, recovery plans, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import lookup_names, unsafe_path


def trace(registered: DataFrame, found: DataFrame) -> DataFrame:
    """Class of each registered file. registered: id, path, digest; found: path, digest (null: unreadable).

    unsafe_path, no_path, missing_hash, then by what is found: exact_match, hash_mismatch (a file is at the path, whatever lies
    elsewhere), unreadable, relocated_match (one other place with a file of that name and hash), ambiguous_candidates
    (several), missing.
    """
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    here = found.select(F.col("path").alias("_path"), F.col("digest").alias("at_digest"), F.lit(True).alias("there"))
    rows = registered.join(here, F.col("path") == F.col("_path"), "left").drop("_path")
    # only files that aren't at their place look elsewhere; names are tried with and without a numeric suffix
    names = found.filter("digest is not null").select(F.explode(lookup_names(name(F.col("path")))).alias("name"), "digest", F.col("path").alias("other")).distinct()
    lost = rows.filter("there is null and path is not null and digest is not null").select("id", F.explode(lookup_names(name(F.col("path")))).alias("name"), "digest")
    places = lost.join(names, ["name", "digest"]).groupBy("id").agg(F.countDistinct("other").alias("places"))
    rows = rows.join(places, "id", "left")
    state = (
        F.when(F.col("path").isNull(), "no_path").when(unsafe_path(F.col("path")), "unsafe_path").when(F.col("digest").isNull(), "missing_hash")
        .when(F.col("there") & F.col("at_digest").isNull(), "unreadable").when(F.col("at_digest") == F.col("digest"), "exact_match").when(F.col("there"), "hash_mismatch")
        .when(F.col("places") == 1, "relocated_match").when(F.col("places") > 1, "ambiguous_candidates").otherwise("missing")
    )
    return rows.select("id", state.alias("state"))


def select_candidates(inventory: DataFrame, evidence: DataFrame) -> DataFrame:
    """Backups worth searching, in order. inventory: path, size, day, layer; evidence: path, sha256, size.

    Dropped: without evidence, with conflicting evidence, of another size than proven, or of a content that an earlier one
    (by day, layer, path) has. state: candidate, no_manifest, conflict, size_mismatch, represented.
    """
    proof = evidence.groupBy("path").agg(F.size(F.collect_set(F.struct("sha256", "size"))).alias("signatures"), F.min("sha256").alias("sha256"), F.min("size").alias("proven_size"))
    rows = inventory.join(proof, "path", "left")
    state = F.when(F.col("signatures").isNull(), "no_manifest").when(F.col("signatures") > 1, "conflict").when(F.col("size") != F.col("proven_size"), "size_mismatch")
    rows = rows.withColumn("bad", state)
    order = Window.partitionBy("bad", "sha256").orderBy("day", "layer", "path")
    rows = rows.withColumn("n", F.row_number().over(order))
    return rows.select("path", "sha256", "day", "layer", F.coalesce("bad", F.when(F.col("n") == 1, "candidate").otherwise("represented")).alias("state"))


def plan_recovery(missing: DataFrame, evidence: DataFrame) -> DataFrame:
    """For each missing file found (with its first evidence by day and path), not_found or invalid_target.

    missing: id, path, digest; evidence: digest, backup, day.
    """
    first = evidence.groupBy("digest").agg(F.min(F.struct("day", "backup")).alias("e")).select("digest", "e.backup", "e.day")
    rows = missing.join(first, "digest", "left")
    state = F.when(F.col("path").isNull() | unsafe_path(F.col("path")), "invalid_target").when(F.col("backup").isNotNull(), "found").otherwise("not_found")
    return rows.select("id", "digest", state.alias("state"), F.when(state == "found", F.col("backup")).alias("backup"), F.when(state == "found", F.col("day")).alias("day"))


def recovery_counters(plan: DataFrame) -> DataFrame:
    """One row of counts over a plan."""
    n = lambda s: F.count_if(F.col("state") == s)
    return plan.agg(F.count(F.lit(1)).alias("missing"), F.countDistinct("digest").alias("hashes"), n("found").alias("found"), n("not_found").alias("not_found"), n("invalid_target").alias("invalid_target"))


def flatten_manifests(manifests: DataFrame) -> DataFrame:
    """The proven layers of finished manifests. manifests: name, body (JSON with status, schema, name, layers by name)."""
    layer = "struct<package:string,validated:boolean,uploaded:string,path:string,sha256:string,size:bigint>"
    body = F.from_json("body", f"status string, schema int, name string, layers map<string, {layer}>")
    rows = manifests.withColumn("b", body).filter("b.status = 'completed' and b.schema = 1 and b.name = name").select("name", F.explode("b.layers").alias("layer", "x"))
    ok = "x.package = 'completed' and x.validated and x.uploaded = 'completed' and x.sha256 rlike '^[0-9a-f]{64}$' and x.size >= 0 and endswith(x.path, name)"
    return rows.filter(ok).select("name", "layer", "x.path", "x.sha256", "x.size")
