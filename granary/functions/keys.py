"""Reproducible keys. The order of parts is part of a key's meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical


def decimal_key(c: Column) -> Column:
    """K1: a decimal's plain text without trailing zeros; null for null."""
    return F.regexp_replace(c.cast("string"), r"\.0+$|(\.[0-9]*?)0+$", "$1")


def decimal_text_key(c: Column) -> Column:
    """K1 for text: as decimal_key, or INVALID: and the text if it is no number."""
    number = c.try_cast("decimal(38,10)")
    return F.when(c.isNull(), None).when(number.isNull(), F.concat(F.lit("INVALID:"), c)).otherwise(decimal_key(number))


def hash_values(*cs: Column) -> Column:
    """K2: SHA-256 of the parts joined by |, null as ''. Null and '' so have one key; structured_key tells them apart."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cs]), 256)


def structured_key(*cs: tuple[str, Column]) -> Column:
    """K3: SHA-256 of a JSON array of {type, value}; null, '' and 0 are all different. cs: (type, column)."""
    part = lambda kind, c: F.struct(F.when(c.isNull(), "null").otherwise(F.lit(kind)).alias("type"), c.cast("string").alias("value"))
    return F.sha2(F.to_json(F.array(*[part(k, c) for k, c in cs]), {"ignoreNullFields": "false"}), 256)


def content_signature(low: Column, common: Column, high: Column, status: Column) -> Column:
    """K6: decimal keys and canonical status, joined by U+001F."""
    return F.concat_ws("\x1f", *[F.coalesce(decimal_key(c), F.lit("")) for c in (low, common, high)], canonical(status))


def identity_key(source: Column, market: Column, category: Column, product: Column, presentation: Column, origin: Column, classification: Column, date: Column) -> Column:
    return hash_values(source, market, category, product, presentation, origin, classification, date)


def content_key(identity: Column, low: Column, common: Column, high: Column, status: Column) -> Column:
    return hash_values(identity, decimal_key(low), decimal_key(common), decimal_key(high), status)


def collection_key(source: Column, path: Column, digest: Column, url: Column, at: Column) -> Column:
    return hash_values(source, path, digest, url, at)


def presentation_key(original: Column, normalized: Column, symbol: Column, packaging: Column, low: Column, high: Column, detail: Column) -> Column:
    return hash_values(original, normalized, symbol, packaging, decimal_key(low), decimal_key(high), detail)


def provenance_key(collection: Column, content: Column, source: Column, url: Column, date: Column, ordinal: Column) -> Column:
    return hash_values(collection, content, source, url, date, ordinal)


def feed_key(market: Column, date: Column, product: Column, unit: Column) -> list[Column]:
    """The four parts that the secondary feed matches by."""
    from .text import match_text
    from .values import unit_feed

    return [match_text(market), date, match_text(product), unit_feed(unit)]
