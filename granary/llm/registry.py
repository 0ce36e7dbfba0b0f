"""The queries of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, fingerprints, html_text, jaccard, language, licenses, mixing, passages, quality, sharding

MODULES = {
    "op1_sharding": sharding,
    "op2_quality_rules": quality,
    "op3_bpe": bpe,
    "op4_fingerprints": fingerprints,
    "op5_license_scan": licenses,
    "op6_language_id": language,
    "op7_mixing": mixing,
    "op8_jaccard_join": jaccard,
    "op9_html_text": html_text,
    "op10_passages": passages,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in MODULES.items() if getattr(module, "SQL", None)}
