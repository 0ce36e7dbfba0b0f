"""The functions that SQL can call: expressions as temporary SQL functions, the rest as pandas functions, parsers as a table function."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text

#: name: (parameters, result, body). Catalyst inlines them.
EXPRESSIONS = {
    "decimal_key": ("x DECIMAL(38,10)", "STRING", r"regexp_replace(CAST(x AS STRING), r'\.0+$|(\.[0-9]*?)0+$', '$1')"),
    "hash_values": ("xs ARRAY<STRING>", "STRING", "sha2(array_join(transform(xs, v -> coalesce(v, '')), '|'), 256)"),
    "basic_name": ("x STRING", "STRING", r"coalesce(trim(regexp_replace(lower(x), r'(?U)\s+', ' ')), '')"),
    "valid_iso_date": ("x STRING", "BOOLEAN", r"coalesce(x RLIKE r'^\d{4}-\d{2}-\d{2}$' AND try_cast(x AS DATE) IS NOT NULL, false)"),
    "valid_sha256": ("x STRING", "BOOLEAN", "coalesce(x RLIKE '^[0-9a-f]{64}$', false)"),
    "valid_amount": ("x STRING", "BOOLEAN", "coalesce(try_cast(x AS DECIMAL(38,10)) >= 0, false)"),
}
PANDAS = {"canonical_text": text._canonical, "ascii_text": text._ascii}


class TableRows:
    """A page's table rows: table, row, cells."""

    def eval(self, html: str):
        from granary.sources.tables import read

        for number, _, row, _, cells, _, _ in read(html).rows:
            yield number, row, cells


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL; again does no harm."""
    for name, (given, result, body) in EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS {result} RETURN {body}")
    for name, function in PANDAS.items():
        spark.udf.register(name, function)
    rows = T.StructType([T.StructField("table", T.IntegerType()), T.StructField("row", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))])
    spark.udtf.register("html_table_rows", F.udtf(TableRows, returnType=rows))
