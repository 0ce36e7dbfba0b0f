"""Raw files, the secondary feed, archive members."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Form of a raw file's name. Fixed value.
#: category[_yyyy-mm-dd]_yyyymmdd[_-]hhmmss[_n].extension
NAME = r"^(.+?)(?:_(\d{4}-\d{2}-\d{2}))?_(\d{8}[_-]\d{6})(?:_\d+)?\.(html|pdf)$"
# Column names of the feed. Fixed values.
FEED_COLUMNS = ("dsc_ceasa", "dsc_produto", "sig_unidade_medida", "data_preco", "preco_diario")


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """Html and pdf files of a folder (not of folders within): path, name, content, sha256."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{html,pdf}").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content", F.sha2("content", 256).alias("sha256"))


def with_name_parts(files: DataFrame, name: str = "name") -> DataFrame:
    """Category, target_date, downloaded_at from the file's name; bad_name where it has another form."""
    part = lambda k: F.nullif(F.regexp_extract(name, NAME, k), F.lit(""))
    at = F.try_to_timestamp(F.replace(part(3), F.lit("-"), F.lit("_")), F.lit("yyyyMMdd_HHmmss"))
    return files.withColumns({"category": part(1), "target_date": F.try_to_date(part(2), "yyyy-MM-dd"), "downloaded_at": at, "bad_name": at.isNull() | part(1).isNull()})


def decoded(files: DataFrame) -> DataFrame:
    """S3: text of files that are UTF-8 throughout; null for others."""
    return files.withColumn("text", F.try_validate_utf8(F.col("content").cast("string")))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The secondary feed; `;`, latin-1, header. Raises ValueError if a required column is missing."""
    feed = spark.read.csv(path, sep=";", encoding="ISO-8859-1", header=True)
    feed = feed.toDF(*[c.strip().lower() for c in feed.columns])
    lost = sorted(set(FEED_COLUMNS) - set(feed.columns))
    if lost:
        raise ValueError(f"the feed has no column {', '.join(lost)}")
    return feed


def feed_rows(feed: DataFrame) -> DataFrame:
    """The feed in the form that `complement` takes: ordinal, market, day, product, unit, price."""
    from granary.functions import text, values

    ordinal = F.monotonically_increasing_id() if "ordinal" not in feed.columns else F.col("ordinal")
    return feed.select(
        ordinal.alias("ordinal"), text.match_text(F.col("dsc_ceasa")).alias("market"), values.date_feed(F.col("data_preco")).alias("day"),
        text.match_text(F.col("dsc_produto")).alias("product"), values.unit_feed(F.col("sig_unidade_medida")).alias("unit"), values.money_feed(F.col("preco_diario")).alias("price"),
    )


def archive_members(archives: DataFrame) -> DataFrame:
    """Path, member, name, sha256 of every file in ZIP archives (path, content); unreadable archives have one row with error."""

    def run(batches: Iterator) -> Iterator:
        import hashlib
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():
                            if not info.is_dir():
                                digest = hashlib.sha256()
                                with z.open(info) as f:
                                    while part := f.read(1 << 20):
                                        digest.update(part)
                                rows.append((path, info.filename, info.filename.rsplit("/", 1)[-1], digest.hexdigest(), None))
                except Exception as e:  # noqa: BLE001 - any broken archive is a finding, not a failure
                    rows.append((path, None, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["path", "member", "name", "sha256", "error"])

    return archives.select("path", "content").mapInPandas(run, "path string, member string, name string, sha256 string, error string")


def archive_format(name):
    """By the file's ending: tar.gz, tar.zst, zip, zpaq or null."""
    return F.nullif(F.replace(F.regexp_extract(F.lower(name), r"\.(tar\.gz|tgz|tar\.zst|zip|zpaq)$", 1), F.lit("tgz"), F.lit("tar.gz")), F.lit(""))


def origin_url(source_url, category, day=None):
    """Where a category's page of a day was, with the category encoded."""
    base = F.concat(F.regexp_replace(source_url, "/+$", ""), F.lit("/"), F.url_encode(category))
    return base if day is None else F.when(day.isNull(), base).otherwise(F.concat(base, F.lit("?date="), F.date_format(day, "yyyy-MM-dd")))
