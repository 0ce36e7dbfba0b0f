"""HTML tables to rows of cells with the standard library, and table dialects over them."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import text as tx
from granary.functions import values

ROWS = T.StructType(
    [T.StructField("doc", T.LongType()), T.StructField("table", T.IntegerType()), T.StructField("table_class", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("row_class", T.StringType())]
    + [T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("cell_classes", T.ArrayType(T.StringType())), T.StructField("dates", T.ArrayType(T.StringType()))]
)


class Tables(HTMLParser):
    """Rows of all tables: (table, its class, row, its class, cells, their classes, data-date attributes); and all text, and links."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables, self.rows, self.stack, self.text, self.links = 0, [], [], [], []
        self.row: dict | None = None
        self.cell: list[str] | None = None
        self.link: list | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag == "table":
            self.stack.append((self.tables, a.get("class")))
            self.tables += 1
        elif tag == "tr" and self.stack:
            self.end_row()
            self.row = {"cells": [], "classes": [], "dates": [], "class": a.get("class")}
        elif tag in ("td", "th") and self.row is not None:
            self.end_cell()
            self.cell = []
            self.row["classes"].append(a.get("class") or a.get("id"))
        elif tag == "a":
            self.link = [a.get("href"), []]
        if a.get("data-date") and self.row is not None:
            self.row["dates"].append(a["data-date"])

    def end_cell(self) -> None:
        if self.cell is not None and self.row is not None:
            self.row["cells"].append(" ".join("".join(self.cell).split()) or None)
        self.cell = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row is not None and self.row["cells"] and self.stack:
            table, kind = self.stack[-1]
            self.rows.append((table, kind, len(self.rows), self.row["class"], self.row["cells"], self.row["classes"], self.row["dates"]))
        self.row = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.end_cell()
        elif tag == "tr":
            self.end_row()
        elif tag == "table" and self.stack:
            self.end_row()
            self.stack.pop()
        elif tag == "a" and self.link is not None:
            self.links.append((self.link[0], " ".join("".join(self.link[1]).split())))
            self.link = None

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.cell is not None:
            self.cell += [data, " "]
        if self.link is not None:
            self.link[1].append(data)


def read(html: str | None) -> Tables:
    parser = Tables()
    parser.feed(html or "")
    parser.close()
    parser.end_row()
    return parser


def table_rows(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """A row for each row of each table of each page."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = [(d, *r) for d, h in zip(batch["doc"], batch["html"], strict=True) for r in read(h).rows]
            yield pd.DataFrame(out, columns=[f.name for f in ROWS.fields])

    return docs.select(F.col(doc).cast("long").alias("doc"), F.col(html).alias("html")).mapInPandas(run, ROWS)


def page_links(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """Doc, position, href, label of every link of a page."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = [(d, k, href, label) for d, h in zip(batch["doc"], batch["html"], strict=True) for k, (href, label) in enumerate(read(h).links)]
            yield pd.DataFrame(out, columns=["doc", "position", "href", "label"])

    return docs.select(F.col(doc).cast("long").alias("doc"), F.col(html).alias("html")).mapInPandas(run, "doc long, position int, href string, label string")


def _priced(rows: DataFrame, product, unit, low, common, high, **more) -> DataFrame:
    cols = {"product": product, "unit": unit, "p_min": values.money_br(low), "p_common": values.money_br(common), "p_max": values.money_br(high)} | more
    return rows.select("doc", "row", *[c.alias(n) for n, c in cols.items()])


def cell(k: int):
    return F.get("cells", F.lit(k))


def parse_seven_cells(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """Tables of class contacao_lista, rows of exactly seven cells but the header; the date stands in the table's text."""
    rows = table_rows(docs, doc, html).filter("table_class = 'contacao_lista'")
    day = values.date_br(F.nullif(F.regexp_extract(F.array_join(F.flatten(F.collect_list("cells")), " "), r"(\d{2}/\d{2}/\d{4})", 1), F.lit("")))
    days = rows.groupBy("doc").agg(day.alias("quote_date"))
    quotes = rows.filter((F.size("cells") == 7) & cell(0).isNotNull() & (tx.match_key(cell(0)) != "produto"))
    return _priced(quotes, cell(0), cell(2), cell(3), cell(4), cell(5), classification=cell(1)).join(days, "doc")


def parse_eight_cells(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """Rows of class tr with at least eight cells; the date is an attribute of a button in the row."""
    rows = table_rows(docs, doc, html).filter("array_contains(split(row_class, ' '), 'tr') and size(cells) >= 8 and table = 0")
    return _priced(rows, F.coalesce(cell(0), F.lit("")), cell(1), cell(4), cell(5), cell(6), origin=cell(2), classification=cell(3), market_status=cell(7), quote_date=values.date_br(F.get("dates", F.lit(0))))


def _named_cell(name: str):
    """The first cell whose class has that word."""
    named = F.transform("cells", lambda c, i: F.when(F.get("cell_classes", i).contains(name), c))
    return F.try_element_at(F.filter(named, lambda x: x.isNotNull()), F.lit(1))


def parse_grid(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """P10: rows of a grid whose cells are known by a word in their class."""
    rows = table_rows(docs, doc, html).filter("row_class rlike '(^| )scGridField(Odd|Even)( |$)'")
    at = {n: _named_cell(n) for n in ("prdnom", "embdesresu", "pboprcmin", "pboprccomum", "pboprcmax", "mersit")}
    return _priced(rows, at["prdnom"], at["embdesresu"], at["pboprcmin"], at["pboprccomum"], at["pboprcmax"], market_status=at["mersit"]).filter("product is not null")


def parse_matrix(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """Product by city tables, unpivoted: a row for each product and city with a price; dates come from lines `city - date`."""
    rows = table_rows(docs, doc, html)
    keys = F.transform("cells", tx.latin_key)
    rows = rows.withColumn("keys", keys)
    head = rows.filter("array_contains(keys, 'produtos') and array_contains(keys, 'embalagens')").groupBy("doc").agg(F.min(F.struct("row", "cells", "keys")).alias("h"))
    names = head.select("doc", "h.row", F.posexplode("h.cells").alias("k", "city"), F.array_position("h.keys", "produtos").alias("p"), F.array_position("h.keys", "embalagens").alias("u"))
    names = names.filter("city is not null and k + 1 <> p and k + 1 <> u").withColumnRenamed("row", "head_row")
    body = rows.select("doc", "row", "cells").join(names, "doc").filter("row > head_row")
    last = names.groupBy("doc").agg(F.max("k").alias("last"))
    body = body.join(last, "doc").filter("size(cells) > last")
    body = body.select("doc", "row", F.get("cells", F.col("p") - 1).alias("product"), F.get("cells", F.col("u") - 1).alias("unit"), F.col("city").alias("market"), values.money_matrix(F.get("cells", "k")).alias("p_common"))
    body = body.filter("product is not null and p_common is not null")
    days = docs.select(F.col(doc).cast("long").alias("doc"), F.explode(F.split(F.regexp_replace(html, "<[^>]+>", "\n"), "\n")).alias("line"))
    days = days.select("doc", tx.match_key(F.substring_index("line", "-", 1)).alias("city_key"), values.date_br(F.nullif(F.regexp_extract("line", r"-.*?(\d{2}/\d{2}/\d{4})", 1), F.lit(""))).alias("quote_date"))
    days = days.filter("quote_date is not null and city_key <> ''").groupBy("doc", "city_key").agg(F.max("quote_date").alias("quote_date"))
    return body.withColumn("city_key", tx.match_key(F.col("market"))).join(days, ["doc", "city_key"], "left").drop("city_key")



# Forms of a day in a link's text or address. Fixed values.
LINK_DAY = r"(?<!\d)(\d{2}/\d{2}/\d{4})(?!\d)"
LINK_LONG_DAY = r"(?i)\b(\d{1,2})\s+de\s+(\p{L}+)\s+de\s+(20\d{2})\b"
LINK_URL_DAY = r"(?<!\d)(\d{1,2})[-_/](\d{1,2})[-_/](20\d{2})(?!\d)"


def dated_links(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """page_links with the day that a link's text tells, in long or short form, or else its address; null if neither does."""
    part = lambda c, pattern, k: F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))
    month = tx.month_number(part("label", LINK_LONG_DAY, 2))
    day = lambda y, m, d: F.try_to_date(F.format_string("%s-%s-%s", y, m, d), "yyyy-M-d")
    long_day = F.when(month.isNotNull(), day(part("label", LINK_LONG_DAY, 3), month.cast("string"), part("label", LINK_LONG_DAY, 1)))
    in_url = F.when(part("href", LINK_URL_DAY, 3).isNotNull(), day(*[part("href", LINK_URL_DAY, k) for k in (3, 2, 1)]))
    return page_links(docs, doc, html).withColumn("day", F.coalesce(long_day, values.date_br(part("label", LINK_DAY, 1)), in_url))


def month_links(docs: DataFrame, doc: str = "doc", html: str = "html") -> DataFrame:
    """Doc, year, month, href of links whose text or address names a month and a year; one row for each address."""
    links = page_links(docs, doc, html).filter("href is not null")
    said = F.lower(tx.strip_accents(F.concat_ws(" ", "label", "href")))
    year = F.nullif(F.regexp_extract(said, r"(?<!\d)(20\d{2})(?!\d)", 1), F.lit("")).cast("int")
    month = F.coalesce(*[F.when(said.contains(name), F.lit(number)) for name, number in tx.MONTHS.items()])
    out = links.select("doc", "position", year.alias("year"), month.alias("month"), "href").filter("year is not null and month is not null")
    return out.groupBy("doc", "href").agg(F.min_by("year", "position").alias("year"), F.min_by("month", "position").alias("month"))


def page_urls(docs: DataFrame, base, doc: str = "doc", html: str = "html") -> DataFrame:
    """Doc, url of the further pages that a page links to (page= in the address), each once, against its own address."""
    links = page_links(docs, doc, html).filter(F.col("href").contains("page="))
    own = docs.select(F.col(doc).cast("long").alias("doc"), base.alias("base"))
    root = F.regexp_extract("base", r"^(\w+://[^/]+)", 1)
    href = F.col("href")
    url = (
        F.when(href.rlike(r"^\w+://"), href).when(href.startswith("//"), F.concat(F.substring_index("base", "//", 1), href)).when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(F.substring_index("base", "?", 1), href)).otherwise(F.concat(F.regexp_replace(F.substring_index("base", "?", 1), r"[^/]*$", ""), href))
    )
    return links.join(own, "doc").select("doc", url.alias("url")).distinct()


# What a result table of seven cells tells of itself, and pages that say that the service is down. Fixed values.
RESULT_CATEGORY = r"(?i)\b([\p{L} ]+?)\s+\d{2}/\d{2}/\d{4}"
UNAVAILABLE = r"(?i)service unavailable|temporarily unavailable|indispon[ií]vel"


def seven_cell_problems(docs: DataFrame, category, day, doc: str = "doc", html: str = "html") -> DataFrame:
    """Doc, problem of pages that don't answer what was asked: unavailable, layout, wrong_category, no_date, wrong_date, no_rows."""
    rows = table_rows(docs, doc, html).filter("table_class = 'contacao_lista'")
    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda x: x["cells"])), " ")
    quote = (F.size("cells") == 7) & cell(0).isNotNull() & (tx.match_key(cell(0)) != "produto")
    found = rows.withColumn("quote", quote).groupBy("doc").agg(text.alias("text"), F.bool_or("quote").alias("quotes"))
    asked = docs.select(F.col(doc).cast("long").alias("doc"), F.col(html).alias("html"), category.alias("category"), day.alias("day")).join(found, "doc", "left")
    said = values.date_br(F.nullif(F.regexp_extract("text", r"(\d{2}/\d{2}/\d{4})", 1), F.lit("")))
    name = F.nullif(F.trim(F.regexp_extract("text", RESULT_CATEGORY, 1)), F.lit(""))
    problem = (
        F.when(F.col("text").isNull() & F.coalesce(F.col("html").rlike(UNAVAILABLE), F.lit(False)), "unavailable").when(F.col("text").isNull(), "layout").when(~tx.match_key(name).eqNullSafe(tx.match_key(F.col("category"))), "wrong_category")
        .when(said.isNull(), "no_date").when(said != F.col("day"), "wrong_date").when(~F.col("quotes"), "no_rows")
    )
    return asked.select("doc", problem.alias("problem")).filter("problem is not null")
