"""Text bulletins to quotes (P3 to P9), as DataFrame plans.

A document is exploded to numbered lines. What a line says about those after it (section, product, unit, variety) is carried
forward by a window over the document's lines; prices, units and the rest come from expressions. Every dialect gives the
columns of QUOTE; what a bulletin doesn't tell is null. Null and empty texts have no quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import text as tx
from granary.functions import values

QUOTE = ("doc", "n", "category", "product", "unit", "origin", "classification", "variety", "p_min", "p_common", "p_max", "market_status", "quote_date", "place")

# Patterns and vocabularies of the bulletins. Fixed values.
PRICE = r"(?<!\d)\d+(?:\.\d{3})*,\d{2}(?!\d)"
BA_DATE = r"EMISS[AÃ]O\s*:\s*(\d{2}/\d{2}/\d{4})"
BA_SECTIONS = ("cereais", "frutas", "hortalicas", "outrosgenerosalimenticios", "ovos")
BA_UNIT = r"(?i)\b(?:CENTO|CX\.?|FRD\.?|KG|MOL\.?|PCT\.?|SC\.?|UND\.?)\b"
BA_ORIGIN = r"^[A-Z]{2}(?:[/;][A-Z]{2})*$"
RJ_DATE = r"\b(\d{2}/\d{2}/\d{4})\b"
RJ_SECTION = r"^\d+\.\s+(.+?)(?:\s+S/C)?$"
RJ_UNIT = r"(?i)\b(?:Ama|Cx|kg|Mol|Pct|Preg|Sc|Unid)\b"
RJ_TRAILER = r"(?:S/C|[-+]?\d+(?:,\d+)?%?)\s*$"
GO_PRICE = r"(?<!\d)\d+(?:\.\d{3})*,\d{2,3}(?!\d)"
GO_PERIOD = r"Periodo\s*:\s*(\d{2}/\d{2}/\d{4})"
GO_URL_DATE = r"(?<!\d)(\d{1,2})[-_/](\d{1,2})[-_/](20\d{2})(?!\d)"
GO_SECTION = r"^\d{2}\s*-\s*(.+)$"
GO_UNITS = "bd bdj cx dz eng kg mao mc mol pct pe plt sc un uni".split()
GO_HEADERS = "centraisdeabastecimentodegoias cotacaodepreco pagina emitido todosprodutos periodo hora modelo nomeprodutoqtdeem kg embalagem padrao class precoemr comummaximominimokg linksiminformatica".split()
PR_PRICE = r"\d{1,3}(?:\.\d{3})*,\d{2}"
PR_DATE = r"Data da Coleta:\s*(\d{2}/\d{2}/\d{4})"
PR_UNIT = r"(?i)\b(?:cx|sc|un|pct|bdj|kg|fardo|saco|caixa|bandeja|molho|ma.o|\d+(?:,\d+)?\s*(?:kg|g|l|ml|un|unid)|\d+\s*UNID)\b"
PR_HEADERS = "centraisdeabastecimentos mercadodoprodutor coletadeprecos datadacoleta produtotipounidade embalagem situacao mercadomin diamax anteriorvar pagina".split()
PR_HEADERS_WITH = (("pesomedio", "proced", "unit"), ("produto", "unidade", "embalagem"), ("mercado", "min", "max"))
PR_FOOTERS = ("Centrais de Abastecimentos", "Mercado do Produtor")
PR_SITUATIONS = "estavel firme fraco ausente alta baixa normal".split()
PR_KINDS = "comum grauda graudo importada importado media medio nacional pequena pequeno".split()
CE_PRICE = r"(?<!\d)\d{1,3}(?:\.\d{3})*,\d{2}(?!\d)"
CE_DATE = r"(?i)(?:Emissao|BOLETIM INFORMATIVO DIARIO DE)\s*:?\s*(\d{2}/\d{2}/\d{4})"
CE_SITUATIONS = "ent sinf est fir fra aus sin".split()
CE_UNIT = r"(?i)\b(?:CX\.?\s*\d*(?:\s*KG)?|SC\.?\s*\d*(?:\s*KG)?|KG|CENTO|MOLHO|PE|UND|UMA|UNIDADE)\b"
CE_HEADERS = "centraisdeabastecimentodocearasa nucleodeeconomiaeestatistica sistemadeinformacaodemercadoagricola preconoatacado frutasundsit hortalicasundsit cereaisundsit carnesundsit outrosundsit emissao legenda fonte email fone av".split()
CAMPINAS_PRICE = r"(?<!\d)\d+(?:[.,]\d{2})(?!\d)"
CAMPINAS_DATE = r"Cotacao Realizada em:\s*(\d{2}/\d{2}/\d{4})"
CAMPINAS_HEADERS = "centraisdeabastecimentodecampinassa formulariodecotacaoceasacampinasboletimnumero cotacaorealizadaem produtovariedade produtovariedadesubvariedadeclassificacaovalor minimocomummaximo minimo valor comum maximo mercado".split()
CAMPINAS_MARKERS = ("Produto Variedade", "SubVariedade", "Classificacao", "Valor", "Minimo", "Maximo", "Mercado")
DF_DATE = r"DATA:\s*(\d{2}\.\d{2}\.\d{4})"
DF_STATUS = r"\b(?:AUS|ENT|EST|FIR|FRA|SINF)\b"
DF_CATEGORIES = ("hortalicas", "frutas", "ovos")
DF_PRODUCT_END = r"(?i)\s+-\s+(?=\(|CX|DZ|KG|PCT|SC|UND|PROC)"
DF_UNIT = r"(?i)\(([^()]*(?:CX|DZ|KG|PCT|SC|UND)[^()]*)\)"
DF_INLINE_UNIT = r"(?i)\s+-\s+((?:CX|DZ|KG|PCT|SC|UND)\.?(?:\s+[^-]+)?)\s+PROC"
DF_ORIGIN = r"\bPROC\.?\s*-?\s*([A-Z/. -]+)"
DF_APPLE = "maca"
DF_VARIETY = r"(?i)^(?:(.+?)\s+)?(CAT\s*-?\s*1\b.*|COMERCIAL\s*-\s*SOLTA\b.*)$"
#: Where the right column of a two-column page starts if its headers don't tell, and the least place that they may tell.
COLUMN_BREAK = 118
LEAST_BREAK = 80
LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"

def _none() -> Column:
    return F.lit(None).cast("string")


def lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, n, raw, line: the lines in order; line is collapsed, null if nothing is in it."""
    out = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(text, LINE_ENDS)).alias("n", "raw"))
    return out.select("doc", "n", "raw", tx.clean(F.col("raw")).alias("line"))


def along(*by: str) -> Window:
    """Up to the line itself, within the document."""
    return Window.partitionBy("doc", *by).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)


def carried(c: Column, *by: str) -> Column:
    """The last value so far that isn't null, along the document's lines."""
    return F.last(c, ignorenulls=True).over(along(*by))


def group(c: Column | str, pattern: str, k: int = 1) -> Column:
    """A group of the pattern's first match, null without one."""
    return F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))


def split_at(c: Column, pattern: str) -> tuple[Column, Column]:
    """The text before the pattern's first match, and from it on; the whole and null without one."""
    at = F.regexp_instr(c, F.lit(pattern))
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c), F.when(at > 0, F.substring(c, at, F.char_length(c)))


def starts_with_one(key: Column, words) -> Column:
    return key.rlike("^(?:" + "|".join(words) + ")")


def first_prices(d: DataFrame, price: str, n: int) -> DataFrame:
    """Lines with at least n prices: found (all), before (the first), parts (the text around them)."""
    d = d.withColumn("found", F.regexp_extract_all("line", F.lit(price), F.lit(0))).filter(F.size("found") >= n)
    return d.withColumn("parts", F.split("line", price, -1)).withColumn("before", F.trim(F.get("parts", F.lit(0))))


def after_prices(price: str, n: int) -> Column:
    """The text after the n-th price."""
    return F.get(F.split("line", price, n + 1), F.lit(n))


def last_prices(d: DataFrame, price: str, n: int) -> DataFrame:
    """Lines with at least n prices: found (the last n), before (the first of these), after (the last)."""
    d = d.withColumn("found", F.regexp_extract_all("line", F.lit(price), F.lit(0))).filter(F.size("found") >= n)
    other = rf"(?:(?!{price}).)*"
    before = F.trim(F.regexp_extract("line", rf"^(.*?){price}(?:{other}{price}){{{n - 1}}}{other}$", 1))
    return d.withColumns({"before": before, "after": F.trim(F.element_at(F.split("line", price), -1)), "found": F.slice("found", -n, n)})


def quotes(d: DataFrame, docs: DataFrame, doc: str, date: Column, prices: tuple[int, int, int] = (0, 1, 2), money=values.money_br, **more: Column) -> DataFrame:
    """The columns of QUOTE from the given ones, the prices at those places of found, and the date of each document."""
    days = docs.select(F.col(doc).alias("doc"), date.alias("quote_date"))
    cols = {name: _none() for name in QUOTE if name not in ("doc", "n", "quote_date")} | more
    cols |= {name: money(F.get("found", F.lit(k))) for name, k in zip(("p_min", "p_common", "p_max"), prices, strict=True)}
    d = d.select("doc", "n", *[c.alias(name) for name, c in cols.items()]).filter("product is not null")
    return d.join(days, "doc").select(*QUOTE)


def parse_ba(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, **_) -> DataFrame:
    """Three prices at the end, an origin before them, a unit that ends the product; the market status may follow."""
    d = lines(docs, doc, text).filter("line is not null")
    section = F.when(tx.match_key(F.col("line")).isin(*BA_SECTIONS), tx.slug(F.col("line")))
    d = d.withColumn("section", section).withColumn("category", carried(F.col("section"))).filter("section is null")
    d = last_prices(d, PRICE, 3).withColumn("origin", F.element_at(F.split("before", " "), -1)).filter(F.col("origin").rlike(BA_ORIGIN))
    d = d.withColumn("before", F.trim(F.regexp_replace("before", r"\S+$", "")))
    product, unit = split_at(F.col("before"), BA_UNIT)
    d = d.withColumns({"product": tx.clean(product), "unit": tx.clean(unit)}).filter("unit is not null")
    d = _with_default(d, docs, doc, category)
    return quotes(d, docs, doc, values.date_br(group(text, BA_DATE)), category=F.col("category"), product=F.col("product"), unit=F.col("unit"), origin=F.col("origin"), market_status=F.nullif("after", F.lit("")))


def _with_default(d: DataFrame, docs: DataFrame, doc: str, category: Column | None) -> DataFrame:
    """d with the document's own category where no section told one."""
    if category is None:
        return d
    return d.join(docs.select(F.col(doc).alias("doc"), category.alias("default_category")), "doc").withColumn("category", F.coalesce("category", "default_category"))


def parse_rj(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, **_) -> DataFrame:
    """Numbered sections; three prices at the end, before them S/C or a change in percent that is cut off; a unit is required."""
    d = lines(docs, doc, text).filter("line is not null")
    d = d.withColumn("section", tx.slug(group("line", RJ_SECTION))).withColumn("category", carried(F.col("section"))).filter("section is null")
    d = last_prices(d, PRICE, 3).withColumn("before", F.trim(F.regexp_replace("before", RJ_TRAILER, "")))
    product, unit = split_at(F.col("before"), RJ_UNIT)
    d = _with_default(d.withColumns({"product": tx.clean(product), "unit": tx.clean(unit)}).filter("unit is not null"), docs, doc, category)
    return quotes(d, docs, doc, values.date_br(group(text, RJ_DATE)), category=F.col("category"), product=F.col("product"), unit=F.col("unit"))


def parse_go(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, url: Column | None = None, **_) -> DataFrame:
    """P5: four prices at the end: common, most, least, per kilogram. A prefix of one or two words is a class of the product before.

    The date is the period's, or else the text's first, or else the one in the document's address.
    """
    d = lines(docs, doc, text).filter("line is not null")
    d = d.filter(~starts_with_one(tx.match_key(F.col("line")), GO_HEADERS))
    section = group("line", GO_SECTION)
    d = d.withColumn("section", tx.slug(section)).withColumn("category", carried(F.col("section"))).withColumn("part", F.count("section").over(along())).filter("section is null")
    d = last_prices(d, GO_PRICE, 4).filter("before <> ''").withColumn("words", F.split("before", " "))
    # what the line itself says: words but a number in front, a class in digits, and the unit from the last unit word on
    said = F.when((F.size("words") > 1) & F.get("words", F.lit(0)).rlike(r"^\d+$"), F.slice("words", F.lit(2), F.size("words"))).otherwise(F.col("words"))
    d = d.withColumn("said", said).withColumn("class", F.when(F.element_at("said", -1).rlike(r"^\d+$"), F.element_at("said", -1)))
    d = d.withColumn("said", F.when(F.col("class").isNotNull(), F.slice("said", F.lit(1), F.size("said") - 1)).otherwise(F.col("said")))
    d = d.withColumn("at", F.array_max(F.transform("said", lambda w, i: F.when(tx.latin_key(w).isin(*GO_UNITS), i))))
    joined = lambda a: F.nullif(F.array_join(a, " "), F.lit(""))
    own = F.struct(joined(F.when(F.col("at").isNull(), F.col("said")).otherwise(F.slice("said", F.lit(1), F.col("at")))).alias("product"), joined(F.slice("said", F.col("at") + 1, F.size("said"))).alias("unit"))
    d = d.withColumn("own", own)
    before = Window.partitionBy("doc", "part").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("known", F.count("own.product").over(before) > 0)
    sets = F.col("own.product").isNotNull() & ((F.size("words") > 2) | ~F.col("known"))
    d = d.withColumn("sets", sets).withColumn("held", carried(F.when(F.col("sets"), F.col("own")), "part"))
    d = d.filter(F.col("sets") | (F.col("known") & (F.size("words") <= 2)))
    d = _with_default(d, docs, doc, category)
    first = group(text, RJ_DATE)
    in_url = F.lit(None).cast("date") if url is None else F.try_to_date(F.concat_ws("-", *[F.regexp_extract(url, GO_URL_DATE, k) for k in (3, 2, 1)]), "yyyy-M-d")
    date = F.coalesce(values.date_br(group(tx.strip_accents(F.col(text)), GO_PERIOD)), values.date_br(first), in_url)
    return quotes(d, docs, doc, date, (2, 0, 1), category=F.col("category"), product=F.col("held.product"), unit=F.col("held.unit"), classification=F.when(F.col("sets"), F.col("class")).otherwise(F.col("before")))


def parse_pr(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, target_date: Column | None = None, **_) -> DataFrame:
    """Four prices or more, the last of the prefix's words may be the market status. Lines without price name the product.

    An indented line, one that starts with a kind or with a word twice is a class of that product; else its first word is the
    product. P14: the date is the document's target where the text tells none. category is the market's (place).
    """
    d = lines(docs, doc, text).filter("line is not null")
    key = tx.match_key(F.col("line"))
    header = starts_with_one(key, PR_HEADERS)
    for words in PR_HEADERS_WITH:  # all of them, in any order
        header = header | key.rlike("^" + "".join(f"(?=.*{w})" for w in words))
    d = d.filter(~header).withColumn("named", carried(F.when(~F.col("line").rlike(PR_PRICE), F.col("line"))))
    d = first_prices(d, PR_PRICE, 4)
    tail = F.regexp_replace(F.when(F.size("found") >= 5, after_prices(PR_PRICE, 5)).otherwise(after_prices(PR_PRICE, 4)), "(?:" + "|".join(PR_FOOTERS) + ").*$", "")
    last = F.element_at(F.split("before", " "), -1)
    d = d.withColumn("status", F.when(F.col("before").contains(" ") & tx.match_key(last).isin(*PR_SITUATIONS), last))
    d = d.withColumn("rest", F.when(F.col("status").isNotNull(), F.trim(F.regexp_replace("before", r" \S+$", ""))).otherwise(F.col("before")))
    kind, unit = split_at(F.col("rest"), PR_UNIT)
    d = d.withColumns({"kind": tx.clean(kind), "unit": tx.clean(unit)})
    d = d.withColumn("keys", F.transform(F.split("kind", " "), tx.latin_key))
    one, two = F.get("keys", F.lit(0)), F.get("keys", F.lit(1))
    goes_on = F.col("kind").isNull() | (F.col("named").isNotNull() & (F.col("raw").rlike(r"^\s") | F.coalesce(one == two, F.lit(False)) | one.isin(*PR_KINDS)))
    d = d.withColumn("goes_on", goes_on)
    product = F.when(F.col("goes_on"), F.col("named")).otherwise(F.get(F.split("kind", " "), F.lit(0)))
    classification = F.when(F.col("goes_on"), F.col("kind")).otherwise(group("kind", r"^\S+ (.+)$"))
    d = d.withColumns({"product": product, "classification": classification, "origin": tx.clean(tail)})
    if category is not None:
        d = d.join(docs.select(F.col(doc).alias("doc"), category.alias("place")), "doc")
    date = values.date_br(group(text, PR_DATE))
    date = date if target_date is None else F.coalesce(date, target_date)
    return quotes(
        d, docs, doc, date, category=F.lit("nao-informada"), product=F.col("product"), unit=F.col("unit"), origin=F.col("origin"),
        classification=F.col("classification"), market_status=F.col("status"), place=_none() if category is None else F.col("place"),
    )


def parse_ce(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, **_) -> DataFrame:
    """Three prices, the last situation word before them ends the description; upper-case lines name the product.

    category is `market-category`.
    """
    d = lines(docs, doc, text).filter("line is not null")
    d = d.withColumn("key", tx.match_key(F.col("line"))).filter(~starts_with_one(F.col("key"), CE_HEADERS))
    names = ~F.col("line").rlike(r"\d") & (F.col("key") != "") & (F.upper("line") == F.col("line")) & F.col("line").rlike(r"\p{L}")
    d = d.withColumn("named", carried(F.when(names, F.col("line"))))
    d = first_prices(d, CE_PRICE, 3).withColumn("words", F.split("before", " "))
    d = d.withColumn("at", F.array_max(F.transform("words", lambda w, i: F.when(tx.latin_key(w).isin(*CE_SITUATIONS), i))))
    d = d.withColumns({"status": F.get("words", F.col("at")), "rest": F.when(F.col("at").isNull(), F.col("before")).otherwise(F.array_join(F.slice("words", F.lit(1), F.col("at")), " "))})
    # the unit is found in the text without accents, which is as long as with them
    at = F.when(F.col("at").isNotNull(), F.regexp_instr(tx.strip_accents(F.col("rest")), F.lit(CE_UNIT)))
    d = d.withColumn("from", F.nullif(at, F.lit(0)))
    said = tx.clean(F.when(F.col("from").isNull(), F.col("rest")).otherwise(F.substring(F.col("rest"), F.lit(1), F.col("from") - 1)))
    d = d.withColumns({"said": said, "unit": tx.clean(F.substring(F.col("rest"), F.col("from"), F.char_length("rest")))})
    same = F.startswith(tx.match_key(F.col("said")), tx.match_key(F.col("named")))
    rest = F.when(same, tx.clean(F.substring(F.col("said"), F.char_length("named") + 1, F.char_length("said")))).otherwise(F.col("said"))
    d = d.withColumns({"product": F.coalesce("named", "said"), "classification": F.when(F.col("named").isNotNull(), rest)})
    origin = tx.clean(after_prices(CE_PRICE, 3))
    d = d.withColumn("origin", F.when(~origin.rlike(r"^[-.]+$"), origin))
    if category is not None:
        d = d.join(docs.select(F.col(doc).alias("doc"), category.alias("slug")), "doc")
    else:
        d = d.withColumn("slug", _none())
    return quotes(
        d, docs, doc, values.date_br(group(tx.strip_accents(F.col(text)), CE_DATE)), category=F.coalesce(group("slug", r"^[^-]*-(.+)$"), F.lit("nao-informada")), product=F.col("product"), unit=F.col("unit"),
        origin=F.col("origin"), classification=F.col("classification"), market_status=F.col("status"), place=F.substring_index("slug", "-", 1),
    )


def parse_campinas(docs: DataFrame, doc: str = "doc", text: str = "text", category: Column | None = None, **_) -> DataFrame:
    """A product may take several lines up to the one with its prices. Documents without a date are rejected: no quotes.

    Upper-case lines after a blank one are sections; the line right after a priced one belongs to it and is skipped.
    """
    d = lines(docs, doc, text)
    plain = tx.strip_accents(F.col("line"))
    d = d.withColumn("plain", plain)
    places = F.filter(F.array(*[F.instr("plain", m) for m in CAMPINAS_MARKERS]), lambda p: p > 1)
    d = d.withColumn("line", F.when(F.size(places) > 0, tx.clean(F.substring(F.col("line"), F.lit(1), F.array_min(places) - 1))).otherwise(F.col("line")))
    order = Window.partitionBy("doc").orderBy("n")
    d = d.withColumn("after_blank", F.lag("line").over(order).isNull()).filter("line is not null")
    d = d.withColumn("priced", F.col("line").rlike(CAMPINAS_PRICE))
    d = d.withColumn("skipped", ~F.col("priced") & ~F.col("after_blank") & F.coalesce(F.lag("priced").over(order), F.lit(False))).filter("not skipped")
    header = starts_with_one(tx.match_key(F.col("line")), CAMPINAS_HEADERS)
    named = ~F.col("line").contains(" - ") & ~F.col("line").rlike(r"\d") & F.col("line").rlike(r"\p{L}") & (F.upper("line") == F.col("line"))
    d = d.withColumn("header", ~F.col("priced") & header).withColumn("section", F.when(~F.col("priced") & ~F.col("header") & F.col("after_blank") & named, tx.slug(F.col("line"))))
    d = d.withColumn("category", carried(F.col("section")))
    # each priced line, header and section ends a run of lines; a priced one takes the run's lines
    ends = F.col("priced") | F.col("header") | F.col("section").isNotNull()
    d = d.withColumn("run", F.coalesce(F.count_if(ends).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), " ")
    d = d.groupBy("doc", "run").agg(F.max("n").alias("n"), whole.alias("line"), F.max_by("priced", "n").alias("priced"), F.max_by("category", "n").alias("category")).filter("priced")
    d = first_prices(d, CAMPINAS_PRICE, 3)
    tail = F.regexp_replace(tx.strip_accents(after_prices(CAMPINAS_PRICE, 3)), "(?:" + "|".join(CAMPINAS_MARKERS) + ").*$", "")
    details = group("before", r"^.*? - (.*)$")
    d = d.withColumns({"product": tx.clean(F.substring_index("before", " - ", 1)), "unit": F.get(F.split(tx.clean(details), " "), F.lit(0)), "classification": group(tx.clean(details), r"^\S+ (.+)$"), "market": F.get(F.split(tx.clean(tail), " "), F.lit(0))})
    d = _with_default(d, docs, doc, category)
    date = values.date_br(group(tx.strip_accents(F.col(text)), CAMPINAS_DATE))
    out = quotes(d, docs, doc, date, money=values.money_comma, category=F.col("category"), product=F.col("product"), unit=F.col("unit"), classification=F.col("classification"), market_status=F.col("market"))
    return out.filter("quote_date is not null")


def two_columns(docs: DataFrame, doc: str, pages: str) -> DataFrame:
    """Doc, side, n, line of two-column pages (array of text): all left columns, then all right ones.

    The break of a page is the least indentation beyond 80 of a line with PROC., or 118.
    """
    rows = docs.select(F.col(doc).alias("doc"), F.posexplode(pages).alias("page", "text")).select("doc", "page", F.posexplode(F.split("text", LINE_ENDS)).alias("row", "line"))
    indent = F.char_length("line") - F.char_length(F.regexp_replace("line", r"^\s+", ""))
    page = Window.partitionBy("doc", "page")
    cut = F.coalesce(F.min(F.when(is_header(F.col("line")) & (indent > LEAST_BREAK), indent)).over(page), F.lit(COLUMN_BREAK))
    rows = rows.withColumn("cut", cut)
    halves = F.array(F.struct(F.lit(0).alias("side"), F.expr("substring(line, 1, cut)").alias("t")), F.struct(F.lit(1).alias("side"), F.expr("substring(line, cut + 1)").alias("t")))
    rows = rows.select("doc", "page", "row", F.explode(halves).alias("h")).select("doc", "h.side", "page", "row", tx.clean(F.col("h.t")).alias("line")).filter("line is not null")
    return rows.select("doc", "side", F.row_number().over(Window.partitionBy("doc").orderBy("side", "page", "row")).alias("n"), "line")


def is_header(line: Column) -> Column:
    return F.upper(tx.strip_accents(line)).rlike("PROC[. ]")


def parse_two_columns(docs: DataFrame, doc: str = "doc", pages: str = "pages", category: Column | None = None, **_) -> DataFrame:
    """Product lines with PROC. tell product, unit and origin of the quotes after them, which need three prices and a status.

    An apple's variety is carried to the lines that go on with it, up to the next product or category.
    """
    d = two_columns(docs, doc, pages)
    line = F.col("line")
    d = d.withColumn("section", F.when(tx.match_key(line).isin(*DF_CATEGORIES), tx.slug(line))).withColumn("header", F.col("section").isNull() & is_header(line))
    origin = tx.clean(F.regexp_replace(group(F.upper(tx.strip_accents(line)), DF_ORIGIN), r"^[ .-]+|[ .-]+$", ""))
    told = F.struct(tx.clean(F.get(F.split(line, DF_PRODUCT_END, 2), F.lit(0))).alias("product"), tx.clean(F.coalesce(group(line, DF_UNIT), group(line, DF_INLINE_UNIT))).alias("unit"), origin.alias("origin"))
    d = d.withColumn("category", carried(F.col("section"), "side")).withColumn("told", carried(F.when(F.col("header"), told), "side")).filter(F.col("section").isNotNull() | F.col("told").isNotNull())
    marks = d.filter("section is not null or header").select("doc", "side", "n", F.lit("").alias("said"))
    q = last_prices(d.filter("section is null"), PRICE, 3)
    status = group("before", rf"({DF_STATUS})")
    q = q.withColumn("status", status).filter("status is not null")
    q = q.withColumn("given", F.when(~F.col("header"), tx.clean(F.regexp_extract("before", rf"^(.*?){DF_STATUS}", 1))))
    apple = F.coalesce(tx.match_key(F.col("told.product")) == DF_APPLE, F.lit(False))
    q = q.withColumns({"apple": apple, "rest": group("given", DF_VARIETY, 2)})
    # '' ends a variety: a product or category line, and a quote that is no apple's or has no class
    q = q.withColumn("said", F.when(~F.col("apple") | F.col("given").isNull(), "").otherwise(tx.clean(group("given", DF_VARIETY, 1))))
    both = q.unionByName(marks, allowMissingColumns=True).withColumn("mark", F.col("found").isNull())
    order = Window.partitionBy("doc", "side").orderBy("n", F.col("mark").desc()).rowsBetween(Window.unboundedPreceding, 0)
    q = both.withColumn("variety", F.nullif(F.last("said", ignorenulls=True).over(order), F.lit(""))).filter("not mark")
    named = F.when(F.col("apple") & F.col("rest").isNotNull() & F.col("variety").isNotNull(), F.concat_ws(" ", "variety", tx.clean(F.col("rest")))).otherwise(F.col("given"))
    q = _with_default(q.withColumn("classification", named), docs, doc, category)
    date = values.date_br(F.replace(group(F.array_join(pages, "\n"), DF_DATE), F.lit("."), F.lit("/")))
    return quotes(q, docs, doc, date, category=F.col("category"), product=F.col("told.product"), unit=F.col("told.unit"), origin=F.col("told.origin"), classification=F.col("classification"), variety=F.col("variety"), market_status=F.col("status"))


DIALECTS = {"ba": parse_ba, "campinas": parse_campinas, "ce": parse_ce, "go": parse_go, "pr": parse_pr, "rj": parse_rj}


def parse_bulletins(docs: DataFrame, dialect: str, doc: str = "doc", text: str = "text", **more) -> DataFrame:
    """The quotes of text bulletins (doc, text): the columns of QUOTE. more: category, and url (go) or target_date (pr), as Columns of docs."""
    return DIALECTS[dialect](docs, doc, text, **more)
