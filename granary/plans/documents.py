"""Queries of parsers and scalar functions on literal documents, each with the rows it must give as SQL VALUES."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import keys, units, values
from granary.functions import text as tx
from granary.operators import raw
from granary.sources import bulletins, files, tables

from .base import query


def golden(name: str, columns: str, rows: Sequence[Sequence[str | None]]):
    """Registers a query whose columns, as text, must have these rows."""
    names = columns.split()
    cell = lambda v: "CAST(NULL AS VARCHAR)" if v is None else "'" + v.replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    sql = f"SELECT * FROM (VALUES {body}) AS t({', '.join(chr(34) + n + chr(34) for n in names)})"

    def add(f: Callable[[SparkSession], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            made = f(spark)
            return made.select(*[F.col(n).cast("string").alias(n) for n in names])

        return query(name, sql)(run)

    return add


def literal(spark: SparkSession, texts: Sequence[str | None], name: str = "text") -> DataFrame:
    return spark.createDataFrame(list(enumerate(texts)), f"doc long, {name} string")


def each(name: str, function: Callable[[Column], Column], cases: Sequence[tuple[str | None, str | None]]) -> None:
    """A query of one function: rows (n, given, got)."""
    rows = [(str(k), given, got) for k, (given, got) in enumerate(cases)]

    @golden(name, "n given got", rows)
    def _(spark):
        df = spark.createDataFrame([(k, given) for k, (given, _) in enumerate(cases)], "n int, given string")
        return df.select("n", "given", function(F.col("given")).alias("got"))


# --- scalar functions -----------------------------------------------------------------------------------------------

_joined = lambda c: F.concat_ws("/", c)
each("k4_canonical", tx.canonical, [("Straße  É", "strasse e"), ("ABC", "abc"), (None, ""), (" x\ty ", "x y"), ("ﬁn ＡＢ", "fin ab"), ("São  João", "sao joao")])
each("k8_valid_times", values.valid_time, [("2024-02-29T10:00:00", "true"), ("2024-02-29 10:00", "true"), ("2024-02-29", "true"), ("2024-02-29T10:00:00Z", "true"), ("2023-02-29T10:00:00", "false"), ("x", "false"), (None, "false")])
each("k11_clean", tx.clean, [("  a \t b ", "a b"), ("a\n\n b", "a b"), ("", None), ("  \n", None), (None, None), ("São  Paulo", "São Paulo")])
each("k12_match_keys", tx.match_key, [("Maçã Fuji 1.", "macafuji1"), ("PROC. SP/MG", "procspmg"), ("ß ø é", "e"), ("", ""), (None, None)])
each("k13_slugs", tx.slug, [("--Foz do Iguaçu!", "foz-do-iguacu"), ("Raízes  & Tubérculos", "raizes-tuberculos"), ("...", ""), (None, None)])
each("k14_accents", tx.strip_accents, [("ção ß ø", "cao  "), ("Œuvre Ångström", "uvre Angstrom"), ("plain", "plain"), ("", ""), (None, None)])
each("k15_match_texts", tx.match_text, [("Caixa (20 kg)", "caixa 20 kg"), ("Maçã-Gala", "maca gala"), ("!", ""), (None, "")])
each("k16_feed_values", tx.feed_value, [("  A   b ", "A b"), ("\t", ""), (None, "")])
each("k18_matrix_money", values.money_matrix, [("---", None), ("1.234,50", "1234.5000"), ("1.234", "1.2340"), ("2,5", "2.5000"), ("x", None), (None, None)])
each("k19_comma_money", values.money_comma, [("1.234,50", "1234.5000"), ("12.5", "12.5000"), (" 7,00 ", "7.0000"), ("a", None), (None, None)])
each("k20_feed_money", values.money_feed, [("10.50", "10.5000"), ("10,50", "10.5000"), ("1.234,56", None), ("", None), (None, None)])
each("k22_feed_dates", values.date_feed, [("2026/10/28 00:00:00.000", "2026-10-28"), ("2026-10-28", "2026-10-28"), ("28/10/2026", None), ("2026-02-30", None), (None, None)])
each("k23_feed_units", values.unit_feed, [("Kg", "KG"), ("quilograma", "KG"), ("Unid.", "UN"), ("dúzia", "DZ"), ("caixa", None), (None, None)])
each("k25_lookup_names", lambda c: _joined(tx.lookup_names(c)), [("a_12.pdf", "a_12.pdf/a.pdf"), ("b.pdf", "b.pdf"), ("c_1_2.html", "c_1_2.html/c_1.html"), ("d_7", "d_7/d")])
each("k33_months", tx.month_number, [("Março", "3"), ("dezembro", "12"), (" JANEIRO", "1"), ("may", None), (None, None)])
each("p16_price_tokens", lambda c: _joined(values.price_tokens(c)), [("ALFACE 1.234,50 7,00 8,5 A 3,25", "1.234,50/7,00/3,25"), ("sem 12 preco 1,234", ""), ("0,99", "0,99")])
each("f8_categories", tx.category, [("frutas ", "frutas"), ("Nao Informada", None), ("não-informada", None), (" ", None), (None, None)])
each("f11_unsafe_paths", tx.unsafe_path, [("/a", "true"), ("a/../b", "true"), ("..", "true"), ("a/b..c", "false"), ("raw/a.html", "false")])
each("x12_archive_formats", files.archive_format, [("a.TAR.GZ", "tar.gz"), ("b.tgz", "tar.gz"), ("c.tar.zst", "tar.zst"), ("d.zip", "zip"), ("e.zpaq", "zpaq"), ("f.rar", None), ("tar", None)])


@golden("f9_markets", "name city got", [("Centro", "Recife", "Centro"), (None, "Recife", "Recife"), (None, "Varias Cidades", None), ("A", "varias cidades", "A"), (None, None, None)])
def _(spark):
    df = spark.createDataFrame([("Centro", "Recife"), (None, "Recife"), (None, "Varias Cidades"), ("A", "varias cidades"), (None, None)], "name string, city string")
    return df.select("name", "city", tx.market(F.col("name"), F.col("city")).alias("got"))


@golden("k6_content_signatures", "n signature", [("0", "10\x1f12.5\x1f\x1festavel"), ("1", "\x1f\x1f\x1f"), ("2", "100\x1f0\x1f7.25\x1ffirme a")])
def _(spark):
    df = spark.createDataFrame([(0, "10.00", "12.50", None, "Estável"), (1, None, None, None, None), (2, "100", "0.00", "7.2500", " FIRME  A ")], "n int, a string, b string, c string, s string")
    price = lambda c: F.col(c).cast("decimal(18,4)")
    return df.select("n", keys.content_signature(price("a"), price("b"), price("c"), F.col("s")).alias("signature"))


@query("k3_structured_keys", """SELECT n_nationkey AS id, sha256('[{"type":"str","value":"' || n_name || '"},{"type":"int","value":"' || n_regionkey || '"},' || CASE WHEN n_nationkey % 2 = 0 THEN '{"type":"null","value":null}' ELSE '{"type":"str","value":""}' END || ']') AS key FROM nation""")
def _(spark, sf):
    from granary.session import table

    n = table(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("id"), keys.structured_key(("str", F.col("n_name")), ("int", F.col("n_regionkey")), ("str", F.when(F.col("n_nationkey") % 2 != 0, ""))).alias("key"))


_UNITS = {
    # given: normalized, symbol, description, packaging, qty_min, qty_max, detail
    "KG": ("kg", "kg", "Quilograma", None, "1", None, None),
    "Cx 20 kg": ("caixa 20 kg", "kg", "Quilograma", "caixa", "20", None, None),
    "caixa 18 a 20 kg": ("caixa 18 a 20 kg", "kg", "Quilograma", "caixa", "18", "20", None),
    "Saco 2,50 kg": ("saco 2.5 kg", "kg", "Quilograma", "saco", "2.5", None, None),
    "KG - 20": ("20 kg", "kg", "Quilograma", None, "20", None, None),
    "05 kg": ("5 kg", "kg", "Quilograma", None, "5", None, None),
    "Caixa": ("caixa", None, None, "caixa", "1", None, None),
    "Caixa c/ 12": ("caixa (com 12)", None, None, "caixa", "1", None, "com 12"),
    "Maço": ("maco", "maco", "Maco", "maco", "1", None, None),
    "granel/solto": ("granel solto", None, None, None, None, None, "granel solto"),
    "Cx (20 kg) tipo A": ("caixa 20 kg (( ) tipo a)", "kg", "Quilograma", "caixa", "20", None, "( ) tipo a"),
    "Bj 300g": ("bandeja 300 g", "g", "Grama", "bandeja", "300", None, None),
    "Engradado c/ 100 unid.": ("engradado 100 un (com)", "un", "Unidade", "engradado", "100", None, "com"),
    "Dúzia": ("dz", "dz", "Duzia", None, "1", None, None),
    "  ": (None,) * 7,
}


@golden("k24_units", "given normalized symbol description packaging qty_min qty_max detail", [(k, *v) for k, v in _UNITS.items()])
def _(spark):
    df = units.with_units(spark.createDataFrame([(k,) for k in _UNITS], "given string"), "given")
    return df.select("given", *[F.col("unit")[f].alias(f) for f in units.FIELDS if f != "original"])


# --- bulletins ------------------------------------------------------------------------------------------------------

_COLUMNS = "doc n category product unit origin classification variety p_min p_common p_max market_status quote_date place"


def _quote(n, category, product, unit, low, common, high, day, origin=None, kind=None, variety=None, status=None, place=None, doc="0"):
    money = lambda v: None if v is None else f"{v:.4f}"
    return (doc, str(n), category, product, unit, origin, kind, variety, money(low), money(common), money(high), status, day, place)


_BA = "BOLETIM\nEMISSÃO: 05/08/2026\nFRUTAS\nABACAXI GRANDE CX. 20 KG BA/PE 30,00 1.035,50 40,00 EST\nnot a quote 1,00 2,00 3,00\nHORTALIÇAS\nALFACE UND BA 1,00 1,50 2,00"


@golden("p8_ba_bulletin", _COLUMNS, [_quote(3, "frutas", "ABACAXI GRANDE", "CX. 20 KG", 30, 1035.5, 40, "2026-08-05", "BA/PE", status="EST"), _quote(6, "hortalicas", "ALFACE", "UND", 1, 1.5, 2, "2026-08-05", "BA")])
def _(spark):
    return bulletins.parse_bulletins(literal(spark, [_BA, None, ""]), "ba")


_RJ = "RIO 03/03/2026\n1. RAIZES S/C\nBATATA LISA SC 50 KG S/C 90,00 100,00 110,00\nOVO BRANCO Unid 12% 1,00 2,00 3,00\nCOUVE Mol -3,5% 1,00 2,00 3,00\nsem unidade 1,00 2,00 3,00"


@golden(
    "p7_rj_bulletin", _COLUMNS,
    [_quote(2, "raizes", "BATATA LISA", "SC 50 KG", 90, 100, 110, "2026-03-03"), _quote(3, "raizes", "OVO BRANCO", "Unid", 1, 2, 3, "2026-03-03"), _quote(4, "raizes", "COUVE", "Mol", 1, 2, 3, "2026-03-03"), _quote(0, "frutas", "LIMA", "Cx", 4, 5, 6, None, doc="1")],
)
def _(spark):
    return bulletins.parse_bulletins(literal(spark, [_RJ, "LIMA Cx 4,00 5,00 6,00"]), "rj", category=F.lit("frutas"))


_GO = "Emitido 05/02/2026\nx 04/02/2026\nPeríodo : 01/02/2026\n01 - FRUTAS\n123 BANANA PRATA CX 1 50,00 60,00 40,00 2,500\nEXTRA 51,00 61,00 41,00 2,500\n2 52,00 62,00 42,00 2,500\nSEM UNIDADE AQUI 3,00 4,00 2,00 1,000\nCX 20 KG 1,00 1,00 1,00 1,00\n02 - RAÍZES\nALHO 1,00 2,00 0,50 1,00\nROXO 1,00 2,00 0,50 1,00"


@golden(
    "p5_go_bulletin", _COLUMNS,
    [
        _quote(4, "frutas", "BANANA PRATA", "CX", 40, 50, 60, "2026-02-01", kind="1"), _quote(5, "frutas", "BANANA PRATA", "CX", 41, 51, 61, "2026-02-01", kind="EXTRA"), _quote(6, "frutas", "BANANA PRATA", "CX", 42, 52, 62, "2026-02-01", kind="2"),
        _quote(7, "frutas", "SEM UNIDADE AQUI", None, 2, 3, 4, "2026-02-01"), _quote(8, "frutas", "CX 20", "KG", 1, 1, 1, "2026-02-01"), _quote(10, "raizes", "ALHO", None, 0.5, 1, 2, "2026-02-01"),
        _quote(11, "raizes", "ALHO", None, 0.5, 1, 2, "2026-02-01", kind="ROXO"), _quote(0, None, "UVA", "KG", 3, 1, 2, "2026-01-09", doc="1"),
    ],
)
def _(spark):
    docs = spark.createDataFrame([(0, _GO, None), (1, "UVA KG 1,00 2,00 3,00 1,00", "https://example.org/a-9-1-2026.pdf")], "doc long, text string, url string")
    return bulletins.parse_bulletins(docs, "go", url=F.col("url"))


_PR = "Data da Coleta: 05/08/2026\nPRODUTO UNIDADE EMBALAGEM\nABACATE\n  ABACATE FORTUNA cx 20 kg Estável 60,00 65,00 70,00 60,00 8,33 PR\nTOMATE LONGA VIDA cx 20 kg Firme 50,00 55,00 60,00 50,00\nGRAUDA cx 20 kg 50,00 55,00 60,00 50,00 1,00 SP Mercado do Produtor x\nonly 1,00 2,00 3,00"


@golden(
    "p3_p14_pr_bulletin", _COLUMNS,
    [
        _quote(3, "nao-informada", "ABACATE", "cx 20 kg", 60, 65, 70, "2026-08-05", "PR", "ABACATE FORTUNA", status="Estável", place="curitiba"), _quote(4, "nao-informada", "TOMATE", "cx 20 kg", 50, 55, 60, "2026-08-05", None, "LONGA VIDA", status="Firme", place="curitiba"),
        _quote(5, "nao-informada", "ABACATE", "cx 20 kg", 50, 55, 60, "2026-08-05", "SP", "GRAUDA", place="curitiba"), _quote(1, "nao-informada", "ALHO", "kg", 1, 2, 3, "2026-01-02", None, "NACIONAL", place="curitiba", doc="1"),
    ],
)
def _(spark):
    return bulletins.parse_bulletins(literal(spark, [_PR, "sem data\nALHO NACIONAL kg 1,00 2,00 3,00 4,00"]), "pr", category=F.lit("curitiba"), target_date=F.lit("2026-01-02").cast("date"))


_CE = "Emissão: 05/08/2026\nFRUTAS UND SIT\nABACATE\nABACATE COMUM CX 20 KG EST 60,00 65,00 70,00 CE/PE\nFORTUNA SC. 20 KG FIR 60,00 65,00 70,00 -.\nMAÇÃ\nMACA GALA CENTO SINF 1,00 2,00 3,00\nsemsit 1,00 2,00 3,00"


@golden(
    "p6_ce_bulletin", _COLUMNS,
    [
        _quote(3, "frutas", "ABACATE", "CX 20 KG", 60, 65, 70, "2026-08-05", "CE/PE", "COMUM", status="EST", place="maracanau"), _quote(4, "frutas", "ABACATE", "SC. 20 KG", 60, 65, 70, "2026-08-05", None, "FORTUNA", status="FIR", place="maracanau"),
        _quote(6, "frutas", "MAÇÃ", "CENTO", 1, 2, 3, "2026-08-05", None, "GALA", status="SINF", place="maracanau"), _quote(7, "frutas", "MAÇÃ", None, 1, 2, 3, "2026-08-05", None, "semsit", place="maracanau"),
    ],
)
def _(spark):
    return bulletins.parse_bulletins(literal(spark, [_CE]), "ce", category=F.lit("maracanau-frutas"))


_CAMPINAS = "Cotação Realizada em: 05/08/2026\nProduto Variedade\n\nFRUTAS\nABACATE - KG FORTUNA\nEXTRA 1,00 2.50 3,00 Firme\nskipped line\n\nHORTALICAS\nALFACE CRESPA 1,00 2,00 3,00 Fraco Produto Variedade\nCOUVE - MACO 1,00 2,00 3,00"


@golden(
    "p4_campinas_bulletin", _COLUMNS,
    [
        _quote(5, "frutas", "ABACATE", "KG", 1, 2.5, 3, "2026-08-05", kind="FORTUNA EXTRA", status="Firme"), _quote(9, "hortalicas", "ALFACE CRESPA", None, 1, 2, 3, "2026-08-05", status="Fraco"),
        _quote(10, "hortalicas", "COUVE", "MACO", 1, 2, 3, "2026-08-05"),
    ],
)
def _(spark):
    return bulletins.parse_bulletins(literal(spark, [_CAMPINAS, "no date\nALFACE 1,00 2,00 3,00"]), "campinas")


_DF = "DATA: 05.08.2026\nFRUTAS\nMAÇÃ - (CX 18 KG) PROC. SC/RS\nFUJI CAT-1 TP. 90 EST 100,00 110,00 120,00\nCAT-1 TP.150 ENT 90,00 95,00 99,00\nPINK LADY CAT-1 TP. 90 FIR 100,00 110,00 120,00\nCOMERCIAL - SOLTA SINF 60,00 80,00 90,00\nOUTRA EST 1,00 2,00 3,00\nHORTALIÇAS\nCOUVE - KG PROC. DF\nEXTRA AUS 1,00 2,00 3,00"


@golden(
    "p9_df_bulletin", _COLUMNS,
    [
        _quote(4, "frutas", "MAÇÃ", "CX 18 KG", 100, 110, 120, "2026-08-05", "SC/RS", "FUJI CAT-1 TP. 90", "FUJI", "EST"), _quote(5, "frutas", "MAÇÃ", "CX 18 KG", 90, 95, 99, "2026-08-05", "SC/RS", "FUJI CAT-1 TP.150", "FUJI", "ENT"),
        _quote(6, "frutas", "MAÇÃ", "CX 18 KG", 100, 110, 120, "2026-08-05", "SC/RS", "PINK LADY CAT-1 TP. 90", "PINK LADY", "FIR"), _quote(7, "frutas", "MAÇÃ", "CX 18 KG", 60, 80, 90, "2026-08-05", "SC/RS", "PINK LADY COMERCIAL - SOLTA", "PINK LADY", "SINF"),
        _quote(8, "frutas", "MAÇÃ", "CX 18 KG", 1, 2, 3, "2026-08-05", "SC/RS", "OUTRA", "PINK LADY", "EST"), _quote(11, "hortalicas", "COUVE", "KG", 1, 2, 3, "2026-08-05", "DF", "EXTRA", None, "AUS"),
    ],
)
def _(spark):
    return bulletins.parse_two_columns(spark.createDataFrame([(0, [_DF])], "doc long, pages array<string>"))


@golden("p9_two_columns", "side line", [("0", "TOMATE - CX 20 KG PROC. DF"), ("0", "EST 1,00 2,00 3,00"), ("1", "CEBOLA - SC 20 KG PROC. GO"), ("1", "EST 4,00 5,00 6,00")])
def _(spark):
    page = "TOMATE - CX 20 KG PROC. DF\n" + " " * 100 + "CEBOLA - SC 20 KG PROC. GO\n" + "EST 1,00 2,00 3,00".ljust(100) + "EST 4,00 5,00 6,00"
    return bulletins.two_columns(spark.createDataFrame([(1, [page])], "doc long, pages array<string>"), "doc", "pages")


# --- pages and files ------------------------------------------------------------------------------------------------


def _row(cells: str) -> str:
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells.split("|")) + "</tr>"


@golden("p11_seven_cells", "doc product classification unit p_min p_common p_max quote_date", [("0", "ABACATE", "A", "KG", "5.3600", "6.4700", "7.5500", "2026-08-05")])
def _(spark):
    html = "<table class=contacao_lista><tr><th colspan=7>FRUTAS 05/08/2026</th></tr>" + _row("Produto|Classe|Uni|Menor|Comum|Maior|Quilo") + _row("ABACATE|A|KG|5,36|6,47|7,55|1") + _row("six|cells|1|2|3|4") + "</table>"
    return tables.parse_seven_cells(literal(spark, [html, None], "html"))


@golden("p1_eight_cells", "doc product unit origin classification p_min p_common p_max market_status quote_date", [("0", "Alface", "UND", "PE", "Extra", "1.0000", "1.5000", "2.0000", "Estável", "2026-08-05")])
def _(spark):
    html = "<table><tbody><tr class=tr>" + _row("Alface|UND|PE|Extra|1,00|1,50|2,00|Estável")[4:-5] + "<td><a class=btn-grafico data-date='05/08/2026'></a></td></tr></tbody></table>"
    return tables.parse_eight_cells(literal(spark, [html, "<p>nothing</p>", None], "html"))


@golden("p2_city_matrix", "product unit market p_common quote_date", [("Alho", "kg", "Grande BH", "1234.5000", "2026-08-06"), ("Batata", "sc", "Barbacena", "85.5000", "2026-08-05"), ("Batata", "sc", "Grande BH", "90.0000", "2026-08-06")])
def _(spark):
    html = "<p>Barbacena - 05/08/2026</p><p>Grande BH - 06/08/2026</p><table>" + _row("Produtos|Embalagens|Grande BH|Barbacena") + _row("Alho|kg|1.234,50|---") + _row("Batata|sc|90,00|85.5") + "</table>"
    return tables.parse_matrix(literal(spark, [html], "html"))


@golden("p10_grid", "product unit p_min p_common p_max market_status", [("Alho", None, "1.0000", "2.0000", "3.0000", "Firme")])
def _(spark):
    html = "<table><tr class=scGridFieldOdd><td class='css_prdnom_grid_line'>Alho<td class='css_pboprcmin_grid_line'>1,00<td class='css_pboprccomum_grid_line'>2,00<td class='css_pboprcmax_grid_line'>3,00<td class=css_mersit_grid_line>Firme</tr><tr class=other><td>x</tr></table>"
    return tables.parse_grid(literal(spark, [html], "html"))


@golden(
    "p12_links", "doc position href label day",
    [("0", "0", "/x.pdf", "Cotação 05/08/2026", "2026-08-05"), ("0", "1", "/a_5-8-2026.pdf", "sem data", "2026-08-05"), ("0", "2", "/y.pdf", "7 de março de 2026", "2026-03-07"), ("0", "3", "/z", "outra", None), ("1", "0", "?page=2", "2", None)],
)
def _(spark):
    pages = ["<a href=/x.pdf>Cotação <b>05/08/2026</b></a><a href='/a_5-8-2026.pdf'>sem data</a><a href=/y.pdf>7 de março de 2026</a><a href=/z>outra</a>", "<a href='?page=2'>2</a>"]
    return tables.dated_links(literal(spark, pages, "html"))


@golden("p12_month_links", "year month href", [("2026", "1", "/jan-2026"), ("2026", "3", "/m/marco"), ("2025", "12", "/d")])
def _(spark):
    return tables.month_links(literal(spark, ["<a href=/jan-2026>Janeiro</a><a href=/m/marco>Março 2026</a><a href=/d>dezembro de 2025</a><a href=/jan-2026>Janeiro</a><a href=/q>2024</a>"], "html"))


@golden("p12_next_pages", "doc url", [("0", "https://example.org/list?page=2"), ("0", "https://example.org/list?page=3")])
def _(spark):
    return tables.page_urls(literal(spark, ["<a href='?page=2'>2</a><a href='/list?page=3'>3</a><a href='?page=2'>next</a><a href=/x>x</a>"], "html"), F.lit("https://example.org/list"))


@golden(
    "s2_raw_names", "name category target_date downloaded_at bad_name",
    [("frutas_2026-08-05_20260806_101500.html", "frutas", "2026-08-05", "2026-08-06 10:15:00", "false"), ("a_b_20260806-101500_3.pdf", "a_b", None, "2026-08-06 10:15:00", "false"), ("bad.html", None, None, None, "true"), ("x_20261306_101500.html", "x", None, None, "true")],
)
def _(spark):
    return files.with_name_parts(spark.createDataFrame([(n,) for n in ("frutas_2026-08-05_20260806_101500.html", "a_b_20260806-101500_3.pdf", "bad.html", "x_20261306_101500.html")], "name string"))


@golden("s3_decoded_files", "name text", [("good", "olá\r\nb"), ("bad", None), ("empty", "")])
def _(spark):
    return files.decoded(spark.createDataFrame([("good", bytearray("olá\r\nb".encode())), ("bad", bytearray(b"\xff")), ("empty", bytearray(b""))], "name string, content binary"))


@golden("s4_feed_rows", "ordinal market day product unit price", [("1", "mercado pe recife", "2026-10-28", "maca", "KG", "10.5000"), ("2", "", None, "", None, None)])
def _(spark):
    return files.feed_rows(spark.createDataFrame([(1, "MERCADO/PE - RECIFE", "MAÇÃ", "Kg", "2026/10/28 00:00:00.000", "10.50"), (2, None, None, None, "x", "1.234,5")], "ordinal long, dsc_ceasa string, dsc_produto string, sig_unidade_medida string, data_preco string, preco_diario string"))


def _zip(**members: str) -> bytearray:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name.replace("__", "/"), content)
    return bytearray(buffer.getvalue())


@golden(
    "s8_archive_members", "path member name sha256 broken",
    [("ok.zip", "d/a", "a", "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", "false"), ("ok.zip", "b", "b", "a1fce4363854ff888cff4b8e7875d600c2682390412a8cf79b37d0b11148b0fa", "false"), ("bad.zip", None, None, None, "true")],
)
def _(spark):
    df = spark.createDataFrame([("ok.zip", _zip(d__a="x", b="y")), ("bad.zip", bytearray(b"no"))], "path string, content binary")
    return files.archive_members(df).withColumn("broken", F.col("error").isNotNull())


@golden("p15_origin_urls", "url", [("https://example.org/q/ra%C3%ADzes+e+tub?date=2026-08-05",), ("https://example.org/q/frutas",)])
def _(spark):
    df = spark.createDataFrame([("https://example.org/q/", "raízes e tub", "2026-08-05"), ("https://example.org/q", "frutas", None)], "u string, c string, d string")
    return df.select(files.origin_url(F.col("u"), F.col("c"), F.col("d").cast("date")).alias("url"))


_BODY = '{"status":"%s","schema":1,"name":"%s","layers":{"raw":{"package":"completed","validated":%s,"uploaded":"completed","path":"b/%s","sha256":"%s","size":5}}}'


@golden("x22_manifest_layers", "name layer path size", [("m1", "raw", "b/m1", "5")])
def _(spark):
    body = lambda status, name, valid, path, sha: _BODY % (status, name, valid, path, sha)
    rows = [("m1", body("completed", "m1", "true", "m1", "a" * 64)), ("m2", body("failed", "m2", "true", "m2", "a" * 64)), ("m3", body("completed", "other", "true", "m3", "a" * 64)), ("m4", body("completed", "m4", "false", "m4", "a" * 64)), ("m5", body("completed", "m5", "true", "m5", "A" * 64)), ("m6", "broken")]
    return raw.flatten_manifests(spark.createDataFrame(rows, "name string, body string"))


@golden("l10_first_evidence", "id state backup", [("1", "found", "b1"), ("2", "not_found", None), ("3", "invalid_target", None)])
def _(spark):
    missing = spark.createDataFrame([(1, "raw/a", "h1"), (2, "raw/b", "h2"), (3, "../c", "h1")], "id long, path string, digest string")
    evidence = spark.createDataFrame([("h1", "b2", "2026-02-01"), ("h1", "b1", "2026-01-01"), ("h1", "b3", "2026-01-01")], "digest string, backup string, day string")
    return raw.plan_recovery(missing, evidence)
