"""Files, parsers and streams on small documents of our own."""

import io
import zipfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.sources import bulletins, files, tables
from granary.streaming import ingest

D = Decimal


def docs(spark, *texts, name="text"):
    return spark.createDataFrame(list(enumerate(texts)), f"doc long, {name} string")


def test_origin_bulletin(spark):
    text = "BOLETIM\nEMISSÃO: 05/08/2026\nFRUTAS\nABACAXI GRANDE CX. 20 KG BA/PE 30,00 1.035,50 40,00 EST\nnot a quote 1,00 2,00 3,00\nHORTALIÇAS\nALFACE UND BA 1,00 1,50 2,00"
    rows = bulletins.parse_bulletins(docs(spark, text), "ba").orderBy("n").collect()
    assert [(r["category"], r["product"], r["unit"], r["origin"], r["p_min"], r["p_common"], r["p_max"], r["market_status"]) for r in rows] == [
        ("frutas", "ABACAXI GRANDE", "CX. 20 KG", "BA/PE", D("30"), D("1035.5"), D("40"), "EST"),
        ("hortalicas", "ALFACE", "UND", "BA", D("1"), D("1.5"), D("2"), None),
    ]
    assert {r["quote_date"] for r in rows} == {date(2026, 8, 5)}


def test_four_price_bulletin_keeps_its_order(spark):
    rows = bulletins.parse_bulletins(docs(spark, "Periodo : 01/02/2026\n01 - FRUTAS\nBANANA PRATA CX 50,00 60,00 40,00 2,500"), "go").collect()
    assert [(r["product"], r["unit"], r["p_min"], r["p_common"], r["p_max"], r["category"]) for r in rows] == [("BANANA PRATA", "CX", D("40"), D("50"), D("60"), "frutas")]


def test_sections_and_trailer(spark):
    rows = bulletins.parse_bulletins(docs(spark, "RIO 03/03/2026\n1. RAIZES S/C\nBATATA LISA SC 50 KG S/C 90,00 100,00 110,00\nsem unidade 1,00 2,00 3,00"), "rj").collect()
    assert [(r["category"], r["product"], r["unit"], r["p_max"], r["quote_date"]) for r in rows] == [("raizes", "BATATA LISA", "SC 50 KG", D("110"), date(2026, 3, 3))]


def test_variety_is_carried(spark):
    lines = ["DATA: 05.08.2026", "MAÇÃ - CX 18 KG PROC. SC", "FUJI CAT-1 TP. 90 EST 100,00 110,00 120,00", "CAT-1 TP.150 EST 90,00 95,00 99,00", "GALA CAT-1 TP. 90 EST 100,00 110,00 120,00", "COMERCIAL - SOLTA EST 60,00 80,00 90,00"]
    df = spark.createDataFrame([(1, ["\n".join(lines)])], "doc long, pages array<string>")
    rows = bulletins.parse_two_columns(df).orderBy("n").collect()
    assert [r["classification"] for r in rows] == ["FUJI CAT-1 TP. 90", "FUJI CAT-1 TP.150", "GALA CAT-1 TP. 90", "GALA COMERCIAL - SOLTA"]
    assert rows[0]["quote_date"] == date(2026, 8, 5) and rows[3]["p_common"] == D("80")


def test_two_columns_split(spark):
    left, right = "TOMATE - CX 20 KG PROC. DF", "CEBOLA - SC 20 KG PROC. GO"
    page = left + "\n" + " " * 100 + right + "\n" + "EST 1,00 2,00 3,00".ljust(100) + "EST 4,00 5,00 6,00"
    rows = bulletins.two_columns(spark.createDataFrame([(1, [page])], "doc long, pages array<string>"), "doc", "pages").orderBy("n").collect()
    assert [(r["side"], r["line"]) for r in rows] == [(0, left), (0, "EST 1,00 2,00 3,00"), (1, right), (1, "EST 4,00 5,00 6,00")]


def test_seven_cells(spark):
    html = "<table class=contacao_lista><tr><th colspan=7>FRUTAS 05/08/2026</th></tr><tr>" + "".join(f"<td>{c}</td>" for c in "Produto Classe Uni Menor Comum Maior Quilo".split()) + "</tr><tr>" + "".join(f"<td>{c}</td>" for c in ("ABACATE", "A", "KG", "5,36", "6,47", "7,55", "1")) + "</tr></table>"
    (r,) = tables.parse_seven_cells(docs(spark, html, name="html")).collect()
    assert (r["product"], r["classification"], r["unit"], r["p_min"], r["p_common"], r["p_max"], r["quote_date"]) == ("ABACATE", "A", "KG", D("5.36"), D("6.47"), D("7.55"), date(2026, 8, 5))


def test_eight_cells(spark):
    html = "<table><tbody><tr class=tr>" + "".join(f"<td>{c}</td>" for c in ("Alface", "UND", "PE", "Extra", "1,00", "1,50", "2,00", "Estável")) + "<td><a class=btn-grafico data-date='05/08/2026'></a></td></tr></tbody></table>"
    (r,) = tables.parse_eight_cells(docs(spark, html, "<p>nothing</p>", None, name="html")).collect()
    assert (r["product"], r["origin"], r["p_max"], r["market_status"], r["quote_date"]) == ("Alface", "PE", D("2"), "Estável", date(2026, 8, 5))


def test_matrix(spark):
    html = "<p>Barbacena - 05/08/2026</p><p>Grande BH - 06/08/2026</p><table><tr><th>Produtos<th>Embalagens<th>Grande BH<th>Barbacena</tr><tr><td>Alho<td>kg<td>1.234,50<td>---</tr><tr><td>Batata<td>sc<td>90,00<td>85.5</tr></table>"
    rows = tables.parse_matrix(docs(spark, html, name="html")).orderBy("product", "market").collect()
    assert [(r["product"], r["unit"], r["market"], r["p_common"], r["quote_date"].day) for r in rows] == [("Alho", "kg", "Grande BH", D("1234.5"), 6), ("Batata", "sc", "Barbacena", D("85.5"), 5), ("Batata", "sc", "Grande BH", D("90"), 6)]


def test_grid_and_links(spark):
    html = "<a href=/x>See <b>this</b></a><table><tr class=scGridFieldOdd><td class='css_prdnom_grid_line'>Alho<td class='css_pboprcmin_grid_line'>1,00<td class='css_pboprccomum_grid_line'>2,00<td class='css_pboprcmax_grid_line'>3,00<td class=css_mersit_grid_line>Firme</tr></table>"
    (r,) = tables.parse_grid(docs(spark, html, name="html")).collect()
    assert (r["product"], r["p_min"], r["p_max"], r["market_status"], r["unit"]) == ("Alho", D("1"), D("3"), "Firme", None)
    (link,) = tables.page_links(docs(spark, html, name="html")).collect()
    assert (link["href"], link["label"]) == ("/x", "See this")


def test_raw_files(spark, tmp_path):
    (tmp_path / "frutas_2026-08-05_20260806_101500.html").write_bytes(b"a\r\nb")
    (tmp_path / "bad.html").write_bytes(b"\xff")
    (tmp_path / "note.txt").write_bytes(b"x")
    rows = {r["name"]: r for r in files.decoded(files.with_name_parts(files.scan_raw(spark, str(tmp_path)))).collect()}
    good, bad = rows["frutas_2026-08-05_20260806_101500.html"], rows["bad.html"]
    assert len(rows) == 2 and (good["category"], good["target_date"], good["bad_name"], good["text"]) == ("frutas", date(2026, 8, 5), False, "a\r\nb")
    assert bad["bad_name"]


def test_feed(spark, tmp_path):
    (tmp_path / "feed.csv").write_bytes("dsc_ceasa;dsc_produto;sig_unidade_medida;data_preco;preco_diario\nMERCADO/PE - RECIFE;MAÇÃ;Kg;2026/10/28 00:00:00.000;10.50\n".encode("latin-1"))
    (r,) = files.feed_rows(files.read_feed(spark, str(tmp_path / "feed.csv"))).collect()
    assert (r["market"], r["product"], r["unit"], r["day"], r["price"]) == ("mercado pe recife", "maca", "KG", date(2026, 10, 28), D("10.5"))
    (tmp_path / "bad.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError):
        files.read_feed(spark, str(tmp_path / "bad.csv"))


def test_archives(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("d/a.html", "x")
    df = spark.createDataFrame([("ok.zip", bytearray(buffer.getvalue())), ("bad.zip", bytearray(b"no"))], "path string, content binary")
    rows = {r["path"]: r for r in files.archive_members(df).collect()}
    assert rows["ok.zip"]["name"] == "a.html" and rows["bad.zip"]["error"]


def test_sync_and_stream(spark, tmp_path):
    marks, target = str(tmp_path / "marks"), str(tmp_path / "target")
    rows = spark.range(1, 11).withColumnRenamed("id", "k")
    assert ingest.sync(spark, rows, "t", "k", target, marks) == 10
    assert ingest.sync(spark, rows, "t", "k", target, marks) == 0
    assert ingest.sync(spark, spark.range(1, 16).withColumnRenamed("id", "k"), "t", "k", target, marks) == 5
    assert spark.read.parquet(f"{target}/t").select("k").distinct().count() == 15
    source = str(tmp_path / "in")
    made = spark.createDataFrame([("a", "h1"), ("a", "h1"), ("b", "h1"), ("a", "h2")], "source string, digest string").withColumn("at", F.lit("2026-08-05 10:00:00").cast("timestamp"))
    made.write.parquet(source)
    stream = ingest.once_per_document(ingest.raw_stream(spark, source, "source string, digest string, at timestamp"), "source", "digest", "at")
    ingest.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    ingest.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
