"""Goldens of the scalar functions."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from granary.functions import keys, text, units, values


def each(spark, function, inputs, kind="string"):
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r["y"] for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_text(spark):
    assert each(spark, text.clean, ["  a \t b ", "", "   ", None]) == ["a b", None, None, None]
    assert each(spark, text.basic_name, [" A  b", None]) == ["a b", ""]
    assert each(spark, text.canonical, ["Straße  É", "ABC", None, " x\ty "]) == ["strasse e", "abc", "", "x y"]
    assert each(spark, text.strip_accents, ["ção ß ø", "abc", None]) == ["cao  ", "abc", None]
    assert each(spark, text.match_key, ["Maçã Fuji 1."]) == ["macafuji1"]
    assert each(spark, text.slug, ["--Foz do Iguaçu!"]) == ["foz-do-iguacu"]
    assert each(spark, text.match_text, ["Caixa (20 kg)", None]) == ["caixa 20 kg", ""]
    assert each(spark, text.category, ["frutas ", "Nao Informada", " ", None]) == ["frutas", None, None, None]
    assert each(spark, text.month_number, ["Março", "dezembro", "x"]) == [3, 12, None]
    assert each(spark, text.lookup_names, ["a_12.pdf", "b.pdf"]) == [["a_12.pdf", "a.pdf"], ["b.pdf"]]
    assert each(spark, text.unsafe_path, ["/a", "a/../b", "a/b..c"]) == [True, True, False]
    assert each(spark, text.mask_secrets, ["postgres://u:pw@h/d", "?token=abc&x=1"]) == ["postgres://u:***@h/d", "?token=***&x=1"]


def test_money(spark):
    d = Decimal
    assert each(spark, values.money_br, ["R$ 1.234,56", "7,5", "x", None]) == [d("1234.5600"), d("7.5000"), None, None]
    assert each(spark, values.money_matrix, ["---", "1.234,50", "1.234", "2,5"]) == [None, d("1234.5000"), d("1.2340"), d("2.5000")]
    assert each(spark, values.money_comma, ["1.234,50", "12.5"]) == [d("1234.5000"), d("12.5000")]
    assert each(spark, values.money_feed, ["10.50", "10,50", "1.234,56"]) == [d("10.5000"), d("10.5000"), None]
    assert each(spark, values.price_tokens, ["ALFACE 1.234,50 7,00 8,5 A 3,25"]) == [["1.234,50", "7,00", "3,25"]]


def test_dates(spark):
    assert each(spark, values.date_br, ["31/12/2024", "31/02/2024", "1/2/2024"]) == [date(2024, 12, 31), None, None]
    assert each(spark, values.date_feed, ["2026/10/28 00:00:00.000", "2026-10-28", "28/10/2026"]) == [date(2026, 10, 28), date(2026, 10, 28), None]
    assert each(spark, values.valid_date, ["2024-02-29", "2023-02-29", "2024-2-3", None]) == [True, False, False, False]
    assert each(spark, values.valid_time, ["2024-02-29T10:00:00", "x", None]) == [True, False, False]
    assert each(spark, values.unit_feed, ["Kg", "duzia", "caixa"]) == ["KG", "DZ", None]
    assert each(spark, values.valid_sha256, ["a" * 64, "A" * 64, "a" * 63]) == [True, False, False]
    assert each(spark, values.valid_amount, ["0", "-1", "NaN", " "]) == [True, False, False, False]


def test_keys(spark):
    assert each(spark, keys.decimal_key, [Decimal("10.00"), Decimal("10.50"), Decimal("100"), None], "decimal(18,4)") == ["10", "10.5", "100", None]
    assert each(spark, keys.decimal_text_key, ["10.00", "0.000", "abc", None]) == ["10", "0", "INVALID:abc", None]
    same = each(spark, lambda c: keys.hash_values(c, F.lit("b")), ["", None])
    assert same[0] == same[1]
    apart = each(spark, lambda c: keys.structured_key(("str", c)), ["", None, "0"])
    assert len(set(apart)) == 3


@pytest.mark.parametrize(
    "given,symbol,packaging,low,high,shown",
    [
        ("KG", "kg", None, "1", None, "kg"),
        ("Cx 20 kg", "kg", "caixa", "20", None, "caixa 20 kg"),
        ("caixa 18 a 20 kg", "kg", "caixa", "18", "20", "caixa 18 a 20 kg"),
        ("Saco 2,50 kg", "kg", "saco", "2.5", None, "saco 2.5 kg"),
        ("Maço", "maco", "maco", "1", None, "maco"),
        ("granel", None, None, None, None, "granel"),
        ("granel/solto", None, None, None, None, "granel solto"),
        ("Caixa", None, "caixa", "1", None, "caixa"),
        ("KG - 20", "kg", None, "20", None, "20 kg"),
        ("05 kg", "kg", None, "5", None, "5 kg"),
        ("18a20 kg", "kg", None, "18", "20", "18 a 20 kg"),
    ],
)
def test_units(given, symbol, packaging, low, high, shown):
    got = dict(zip(units.FIELDS, units.parse(given), strict=True))
    assert (got["symbol"], got["packaging"], got["qty_min"], got["qty_max"], got["normalized"]) == (symbol, packaging, low, high, shown)


def test_units_on_frames(spark):
    df = spark.createDataFrame([(1, "Cx 20 kg"), (2, None), (3, "Cx 20 kg"), (4, "  ")], "i int, u string")
    got = {r["i"]: r["unit"] for r in units.with_units(df, "u").collect()}
    assert got[1] == got[3] and got[1]["symbol"] == "kg"
    assert got[2]["original"] is None and got[4]["original"] is None
