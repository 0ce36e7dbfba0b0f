"""Money, dates and validity. Lenient: what can't be read is null (or false), never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _number(c: Column) -> Column:
    return c.try_cast(MONEY)


def money_br(c: Column) -> Column:
    """R$ and thousands dots dropped, decimal comma."""
    bare = F.trim(F.replace(F.replace(c, F.lit("R$"), F.lit("")), F.lit("."), F.lit("")))
    return _number(F.replace(bare, F.lit(","), F.lit(".")))


def money_matrix(c: Column) -> Column:
    """--- is null; with both separators the dot is for thousands; else the comma is a decimal point."""
    c = F.trim(c)
    both = c.contains(",") & c.contains(".")
    return F.when(c == "---", None).when(both, money_br(c)).otherwise(_number(F.replace(c, F.lit(","), F.lit("."))))


def money_comma(c: Column) -> Column:
    """Thousands dots only where there is a comma."""
    return F.when(c.contains(","), money_br(c)).otherwise(_number(F.trim(c)))


def money_feed(c: Column) -> Column:
    """Comma as decimal point, else null."""
    return _number(F.replace(F.trim(c), F.lit(","), F.lit(".")))


def price_tokens(c: Column, least: int = 2, most: int = 2, point: str = ",") -> Column:
    """The prices in a line, as text: thousands dots, and `least` to `most` decimals after the point."""
    return F.regexp_extract_all(c, F.lit(rf"(?<![\d.,])\d+(?:\.\d{{3}})*[{point}]\d{{{least},{most}}}(?!\d)"), F.lit(0))


def date_br(c: Column) -> Column:
    """dd/mm/yyyy."""
    return F.when(F.trim(c).rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(F.trim(c), "dd/MM/yyyy"))


def date_feed(c: Column) -> Column:
    """The first ten characters as yyyy/mm/dd or yyyy-mm-dd."""
    return F.try_to_date(F.replace(F.left(F.trim(c), F.lit(10)), F.lit("/"), F.lit("-")), "yyyy-MM-dd")


def unit_feed(c: Column) -> Column:
    """KG, UN or DZ, else null."""
    from .text import match_text

    t = match_text(c)
    return F.when(t.isin("kg", "quilo", "quilograma"), "KG").when(t.isin("un", "und", "unid", "unidade"), "UN").when(t.isin("dz", "duzia"), "DZ")


def valid_date(c: Column) -> Column:
    """K7: yyyy-mm-dd of a real day; false for null."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & c.try_cast("date").isNotNull(), F.lit(False))


def valid_time(c: Column) -> Column:
    """K8: an ISO date and time."""
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:?\d{2}|Z)?)?$") & c.try_cast("timestamp").isNotNull(), F.lit(False))


def valid_sha256(c: Column) -> Column:
    """K9: 64 lower-case hex digits."""
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def valid_amount(c: Column) -> Column:
    """A finite number of at least 0."""
    return F.coalesce(c.cast("string").try_cast("decimal(38,10)") >= 0, F.lit(False))
