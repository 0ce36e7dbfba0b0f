"""Text cleaning and matching. Null stays null unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that mean "no category". Fixed values.
NO_CATEGORY = ("", "nao informada", "nao-informada", "não informada", "não-informada")
# The city that stands for no single market. Fixed value.
MANY_CITIES = "varias cidades"


def collapse(c: Column) -> Column:
    """Runs of white space (Unicode) as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean(c: Column) -> Column:
    """Collapsed text, null if nothing is left."""
    return F.nullif(collapse(c), F.lit(""))


def basic_name(c: Column) -> Column:
    """K5: lower case, collapsed; '' for null."""
    return F.coalesce(collapse(F.lower(c)), F.lit(""))


@F.pandas_udf(T.StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def _canonical(s: pd.Series) -> pd.Series:
    def one(x):
        bare = "".join(c for c in unicodedata.normalize("NFKD", x or "") if not unicodedata.combining(c))
        return " ".join(bare.casefold().split())

    return s.map(one)


def _plain(c: Column) -> Column:
    return c.rlike(r"^[\x00-\x7F]*$")


def strip_accents(c: Column) -> Column:
    """Decomposed, all that isn't ASCII dropped. ASCII text never leaves the JVM."""
    return F.when(c.isNull() | _plain(c), c).otherwise(_ascii(c))


def canonical(c: Column) -> Column:
    """K4: marks dropped, case folded, collapsed; '' for null."""
    fast = collapse(F.lower(F.regexp_replace(c, r"[\x1c-\x1f]", " ")))
    return F.when(c.isNull(), "").when(_plain(c), fast).otherwise(_canonical(c))


def match_key(c: Column) -> Column:
    """ASCII letters and digits only, lower case."""
    return F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]", "")


def latin_key(c: Column) -> Column:
    """K12 for Latin-1 text without a UDF, so for use in a lambda."""
    plain = F.translate(F.lower(c), "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
    return F.regexp_replace(plain, "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """Runs of other characters as one dash, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def match_text(c: Column) -> Column:
    """Runs of other characters as one space, none at the ends; '' for null."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", " ")), F.lit(""))


def feed_value(c: Column) -> Column:
    """Collapsed; '' for null."""
    return F.coalesce(collapse(c), F.lit(""))


def category(c: Column) -> Column:
    """F8: null for the names that mean no category and for blanks."""
    return F.when(~F.lower(F.trim(c)).isin(*NO_CATEGORY), F.trim(c))


def market(name: Column, city: Column) -> Column:
    """the named market, or else the source's city unless that stands for many."""
    return F.coalesce(name, F.when(F.lower(city) != MANY_CITIES, city))


#: Parameters of an address whose values are secrets. Fixed value.
SECRET_PARAMETERS = ("api-key", "api_key", "apikey", "password", "secret", "token")


def mask_secrets(c: Column) -> Column:
    """Passwords in connection addresses and secrets in query strings as ***."""
    in_address = r"(?i)\b(postgres|postgresql)://([^\s/:]+):[^\s/@]+@"
    in_query = r"(?i)([?&])(" + "|".join(SECRET_PARAMETERS) + r")=[^\s&]+"
    return F.regexp_replace(F.regexp_replace(c, in_address, "$1://$2:***@"), in_query, "$1$2=***")


def mask_settings(c: Column, secrets) -> Column:
    """The given secrets, such as those of the environment, as ***; the longest first, as one may hold another."""
    for secret in sorted(filter(None, secrets), key=len, reverse=True):
        c = F.replace(c, F.lit(secret), F.lit("***"))
    return c


def lookup_names(c: Column) -> Column:
    """The name, and the name without a numeric suffix before its extension."""
    return F.array_distinct(F.array(c, F.regexp_replace(c, r"_\d+(\.[^.]*)?$", "$1")))


# Portuguese months. Fixed values.
MONTHS = dict(zip("janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split(), range(1, 13), strict=True))


def month_number(c: Column) -> Column:
    """Number of a month's Portuguese name, accents and case aside; null for others."""
    table = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(table, match_key(c))


def unsafe_path(c: Column) -> Column:
    """absolute, or with a part that goes up."""
    return c.startswith("/") | F.array_contains(F.split(c, "/"), "..")
