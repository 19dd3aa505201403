"""Text column expressions: trimming, title case and canonical names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as blank when a text is stripped.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Canonical category, region and country names.
CATEGORY_NAMES = {
    "furniture": "Furniture",
    "furnitures": "Furniture",
    "office supplies": "Office Supplies",
    "officesupplies": "Office Supplies",
    "technology": "Technology",
    "tech": "Technology",
}
REGION_NAMES = {
    "east": "East",
    "west": "West",
    "central": "Central",
    "south": "South",
    "e": "East",
    "w": "West",
    "c": "Central",
    "s": "South",
}
COUNTRY_NAMES = {
    "US": "United States",
    "USA": "United States",
    "United States of America": "United States",
}


# Texts of one line that begin and end with a visible ASCII character.
_TIDY = r"^[\x21-\x7e](.*[\x21-\x7e])?\z"


def strip(text: Column) -> Column:
    """Remove blanks of every kind from both ends.

    Most texts have nothing to remove; one pattern finds them faster than a
    search of each end in the set of blanks.
    """
    return F.when(text.rlike(_TIDY), text).otherwise(F.btrim(text, F.lit(BLANKS)))


# Texts whose runs of letters are all one capital and small letters after it.
_TITLED = r"^(?:(?<!\p{L})\p{Lu}\p{Ll}*+(?!\p{L})|\P{L}++)*+\z"


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` only starts a word after a blank, so ``o'neil-smith`` needs this.
    Texts already in that form, most of a clean source, pass through.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    rebuilt = F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substr(run, F.lit(2)))), "")
    return F.when(text.rlike(_TITLED), text).otherwise(rebuilt)


def _lookup(names: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def category_name(text: Column) -> Column:
    """Known spellings to their canonical name, others to title case."""
    key = strip(F.lower(text))
    return F.coalesce(_lookup(CATEGORY_NAMES, key), title_case(key))


def region_name(text: Column) -> Column:
    """Region names and one-letter codes to their canonical name."""
    key = strip(F.lower(text))
    return F.coalesce(_lookup(REGION_NAMES, key), title_case(key))


def country_name(text: Column) -> Column:
    """Aliases of the United States to one spelling; case matters."""
    key = strip(text)
    return F.coalesce(_lookup(COUNTRY_NAMES, key), key)


def place_name(text: Column) -> Column:
    """States, cities and sub-categories: trimmed title case."""
    return title_case(strip(text))


def postal_code(text: Column, default: str | None = "Unknown") -> Column:
    """Drop the ``.0`` a numeric reader left behind; keep leading zeros."""
    code = F.regexp_replace(text, r"\.0$", "")
    known = F.when(F.lower(code) != "nan", code)
    return known if default is None else F.coalesce(known, F.lit(default))


def category_code(category: Column, sub_category: Column) -> Column:
    """``FURN-BOOKCASES``: four letters of the category and the joined sub-category."""
    return F.concat(F.upper(F.left(category, F.lit(4))), F.lit("-"), F.upper(F.replace(sub_category, F.lit(" "), F.lit(""))))


def category_description(category: Column, sub_category: Column) -> Column:
    return F.concat(F.lit("Product Category: "), category, F.lit(", Sub-Category: "), sub_category)


def hash_key(*fields: Column, digits: int = 64) -> Column:
    """SHA-256 of the fields joined by ``|`` in hex; NULL reads ``None``.

    ``digits=16`` gives the short form, which some 10**9 rows may share by chance.
    """
    if not fields:
        raise ValueError("a key needs at least one field")
    texts = [F.coalesce(f.cast("string"), F.lit("None")) for f in fields]
    return F.left(F.sha2(F.concat_ws("|", *texts), 256), F.lit(digits))


def clean_string(text: Column) -> Column:
    """Strip, compose to NFC, empty to NULL.

    Spark has no NFC function, so the composition runs in Arrow batches. It is
    defined here, not at module level, to travel to executors by value.
    """
    @F.pandas_udf(T.StringType())
    def nfc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")

    return F.nullif(nfc(strip(text)), F.lit(""))
