"""URL and HTML-title expressions (V10, V11): native regex columns; character
references in titles are decoded in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import py_strip

# Fixed values (equal to the reference's constants):
PAGE_NOT_FOUND = "Page not found"
MEDIA_NOT_FOUND = "Media not found"

SCHEME_PATTERN = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
NETLOC_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
# split at the last of "-", "|", "—"
TITLE_SPLIT_PATTERN = r"(?s)^(.*)[-|—]([^-|—]*)\z"
def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def url_scheme(col) -> Column:
    return F.lower(F.regexp_extract(_c(col), SCHEME_PATTERN, 1))


def url_netloc(col) -> Column:
    return F.regexp_extract(_c(col), NETLOC_PATTERN, 1)


def home_url(col) -> Column:
    """``'{scheme}://{netloc}/'`` as ``urlparse`` splits it; a URL with no
    scheme gives ``':///'``."""
    return F.concat(url_scheme(col), F.lit("://"), url_netloc(col), F.lit("/"))


def unescape_references(col) -> Column:
    """All character references of a text replaced as HTML defines it: named ones
    by the longest name that fits (with or without its semicolon), decimal and
    hexadecimal ones, references to no character. The standard library's table
    of names is looked up in Arrow batches, and only texts with an "&" go there."""
    text = _c(col)

    def decode(texts: pd.Series) -> pd.Series:
        from html import unescape
        return texts.map(unescape, na_action="ignore")
    return F.coalesce(F.pandas_udf(decode, "string")(F.when(F.instr(text, "&") > 0, text)), text)


def raw_title(html) -> Column:
    """Text of the first <title> element, character references decoded; '' if none."""
    return unescape_references(F.regexp_extract(_c(html), TITLE_PATTERN, 1))


def title_and_media(html) -> tuple[Column, Column]:
    """(headline, media) from stored HTML."""
    raw = raw_title(html)
    has_sep = raw.rlike(TITLE_SPLIT_PATTERN)
    missing = raw == ""
    headline = (F.when(missing, F.lit(PAGE_NOT_FOUND))
                .when(has_sep, py_strip(F.regexp_extract(raw, TITLE_SPLIT_PATTERN, 1)))
                .otherwise(raw))
    media = (F.when(missing, F.lit(MEDIA_NOT_FOUND))
             .when(has_sep, F.regexp_extract(raw, TITLE_SPLIT_PATTERN, 2))
             .otherwise(F.lit(MEDIA_NOT_FOUND)))
    return headline, media
