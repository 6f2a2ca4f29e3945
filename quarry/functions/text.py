"""Column expressions for text: all JVM-side, inside whole-stage codegen.

Python's ``str.strip``/``split``/``isspace`` treat Unicode whitespace as blank,
while Java's ``\\s`` is ASCII-only, so the whitespace class is spelled out.
Every pattern here is also valid RE2 syntax, so the same text works in
DuckDB oracles.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters for which str.isspace() is true (29 of them), as a regex class
# body: ASCII \s and \v, the information separators 1C-1F, NEL, and the
# Unicode separator categories (Zs, Zl, Zp). A category test is a table
# lookup, about twice as fast in Java as a list of ranges.
PY_WHITESPACE = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
# the same set as a string, for trim()/translate() (no regex at all)
PY_WHITESPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# Fixed values (must equal Python's definitions for equal results):
# string.punctuation, in its natural order
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# line boundaries of str.splitlines()
PY_LINE_BREAK = r"\r\n|[\n\x{0B}\f\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"

WS_CLASS = f"[{PY_WHITESPACE}]"
NON_WS_CLASS = f"[^{PY_WHITESPACE}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE_CHARS))


def py_rstrip(col) -> Column:
    """``str.rstrip()``: remove trailing Unicode whitespace."""
    return F.rtrim(_c(col), F.lit(PY_WHITESPACE_CHARS))


def is_blank(col) -> Column:
    """True when ``len(s.strip()) == 0``; NULL stays NULL (filters drop it)."""
    return ~_c(col).rlike(NON_WS_CLASS)


def has_text(col) -> Column:
    """Non-null and not blank."""
    c = _c(col)
    return c.isNotNull() & c.rlike(NON_WS_CLASS)


def flatten_newlines(col) -> Column:
    """``s.replace('\\n', ' ')``."""
    return F.translate(_c(col), "\n", " ")


def simple_clean(col, null_as: str = "") -> Column:
    """``str(x).lower()`` with newline/tab to space, then strip.

    A NULL becomes ``null_as`` first (the reference's ``str(nan)`` gives
    ``'nan'``; the default maps it to '' so blank filters drop it, D09)."""
    c = F.coalesce(_c(col).cast("string"), F.lit(null_as))
    return py_strip(F.translate(F.lower(c), "\n\t", "  "))


def strip_punctuation(col) -> Column:
    """Delete the 32 ASCII punctuation characters."""
    return F.translate(_c(col), ASCII_PUNCTUATION, "")


def punctuation_to_space(col, keep: str = "") -> Column:
    chars = "".join(ch for ch in ASCII_PUNCTUATION if ch not in keep)
    return F.translate(_c(col), chars, " " * len(chars))


def split_words(col) -> Column:
    """``str.split()``: runs of Unicode whitespace separate, no empty words."""
    stripped = py_strip(col)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, f"{WS_CLASS}+"))


def strip_tags(col) -> Column:
    """Punctuation except ``@ #`` to space, drop words starting with
    ``@``/``#``, rejoin by single spaces."""
    words = split_words(punctuation_to_space(col, keep="@#"))
    kept = F.filter(words, lambda w: ~(w.startswith("@") | w.startswith("#")))
    return F.array_join(kept, " ")


# Fixed value: the C05 URL pattern; only \w and \d are spelled as Unicode classes, which Java needs.
URL_PATTERN = r"((https?):((//)|(\\))+([\p{L}\p{N}_\p{Nd}:#@%/;$()“”~_?\+-=\\\.&](#!)?)*)"


def strip_urls(col) -> Column:
    """Every http(s) URL becomes ``', '`` (positional, D10)."""
    return F.regexp_replace(_c(col), URL_PATTERN, ", ")


# digits besides \p{Nd} that ``str.isdigit`` accepts (superscripts, circled digits, ...)
OTHER_DIGITS = "".join(c for c in map(chr, range(0x20000)) if c.isdigit() and unicodedata.category(c) != "Nd")
_DIGIT = rf"[\p{{Nd}}{OTHER_DIGITS}]"
NUMBER_PATTERN = rf"^(?:{_DIGIT}+\.?{_DIGIT}*|\.{_DIGIT}+)$"


ASCII_NUMBER_PATTERN = r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"


def is_number(col) -> Column:
    """Digits after removing one ``.`` (``s.replace('.', '', 1).isdigit()``).
    Other digits than ASCII ones are looked for only where there are other characters."""
    c = _c(col)
    return c.rlike(ASCII_NUMBER_PATTERN) | ((F.octet_length(c) > F.char_length(c)) & c.rlike(NUMBER_PATTERN))


def split_lines(col) -> Column:
    """``str.splitlines()`` boundaries (D24); the pieces are not trimmed."""
    return F.split(_c(col), PY_LINE_BREAK)
