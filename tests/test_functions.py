"""Column expressions against Python's own string semantics."""

import string

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions import web
from quarry.functions.math import argmax, softmax

SAMPLES = ["  hello\tworld \n", " a b ", "", "   ", "x\x1cy\x85", "Ünïcode  ", "　z　",
           "line1\nline2\r\nline3\rline4\x0bline5 line6", "a,b.c!d@e#f"]


def collect(spark, exprs):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_strip_family_matches_python(spark):
    rows = collect(spark, [tx.py_strip("s"), tx.py_rstrip("s"), tx.is_blank("s")])
    for s, (strip, rstrip, blank) in zip(SAMPLES, rows):
        assert strip == s.strip()
        assert rstrip == s.rstrip()
        assert blank == (len(s.strip()) == 0)


def test_split_words_and_lines(spark):
    rows = collect(spark, [tx.split_words("s"), tx.split_lines("s")])
    for s, (words, lines) in zip(SAMPLES, rows):
        assert words == s.split()
        got = [p for p in lines if p.strip()]
        assert got == [p for p in s.splitlines() if p.strip()]


def test_simple_clean_and_punctuation(spark):
    df = spark.createDataFrame([("  Ab\tC\nd! ",), ("@you see #this, and that's (all)",), ("",)], "s string")
    rows = [tuple(r) for r in df.select(tx.simple_clean("s"), tx.strip_punctuation("s"), tx.strip_tags("s")).collect()]
    assert rows == [("ab c d!", "  Ab\tC\nd ", "Ab C d"),
                    ("@you see #this, and that's (all)", "you see this and thats all", "see and that s all"),
                    ("", "", "")]


@pytest.mark.parametrize("token,expected", [
    ("12", True), ("1.5", True), (".5", True), ("5.", True), ("1.2.3", False), (".", False), ("", False), ("a1", False),
    ("\u00b2", True), ("\u2460", True), ("\u00bd", False), ("\u0663\u00b9", True)])
def test_is_number(spark, token, expected):
    assert spark.createDataFrame([(token,)], "t string").select(tx.is_number("t")).first()[0] == expected


def test_strip_urls_positional(spark):
    df = spark.createDataFrame([("see http://a.com/x and https://b.org/#!/y?q=1 end",)], "t string")
    assert df.select(tx.strip_urls("t")).first()[0] == "see ,  and ,  end"


def test_home_url_like_urlparse(spark):
    from urllib.parse import urlparse
    urls = ["http://User@Example.com:8080/a?b#c", "HTTPS://x.org", "www.example.com/a", "//cdn.net/x",
            "ftp://files.net/", "mailto:a@b.c", ""]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string")
           .select(web.home_url("u")).collect()]
    for u, g in zip(urls, got):
        p = urlparse(u)
        assert g == f"{p.scheme}://{p.netloc}/"


def test_title_and_media(spark):
    pages = ["<html><title>Big news - The Paper</title></html>", "<TITLE>a|b|c </TITLE>",
             "<title>No separator</title>", "<p>no title</p>", "<title></title>",
             "<title>Tom &amp; Jerry — Daily</title>"]
    h, m = web.title_and_media(F.col("html"))
    got = [tuple(r) for r in spark.createDataFrame([(p,) for p in pages], "html string")
           .select(h, m).collect()]
    assert got == [("Big news", " The Paper"), ("a|b", "c "), ("No separator", "Media not found"),
                   ("Page not found", "Media not found"), ("Page not found", "Media not found"),
                   ("Tom & Jerry", " Daily")]


def test_softmax_and_argmax(spark):
    import numpy as np
    x = [1.0, 3.0, 2.0]
    row = spark.createDataFrame([(x,)], "x array<double>").select(softmax("x"), argmax("x")).first()
    e = np.exp(np.array(x) - max(x))
    assert np.allclose(row[0], e / e.sum())
    assert row[1] == 1


def test_character_references_as_html_defines_them(spark):
    import html
    import random
    from html.entities import html5
    from quarry.functions.web import unescape_references
    rng = random.Random(1)
    texts = ["&mdash;", "&#8212;", "&#x2014;", "&nbsp;x", "&ampx", "&amp;lt;", "&notit;", "&notin;", "&#0;", "&#128;", "&#xD800;", "&#x110000;",
             "&#99999999999999999999999;", "&#xFFFFFFFFFFFFFFFFFFFF;", "&#x1F600;", "&#65", "&#x41g", "&", "&&amp&", "&;", "& amp;", "&unknown;",
             "&copycat", "&#", "&#x", "&#11;", "&#xfdd0;", "&#xfffe;", "&#00065;", "a&b&lt;c", "&AMP;", "&acE;", "&" + "a" * 40 + ";", "no reference", ""]
    texts += ["&" + name + rng.choice(["", "x", ";", " ", "="]) for name in html5]
    texts += ["".join(rng.choice(["&", "#", "x", "amp", "lt", "gt", "not", "in", ";", "1", "8", "a", " ", "<"]) for _ in range(rng.randrange(1, 9)))
              for _ in range(1000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [(r["t"], r["u"]) for r in df.select("t", unescape_references("t").alias("u")).collect()]
    assert len(got) == len(texts) + 1
    assert [(t, u) for t, u in got if u != (None if t is None else html.unescape(t))] == []
