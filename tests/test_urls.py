from urllib.parse import parse_qsl, urldefrag, urlencode, urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from quarry.functions import urls as ux

CASES = [
    "http://h.example.org/a/b?x=1&utm_source=feed#frag",
    "https://u:p@h.example.org:8080/p;params?q=a+b&gclid=1&FBCLID=2&k=",
    "http://h/x?a&b=&c=%7E*",
    "http://h/x?sp=a%20b&e=%C3%A9",
    "//h/x",
    "../x",
    "mailto:someone@example.org",
    "http://h/data/file.CSV/",
    "http://h/doc/xlsx",
    "http://h/file.pdf?x=1",
]


def _canonical_py(u):
    p = urlparse(u)
    if not p.scheme or not p.netloc:
        return u
    q = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True)
         if not k.lower().startswith(ux.TRACKING_PREFIXES)]
    return urlunparse(p._replace(fragment="", query=urlencode(q, doseq=True)))


def test_canonical_matches_urllib(spark):
    df = spark.createDataFrame([(u,) for u in CASES], "u string")
    got = [r[0] for r in df.select(ux.canonical("u")).collect()]
    assert got == [_canonical_py(u) for u in CASES]


def test_parts(spark):
    df = spark.createDataFrame([(u,) for u in CASES], "u string")
    rows = df.select("u", ux.netloc("u").alias("h"), ux.path("u").alias("p"),
                     ux.guess_ext("u").alias("e"), ux.is_binary_link("u").alias("b")).collect()
    for r in rows:
        p = urlparse(r["u"])
        assert r["h"] == p.netloc and r["p"] == p.path
    by = {r["u"]: r for r in rows}
    assert by["http://h/data/file.CSV/"]["e"] == ".csv" and not by["http://h/data/file.CSV/"]["b"]
    assert by["http://h/doc/xlsx"]["e"] == ".xlsx"
    assert by["http://h/file.pdf?x=1"]["b"]


def test_resolve_and_scope(spark):
    base = "http://h.gov.au/a/b/c"
    hrefs = ["../x", "//other.gov.au/y", "?q=1", "#f", "/z#top", "http://h.gov.au:80/p"]
    df = spark.createDataFrame([(base, h) for h in hrefs], "b string, h string")
    rows = df.select(ux.resolve("h", "b").alias("r")).collect()
    assert [r[0] for r in rows] == [urldefrag(urljoin(base, h))[0] for h in hrefs]
    s = df.select(ux.in_domain(ux.resolve("h", "b"), "gov.au").alias("ok")).collect()
    assert [r[0] for r in s] == [True, True, True, True, True, False]  # a port fails the test


def test_content_types(spark):
    df = spark.createDataFrame([("text/html; charset=utf-8",), ("",), ("TEXT/CSV",), ("application/zip",)], "c string")
    r = df.select(ux.content_type_is_html("c"), ux.mime_ext("c")).collect()
    assert [x[0] for x in r] == [True, True, False, False]
    assert [x[1] for x in r] == [None, None, ".csv", ".zip"]
