"""URL scalars.

Everything but ``resolve`` (D1, RFC 3986 joining) is a built-in expression.
Parsing follows ``urllib.parse.urlparse``: scheme (lower-cased), netloc (kept
as written, user-info and port included), path, ``;params``, query, fragment.
"""

from __future__ import annotations

from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import pystrip

# RFC 3986 appendix B split: scheme, //netloc, path, ?query, #fragment.
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

# Extensions, MIME hints and tracking-key prefixes.
DATA_FILE_EXTS = (".csv", ".xls", ".xlsx", ".pdf")
ARCHIVE_FILE_EXTS = (".zip",)
BINARY_EXTS = (".pdf", ".csv", ".xls", ".xlsx")
HTML_MIME_TYPES = ("text/html", "application/xhtml+xml")
TEXT_MIME_HINTS = ("text/html", "application/xhtml+xml")
DATA_MIME_HINTS = {
    "text/csv": ".csv",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "application/pdf": ".pdf",
    "application/zip": ".zip",
}
TRACKING_PREFIXES = ("utm_", "gclid", "fbclid")
SKIP_HREF_PREFIXES = ("javascript:", "mailto:", "tel:")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scheme(u) -> Column:
    return F.lower(F.regexp_extract(_c(u), _SPLIT, 1))


def netloc(u) -> Column:
    """D3: host part as written (user-info and port kept)."""
    return F.regexp_extract(_c(u), _SPLIT, 2)


def _path_params(u) -> Column:
    return F.regexp_extract(_c(u), _SPLIT, 3)


def path(u) -> Column:
    """Path without ``;params`` of the last segment (as ``urlparse``)."""
    pp = _path_params(u)
    last = F.substring_index(pp, "/", -1)
    head = F.left(pp, F.length(pp) - F.length(last))
    return F.when(F.instr(last, ";") > 0,
                  F.concat(head, F.substring_index(last, ";", 1))).otherwise(pp)


def query(u) -> Column:
    return F.regexp_extract(_c(u), _SPLIT, 4)


def fragment(u) -> Column:
    return F.regexp_extract(_c(u), _SPLIT, 5)


def has_query(u) -> Column:
    return F.regexp_extract(_c(u), r"^[^#]*\?", 0) != ""


def defrag(u) -> Column:
    """Drop ``#fragment``."""
    return F.regexp_replace(_c(u), r"#.*\z", "")


def in_domain(u, suffix: str | tuple[str, ...]) -> Column:
    """Lower netloc ends with ``.suffix`` or equals it (a port makes it fail).
    Several suffixes may be given."""
    host = F.lower(netloc(u))
    cond = F.lit(False)
    for sfx in ((suffix,) if isinstance(suffix, str) else suffix):
        s = sfx.lower().lstrip(".")
        cond = cond | host.endswith("." + s) | (host == s)
    return cond


def same_host(a, b) -> Column:
    """Exact netloc equality."""
    return netloc(a) == netloc(b)


def guess_ext(u) -> Column:
    """``.ext`` when the path (lower, trailing slashes cut) ends ``.ext`` or ``/ext``."""
    p = F.regexp_replace(F.lower(path(u)), r"/+\z", "")
    exts = "|".join(sorted({e.lstrip(".") for e in DATA_FILE_EXTS + ARCHIVE_FILE_EXTS},
                           key=lambda e: (-len(e), e)))
    e = F.regexp_extract(p, rf"[./]({exts})\z", 1)
    return F.when(e != "", F.concat(F.lit("."), e))


def looks_like_data_file(u, allow_zip: bool = False) -> Column:
    """D6."""
    ok = list(DATA_FILE_EXTS) + (list(ARCHIVE_FILE_EXTS) if allow_zip else [])
    return F.coalesce(guess_ext(u).isin(ok), F.lit(False))


def is_binary_link(u) -> Column:
    """Path (lower) ends with a binary extension; no slash strip, no ``/ext`` form."""
    p = F.lower(path(u))
    cond = F.lit(False)
    for e in BINARY_EXTS:
        cond = cond | p.endswith(e)
    return cond


def mime_base(content_type) -> Column:
    return F.lower(pystrip(F.substring_index(F.coalesce(_c(content_type), F.lit("")), ";", 1)))


def mime_ext(content_type) -> Column:
    """Extension hinted by the MIME type, or NULL."""
    m = F.create_map(*[F.lit(x) for kv in DATA_MIME_HINTS.items() for x in kv])
    return m[mime_base(content_type)]


def content_type_is_html(content_type) -> Column:
    """Html types, or a blank type."""
    b = mime_base(content_type)
    return b.isin(*HTML_MIME_TYPES) | (b == "")


def response_class(u, status, content_type) -> Column:
    """``binary`` / ``non-html`` / ``html``; NULL = dropped (failed fetch)."""
    ct = F.coalesce(_c(content_type), F.lit(""))
    hint = F.lit(False)
    for h in TEXT_MIME_HINTS:
        hint = hint | (F.instr(ct, h) > 0)
    failed = _c(status) == 0
    return F.when(is_binary_link(u), F.lit("binary")) \
        .when(~failed & hint, F.lit("html")) \
        .when((ct != "") & ~hint, F.lit("non-html"))


def parse_length(x) -> Column:
    """Integer or NULL."""
    return _c(x).try_cast("bigint")


def unquote(x: Column) -> Column:
    """Percent escapes decoded ('+' is a blank); a '%' that starts no escape stays."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25")), x)


def _qs_decode(x: Column) -> Column:
    return unquote(x)


def _qs_encode(x: Column) -> Column:
    enc = F.url_encode(x)
    # Java's form encoder keeps '*' and escapes '~'; Python's quote_plus does the reverse.
    return F.regexp_replace(F.regexp_replace(enc, r"\*", "%2A"), "%7E", "~")


def canonical(u) -> Column:
    """Drop fragment and tracking keys, re-encode the query; only for urls
    with scheme and host, others unchanged.  No dot-segment, case or slash changes."""
    u = _c(u)
    pairs = F.filter(F.split(query(u), "&"), lambda p: p != "")
    kv = F.transform(pairs, lambda p: F.named_struct(
        F.lit("k"), _qs_decode(F.substring_index(p, "=", 1)),
        F.lit("v"), F.when(F.instr(p, "=") > 0, _qs_decode(F.substring(p, F.instr(p, "=") + 1, 1 << 30)))
        .otherwise(F.lit(""))))

    def keep(x):
        lk = F.lower(x["k"])
        cond = F.lit(True)
        for pre in TRACKING_PREFIXES:
            cond = cond & ~lk.startswith(pre)
        return cond

    q = F.array_join(F.transform(F.filter(kv, keep), lambda x: F.concat(
        _qs_encode(x["k"]), F.lit("="), _qs_encode(x["v"]))), "&")
    pp = _path_params(u)
    base = F.concat(scheme(u), F.lit("://"), netloc(u), pp)
    out = F.when(q != "", F.concat(base, F.lit("?"), q)).otherwise(base)
    return F.when((scheme(u) != "") & (netloc(u) != ""), out).otherwise(u)


@F.pandas_udf(T.StringType())
def _resolve(base: pd.Series, href: pd.Series) -> pd.Series:
    out = []
    for b, h in zip(base, href):
        if h is None:
            out.append(None)
            continue
        try:
            out.append(urldefrag(urljoin(b, h) if b else h)[0])
        except ValueError:
            out.append(None)
    return pd.Series(out, dtype=object)


def resolve(href, base=None) -> Column:
    """Join ``href`` to ``base`` (RFC 3986) and drop the fragment."""
    if base is None:
        return defrag(href)
    return _resolve(_c(base), _c(href))


def skip_href(href) -> Column:
    """E6 filter: blank or javascript:/mailto:/tel: hrefs (after strip)."""
    h = pystrip(_c(href))
    cond = (h == "") | h.isNull()
    for pre in SKIP_HREF_PREFIXES:
        cond = cond | h.startswith(pre)
    return cond
