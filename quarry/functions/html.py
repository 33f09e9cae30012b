"""HTML extraction (E1-E7, F1) over a flat node array.

``nodes`` is the only parse: an Arrow UDF on the standard-library parser emits
one array of nodes per page (elements and text runs in document order; each knows
its subtree's end, its parent and whether it lies in page chrome).  Every field
is a Spark expression over that array and is only evaluated where it is used:
metas, title, description, tags, links, date texts and visible text.  The one
other Python step is ``unescape`` (the standard library's entity table).

Tree rules: void tags close at once; no end tag is implied; an end tag closes
the nearest open element of its name and is ignored when none is open; the end
of the input closes everything.  Text in script, style, template, rt and rp,
comments and declarations is ``hidden``: not part of an element's text.
"""

from __future__ import annotations

import html as _html
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions import urls as ux
from quarry.functions.text import PY_WS, pystrip

# Fixed values used by the extraction rules.
DESCRIPTION_METAS = (("name", "description"), ("property", "og:description"),
                     ("name", "twitter:description"))
DESCRIPTION_MAX = 500
SUBJECT_METAS = ("dcterms.subject", "dc.subject")
KEYWORD_CAP, TAG_CAP, TAG_ROOM = 5, 8, 6
TAG_MIN_LEN, TAG_MAX_LEN = 2, 50
DATE_METAS = ("date", "publication-date", "created", "modified", "dc.date",
              "dcterms.created", "dcterms.modified")
DATE_HINT = r"(?i)(published|updated|created|collected|as at|data from|year ending)"
CHROME_TAGS = ("script", "style", "noscript", "template", "header", "footer", "nav", "aside")
TEXT_SELECTORS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "dt", "dd", "th", "td")
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta",
             "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex",
             "nextid", "spacer")
HIDDEN_TAGS = ("script", "style", "template", "rt", "rp")

NODES = T.ArrayType(T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("up", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()), T.StructField("hidden", T.BooleanType()),
    T.StructField("chrome", T.BooleanType()), T.StructField("joined", T.StringType()),
    T.StructField("joined_strip", T.StringType())]))
_ARROW_NODES = to_arrow_type(NODES)


# ------------------------------------------------------------------- parse

def _join(base: str, href: str | None) -> str | None:
    if href is None:
        return None
    try:
        return urljoin(base, href)
    except ValueError:
        return None


class _Emitter(HTMLParser):
    """Appends one dict per element start and text run; ``open`` holds the open elements' rows."""

    def __init__(self, base: str) -> None:
        super().__init__(convert_charrefs=True)
        self.base, self.rows, self.open, self.run, self.void_ends = base, [], [], [], {}

    def _row(self, **values) -> dict:
        up = self.open[-1] if self.open else None
        row = {"i": len(self.rows), "end": len(self.rows) + 1, "up": up["i"] if up else -1, "tag": None, "attrs": None,
               "text": None, "hidden": up["hidden"] if up else False, "chrome": up["chrome"] if up else False,
               "joined": None, "joined_strip": None} | values
        self.rows.append(row)
        return row

    def _text(self) -> None:
        text, self.run = "".join(self.run), []
        if not text:
            return
        if not text.strip(" \t\n\r\f\v") and not any(o["tag"] in ("pre", "textarea") for o in self.open):
            text = "\n" if "\n" in text else " "
        self._row(text=text)

    def _close(self, tag: str) -> None:
        at = next((k for k in reversed(range(len(self.open))) if self.open[k]["tag"] == tag), None)
        if at is not None:
            for row in self.open[at:]:
                row["end"] = len(self.rows)
            del self.open[at:]

    def handle_starttag(self, tag, attrs):
        self._text()
        values = {k: v or "" for k, v in attrs}
        href = values.get("href")
        row = self._row(tag=tag, attrs=values, joined=_join(self.base, href),
                        joined_strip=_join(self.base, href.strip()) if href is not None else None)
        row["hidden"] |= tag in HIDDEN_TAGS
        row["chrome"] |= tag in CHROME_TAGS
        if tag in VOID_TAGS:
            self.void_ends[tag] = self.void_ends.get(tag, 0) + 1
        else:
            self.open.append(row)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.void_ends.get(tag):  # an explicit end tag of a void element
            self.void_ends[tag] -= 1
            return
        self._text()
        self._close(tag)

    def handle_data(self, data):
        self.run.append(data)

    def _note(self, data):
        self._text()
        self._row(text=data, hidden=True)

    handle_comment = handle_decl = handle_pi = unknown_decl = _note

    def finish(self) -> list[dict]:
        self._text()
        for row in self.open:
            row["end"] = len(self.rows)
        return self.rows


def page_nodes(page: str | None, base: str | None) -> list[dict]:
    """Nodes of one page; malformed markup keeps what was read."""
    emitter = _Emitter(base or "")
    try:
        emitter.feed(page or "")
        emitter.close()
    except Exception:  # noqa: BLE001 - the parser gives up on some markup
        pass
    return emitter.finish()


PARSED = 1 << 18  # characters of html whose nodes are held at once; a node takes far more than its text


def _pieces(pages: Iterable) -> Iterator[tuple[int, int]]:
    """Row ranges of about PARSED characters (bytes, if the pages are buffers), one page at least."""
    lo = held = end = 0
    for i, page in enumerate(pages):
        size = len(page) if page is not None else 0
        if i > lo and held + size > PARSED:
            yield lo, i
            lo, held = i, 0
        held += size + 64
        end = i + 1
    yield lo, end


def _node_array(pages: list[list[dict]]) -> pa.Array:
    """The pages' nodes in Arrow's form of ``NODES`` (a map is made of pairs)."""
    for page in pages:
        for n in page:
            if n["attrs"] is not None:
                n["attrs"] = list(n["attrs"].items())
    return pa.array(pages, _ARROW_NODES)


@F.arrow_udf(NODES)
def _nodes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """A batch stays in Arrow; only the strings and nodes of the piece being parsed are Python objects."""
    for page, url in batches:
        for lo, hi in _pieces(x.as_buffer() for x in page):
            yield _node_array([page_nodes(h.as_py(), u.as_py()) for h, u in zip(page[lo:hi], url[lo:hi])])
        del page, url  # the next batch is read before these names are set again


def nodes(html, url) -> Column:
    """Node array of an html column (see ``NODES``); ``url`` is the base of its links."""
    return _nodes_once(_c(html), _c(url))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else [None if x is None else _html.unescape(x) for x in v])


@F.pandas_udf(T.StringType())
def _unescape_text(values: pd.Series) -> pd.Series:
    return values.map(lambda x: None if x is None else _html.unescape(x))


# Marked non-deterministic so that the optimizer neither moves them into the
# lambdas of the expressions above them nor runs them once per use.
_nodes_once, _unescape_once, _text_once = (u.asNondeterministic() for u in (_nodes, _unescape, _unescape_text))


def unescape(values) -> Column:
    """Entities of every string of an array replaced."""
    return _unescape_once(_c(values))


def unescape_text(text) -> Column:
    """Entities of a string replaced."""
    return _text_once(_c(text))


# ------------------------------------------------------------- expressions

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _under(n: Column, all_nodes: Column) -> Column:
    return F.slice(all_nodes, n["i"] + 2, n["end"] - n["i"] - 1)


def _texts(some: Column) -> Column:
    """Values of the visible text runs among some nodes."""
    return F.transform(F.filter(some, lambda t: t["text"].isNotNull() & ~t["hidden"]), lambda t: t["text"])


def _stripped(texts: Column) -> Column:
    return F.filter(F.transform(texts, lambda t: pystrip(t)), lambda t: t != "")


def text_of(n: Column, all_nodes: Column, sep: str = " ") -> Column:
    """The element's stripped text runs joined by ``sep``."""
    return F.array_join(_stripped(_texts(_under(n, all_nodes))), sep)


def _elements(all_nodes: Column, tag: str) -> Column:
    return F.filter(all_nodes, lambda n: n["tag"] == tag)


def _first(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1))


def _metas(all_nodes: Column, attr: str, value: str) -> Column:
    return F.filter(all_nodes, lambda n: (n["tag"] == "meta") & (n["attrs"][attr] == value))


def _contents(metas: Column) -> Column:
    """Non-empty content attributes of some metas."""
    return F.filter(F.transform(metas, lambda m: m["attrs"]["content"]), lambda c: c.isNotNull() & (c != ""))


def title_raw(ns) -> Column:
    """The title's text when the title holds nothing but one chain down to one text run; else ''."""
    ns = _c(ns)
    one = F.transform(F.slice(_elements(ns, "title"), 1, 1), lambda t: _under(t, ns))
    chain = lambda c: F.forall(c, lambda n: n["up"] == n["i"] - 1) & (F.size(c) > 0)
    value = _first(F.transform(one, lambda c: F.when(chain(c), F.try_element_at(c, F.lit(-1))["text"])))
    return pystrip(F.coalesce(value, F.lit("")))


def title_text(ns) -> Column:
    ns = _c(ns)
    return F.coalesce(_first(F.transform(F.slice(_elements(ns, "title"), 1, 1), lambda t: text_of(t, ns, ""))), F.lit(""))


def description_raw(ns) -> Column:
    """E3 parts, not yet unescaped: content of the first description meta found (in
    priority order, even a blank one), then the first paragraph's text."""
    ns = _c(ns)
    found = _first(F.concat(*[F.slice(_metas(ns, a, v), 1, 1) for a, v in DESCRIPTION_METAS]))
    meta = F.coalesce(pystrip(found["attrs"]["content"]), F.lit(""))
    return F.array(meta, first_paragraph(ns))


def first_paragraph(ns) -> Column:
    ns = _c(ns)
    return F.coalesce(_first(F.transform(F.slice(_elements(ns, "p"), 1, 1), lambda p: text_of(p, ns))), F.lit(""))


def description(parts) -> Column:
    """The meta content when non-blank, else the first paragraph cut to 500 chars."""
    parts = _c(parts)
    return F.when(parts[0] != "", parts[0]).otherwise(F.substring(parts[1], 1, DESCRIPTION_MAX))


def description_chunk(ns) -> Column:
    """E3, chunk-crawler variant: the first name=description meta (stripped) when
    non-blank, else the whole first paragraph."""
    ns = _c(ns)
    own = pystrip(F.coalesce(_first(_metas(ns, "name", "description"))["attrs"]["content"], F.lit("")))
    return F.when(own != "", own).otherwise(first_paragraph(ns))


def _split_keywords(s: Column) -> Column:
    return _stripped(F.split(s, ","))


def _json_keywords(script: Column) -> Column:
    """``keywords`` of a JSON-LD script: of its object, or of every object of its list."""
    doc = F.try_parse_json(script)
    kind = lambda v: F.schema_of_variant(v)
    items = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.filter(F.array(doc), lambda d: d.isNotNull()))

    def of(item: Column) -> Column:
        words = F.try_variant_get(item, "$.keywords", "variant")
        listed = F.transform(F.try_variant_get(words, "$", "array<variant>"), lambda k: (
            F.when(kind(k) == "VOID", F.lit("None")).when(kind(k) == "BOOLEAN", F.initcap(F.try_variant_get(k, "$", "string")))
            .otherwise(F.try_variant_get(k, "$", "string"))))
        return F.when(~kind(item).startswith("OBJECT") | words.isNull(), F.array().cast("array<string>")) \
            .when(kind(words) == "STRING", _split_keywords(F.try_variant_get(words, "$", "string"))) \
            .otherwise(F.coalesce(_stripped(F.filter(listed, lambda x: x.isNotNull())), F.array().cast("array<string>")))

    return F.flatten(F.transform(items, of))


def tag_candidates(ns) -> Column:
    """E4 candidates in priority order, not yet unescaped: array of the four groups'
    arrays (keywords, subjects, article tags, JSON-LD keywords)."""
    ns = _c(ns)
    keywords = F.coalesce(_split_keywords(_first(_metas(ns, "name", "keywords"))["attrs"]["content"]), F.array().cast("array<string>"))
    subjects = F.concat(*[_contents(_metas(ns, "name", n)) for n in SUBJECT_METAS])
    articles = _contents(_metas(ns, "property", "article:tag"))
    scripts = F.filter(ns, lambda n: (n["tag"] == "script") & (n["attrs"]["type"] == "application/ld+json"))
    linked = F.flatten(F.transform(scripts, lambda s: _json_keywords(F.array_join(F.transform(
        _under(s, ns), lambda t: F.coalesce(t["text"], F.lit(""))), ""))))
    strip = lambda a: F.transform(a, lambda x: pystrip(x))
    return F.array(strip(keywords), strip(subjects), strip(articles), strip(linked))


# Cap of each group, and whether it only runs while fewer than TAG_ROOM tags are kept.
TAG_GROUPS = ((KEYWORD_CAP, False), (TAG_CAP, False), (TAG_CAP, True), (TAG_CAP, True))


def select_tags(groups: list[Column]) -> Column:
    """E4 selection: per group an ``aggregate`` keeps a candidate when it has 2-50
    characters, is not yet present (any case) and the list is under the group's cap."""
    def adder(cap):  # Spark reads a lambda's arity: bind the cap in a closure
        def add(kept, value):
            fresh = ~F.exists(kept, lambda x: F.lower(x) == F.lower(value))
            ok = F.length(value).between(TAG_MIN_LEN, TAG_MAX_LEN) & fresh & (F.size(kept) < cap)
            return F.when(ok, F.array_append(kept, value)).otherwise(kept)
        return add

    tags = F.array().cast("array<string>")
    for values, (cap, gated) in zip(groups, TAG_GROUPS, strict=True):
        more = F.aggregate(values, tags, adder(cap))
        tags = F.when(F.size(tags) < TAG_ROOM, more).otherwise(tags) if gated else more
    return tags


def links(ns) -> Column:
    """E5: (url, anchor) of every http(s) link in document order, without fragments."""
    ns = _c(ns)
    anchors = F.filter(ns, lambda n: (n["tag"] == "a") & (n["attrs"]["href"] != "") & n["joined"].isNotNull())
    found = F.transform(anchors, lambda a: F.struct(ux.defrag(a["joined"]).alias("url"), text_of(a, ns).alias("anchor")))
    return F.filter(found, lambda x: ux.scheme(x["url"]).isin("http", "https"))


def hrefs(ns, body_only: bool = False) -> Column:
    """Absolute urls of the links worth following; ``body_only`` leaves page chrome out."""
    ns = _c(ns)
    wanted = lambda n: ((n["tag"] == "a") & n["joined_strip"].isNotNull() & ~ux.skip_href(n["attrs"]["href"])
                        & (~n["chrome"] if body_only else F.lit(True)))
    return F.transform(F.filter(ns, wanted), lambda n: n["joined_strip"])


def date_texts(ns, title: Column, desc: Column) -> Column:
    """texts that may hold a date: title, description, date metas, <time>
    elements, and the elements around a text run with a hint word."""
    ns = _c(ns)
    metas = F.flatten(F.array(*[_contents(F.slice(_metas(ns, "name", n), 1, 1)) for n in DATE_METAS]))
    plain = lambda n: F.array_join(_texts(_under(n, ns)), "")
    times = F.flatten(F.transform(_elements(ns, "time"), lambda n: F.array(n["attrs"]["datetime"], plain(n))))
    hints = F.filter(ns, lambda n: n["text"].rlike(DATE_HINT))
    around = F.transform(hints, lambda n: F.when(n["up"] < 0, F.array_join(_texts(ns), "")).otherwise(
        plain(F.try_element_at(ns, n["up"] + 1))))
    return F.filter(F.concat(F.array(title, desc), metas, times, around), lambda x: x.isNotNull() & (x != ""))


def visible_raw(ns) -> Column:
    """E7, not yet unescaped: the texts of headings, paragraphs, list items and cells
    outside page chrome, selector by selector, one per line."""
    ns = _c(ns)
    shown = F.filter(ns, lambda n: ~n["chrome"] & n["tag"].isin(*TEXT_SELECTORS))
    order = F.array(*map(F.lit, TEXT_SELECTORS))
    rows = F.transform(shown, lambda n: F.struct(
        F.array_position(order, n["tag"]).alias("k"), n["i"].alias("i"),
        F.array_join(_stripped(_texts(F.filter(_under(n, ns), lambda t: ~t["chrome"]))), " ").alias("t")))
    lines = F.transform(F.filter(F.array_sort(rows), lambda r: r["t"] != ""), lambda r: r["t"])
    return F.regexp_replace(F.array_join(lines, "\n"), r"[ \t]+", " ")


def tidy(text) -> Column:
    """At most one empty line in a row; Unicode blanks at the ends removed."""
    return F.regexp_replace(F.regexp_replace(_c(text), r"\n{3,}", "\n\n"), rf"\A{PY_WS}+|{PY_WS}+\z", "")
