"""Catalog scalars over typed flow columns (C2-C5) -- built-in expressions only.

``annotations`` is ``array<struct<type:string,title:string,text:string>>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import first_nonblank, nonblank, pystrip

# Frequency codes and their names; tag length limits; api prefix.
FREQ_MAP = {"A": "annual", "Q": "quarterly", "M": "monthly", "W": "weekly", "D": "daily"}
FREQ_PATTERN = r"(?iuU)FREQUENCY\s*=\s*([AQMWD])"
TAG_PART_MAX = 64
TAG_TEXT_MAX = 100
API_PREFIX = "http://data.api.abs.gov.au/data/"
DEFAULT_AGENCY = "ABS"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def infer_freq(annotations) -> Column:
    """First annotation whose ``_first(title, text)`` matches wins; else ''."""
    codes = F.transform(F.coalesce(_c(annotations), F.array()), lambda a: F.regexp_extract(
        F.coalesce(first_nonblank(a["title"], a["text"]), F.lit("")), FREQ_PATTERN, 1))
    code = F.upper(F.try_element_at(F.filter(codes, lambda x: x != ""), F.lit(1)))
    lookup = F.create_map(*[F.lit(x) for kv in FREQ_MAP.items() for x in kv])
    return F.coalesce(lookup[code], F.lit(""))


def _annotation_tags(a: Column) -> Column:
    typ = a["type"]
    title = nonblank(a["title"])
    text = nonblank(a["text"])
    type_tag = F.when(typ.isNotNull() & (typ != ""), pystrip(typ))
    parts = F.filter(F.transform(F.split(F.coalesce(title, F.lit("")), ","), lambda p: pystrip(p)),
                     lambda p: p != "")

    def part_tags(p: Column) -> Column:
        key = pystrip(F.substring_index(p, "=", 1))
        has_eq = F.instr(p, "=") > 0
        return F.array(
            F.when(has_eq & (key != "") & (F.length(key) <= TAG_PART_MAX), key),
            F.when(F.length(p) <= TAG_PART_MAX, p))

    text_tag = F.when(text.isNotNull() & (title.isNull() | (text != title)) &
                      (F.length(text) <= TAG_TEXT_MAX), text)
    return F.concat(F.array(type_tag), F.flatten(F.transform(parts, part_tags)), F.array(text_tag))


def collect_tags(annotations) -> Column:
    """The distinct tag set, sorted by code point (array<string>)."""
    per = F.transform(F.coalesce(_c(annotations), F.array()), _annotation_tags)
    flat = F.filter(F.flatten(per), lambda x: x.isNotNull())
    return F.array_sort(F.array_distinct(flat))


def stable_id(native_id, *key_parts) -> Column:
    """C4: native id if non-blank, else SHA-1 of a deterministic key (``a|b|c``)."""
    key = F.concat_ws("|", *[F.coalesce(_c(k).cast("string"), F.lit("None")) for k in key_parts])
    return F.coalesce(nonblank(native_id), F.sha1(key))


def api_url(native_id, prefix: str = API_PREFIX) -> Column:
    nid = nonblank(native_id)
    return F.when(nid.isNotNull(), F.concat(F.lit(prefix), nid)).otherwise(F.lit(""))
