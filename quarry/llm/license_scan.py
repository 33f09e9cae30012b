"""Operator 2: licences by canonical digest.

A text is brought into a canonical form (lower case, no copyright lines,
equivalent spellings made equal, punctuation and blanks reduced to single
spaces) and its SHA-256 digest is hash-joined with the digests of the known
licences, canonicalised the same way.  Units are whole documents, whole lines
(a notice of its own line) and runs of lines: a run starts at a line that opens as a
known text does and has as many words as a known text.  Everything is DataFrame expressions; the known
digests, a fixed list, are broadcast.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import tables
from quarry.llm.licences import KNOWN, MORE

#: Lines that state a copyright (fixed value): only holder and year, or "all rights reserved".
COPYRIGHT = r"(?m)^[ \t]*((copyright|\(c\)|©)[^\n]*(\(c\)|©|[0-9][0-9][0-9][0-9])[^\n]*|all rights reserved[. \t]*)$"
#: Equivalent spellings (fixed values), applied in this order to the lower-case text.
SPELLINGS = [
    ("https://", "http://"), ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("share-alike", "sharealike"), ("organisation", "organization"),
    ("authorisation", "authorization"), ("merchantibility", "merchantability"), ("favour", "favor"),
    ("behaviour", "behavior"), ("copyright owner", "copyright holder"), ("©", "(c)"), ("&", "and"),
]
#: Comment signs before a line's text, and the mark of a line's last word.
LEADER = r"^[ \t]*(//+|/?\*+|#+|;+|--+|<!--|%+)[ \t]*"
END = "|"


def canonical(text: Column) -> Column:
    """The form that is digested; "" if nothing is left."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


#: Words of so many letters are rare enough to choose the most shared among them.
LONG = 10


def anchors(forms: list[str]) -> str | None:
    """A pattern that every lower-cased text with one of these canonical forms matches, so that
    others need no canonical form; None if a form has no word to tell.

    A word of a canonical form stands in the text as it is, unless a spelling was replaced in
    it; of those only "license" is taken, in both spellings.  Words that many forms share come
    first, long ones before short ones.
    """
    made = {w for _, b in SPELLINGS for w in re.findall("[a-z0-9]{2,}", b)} - {"license"}
    usable = [{w for w in form.split() if len(w) > 1 and not any(m in w for m in made)} for form in forms]
    if not all(usable):
        return None
    shared = Counter(w for words in usable for w in words)
    chosen: set[str] = set()
    for words in sorted(usable, key=lambda x: (len(x), sorted(x))):
        if not words & chosen:
            chosen.add(max(words, key=lambda w: (min(len(w), LONG), shared[w], w)))
    return "|".join(sorted(w.replace("license", "licen[cs]e") for w in chosen))


def known_texts(spark) -> DataFrame:
    """license, text of the known texts."""
    return spark.createDataFrame(KNOWN + MORE, "license string, text string")


def _runs(text: Column, shapes: list[tuple[str, int]]) -> Column:
    """Runs of two lines and more, not all of the text: array of (from, to, unit), in words of
    the canonical form.  ``shapes`` are the known texts' first words and numbers of words."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda s: canonical(F.regexp_replace(s, LEADER, ""))), lambda s: s != "")
    words = F.split(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit(END))), " "), " ")
    plain = lambda w: F.replace(w, F.lit(END), F.lit(""))

    def of(w: Column) -> Column:
        opens = lambda i: (i == 1) | F.get(w, i - 2).endswith(END)
        starts = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: opens(i) & plain(F.get(w, i - 1)).isin(sorted({f for f, _ in shapes})))
        sizes = {f: sorted({n for g, n in shapes if g == f}) for f, _ in shapes}
        asked = lambda i: F.coalesce(*[F.when(plain(F.get(w, i - 1)) == f, F.array(*map(F.lit, n))) for f, n in sizes.items()])
        spans = F.flatten(F.transform(starts, lambda i: F.transform(asked(i), lambda n: F.struct(i.alias("from"), (i + n).alias("to")))))
        # a run ends with a line, and the document as a whole is a unit of its own
        ended = F.filter(spans, lambda x: F.coalesce(F.get(w, x["to"] - 2).endswith(END), F.lit(False))
                         & ~((x["from"] == 1) & (x["to"] == F.size(w) + 1)))
        runs = F.transform(ended, lambda x: F.struct(x["from"].alias("from"), x["to"].alias("to"), F.array_join(
            F.slice(w, x["from"], x["to"] - x["from"]), " ").alias("unit")))
        return F.transform(F.filter(runs, lambda x: x["unit"].contains(END + " ")), lambda x: F.struct(
            x["from"].alias("from"), x["to"].alias("to"), plain(x["unit"]).alias("unit")))

    return F.element_at(F.transform(F.array(words), of), 1)


def scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, text_license, n_notices, notices for every document.

    ``docs`` has doc_id and text, other columns are ignored.  ``texts`` has license and
    text of the known licences (a list the driver can hold; None: those of ``licences``);
    texts without a canonical form are left out of it.  ``text_license`` is the licence whose text the whole document is, or
    null; ``n_notices`` counts its lines and runs of lines that are a known licence text
    or notice (a run inside a longer one, or inside a document that is a licence text, is not counted), ``notices`` lists their licences
    (sorted, distinct, comma-joined, "" if none).  Lines end at line feeds.  A null or
    empty text holds no licence; repeated rows give repeated rows; an empty table gives
    an empty result.
    """
    forms = (known_texts(docs.sparkSession) if texts is None else texts).select("license", canonical(F.col("text")).alias("form")).where("form <> ''").distinct()
    listed = sorted({r.form for r in forms.select("form").collect()})
    shapes = sorted({(f.split()[0], len(f.split())) for f in listed})
    anchor = anchors(listed)
    may_hold = lambda text: F.lit(True) if anchor is None else F.lower(text).rlike(anchor)
    known = forms.select("license", F.sha2("form", 256).alias("digest"))
    if texts is None:
        known = F.broadcast(known)  # a fixed list
    unit = lambda kind, text, a=F.lit(None), b=F.lit(None): F.struct(
        F.lit(kind).alias("kind"), a.cast("int").alias("from"), b.cast("int").alias("to"), text.alias("unit"))
    # a unit without text keeps documents without any licence in the result
    none = F.array(unit("line", F.lit(None).cast("string")))
    lines = F.transform(F.split("text", "\n"), lambda s: unit("line", s))
    runs = F.transform(_runs(F.col("text"), shapes), lambda r: unit("run", r["unit"], r["from"], r["to"])) if shapes else F.array()
    units = F.when(may_hold(F.col("text")), F.concat(none, F.array(unit("whole", F.col("text"))), lines, runs)).otherwise(none)
    numbered = tables.columns(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    rows = numbered.select("doc_id", "row", F.explode(units).alias("u")).select("doc_id", "row", "u.*")
    digests = rows.where(F.col("unit").isNull() | may_hold(F.col("unit"))).withColumn(
        "digest", F.sha2(F.when(F.col("kind") == "run", F.col("unit")).otherwise(canonical(F.col("unit"))), 256))
    line = F.when(F.col("kind") == "line", F.col("license"))
    hit = F.when((F.col("kind") == "run") & F.col("license").isNotNull(), F.struct("from", "to", "license"))
    found = digests.join(known, "digest", "left").groupBy("row", "doc_id").agg(
        F.min(F.when(F.col("kind") == "whole", F.col("license"))).alias("text_license"), F.count(line).alias("n"),
        F.collect_set(line).alias("names"), F.collect_set(hit).alias("hits"))
    longest = F.filter("hits", lambda h: F.col("text_license").isNull() & ~F.exists("hits", lambda g: (g["from"] <= h["from"]) & (g["to"] >= h["to"]) & (
        g["to"] - g["from"] > h["to"] - h["from"])))
    return found.withColumn("longest", longest).select(
        "doc_id", "text_license", (F.col("n") + F.size("longest")).alias("n_notices"),
        F.array_join(F.array_sort(F.array_union("names", F.transform("longest", lambda h: h["license"]))), ",").alias("notices"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The same rows in DuckDB SQL."""
    form = "regexp_replace(lower({0}), " + _quoted(COPYRIGHT) + ", '', 'g')"
    for a, b in SPELLINGS:
        form = f"replace({form}, {_quoted(a)}, {_quoted(b)})"
    form = f"sha256(trim(regexp_replace({form}, '[^a-z0-9]+', ' ', 'g')))"
    known = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in KNOWN)
    return f"""
WITH known AS (SELECT DISTINCT license, {form.format('t')} AS digest FROM (VALUES {known}) k(license, t)),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents),
notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
            FROM (SELECT doc_id, {form.format('unit')} AS digest FROM lines) u
            JOIN known USING (digest) GROUP BY doc_id),
wholes AS (SELECT doc_id, min(license) AS license FROM (SELECT doc_id, {form.format('text')} AS digest FROM documents) d
           JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, w.license AS text_license, coalesce(n.n, 0)::BIGINT AS n_notices, coalesce(n.names, '') AS notices
FROM documents d LEFT JOIN notices n USING (doc_id) LEFT JOIN wholes w USING (doc_id)"""
