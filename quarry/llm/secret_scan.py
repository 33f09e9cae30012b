"""Operator 5: secrets in texts, by patterns and by a randomness test battery.

Everything is DataFrame expressions.  Patterns find the base spans.  Beyond
them, every run of at least ``MIN_LENGTH`` code characters is a candidate.  Its
encoding is inferred (digits, hex, upper case and digits, letters and digits, base64)
and four tests ask whether it can be a uniformly random string of that alphabet:

* chi-squared of the character counts,
* runs: how often neighbouring characters change between digits, lower case and
  upper case, whose chance under uniformity the alphabet gives,
* serial correlation of neighbouring characters' places in the alphabet,
* equal neighbours: how often a character is repeated at once.

A string that one of them rules out (beyond ``OUTSIDE`` deviations) is no secret.
For the others the evidence against "this is ordinary text" is added up character
by character: the likelihood of the string as ordinary text (letter frequencies,
changes between kinds of characters; the best of several writing styles) over its
likelihood as a uniform string of its own alphabet.  Text rarely keeps to a small
alphabet, so the ratio is right for hex and base36 as for base64.  By Markov's
inequality the ratio bounds the p-value of ordinary text.  It goes into a
Benjamini-Hochberg procedure per encoding and length class, run on counts per
p-value bin: short candidates need more evidence where there are many of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import tables

# The base patterns (group 2 of an assignment has 12 characters or more).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]

MIN_LENGTH = 20
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Level of the false-discovery control, and bins per factor of ten of a p-value.
LEVEL = 0.01
BINS, LAST_BIN = 4, 120
#: Encodings in the order in which they are tried: pattern, alphabet (its order gives the places).
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("BASE36", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[0-9A-Za-z+/_=-]+$", UPPER + LOWER + DIGITS + "+/_-="),
]
#: Deviations from uniformity beyond which a string is not random (chi-squared, runs, serial correlation,
#: equal neighbours).
OUTSIDE = (4.5, 4.0, 4.0, 4.0)
#: Ordinary text.  Frequencies of the letters a-z in per mille (rounded values of European text);
#: digits and signs are taken as equally frequent among themselves.
LETTERS = [81, 14, 28, 42, 132, 19, 20, 43, 72, 3, 8, 42, 25, 74, 66, 23, 4, 63, 66, 78, 32, 12, 15, 3, 14, 6]
SIGNS = "+/_-="
#: Chance of the next character's kind (digit, lower case, upper case, sign) by the kind before it: running
#: words, identifiers (capitals inside words, separators), constants (capitals, digits, separators).
STYLES = [
    [[.88, .04, .04, .04], [.04, .88, .04, .04], [.04, .04, .88, .04], [.04, .04, .04, .88]],
    [[.60, .10, .10, .20], [.04, .82, .06, .08], [.05, .55, .34, .06], [.20, .45, .25, .10]],
    [[.60, .05, .20, .15], [.05, .80, .05, .10], [.07, .03, .80, .10], [.25, .05, .60, .10]],
]

def spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches: array of (start, kind, end, match), in code points."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.transform(F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("b")),
                        lambda x: F.struct(F.length(x["b"]).alias("gap"), x["m"].alias("match")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>").alias("out"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), F.aggregate(steps, empty, add, lambda s: s["out"])).otherwise(none)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _battery(match: Column) -> Column:
    """(encoding, length class, bin of the p-value for "ordinary text") of one candidate,
    in time proportional to its length."""
    def encoded(m: Column) -> Column:
        code = F.coalesce(*[F.when(m.rlike(p), F.lit(i)) for i, (_, p, _) in enumerate(ENCODINGS)], F.lit(len(ENCODINGS) - 1))
        return _let(F.struct(code.alias("code"), F.filter(F.split(m, ""), lambda c: c != "").alias("chars")), lambda e: _let(
            F.struct(e["code"].alias("code"), e["chars"].alias("chars"), pick([a for _, _, a in ENCODINGS], e["code"]).alias("alphabet")), placed))

    def pick(values: list, code: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), code + 1)

    def constants(values: list[float]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    known = UPPER + LOWER + DIGITS + SIGNS
    as_text = constants([math.log10(x / sum(LETTERS)) for x in LETTERS] * 2 + [-1.0] * 10 + [-math.log10(len(SIGNS))] * len(SIGNS))
    kinds_of = lambda a: [sum(c in k for c in a) / len(a) for k in (DIGITS, LOWER, UPPER, SIGNS)]
    change = [1 - sum(x * x for x in kinds_of(a)) for _, _, a in ENCODINGS]

    def placed(e: Column) -> Column:
        kind = lambda c: F.when(c.rlike("[0-9]"), 0).when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2).otherwise(3)
        count = lambda c: F.size(F.filter(e["chars"], lambda x: x == c)).cast("double")
        return _let(F.struct(
            e["code"].alias("code"), F.size(e["chars"]).cast("double").alias("n"), F.length(e["alphabet"]).cast("double").alias("size"),
            F.transform(e["chars"], lambda c: F.instr(e["alphabet"], c).cast("double")).alias("at"),
            F.transform(e["chars"], kind).alias("kinds"),
            total(F.transform(e["chars"], lambda c: F.element_at(as_text, F.instr(F.lit(known), c)))).alias("text"),
            F.aggregate(F.array_distinct(e["chars"]), F.lit(0.0), lambda a, c: a + count(c) * count(c)).alias("squares")), summed)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def neighbours(values: Column) -> Column:
        return F.arrays_zip(F.slice(values, 1, F.size(values) - 1).alias("x"), F.slice(values, 2, F.size(values) - 1).alias("y"))

    def summed(e: Column) -> Column:
        steps = F.transform(neighbours(e["kinds"]), lambda p: p["x"] * 4 + p["y"] + 1)
        style = lambda m: total(F.transform(steps, lambda k: F.element_at(constants([math.log10(x) for r in m for x in r]), k)))
        return _let(F.struct(
            e["code"].alias("code"), e["n"].alias("n"), e["size"].alias("size"), (e["squares"] * e["size"] / e["n"] - e["n"]).alias("chi"),
            (e["text"] + F.greatest(*map(style, STYLES))).alias("text"), pick(change, e["code"]).alias("change"),
            F.size(F.filter(neighbours(e["kinds"]), lambda p: p["x"] != p["y"])).cast("double").alias("changes"),
            F.size(F.filter(neighbours(e["at"]), lambda p: p["x"] == p["y"])).cast("double").alias("repeats"),
            total(e["at"]).alias("sum"), total(F.transform(e["at"], lambda x: x * x)).alias("sum2"),
            total(F.transform(neighbours(e["at"]), lambda p: p["x"] * p["y"])).alias("cross"),
            (e["at"][0] + F.element_at(e["at"], -1)).alias("ends")), tested)

    def tested(e: Column) -> Column:
        n, mean = e["n"], e["sum"] / e["n"]
        chi_z = (e["chi"] - (e["size"] - 1)) / F.sqrt(2 * (e["size"] - 1))
        runs_z = (e["changes"] - (n - 1) * e["change"]) / F.sqrt((n - 1) * e["change"] * (1 - e["change"]))
        repeats_z = (e["repeats"] - (n - 1) / e["size"]) / F.sqrt((n - 1) / e["size"] * (1 - 1 / e["size"]))
        spread = e["sum2"] - e["sum"] * mean
        serial = e["cross"] - mean * (2 * e["sum"] - e["ends"]) + (n - 1) * mean * mean
        r = F.when(spread > 1e-9, serial / spread).otherwise(F.lit(1.0))
        # uniform strings have r near -1/n with deviation 1/sqrt(n)
        uniform = (chi_z <= OUTSIDE[0]) & (F.abs(runs_z) <= OUTSIDE[1]) & (F.abs(r + 1 / n) * F.sqrt(n) <= OUTSIDE[2]) & (
            repeats_z <= OUTSIDE[3])
        evidence = F.when(uniform, F.greatest(-n * F.log10(e["size"]) - e["text"], F.lit(0.0))).otherwise(F.lit(0.0))
        # the bins of very short p-values meet in the last one
        place = F.least(F.floor(evidence * BINS), F.lit(LAST_BIN)).cast("int")
        return F.struct(e["code"].alias("encoding"), F.floor(F.log2(n) * 2).cast("int").alias("size_class"), place.alias("bin"))

    return _let(match, encoded)


def _accepted(candidates: DataFrame) -> DataFrame:
    """(encoding, size_class, from_bin): Benjamini-Hochberg per encoding and length class, on p-value bins.

    A bin b holds p-values of at most 10^(-b / BINS); it passes if that is at most
    LEVEL * (candidates in bins >= b) / candidates.  One row per bin at most, whatever the input.
    """
    group = ["encoding", "size_class"]
    counts = candidates.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("n"))
    tail = Window.partitionBy(*group).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy(*group))
    bound = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS)))
    return (counts.withColumn("tail", F.sum("n").over(tail)).withColumn("total", total)
            .where(bound <= F.lit(LEVEL) * F.col("tail") / F.col("total"))
            .groupBy(*group).agg(F.min("bin").alias("from_bin")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every document: array of (start, kind, end), in code
    points, end exclusive, by start and kind (0 assign, 1 access, 2 hex, 3 random).

    ``docs`` has doc_id and text, other columns are ignored; a null text counts as
    the empty text (no spans).  Base spans are never changed; a random span is added
    unless it overlaps a base span.  Repeated rows give repeated rows and count as
    often in the false-discovery control; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN_VALUE, 1)) >= 12)
    base = tables.columns(docs, "doc_id", "text").select(
        "doc_id", F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2)).alias("base"), spans(text, RUN, 3).alias("run"))
    free = F.filter("run", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    slim = lambda a: F.transform(a, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    tested = F.transform(free, lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end"),
                                                  _battery(r["match"]).alias("test")))
    # the spans are a fraction of the texts: kept as a table, so that the texts are scanned once
    found = tables.keep(base.select("doc_id", slim("base").alias("base"), tested.alias("runs")), "spans")
    accepted = _accepted(found.select(F.explode("runs.test").alias("t")).select("t.*"))
    # one row per encoding and length class: at most 6 * 64
    bound = {(r.encoding, r.size_class): r.from_bin for r in accepted.collect()}
    bounds = F.create_map(*[F.lit(x) for (e, c), b in sorted(bound.items()) for x in (e * 1000 + c, b)]) if bound else \
        F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<int>"))
    ok = F.filter("runs", lambda r: r["test"]["bin"] >= F.coalesce(
        F.element_at(bounds, r["test"]["encoding"] * 1000 + r["test"]["size_class"]), F.lit(LAST_BIN + 1)))
    return found.select("doc_id", F.array_sort(F.concat("base", slim(ok))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and all spans as text."""
    named = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_random"),
        F.sha2(named(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
