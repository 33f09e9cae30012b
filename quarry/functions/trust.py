"""Trust scoring, grounding and answer text (T1-T7, C10-C13) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Claim patterns and trust weights, as the reference defines them
# (Unicode digits, blanks and word borders).
CLAIM_PATTERN = (r"(?iuU)\b\d+(?:\.\d+)?(?:\s*[%$]|\s*(?:million|billion|thousand|index|rate|percent))\b")
MASK_PATTERN = r"(?iuU)\b\d+(?:\.\d+)?(?:\s*[%$]|\s*(?:million|billion|thousand))\b"
MASK_TEXT = "[data available]"
WEIGHTS = (("grounding", 0.30), ("provenance", 0.20), ("retrieval", 0.20),
           ("verification", 0.20), ("recency", 0.10))
RETRIEVAL_JUMP = 0.90

# Answer texts.
BLANK_ANSWER = "Please provide a specific query to search for datasets."
NO_HITS_ANSWER = "No datasets found matching your query. Please try refining your search terms."
PROMPT_QUERY = (
    'You are a helpful government data assistant. A user asked: "{query}"\n\n'
    "I found these relevant datasets:\n{context}\n\n"
    "Write a brief, friendly response (2-3 sentences) that:\n"
    "1. Acknowledges their query\n"
    "2. Mentions how many datasets were found\n"
    "3. Briefly describes what kind of data is available\n\n"
    "Keep it conversational and helpful.")
PROMPT_SIMILAR = (
    'You are a helpful government data assistant. A user asked for datasets similar to dataset ID: "{query}"\n\n'
    "I found these similar datasets:\n{context}\n\n"
    "Write a brief, friendly response (2-3 sentences) that:\n"
    "1. Acknowledges they're looking for similar datasets\n"
    "2. Mentions how many similar datasets were found\n"
    "3. Briefly explains what makes these datasets related or useful together\n\n"
    "Keep it conversational and helpful.")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numeric_claims(text) -> Column:
    """Every numeric claim in the text (array<string>)."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(CLAIM_PATTERN), F.lit(0))


def mask_claims(text) -> Column:
    """Replace amounts / percents with ``[data available]``."""
    return F.regexp_replace(_c(text), MASK_PATTERN, MASK_TEXT)


def fallback_answer(query, n_hits, similar: bool = False) -> Column:
    """The deterministic answer used when no generator answers."""
    if similar:
        return F.format_string(
            "I found %d datasets similar to '%s'. These datasets share related themes "
            "and might be useful for your analysis:", _c(n_hits), _c(query))
    return F.format_string(
        "I found %d datasets related to '%s'. Here are the most relevant results:",
        _c(n_hits), _c(query))


def context_block(hits, limit: int | None = None) -> Column:
    """C11: ``i. title - agency`` lines joined by newline (first ``limit`` hits)."""
    h = _c(hits)
    if limit is not None:
        h = F.slice(h, 1, limit)
    lines = F.transform(h, lambda x, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), x["title"], F.lit(" - "), x["agency"]))
    return F.array_join(lines, "\n")


def prompt(query, hits, similar: bool = False) -> Column:
    """The model prompt for a query row."""
    tmpl = PROMPT_SIMILAR if similar else PROMPT_QUERY
    ctx = context_block(hits, 3 if similar else None)
    pre, rest = tmpl.split("{query}")
    mid, post = rest.split("{context}")
    return F.concat(F.lit(pre), _c(query), F.lit(mid), ctx, F.lit(post))


def sources(hits) -> Column:
    """title/agency/api_url/url/similarity(3 dp) per hit."""
    return F.transform(_c(hits), lambda h: F.struct(
        F.coalesce(h["title"], F.lit("")).alias("title"),
        F.coalesce(h["agency"], F.lit("")).alias("agency"),
        F.coalesce(h["api_url"], F.lit("")).alias("api_url"),
        F.coalesce(h["url"], F.lit("")).alias("url"),
        F.round(F.coalesce(h["similarity_score"], F.lit(0.0)), 3).alias("similarity")))


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def trust_factors(answer, hits, srcs, metadata_only: bool = True) -> dict[str, Column]:
    """T3-T6 factor values (clamped)."""
    claims = numeric_claims(answer)
    g = F.when(F.lit(metadata_only) & (F.size(claims) > 0), 0.0).otherwise(1.0)
    first_title = F.get(_c(srcs), 0)["title"]
    p = F.when(F.coalesce(first_title, F.lit("")) != "", 1.0).otherwise(0.0)
    m = F.array_max(F.transform(_c(hits), lambda h: F.coalesce(h["similarity_score"], F.lit(0.0))))
    r = F.when(F.coalesce(F.size(_c(hits)), F.lit(0)) <= 0, 0.0) \
        .when(m >= RETRIEVAL_JUMP, F.least(F.lit(1.0), m / RETRIEVAL_JUMP)).otherwise(m)
    v = F.lit(1.0 if metadata_only else 0.0)
    c = F.lit(1.0)
    return {"grounding": _clamp(g), "provenance": _clamp(p), "retrieval": _clamp(r),
            "verification": _clamp(v), "recency": _clamp(c)}


def trust_score(factors: dict[str, Column]) -> Column:
    """Weighted geometric blend, 3 dp."""
    prod = None
    for name, w in WEIGHTS:
        term = F.pow(factors[name], F.lit(w))
        prod = term if prod is None else prod * term
    return F.round(prod, 3)


def trust_struct(factors: dict[str, Column], audit_id: Column) -> Column:
    """``struct<score, factors array<struct<name,value>>, checks, audit_id>``."""
    return F.struct(
        trust_score(factors).alias("score"),
        F.array(*[F.struct(F.lit(n).alias("name"), F.round(factors[n], 3).alias("value"))
                  for n, _ in WEIGHTS]).alias("factors"),
        F.array().cast("array<string>").alias("checks"),
        audit_id.alias("audit_id"))


def audit_id(key: Column | None = None) -> Column:
    """8 characters; random (uuid) by default, or derived from a key."""
    if key is None:
        return F.substring(F.expr("uuid()"), 1, 8)
    return F.substring(F.sha1(key.cast("string")), 1, 8)


def geometric_mean_agg(value, weight) -> Column:
    """I9 over rows: prod(value ** weight) as exp(sum(weight * ln value)); 0 if any value is 0."""
    v, w = _c(value), _c(weight)
    return F.when(F.min(v) <= 0, F.lit(0.0)).otherwise(F.exp(F.sum(w * F.log(v))))
