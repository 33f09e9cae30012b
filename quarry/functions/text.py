"""String scalars for catalog text (C1, C7-C9, E1 helpers).

All are built-in column expressions; they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (str.isspace),
# written as one regex class usable by both Java regex and RE2.
PY_WS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pystrip(x) -> Column:
    """Python ``str.strip()``: Unicode white space at both ends.

    Uses ``\\z`` (true end) rather than ``$``, which in Java also matches before
    a final line break.
    """
    return F.regexp_replace(_c(x).cast("string"), rf"^{PY_WS}+|{PY_WS}+\z", "")


def nonblank(x) -> Column:
    """Stripped value, or NULL when it is NULL or blank after strip."""
    s = pystrip(x)
    return F.when(s != "", s)


def first_nonblank(*xs) -> Column:
    """First value that is non-null and non-blank after strip, stripped."""
    return F.coalesce(*[nonblank(x) for x in xs])


def safe_str(x) -> Column:
    """NULL -> '', else the value as text."""
    return F.coalesce(_c(x).cast("string"), F.lit(""))


# Labels of the embedding text, in the reference's order.
EMBED_TEXT_LABELS = ("Title", "Description", "Agency", "Collected", "Tags")


def embedding_text(title, description, agency, collected, tags) -> Column:
    """``Label: value`` parts joined by `` | ``.

    A part that ends in ``": "`` (empty value, or a value ending that way) is
    dropped before the strip; NULL counts as blank.
    """
    parts = []
    for label, col in zip(EMBED_TEXT_LABELS, (title, description, agency, collected, tags)):
        p = F.concat(F.lit(f"{label}: "), safe_str(col))
        parts.append(F.when(~p.endswith(": "), pystrip(p)))
    return F.concat_ws(" | ", *parts)


def document_text(title, description, agency, tags) -> Column:
    """``title | description | Agency: a | Tags: t`` -- all four always present."""
    return F.concat_ws(" | ", safe_str(title), safe_str(description),
                       F.concat(F.lit("Agency: "), safe_str(agency)),
                       F.concat(F.lit("Tags: "), safe_str(tags)))
