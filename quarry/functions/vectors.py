"""Vector scalar functions as built-in column expressions (JVM side).

These are the simple, SQL-checkable forms (R1, W8, I2); the block form used
for top-k lives in ``quarry.operators.knn``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    a, b = _c(a), _c(b)
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    a = _c(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"),
                              lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """Cosine similarity; a zero-norm side gives 0 (as sklearn does)."""
    den = norm(a) * norm(b)
    return F.when(den == 0, F.lit(0.0)).otherwise(dot(a, b) / den)


def l2sq(a, b) -> Column:
    a, b = _c(a), _c(b)
    diffs = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) *
                       (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def store_score(sq_distance) -> Column:
    """Store distance -> similarity: clamp(1 - d^2/2, 0, 1) with d clamped >= 0.

    The store's default space is squared L2, so ``d`` is already squared here.
    """
    d = F.greatest(F.lit(0.0), _c(sq_distance).cast("double"))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - d * d / 2.0))


def head(a, n: int = 10) -> Column:
    return F.slice(_c(a), 1, n)


def tail(a, n: int = 10) -> Column:
    a = _c(a)
    return F.slice(a, F.greatest(F.lit(1), F.size(a) - n + 1), n)
