"""Batch embedding of a text column.

The hosted model of the reference is an outside service; here the embedder
is pluggable (``list[str] -> list[vector]``) and runs inside
``mapInPandas``, ``batch_rows`` texts per call (128 by default, like the
reference's batches).  The default is a local feature-hash embedder: ASCII
word tokens of the lower-cased text, bucket = first 8 hex digits of the
token's MD5 modulo ``dim``, sign from the 9th hex digit, L2-normalised.
It is row-parallel (no shuffle) and can be restated in SQL for checking.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.session import spread

DEFAULT_DIM = 64
_TOKEN = re.compile(r"[a-z0-9]+")


def hash_embed(texts: Sequence[str | None], dim: int = DEFAULT_DIM) -> list[list[float]]:
    out = []
    cache: dict[str, tuple[int, float]] = {}
    for t in texts:
        v = np.zeros(dim, dtype=np.float64)
        for tok in _TOKEN.findall((t or "").lower()):
            hit = cache.get(tok)
            if hit is None:
                h = hashlib.md5(tok.encode("utf-8")).hexdigest()
                hit = (int(h[:8], 16) % dim, 1.0 if int(h[8], 16) < 8 else -1.0)
                cache[tok] = hit
            v[hit[0]] += hit[1]
        n = float(np.sqrt(v @ v))
        out.append((v / n if n > 0 else v).tolist())
    return out


def embed(df: DataFrame, text_col: str, out_col: str = "embedding",
          embedder: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
          batch_rows: int = 128, dim: int = DEFAULT_DIM) -> DataFrame:
    """Append ``out_col`` (array<double>) computed by ``embedder`` per batch."""
    fn = embedder or (lambda texts: hash_embed(texts, dim))
    schema = T.StructType(df.schema.fields + [
        T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def run(it):
        for pdf in it:
            for at in range(0, len(pdf), 8 * batch_rows):  # vectors as Python lists are large
                part, vecs = pdf.iloc[at:at + 8 * batch_rows].copy(), []
                texts = part[text_col].tolist()
                for lo in range(0, len(texts), batch_rows):
                    vecs.extend(list(map(list, fn(texts[lo:lo + batch_rows]))))
                part[out_col] = pd.Series(vecs, index=part.index, dtype=object)
                yield part

    return spread(df).mapInPandas(run, schema)


def hash_embed_sql(text_expr: str, key_expr: str, from_clause: str, dim: int = DEFAULT_DIM) -> str:
    """The default embedder restated in DuckDB SQL (for oracles): rows (key, vec)."""
    return f"""
    (WITH _src AS (SELECT {key_expr} AS k, {text_expr} AS t FROM {from_clause}),
     _tok AS (SELECT k, unnest(regexp_extract_all(lower(coalesce(t, '')), '[a-z0-9]+')) AS tok FROM _src),
     _h AS (SELECT k, md5(tok) AS h FROM _tok),
     _b AS (SELECT k, (('0x' || substr(h, 1, 8))::BIGINT % {dim}) AS b,
                   sum(CASE WHEN ('0x' || substr(h, 9, 1))::INTEGER < 8 THEN 1.0 ELSE -1.0 END) AS v
            FROM _h GROUP BY 1, 2),
     _n AS (SELECT k, sqrt(sum(v * v)) AS n FROM _b GROUP BY 1),
     _g AS (SELECT s.k, g.i FROM _src s, range({dim}) g(i))
     SELECT _g.k AS k,
            list(CASE WHEN _n.n > 0 THEN coalesce(_b.v, 0.0) / _n.n ELSE 0.0 END ORDER BY _g.i) AS vec
     FROM _g LEFT JOIN _b ON _b.k = _g.k AND _b.b = _g.i LEFT JOIN _n ON _n.k = _g.k
     GROUP BY _g.k)"""
