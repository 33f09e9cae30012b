"""Answer pipelines over a batch of queries.

One output row per query row, as the reference's ``/query`` and ``/similar``
responses, plus the audit record of every answered query.  The whole batch is
one DataFrame chain: embed (U1) -> exact top-k (R4, J7) -> hits array (J2) ->
answer text (C12/U2) -> mask (T2) -> sources (C10) -> trust (T3-T7).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.functions import trust as tr
from quarry.functions import vectors as vx
from quarry.operators.cells import LEAST_PAIRS, knn_join
from quarry.operators.embed import embed
from quarry.sources.audit import append_audit, read_audit  # noqa: F401

HIT_FIELDS = ("id", "title", "description", "agency", "api_url", "url")


def store_search(queries: DataFrame, collection: DataFrame, k: int, *,
                 qid: str = "qid", qvec: str = "qvec", exclude_self: bool = False,
                 fields: tuple[str, ...] | None = None, least_pairs: int = LEAST_PAIRS) -> DataFrame:
    """Nearest ``k`` by squared L2 with metadata and store score.

    Beyond ``least_pairs`` pairs the search leaves out cells that cannot matter.

    Returns ``(qid, rank, id, distance, similarity_score, title, ...)``.
    The search itself sees ids and vectors only; the winners' metadata is joined
    to them afterwards (``fields`` narrows it; default: every hit field).
    """
    carry = [f for f in (fields if fields is not None else HIT_FIELDS) if f != "id"]
    top = knn_join(queries, collection, k, query_id=qid, query_vec=qvec, id_col="id",
                   vec_col="embedding", metric="l2sq", exclude_self=exclude_self, least_pairs=least_pairs)
    named = top.join(collection.select("id", *carry), "id") if carry else top
    return named.withColumn("similarity_score", vx.store_score("distance"))


def _hits_by_query(hits: DataFrame) -> DataFrame:
    packed = F.struct(F.col("rank"), *[F.col(f) for f in HIT_FIELDS], F.col("similarity_score"))
    return hits.groupBy(F.col("qid")).agg(F.sort_array(F.collect_list(packed)).alias("_h")) \
        .select("qid", F.transform("_h", lambda h: F.struct(
            *[h[f].alias(f) for f in HIT_FIELDS], h["similarity_score"].alias("similarity_score")))
            .alias("hits"))


def _finish(df: DataFrame, answer: F.Column, deterministic_audit: bool, audit_key: F.Column) -> DataFrame:
    srcs = tr.sources("hits")
    factors = tr.trust_factors(F.col("answer"), F.col("hits"), F.col("sources"))
    aid = tr.audit_id(audit_key if deterministic_audit else None)
    out = df.withColumn("answer", tr.mask_claims(answer)) \
        .withColumn("sources", srcs) \
        .withColumn("audit_id", aid)
    return out.withColumn("trust", tr.trust_struct(factors, F.col("audit_id")))


def answer_queries(queries: DataFrame, collection: DataFrame, *, k: int = 4,
                   qid: str = "qid", text_col: str = "query",
                   embedder: Callable | None = None,
                   generator: Callable[[list[str]], list[str]] | None = None,
                   deterministic_audit: bool = False) -> DataFrame:
    """The ``/query`` pipeline for every row of ``queries``.

    Status: ``blank`` (G10: fixed answer, score 0, empty audit id, not logged),
    ``no_hits`` (fixed answer, zero trust, logged) or ``ok``.
    """
    q = queries.select(F.col(qid).alias("qid"), F.col(text_col).alias("query"))
    blank = tx.pystrip(F.coalesce("query", F.lit(""))) == ""
    live = q.where(~blank)
    vecs = embed(live, "query", "qvec", embedder=embedder)
    hits = _hits_by_query(store_search(vecs, collection, k))
    joined = q.join(hits, "qid", "left") \
        .withColumn("hits", F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType))) \
        .withColumn("count", F.size("hits").cast("bigint")) \
        .withColumn("status", F.when(blank, "blank").when(F.col("count") == 0, "no_hits")
                    .otherwise("ok"))
    raw = F.when(F.col("status") == "blank", F.lit(tr.BLANK_ANSWER)) \
        .when(F.col("status") == "no_hits", F.lit(tr.NO_HITS_ANSWER)) \
        .otherwise(tr.fallback_answer("query", "count"))
    if generator is not None:
        joined = generate(joined.withColumn("prompt", tr.prompt("query", "hits")), generator)
        raw = F.when(F.col("status") == "ok", F.coalesce("generated", raw)).otherwise(raw)
    out = _finish(joined, raw, deterministic_audit, F.col("qid"))
    blank_trust = F.struct(F.lit(0.0).alias("score"),
                           F.array().cast(out.schema["trust"].dataType["factors"].dataType).alias("factors"),
                           F.array().cast("array<string>").alias("checks"), F.lit("").alias("audit_id"))
    return out.withColumn("trust", F.when(F.col("status") == "blank", blank_trust).otherwise(F.col("trust"))) \
        .withColumn("audit_id", F.col("trust.audit_id"))


def similar_by_id(ids: DataFrame, collection: DataFrame, *, k: int = 3, id_col: str = "id",
                  reembed: bool = False, embedder: Callable | None = None,
                  generator: Callable[[list[str]], list[str]] | None = None,
                  deterministic_audit: bool = False, least_pairs: int = LEAST_PAIRS) -> DataFrame:
    """The ``/similar/{id}`` pipeline for every id in ``ids``.

    The query vector is the stored one (default) or, with ``reembed``, the
    embedding of the stored document text, as the reference does.  Self is
    removed before the cut (W5).  Status ``not_found`` (404) for unknown ids.
    """
    want = ids.select(F.col(id_col).cast("string").alias("qid")).distinct()
    known = want.join(collection.select(F.col("id").alias("qid"), "embedding", "document"), "qid")
    if reembed:
        qv = embed(known.select("qid", "document"), "document", "qvec", embedder=embedder)
    else:
        qv = known.select("qid", F.col("embedding").alias("qvec"))
    hits = _hits_by_query(store_search(qv, collection, k, exclude_self=True, least_pairs=least_pairs))
    found = known.select("qid", F.lit(True).alias("_found"))
    joined = want.join(found, "qid", "left").join(hits, "qid", "left") \
        .withColumn("hits", F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType))) \
        .withColumn("count", F.size("hits").cast("bigint")) \
        .withColumn("status", F.when(F.col("_found").isNull(), "not_found")
                    .when(F.col("count") == 0, "no_hits").otherwise("ok")).drop("_found") \
        .withColumn("query", F.concat(F.lit("similar:"), F.col("qid")))
    raw = F.when(F.col("status") == "not_found", F.format_string("Dataset %s not found", F.col("qid"))) \
        .when(F.col("status") == "no_hits", F.format_string("No similar datasets found for %s.", F.col("qid"))) \
        .otherwise(tr.fallback_answer("qid", "count", similar=True))
    if generator is not None:
        joined = generate(joined.withColumn("prompt", tr.prompt("qid", "hits", similar=True)), generator)
        raw = F.when(F.col("status") == "ok", F.coalesce("generated", raw)).otherwise(raw)
    return _finish(joined, raw, deterministic_audit, F.col("query"))


def generate(df: DataFrame, generator: Callable[[list[str]], list[str]],
             prompt_col: str = "prompt", out_col: str = "generated", batch_rows: int = 16) -> DataFrame:
    """Batch answer generation; any failure yields NULL (the caller falls back to C12)."""
    from pyspark.sql import types as T

    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(it):
        for pdf in it:
            prompts = pdf[prompt_col].tolist()
            outs: list = []
            for lo in range(0, len(prompts), batch_rows):
                part = prompts[lo:lo + batch_rows]
                try:
                    got = [None if g is None else str(g).strip() for g in generator(part)]
                    if len(got) != len(part):
                        raise ValueError("generator returned a different number of answers")
                except Exception:
                    got = [None] * len(part)
                outs.extend(got)
            pdf = pdf.copy()
            pdf[out_col] = outs
            yield pdf

    return df.mapInPandas(run, schema)


def audit_records(answers: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """K6: one audit record per answered (non-blank, found) query."""
    logged = answers.where(~F.col("status").isin("blank", "not_found"))
    ts = F.unix_timestamp(F.current_timestamp())
    ext = F.create_map(*[F.lit(x) for kv in (extra or {}).items() for x in kv]) if extra \
        else F.create_map().cast("map<string,string>")
    return logged.select(
        F.col("audit_id"), ts.alias("timestamp"), F.col("query"), F.col("answer"),
        F.col("hits").alias("raw_hits"), F.col("trust"), ext.alias("extra"),
        F.to_date(F.from_unixtime(ts)).cast("string").alias("dt"))


def audit_lookup(audit: DataFrame, ids: DataFrame, id_col: str = "audit_id") -> DataFrame:
    """Batch lookup of audit ids; ``found`` false for unknown ids."""
    hit = audit.select(F.col("audit_id"), F.struct(*[F.col(c) for c in audit.columns]).alias("record"))
    return ids.select(F.col(id_col).alias("audit_id")).join(hit, "audit_id", "left") \
        .withColumn("found", F.col("record").isNotNull())
