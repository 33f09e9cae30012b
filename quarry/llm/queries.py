"""Registered queries of the training-data operators, one per operator, with
DuckDB SQL where SQL can express the operator.  Each query applies its operator
to the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (byte_bpe, conversation_trie, decontaminate, license_scan, line_dedup, lm_score,
                        minhash_dedup, period_runs, secret_scan, tables, token_count, token_store, toxicity, voronoi_knn)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "documents")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and decision for every document."""
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, tables.table(spark, sf_dir, "labels")))


@query("op2_license_scan", license_scan.oracle())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices of every document."""
    return license_scan.scan(documents(spark, sf_dir))


LINE_SQL = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
split AS (SELECT doc_id, pos, parts[pos] AS line, trim(parts[pos], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t
          FROM lines, unnest(range(1, len(parts) + 1)) u(pos)),
solid AS (SELECT doc_id, pos, t, length(t)::BIGINT AS n FROM split WHERE t <> ''),
firsts AS (SELECT t, n, min((doc_id, pos)) AS place FROM solid GROUP BY t, n),
halves AS (SELECT place, t, n, m, left(t, (m // 2)::BIGINT) AS head, right(t, (m - m // 2)::BIGINT) AS tail
           FROM firsts, unnest([n, n - 1]) u(m) WHERE n >= 24),
pairs AS (SELECT x.place AS xa, y.place AS ya, x.t AS xt, y.t AS yt, x.n AS xn, y.n AS yn
          FROM halves x JOIN halves y ON x.m = y.m AND x.head = y.head AND x.n = x.m AND x.t <> y.t
          UNION SELECT x.place, y.place, x.t, y.t, x.n, y.n
          FROM halves x JOIN halves y ON x.m = y.m AND x.tail = y.tail AND x.n = x.m AND x.t <> y.t),
differ AS (SELECT *, coalesce(list_min(list_filter(range(1, xn + 1), lambda i: xt[i] <> yt[i])), xn + 1) AS p FROM pairs),
close AS (SELECT xa, ya FROM differ WHERE substr(xt, p + (CASE WHEN xn = yn THEN 1 ELSE 0 END)) = substr(yt, p + 1)),
near AS (SELECT greatest(xa, ya) AS place FROM close),
gone AS (SELECT doc_id, pos FROM solid l JOIN firsts f USING (t)
         WHERE (l.doc_id, l.pos) <> f.place OR f.place IN (SELECT place FROM near)),
kept AS (SELECT s.doc_id, s.pos, s.line, g.pos IS NOT NULL AS dropped
         FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS text_sha256
FROM kept GROUP BY doc_id"""


@query("op3_line_dedup", LINE_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many repeat earlier ones, and a digest of the text without them."""
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query("op4_token_store")
def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as ORC in doc_id order and read back."""
    path = tables.scratch_path(spark, "ids")
    token_store.write_ids(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path, end_id=2)
    return token_store.with_crc(token_store.read_ids(spark, path))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: pattern spans and random-looking runs."""
    return secret_scan.digest(secret_scan.scan(documents(spark, sf_dir)))


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontaminate.find_passages(documents(spark, sf_dir), tables.table(spark, sf_dir, "benchmark"))


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM w, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) u(i)
       WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
sym AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT r.d, s.y FROM reach r JOIN sym s ON s.x = r.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(r) AS component_id FROM reach GROUP BY d) c USING (doc_id)"""


@query("op7_minhash_dedup", NEAR_SQL)
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents by shingles of four words."""
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), width=4)


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the byte-level ranks and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN).drop("ids")


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they exceed a context of 1024."""
    return token_count.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


KNN_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding,
                 lambda x: coalesce(isfinite(x), false)))),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


@query("op10_voronoi_knn", KNN_SQL)
def op10_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every twentieth vector with all others."""
    vectors = voronoi_knn.quantised(tables.table(spark, sf_dir, "embeddings"))
    return voronoi_knn.knn_join(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


@query("op11_lm_score")
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and context-mixing log-probabilities of every document."""
    docs = documents(spark, sf_dir)
    return lm_score.score(docs, lm_score.train(docs))


@query("op12_period_runs")
def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the strongest one, and digests of all runs and of the collapsed text."""
    docs = period_runs.with_planted_runs(documents(spark, sf_dir))
    return period_runs.digest(period_runs.period_runs(docs))


def crc32_sql(value: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a value's decimal text, bit by bit."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({value}::VARCHAR, ''),
        lambda s: [ord(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, v: CASE WHEN v >= 0 THEN xor(a, v)
        WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""


TRIE_SQL = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, sha256(coalesce(text, '')) AS x,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS w,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     sha256(coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
k AS (SELECT n.c, h, b, least(h, coalesce(m.n, 0)) AS taken FROM (SELECT c, {crc32_sql('c')} % 4 AS h, c - c % 20 AS b FROM n) n
      LEFT JOIN n m ON m.c = n.b),
turns AS (SELECT c, p - h + taken AS d, r, x, w FROM t JOIN k USING (c) WHERE p > h
          UNION ALL SELECT k.c, p, r, x, w FROM k JOIN t ON t.c = k.b AND p <= taken),
seq AS (SELECT k.c, coalesce(list({{'r': r, 'x': x, 'w': w}} ORDER BY d) FILTER (d IS NOT NULL), []) AS s
        FROM k LEFT JOIN turns USING (c) GROUP BY k.c),
pre AS (SELECT c, d, s[1:d] AS q FROM seq, unnest(range(0, len(s) + 1)) u(d)),
node AS (SELECT q, d, min(c) AS conv_id, count(*) AS n_convs FROM pre GROUP BY q, d),
child AS (SELECT q[1:d - 1] AS q, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
val AS (SELECT node.q, node.d, (n_convs - 1) * coalesce(node.q[node.d].w, 0) AS saved, (n_children IS NULL)::BIGINT AS leaf
        FROM node LEFT JOIN child USING (q, d)),
sums AS (SELECT q[1:e] AS q, e AS d, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves
         FROM val, unnest(range(0, d + 1)) u(e) GROUP BY ALL),
ends AS (SELECT s AS q, len(s) AS d, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM seq GROUP BY s)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node JOIN sums USING (q, d) LEFT JOIN child USING (q, d) LEFT JOIN ends USING (q, d)
     LEFT JOIN node up ON up.d = node.d - 1 AND up.q = node.q[1:node.d - 1]"""


@query("op13_conversation_trie", TRIE_SQL)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations, one row per node."""
    return conversation_trie.trie(tables.table(spark, sf_dir, "conversations"))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
