"""Derived views over the driver's tables, defined once in Spark and once in SQL.

Each view grows with its base table; none filters rows away.  The SQL twin
is DuckDB text used by the oracles (the base tables are DuckDB views there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import read_table


def vec_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as a dataset catalog keyed like ``embeddings.vec_id``: a short
    title made from the language and id, the whole text as the description."""
    d = read_table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.upper("lang"), F.lit(" document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.col("source").alias("agency"),
        F.concat(F.lit("http://data.example.org/data/"), F.col("doc_id").cast("string")).alias("api_url"),
        F.concat_ws(";", "lang", "source").alias("tags"))


VEC_CATALOG_SQL = """(SELECT CAST(doc_id AS VARCHAR) AS id, upper(lang) || ' document ' || CAST(doc_id AS VARCHAR) AS title,
    text AS description, source AS agency,
    'http://data.example.org/data/' || CAST(doc_id AS VARCHAR) AS api_url,
    concat_ws(';', lang, source) AS tags FROM documents)"""

# The collection: catalog x vectors (J1) with the C8 document text and C9 blanks.
COLLECTION_SQL = f"""(SELECT c.id, e.embedding::DOUBLE[] AS embedding,
    concat_ws(' | ', coalesce(c.title, ''), coalesce(c.description, ''),
              'Agency: ' || coalesce(c.agency, ''), 'Tags: ' || coalesce(c.tags, '')) AS document,
    coalesce(c.title, '') AS title, coalesce(c.description, '') AS description,
    coalesce(c.agency, '') AS agency, coalesce(c.api_url, '') AS api_url, '' AS url,
    coalesce(c.tags, '') AS tags
  FROM {VEC_CATALOG_SQL} c JOIN embeddings e ON c.id = CAST(e.vec_id AS VARCHAR))"""


def user_queries(spark: SparkSession, sf: str) -> DataFrame:
    """User turns of ``conversations`` as query texts; qid = conv_id * 1000 + turn."""
    c = read_table(spark, sf, "conversations")
    return c.where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), F.col("text").alias("query"))


USER_QUERIES_SQL = """(SELECT conv_id * 1000 + turn AS qid, text AS query
  FROM conversations WHERE role = 'user')"""


def label_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Per-label mean vector of ``embeddings`` (query vectors for R2/R4)."""
    e = read_table(spark, sf, "embeddings")
    ex = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    m = ex.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return m.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("_v")) \
        .select(F.col("label").alias("qid"), F.transform("_v", lambda s: s["m"]).alias("qvec"))


LABEL_CENTROIDS_SQL = """(WITH ex AS (SELECT label, unnest(generate_series(1, len(embedding))) AS pos,
        unnest(embedding) AS x FROM embeddings),
    m AS (SELECT label, pos, avg(x::DOUBLE) AS m FROM ex GROUP BY 1, 2)
  SELECT label AS qid, list(m ORDER BY pos) AS qvec FROM m GROUP BY 1)"""


def answers_text(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` rendered as answer texts with numeric claims."""
    o = read_table(spark, sf, "orders")
    unit = F.element_at(F.array(*[F.lit(u) for u in ANSWER_UNITS]),
                        (F.pmod(F.col("o_orderkey"), F.lit(5)) + 1).cast("int"))
    return o.select("o_orderkey", F.concat(
        F.lit("Order total "), F.col("o_totalprice").cast("bigint").cast("string"), unit,
        F.lit(" for "), F.col("o_orderpriority"), F.lit(" status "), F.col("o_orderstatus")).alias("answer"))


# Unit suffixes of the derived answers, picked by o_orderkey % 5.
ANSWER_UNITS = (" million", " percent", "%x", "% of", "")

ANSWERS_SQL = """(SELECT o_orderkey, 'Order total ' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR)
    || ([' million', ' percent', '%x', '% of', ''])[(o_orderkey % 5) + 1]
    || ' for ' || o_orderpriority || ' status ' || o_orderstatus AS answer FROM orders)"""


# ------------------------------------------------------------------ flows

def part_flows(spark: SparkSession, sf: str) -> DataFrame:
    """``part`` as typed dataflows: blank ids / names / agencies by p_partkey % 7,
    annotation shapes by p_partkey % 6 (see ``PART_FLOWS_SQL``)."""
    p = read_table(spark, sf, "part")
    k = F.col("p_partkey")
    m7, m6 = F.pmod(k, F.lit(7)), F.pmod(k, F.lit(6))
    null = F.lit(None).cast("string")

    def ann(t, ti, tx):
        return F.struct(t.alias("type"), ti.alias("title"), tx.alias("text"))

    L = F.lit
    anns = (F.when(m6 == 0, F.array(ann(L("DEFAULT"), F.concat(L("FREQUENCY=A,SIZE="), F.col("p_size").cast("string")),
                                         L("annual data"))))
            .when(m6 == 1, F.array(ann(L("NOTE"), null, L("Frequency = m")),
                                   ann(L(" "), L("UNIT_MULT=3"), L("UNIT_MULT=3"))))
            .when(m6 == 2, F.array(ann(L("DEFAULT"), L("no frequency here"), L("FREQUENCY=D"))))
            .when(m6 == 3, F.array(ann(L(""), L("  "), null),
                                   ann(L("X"), F.concat(L("freq=w, BASE="), F.col("p_brand")), F.col("p_type"))))
            .when(m6 == 4, F.array().cast("array<struct<type:string,title:string,text:string>>"))
            .otherwise(F.array(ann(L("LONG"), F.concat(F.repeat(L("k"), 65), L("=v")), F.repeat(L("t"), 101)),
                               ann(L("B"), L("FREQUENCY = Q"), L("FREQUENCY = Q")))))
    return p.select(
        L("part").alias("path"), k.alias("pos"),
        F.when(m7 == 0, L("")).when(m7 == 1, L("  "))
        .otherwise(F.concat(L("DF_"), F.floor(k / 2).cast("bigint").cast("string"))).alias("native_id"),
        F.when(m7 == 2, null).when(m7 == 3, L("   ")).otherwise(F.col("p_name")).alias("name"),
        F.concat(F.col("p_name"), L(" (en)")).alias("names_en"),
        F.when(m7 == 4, null).otherwise(F.col("p_type")).alias("description"),
        F.concat(L("type "), F.col("p_type")).alias("descriptions_en"),
        F.when(m7 == 5, null).when(m7 == 6, L(" ")).otherwise(F.col("p_brand")).alias("agency_id"),
        anns.alias("annotations"))


PART_FLOWS_SQL = """(SELECT 'part' AS path, p_partkey AS pos,
    CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN '  '
         ELSE 'DF_' || CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS VARCHAR) END AS native_id,
    CASE p_partkey % 7 WHEN 2 THEN NULL WHEN 3 THEN '   ' ELSE p_name END AS name,
    p_name || ' (en)' AS names_en,
    CASE p_partkey % 7 WHEN 4 THEN NULL ELSE p_type END AS description,
    'type ' || p_type AS descriptions_en,
    CASE p_partkey % 7 WHEN 5 THEN NULL WHEN 6 THEN ' ' ELSE p_brand END AS agency_id,
    CASE p_partkey % 6
      WHEN 0 THEN [{'type': 'DEFAULT', 'title': 'FREQUENCY=A,SIZE=' || CAST(p_size AS VARCHAR), 'text': 'annual data'}]
      WHEN 1 THEN [{'type': 'NOTE', 'title': NULL::VARCHAR, 'text': 'Frequency = m'},
                   {'type': ' ', 'title': 'UNIT_MULT=3', 'text': 'UNIT_MULT=3'}]
      WHEN 2 THEN [{'type': 'DEFAULT', 'title': 'no frequency here', 'text': 'FREQUENCY=D'}]
      WHEN 3 THEN [{'type': '', 'title': '  ', 'text': NULL::VARCHAR},
                   {'type': 'X', 'title': 'freq=w, BASE=' || p_brand, 'text': p_type}]
      WHEN 4 THEN []::STRUCT(type VARCHAR, title VARCHAR, text VARCHAR)[]
      ELSE [{'type': 'LONG', 'title': repeat('k', 65) || '=v', 'text': repeat('t', 101)},
            {'type': 'B', 'title': 'FREQUENCY = Q', 'text': 'FREQUENCY = Q'}] END AS annotations
  FROM part)"""


# ------------------------------------------------------------ links / dates

# Link suffixes by page_id % 6; content types by page_id % 4.
FILE_SUFFIXES = (".csv", ".xlsx", "/pdf", ".zip", ".html", ".csv/")
FETCH_TYPES = ("text/csv", "text/csv; charset=utf-8", "application/pdf", "")


def file_links(spark: SparkSession, sf: str) -> DataFrame:
    """One data-file-like link per page: url without query/fragment + a suffix."""
    p = read_table(spark, sf, "pages")
    sfx = F.element_at(F.array(*[F.lit(x) for x in FILE_SUFFIXES]),
                       (F.pmod("page_id", F.lit(6)) + 1).cast("int"))
    return p.select("page_id", F.col("url").alias("page_url"),
                    F.concat(F.regexp_replace("url", r"[?#].*\z", ""), sfx).alias("link"))


FILE_LINKS_SQL = """(SELECT page_id, url AS page_url,
    regexp_replace(url, '[?#].*$', '') || (['.csv', '.xlsx', '/pdf', '.zip', '.html', '.csv/'])[(page_id % 6) + 1] AS link
  FROM pages)"""


def fetches(spark: SparkSession, sf: str) -> DataFrame:
    """Response metadata per file link (HEAD/GET replaced by a snapshot table)."""
    fl = file_links(spark, sf)
    ct = F.element_at(F.array(*[F.lit(x) for x in FETCH_TYPES]), (F.pmod("page_id", F.lit(4)) + 1).cast("int"))
    ln = F.when(F.pmod("page_id", F.lit(3)) == 0, (F.col("page_id") * 100).cast("string")) \
        .when(F.pmod("page_id", F.lit(3)) == 1, F.lit("")).otherwise(F.lit("x"))
    st = F.when(F.pmod("page_id", F.lit(10)) == 9, F.lit(0)).otherwise(F.lit(200))
    return fl.select("link", st.alias("status"), ct.alias("content_type"), ln.alias("content_length"))


FETCHES_SQL = f"""(SELECT link, CASE WHEN page_id % 10 = 9 THEN 0 ELSE 200 END AS status,
    (['text/csv', 'text/csv; charset=utf-8', 'application/pdf', ''])[(page_id % 4) + 1] AS content_type,
    CASE page_id % 3 WHEN 0 THEN CAST(page_id * 100 AS VARCHAR) WHEN 1 THEN '' ELSE 'x' END AS content_length
  FROM {FILE_LINKS_SQL} fl)"""


def date_texts(spark: SparkSession, sf: str) -> DataFrame:
    """``orders.o_orderdate`` rendered in six forms inside a sentence."""
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    forms = F.array(F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "yyyy/MM/dd"),
                    F.date_format(d, "dd-MM-yyyy"), F.date_format(d, "dd/MM/yyyy"),
                    F.date_format(d, "MMMM yyyy"), F.date_format(d, "d MMMM yyyy"))
    r = F.element_at(forms, (F.pmod("o_orderkey", F.lit(6)) + 1).cast("int"))
    return o.select("o_orderkey", F.concat(
        F.lit("Published "), r, F.lit(" covering "),
        (F.year(d) + F.pmod("o_orderkey", F.lit(3))).cast("string")).alias("text"))


DATE_TEXTS_SQL = """(SELECT o_orderkey, 'Published ' || ([strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y/%m/%d'),
    strftime(o_orderdate, '%d-%m-%Y'), strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%B %Y'),
    strftime(o_orderdate, '%-d %B %Y')])[(o_orderkey % 6) + 1]
    || ' covering ' || CAST(year(o_orderdate) + o_orderkey % 3 AS VARCHAR) AS text FROM orders)"""


# ------------------------------------------------------------------ crawl

CONTENT_TYPES = ("text/html", "text/html; charset=utf-8", "application/xhtml+xml", "", "text/html", "application/json", "text/html")
CONTENT_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in CONTENT_TYPES) + "]"


def content_type(page_id: str) -> F.Column:
    """Derived content type of a page: every seventh is no html."""
    return F.element_at(F.array(*map(F.lit, CONTENT_TYPES)), (F.pmod(page_id, F.lit(len(CONTENT_TYPES))) + 1).cast("int"))


def page_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Derived page-to-page links: page p -> pages (7p+1) mod n and (3p+2) mod n."""
    p = read_table(spark, sf, "pages").select("page_id", "url")
    n = p.select(F.count("*")).scalar()  # scalar subquery, evaluated once inside the plan
    src = p.select(F.col("page_id").alias("src_id"), F.col("url").alias("src_url"))
    a = src.select("src_id", "src_url", F.lit(0).alias("k"),
                   F.pmod(F.col("src_id") * 7 + 1, n).alias("dst_id")) \
        .unionByName(src.select("src_id", "src_url", F.lit(1).alias("k"),
                                F.pmod(F.col("src_id") * 3 + 2, n).alias("dst_id")))
    d = p.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst_url"))
    return a.join(d, "dst_id")


def page_edges_sql(n_expr: str = "(SELECT count(*) FROM pages)") -> str:
    return f"""(SELECT s.page_id AS src_id, s.url AS src_url, e.k, d.page_id AS dst_id, d.url AS dst_url
  FROM pages s, (VALUES (0), (1)) e(k),
       pages d
  WHERE d.page_id = CASE e.k WHEN 0 THEN (s.page_id * 7 + 1) % {n_expr} ELSE (s.page_id * 3 + 2) % {n_expr} END)"""


def robots_rules(spark: SparkSession, sf: str) -> DataFrame:
    """One robots file per origin of ``pages``: hosts of even length disallow /es/."""
    p = read_table(spark, sf, "pages")
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    origin = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    body = F.when(F.pmod(F.length(host), F.lit(2)) == 0, F.lit("User-agent: *\nDisallow: /es/")) \
        .otherwise(F.lit("User-agent: *\nAllow: /"))
    return p.select(origin.alias("origin"), F.lit(200).alias("status"), body.alias("body")).distinct()


def made_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One html page per part, written from its columns, so that SQL over the columns
    knows every extracted field: metas in all variants, keywords, JSON-LD, dates, links
    in and outside page chrome, and a paragraph longer than a chunk."""
    p = read_table(spark, sf, "part")
    key, k = F.col("p_partkey"), F.pmod("p_partkey", F.lit(4))
    every = lambda n, html: F.when(F.pmod(key, F.lit(n)) == 0, html).otherwise(F.lit(""))
    c = lambda *xs: F.concat(*[F.lit(x[1:]) if isinstance(x, str) and x.startswith("=") else F.col(x) if isinstance(x, str) else x for x in xs])
    meta = F.when(k == 0, c("=<meta name=\"description\" content=\" ", "p_type", "= &amp;amp; more \">")) \
        .when(k == 1, c("=<meta property=\"og:description\" content=\"", "p_type", "=\">")) \
        .when(k == 2, F.lit("<meta name=\"description\" content=\"  \"><meta property=\"og:description\" content=\"unused\">")).otherwise(F.lit(""))
    html = c(
        "=<html><head><title> ", "p_name", "= &amp; co</title>", meta,
        every(3, c("=<meta name=\"keywords\" content=\"", "p_brand", "=, x ,", F.lower("p_brand"), "=,size ", F.col("p_size").cast("string"), "=\">")),
        every(2, c("=<meta name=\"dcterms.subject\" content=\"subject ", "p_name", "=\">")),
        every(5, c("=<script type=\"application/ld+json\">{\"keywords\": \"ld ", "p_type", "=, LD\"}</script>")),
        every(2, c("=<meta name=\"dcterms.modified\" content=\"20", F.lpad(F.pmod(key, F.lit(20)).cast("string"), 2, "0"), "=-0",
                   (F.pmod(key, F.lit(9)) + 1).cast("string"), "=-15\">")),
        "=</head><body><nav><a href=\"/nav\">Nav</a><p>menu</p></nav><h1>", "p_name", "=</h1><p>First  ", "p_type", "= para</p>",
        every(7, c("=<p>", F.repeat(c("p_name", "= and "), 150), "=end</p>")),
        "=<ul><li>", "p_brand", "=</li></ul><a href=\"/p/", key.cast("string"), "=#f\">Go <b>", "p_brand", "=</b></a>",
        every(3, c("=<a href=\"mailto:a@b.example\">mail</a><time datetime=\"1995-02-03\">old</time><div>Last updated 4/5/1996</div>")),
        "=<footer><p>foot</p></footer></body></html>")
    return p.select(key.alias("page_id"), F.concat(F.lit("http://made.example.org/d/"), key.cast("string")).alias("url"), html.alias("html"))


_LONG = "CASE WHEN p_partkey % 7 = 0 THEN chr(10) || repeat(p_name || ' and ', 150) || 'end' ELSE '' END"
MADE_SQL = f"""(SELECT p_partkey AS page_id, p_name || ' & co' AS title,
    CASE WHEN p_partkey % 4 = 0 THEN p_type || ' & more' WHEN p_partkey % 4 = 1 THEN p_type ELSE 'menu' END AS description,
    CASE WHEN p_partkey % 4 = 0 THEN p_type || ' &amp; more' ELSE 'menu' END AS description_chunk,
    list_concat(CASE WHEN p_partkey % 3 = 0 THEN [p_brand, 'size ' || p_size] ELSE [] END,
                CASE WHEN p_partkey % 2 = 0 THEN ['subject ' || p_name] ELSE [] END,
                CASE WHEN p_partkey % 5 = 0 THEN ['ld ' || p_type, 'LD'] ELSE [] END) AS tags,
    p_name || chr(10) || 'First ' || p_type || ' para' || {_LONG} || chr(10) || p_brand AS visible_text,
    CASE WHEN p_partkey % 2 = 0 THEN '20' || lpad((p_partkey % 20)::VARCHAR, 2, '0') || '-0' || (p_partkey % 9 + 1) || '-15'
         WHEN p_partkey % 3 = 0 THEN '1996-05-04' END AS data_collected_date,
    2 + (p_partkey % 2 = 0)::INT + 3 * (p_partkey % 3 = 0)::INT AS n_date_texts,
    'http://made.example.org/p/' || p_partkey AS body_link, p_brand
  FROM part)"""
