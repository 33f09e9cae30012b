"""Breadth-first crawls over a page snapshot.

The driver runs one Spark job per BFS level and reads back only counts.
Before the loop, everything that depends on a single url is computed once:
scope and robots (G3-G5), the "fetch" against the snapshot and its html test
(J8, G6), the data-file test and probe join (D6, J9); the snapshot and edge
tables are written in hash-bucket folders of the url.  A level then joins the
frontier with those tables (reading only the frontier's buckets when it is
small), drops everything already enqueued (J3), keeps the first occurrence of
each link by (parent key, position) and writes the next frontier.  FIFO order
of the reference's queue equals order by (depth, parent key, position), kept
as fixed-width string keys, so the page and file caps (W7) are exact.  Each
level is written to the cluster's shared checkpoint folder and read back, which
cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import dates as dx
from quarry.functions import urls as ux
from quarry.session import bucket, materialize, scratch_path
from quarry.sources.sinks import FILE_HIT_COLUMNS, write_file_hits  # noqa: F401

# User agents matched against robots groups (agent-specific groups apply by name).
FILES_USER_AGENT = "quarry-files/1.0"
CHUNKS_USER_AGENT = "quarry-chunks/1.0"



# ------------------------------------------------------------------ seeds

SMALL_LEVEL = 100_000  # rows that one task sorts


def numbered(level: DataFrame, *order: str, small: bool = False) -> DataFrame:
    """``level`` with ``seq``: a number whose order is that of ``order``, 8 bytes at any depth.

    The rows are range-partitioned and sorted; (partition, row in it) is the number,
    so no task sees the whole level unless its size was checked (``small``).  Only
    numbers of one level are compared."""
    ranged = level.coalesce(1) if small else level.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())


def seeds_frame(spark: SparkSession, seeds: str | Iterable[str], normalise: str = "defrag") -> DataFrame:
    """M4: list or comma-separated text -> trimmed, normalised, distinct, in order (url, seq)."""
    items = seeds.split(",") if isinstance(seeds, str) else list(seeds)
    rows = [(s.strip(), i) for i, s in enumerate(items) if s and s.strip()]
    df = spark.createDataFrame(rows, "raw string, i long")
    norm = ux.defrag("raw") if normalise == "defrag" else ux.canonical("raw")
    first = df.select(norm.alias("url"), "i").groupBy("url").agg(F.min("i").alias("i"))
    return first.select("url", F.col("i").alias("seq"))


def seeds_table(texts: DataFrame, text_col: str, order_col: str, normalise: str = "defrag") -> DataFrame:
    """M4 over a column of comma-separated texts: as ``seeds_frame``, by (``order_col``, place in the text)."""
    norm = ux.defrag("raw") if normalise == "defrag" else ux.canonical("raw")
    items = texts.select(F.col(order_col).alias("_t"), F.posexplode(F.split(text_col, ",")).alias("_p", "raw")) \
        .withColumn("raw", F.trim("raw")).where("raw <> ''")
    first = items.select(norm.alias("url"), "_t", "_p").groupBy("url").agg(F.min(F.struct("_t", "_p")).alias("_o"))
    return numbered(first.select("url", "_o._t", "_o._p"), "_t", "_p").select("url", "seq")


# ----------------------------------------------------------------- robots

RULES = "array<struct<pattern:string,allow:boolean>>"


def _rules(status, body, agent: str, on_missing: str) -> list[tuple[str, bool]]:
    """Ordered (path prefix, allowed) rules of one robots file for ``agent``; the
    first that a path starts with decides, none: allowed."""
    everything = [("", False)]
    if status is None or pd.isna(status):
        return [] if on_missing == "allow" else everything
    status = int(status)
    if status in (401, 403):
        return everything
    if 400 <= status < 500:
        return []
    if not 200 <= status < 300:
        return [] if on_missing == "allow" else everything
    parser = RobotFileParser()
    parser.parse((body or "").splitlines())
    entry = next((e for e in parser.entries if e.applies_to(agent)), parser.default_entry)
    return [] if entry is None else [("" if r.path == "*" else r.path, r.allowance) for r in entry.rulelines]


def robots_allowed(urls: DataFrame, robots: DataFrame | None, url_col: str, agent: str, *,
                   origin: str = "scheme_host", on_missing: str = "block") -> DataFrame:
    """``urls`` with a boolean ``robots_ok``.

    ``robots`` has ``origin, status, body`` (one row per origin; no row = the
    file could not be read).  Origin is ``scheme://host`` or just ``host``.
    ``on_missing='block'`` is what an unread parser does; ``'allow'`` is the
    documented intent.  A file is parsed once per origin into rules; urls only
    meet their origin's few rules, matched as Spark expressions.
    """
    if robots is None:
        return urls.withColumn("robots_ok", F.lit(True))
    key = F.concat(ux.scheme(url_col), F.lit("://"), ux.netloc(url_col)) if origin == "scheme_host" \
        else ux.netloc(url_col)

    @F.pandas_udf(RULES)
    def rules(status: pd.Series, body: pd.Series) -> pd.Series:
        return pd.Series([[{"pattern": p, "allow": a} for p, a in _rules(s, b, agent, on_missing)]
                          for s, b in zip(status, body)], dtype=object)

    parsed = robots.select(F.col("origin").alias("_origin"), rules("status", "body").alias("_rules"))
    missing = F.array() if on_missing == "allow" else F.array(F.struct(F.lit("").alias("pattern"), F.lit(False).alias("allow")))
    path = robots_path(url_col)
    decided = F.filter("_rules", lambda r: path.startswith(r["pattern"]))
    return urls.withColumn("_origin", key).join(parsed, "_origin", "left") \
        .withColumn("_rules", F.coalesce("_rules", missing.cast(RULES))) \
        .withColumn("robots_ok", F.coalesce(F.try_element_at(decided, F.lit(1))["allow"], F.lit(True))) \
        .drop("_origin", "_rules")


def robots_path(url) -> F.Column:
    """What follows a url's host as robots rules see it: unquoted, then quoted again
    but for '/' ('/' if there is nothing)."""
    rest = F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?(.*)", 1)
    plain = ux.unquote(F.regexp_replace(rest, r"\+", "%2B"))
    quoted = F.regexp_replace(F.regexp_replace(F.url_encode(plain), r"\+", "%20"), r"\*", "%2A")
    quoted = F.replace(F.replace(quoted, F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~"))
    return F.when(quoted == "", F.lit("/")).otherwise(quoted)


# ----------------------------------------------------------------- helpers

def _buckets(df: DataFrame) -> int:
    """About one bucket per input split (one folder per ~128 MB of edges)."""
    return max(8, df.rdd.getNumPartitions())


def materialize_all(specs: list[tuple]) -> list[DataFrame]:
    """``materialize`` several independent frames as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        return list(pool.map(lambda sp: materialize(*sp), specs))


def _present_buckets(keyed: DataFrame, n_rows: int, buckets: int) -> list[int] | None:
    """Bucket ids a small frontier touches (at most ``buckets`` ints), or None
    when the frontier is large enough to touch most buckets anyway."""
    if n_rows * 2 >= buckets:
        return None
    return [r[0] for r in keyed.select("_b").distinct().collect()]


def _prune(table: DataFrame, present: list[int] | None) -> DataFrame:
    """Static partition filter on a bucketed table (reads only those folders)."""
    return table if present is None else table.where(F.col("_b").isin(present))


class Frontier:
    """The levels of a breadth-first walk, each a written table (url, depth, seq).

    A level is laid out in the hash buckets of its urls under one folder, so
    ``seen`` reads one scan whatever the depth, and of it only the buckets that
    the candidates of a small level fall into.
    """

    def __init__(self, first: DataFrame, schema: str, buckets: int) -> None:
        self.spark, self.schema, self.buckets = first.sparkSession, schema, buckets
        self.root, self.depth = scratch_path(self.spark), 0
        self.levels: list[DataFrame] = []
        self.advance(first)

    def advance(self, level: DataFrame, *order: str) -> None:
        """Write the next level; ``order``: columns that give its queue order (``seq``, if it has none)."""
        sizes: list[int] = []
        frame = materialize(level, "url", self.buckets, counter=sizes, path=f"{self.root}/level={self.depth}")
        self.size, self.depth = sizes[-1], self.depth + 1
        if order and self.size <= SMALL_LEVEL:
            frame = numbered(frame, *order, small=True).drop(*order[:-1])
        elif order:
            frame = materialize(numbered(frame.drop("_b"), *order).drop(*order[:-1]), "url", self.buckets)
        self.frame = frame

    def unseen(self, links: DataFrame) -> DataFrame:
        """``links`` (with ``dst``) to urls that no level holds."""
        links = links.withColumn("_b", bucket("dst", self.buckets))
        present = None
        if self.size * 2 < self.buckets:  # few pages: their links' buckets are worth a look
            present = sorted(r[0] for r in links.select("_b").distinct().collect())
        seen = self.spark.read.schema("url string, level int, _b int").parquet(self.root)
        return links.join(_prune(seen, present).select("_b", F.col("url").alias("dst")), ["_b", "dst"], "left_anti")

    def found(self) -> DataFrame:
        """Every visited page (the kept part of each level)."""
        out = self.spark.createDataFrame([], self.schema)
        for level in self.levels:
            out = out.unionByName(level)
        return out


class Quota:
    """An optional page cap in queue order.

    Frontier sizes bound the pages from above, so pages are only counted once the
    cap can bind.
    """

    def __init__(self, limit: int | None) -> None:
        self.limit, self.used, self.exact = limit, 0, False

    def take(self, pages: DataFrame, at_most: int, count_before) -> int | None:
        """Order key of the last page allowed in this level, or None if all are."""
        if self.limit is None:
            return None
        if not self.exact and self.used + at_most >= self.limit:
            self.used, self.exact = count_before(), True
        if not self.exact:
            self.used += at_most
            return None
        n = pages.count()
        last = _cap_seq(pages, n, self.limit - self.used)
        self.used += n if last is None else self.limit - self.used
        return last

    def spent(self) -> bool:
        return self.limit is not None and self.exact and self.used >= self.limit


def _cap_seq(df: DataFrame, n_rows: int, remaining: int) -> int | None:
    """Key of the ``remaining``-th row in key order (distributed top-N), or None
    when the level has no more rows than that."""
    if n_rows <= remaining:
        return None
    return df.select("seq").orderBy("seq").limit(remaining).agg(F.max("seq")).first()[0]


# -------------------------------------------------------- M1 + M2: files

def crawl_files(seeds: DataFrame, docs: DataFrame, edges: DataFrame, fetches: DataFrame,
                robots: DataFrame | None = None, *, scope_suffix: str | tuple[str, ...] = "gov.au",
                same_domain_only: bool = False, allow_zip: bool = False,
                max_pages: int | None = None, max_files: int | None = None, user_agent: str = FILES_USER_AGENT,
                on_missing_robots: str = "block", current_year: int | None = None,
                discovered_at: F.Column | None = None) -> tuple[DataFrame, DataFrame]:
    """M1/M2: breadth-first crawl collecting data-file hits.

    ``seeds``: ``url, seq``.  ``docs``: snapshot keyed by ``url`` with
    ``content_type, title, description, tags, date_texts``.  ``edges``:
    ``src, pos, dst, anchor`` in document order (E5).  ``fetches``:
    ``link, content_type, content_length`` (J9; a missing row = failed probe).
    Returns (pages processed with depth and seq, file hits).

    ``max_pages`` and ``max_files`` are optional caps in queue order; None (the
    default) walks everything reachable.  Everything that depends on one url only
    (scope, robots, html type, data-file test, the probe join) is computed once
    over the snapshot before the loop; a level is then three joins on small frames.
    """
    spark = seeds.sparkSession
    seed_hosts = seeds.select(ux.netloc("url").alias("h")).distinct()

    def scope(df: DataFrame, col: str) -> DataFrame:
        out = df.where(ux.in_domain(col, scope_suffix))
        if same_domain_only:
            out = out.join(seed_hosts, ux.netloc(col) == F.col("h"), "left_semi")
        return out

    # Pages a dequeued url can turn into: in scope, robots allow, fetched, html.
    ok_docs = robots_allowed(scope(docs, "url"), robots, "url", user_agent, on_missing=on_missing_robots) \
        .where(F.col("robots_ok") & ux.content_type_is_html("content_type")) \
        .select("url", "title", "description", "tags",
                dx.pick_date(dx.extract_dates_all("date_texts"), current_year).alias("data_collected_date"))
    nb = _buckets(edges)
    # Data-file hits a page can yield (D6, G5, J9), and the links it can enqueue.
    data = edges.where(ux.looks_like_data_file("dst", allow_zip))
    data = robots_allowed(data, robots, "dst", user_agent, on_missing=on_missing_robots).where("robots_ok")
    data = data.join(fetches.select(F.col("link").alias("dst"), F.col("content_type").alias("f_ct"),
                                    "content_length"), "dst") \
        .withColumn("file_ext", F.coalesce(ux.guess_ext("dst"), ux.mime_ext("f_ct"))) \
        .where(F.col("file_ext").isNotNull()) \
        .select("src", "pos", "dst", "anchor", "file_ext", "f_ct", "content_length")
    follow = scope(edges.where(~ux.looks_like_data_file("dst", allow_zip)), "dst").select("src", "pos", "dst")
    # The three tables are independent: written as concurrent jobs.
    ok_docs, data, follow = materialize_all([(ok_docs, "url", nb), (data, "src", nb), (follow, "src", nb)])
    ok_keys = ok_docs.select("_b", "url")

    # One write per level (the next frontier), counted by the write.  A small
    # frontier's bucket ids prune the bucketed snapshot and edge tables.
    walk = Frontier(seeds.select("url", F.lit(0).alias("depth"), "seq"), "url string, depth int, seq long", nb)
    quota = Quota(max_pages)
    while walk.size > 0:
        keyed = walk.frame
        present = _present_buckets(keyed, walk.size, nb)
        pages = keyed.join(_prune(ok_keys, present), ["_b", "url"])
        last = quota.take(pages, walk.size, lambda: walk.found().count())
        if last is not None:
            pages = pages.where(F.col("seq") <= last)
        walk.levels.append(pages.select("url", "depth", "seq"))
        if quota.spent():
            break
        # Followable links never enqueued before, first by (page seq, pos).
        src = pages.select("_b", F.col("url").alias("src"), F.col("seq").alias("page_seq"), "depth")
        nxt = walk.unseen(_prune(follow, present).join(src, ["_b", "src"]).drop("_b"))
        first = nxt.groupBy("dst").agg(F.min(F.struct("page_seq", "pos", "depth")).alias("_o")) \
            .select(F.col("dst").alias("url"), (F.col("_o.depth") + 1).alias("depth"), "_o.page_seq", "_o.pos")
        walk.advance(first, "page_seq", "pos", "url")

    order = walk.found()
    # File hits of all crawled pages in FIFO order; the file cap (checked before each
    # page and after each hit) keeps the first ``max_files`` and drops later pages.
    hits_all = data.drop("_b").join(order.select(F.col("url").alias("src"), F.col("depth").alias("page_depth"),
                                      F.col("seq").alias("page_seq")), "src")
    if max_files is not None and hits_all.count() >= max_files:
        hits_all = materialize(hits_all.orderBy("page_depth", "page_seq", "pos").limit(max_files))
        last = hits_all.orderBy(F.col("page_depth").desc(), F.col("page_seq").desc()).first()
        order = order.where((F.col("depth") < last["page_depth"]) |
                            ((F.col("depth") == last["page_depth"]) & (F.col("seq") <= last["page_seq"])))
    docs_out = ok_docs.drop("_b")
    pages_all = order.join(docs_out, "url")
    hits_all = hits_all.join(docs_out.select(F.col("url").alias("src"), F.col("url").alias("page_url"), "title",
                                            "description", "tags", "data_collected_date"), "src")
    now = discovered_at if discovered_at is not None else dx.iso_now()
    file_hits = hits_all.select(
        F.col("dst").alias("file_url"), "file_ext", "page_url", F.coalesce("title", F.lit("")).alias("page_title"),
        F.coalesce("description", F.lit("")).alias("page_description"), F.col("tags").alias("page_tags"),
        F.coalesce("anchor", F.lit("")).alias("anchor_text"), ux.mime_base("f_ct").alias("content_type"),
        ux.parse_length("content_length").alias("content_length"), now.alias("discovered_at"),
        "data_collected_date", "page_depth", "page_seq", "pos")
    return pages_all.select("url", "depth", "seq", "title", "description", "tags", "data_collected_date"), file_hits


# ------------------------------------------------------ M3: chunk crawl

def crawl_chunks(seeds: DataFrame, docs: DataFrame, links: DataFrame, robots: DataFrame | None = None, *,
                 allowed_domains=None, max_pages: int | None = None, max_depth: int | None = None,
                 user_agent: str = CHUNKS_USER_AGENT, on_missing_robots: str = "block",
                 chunk_size: int = 1400, chunk_overlap: int = 200) -> tuple[DataFrame, DataFrame]:
    """M3: depth-limited BFS with a host allow-list; returns (visited urls, K3 rows).

    ``seeds``: canonical ``url, seq``.  ``docs``: snapshot keyed by ``url`` with
    ``status, content_type, final_url`` and the extracted fields.  ``links``:
    ``src, dst`` canonical body links (E6); a page's links are followed in
    sorted order (the reference iterates an unordered set).  ``max_pages`` and
    ``max_depth`` are optional limits (None: everything reachable).  Binary links are
    recorded without a fetch; non-html responses get a row; html pages are
    counted against ``max_pages`` in FIFO order and chunked (L2).
    ``allowed_domains``: None (the seeds' hosts), a list, or a DataFrame ``host``.
    """
    from quarry.operators.pages import CHUNK_COLUMNS, page_chunks

    spark = seeds.sparkSession
    if allowed_domains is None:
        allowed = seeds.select(F.lower(ux.netloc("url")).alias("host")).distinct()
    elif isinstance(allowed_domains, DataFrame):
        allowed = allowed_domains.select(F.lower(F.trim(F.col("host"))).alias("host")).distinct()
    else:
        allowed = spark.createDataFrame([(d.strip().lower(),) for d in allowed_domains if d.strip()], "host string")
    allowed = materialize(allowed)

    def admissible(df: DataFrame, col: str) -> DataFrame:
        """Host allow-list (G4) and robots (G5), both decided per url."""
        scoped = df.join(allowed, F.lower(ux.netloc(col)) == F.col("host"), "left_semi")
        return robots_allowed(scoped, robots, col, user_agent, origin="host",
                              on_missing=on_missing_robots).where("robots_ok").drop("robots_ok")

    kind = ux.response_class("url", "status", "content_type")
    nb = _buckets(links)
    classified = materialize(docs.withColumn("source_type", kind).where(F.col("source_type").isNotNull()), "url", nb)
    follow = materialize(admissible(links.select("src", "dst"), "dst"), "src", nb)
    kinds = classified.select("_b", "url", F.col("source_type").alias("kind"))

    walk = Frontier(admissible(seeds.select("url", F.lit(0).alias("depth"), "seq"), "url"),
                    "url string, depth int, seq long, kind string", nb)
    quota = Quota(max_pages)
    while walk.size > 0:
        keyed = walk.frame
        present = _present_buckets(keyed, walk.size, nb)
        flagged = keyed.join(_prune(kinds, present), ["_b", "url"], "left") \
            .withColumn("kind", F.when(ux.is_binary_link("url"), F.lit("binary")).otherwise(F.col("kind")))
        html = flagged.where(F.col("kind") == "html")
        last = quota.take(html, walk.size, lambda: walk.found().where(F.col("kind") == "html").count())
        level = flagged if last is None else flagged.where(F.col("seq") <= last)
        walk.levels.append(level.drop("_b"))
        if quota.spent():
            break
        pages = level.where(F.col("kind") == "html")
        if max_depth is not None:
            pages = pages.where(F.col("depth") < max_depth)
        src = pages.select("_b", F.col("url").alias("src"), F.col("seq").alias("page_seq"), "depth")
        nxt = walk.unseen(_prune(follow, present).join(src, ["_b", "src"]).drop("_b"))
        # A page's links are followed in sorted order.
        first = nxt.groupBy("dst").agg(F.min(F.struct("page_seq", "depth")).alias("_o")) \
            .select(F.col("dst").alias("url"), (F.col("_o.depth") + 1).alias("depth"), "_o.page_seq")
        walk.advance(first, "page_seq", "url")
    visited = walk.found()
    classified = classified.drop("_b")
    html_pages = visited.where(F.col("kind") == "html").select("url", "depth", "seq").join(classified, "url")
    chunks = page_chunks(html_pages, depth=F.col("depth"), max_chars=chunk_size, overlap=chunk_overlap,
                         status=F.col("status"), content_type=F.col("content_type"), final_url=F.col("final_url"))
    blanks = [F.lit(None).cast(t).alias(c) for c, t in (("title", "string"), ("description", "string"),
                                                      ("chunk_index", "int"), ("chunk_total", "int"),
                                                      ("chunk_text", "string"))]
    other = visited.where(F.col("kind") == "non-html").select("url", "depth").join(classified, "url") \
        .select("url", "final_url", "status", "content_type", "source_type", *blanks, "depth")
    binary = visited.where(F.col("kind") == "binary").select(
        "url", F.col("url").alias("final_url"), F.lit(200).alias("status"), F.lit("binary").alias("content_type"),
        F.lit("binary").alias("source_type"), *blanks, "depth")
    rows = chunks.select(*CHUNK_COLUMNS).unionByName(other.select(*CHUNK_COLUMNS)) \
        .unionByName(binary.select(*CHUNK_COLUMNS))
    return visited.select("url", "depth", "seq"), rows


def crawl_counts(pages: DataFrame, hits: DataFrame) -> DataFrame:
    """Pages done and file hits found per depth of a file crawl."""
    found = hits.groupBy(F.col("page_depth").alias("depth")).agg(F.count("*").alias("files"))
    return pages.groupBy("depth").agg(F.count("*").alias("pages")).join(found, "depth", "left") \
        .withColumn("files", F.coalesce("files", F.lit(0)))


def crawl_summary(rows: DataFrame) -> DataFrame:
    """Pages and chunks per depth (true counts)."""
    return rows.groupBy("depth").agg(F.countDistinct("url").alias("pages"), F.count("*").alias("rows"))
