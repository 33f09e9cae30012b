"""Pages -> tables: extracted fields, link edges, chunk rows.

The parse emits one node array per page (one Arrow UDF); every field, and
everything after it, is built-in: link canonicalisation and dedupe, dates, chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import chunk as ch
from quarry.functions import dates as dx
from quarry.functions import html as hx
from quarry.functions import urls as ux
from quarry.session import spread
from quarry.sources.sinks import CHUNK_COLUMNS, write_chunks_csv  # noqa: F401



def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Every page field as a column; a field that is not used later costs nothing.

    Columns: the kept ones, url, title, title_text, description, description_chunk,
    tags, links, all_hrefs, body_hrefs, date_texts, visible_text.
    """
    kept = [c for c in keep if c in pages.columns]
    n = spread(pages).select(*kept, F.col(url_col).alias("url"), hx.nodes(html_col, url_col).alias("_n"))
    raw = n.select(*kept, "url", "_n", hx.title_raw("_n").alias("_title"), hx.description_raw("_n").alias("_parts"),
                   hx.tag_candidates("_n").alias("_tags"), hx.visible_raw("_n").alias("_visible"))
    plain = raw.select(
        *kept, "url", "_n", hx.unescape_text("_title").alias("_title"), hx.unescape("_parts").alias("_parts"),
        F.transform("_tags", lambda g: F.size(g)).alias("_sizes"), hx.unescape(F.flatten("_tags")).alias("_tags"),
        hx.unescape_text("_visible").alias("_visible"))

    def group(k: int) -> F.Column:
        before = sum((F.col("_sizes")[i] for i in range(k)), F.lit(0))
        return F.slice("_tags", before + 1, F.col("_sizes")[k])

    title, desc = F.col("_title"), hx.description("_parts")
    return plain.select(
        *kept, "url", title.alias("title"), hx.title_text("_n").alias("title_text"), desc.alias("description"),
        hx.description_chunk("_n").alias("description_chunk"), hx.select_tags([group(k) for k in range(4)]).alias("tags"),
        hx.links("_n").alias("links"), hx.hrefs("_n").alias("all_hrefs"), hx.hrefs("_n", body_only=True).alias("body_hrefs"),
        hx.date_texts("_n", title, desc).alias("date_texts"), hx.tidy("_visible").alias("visible_text"))


def page_links(fields: DataFrame, strip_chrome: bool = True) -> DataFrame:
    """Distinct canonical links per page (after removing nav/header/footer/aside
    when ``strip_chrome``, as the chunk crawler does)."""
    src = "body_hrefs" if strip_chrome else "all_hrefs"
    return fields.withColumn("page_links", F.array_distinct(F.transform(src, lambda h: ux.canonical(h))))


def link_edges(fields: DataFrame, id_col: str = "page_id") -> DataFrame:
    """E5 as an edge table: (page, pos, url, anchor) in document order, duplicates kept."""
    return fields.select(id_col, "url", F.posexplode_outer("links").alias("pos", "_l")) \
        .where(F.col("_l").isNotNull()) \
        .select(id_col, F.col("url").alias("page_url"), F.col("pos").cast("bigint").alias("pos"),
                F.col("_l.url").alias("link"), F.col("_l.anchor").alias("anchor_text"))


def page_date(fields: DataFrame, current_year: int | None = None) -> DataFrame:
    """F1 -> F2 -> F3: the page's data-collected date (or NULL)."""
    return fields.withColumn("data_collected_date",
                             dx.pick_date(dx.extract_dates_all("date_texts"), current_year))


def page_chunks(fields: DataFrame, depth: F.Column | None = None, *,
                max_chars: int = ch.DEFAULT_MAX_CHARS, overlap: int = ch.DEFAULT_OVERLAP,
                status: F.Column | None = None, content_type: F.Column | None = None,
                final_url: F.Column | None = None) -> DataFrame:
    """L2: chunk rows per html page; a page with no chunk still yields one row
    (index 0, total 0, blank text)."""
    c = fields.withColumn("_c", ch.chunks("visible_text", max_chars, overlap))
    base = c.select(
        F.col("url"), (final_url if final_url is not None else F.col("url")).alias("final_url"),
        (status if status is not None else F.lit(200)).alias("status"),
        (content_type if content_type is not None else F.lit("text/html")).alias("content_type"),
        F.lit("html").alias("source_type"), F.col("title_text").alias("title"),
        F.col("description_chunk").alias("description"),
        F.size("_c").alias("chunk_total"),
        (depth if depth is not None else F.lit(0)).alias("depth"), "_c")
    ex = base.select("*", F.posexplode_outer("_c").alias("_i", "_t"))
    return ex.select("url", "final_url", "status", "content_type", "source_type", "title", "description",
                     F.coalesce("_i", F.lit(0)).alias("chunk_index"), "chunk_total",
                     F.coalesce("_t", F.lit("")).alias("chunk_text"), "depth")


