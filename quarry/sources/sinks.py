"""K2 / K3: crawl outputs (file hits as CSV + JSON lines; chunk rows as CSV)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize

FILE_HIT_COLUMNS = ("file_url", "file_ext", "page_url", "page_title", "page_description", "page_tags",
                    "anchor_text", "content_type", "content_length", "discovered_at", "data_collected_date")
CHUNK_COLUMNS = ("url", "final_url", "status", "content_type", "source_type", "title",
                 "description", "chunk_index", "chunk_total", "chunk_text", "depth")


#: Quoting as CSV readers expect it; values keep their outer blanks.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_file_hits(hits: DataFrame, prefix: str) -> None:
    """K2: the same hits as CSV (tags joined by '; ', NULL -> blank) and JSON lines.

    The hits are computed once, into a table in the checkpoint folder that both
    writes read: nothing is held in executor memory."""
    hits = materialize(hits.select(*FILE_HIT_COLUMNS))
    hits.select(*[F.array_join(c, "; ").alias(c) if c == "page_tags" else F.col(c)
                  for c in FILE_HIT_COLUMNS]) \
        .write.mode("overwrite").options(**CSV_OPTIONS).option("nullValue", "").csv(prefix + "_csv")
    hits.write.mode("overwrite").option("ignoreNullFields", "false").json(prefix + "_jsonl")


def write_chunks_csv(chunks: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """K3: chunk CSV with the fixed column order; NULLs render blank.

    Every chunk row repeats its page's title and description, so the plain text grows with
    the square of a page's length; ``compression`` ("gzip", "lz4", ...) stores the repeats once."""
    chunks.select(*CHUNK_COLUMNS).write.mode(mode).options(**CSV_OPTIONS) \
        .option("nullValue", "").option("compression", compression).csv(path)
