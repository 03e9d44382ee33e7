"""Font-size heuristics over text blocks: body size, heading ranks, and what every block is.

Blocks are rows (doc_id, page_num, idx, bbox struct of x0 y0 x1 y1, text, size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import overlap_ratio, strip

# Sizes relative to the body's, and the fewest characters of a heading.
HEADING, NOISE, HEADING_CHARS, SCANNED_CHARS, INSIDE = 1.15, 0.85, 4, 30, 0.5


def body_sizes(blocks: DataFrame) -> DataFrame:
    """(doc_id, body_size): the size with most characters; of a tie the one met first."""
    counted = blocks.groupBy("doc_id", "size").agg(F.sum(F.char_length("text")).alias("chars"), F.min(F.struct("page_num", "idx")).alias("first"))
    best = Window.partitionBy("doc_id").orderBy(F.desc("chars"), "first")
    return counted.withColumn("place", F.row_number().over(best)).filter("place = 1").select("doc_id", F.col("size").alias("body_size"))


def heading_levels(blocks: DataFrame, bodies: DataFrame, clean=strip) -> DataFrame:
    """(doc_id, size, level): distinct heading sizes, the largest first; `clean` cuts a text's ends before its length counts."""
    large = blocks.join(bodies, "doc_id").filter((F.col("size") >= F.col("body_size") * HEADING) & (F.char_length(clean("text")) >= HEADING_CHARS))
    return large.select("doc_id", "size").distinct().withColumn("level", F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.desc("size"))))


def classify_blocks(blocks: DataFrame, tables: DataFrame | None = None, clean=strip, blanks: bool = False) -> DataFrame:
    """(doc_id, page_num, idx, kind, level, text) of blocks not blank and not mostly inside a table of their page (doc_id, page_num, bbox).

    With `blanks` blank blocks are classified by their size like others; `clean` cuts a text's ends.
    """
    if not blanks:
        blocks = blocks.filter(strip("text") != "")
    bodies = body_sizes(blocks)
    kept = blocks
    if tables is not None:
        boxes = tables.select("doc_id", "page_num", F.col("bbox").alias("table_box"))
        here, there = blocks.alias("b"), boxes.alias("t")
        kept = here.join(there, (F.col("b.doc_id") == F.col("t.doc_id")) & (F.col("b.page_num") == F.col("t.page_num")) & (overlap_ratio(F.col("b.bbox"), F.col("t.table_box")) > INSIDE), "left_anti")
    sized = kept.join(bodies, "doc_id").join(heading_levels(blocks, bodies, clean), ["doc_id", "size"], "left")
    heading = (F.col("size") >= F.col("body_size") * HEADING) & (F.char_length(clean("text")) >= HEADING_CHARS)
    kind = F.when(heading, "heading").when(F.col("size") <= F.col("body_size") * NOISE, "noise").otherwise("body")
    return sized.select("doc_id", "page_num", "idx", kind.alias("kind"), F.when(heading, F.coalesce("level", F.lit(1))).alias("level"), clean("text").alias("text"))


def page_texts(classified: DataFrame, pages: DataFrame) -> DataFrame:
    """One row a page of pages (doc_id, page_num, char_count, has_image): source_type, body text, headings and margin noise in order; a scanned page holds nothing."""
    ordered = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("idx", "text", "level")))), lambda b: F.struct(b["text"].alias("text"), b["level"].alias("level")))
    grouped = classified.groupBy("doc_id", "page_num").agg(ordered("body").alias("body"), ordered("heading").alias("headings"), ordered("noise").alias("noise"))
    scanned = (F.col("char_count") < SCANNED_CHARS) & F.col("has_image")
    texts = lambda c: F.coalesce(F.transform(c, lambda b: b["text"]), F.array().cast("array<string>"))
    blank = F.array().cast("array<string>")
    joined = pages.join(grouped, ["doc_id", "page_num"], "left")
    return joined.select("doc_id", "page_num", F.when(scanned, "scanned").otherwise("native").alias("source_type"), "char_count", "has_image", F.when(scanned, "").otherwise(F.array_join(texts("body"), "\n")).alias("body_text"), F.when(~scanned, F.col("headings")).alias("headings"), F.when(scanned, blank).otherwise(texts("noise")).alias("margin_noise"))


def document_summary(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """One row a document: pages by source type, and its tables (doc_id, page_num)."""
    counted = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_pages"), F.count_if(F.col("source_type") == "native").alias("native_page_count"), F.count_if(F.col("source_type") == "scanned").alias("scanned_page_count"), F.array_sort(F.collect_list(F.when(F.col("source_type") == "scanned", F.col("page_num")))).alias("scanned_pages"))
    native = pages.filter("source_type = 'native'").select("doc_id", "page_num")
    held = tables.join(native, ["doc_id", "page_num"], "left_semi").groupBy("doc_id").agg(F.countDistinct("page_num").alias("table_page_count"), F.count(F.lit(1)).alias("total_table_count"))
    return counted.join(held, "doc_id", "left").na.fill(0, ["table_page_count", "total_table_count"])
