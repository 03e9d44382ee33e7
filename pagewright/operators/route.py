"""Page preflight and routing: which parser every page goes to, and why.

Signals are rows (doc_id, page_num, char_count, image_count, image_coverage, drawing_count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..options import Options


def requested_pages(pages: DataFrame, start: int = 1, end: int | None = None) -> DataFrame:
    """Pages from start to end; the end is clamped to what is there, a start beyond it selects nothing.  ValueError for an impossible range."""
    Options().check(start, end)
    kept = pages.filter(F.col("page_num") >= start)
    return kept if end is None else kept.filter(F.col("page_num") <= end)


def is_scanned(chars: Column | str, images: Column | str, options: Options = Options()) -> Column:
    """A photographed page: almost no text (white space counts) and an image."""
    chars, images = (F.col(c) if isinstance(c, str) else c for c in (chars, images))
    return (chars < options.scanned_text) & (images > 0)


def image_coverage(boxes: Column, width: Column, height: Column) -> Column:
    """Share of the page under images, boxes clipped to the page, overlaps counted twice, at most 1, four digits."""
    side = lambda low, high, limit: F.greatest(F.lit(0.0), F.least(high, limit) - F.greatest(low, F.lit(0.0)))
    area = F.aggregate(boxes, F.lit(0.0), lambda total, b: total + side(b["x0"], b["x1"], width) * side(b["y0"], b["y1"], height))
    return F.bround(F.least(F.lit(1.0), area / F.greatest(F.lit(1.0), width * height)), 4)


def route_hybrid(signals: DataFrame, options: Options = Options()) -> DataFrame:
    """Adds has_image, mode (ocr or native) and reason; the first rule that holds decides."""
    image = F.col("image_count") > 0
    covered = F.when(image, F.col("image_coverage")).otherwise(0.0)
    rules = [
        ("no_native_text_with_image", (F.col("char_count") == 0) & image),
        ("low_text_with_image", (F.col("char_count") < options.low_text) & image & (covered >= options.low_image_coverage)),
        ("image_dominant_low_text", (F.col("char_count") < options.mixed_text) & image & (covered >= options.image_coverage)),
    ]
    reason = F.coalesce(*[F.when(test, F.lit(name)) for name, test in rules], F.lit("native_text_available"))
    routed = signals.withColumns({"has_image": image, "image_coverage": covered, "reason": reason})
    return routed.withColumn("mode", F.when(F.col("reason") == "native_text_available", "native").otherwise("ocr"))


def route_vlm(signals: DataFrame, options: Options = Options()) -> DataFrame:
    """Adds to the two-way route the vision route, its candidates and their reasons, in the order of the rules."""
    chars, drawings = F.col("char_count"), F.col("drawing_count")
    direct = (chars == 0) & ~F.col("has_image") & (drawings >= options.direct_vlm_drawings)
    found = F.array_compact(
        F.array(
            F.when(direct, F.lit("vector_only_no_native_text")),
            F.when(F.col("image_coverage") >= options.vlm_image_coverage, F.lit("high_image_coverage")),
            F.when((drawings >= options.candidate_drawings) & (chars < options.mixed_text), F.lit("drawing_dominant_low_text")),
        )
    )
    routed = route_hybrid(signals, options).withColumns({"mode": F.when(direct, "vlm").otherwise(F.col("mode")), "reason": F.when(direct, "vector_only_no_native_text").otherwise(F.col("reason")), "vlm_candidate_reasons": found})
    return routed.withColumns({"initial_route": F.col("mode"), "vlm_candidate": F.size("vlm_candidate_reasons") > 0})


def plan_summary(routed: DataFrame) -> DataFrame:
    """One row a document: pages by mode, candidates, and the ordered pages of each mode."""
    pages = lambda mode: F.array_sort(F.collect_list(F.when(F.col("mode") == mode, F.col("page_num"))))
    count = lambda mode: F.count_if(F.col("mode") == mode)
    return routed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("page_count"),
        count("native").alias("native_page_count"),
        count("ocr").alias("ocr_page_count"),
        count("vlm").alias("direct_vlm_page_count"),
        F.count_if("vlm_candidate").alias("vlm_candidate_page_count"),
        pages("native").alias("native_pages"),
        pages("ocr").alias("ocr_pages"),
        pages("vlm").alias("vlm_pages"),
    )


def page_ranges(routed: DataFrame) -> DataFrame:
    """Maximal runs of consecutive pages of one mode: (doc_id, mode, start_page, end_page, page_count).  A missing page ends a run."""
    island = F.col("page_num") - F.row_number().over(Window.partitionBy("doc_id", "mode").orderBy("page_num"))
    return routed.withColumn("island", island).groupBy("doc_id", "mode", "island").agg(F.min("page_num").alias("start_page"), F.max("page_num").alias("end_page"), F.count(F.lit(1)).alias("page_count")).drop("island")


def work_items(routed: DataFrame, options: Options = Options()) -> DataFrame:
    """What a layout parser is to convert: single pages of short documents, runs of pages of long ones; vision pages never."""
    parsed = F.col("mode").isin("native", "ocr")
    pages = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    wanted = F.when(pages <= options.page_progress_limit, F.lit("page")).otherwise("range") if options.progress_mode == "auto" else F.lit(options.progress_mode)
    grained = routed.withColumn("grain", wanted)
    single = grained.filter(parsed & (F.col("grain") == "page")).select("doc_id", "mode", F.col("page_num").alias("start_page"), F.col("page_num").alias("end_page"), F.lit(1).cast("long").alias("page_count"))
    return single.unionByName(page_ranges(grained.filter(F.col("grain") == "range")).filter(parsed))


def page_index(signals: DataFrame, layouts: DataFrame, options: Options = Options()) -> DataFrame:
    """(doc_id, page_num, source_type, char_count, has_image, docling_page_present); layouts holds (doc_id, pages map) and char_count is not stripped here."""
    kind = F.when(is_scanned("char_count", "image_count", options), "scanned_candidate").otherwise("native_candidate")
    present = F.coalesce(F.map_contains_key("pages", F.col("page_num").cast("string")), F.lit(False))
    return signals.join(layouts.select("doc_id", "pages"), "doc_id", "left").select("doc_id", "page_num", kind.alias("source_type"), "char_count", (F.col("image_count") > 0).alias("has_image"), present.alias("docling_page_present"))


def index_summary(index: DataFrame) -> DataFrame:
    """One row a document: pages, scanned candidates, and their page numbers in order."""
    scanned = F.col("source_type") == "scanned_candidate"
    return index.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total_pages"), F.count_if(scanned).alias("scanned_candidate_count"), F.array_sort(F.collect_list(F.when(scanned, F.col("page_num")))).alias("scanned_candidate_pages"))
