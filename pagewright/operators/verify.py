"""Verification of what every route produced, fallback to the vision model within a budget, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import distinct_matches, strip
from ..options import Options

# Patterns of words that a parser has run together.
WORD_JOINS = (r"\b[A-Za-z]+Examination\b", r"\b[A-Za-z]+introduced\b", r"\b[A-Z]{2,}OF[A-Z]{2,}\b", r"\b[A-Za-z]+Sabha\b")
STATS = ("text_chars", "text_element_count", "table_count", "picture_count")


def item_pages(prov: Column | str) -> Column:
    """Distinct page numbers of an item's places."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(prov, F.array()), lambda p: p["page_no"]), lambda n: n.isNotNull()))


def page_stats(items: DataFrame, requested: DataFrame) -> DataFrame:
    """Counts for every requested page: items hold (doc_id, kind, text, pages).

    A text counts in full, stripped, on each page it touches; pages that were not asked for are left out, and
    pages without items count zero.
    """
    touched = items.select("doc_id", "kind", F.char_length(strip(F.coalesce("text", F.lit("")))).alias("chars"), F.explode(F.array_distinct("pages")).alias("page_num"))
    of = lambda kind: F.col("kind") == kind
    counted = touched.groupBy("doc_id", "page_num").agg(
        F.sum(F.when(of("text"), F.col("chars")).otherwise(0)).alias("text_chars"),
        F.count_if(of("text")).alias("text_element_count"),
        F.count_if(of("table")).alias("table_count"),
        F.count_if(of("picture")).alias("picture_count"),
    )
    spine = requested.select("doc_id", "page_num").distinct()
    return spine.join(counted, ["doc_id", "page_num"], "left").select("doc_id", "page_num", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in STATS])


def verify_pages(routed: DataFrame, stats: DataFrame, options: Options = Options()) -> DataFrame:
    """A decision for every routed page, with its reasons in the order of the rules.

    Pages routed straight to the vision model are not verified and keep their candidate reasons; a forced page's
    reasons are replaced, unless it is such a page already.
    """
    joined = routed.join(stats, ["doc_id", "page_num"], "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in STATS})
    checks = F.array_compact(
        F.array(
            F.when((F.col("text_element_count") == 0) & (F.col("table_count") == 0), F.lit("no_docling_content")),
            F.when(F.col("vlm_candidate") & (F.col("text_chars") < options.min_visual_text), F.lit("visual_risk_with_sparse_extraction")),
            F.when((F.col("mode") == "ocr") & (F.col("char_count") == 0) & (F.col("text_chars") == 0), F.lit("ocr_produced_no_text")),
        )
    )
    direct = F.col("mode") == "vlm"
    forced = F.col("page_num").isin(list(options.forced_pages)) if options.forced_pages else F.lit(False)
    reasons = F.when(direct, F.col("vlm_candidate_reasons")).when(forced, F.array(F.lit("forced_vlm_page"))).otherwise(checks)
    decided = joined.withColumn("reasons", reasons).withColumn("accepted", ~direct & (F.size("reasons") == 0))
    return decided.select(
        "doc_id",
        "page_num",
        "initial_route",
        F.when(direct, "vlm_direct").otherwise(F.col("initial_route")).alias("final_route"),
        F.when(F.col("accepted"), "accept").otherwise("fallback_to_vlm").alias("decision"),
        "accepted",
        F.when(F.col("accepted"), 0.95).otherwise(0.0).alias("confidence"),
        "reasons",
        F.when(~direct, F.struct(*STATS)).alias("output_stats"),
        F.lit(False).alias("manual_review_required"),
    )


def vlm_only_decisions(pages: DataFrame) -> DataFrame:
    """Every page pending for the vision model, as a run without layout parsing plans it."""
    return pages.select("doc_id", "page_num", F.lit("vlm_direct").alias("initial_route"), F.lit("vlm_direct").alias("final_route"), F.lit("fallback_to_vlm").alias("decision"), F.lit(False).alias("accepted"), F.lit(0.0).alias("confidence"), F.array(F.lit("vlm_only_requested")).alias("reasons"), F.lit(False).alias("manual_review_required"))


def plan_only_decisions(routed: DataFrame) -> DataFrame:
    """Decisions of a run that only plans: nothing has run, no route is final."""
    return routed.select("doc_id", "page_num", "initial_route", F.lit(None).cast("string").alias("final_route"), F.lit("not_run_plan_only").alias("decision"), F.lit(False).alias("accepted"), F.lit(None).cast("double").alias("confidence"), F.array().cast("array<string>").alias("reasons"), F.lit(False).alias("manual_review_required"))


def budget_fallback(decisions: DataFrame, options: Options = Options()) -> DataFrame:
    """Decisions with pending pages beyond the budget, or all without a provider, sent to manual review.

    The first max_vlm_pages pending pages of a document stay pending, whether their calls succeed or not; 0 sets
    no limit.  Without a provider the limit adds no reason.
    """
    pending = F.col("decision") == "fallback_to_vlm"
    place = F.row_number().over(Window.partitionBy("doc_id", "decision").orderBy("page_num"))
    over = pending & (place > options.max_vlm_pages) if options.max_vlm_pages and options.provider != "none" else F.lit(False)
    marked = decisions.withColumn("__over", over).withColumn("__manual", pending if options.provider == "none" else F.col("__over"))
    return marked.withColumns(
        {
            "reasons": F.when(F.col("__over"), F.concat("reasons", F.array(F.lit("max_vlm_pages_exceeded")))).otherwise(F.col("reasons")),
            "decision": F.when(F.col("__manual"), "manual_review").otherwise(F.col("decision")),
            "final_route": F.when(F.col("__manual"), "manual_review").otherwise(F.col("final_route")),
            "manual_review_required": F.col("__manual") | F.col("manual_review_required"),
        }
    ).drop("__over", "__manual")


def apply_extractions(decisions: DataFrame, extractions: DataFrame) -> DataFrame:
    """Outcomes of the pages that were sent: extractions hold (doc_id, page_num, elements, error).

    A page with elements is accepted with their least confidence; an error or an empty reply goes to manual review.
    """
    joined = decisions.join(extractions.select("doc_id", "page_num", "elements", F.col("error").alias("provider_error")), ["doc_id", "page_num"], "left")
    sent = (F.col("decision") == "fallback_to_vlm") & (F.col("elements").isNotNull() | F.col("provider_error").isNotNull())
    good = sent & F.col("provider_error").isNull() & (F.size("elements") > 0)
    marked = joined.withColumn("__good", good).withColumn("__bad", sent & ~F.col("__good"))
    pick = lambda yes, no, other: F.when(F.col("__good"), yes).when(F.col("__bad"), no).otherwise(other)
    return marked.withColumns(
        {
            "provider_error": F.when(F.col("__bad"), F.coalesce("provider_error", F.lit("VLM produced no elements."))),
            "vlm_element_count": F.when(F.col("__good"), F.size("elements")),
            "confidence": pick(F.array_min(F.transform("elements", lambda e: e["confidence"])), F.col("confidence"), F.col("confidence")),
            "accepted": F.col("__good") | F.col("accepted"),
            "decision": pick(F.lit("accept_vlm"), F.lit("manual_review"), F.col("decision")),
            "final_route": pick(F.lit("vlm"), F.lit("manual_review"), F.col("final_route")),
            "manual_review_required": F.col("__bad") | F.col("manual_review_required"),
        }
    ).drop("__good", "__bad", "elements")


def run_report(decisions: DataFrame, page_counts: DataFrame) -> DataFrame:
    """One row a document: final routes, pages for manual review, and whether the run passed; page_counts holds (doc_id, page_count)."""
    routes = [F.count_if(F.col("final_route") == r).alias(f"{r}_pages") for r in ("native", "ocr", "vlm", "manual_review")]
    counted = decisions.groupBy("doc_id").agg(*routes, F.array_sort(F.collect_list(F.when(F.col("manual_review_required"), F.col("page_num")))).alias("review_pages"), F.count(F.lit(1)).alias("decided"), F.count("final_route").alias("routed"))
    passed = (F.size(F.coalesce("review_pages", F.array())) == 0) & (F.coalesce("decided", F.lit(0)) == F.col("page_count")) & (F.coalesce("routed", F.lit(0)) == F.coalesce("decided", F.lit(0)))
    return page_counts.join(counted, "doc_id", "left").withColumn("passed", passed).drop("decided", "routed")


def parse_report(index: DataFrame, layouts: DataFrame, options: Options = Options()) -> DataFrame:
    """One row a document: missing pages, warnings, and whether parsing passed; layouts holds (doc_id, pages, status, markdown)."""
    asked = index.groupBy("doc_id").agg(F.collect_set(F.col("page_num").cast("string")).alias("asked"), F.count_if(F.col("source_type") == "scanned_candidate").alias("scanned"))
    joined = layouts.join(asked, "doc_id", "left").withColumn("missing_pages", F.array_sort(F.transform(F.array_except(F.coalesce("asked", F.array().cast("array<string>")), F.map_keys("pages")), lambda p: p.cast("int"))))
    joined = joined.withColumn("samples", distinct_matches("markdown", WORD_JOINS, 25))
    warnings = F.array_compact(
        F.array(
            F.when((F.col("scanned") > 0) & F.lit(not options.ocr), F.lit("Scanned candidate pages detected, but OCR was disabled.")),
            F.when(F.size("missing_pages") > 0, F.lit("Some requested pages are missing from Docling output.")),
            F.when(F.size("samples") > 0, F.lit("Possible word-join artifacts detected in Markdown output.")),
        )
    )
    joined = joined.withColumn("warnings", warnings)
    return joined.select("doc_id", "missing_pages", F.col("samples").alias("word_join_samples"), "warnings", ((F.col("status") == "SUCCESS") & (F.size("missing_pages") == 0) & (F.size("warnings") == 0)).alias("passed"))


def conversion_report(conversions: DataFrame, plan_only: bool = False) -> DataFrame:
    """One row a document over its converted ranges: (doc_id, passed, seconds, text_element_count, table_count)."""
    warnings = F.array_compact(
        F.array(
            F.when(F.col("failed") > 0, F.lit("One or more hybrid range conversions did not pass Phase 1A checks.")),
            F.when(F.lit(plan_only), F.lit("Plan-only mode did not run Docling conversions.")),
        )
    )
    summed = conversions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("range_count"), F.round(F.sum("seconds"), 2).alias("total_seconds"), F.sum("text_element_count").alias("text_element_count"), F.sum("table_count").alias("table_count"), F.count_if(~F.col("passed")).alias("failed"))
    return summed.withColumn("warnings", warnings).withColumn("passed", F.size("warnings") == 0).drop("failed")


def manifest(summary: DataFrame, decisions: DataFrame) -> DataFrame:
    """One nested record a document, for the sink: its plan and its decisions in page order."""
    rows = decisions.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_num", "initial_route", "final_route", "decision", "accepted", "confidence", "reasons"))).alias("decisions"))
    return summary.join(rows, "doc_id", "left")


def label_counts(texts: DataFrame) -> DataFrame:
    """(doc_id, label, n); a missing label counts as unknown."""
    return texts.groupBy("doc_id", F.coalesce("label", F.lit("unknown")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def word_join_samples(texts: DataFrame, limit: int = 25) -> DataFrame:
    """(doc_id, samples) of (doc_id, markdown)."""
    return texts.select("doc_id", distinct_matches("markdown", WORD_JOINS, limit).alias("samples"))
