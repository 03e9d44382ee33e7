"""Quality gates over elements and sections: long tables of issues, and a roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import present

CHECKS = ("provenance_issues", "text_reconstruction_issues", "section_tree_issues", "table_duplication_issues", "reading_order_issues")
# A word with a capital inside is suspect above this length; so many are reported a document.
LONG_WORD, WORD_ISSUES, LONG_TEXT = 12, 5, 20


def _issues(check: str, df: DataFrame, messages: Column) -> DataFrame:
    return df.select("doc_id", F.lit(check).alias("check"), F.explode(F.array_compact(messages)).alias("message"))


def _named(column: str = "element_id") -> Column:
    """An element's id in a message; one without an id is called None."""
    return F.coalesce(F.col(column), F.lit("None"))


def _of(kind: str, id_col: str, what: str) -> Column:
    return F.concat(F.lit(f"{kind} "), F.col(id_col), F.lit(f" {what}"))


def provenance(elements: DataFrame) -> DataFrame:
    """Elements without an id, or without page, section or parser; null, 0 and empty are missing."""
    named = present("element_id")
    lacking = [(c, w) for c, w in (("page_num", "is missing page_num."), ("section_id", "is missing section_id."), ("source_parser", "is missing source_parser metadata."))]
    messages = F.array(F.when(~named, F.lit("Element found without an element_id.")), *[F.when(named & ~present(c), _of("Element", "element_id", what)) for c, what in lacking])
    return _issues("provenance_issues", elements, messages)


def word_joins(elements: DataFrame, limit: int = WORD_ISSUES) -> DataFrame:
    """Words that look run together, the first `limit` of each document in reading order (seq), repeats kept; addresses and paths are not words."""
    words = elements.select("doc_id", "seq", "element_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"(?U)\s+")).alias("at", "word"))
    suspect = F.col("word").rlike("[a-z]+[A-Z][a-z]+") & (F.char_length("word") > LONG_WORD) & ~F.col("word").rlike(r"http|/|\\")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "at"))
    first = words.filter(suspect).withColumn("place", place).filter(F.col("place") <= limit)
    return _issues("text_reconstruction_issues", first, F.array(F.concat(F.lit("Element "), _named(), F.lit(" contains potential word-join artifact: '"), "word", F.lit("'"))))


def section_tree(sections: DataFrame) -> DataFrame:
    """Sections without id, range or title, or with a range that ends before it starts."""
    named = present("section_id")
    unranged = F.col("start_page").isNull() | F.col("end_page").isNull()
    turned = F.concat(F.lit("Section "), "section_id", F.lit(" has invalid page range ("), F.col("start_page").cast("string"), F.lit(" to "), F.col("end_page").cast("string"), F.lit(")."))
    messages = F.array(
        F.when(~named, F.lit("Section found without a section_id.")),
        F.when(named & unranged, _of("Section", "section_id", "is missing a page range.")),
        F.when(named & ~unranged & (F.col("start_page") > F.col("end_page")), turned),
        F.when(named & (F.coalesce("title", F.lit("")) == ""), _of("Section", "section_id", "is missing a title.")),
    )
    return _issues("section_tree_issues", sections, messages)


def table_duplication(elements: DataFrame) -> DataFrame:
    """Texts of more than 20 characters that a captioned table of the same page holds; an equi-join on document and page with the containment as residual."""
    tables = elements.filter((F.col("type") == "table") & (F.coalesce("text", F.lit("")) != "") & F.col("rows").isNotNull())
    tables = tables.select("doc_id", F.col("page_num").alias("page"), F.col("element_id").alias("table_id"), F.array_join(F.transform("rows", lambda r: F.array_join(r, " ")), " ").alias("content"))
    texts = elements.filter(F.col("type").isin("paragraph", "text") & (F.char_length("text") > LONG_TEXT)).select(F.col("doc_id").alias("d"), "page_num", "element_id", "text")
    met = texts.join(tables, (F.col("d") == F.col("doc_id")) & F.col("page_num").eqNullSafe(F.col("page")) & F.contains("content", "text"))
    return _issues("table_duplication_issues", met, F.array(F.concat(F.lit("Potential table content duplicated in text element "), _named(), F.lit(" near table "), _named("table_id"))))


def reading_order_breaks(elements: DataFrame) -> DataFrame:
    """Elements on an earlier page than some element before them, in the order of seq."""
    page = F.nullif(F.col("page_num"), F.lit(0))
    before = F.max(page).over(Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    found = elements.withColumn("before", before).filter(page < F.col("before"))
    text = F.concat(F.lit("Reading order violation: Element "), _named(), F.lit(" is on page "), F.col("page_num").cast("string"), F.lit(" but previous element was on page "), F.col("before").cast("string"), F.lit("."))
    return _issues("reading_order_issues", found, F.array(text))


def all_issues(elements: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, check, message) of all five gates."""
    return provenance(elements).unionByName(word_joins(elements)).unionByName(section_tree(sections)).unionByName(table_duplication(elements)).unionByName(reading_order_breaks(elements))


def roll_up(issues: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, check, issue_count, passed) for every document and check, those without issues too."""
    spine = documents.select("doc_id").distinct().select("doc_id", F.explode(F.array(*map(F.lit, CHECKS))).alias("check"))
    counted = issues.groupBy("doc_id", "check").agg(F.count(F.lit(1)).alias("issue_count"))
    return spine.join(counted, ["doc_id", "check"], "left").na.fill(0, ["issue_count"]).withColumn("passed", F.col("issue_count") == 0)


def verdict(rolled: DataFrame) -> DataFrame:
    """(doc_id, passed): whether all gates are clean.  Advisory: chunking does not ask for it unless the caller filters by it."""
    return rolled.groupBy("doc_id").agg(F.bool_and("passed").alias("passed"))
