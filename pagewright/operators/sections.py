"""The section tree of a document, from its outline or its headings, and the section of every element.

Everything is keyed by doc_id.  Documents are rows (doc_id, title, page_count); an outline is rows
(doc_id, ord, outline_level, title, page), headings rows (doc_id, ord, level, title, page).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import APPENDIX, CHAPTER, PART, roman_to_int, slugify, strip

SECTION = ["doc_id", "section_id", "title", "level", "parent_id", "parent_title", "start_page", "end_page", "source", "confidence", "outline_level", "order", "kind"]


def with_kind(outline: DataFrame) -> DataFrame:
    """Adds kind and inferred_level by title; an entry that fits no pattern is a section once a part has come before, else front matter."""
    part = F.col("title").rlike(PART)
    seen = F.coalesce(F.max(part).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    kind = (
        F.when(part, "part")
        .when(F.lower(strip("title")) == "appendices", "appendices")
        .when(F.col("title").rlike(APPENDIX), "appendix")
        .when(F.col("title").rlike(CHAPTER), "chapter")
        .when(seen, "section")
        .otherwise("front_matter")
    )
    kinded = outline.withColumn("title", strip("title")).withColumn("kind", kind)
    return kinded.withColumn("inferred_level", F.when(F.col("kind").isin("part", "appendices", "front_matter"), 1).otherwise(2))


def section_id() -> Column:
    """The id of a section from its kind, title and running number within the kind."""
    nth = F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("ord"))
    numeral = roman_to_int(F.regexp_extract("title", PART, 1))
    other = F.format_string("%s_%03d_%s", F.col("kind"), nth, slugify("title"))
    chapter = F.format_string("ch_%03d_%s", F.regexp_extract("title", CHAPTER, 1).cast("int"), slugify(F.regexp_extract("title", CHAPTER, 2)))
    appendix = F.format_string("app_%02d_%s", roman_to_int(F.regexp_extract("title", APPENDIX, 1)), slugify(F.regexp_extract("title", APPENDIX, 2)))
    return F.when(F.col("kind") == "part", F.format_string("part_%02d_%s", numeral, slugify("title"))).when(F.col("kind") == "chapter", chapter).when(F.col("kind") == "appendix", appendix).when(F.col("kind") == "appendices", F.lit("appendices")).otherwise(other)


def _roots(documents: DataFrame) -> DataFrame:
    null = F.lit(None).cast("string")
    return documents.select("doc_id", F.lit("document").alias("section_id"), "title", F.lit(0).alias("level"), null.alias("parent_id"), null.alias("parent_title"), F.lit(1).alias("start_page"), F.col("page_count").alias("end_page"), F.lit("synthetic_root").alias("source"), F.lit(1.0).alias("confidence"), F.lit(0).alias("outline_level"), F.lit(0).alias("order"), F.lit("document").alias("kind"))


def _clamped(page: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.coalesce(page, F.lit(1)), F.col("page_count")))


def _end_pages(sections: DataFrame, levels: int) -> DataFrame:
    """Sets end_page: before the first later section of the same or a lesser level, not before the start, else the last page.

    One window, with an expression for each of `levels` levels; deeper ones count as the deepest.
    """
    later = Window.partitionBy("doc_id").orderBy("order").rowsBetween(1, Window.unboundedFollowing)
    following = [F.min(F.when(F.col("level") <= n, F.struct("order", "start_page"))).over(later)["start_page"] for n in range(1, levels + 1)]
    nearest = F.element_at(F.array(*following), F.least(F.col("level"), F.lit(levels)))
    return sections.withColumn("end_page", F.when(nearest.isNull(), F.col("page_count")).otherwise(F.greatest(F.col("start_page"), nearest - 1)))


def outline_sections(outline: DataFrame, documents: DataFrame) -> DataFrame:
    """Sections of documents: a root each, front matter before an outline that starts later than page 1, and one a outline entry.

    Inferred levels are 1 or 2, so a section's parent is the last one of level 1 before it, or the root; front
    matter before the outline is nobody's parent.
    """
    docs = documents.select("doc_id", F.col("title").alias("root_title"), "page_count")
    kinded = with_kind(outline.join(docs, "doc_id"))
    first = F.first(_clamped(F.col("page"))).over(Window.partitionBy("doc_id").orderBy("ord"))
    sections = kinded.withColumns({"section_id": section_id(), "level": F.col("inferred_level"), "start_page": _clamped(F.col("page")), "first_page": first})
    above = F.last(F.when(F.col("level") == 1, F.struct("section_id", "title")), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    nested = (F.col("level") == 2) & above.isNotNull()
    sections = sections.withColumns(
        {
            "parent_id": F.when(nested, above["section_id"]).otherwise("document"),
            "parent_title": F.when(nested, above["title"]).otherwise(F.col("root_title")),
            "order": F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) + (F.col("first_page") > 1).cast("int"),
            "source": F.lit("pdf_outline"),
            "confidence": F.when(F.col("outline_level") == F.col("level"), 0.98).otherwise(0.9),
        }
    )
    columns = [c for c in SECTION if c != "end_page"] + ["page_count"]
    fronts = sections.filter((F.col("first_page") > 1) & (F.col("order") == 2)).withColumns(
        {
            "section_id": F.lit("front_matter_pre_outline"), "title": F.lit("Front Matter Before PDF Outline"), "level": F.lit(1), "parent_id": F.lit("document"), "parent_title": F.col("root_title"), "start_page": F.lit(1),
            "source": F.lit("synthetic_pre_outline"), "confidence": F.lit(1.0), "outline_level": F.lit(0), "order": F.lit(1), "kind": F.lit("front_matter"),
        }
    )
    ended = _end_pages(sections.select(*columns).unionByName(fronts.select(*columns)), 2)
    return _roots(documents).select(*SECTION).unionByName(ended.select(*SECTION))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _parents(levels: pd.Series) -> pd.Series:
    """Of each level in order, the place of the last one before it that is less; null where there is none."""

    def links(found: np.ndarray) -> list[int | None]:
        out, open_ = [], []
        for i, level in enumerate(found):
            while open_ and found[open_[-1]] >= level:
                open_.pop()
            out.append(open_[-1] if open_ else None)
            open_.append(i)
        return out

    return levels.map(links)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _followers(levels: pd.Series) -> pd.Series:
    """Of each level in order, the place of the first one after it that is not greater; null where there is none."""

    def links(found: np.ndarray) -> list[int | None]:
        out, open_ = [None] * len(found), []
        for i, level in enumerate(found):
            while open_ and found[open_[-1]] >= level:
                out[open_.pop()] = i
            open_.append(i)
        return out

    return levels.map(links)


def heading_sections(headings: DataFrame, documents: DataFrame) -> DataFrame:
    """Sections from headings of any depth: a heading's parent is the last one before it of a lesser level, or the root.

    Blank headings are left out; a missing level is 1.  A document's headings meet in one row, in order, where one
    pass with a stack links each to its parent and to the next heading of its level or a lesser one.
    """
    docs = documents.select("doc_id", F.col("title").alias("root_title"), "page_count")
    kept = headings.filter(F.coalesce(strip("title"), F.lit("")) != "").withColumn("level", F.coalesce(F.nullif(F.col("level"), F.lit(0)), F.lit(1)))
    kinded = with_kind(kept.join(docs, "doc_id")).withColumns({"section_id": section_id(), "order": F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")), "start_page": _clamped(F.nullif(F.col("page"), F.lit(0)))})
    listed = kinded.groupBy("doc_id", "root_title", "page_count").agg(F.array_sort(F.collect_list(F.struct("order", "section_id", "title", "level", "kind", "start_page"))).alias("all"))
    levels = F.transform("all", lambda s: s["level"])
    linked = listed.withColumns({"parents": _parents(levels), "followers": _followers(levels)})
    each = F.transform("all", lambda s, i: F.struct(s.alias("own"), F.get("all", F.get("parents", i)).alias("parent"), F.get("all", F.get("followers", i))["start_page"].alias("following")))
    rows = linked.select("doc_id", "root_title", "page_count", F.explode(each).alias("s")).select("doc_id", "root_title", "page_count", "s.own.*", "s.parent", "s.following")
    sections = rows.withColumns(
        {
            "parent_id": F.coalesce(F.col("parent")["section_id"], F.lit("document")), "parent_title": F.coalesce(F.col("parent")["title"], F.col("root_title")),
            "end_page": F.when(F.col("following").isNull(), F.col("page_count")).otherwise(F.greatest(F.col("start_page"), F.col("following") - 1)),
            "source": F.lit("docling_heading"), "confidence": F.lit(0.8), "outline_level": F.col("level"),
        }
    )
    return _roots(documents).select(*SECTION).unionByName(sections.select(*SECTION))


def sections_of(outline: DataFrame, headings: DataFrame, documents: DataFrame) -> DataFrame:
    """Outline sections where a document has an outline, heading sections where it has none."""
    with_outline = outline.select("doc_id").distinct()
    return outline_sections(outline, documents.join(with_outline, "doc_id", "left_semi")).unionByName(heading_sections(headings.join(with_outline, "doc_id", "left_anti"), documents.join(with_outline, "doc_id", "left_anti")))


#: The five columns an element gets from its section, by the section's own.
PLACE = {"section_id": "section_id", "section_title": "title", "section_level": "level", "parent_section_id": "parent_id", "parent_section_title": "parent_title"}


def _place(columns: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(PLACE[c]).alias(c) for c in columns])


def page_sections(sections: DataFrame, columns: tuple[str, ...] = tuple(PLACE)) -> DataFrame:
    """(doc_id, page_num, section): the deepest section of every page, ties to the later start, then the later order."""
    pages = sections.filter("start_page <= end_page").withColumn("page_num", F.explode(F.sequence("start_page", "end_page")))
    return pages.groupBy("doc_id", "page_num").agg(F.max_by(_place(columns), F.struct("level", "start_page", "order")).alias("section"))


def attach_sections(elements: DataFrame, sections: DataFrame, columns: tuple[str, ...] = tuple(PLACE)) -> DataFrame:
    """Elements with their section's five columns, or those named; a missing page, 0, or one outside all sections belongs to the root.  One equi-join on document and page."""
    roots = sections.filter("source = 'synthetic_root'").select("doc_id", _place(columns).alias("root"))
    joined = elements.join(page_sections(sections, columns), ["doc_id", "page_num"], "left").join(roots, "doc_id", "left").withColumn("__section", F.coalesce("section", "root"))
    return joined.drop("section", "root").select("*", "__section.*").drop("__section")


def segmentation_report(elements: DataFrame, sections: DataFrame) -> DataFrame:
    """One row a document: counts of sections by source and of elements, warnings, and whether segmentation passed."""
    of = lambda source: F.count_if(F.col("source") == source)
    trees = sections.groupBy("doc_id").agg(F.count(F.lit(1)).alias("section_count"), of("pdf_outline").alias("outline_section_count"), of("docling_heading").alias("heading_section_count"))
    counted = elements.groupBy("doc_id").agg(F.count(F.lit(1)).alias("element_count"), F.countDistinct(F.nullif(F.col("page_num"), F.lit(0))).alias("element_page_count"), F.count_if(F.col("section_id") == "document").alias("root_only_element_count"))
    joined = trees.join(counted, "doc_id", "left").na.fill(0, ["element_count", "element_page_count", "root_only_element_count"])
    warnings = F.array_compact(
        F.array(
            F.when(F.col("root_only_element_count") > 0, F.lit("Some elements only matched the synthetic document root.")),
            F.when(F.col("outline_section_count") + F.col("heading_section_count") == 0, F.lit("No PDF outline sections or Docling headings were found.")),
        )
    )
    return joined.withColumn("warnings", warnings).withColumn("passed", F.size("warnings") == 0)


def element_counts(elements: DataFrame) -> DataFrame:
    """(doc_id, by, value, n): elements by section and by type."""
    long = elements.select("doc_id", F.explode(F.array(F.struct(F.lit("section").alias("by"), F.col("section_id").alias("value")), F.struct(F.lit("type").alias("by"), F.col("type").alias("value")))).alias("x"))
    return long.groupBy("doc_id", "x.by", "x.value").agg(F.count(F.lit(1)).alias("n"))


def _paths(ids: list[str], titles: list[str], parents: list[str]) -> list[str]:
    """Of each section the titles from the root down, joined by ' > '; ids that do not exist or were met before end a path."""
    title_of, up, known = dict(zip(ids, titles, strict=True)), dict(zip(ids, parents, strict=True)), {}

    def joined(path: str, at: str) -> str:
        title = title_of[at] or ""
        return f"{path} > {title}" if path and title else path or title

    for start in ids:
        chain, met, at = [], set(), start
        while at in up and at not in met and at not in known:
            chain.append(at)
            met.add(at)
            at = up[at]
        if at in met:  # a cycle: paths of the sections on it each end before themselves
            ring = chain[chain.index(at) :]
            for i, x in enumerate(ring):
                path = ""
                for y in reversed(ring[i:] + ring[:i]):
                    path = joined(path, y)
                known[x] = path
            chain = chain[: -len(ring)]
        path = known.get(at, "")
        for x in reversed(chain):
            path = known[x] = joined(path, x)
    return [known[x] for x in ids]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _hierarchies(trees: pd.DataFrame) -> pd.Series:
    return pd.Series([_paths(list(i), list(t), list(p)) for i, t, p in zip(trees["ids"], trees["titles"], trees["parents"], strict=True)], dtype=object)


def breadcrumbs(sections: DataFrame) -> DataFrame:
    """(doc_id, section_id, hierarchy): titles from the root down, joined by ' > '; of equal ids the last section counts.

    Ids that do not exist end a path, and so do ids met before, so a cycle is no harm; depth has no limit.
    A document's sections meet in one row, where each path is made once from its parent's.
    """
    last = sections.groupBy("doc_id", "section_id").agg(F.max_by(F.struct(strip(F.coalesce("title", F.lit(""))).alias("title"), "parent_id"), "order").alias("s"))
    listed = last.groupBy("doc_id").agg(F.collect_list(F.struct("section_id", "s.title", "s.parent_id")).alias("all"))
    tree = F.struct(F.col("all.section_id").alias("ids"), F.col("all.title").alias("titles"), F.col("all.parent_id").alias("parents"))
    paths = listed.withColumn("paths", _hierarchies(tree))
    rows = paths.select("doc_id", F.explode(F.transform("all", lambda s, i: F.struct(s["section_id"].alias("section_id"), F.get("paths", i).alias("hierarchy")))).alias("s"))
    return rows.select("doc_id", "s.*")


def outline_gaps(outline: DataFrame, headings: DataFrame) -> DataFrame:
    """Outline entries without a heading of the same title and headings without an outline entry (an extension; the gates do not use it)."""
    key = lambda df, name: df.select("doc_id", slugify("title", 200).alias("slug"), F.lit(True).alias(name)).distinct()
    both = key(outline, "in_outline").join(key(headings, "in_headings"), ["doc_id", "slug"], "full")
    return both.na.fill(False, ["in_outline", "in_headings"]).filter("in_outline <> in_headings")
