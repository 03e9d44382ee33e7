"""Inputs of the operators made from the synthetic tables, which hold no PDFs.

Lines of a document are elements, five a page; signals, outlines, layouts and blocks follow from ids and places by
fixed arithmetic, so that every rule of every operator has rows that meet it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, seq, page_num, type, text, rows): a line with ' | ' is a table of one row."""
    lines = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    table = F.contains("text", F.lit(" | "))
    return lines.select("doc_id", (F.col("at") + 1).alias("seq"), (F.floor(F.col("at") / 5) + 1).cast("int").alias("page_num"), F.when(table, "table").otherwise("paragraph").alias("type"), "text", F.when(table, F.array(F.split("text", r" \| "))).alias("rows"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = elements(spark, sf_dir).groupBy("doc_id", "page_num").agg(F.sum(F.char_length("text")).alias("chars"))
    d, p, chars = F.col("doc_id"), F.col("page_num"), F.col("chars")
    count = F.when((d + p) % 7 == 0, 0).when((d + p) % 5 == 0, chars % 40).otherwise(chars)
    images = (d * 3 + p) % 3
    coverage = F.when(images > 0, ((d * 13 + p * 29) % 101).cast("double") / 100).otherwise(0.0)
    return pages.select("doc_id", "page_num", count.cast("int").alias("char_count"), images.cast("int").alias("image_count"), coverage.alias("image_coverage"), ((d * 7 + p * 43) % 260).cast("int").alias("drawing_count"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, kind, text, pages): every fifth line touches the next page as well."""
    kind = F.when(F.col("type") == "table", "table").when(F.col("seq") % 9 == 0, "picture").otherwise("text")
    pages = F.when(F.col("seq") % 5 == 0, F.array(F.col("page_num"), F.col("page_num") + 1)).otherwise(F.array("page_num"))
    return elements(spark, sf_dir).select("doc_id", kind.alias("kind"), "text", pages.alias("pages"))


def titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, page_count)"""
    lines = F.size(F.split("text", "\n"))
    return documents(spark, sf_dir).select("doc_id", F.concat_ws("-", "source", F.col("doc_id").cast("string")).alias("title"), (F.floor((lines - 1) / 5) + 2).cast("int").alias("page_count"))


def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry a page, named by its first line, of each kind in turn; odd documents start at page 2."""
    first = elements(spark, sf_dir).filter("seq % 5 = 1")
    p, text = F.col("page_num"), F.col("text")
    numeral = F.element_at(F.array(*map(F.lit, ROMAN)), (F.floor((p - 1) / 5) % 10 + 1).cast("int"))
    title = (
        F.when((p - 1) % 5 == 0, F.concat(F.lit("PART "), numeral, F.lit(" "), text))
        .when((p - 1) % 5 == 1, F.concat(p.cast("string"), F.lit(". "), text))
        .when((p - 1) % 5 == 2, F.concat(F.lit("Appendix IV: "), text))
        .when((p - 1) % 5 == 3, F.lit("Appendices"))
        .otherwise(text)
    )
    return first.select("doc_id", p.alias("ord"), (p % 2 + 1).alias("outline_level"), title.alias("title"), (p + F.col("doc_id") % 2).cast("int").alias("page"))


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, over twenty levels."""
    return elements(spark, sf_dir).select("doc_id", F.col("seq").alias("ord"), ((F.col("seq") * 7 + F.col("doc_id")) % 20 + 1).cast("int").alias("level"), F.col("text").alias("title"), F.col("page_num").alias("page"))


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, file, layout JSON): a list group of odd lines, tables with the line before as caption, even lines; every tenth line is in nothing."""
    table = F.col("type") == "table"
    rows = elements(spark, sf_dir).withColumn("name", F.concat(F.when(table, "#/tables/").otherwise("#/texts/"), (F.col("seq") - 1).cast("string")))
    prov = F.array(F.struct(F.col("page_num").alias("page_no")))
    label = F.element_at(F.array(*map(F.lit, ("section_header", "list_item", "text", "footnote"))), F.col("seq") % 4 + 1)
    ref = lambda c: F.struct(c.alias("$ref"))
    caption = F.when(F.col("seq") > 1, F.array(ref(F.concat(F.lit("#/texts/"), (F.col("seq") - 2).cast("string")))))
    text = F.when(~table, F.struct(F.col("name").alias("self_ref"), label.alias("label"), F.col("text"), prov.alias("prov")))
    grid = F.struct(F.transform("rows", lambda r: F.transform(r, lambda c: F.struct(c.alias("text")))).alias("grid"))
    tab = F.when(table, F.struct(F.col("name").alias("self_ref"), F.lit("table").alias("label"), caption.alias("captions"), grid.alias("data"), prov.alias("prov")))
    odd, named = F.col("seq") % 2 == 1, F.struct("seq", ref(F.col("name")).alias("r"))
    listed = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, named))), lambda x: x["r"])
    grouped = rows.groupBy("doc_id").agg(F.collect_list(text).alias("texts"), F.collect_list(tab).alias("tables"), listed(~table & odd).alias("inner"), listed(table).alias("tabs"), listed(~table & ~odd & (F.col("seq") % 10 != 0)).alias("rest"))
    group = F.struct(F.lit("#/groups/0").alias("self_ref"), F.lit("list").alias("label"), F.col("inner").alias("children"))
    body = F.struct(F.concat(F.array(ref(F.lit("#/groups/0"))), "tabs", "rest").alias("children"))
    return grouped.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file"), F.to_json(F.struct(body.alias("body"), "texts", "tables", F.array(group).alias("groups"))).alias("layout"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_num, idx, bbox, text, size): lines as blocks of varying size, one below the other."""
    d, s = F.col("doc_id"), F.col("seq")
    size = F.when(s % 6 == 1, 14.0 + d % 3).when(s % 6 == 4, 8.0).otherwise(10.0 + s % 2)
    top = ((s - 1) % 5 * 100).cast("double")
    box = F.struct(F.lit(0.0).alias("x0"), top.alias("y0"), F.lit(100.0).alias("x1"), (top + 100).alias("y1"))
    return elements(spark, sf_dir).select("doc_id", "page_num", s.alias("idx"), box.alias("bbox"), "text", size.cast("double").alias("size"))


def block_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_num, bbox): on every third page a table over most of the second block and some of the third."""
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(110.0).alias("y0"), F.lit(100.0).alias("x1"), F.lit(230.0).alias("y1"))
    return elements(spark, sf_dir).filter("page_num % 3 = 0").select("doc_id", "page_num").distinct().withColumn("bbox", box)


def flawed_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with what the gates look for: missing fields, words run together, texts that repeat a table, pages out of order."""
    s, text = F.col("seq"), F.col("text")
    joined = F.concat(F.when(s % 15 == 0, "http://longword").otherwise("longword"), F.lit("Joined"), F.when(s % 2 == 0, "abc").otherwise("xyzq"), F.lit(" "), text)
    base = elements(spark, sf_dir).withColumns(
        {
            "element_id": F.when(s % 19 != 0, F.format_string("e%05d", s)),
            "section_id": F.when(s % 13 == 0, "").otherwise("document"),
            "source_parser": F.when(s % 17 != 0, "docling"),
            "text": F.when(F.col("type") == "table", "Caption").when(s % 3 == 0, joined).otherwise(text),
            "page_num": F.when(s % 11 != 0, F.col("page_num") - F.when(s % 6 == 0, 1).otherwise(0)),
        }
    )
    cells = F.array_join(F.slice(F.col("rows")[0], 1, 4), " ")
    copies = base.filter(F.col("rows").isNotNull()).withColumns({"element_id": F.concat(F.lit("c"), F.coalesce("element_id", F.lit("x"))), "type": F.lit("text"), "text": cells, "seq": s + 100000, "rows": F.lit(None).cast("array<array<string>>")})
    return base.unionByName(copies)


def base_url(column: str) -> Column:
    d = F.col(column)
    tail = F.element_at(F.array(*map(F.lit, ("", "/", "/v1", "/v1/v1/", "/api//"))), (d % 5 + 1).cast("int"))
    return F.concat(F.lit("http://host"), d.cast("string"), F.lit(":7080"), tail)
