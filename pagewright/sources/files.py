"""Readers and writers of pipeline artifacts: layout documents, JSON lines, Markdown, PDFs by plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_layouts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Layout documents, one a file, as (doc_id, file, layout): the JSON text whole, the id a hash of the file's name."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("layout"))
    return files.select(F.xxhash64("file").alias("doc_id"), "file", "layout")


def read_json(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Whole-file JSON by a given schema, never inferred; a file that does not parse fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths)


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines by a given schema; blank lines are skipped, a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def with_optional(elements: DataFrame, more: DataFrame | None) -> DataFrame:
    """Elements and, where there are any, those of the vision model; columns that one side lacks are null."""
    return elements if more is None else elements.unionByName(more, allowMissingColumns=True)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, always overwritten, so that no file of an earlier run is left to be read."""
    df.write.mode("overwrite").json(path)


def joined_markdown(parts: DataFrame) -> DataFrame:
    """(doc_id, markdown) of (doc_id, start_page, markdown): parts in page order with a blank line between."""
    ordered = F.array_sort(F.collect_list(F.struct("start_page", "markdown")))
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["markdown"]), "\n\n").alias("markdown"))


def read_pdfs(spark: SparkSession, paths: str | list[str], plugin: Callable[[str, bytes], Iterator[dict]], schema: str) -> DataFrame:
    """Rows that a plug-in yields for every PDF: plugin(path, bytes) runs in the worker, once a file.

    Page signals, outlines, layout JSON and page images all come this way (module `pdf`); a plug-in holds its model in
    a module global, so that a worker loads it once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in batch.itertuples(index=False):
                yield pd.DataFrame(list(plugin(path, bytes(content))))

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, schema)
