"""Token-budgeted chunks of elements, with page provenance, breadcrumbs and an overlap tail.

Packing is a fold over a document's elements in reading order: whether a chunk closes depends on all before it,
so no window sum expresses it.  Only token counts go through Python; texts stay in the JVM, and meet in one shuffle
by document.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip, word_tail, word_tokens


def table_text(caption: Column | str, rows: Column | str) -> Column:
    """A table as lines: its caption, then cells joined by ' | ', with line ends as spaces and bars escaped."""
    cell = lambda c: F.replace(F.replace(F.replace(strip(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit("")), F.lit("|"), F.lit("\\|"))
    lines = F.transform(F.coalesce(rows, F.array().cast("array<array<string>>")), lambda r: F.array_join(F.transform(r, cell), " | "))
    title = strip(F.coalesce(caption, F.lit("")))
    return F.array_join(F.when(title != "", F.concat(F.array(F.concat(F.lit("Table Caption: "), title)), lines)).otherwise(lines), "\n")


def chunk_units(elements: DataFrame) -> DataFrame:
    """Elements with the text that is chunked: tables with rows as lines, others stripped; blank ones are left out, null counts as blank."""
    plain, filled = strip(F.coalesce("text", F.lit(""))), lambda c: F.coalesce(F.rlike(c, F.lit(r"(?U)\S")), F.lit(False))
    if "rows" not in elements.columns:
        return elements.filter(filled(F.col("text"))).withColumn("text", plain)
    table = (F.col("type") == "table") & F.col("rows").isNotNull()
    # what is blank is told from the text as it came, so that it is stripped once
    return elements.filter(F.when(table, filled(table_text("text", "rows"))).otherwise(filled(F.col("text")))).withColumn("text", F.when(table, table_text("text", "rows")).otherwise(plain))


def counted_units(elements: DataFrame, tokens=word_tokens) -> DataFrame:
    """Units with their number of tokens in place of text and rows: all that `chunk_places` needs, so that texts are not shuffled."""
    return chunk_units(elements).withColumn("tokens", tokens("text").cast("long")).drop("text", "rows")


def chunk_starts(tokens: np.ndarray, budget: int) -> np.ndarray:
    """Places (from 0) at which chunks start: one closes before a unit that would take it over budget, unless it holds no token yet."""
    starts, held = [], 0
    for i, n in enumerate(tokens):
        if not starts or (held > 0 and held + n > budget):
            starts.append(i)
            held = 0
        held += n
    return np.array(starts, np.int64)


def pack(units: DataFrame, budget: int) -> DataFrame:
    """(doc_id, seq, tokens, chunk_no) of units (doc_id, seq, tokens); a unit above the budget stands alone, none is split.

    Equal seq values are taken in any order.
    """

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        fresh = np.zeros(table.num_rows, np.int64)
        fresh[chunk_starts(table["tokens"].to_numpy(), budget)] = 1
        return table.append_column("chunk_no", pa.array(np.cumsum(fresh)))

    kind = units.schema["doc_id"].dataType.simpleString()
    narrow = units.select("doc_id", F.col("seq").cast("long").alias("seq"), F.col("tokens").cast("long").alias("tokens"))
    return narrow.groupBy("doc_id").applyInArrow(fold, f"doc_id {kind}, seq long, tokens long, chunk_no long")


def chunks(elements: DataFrame, budget: int = 1000, overlap: int = 150, hierarchy: DataFrame | None = None, tokens=word_tokens, tail=word_tail) -> DataFrame:
    """Chunks of elements (doc_id, seq, type, text, page_num, section_id and rows where there are tables).

    `tokens` and `tail` count and cut in the caller's tokens; words are the default.  token_count sums the units'
    counts, separators excluded.  A chunk's section is the last one met up to its end; its pages are distinct and
    in order; the first chunk's overlap is empty.  hierarchy holds (doc_id, section_id, hierarchy).
    """

    units = chunk_units(elements).withColumn("tokens", tokens("text").cast("long"))
    return _packed(units, budget, hierarchy, lambda text: tail(text, overlap)).select("doc_id", "chunk_no", "chunk_id", "page_range", "section_id", "hierarchy", "text", "prev_chunk_tail", "token_count")


def chunk_places(units: DataFrame, budget: int = 1000, hierarchy: DataFrame | None = None) -> DataFrame:
    """The chunks of `counted_units` as `chunks` makes them, without their texts and overlaps: (doc_id, chunk_no, chunk_id, page_range, section_id, hierarchy, token_count)."""
    return _packed(units, budget, hierarchy, None).select("doc_id", "chunk_no", "chunk_id", "page_range", "section_id", "hierarchy", "token_count")


def _packed(units: DataFrame, budget: int, hierarchy: DataFrame | None, tail: Callable[[Column], Column] | None) -> DataFrame:
    """Chunks of units (doc_id, seq, tokens, and page_num, section_id, text); with `tail`, texts and the tails of those before."""

    @F.pandas_udf("array<int>")
    def starts_of(counts: pd.Series) -> pd.Series:
        return counts.map(lambda n: chunk_starts(n, budget) + 1)

    units = units.withColumn("seq", F.col("seq").cast("long"))
    for name in ("section_id", "page_num"):
        if name not in units.columns:
            units = units.withColumn(name, F.lit(None).cast("string" if name == "section_id" else "int"))
    so_far = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    # every unit knows the last section met, so a chunk's is that of its last unit
    units = units.withColumn("section_id", F.last(F.nullif(F.col("section_id"), F.lit("")), ignorenulls=True).over(so_far))
    whole = units.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", *["text"] * bool(tail), "page_num", "section_id", "tokens"))).alias("units"))
    started = whole.withColumn("starts", starts_of(F.transform("units", lambda u: u["tokens"])))
    parts = F.transform("starts", lambda s, i: F.slice("units", s, F.coalesce(F.get("starts", i + 1), F.size("units") + 1) - s))
    text_of = lambda part: F.array_join(F.transform(part, lambda u: u["text"]), "\n\n")

    def chunk(doc: Column, part: Column, i: Column) -> Column:
        texts = [F.get(doc["texts"], i).alias("text"), F.when(i == 0, F.lit("")).otherwise(tail(F.get(doc["texts"], i - 1))).alias("prev_chunk_tail")] if tail else []
        return F.struct(
            *texts,
            F.array_sort(F.array_distinct(F.filter(F.transform(part, lambda u: u["page_num"]), lambda p: F.coalesce(p, F.lit(0)) != 0))).alias("page_range"),
            F.element_at(part, -1)["section_id"].alias("section_id"),
            F.aggregate(F.transform(part, lambda u: u["tokens"]), F.lit(0).cast("long"), lambda total, n: total + n).alias("token_count"),
        )

    # a document's chunks are made in its row, from arrays bound once: neither texts nor tails need another shuffle
    bound = F.array(F.struct(parts.alias("parts"), *[F.transform(parts, text_of).alias("texts")] * bool(tail)))
    made = F.get(F.transform(bound, lambda doc: F.transform(doc["parts"], lambda part, i: chunk(doc, part, i))), F.lit(0))
    found = started.select("doc_id", F.posexplode(made).alias("at", "chunk")).select("doc_id", (F.col("at") + 1).cast("long").alias("chunk_no"), "chunk.*")
    found = found.withColumn("chunk_id", F.format_string("chunk_%04d", F.col("chunk_no")))
    if hierarchy is not None:
        found = found.join(hierarchy.select("doc_id", "section_id", "hierarchy"), ["doc_id", "section_id"], "left").withColumn("hierarchy", F.coalesce("hierarchy", F.lit("")))
    else:
        found = found.withColumn("hierarchy", F.lit(""))
    return found


def sentence_units(elements: DataFrame) -> DataFrame:
    """Units split at sentence ends (an extension), for chunks that keep to a budget more closely; seq is made anew."""
    parts = elements.withColumn("part", F.explode(F.split(F.col("text"), r"(?<=[.!?])\s+"))).withColumn("at", F.monotonically_increasing_id())
    return parts.withColumn("text", F.col("part")).withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "at"))).drop("part", "at")


def bpe_tokens(ranks_path: str, pattern: str):
    """A token counter over a tiktoken rank file for `chunks`: Arrow batches, the vocabulary loaded once a worker."""
    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(ranks_path, pattern)
        return pd.Series([len(x) for x in encoding.encode_ordinary_batch(texts.fillna("").tolist(), num_threads=1)])

    return count


_ENCODINGS: dict = {}


def _encoding(path: str, pattern: str):
    if path not in _ENCODINGS:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]
