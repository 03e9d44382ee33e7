"""SentencePiece encoding and decoding over a distinct-chunk table.

No vocabulary piece holds a white-space marker after another character, nor a line feed, so merges never
cross the start of a marked word or a line.  Each slice of rows segments every distinct marked word once and
joins the ids back by position; nothing is kept between slices, so memory is bounded by the slice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, slices
from .token_counts import MARK, MODEL, crosses_marks, processor

#: A chunk starts at a run of markers or at a line feed.
CHUNK = re.compile(f"\n[^ \n{MARK}]*|[ {MARK}]+[^ \n{MARK}]*")
SLICE_BYTES = 1 << 20


def chunk_ids(chunks: list[str], sp) -> list[list[int]]:
    """Ids of marked words.  The encoder puts a marker before whatever it gets: it stands for the chunk's first one, or is dropped before a line feed."""
    found = sp.encode([c if c[0] == "\n" else c[1:] or "\n" for c in chunks], num_threads=1)
    return [ids[1:] if c[0] == "\n" else ids[:1] if len(c) == 1 else ids for c, ids in zip(chunks, found, strict=True)]


def encode_texts(texts: list[str], sp) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat ids of some texts."""
    table: dict[str, int] = {}
    codes: list[int] = []
    starts = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        if text:
            codes += [table.setdefault(c, len(table)) for c in CHUNK.findall(" " + text)]
        starts[i + 1] = len(codes)
    ids = chunk_ids(list(table), sp)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((x for part in ids for x in part), np.int32, int(lengths.sum()))
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(ids) else np.zeros(0, np.int64)
    at = np.array(codes, np.int64)
    n = lengths[at] if len(at) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(n)])
    take = np.arange(ends[-1]) + np.repeat((first[at] if len(at) else n) - ends[:-1], n)
    return ends[starts], flat[take] if len(take) else np.zeros(0, np.int32)


def encode_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Rows (doc_id, ids array<int>), exactly the library's ids without begin or end marks.

    Null and empty texts give an empty array.  Rows are independent: repeated rows, null ids and empty tables
    need no rule; other columns are not read.  A model with pieces that cross markers is encoded text by text.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        whole = crosses_marks(model)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = part.column(1).to_pylist()
            if whole:
                found = pa.array(sp.encode([t or "" for t in texts], num_threads=1), pa.list_(pa.int32()))
            else:
                ends, flat = encode_texts(texts, sp)
                found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Rows (doc_id, ids array<int>, decoded string): `encode_pieces` and the library's decode(ids) in one pass of one worker."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        whole = crosses_marks(model)
        for part in slices(batches, "text", SLICE_BYTES):
            texts = part.column(1).to_pylist()
            ends, flat = (None, None) if whole else encode_texts(texts, sp)
            ids = sp.encode([t or "" for t in texts], num_threads=1) if whole else [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            found = pa.array(ids, pa.list_(pa.int32())) if whole else pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), found, pa.array(sp.decode(ids), pa.string())], ["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def decode_pieces(encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """Adds the library's decode(ids) as a string column to all columns of `encoded`; null ids decode to an empty text."""
    columns = [c for c in encoded.columns if c != out_col]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = sp.decode([x or [] for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*columns, out_col])

    rows = encoded.select(*columns)
    return rows.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, `{out_col}` string")
