"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut into pieces at safe boundaries, pieces are packed into batches of equal bytes, and only
the number of ids leaves the worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, released, slices

MODEL = "piece_bpe_32k.model"
#: Texts above this many characters are cut, and batches hold about so many bytes.
PIECE_CHARS, BATCH_BYTES = 1 << 15, 1 << 20
MARK = "▁"


@cache
def processor(model: str):
    """The sentencepiece processor of a model file, once a worker; a bare name is looked up among the public tokenizers."""
    import sentencepiece

    if "/" not in model:
        import public_tokenizers

        model = public_tokenizers.path(model)
    return sentencepiece.SentencePieceProcessor(model_file=model)


@cache
def crosses_marks(model: str) -> bool:
    """Whether some piece holds a white-space marker after another character, or a line feed: then no cut is safe."""
    sp = processor(model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    spaced = sp.encode("a  b") != sp.encode("a b") and sp.encode(" a") != sp.encode("a")
    return not spaced or any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """Cut a long text at single spaces between words, each dropped because the encoder puts one before every piece.

    The pieces' counts add up to the text's: no vocabulary piece holds a marker after another character.
    A run of characters without such a space stays whole.
    """
    out, start = [], 0
    while len(text) - start > limit:
        at = text.rfind(" ", start + 1, start + limit)
        while at > start and (text[at - 1] in (" ", MARK) or text[at + 1] in (" ", MARK)):
            at = text.rfind(" ", start + 1, at)
        if at <= start:
            at = text.find(" ", start + limit, len(text) - 1)
            while at > 0 and (text[at - 1] in (" ", MARK) or text[at + 1] in (" ", MARK)):
                at = text.find(" ", at + 1, len(text) - 1)
            if at < 0:
                break
        out.append(text[start:at])
        start = at + 1
    out.append(text[start:])
    return out


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, limit: int = 4096) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of docs.

    A null text counts as empty: 0 bytes and 0 tokens.  Rows are independent, so ties, repeated rows, null
    ids and empty tables need no rule; columns other than the two named are not read.  No shuffle.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        cut = (lambda t: [t]) if crosses_marks(model) else safe_pieces
        for part in slices(batches, "text", SLICE_BYTES):
            counts = np.zeros(part.num_rows, np.int64)
            held: list[str] = []
            owner: list[int] = []
            size = 0

            def flush(held: list[str], owner: list[int], counts: np.ndarray) -> None:
                if held:
                    np.add.at(counts, owner, [len(ids) for ids in sp.encode(held, num_threads=1)])

            for i, text in enumerate(part.column(1).to_pylist()):
                for piece in cut(text or ""):
                    held.append(piece)
                    owner.append(i)
                    size += len(piece.encode("utf-8", "surrogatepass"))
                    if size >= BATCH_BYTES:
                        flush(held, owner, counts)
                        held, owner, size = [], [], 0
            flush(held, owner, counts)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
