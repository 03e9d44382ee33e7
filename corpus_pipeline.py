"""A training corpus in five stages over the documents table.

Toxic documents go, near duplicates go, repeated passages go, sources are mixed to their target weights, and
what is left is encoded.  Every stage works on all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.common import materialize, settled
from pagewright.llm.minhash_dedup import drop_near_duplicates
from pagewright.llm.paragraph_dedup import remove_passages, repeated_passages
from pagewright.llm.piece_codec import round_trip
from pagewright.llm.source_mixing import apply_mix, mix_sources
from pagewright.llm.toxicity import fit_toxicity, fold, score_toxicity
from pagewright.workers import reachable

#: Documents of at least this toxicity are rejected.
TOXIC = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score below TOXIC; labels of fold 0 are not learned from.  Null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold() != 0)
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs, model).filter(F.col("toxicity") < TOXIC).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate component on five-word shingles, of its least doc_id; rows with a null id and texts without words stay."""
    return drop_near_duplicates(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that repeat an earlier document's out of texts; n_chars follows the text."""
    cut = remove_passages(docs, settled(spark, lambda: repeated_passages(docs), "repeats"))
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else cut


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every document as often as the mix of sources to target weights says."""
    return apply_mix(docs, settled(spark, lambda: mix_sources(docs), "mix"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text and whether they decode to it."""
    decoded = round_trip(docs)
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", digest(F.col("decoded")).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("source_mixing", mix), ("piece_encoding", encode)]
#: Models, MinHash and the tokenizer are beyond SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each stage's result is written to the shared folder before the next reads it."""
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
