"""Queries over the synthetic tables, one for each operator, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of
from .embedding_dedup import near_duplicate_vectors
from .imatch import band_lexicon, fingerprint_of, likeness, with_next
from .minhash_dedup import near_duplicates
from .paragraph_dedup import repeated_passages
from .piece_codec import round_trip
from .sharding import shuffle_into_shards
from .source_mixing import mix_sources
from .suffix_tree import score_texts
from .token_counts import count_tokens
from .toxicity import fit_toxicity, fold, score_toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 16 shards with row counts at most one apart (law `rows`)."""
    found = shuffle_into_shards(documents(spark, sf_dir).select("doc_id", "text"), 16)
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), crc32_of(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings at a cosine of 0.9."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    found = round_trip(documents(spark, sf_dir))
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents on 4-word shingles at a Jaccard similarity of 0.8."""
    return near_duplicates(documents(spark, sf_dir), k=4, percent=80)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, and its offending sentences; labels of fold 0 are held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold() != 0)
    found = score_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return found.select("doc_id", (fold() == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "offending")


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix-tree and unigram scores of all texts; fold 1 is held out of the training."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = score_texts(docs, docs.filter(fold() != 1))
    return found.select("doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose last quarter comes from the next document."""
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = docs.count()
    lexicon = band_lexicon(docs, "text", total=total)
    printed = docs.withColumn("fingerprint", fingerprint_of(F.col("text"), lexicon))
    n_ranges = min(1 << 16, max(128, total // 1024))
    rows = with_next(printed, "doc_id", ["text", "fingerprint"], n_ranges).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_fingerprint", fingerprint_of(F.col("edited"), lexicon))
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op8_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ranges of documents that repeat a passage of another document or an earlier place."""
    found = repeated_passages(documents(spark, sf_dir))
    return found.select("doc_id", "first_doc_id", F.col("start").alias("start_byte"), F.col("end").alias("end_byte"), (F.col("end") - F.col("start")).alias("n_bytes"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return count_tokens(documents(spark, sf_dir))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_sharding, op2_embedding_dedup, op3_piece_codec, op4_minhash_dedup, op5_toxicity, op6_suffix_tree, op7_imatch, op8_paragraph_dedup, op9_token_counts, op10_source_mixing)}


def oracle_sql() -> dict[str, str]:
    return {}
