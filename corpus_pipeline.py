"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

Every stage but the last returns the columns of documents.  Rows without a doc_id pass the
duplicate stages unchanged, as those compare documents by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import cotraining, decontamination, jaccard, packing, recompression
from tallyforge.llm.common import written
from tallyforge.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def box(docs: DataFrame, *without: str) -> Column:
    """The document's columns as one, out of reach of the names that an operator adds."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without)).alias("row")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects."""
    boxed = docs.select(box(docs), "doc_id", "text", "source", "lang")
    scored = cotraining.quality_classifier(boxed, table(spark, sf_dir, "labels"))
    return scored.where("accepted").select("row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return jaccard.representatives(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id has; documents that were all copy go."""
    boxed = docs.select(box(docs, "text"), "doc_id", "text")
    kept = recompression.substring_dedup(boxed, REPEAT_WORDS, keep_text=True)
    left = kept.where("n_removed = 0 or n_removed < n_words")
    changed = {
        "text": F.col("text"),
        "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return left.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids and the checksum of these."""
    pieces = packing.pack(docs, tokenizer_path(), kept_pieces=100_000)  # other stages need the memory too
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


# Passages of at least this many words are repeats.
REPEAT_WORDS = 30

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", distinct_documents),
    ("substring_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

# No SQL: a trained classifier and a tokenizer are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another; what each returns is written below ``spark.checkpoint.dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
