"""The corpus pipeline: documents in, packed token sequences out.

Each stage works on all that its predecessor kept; all but the last return the columns of ``documents`` and any extra ones.

Defined results, by stage and as the operators' own modules say: null and empty texts are judged, grouped with each other,
left as they are, and packed as the end id alone; rows are told apart by doc_id and text, so rows that share a doc_id go
or stay by their own text, and rows equal in both go together; a null doc_id is never a near duplicate; very long texts go
through whole; of ties the smallest doc_id stays; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coevo.llm import importance, packing, registry, secrets, simhash, suffix_dedup
from coevo.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    return importance.keep(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their five-word shingles the one with the smallest doc_id stays."""
    return simhash.keep_similar(docs, words=5, threshold=0.8)


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes and more go; n_chars follows the text."""
    return _recounted(suffix_dedup.without_repeats(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; n_chars follows it."""
    return _recounted(secrets.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in a sequence."""
    pieces = packing.tokenize_pieces(docs, registry.tokenizer_path())
    return packing.pack_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages have no SQL form; tests/llm holds each against a brute-force version.
ORACLE_SQL = None
