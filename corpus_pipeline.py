"""The corpus pipeline over `documents`: reject low quality, keep one of each group of near duplicates, redact secrets, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import near_dedup, packing, quality_knn, secret_scan
from lodestrata.llm.common import Scratch, read

def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels that are not held out."""
    model = quality_knn.fit(docs, read(spark, sf_dir, "labels"))
    score = "_quality_score"
    while score in docs.columns:
        score += "_"
    return quality_knn.score(docs, model, score_col=score).where(F.col(score) >= 0.5).drop(score)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets redacted and n_chars counted again."""
    out = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document (doc_id, piece, start, length, ids_crc32) with their place in a sequence."""
    import public_tokenizers

    pieces = packing.tokenize(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality", quality), ("near_dedup", dedup), ("secrets", secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as a table that the next one reads and that goes when it has been read."""
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
    return docs


#: SQL can neither learn the classifier nor tokenize, so no stage has any; tests/llm holds the brute-force version.
ORACLE_SQL = None
