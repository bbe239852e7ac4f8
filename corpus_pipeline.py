"""From raw documents to token ids: language, exact copies, near copies, source mix, pieces.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
DataFrame, which :func:`run` writes as Parquet into the shared folder and
reads back as the next stage's documents.  All but the last return the columns
of ``documents``; the last returns each row's token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, language, mixing, near_dedup, pieces
from tidemark.llm.common import ROW, materialise, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return language.keep_identified(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest doc_id stays."""
    return near_dedup.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out towards the target mix of sources, in a global random order."""
    return mixing.mix_sources(docs).select(f"{ROW}.*")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row."""
    return pieces.encode_texts(docs, keep=("doc_id", "lang", "source"))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mix_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: Language models, min-hashes and piece segmentation are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
