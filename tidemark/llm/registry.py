"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import alignment, decontamination, exact_dedup, hamming, infilling, language, licences, mixing, near_dedup, pieces, secrets, sharding, substrings
from tidemark.llm.common import ROW, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, whether both libraries agree, and whether decoding gives the text back."""
    return pieces.encode_texts(table(spark, sf_dir, "documents"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy that the mix holds: doc_id, source, copy, n_copies, shuffle_key (its place in the global order)."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(f"{ROW}.doc_id", f"{ROW}.source", "copy", "n_copies", "shuffle_key")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


def op6_shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(F.col(f"{ROW}.doc_id"), "slot", "shard")


def op7_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest codes of every vector whose id is divisible by 50, against all rows: query_id, rank, vec_id, distance."""
    return hamming.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: doc_id, class_id, class_size, kept."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).drop("digest")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers meet in every text, and how common its pairs are in the corpus."""
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, and in how many items' neighbourhoods it has a part (n_near)."""
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=decontamination.NEAR)
    listed = F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")
    counts = [F.size(c).cast("bigint").alias(name) for c, name in (("items", "n_items"), ("near_items", "n_near"))]
    return found.select("doc_id", "n_words", "n_hit", counts[0], listed, (F.col("n_hit") > 0).alias("contaminated"), counts[1])


def op13_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, sizes and digests of every text's fill-in-middle output and of the text rebuilt from it."""
    made = infilling.restore(infilling.fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_repeated_substrings, op2_secret_scan, op3_piece_codec, op4_poisson_mix, op5_licence_scan,
    op6_shard_placement, op7_nearest_codes, op8_near_dedup, op9_exact_dedup, op10_language_id,
    op11_alignment, op12_decontamination, op13_infilling,
)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_poisson_mix": mixing.ORACLE,
        "op5_licence_scan": licences.oracle(),
        "op6_shard_placement": sharding.oracle(),
        "op7_nearest_codes": hamming.ORACLE,
        "op9_exact_dedup": exact_dedup.ORACLE,
        "op12_decontamination": decontamination.ORACLE,
        "op13_infilling": infilling.ORACLE,
    }
