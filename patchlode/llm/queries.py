"""Registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .archives import round_trip
from .chat_tree import format_tree, read_tree
from .decontaminate import find_contamination
from .frames import table
from .langid import fit_language_model, identify_languages
from .minhash import near_duplicates
from .neighbours import nearest
from .packing import pack
from .resampling import importance_resample
from .sharding import interleaved_shards
from .superkmers import remove_repeats
from .toxicity import fit_toxicity, score_toxicity
from .vector_codes import compress_vectors, label_errors
from .wrappers import extract_main_text


def vocabulary() -> tuple[str, str]:
    """The installed tokenizer's file, and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("k1", "k2", "component_group")


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("k1", "k2")


def op3_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_toxicity(docs, fit_toxicity(docs, labels))


def op4_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages")).drop("payload", "url")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, fit_language_model(docs))
    return found.select("rest.doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), *vocabulary())


def op8_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "rest.doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op9_interleaved_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleaved_shards(table(spark, sf_dir, "documents"), shards=24)


def op10_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op11_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts consist of the template's own control strings."""
    said = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    json_path, ranks_path = vocabulary()
    return read_tree(format_tree(conversations, json_path, ranks_path), ranks_path, in_order=True)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, n=2, buckets=10_000, seed=7)
    return found.drop("k1", "k2", "n_words")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress_vectors(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    rows = label_errors(found.rows)
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_kneser_ney_toxicity": op3_kneser_ney_toxicity,
    "op4_zip_warc": op4_zip_warc,
    "op5_language_id": op5_language_id,
    "op6_multiprobe_neighbours": op6_multiprobe_neighbours,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_super_kmer_dedup": op8_super_kmer_dedup,
    "op9_interleaved_sharding": op9_interleaved_sharding,
    "op10_wrapper_extraction": op10_wrapper_extraction,
    "op11_chat_tree": op11_chat_tree,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_vector_codes": op13_vector_codes,
}
SQL: dict[str, str] = {
    "op1_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op4_zip_warc": oracles.ARCHIVES,
    "op8_super_kmer_dedup": oracles.SUPER_KMERS,
    "op9_interleaved_sharding": oracles.SHARDS,
    "op11_chat_tree": oracles.CHAT,
    "op12_importance_resampling": oracles.RESAMPLING,
    "op13_vector_codes": oracles.VECTOR_CODES,
}
