"""Stages of the corpus pipeline: documents in, documents out; the last gives packed pieces.

Every stage works on all rows it gets. The columns of the input travel in one struct, so columns of any
name do no harm. Rows that repeat an id are treated by their own text; null ids are kept unless a stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import find_contamination
from .frames import row_key, table
from .langid import fit_language_model, identify_languages
from .minhash import near_duplicates
from .packing import pack
from .queries import vocabulary
from .superkmers import remove_repeats


def _rebuilt(found: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of ``docs`` from (rest, text), in their order, some of them replaced."""
    return found.select(*(
        (new[c] if c in new else F.col("text") if c == "text" else F.col("rest").getField(c)).alias(c) for c in docs.columns))


def _without(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows whose (k1, k2) is among the keys (left_semi) or not (left_anti)."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key("doc_id", "text"))
    return row.join(keys, ["k1", "k2"], how)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null texts, texts without letters and texts the
    model is unsure of go; without any labelled row to learn from, nothing can be rejected and all stay."""
    model = fit_language_model(docs)
    if not model.labels:
        return docs
    return _rebuilt(identify_languages(docs, model).where("not rejected"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that repeat an id and text one stays. A group without any id keeps one row; texts
    without words are linked to nothing and all stay.
    """
    found = near_duplicates(docs)
    kept = found.where("kept or component_id is null").dropDuplicates(["component_group"]).select("k1", "k2")
    return _without(docs, kept, "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated windows. Texts that lose nothing stay as they are; others are
    their kept words joined by one space, with n_chars to match; documents that lose every word go."""
    found = remove_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        n = F.when(F.col("n_removed") == 0, F.col("rest").getField("n_chars")).otherwise(F.length("kept_text"))
        new["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    return _rebuilt(found, docs, **new)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither as it is nor with other parameters."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark")).select("k1", "k2").distinct()
    return _without(docs, found, "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1024 tokens."""
    return pack(docs, *vocabulary())
