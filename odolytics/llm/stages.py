"""The training-data operators as filters of a corpus: documents in, documents out.

Each takes (spark, docs, sf_dir) and gives back the columns of ``docs`` as they were; ``n_chars``, if there is
one, follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolytics.llm import decontaminate, language, mixing, near_dup, suffix_dedup

LIKENESS = (80, 100)        # near copies from this similarity on count as one document


def least_score(languages: int) -> float:
    """The score that a claimed text exceeds: 0.5 (a margin of 0) for four languages.

    The margins of a text add up to about 2 - K for K languages, so the largest score is 1/K at least, whatever
    the text. The floor is a third of the way from there to 1. One language alone has nothing to compare with.
    """
    return (1 + 2 / languages) / 3 if languages > 1 else 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; text without letters and text no language claims goes.

    Learned from the labelled documents whose crc32(doc_id) modulo 3 is not 1.
    """
    rest = language.fold(F.col("doc_id"), 3)
    model = language.fit(docs.where(rest != 1).select(F.col("doc_id").alias("key"), F.col("lang").alias("label"), "text"))
    found = language.identify(docs, model)
    claimed = (F.col("lang") != language.UNKNOWN) & (F.col("score") > least_score(len(model.languages)))
    return found.where(claimed).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more), the one with the least id. All rows of
    an id share its fate."""
    found = near_dup.near_duplicates(docs, LIKENESS)
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def first_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id has; a text that is all gone goes."""
    others = tuple(c for c in docs.columns if c != "text")
    found = suffix_dedup.suffix_dedup(docs, carry=others)
    kept = found.where("n_bytes = 0 OR n_removed < n_bytes")
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[(columns[c] if c in columns else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = decontaminate.contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words from, whole, with their size, source's target and words taken. All rows of an
    id that differ in nothing are taken together."""
    mix = mixing.mix_sources(docs).where("taken > 0").select(
        F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("size").alias("words"), "source_size", "target", "taken"
    ).dropDuplicates()
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("words"))
    return sized.join(mix, same).select(*docs.columns, "size", "source_size", "target", "taken")
