"""The corpus pipeline: language ID, near-duplicate removal, repeated passages, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir) and returns documents; all but the last return the columns they
were given.  ``run`` writes each stage's result to the shared folder and reads it again for the next; a
result that the next stage has taken over is removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from barline.llm import decontaminate, langid, mixing, ngram_join, repeats, suffix_dedup
from barline.llm.shared import remove_folder, shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with no text or no letter go, and no others; one without a lang gets the language that is
    predicted.  If there is no language to learn, lang stays null and documents stay."""
    marked = docs.where(langid.has_letter()).select(F.struct(*docs.columns).alias("row"), "text")
    found = langid.identify(marked, langid.fit(docs), ("row",))
    lang = F.coalesce(F.col("row.lang"), F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred")))
    return found.select(*[(lang if c == "lang" else F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 256 bytes or more that stand more than once go out of the texts: 51 words have about 320
    bytes, so passages of over 50 words go."""
    return repeats.with_new_text(suffix_dedup.remove_repeats(docs, suffix_dedup.PASSAGE, with_text=True), docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of words that stand in the benchmark go out of the texts."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return repeats.with_new_text(decontaminate.decontaminate(docs, benchmark, with_text=True), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("decontaminate", benchmark_leaks),
    ("mix_sources", mix),
]

# Several stages cannot be said in SQL; tests hold the whole against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
            if k:
                remove_folder(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
