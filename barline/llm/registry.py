"""The queries of this subpackage, op<N>_<name>, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, divergence, mixing, ranked_search
from .decontaminate import decontaminate
from .fingerprints import fingerprint_versions
from .langid import language_id
from .licenses import license_scan
from .neighbours import nearest_neighbours
from .ngram_join import jaccard_components
from .quality import quality_scores
from .substring_dedup import substring_dedup
from .suffix_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest_conversations(chat.format_conversations(chat.with_control_strings(table(spark, sf_dir, "conversations"))))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("rid", "component")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_versions(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    named = (
        op1_license_scan,
        op2_chat_format,
        op3_mix_sources,
        op4_ngram_jaccard_join,
        op5_decontaminate,
        op6_suffix_array_dedup,
        op7_quality_classifier,
        op8_language_id,
        op9_fingerprints,
        op10_substring_dedup,
        op11_source_divergence,
        op12_ranked_search,
        op13_nearest_neighbours,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": chat.ORACLE_SQL, "op3_mix_sources": mixing.ORACLE_SQL, "op11_source_divergence": divergence.ORACLE_SQL, "op12_ranked_search": ranked_search.ORACLE_SQL}
