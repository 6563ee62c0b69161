"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from . import common as C
from . import attention_lm, jaccard_join, media, packing, piece_codec, quality, site_templates, substring_dedup, suffix_dedup, toxicity


def op1_site_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return site_templates.main_texts(C.read(spark, sf_dir, "pages"))


def op2_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens, a row per piece."""
    return packing.pack_documents(C.read(spark, sf_dir, "documents"), window=2048)


def op3_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document: base counts and divergence from language references."""
    return quality.judge(C.read(spark, sf_dir, "documents"))


def op4_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from labelled rows that are not held out."""
    return toxicity.toxicity(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five-word shingles, Jaccard 0.8 or more."""
    return jaccard_join.near_duplicates(C.read(spark, sf_dir, "documents"), threshold=80, shingle=5)


def op6_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention-model and unigram scores of every whole text."""
    return attention_lm.score_documents(C.read(spark, sf_dir, "documents"))


def op7_sentencepiece_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text by suffix-array matching: counts, digest and round trip."""
    return piece_codec.encode_documents(C.read(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op8_media_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as chunked, deduplicated media, read back, verified and measured."""
    return media.media_columns(C.read(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing repeated 35-word windows, for every document."""
    return substring_dedup.remove_repeats(C.read(spark, sf_dir, "documents"), window=35).drop("kept_text")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left after removing 100-byte strings with an earlier occurrence, for every document."""
    return suffix_dedup.remove_earlier(C.read(spark, sf_dir, "documents"), length=100).drop("kept_text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_site_template_removal": op1_site_template_removal,
        "op2_hierarchical_packing": op2_hierarchical_packing,
        "op3_distribution_divergence": op3_distribution_divergence,
        "op4_toxicity_ftrl": op4_toxicity_ftrl,
        "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
        "op6_attention_lm": op6_attention_lm,
        "op7_sentencepiece_suffix_array": op7_sentencepiece_suffix_array,
        "op8_media_chunking": op8_media_chunking,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_suffix_array_dedup": op10_suffix_array_dedup,
    }


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return oracles.sql()
