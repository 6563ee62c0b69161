"""From raw documents to packed training sequences, a stage after the other.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns they were
given, those of ``documents`` and any other, whatever its name.  Every stage reads its
input several times, so ``run`` writes each stage's rows to the shared checkpoint folder
before the next one starts; that also cuts the lineage, so a lost executor costs one stage.

Null texts are empty texts and fail the quality rules, so they end there.  Rows with a
null id are kept by every stage but are never linked or learned from.  Rows of one id and
equal text are reduced to one by the near-duplicate stage.  Very long texts are processed
whole.  An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm import common as C
from lodestone.llm import jaccard_join, packing, quality, suffix_dedup, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from ``labels``, does not reject.

    Without labels nothing is known to be toxic, and scores of 0.5 would reject all: then
    every document stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, labels)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language reference."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates, and all rows without an id.

    Rows of one id and equal texts are reduced to one; other texts of that id stay.
    """
    groups = jaccard_join.near_duplicates(docs.select("doc_id", "text"))
    stay = C.cut(groups.where("doc_id = component_id").select("doc_id").distinct())
    kept = docs.join(stay, "doc_id", "left_semi").select(docs.columns)
    # rows of one id lie together after the join, so this only sorts
    mark = C.unused("place", docs.columns)
    place = F.row_number().over(Window.partitionBy("doc_id", F.sha2("text", 256)).orderBy(F.lit(0)))
    once = kept.withColumn(mark, place).where(F.col(mark) == 1).drop(mark)
    return once.union(docs.where("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that occur earlier; ``n_chars`` follows the text."""
    left = suffix_dedup.dedup_texts(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: A trained model decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = C.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
