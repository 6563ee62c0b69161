"""Incremental ingest: new landing files become documents, each address once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

LANDING = "url string, text string, fetched_at timestamp"


def landing_stream(spark: SparkSession, path: str, schema: str = LANDING) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def new_documents(stream: DataFrame, delay: str = "7 days", min_words: int = 20) -> DataFrame:
    """First arrival of each canonical address within ``delay`` of the newest event, long enough to keep."""
    rows = stream.withColumn("url", U.canon_url(F.col("url"))).withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["url"])
    return rows.withColumn("word_count", T.word_count(F.col("text"))).where(F.col("word_count") >= min_words).withColumn("content_hash", T.content_hash(F.col("text")))


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Start the query that appends documents as Parquet and ends when the input is used up."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def fetch_rates(stream: DataFrame, window: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Fetches per window, for watching a crawl."""
    return stream.withWatermark("fetched_at", delay).groupBy(F.window("fetched_at", window)).agg(F.count("*").alias("n"))
