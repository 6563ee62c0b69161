"""Responses that are not content: what a site answers to impossible addresses, and who else gives it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import text as T


def examined(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with visible text, its hash and word count, response class and interstitial flags."""
    seen = pages.withColumn("visible", K.visible_text(F.coalesce(F.col(html), F.lit(""))))
    visible = F.col("visible")
    return (
        seen.withColumn("text_hash", K.text_hash(visible))
        .withColumn("words", F.when(F.col(html).isNull(), F.lit(-1).cast("long")).otherwise(T.word_count(visible)))
        .withColumn("response", K.response_class(visible, F.coalesce(F.col(html), F.lit(""))))
        .withColumn("flags", K.challenge_flags(visible, F.coalesce(F.col(html), F.lit(""))))
    )


def learn(probes: DataFrame) -> DataFrame:
    """``kind, text_hash, words, sample``: fingerprints of ``probes(url, status, html)``.

    A probe asks for an address that cannot exist.  It teaches a soft not-found page only
    if it came with status 200 and says so; a block page is learned as such, as it tells
    nothing about the address.  Pages of one hash are one row.
    """
    rows = examined(probes)
    kind = F.when(F.col("response") == "blocked", "blocked").when((F.col("status") == 200) & (F.col("response") == "not_found"), "soft_404")
    return rows.withColumn("kind", kind).where("kind is not null").groupBy("kind", "text_hash").agg(F.min("words").alias("words"), F.min(F.substring("visible", 1, 300)).alias("sample"))


def content_pages(pages: DataFrame, learned: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without blocked ones and soft not-found ones.

    ``pages`` may bring flags ``blocked`` and ``soft_404`` of the crawl.  Where soft
    not-found fingerprints were learned they alone decide, else the wording does; block
    fingerprints add to the markers.  ``learned`` has a row for each of a few probes and
    is joined by hash.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in pages.columns else F.lit(False)
    rows = examined(pages, html)
    kinds = learned.groupBy("text_hash").agg(F.max(F.col("kind") == "blocked").alias("_block"), F.max(F.col("kind") == "soft_404").alias("_soft"))
    any_soft = learned.agg(F.count_if(F.col("kind") == "soft_404").alias("n")).select("n").scalar() > 0
    rows = rows.join(kinds, "text_hash", "left")
    blocked = flag("blocked") | F.coalesce("_block", F.lit(False)) | (F.col("response") == "blocked")
    soft = flag("soft_404") | F.when(any_soft, F.coalesce("_soft", F.lit(False))).otherwise(K.looks_not_found(F.col("visible")))
    return rows.where(~blocked & ~soft).select(pages.columns)


def clusters(pages: DataFrame, html: str = "html", key: str = "url", examples: int = 8) -> DataFrame:
    """Bodies that several pages share, largest first: ``text_hash, n, words, flags, not_found, sample, first_urls``.

    Unrelated addresses with one body are a template in place of content.
    """
    rows = examined(pages.where(F.col(html).isNotNull()), html)
    groups = rows.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("words").alias("words"), F.min(F.array_join("flags", ",")).alias("flags"), F.max(K.looks_not_found(F.col("visible"))).alias("not_found"), F.min(F.substring("visible", 1, 800)).alias("sample"))
    shared = groups.where("n > 1")
    from .attachments import first_rows

    first = first_rows(rows.select("text_hash", key).join(shared.select("text_hash"), "text_hash"), "text_hash", [key], examples)
    first = first.groupBy("text_hash").agg(F.array_sort(F.collect_list(key)).alias("first_urls"))
    return shared.join(first, "text_hash").orderBy(F.desc("n"), "text_hash")


def unique_bodies(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row: ``pages, bodies, unique_bodies``."""
    counts = examined(pages.where(F.col(html).isNotNull()), html).groupBy("text_hash").agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pages"), F.count("*").alias("bodies"), F.count_if(F.col("n") == 1).alias("unique_bodies"))
