"""Bringing a crawl up to date: what to fetch again, and writing results back into the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import text as T
from ..functions import urls as U
from . import html as H


def choose(manifest: DataFrame, urls: list[str] | None = None, pattern: str | None = None, unrendered: bool = False, limit: int | None = None) -> DataFrame:
    """``url`` of the rows to fetch again: named ones, those that match, those that look unrendered; in scope, in order."""
    test = F.lit(False)
    spark = manifest.sparkSession
    if pattern:
        test = test | F.col("url").rlike(pattern)
    if unrendered:
        test = test | F.coalesce("looks_unrendered", F.lit(False))
    found = manifest.where(test).select("url")
    if urls:
        found = found.union(spark.createDataFrame([(u,) for u in urls], "url string").select(U.canon_url(F.col("url")).alias("url")))
    found = found.where(U.in_scope(F.col("url"))).distinct().orderBy("url")
    return found if limit is None else found.limit(limit)


def cache_split(urls: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of ``urls(url)`` against a raw store ``(url_key, html, meta...)``.

    A hit has both its record and its body; the flags of earlier renderings and imports
    are not handed on.
    """
    keyed = urls.withColumn("url_key", U.url_key(U.canon_url(F.col("url"))))
    bodies = store.where(F.col("html").isNotNull()).drop(*[c for c in ("rendered", "imported_from", "url") if c in store.columns])
    one = bodies.dropDuplicates(["url_key"])
    return keyed.join(one, "url_key"), keyed.join(one.select("url_key"), "url_key", "left_anti")


def unrendered(html) -> F.col:
    return F.length(K.visible_text(html)) < 400


def write_rendered(manifest: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """``manifest`` with the rows of ``results(url, html, final_url, raw_path)`` brought up to date.

    ``manifest`` has ``ord``; every row keeps its place.  Links and the unrendered flag
    come from the rendered page; ``words_before`` is what the last rendering had.
    """
    final = F.coalesce("final_url", "url")
    new = results.select(
        "url",
        F.lit(True).alias("_hit"),
        F.col("raw_path").alias("_raw_path"),
        final.alias("_final_url"),
        T.word_count(K.visible_text(F.col("html"))).cast("int").alias("_words"),
        unrendered(F.col("html")).alias("_unrendered"),
        H.native_links(F.col("html"), final).alias("_outlinks"),
    )
    hit = F.coalesce("_hit", F.lit(False))
    put = lambda c, value: F.when(hit, value).otherwise(F.col(c)).alias(c)
    changes = {
        "raw_path": F.col("_raw_path"), "final_url": F.col("_final_url"), "fetched_at": F.lit(now), "status": F.lit(200), "error": F.lit(None).cast("string"), "content_type": F.lit("text/html; charset=utf-8"),
        "rendered": F.lit(True), "words_before": F.col("words_after"), "words_after": F.col("_words"), "looks_unrendered": F.col("_unrendered"), "outlinks": F.col("_outlinks"),
    }
    joined = manifest.join(new, "url", "left")
    return joined.select(*[put(c, changes[c]) if c in changes else F.col(c) for c in manifest.columns])


def render_gain(before: DataFrame, results: DataFrame, thin: int = 80) -> DataFrame:
    """One row: how many pages were rendered, gained text, and are still thin.  ``before(url, words)``."""
    after = results.select("url", T.word_count(K.visible_text(F.col("html"))).alias("after"))
    rows = after.join(before.select("url", "words"), "url", "left").withColumn("words", F.coalesce("words", F.lit(0)))
    return rows.agg(F.count("*").alias("rendered"), F.count_if(F.col("after") > F.col("words")).alias("improved"), F.count_if(F.col("after") < thin).alias("still_thin"))


REFETCHED = ["final_url", "status", "error", "content_type", "kind", "raw_path", "fetched_at"]


def write_refetched(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """``manifest`` with ``results`` (REFETCHED, url, html) written over it; new addresses at the end.

    Matched rows keep their place and what the fetch does not tell; new ones follow in
    order of address.  A file that is no page has no unrendered flag.
    """
    page = (F.col("kind") == "html") & F.col("status").between(200, 299) & F.col("error").isNull() & F.col("html").isNotNull()
    new = results.select("url", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in REFETCHED], page.alias("_page"), F.when(page, H.native_links(F.col("html"), F.coalesce("final_url", "url"))).alias("_outlinks"), F.when(page, unrendered(F.col("html"))).when(F.col("kind") != "html", F.lit(False)).alias("_unrendered"))
    joined = manifest.join(new, "url", "full_outer")
    hit = F.coalesce("_hit", F.lit(False))
    last = manifest.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("m")).select("m").scalar()
    out = []
    for c in manifest.columns:
        if c in REFETCHED:
            value = F.when(hit, F.col(f"_{c}")).otherwise(F.col(c))
        elif c == "outlinks":
            value = F.coalesce(F.when(hit, F.col("_outlinks")), F.col(c), F.when(hit, F.array().cast("array<string>")))
        elif c == "looks_unrendered":
            value = F.coalesce(F.when(hit, F.col("_unrendered")), F.col(c))
        elif c == "refetched":
            value = F.when(hit, F.lit(True)).otherwise(F.col(c))
        elif c == "from_cache":
            value = F.when(hit, F.lit(False)).otherwise(F.col(c))
        elif c == "depth":
            value = F.coalesce(F.col(c), F.lit(0))
        elif c == "ord":  # new rows share the place behind the last; their address tells them apart
            value = F.coalesce(F.col(c), last + 1)
        else:
            value = F.col(c)
        out.append(value.alias(c))
    return joined.select(*out)


def inspect(manifest: DataFrame, store: DataFrame) -> DataFrame:
    """What is wrong with each manifest row: ``url, size_bytes, words, problems``.

    ``store(url_key, html, rendered)`` is the raw store.  A row whose ``raw_path`` is not
    among the store's paths is one whose body is missing.
    """
    held = store.select("url_key", F.col("html").alias("_html"), F.coalesce("rendered", F.lit(False)).alias("_rendered"))
    rows = manifest.withColumn("url_key", U.url_key(F.col("url"))).join(held, "url_key", "left")
    words = F.when(F.col("_html").isNull(), -1).otherwise(T.word_count(K.visible_text(F.col("_html"))))
    rows = rows.withColumn("words", words.cast("long"))
    says = lambda c: F.coalesce(F.col(c), F.lit(False))
    tests = [
        ("no body", F.col("_html").isNull()),
        ("raw path missing", F.col("raw_path").isNotNull() & F.col("_html").isNull()),
        ("rendered, but the manifest does not say so", says("_rendered") & ~says("rendered")),
        ("stale unrendered flag", says("_rendered") & says("looks_unrendered") & (F.col("words") >= 400)),
        ("no visible words", F.col("words") == 0),
    ]
    problems = F.array_compact(F.array(*[F.when(test, name) for name, test in tests]))
    return rows.select("url", F.coalesce(F.octet_length("_html"), F.lit(0)).cast("long").alias("size_bytes"), "words", problems.alias("problems"))


def backoff_seconds(attempt, base: float = 2.0):
    """Pause before the next try of a failed request."""
    return F.pow(F.lit(2.0), attempt) * base


def block_pause_seconds(blocks, most: float = 60.0):
    """Pause after so many blocks in a row."""
    return F.least(F.lit(most), F.pow(F.lit(2.0), blocks) * 5)
