"""Link graph: edges, inbound counts, breadth-first levels, runs of blocked fetches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import number_rows


def edges(manifest: DataFrame, url: str = "url", links: str = "outlinks") -> DataFrame:
    return manifest.select(F.col(url).alias("source_url"), F.posexplode(links).alias("link_ord", "target_url"))


def inbound(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.groupBy("target_url").agg(F.count("*").alias("n_inbound"))


def bfs(seeds: DataFrame, edge_rows: DataFrame, max_depth: int, max_pages: int | None = None, leaves: DataFrame | None = None) -> DataFrame:
    """``url, depth, parent, place``: each page once, at its first depth, by its first discoverer.

    ``seeds(url, ord)``, ``edge_rows(source_url, link_ord, target_url)``.  ``leaves(url)``
    are pages whose links are not followed (attachments, soft not-found pages).  ``place``
    is the order of discovery from 0; with ``max_pages`` only the first so many are kept.
    A page's parent is its discoverer that comes first, by place and then by link.  One
    join and one anti-join a level; only the new level is written, so a round's cost is
    that of its frontier and of the keys already seen.
    """
    first = seeds.groupBy("url").agg(F.struct(F.min("ord").cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("via")).withColumn("parent", F.lit(None).cast("string"))
    level, n = _numbered(first, 0, 0)
    levels = [level]
    for depth in range(1, max_depth + 1):
        if max_pages is not None and n >= max_pages:
            break
        open_pages = level if leaves is None else level.join(leaves.select("url"), "url", "left_anti")
        found = open_pages.select(F.col("url").alias("source_url"), "place").join(edge_rows, "source_url")
        found = found.select(F.col("target_url").alias("url"), F.struct(F.col("place").alias("a"), F.col("link_ord").cast("long").alias("b")).alias("via"), F.col("source_url").alias("parent"))
        new = found.groupBy("url").agg(F.min_by("parent", "via").alias("parent"), F.min("via").alias("via"))
        for seen in levels:
            new = new.join(seen.select("url"), "url", "left_anti")
        level, grown = _numbered(new, depth, n)
        if grown == n:
            break
        levels.append(level)
        n = grown
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out if max_pages is None else out.where(F.col("place") < max_pages)


def _numbered(rows: DataFrame, depth: int, start: int) -> tuple[DataFrame, int]:
    """``url, depth, parent, place`` of one level, written, with dense places from ``start``; and the next place."""
    numbered, total = number_rows(rows.select("url", "parent", "via"), ["via", "url"], "place", start)
    return numbered.select("url", F.lit(depth).alias("depth"), "parent", "place"), total


def blocked_runs(fetches: DataFrame, part: str, order: list[str], blocked: str) -> DataFrame:
    """Each run of consecutive blocked fetches: first and last place and its length."""
    w = Window.partitionBy(part).orderBy(*order)
    numbered = fetches.withColumn("n", F.row_number().over(w)).withColumn("k", F.row_number().over(Window.partitionBy(part, blocked).orderBy(*order)))
    return numbered.where(blocked).groupBy(part, (F.col("n") - F.col("k")).alias("run")).agg(F.min("n").alias("first_n"), F.max("n").alias("last_n"), F.count("*").alias("length")).drop("run")


def before_stop(fetches: DataFrame, part: str, order: list[str], blocked: str, limit: int = 3) -> DataFrame:
    """Fetches that happen before ``limit`` blocked ones in a row stop the crawl."""
    runs = blocked_runs(fetches, part, order, blocked).where(F.col("length") >= limit).groupBy(part).agg(F.min(F.col("first_n") + limit - 1).alias("stop"))
    numbered = fetches.withColumn("n", F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    return numbered.join(runs, part, "left").where(F.col("stop").isNull() | (F.col("n") <= F.col("stop"))).drop("stop", "n")
