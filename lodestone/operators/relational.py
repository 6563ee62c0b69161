"""The corpus as related tables with running ids, and full-text search over its sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from .ordering import number_rows

#: Accents are folded, as full-text tables do by default.
_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_TO = "aaaaaaceeeeiiiinooooouuuuyy"


def documents_table(documents: DataFrame, attachments: DataFrame) -> DataFrame:
    """One row an address, of pages and attachments; the last of several wins.

    Both have ``ord``; attachments follow pages.
    """
    text = lambda df, c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")

    def rows(df: DataFrame, kind: str, group: int) -> DataFrame:
        path = F.concat_ws("/", "section_path") if "section_path" in df.columns else F.lit("")
        crumbs = F.concat_ws(" > ", "breadcrumbs") if "breadcrumbs" in df.columns else F.lit("")
        words = F.coalesce(F.col("word_count").cast("long"), F.lit(0)) if "word_count" in df.columns else F.lit(0).cast("long")
        return df.select("url", F.coalesce("source_url", "url").alias("source_url"), text(df, "title").alias("title"), text(df, "language").alias("language"), F.lit(kind).alias("doc_type"), path.alias("section_path"), crumbs.alias("breadcrumbs"), text(df, "fetched_at").alias("fetched_at"), text(df, "content_hash").alias("content_hash"), words.alias("word_count"), text(df, "text").alias("text"), F.struct(F.lit(group).alias("g"), F.col("ord").cast("long").alias("o")).alias("_at"))

    both = rows(documents, "page", 0).unionByName(rows(attachments, "pdf", 1))
    cols = [c for c in both.columns if c not in ("url", "_at")]
    return both.groupBy("url").agg(F.max_by(F.struct(*cols), "_at").alias("r")).select("url", "r.*")


def sections_table(documents: DataFrame, attachments: DataFrame) -> DataFrame:
    """``id, url, heading, level, anchor, citation, text``: all sections, then each attachment as one, ids from 1."""
    s = F.col("s")
    pages = documents.select("url", F.col("ord").cast("long").alias("ord"), F.posexplode("sections").alias("pos", "s")).select(
        F.struct(F.lit(0).alias("g"), "ord", "pos").alias("_at"), "url", F.coalesce(s["heading"], F.lit("")).alias("heading"), F.coalesce(s["level"].cast("long"), F.lit(0)).alias("level"), s["anchor"].alias("anchor"), U.citation(F.col("url"), s["anchor"]).alias("citation"), F.coalesce(s["text"], F.lit("")).alias("text")
    )
    files = attachments.select(F.struct(F.lit(1).alias("g"), F.col("ord").cast("long").alias("ord"), F.lit(0).alias("pos")).alias("_at"), "url", F.coalesce("title", F.lit("")).alias("heading"), F.lit(0).cast("long").alias("level"), F.lit(None).cast("string").alias("anchor"), F.col("url").alias("citation"), F.coalesce("text", F.lit("")).alias("text"))
    numbered, _ = number_rows(pages.unionByName(files), ["_at", "url"], "id", 1)
    return numbered.select("id", "url", "heading", "level", "anchor", "citation", "text")


def tables_table(documents: DataFrame) -> DataFrame:
    """``id, url, caption, headers, n_rows, markdown`` with ids from 1; headers as JSON."""
    t = F.col("t")
    rows = documents.select("url", F.col("ord").cast("long").alias("ord"), F.posexplode("tables").alias("pos", "t"))
    rows = rows.select(F.struct("ord", "pos").alias("_at"), "url", t["caption"].alias("caption"), F.to_json(F.coalesce(t["headers"], F.array().cast("array<string>"))).alias("headers"), F.coalesce(F.size(t["rows"]), F.lit(0)).cast("long").alias("n_rows"), F.coalesce(t["markdown"], F.lit("")).alias("markdown"))
    numbered, _ = number_rows(rows, ["_at", "url"], "id", 1)
    return numbered.select("id", "url", "caption", "headers", "n_rows", "markdown")


def fold(text: Column) -> Column:
    """Terms of a text: runs of letters and digits, lower case, without accents."""
    return F.regexp_extract_all(F.translate(F.lower(F.coalesce(text, F.lit(""))), _FROM, _TO), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(sections: DataFrame) -> DataFrame:
    """``term, id, in_heading, in_text``: the inverted index over headings and texts, to be stored as a table."""
    term = lambda c, name: F.transform(F.array_distinct(fold(F.col(c))), lambda t: F.struct(t.alias("term"), F.lit(name).alias("col")))
    rows = sections.select("id", F.explode(F.concat(term("heading", "h"), term("text", "t"))).alias("x"))
    return rows.groupBy(F.col("x.term").alias("term"), "id").agg(F.max(F.col("x.col") == "h").alias("in_heading"), F.max(F.col("x.col") == "t").alias("in_text"))


def search(index: DataFrame, sections: DataFrame, queries: DataFrame, query_id: str = "query_id", query_text: str = "query") -> DataFrame:
    """``query_id, id, url, citation, heading, text`` of sections that hold every word of the query, in either column."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.array_distinct(fold(F.col(query_text))).alias("words")).select("query_id", F.size("words").alias("n"), F.explode("words").alias("term"))
    hits = index.join(asked, "term").groupBy("query_id", "id", "n").agg(F.count("*").alias("hits")).where("hits = n").select("query_id", "id")
    return hits.join(sections.select("id", "url", "citation", "heading", "text"), "id")


def snippet(text: Column, words: Column, around: int = 12) -> Column:
    """The part of a text, of ``around`` words, that begins where a query word comes first; hits in brackets.

    ``words`` are folded terms; text that is left out at either end shows as dots.
    """
    tokens = F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")
    hit = lambda t: F.size(F.array_intersect(fold(t), words)) > 0
    places = F.filter(F.transform(tokens, lambda t, i: F.when(hit(t), i)), lambda i: i.isNotNull())
    start = F.greatest(F.lit(0), F.least(F.coalesce(F.try_element_at(places, F.lit(1)), F.lit(0)), F.size(tokens) - around))
    part = F.transform(F.slice(tokens, start + 1, around), lambda t: F.when(hit(t), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t))
    return F.concat(F.when(start > 0, "...").otherwise(""), F.array_join(part, " "), F.when(start + around < F.size(tokens), "...").otherwise(""))


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_n = 1").drop("_n")
