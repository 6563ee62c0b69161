"""Lexical ranking: postings, term statistics, BM25, and AND search.

A query batch is a DataFrame.  Postings are one row per (document, term); a query joins
its few terms to them, so the cost follows the posting lists of those terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut

K1, B = 1.5, 0.4
BOILERPLATE_SHARE, BOILERPLATE_MIN_DOCS = 0.35, 25
#: Different query terms up to which they are sent to every executor.
BROADCAST_QUERY_TERMS = 200_000


def with_tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), T.tokenize(F.col(text_col)).alias("tokens"))


def postings(tokens: DataFrame) -> DataFrame:
    """``doc_id, term, tf``: one group per document and term, combined before the shuffle."""
    return tokens.select("doc_id", F.explode("tokens").alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def doc_lengths(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", F.size("tokens").cast("long").alias("doc_len"))


def corpus_stats(lengths: DataFrame) -> DataFrame:
    """One row: ``n_docs, avg_len``; documents without tokens count."""
    return lengths.agg(F.count("*").alias("n_docs"), F.coalesce(F.avg("doc_len"), F.lit(0.0)).alias("avg_len"))


def term_stats(posts: DataFrame, stats: DataFrame) -> DataFrame:
    """``term, df, idf, is_boilerplate``."""
    n = stats.select("n_docs").scalar()
    df = posts.groupBy("term").agg(F.count("*").alias("df"))
    return df.select(
        "term",
        "df",
        F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"),
        ((n >= BOILERPLATE_MIN_DOCS) & (F.col("df") / n > BOILERPLATE_SHARE)).alias("is_boilerplate"),
    )


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``query_id, term, qtf``: a term that is asked twice counts twice."""
    return queries.select(F.col(id_col).alias("query_id"), F.explode(T.tokenize(F.col(text_col))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def asked_postings(docs: DataFrame, terms: DataFrame, doc_id: str, doc_text: str) -> DataFrame:
    """``doc_id, term, tf, doc_len`` of the asked ``terms(term)``, and a row with a null term for each document.

    Written once, as it is read for lengths, for document frequencies and for scores; a
    term that nobody asks for leaves before the shuffle.
    """
    tokens = docs.select(F.col(doc_id).alias("doc_id"), T.tokenize(F.col(doc_text)).alias("tokens"))
    marked = F.concat(F.array(F.lit(None).cast("string")), F.col("tokens"))
    rows = tokens.select("doc_id", F.size("tokens").cast("long").alias("doc_len"), F.explode(marked).alias("term"))
    few = terms.limit(BROADCAST_QUERY_TERMS + 1).count() <= BROADCAST_QUERY_TERMS
    wanted = terms.select(F.col("term").alias("_asked"))
    kept = rows.join(F.broadcast(wanted) if few else wanted, F.col("term") == F.col("_asked"), "left").where(F.col("term").isNull() | F.col("_asked").isNotNull())
    return cut(kept.groupBy("doc_id", "term").agg(F.count("*").alias("tf"), F.max("doc_len").alias("doc_len")))


def bm25_scores(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", query_id: str = "query_id", query_text: str = "query") -> DataFrame:
    """``query_id, doc_id, score`` of every document with a positive score; ``doc_id`` tells documents apart."""
    asked = query_terms(queries, query_id, query_text)
    return score_postings(asked_postings(docs, asked.select("term").distinct(), doc_id, doc_text), asked)


def score_postings(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """BM25 of ``asked(query_id, term, qtf)`` over rows as ``asked_postings`` gives them, or an index stores them."""
    stats = corpus_stats(rows.where("term is null"))
    posts = rows.where("term is not null")
    terms = term_stats(posts, stats).where(~F.col("is_boilerplate")).select("term", "idf").join(asked, "term")
    avg = stats.select("avg_len").scalar()
    weight = F.col("qtf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / avg))
    return posts.join(terms, "term").groupBy("query_id", "doc_id").agg(F.sum(weight).alias("score")).where("score > 0")


def top_k(scores: DataFrame, k: int, tie: str = "doc_id") -> DataFrame:
    """The best ``k`` of each query with their rank; ties by ``tie``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(tie))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def and_search(docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", query_id: str = "query_id", query_text: str = "query") -> DataFrame:
    """``query_id, doc_id`` where the document holds all words of the query (folded to lower case)."""
    fold = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    words = queries.select(F.col(query_id).alias("query_id"), fold(query_text).alias("words")).select("query_id", F.size("words").alias("n"), F.explode("words").alias("word"))
    posts = docs.select(F.col(doc_id).alias("doc_id"), F.explode(fold(doc_text)).alias("word"))
    return posts.join(words, "word").groupBy("query_id", "doc_id", "n").agg(F.count("*").alias("hits")).where("hits = n").select("query_id", "doc_id")


def highlight(text, word, around: int = 40):
    """A bracketed first hit of ``word`` (a string or a column) with some text on both sides."""
    word = F.lower(F.lit(word) if isinstance(word, str) else word)
    at = F.expr("1") * F.instr(F.lower(text), word)
    start = F.greatest(F.lit(1), at - around)
    end = at + F.length(word)
    piece = F.concat(F.when(start > 1, "...").otherwise(""), F.substring(text, start, at - start), F.lit("["), F.substring(text, at, F.length(word)), F.lit("]"), F.substring(text, end, F.lit(around)), F.when(end + around <= F.length(text), "...").otherwise(""))
    return F.when(at > 0, piece)
