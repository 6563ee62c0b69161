"""A retrieval index that is built once and asked often: build, save, load, retrieve.

The index is a folder of Parquet tables: ``records`` (with ``record_ord``), ``vectors``,
``postings`` (a row a document and term, and one with a null term that carries the
document's length) and ``manifest``.  Asking reads posting lists of the asked terms only,
as ``postings`` is partitioned by a hash of the term.
"""

from __future__ import annotations

import json
import warnings
from dataclasses import asdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import classify as K
from .functions import text as T
from .operators import dense, lexical, quality, retrieve
from .operators.attachments import load_records

#: Folders of the postings table; a term lies in one of them.
TERM_PARTS = 64
STATUS_TEXT = {
    "ok": "",
    "no_results": "Nothing matched: the corpus may not hold it, or a filter left it out.",
    "low_confidence": "The best evidence is weak; treat it as not found.",
}


class IndexMissing(FileNotFoundError):
    """There is no index in the folder."""


def _term_part():
    return F.when(F.col("term").isNull(), -1).otherwise(F.pmod(F.xxhash64("term"), F.lit(TERM_PARTS))).cast("int")


def build(spark: SparkSession, records: DataFrame, path: str, embedder: dense.Embedder, cache: str | None = None) -> dict:
    """Write the index of ``records``; returns the build's figures.

    With ``cache`` only texts that no earlier build embedded in this space are embedded.
    """
    records.write.mode("overwrite").parquet(f"{path}/records")
    rows = spark.read.parquet(f"{path}/records")
    keyed = rows.select("record_ord", F.left(F.sha1("text"), F.lit(20)).alias("text_key"), "text")
    held = dense.load_cache(spark, cache, embedder.config) if cache else spark.createDataFrame([], "text_key string, vector array<double>")
    held = held.dropDuplicates(["text_key"])
    todo = keyed.join(held.select("text_key"), "text_key", "left_anti").groupBy("text_key").agg(F.first("text").alias("text"))
    embedder.passages(todo, "text_key", "text").withColumnRenamed("id", "text_key").write.mode("overwrite").parquet(f"{path}/fresh")
    fresh = spark.read.parquet(f"{path}/fresh")
    keyed.drop("text").join(held.unionByName(fresh), "text_key").select("record_ord", "vector").write.mode("overwrite").parquet(f"{path}/vectors")
    if cache:
        dense.save_cache(fresh, cache, embedder.config)
    tokens = rows.select(F.col("record_ord").alias("doc_id"), T.tokenize(F.col("text")).alias("tokens"))
    marked = tokens.select("doc_id", F.size("tokens").cast("long").alias("doc_len"), F.explode(F.concat(F.array(F.lit(None).cast("string")), "tokens")).alias("term"))
    posts = marked.groupBy("doc_id", "term").agg(F.count("*").alias("tf"), F.max("doc_len").alias("doc_len")).withColumn("part", _term_part())
    posts.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
    counts = {f"{r['field']}:{r['value']}": r["n"] for r in quality.overview(rows, ["document_type", "language"]).collect()}  # a few labels
    total, new = rows.count(), keyed.join(fresh.select("text_key"), "text_key", "left_semi").count()
    figures = {"records": total, "embedded_now": new, "reused": total - new, **counts}
    manifest = {"embedder": asdict(embedder.config), "embedder_fingerprint": embedder.config.fingerprint, "classifier_fingerprint": K.fingerprint(), "metric": "cosine", "build": figures}
    spark.createDataFrame([(json.dumps(manifest),)], "json string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return figures


def build_from_corpus(spark: SparkSession, documents: DataFrame, files: DataFrame, path: str, model: str = "hashing", min_words: int = 8, chunk_words: int = 220, cache: str | None = None) -> dict:
    """Build from documents and attachments (both with ``ord``); a corpus without records is an error."""
    records = load_records(documents, files, min_words, chunk_words)
    if records.isEmpty():
        raise ValueError("the corpus gives no retrieval records")
    return build(spark, records, path, dense.build_embedder(model), cache)


class Retriever:
    """Answers batches of questions, or one, over a saved index.

    The embedding model is loaded when a ranking needs it; where it cannot be loaded,
    lexical ranking answers alone.
    """

    def __init__(self, spark: SparkSession, path: str, embedder: dense.Embedder | None = None, enable_bm25: bool = True):
        self.spark, self.path, self._embedder, self.enable_bm25 = spark, path, embedder, enable_bm25
        try:
            self.manifest = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/manifest").collect()))
            self.records = spark.read.parquet(f"{path}/records")
            self._vectors, self._postings = spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/postings")
        except AnalysisException as e:
            raise IndexMissing(f"no index in {path}; build one first: python -m lodestone.cli build") from e
        self.stale = self.manifest["classifier_fingerprint"] != K.fingerprint()
        if self.stale:
            warnings.warn(f"the labels in {path} were made by other rules than today's; build the index again", stacklevel=2)

    @property
    def embedder(self) -> dense.Embedder:
        if self._embedder is None:
            self._embedder = dense.build_embedder(self.manifest["embedder"]["model"])
        return self._embedder

    @property
    def model_name(self) -> str:
        return self.manifest["embedder"]["model"]

    def _dense(self, asked: DataFrame, depth: int) -> DataFrame | None:
        try:
            vectors = self.embedder.queries(asked, "query_id", "query").withColumnRenamed("id", "query_id")
        except dense.ModelUnavailable:
            return None
        return dense.dense_top_k(self._vectors, vectors, depth)

    def _lexical(self, asked: DataFrame, depth: int) -> DataFrame:
        terms = lexical.query_terms(asked, "query_id", "query")
        parts = [r["p"] for r in terms.select(_term_part().alias("p")).distinct().collect()]  # at most TERM_PARTS
        rows = self._postings.where(F.col("part").isin([-1, *parts]))
        wanted = terms.select("term").distinct()
        kept = rows.join(wanted, "term", "left_semi").unionByName(rows.where("term is null")).select("doc_id", "term", "tf", "doc_len")
        scores = lexical.score_postings(kept, terms).withColumn("score", F.round("score", 4))
        return lexical.top_k(scores, depth).withColumnRenamed("doc_id", "record_ord")

    def retrieve_batch(self, queries: DataFrame, top_k: int = 5, mode: str = "hybrid", depth: int | None = None, **options) -> DataFrame:
        """Results of ``queries(query_id, query)``, best first within each; options as in ``operators.retrieve.retrieve``."""
        depth = depth or max(50, 10 * top_k)
        asked = queries.where(F.trim("query") != "")
        found = self._dense(asked, depth) if mode in ("hybrid", "dense") else None
        words = self._lexical(asked, depth) if self.enable_bm25 and mode in ("hybrid", "bm25") else None
        return retrieve.retrieve(self.records, asked, words, found, top_k, mode, depth=depth, **options)

    def retrieve(self, query: str, top_k: int = 5, **options) -> list[dict]:
        """Results of one question, at most ``top_k``."""
        if not query.strip():
            return []
        rows = self.retrieve_batch(self.spark.createDataFrame([(0, query)], "query_id long, query string"), top_k, **options)
        return [{**r.asDict(), "rank": r["result_rank"]} for r in rows.orderBy("result_rank").collect()]

    def retrieve_with_status(self, query: str, min_confidence: float = 0.35, **options) -> dict:
        """Results and whether they can be trusted: ok, low_confidence or no_results."""
        hits = self.retrieve(query, **options)
        best = max((h["confidence"] for h in hits), default=0.0)
        status = "no_results" if not hits else "ok" if best >= min_confidence else "low_confidence"
        return {"status": status, "results": hits, "best_confidence": best, "threshold": min_confidence, "message": STATUS_TEXT[status]}

    def compare_modes(self, queries: DataFrame, top_k: int = 5, **options) -> DataFrame:
        """Results by ``mode``: dense and lexical rankings unboosted, and both fused and boosted."""
        out = None
        for mode in ("dense", "bm25", "hybrid"):
            rows = self.retrieve_batch(queries, top_k, mode, **options).select(F.lit(mode).alias("mode"), "query_id", "result_rank", "record_ord", "score", "confidence", "page_type", "segment", "language", "title", "section_heading", "boosts")
            out = rows if out is None else out.unionByName(rows)
        return out

    def explain(self, queries: DataFrame, depth: int = 20, **options) -> DataFrame:
        """Every part of the score of the first ``depth`` candidates, without the filters that hide any."""
        rows = self.retrieve_batch(queries, depth, per_document=99, use_auto_filter=False, **options)
        return rows.select("query_id", "result_rank", "dense_score", "bm25_score", "base_score", "score", "confidence", F.map_contains_key("boosts", F.lit("heading_match")).alias("heading_match"), "boosts", "page_type", "segment", "language", "title", "section_heading")

    def show(self, pattern: str, field: str = "any", limit: int = 10, chars: int = 400) -> DataFrame:
        """The first ``limit`` records that hold ``pattern``, with the opening of their text on one line."""
        rows = quality.find_records(self.records, pattern, field).orderBy("record_ord").limit(limit)
        line = F.substring(F.regexp_replace(F.trim(F.col("text")), r"\s+", " "), 1, chars)
        return rows.select("record_ord", "title", "section_heading", "citation", "document_type", "page_type", "segment", "language", "has_table", "word_count", line.alias("text"))

    def record(self, needle: str, limit: int = 5) -> DataFrame:
        """Stored labels of records found by a forgiving lookup beside what the rules give now; whole needle first, then all words."""
        found = quality.lookup(self.records, needle)
        n_words = F.size(F.filter(F.split(T.lookup_form(F.lit(needle)), " "), lambda w: w != ""))
        whole, every = found.where("exact"), found.where(F.col("word_hits") == n_words)
        rows = whole if not whole.isEmpty() else every
        live = rows.withColumn("live_page_type", K.record_page_type(F.col("source_url"), F.col("title"), F.col("document_type"))).withColumn("live_segment", K.segment(F.col("source_url"), F.col("title")))
        return live.orderBy("record_ord").limit(limit).select("record_ord", "source_url", "title", "section_heading", "document_type", "chunk_id", "segment", "live_segment", "page_type", "live_page_type", "language", "has_table")


_shared: dict[str, Retriever] = {}


def ask(query: str, path: str, top_k: int = 5, language: str | None = None, **options) -> list[dict]:
    """One question to the index in ``path``, which stays open for the next one."""
    if path not in _shared:
        from .session import get_session

        _shared.clear()
        _shared[path] = Retriever(get_session(), path)
    return _shared[path].retrieve(query, top_k, language=language, **options)


__all__ = ["IndexMissing", "Retriever", "ask", "build", "build_from_corpus"]
