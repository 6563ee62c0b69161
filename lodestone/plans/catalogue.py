"""Registered queries over the driver tables and their DuckDB counterparts.

The tables stand in for a crawled corpus: ``documents`` are records (``source`` is the
site), ``pages`` the raw store, ``benchmark`` and ``conversations`` the questions,
``embeddings`` the vectors and ``events`` the fetch log.  Every query reads its whole
tables; a limit is only there where top-k is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import text as T
from ..functions import urls as U
from ..operators import corpus, dense, graph, html, lexical, quality, retrieve

NOW = "2024-03-01"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _bm25(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    docs, items = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    scores = lexical.bm25_scores(docs, items, query_id="item_id", query_text="text").withColumn("score", F.round("score", 4))
    return lexical.top_k(scores, k)


def bm25_topk(spark, sf_dir):
    return _bm25(spark, sf_dir, 5).select(F.col("query_id").alias("item_id"), "doc_id", "score", F.col("rank").cast("long").alias("rank"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain each benchmark passage?"""
    return bm25_topk(spark, sf_dir)


def term_stats(spark, sf_dir):
    tokens = lexical.with_tokens(_read(spark, sf_dir, "documents"), "doc_id", "text")
    stats = lexical.corpus_stats(lexical.doc_lengths(tokens))
    return lexical.term_stats(lexical.postings(tokens), stats).withColumn("idf", F.round("idf", 6))


def corpus_stats(spark, sf_dir):
    tokens = lexical.with_tokens(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return lexical.corpus_stats(lexical.doc_lengths(tokens)).withColumn("avg_len", F.round("avg_len", 4))


def url_canonical(spark, sf_dir):
    canon = U.canon_url(F.col("url"))
    return _read(spark, sf_dir, "pages").select("page_id", canon.alias("canon"), U.url_key(canon).alias("url_key"))


def url_scope_attach(spark, sf_dir):
    u = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", U.in_scope(u).alias("in_scope"), U.is_attachment(u).alias("attachment"), U.is_pdf_url(u).alias("pdf"))


def url_section_path(spark, sf_dir):
    u = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", F.array_join(U.section_path(U.canon_url(u)), "/").alias("section_path"), T.detect_language(u, F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("string")).alias("language"), U.host_of(u).alias("host"))


def url_dedup_first(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").select("page_id", U.canon_url(F.col("url")).alias("canon"))
    return corpus.first_seen(pages, "canon", ["page_id"])


def lang_script(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", T.script_language(F.col("text")).alias("language"))


def content_dedup(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.concat(F.lit("https://docs.example/d/"), F.col("doc_id").cast("string")).alias("url"), "text")
    return corpus.dedup_documents(docs).select(F.col("ord").alias("doc_id"), "content_hash", "word_count")


def thin_documents(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).alias("word_count")).where("word_count < 80")


def hash_embed(spark, sf_dir):
    return dense.hash_embed(_read(spark, sf_dir, "documents"), dim=384).select(F.col("id").alias("doc_id"), "slot", F.round("value", 6).alias("value"))


def _dense(spark, sf_dir, k):
    vectors = _read(spark, sf_dir, "embeddings")
    asked = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return dense.dense_top_k(vectors.select(F.col("vec_id").alias("record_ord"), F.col("embedding").alias("vector")), asked, k)


def dense_topk(spark, sf_dir):
    return _dense(spark, sf_dir, 10).select("query_id", F.col("record_ord").alias("vec_id"), F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


def _questions(spark, sf_dir):
    """Benchmark passages with words that show an intent."""
    tail = F.element_at(F.array(*[F.lit(x) for x in (" annual fee", " who can apply", " compare cards", "")]), (F.col("item_id") % 4 + 1).cast("int"))
    return _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.concat("text", tail).alias("query"))


def _labelled(spark, sf_dir):
    """Documents as records of an invented site, with every label that the ranking looks at."""
    n = F.col("doc_id")
    pick = lambda *words: F.element_at(F.array(*map(F.lit, words)), (n % len(words) + 1).cast("int"))
    url = F.concat(F.lit("https://docs.example/"), pick("retail-banking/cards", "corporate-banking/loans", "news", "about-us", "accounts"), F.lit("/"), (n % 97).cast("string"))
    title = F.concat(F.lit("Record "), n.cast("string"))
    rows = _read(spark, sf_dir, "documents").select(n.alias("record_ord"), url.alias("source_url"), title.alias("title"), pick("Fees", "Eligibility", "Overview", "Required documents").alias("section_heading"), "text", T.script_language(F.col("text")).alias("language"), F.when(n % 11 == 0, "pdf").otherwise("html").alias("document_type"), (n % 3 == 0).alias("has_table"), F.concat(F.lit("r"), n.cast("string")).alias("chunk_id"))
    return rows.withColumn("page_type", K.record_page_type(F.col("source_url"), F.col("title"), F.col("document_type"))).withColumn("segment", K.segment(F.col("source_url"), F.col("title")))


def _rankings(spark, sf_dir):
    """Dense and lexical rankings of the questions over the same documents."""
    docs, asked = _read(spark, sf_dir, "documents"), _questions(spark, sf_dir)
    embed = dense.build_embedder("hashing-64d")
    vectors = embed.passages(docs, "doc_id", "text").withColumnRenamed("id", "record_ord")
    d = dense.dense_top_k(vectors, embed.queries(asked, "query_id", "query").withColumnRenamed("id", "query_id"), 50)
    scores = lexical.bm25_scores(docs, asked).withColumn("score", F.round("score", 4))
    return d, lexical.top_k(scores, 50).withColumnRenamed("doc_id", "record_ord")


def _fused(spark, sf_dir):
    return retrieve.fuse(*_rankings(spark, sf_dir))


def rrf_hybrid(spark, sf_dir):
    return _fused(spark, sf_dir).select("query_id", "record_ord", F.round("rrf", 6).alias("rrf"))


def confidence_status(spark, sf_dir):
    hits = _fused(spark, sf_dir).withColumn("confidence", F.round(retrieve.confidence(F.round("dense_score", 4), F.col("bm25_score"), F.lit(False)), 2))
    return retrieve.with_status(_questions(spark, sf_dir), hits)


def _title():
    return F.coalesce(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), F.lit(""))


def page_labels(spark, sf_dir):
    u = F.col("url")
    return _read(spark, sf_dir, "pages").select("page_id", K.page_type(u, _title()).alias("page_type"), K.segment(u, _title()).alias("segment"))


def query_intents(spark, sf_dir):
    q = F.coalesce("text", F.lit(""))
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(K.intents(q), ",").alias("intents"), F.array_join(K.topics(q), ",").alias("topics"), K.query_segment(q).alias("segment"))


def response_class(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").withColumn("visible", K.visible_text(F.col("html")))
    return pages.select("page_id", K.response_class(F.col("visible"), F.col("html")).alias("response"), (F.length("visible") < 400).alias("unrendered"), K.text_hash(F.col("visible")).alias("text_hash"))


def page_links(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").select("page_id", F.explode(html.native_links(F.col("html"), F.col("url"))).alias("link"))
    return pages


def inbound_top(spark, sf_dir):
    return graph.inbound(page_links(spark, sf_dir).withColumnRenamed("link", "target_url")).orderBy(F.desc("n_inbound"), "target_url").limit(20)


def parse_pages(spark, sf_dir):
    docs = html.parse_pages(_read(spark, sf_dir, "pages"))
    return docs.select("source_url", "url", "title", "language", "word_count", F.size("sections").cast("long").alias("n_sections"), F.size("links").cast("long").alias("n_links"), "content_hash")


def _chunks(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", T.words(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").alias("total_words"), F.posexplode(corpus.word_windows(F.col("w"))).alias("chunk_index", "text"))


def chunk_windows(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5("text").alias("chunk_md5"), T.chunk_id(F.lit("pdf"), F.col("doc_id").cast("string"), F.col("chunk_index"), F.col("text")).alias("chunk_id"))


def greedy_chunks(spark, sf_dir):
    return corpus.chunk_documents(_read(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count("*").alias("n_chunks"), F.max(T.word_count(F.col("text"))).alias("longest"))


def page_estimate(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).withColumn("n_pages", 1 + F.floor(F.col("total_words") / 500))
    return corpus.page_estimates(chunks).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.col("pdf_page").cast("long").alias("pdf_page"))


def cache_hits(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    cache = docs.where("doc_id % 2 = 0").select(F.left(F.sha1("text"), F.lit(20)).alias("text_key"), F.array(F.lit(1.0)).alias("vector"))
    return dense.cache_lookup(docs, cache).select("doc_id", "text_key", F.col("vector").isNotNull().alias("hit"))


def dup_clusters(spark, sf_dir):
    return corpus.duplicate_openings(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_ord"), "text"))


def existence_check(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.lit("").alias("section_heading"), F.lit("").alias("title"), "text", F.lit("").alias("source_url"))
    return quality.find_records(docs, r"licen[sc]e|all rights reserved").select("doc_id")


def fts_and(spark, sf_dir):
    items = _read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
    return lexical.and_search(_read(spark, sf_dir, "documents"), items, query_id="item_id").select(F.col("query_id").alias("item_id"), "doc_id")


def _records(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages").withColumn("title", _title())
    u = F.col("url")
    return pages.select(
        F.col("page_id").alias("record_ord"), F.concat(F.lit("html_"), F.left(F.sha1("url"), F.lit(16))).alias("chunk_id"), u.alias("source_url"), "title", F.lit("").alias("section_heading"),
        K.visible_text(F.col("html")).alias("text"), T.detect_language(u, F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("string")).alias("language"), F.lit("html").alias("document_type"),
        K.record_page_type(u, F.col("title"), F.lit("html")).alias("page_type"), K.segment(u, F.col("title")).alias("segment"), F.lit(False).alias("has_table"),
    )


def health_check(spark, sf_dir):
    return quality.health(_records(spark, sf_dir)).withColumn("n", F.col("n").cast("long"))


def staleness(spark, sf_dir):
    tampered = _records(spark, sf_dir).withColumn("segment", F.when(F.col("record_ord") % 9 == 0, "corporate").otherwise(F.col("segment")))
    return quality.stale(tampered).select("record_ord", "segment", "live_segment", "page_type", "live_page_type")


def label_overview(spark, sf_dir):
    return quality.overview(_records(spark, sf_dir), ["language", "document_type", "page_type", "segment", "has_table"])


def block_runs(spark, sf_dir):
    fetches = _read(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("blocked"))
    runs = graph.blocked_runs(fetches, "user_id", ["ts", "event_id"], "blocked")
    return runs.select("user_id", F.col("first_n").cast("long").alias("first_n"), F.col("last_n").cast("long").alias("last_n"), F.col("length").cast("long").alias("length"))


def crawl_until_blocked(spark, sf_dir):
    fetches = _read(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("blocked"))
    return graph.before_stop(fetches, "user_id", ["ts", "event_id"], "blocked", 2).select("user_id", "event_id")


def freshness(spark, sf_dir):
    age = F.datediff(F.lit(NOW).cast("date"), F.min("ts").cast("date"))
    return _read(spark, sf_dir, "events").agg(age.cast("long").alias("age_days"), (age > 30).alias("stale"))


def bfs_levels(spark, sf_dir):
    """Depths in a graph of two arithmetic links a page, which is deep where the pages' own links are not."""
    pages = _read(spark, sf_dir, "pages").select("page_id")
    n = pages.agg(F.count("*").alias("n")).scalar()
    links = pages.select(F.col("page_id").cast("string").alias("source_url"), F.posexplode(F.array((F.col("page_id") * 7 + 3) % n, (F.col("page_id") * 3 + 1) % n)).alias("link_ord", "t")).select("source_url", "link_ord", F.col("t").cast("string").alias("target_url"))
    seeds = pages.where("page_id = 0").select(F.col("page_id").cast("string").alias("url"), F.lit(0).alias("ord"))
    return graph.bfs(seeds, links, 6).select("url", F.col("depth").cast("long").alias("depth"))


def crawl_levels(spark, sf_dir):
    """Depths in the pages' own link graph, from each host's page of the smallest id; attachments are not followed."""
    pages = _read(spark, sf_dir, "pages").select("page_id", U.canon_url(F.col("url")).alias("source_url"), html.native_links(F.col("html"), F.col("url")).alias("links"))
    first = corpus.first_seen(pages, "source_url", ["page_id"])
    links = first.select("source_url", F.posexplode("links").alias("link_ord", "target_url"))
    seeds = first.groupBy(U.host_of(F.col("source_url")).alias("host")).agg(F.min_by("source_url", "page_id").alias("url"), F.min("page_id").alias("ord")).select("url", "ord")
    leaves = links.select(F.col("target_url").alias("url")).where(U.is_attachment(F.col("url"))).distinct()
    return graph.bfs(seeds, links, 6, leaves=leaves).select("url", F.col("depth").cast("long").alias("depth"))


def set_coverage(spark, sf_dir):
    return corpus.coverage(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "doc_id")


def upsert(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    changes = orders.where("o_orderkey % 10 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    added = orders.where("o_orderkey % 50 = 0").select((-F.col("o_orderkey") - 1).alias("o_orderkey"), "o_totalprice")
    done = corpus.upsert(orders, changes.union(added), "o_orderkey", ["o_totalprice"])
    return done.withColumn("o_totalprice", F.round("o_totalprice", 2))


def diverse_topk(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("doc_key"), F.substring(F.coalesce("text", F.lit("")), 1, 160).alias("fingerprint"))
    ranked = _bm25(spark, sf_dir, 50).join(docs, "doc_id").withColumn("confidence", F.lit(1.0))
    out = retrieve.diverse(ranked, 5, 2)
    return out.select(F.col("query_id").alias("item_id"), F.col("rank").cast("long").alias("rank"), "doc_key", "place")


def hybrid_retrieve(spark, sf_dir):
    d, lex = _rankings(spark, sf_dir)
    out = retrieve.retrieve(_labelled(spark, sf_dir), _questions(spark, sf_dir), lex, d)
    return out.select("query_id", F.col("result_rank").cast("long").alias("result_rank"), "record_ord", "score", "base_score", "confidence", "page_type", "segment")


def _gate_inputs(spark, sf_dir):
    url = F.concat(F.lit("https://docs.example/d/"), F.col("doc_id").cast("string"))
    docs = _read(spark, sf_dir, "documents").select(
        url.alias("url"), F.concat(url, F.lit("?csrt=1")).alias("source_url"), F.substring("text", 1, 40).alias("title"), F.lit("2024-01-15T00:00:00Z").alias("fetched_at"), T.content_hash(F.col("text")).alias("content_hash"),
        T.script_language(F.col("text")).alias("language"), "text", T.word_count(F.col("text")).alias("word_count"), F.lit(1).alias("n_sections"), F.lit(0).alias("n_tables"), F.lit(0).alias("n_bad_tables"),
        F.when(F.col("doc_id") % 7 == 0, F.array(F.concat(F.lit("https://docs.example/f/"), F.col("doc_id").cast("string"), F.lit(".PDF")))).otherwise(F.array().cast("array<string>")).alias("pdf_links"),
    )
    status = F.when(F.col("doc_id") % 50 == 0, 404).otherwise(200)
    manifest = _read(spark, sf_dir, "documents").select(url.alias("url"), F.lit(None).cast("string").alias("final_url"), status.alias("status"), F.when(F.col("doc_id") % 50 == 0, "http 404").alias("error"), F.lit(False).alias("blocked"), (F.col("doc_id") % 33 == 0).alias("looks_unrendered"))
    held = _read(spark, sf_dir, "benchmark").select(F.concat(F.lit("https://docs.example/f/"), F.col("item_id").cast("string"), F.lit(".pdf")).alias("url"), F.lit(None).cast("string").alias("source_url"), (F.length("text") < 200).alias("needs_ocr"), "text")
    return docs, manifest, held


def verify_gate(spark, sf_dir):
    return quality.verify_gate(*_gate_inputs(spark, sf_dir), now=NOW)


QUERIES = [
    bm25_topk, term_stats, corpus_stats, url_canonical, url_scope_attach, url_section_path, url_dedup_first, lang_script, content_dedup, thin_documents, hash_embed, dense_topk, rrf_hybrid, confidence_status,
    page_labels, query_intents, response_class, page_links, inbound_top, parse_pages, chunk_windows, greedy_chunks, page_estimate, cache_hits, dup_clusters, existence_check, fts_and, health_check,
    staleness, label_overview, block_runs, crawl_until_blocked, freshness, bfs_levels, crawl_levels, set_coverage, upsert, diverse_topk, hybrid_retrieve, verify_gate,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import corpus_queries

    return {f.__name__: f for f in [*QUERIES, *corpus_queries.QUERIES]}


def oracle_sql() -> dict[str, str]:
    from . import corpus_queries, oracles

    return {**oracles.sql(), **corpus_queries.sql()}
