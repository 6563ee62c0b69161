"""Hybrid retrieval over a batch of queries: fusion, boosts, guards, diversity, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import rules


def fuse(dense: DataFrame, lexical: DataFrame, dense_weight: float = rules.DENSE_WEIGHT, bm25_weight: float = rules.BM25_WEIGHT) -> DataFrame:
    """Weighted reciprocal rank fusion of two rankings ``(query_id, record_ord, score, rank)``."""
    d = dense.select("query_id", "record_ord", F.col("score").alias("dense_score"), F.col("rank").alias("dense_rank"))
    b = lexical.select("query_id", "record_ord", F.col("score").alias("bm25_score"), F.col("rank").alias("bm25_rank"))
    term = lambda weight, rank: F.coalesce(F.lit(weight) / (rules.RRF_K + F.col(rank)), F.lit(0.0))
    return d.join(b, ["query_id", "record_ord"], "full_outer").withColumn("rrf", term(dense_weight, "dense_rank") + term(bm25_weight, "bm25_rank"))


def boosts(heading: Column, page_type: Column, segment: Column, has_table: Column, document_type: Column, intents: Column, topics: Column, want: Column) -> Column:
    """Map of the adjustments that apply, in boost units."""
    product_question = (F.size(intents) > 0) | (F.size(topics) > 0)
    money = F.array_contains(intents, "fees") | F.array_contains(intents, "rates")
    mismatch = (want.isin("consumer", "consumer_default") & (segment == "corporate")) | ((want == "corporate") & (segment == "consumer"))
    tests = [
        ("heading_match", K.heading_matches(heading, intents)),
        ("page_news", product_question & (page_type == "news")),
        ("page_about", product_question & (page_type == "about")),
        ("page_product", product_question & (page_type == "product")),
        ("segment_mismatch", mismatch),
        ("has_table_fee_query", money & F.coalesce(has_table, F.lit(False))),
        ("pdf_fee_query", money & (document_type == "pdf")),
    ]
    return F.map_from_entries(F.array_compact(F.array(*[F.when(test, F.struct(F.lit(name), F.lit(rules.BOOSTS[name]))) for name, test in tests])))


def boost_total(applied: Column) -> Column:
    return F.aggregate(F.map_values(applied), F.lit(0.0), lambda a, x: a + x) * rules.BOOST_UNIT


def confidence(dense: Column, bm25: Column, heading_match: Column) -> Column:
    """Evidence from 0 to 1: similarity, a lexical hit, a matching heading."""
    # least and greatest skip nulls, so a missing similarity needs its own case
    c = F.when(dense.isNotNull(), 0.65 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), dense))).otherwise(0.0)
    c = c + F.coalesce(F.when(bm25 != 0, 0.20 * F.least(F.lit(1.0), bm25 / 8.0)), F.lit(0.0))
    c = c + F.when(heading_match, 0.15).otherwise(0.0)
    return F.bround(F.least(F.lit(1.0), c), 4)


def auto_filter(ranked: DataFrame, top_k: int, depth: int) -> DataFrame:
    """Drop news and about pages where product pages among the first ``depth`` can fill the answer.

    ``ranked`` has ``query_id, rank, page_type, is_product_question`` and
    ``language_ok`` (true without a language filter).
    """
    enough = F.sum(F.when((F.col("rank") <= depth) & (F.col("page_type") == "product") & F.col("language_ok"), 1).otherwise(0)).over(Window.partitionBy("query_id"))
    return ranked.withColumn("_enough", enough >= top_k).where(~(F.col("is_product_question") & F.col("_enough") & F.col("page_type").isin("news", "about"))).drop("_enough")


def diverse(ranked: DataFrame, top_k: int, per_document: int, min_confidence: float = 0.0) -> DataFrame:
    """Greedy pass in rank order: a quota for each document, no repeated opening text.

    ``ranked`` has ``query_id, rank, doc_key, fingerprint, confidence``; the fold sees the
    candidates of one query (at most two depths), quota and opening are charged before
    the confidence test.  Returns ``query_id, rank, doc_key, confidence, place``.
    """
    item = "struct<rank:bigint,doc_key:string,fingerprint:string,confidence:double>"
    state = f"struct<used:map<string,int>,seen:array<string>,out:array<{item}>>"
    rows = ranked.select("query_id", F.struct(F.col("rank").cast("long").alias("rank"), F.col("doc_key").cast("string").alias("doc_key"), "fingerprint", F.col("confidence").cast("double").alias("confidence")).alias("x"))
    folded = rows.groupBy("query_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    quota_hit = f"{per_document} > 0 and coalesce(try_element_at(s.used, x.doc_key), 0) >= {per_document}"
    skip = f"size(s.out) >= {top_k} or ({quota_hit}) or array_contains(s.seen, x.fingerprint)"
    charged = "map_concat(map_filter(s.used, (k, v) -> k <> x.doc_key), map(x.doc_key, coalesce(try_element_at(s.used, x.doc_key), 0) + 1))"
    step = (
        f"(s, x) -> case when {skip} then s else cast(named_struct('used', {charged}, 'seen', array_append(s.seen, x.fingerprint), "
        f"'out', case when x.confidence >= {min_confidence} then array_append(s.out, x) else s.out end) as {state}) end"
    )
    start = f"cast(named_struct('used', cast(map() as map<string,int>), 'seen', cast(array() as array<string>), 'out', cast(array() as array<{item}>)) as {state})"
    kept = folded.select("query_id", F.expr(f"aggregate(xs, {start}, {step}, s -> s.out)").alias("out"))
    return kept.select("query_id", F.posexplode("out").alias("pos", "x")).select("query_id", F.col("x.rank").alias("rank"), F.col("x.doc_key").alias("doc_key"), F.col("x.confidence").alias("confidence"), (F.col("pos") + 1).cast("long").alias("place"))


def with_status(queries: DataFrame, hits: DataFrame, min_confidence: float = 0.35) -> DataFrame:
    """One row per query: ok, low_confidence or no_results, and the best confidence."""
    best = hits.groupBy("query_id").agg(F.max("confidence").alias("best_confidence"), F.count("*").alias("n_results"))
    out = queries.select("query_id").join(best, "query_id", "left")
    status = F.when(F.col("n_results").isNull(), "no_results").when(F.col("best_confidence") >= min_confidence, "ok").otherwise("low_confidence")
    return out.select("query_id", status.alias("status"), F.coalesce("best_confidence", F.lit(0.0)).alias("best_confidence"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"))


def retrieve(
    records: DataFrame,
    queries: DataFrame,
    lexical: DataFrame | None,
    dense: DataFrame | None = None,
    top_k: int = 5,
    mode: str = "hybrid",
    per_document: int = 2,
    language: str | None = None,
    document_type: str | None = None,
    page_type: str | None = None,
    exclude_page_types: tuple[str, ...] = (),
    use_boosts: bool | None = None,
    use_auto_filter: bool = True,
    min_confidence: float = 0.0,
    depth: int | None = None,
    dense_weight: float = rules.DENSE_WEIGHT,
    bm25_weight: float = rules.BM25_WEIGHT,
) -> DataFrame:
    """The whole ranking for ``queries(query_id, query)`` over ``records``.

    ``records`` has ``record_ord, source_url, section_heading, text, language,
    document_type, page_type, segment, has_table``.  Language and type filters act on the
    candidates, not below the ranking, so they do not change who is a candidate.
    """
    depth = depth or max(50, 10 * top_k)
    none = records.sparkSession.createDataFrame([], "query_id long, record_ord long, score double, rank int")
    d = (dense if dense is not None and mode in ("hybrid", "dense") else none).where(F.col("rank") <= depth)
    b = (lexical if lexical is not None and mode in ("hybrid", "bm25") else none).where(F.col("rank") <= depth)
    fused = fuse(d, b, dense_weight, bm25_weight)
    if mode != "hybrid":
        fused = fused.withColumn("rrf", F.coalesce("dense_score", "bm25_score"))
    use_boosts = mode == "hybrid" if use_boosts is None else use_boosts
    asked = queries.where(F.trim("query") != "").select("query_id", K.intents(F.col("query")).alias("intents"), K.topics(F.col("query")).alias("topics"), K.query_segment(F.col("query")).alias("want"))
    rows = fused.join(records, "record_ord").join(asked, "query_id")
    applied = boosts(F.col("section_heading"), F.col("page_type"), F.col("segment"), F.col("has_table"), F.col("document_type"), F.col("intents"), F.col("topics"), F.col("want"))
    rows = rows.withColumn("boosts", applied if use_boosts else F.create_map().cast("map<string,double>"))
    rows = rows.withColumn("score", F.col("rrf") + boost_total(F.col("boosts"))).withColumn("is_product_question", (F.size("intents") > 0) | (F.size("topics") > 0))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.expr("dense_rank is null"), "dense_rank", "bm25_rank", "record_ord")
    rows = rows.withColumn("rank", F.row_number().over(order)).withColumn("language_ok", F.col("language") == language if language else F.lit(True))
    if use_auto_filter:
        rows = auto_filter(rows, top_k, depth)
    if exclude_page_types:
        rows = rows.where(~F.col("page_type").isin(*exclude_page_types))
    for col, value in (("language", language), ("document_type", document_type), ("page_type", page_type)):
        if value:
            rows = rows.where(F.col(col) == value)
    rows = rows.withColumn("confidence", confidence(F.col("dense_score"), F.col("bm25_score"), F.map_contains_key("boosts", F.lit("heading_match"))))
    rows = rows.withColumn("doc_key", F.col("source_url")).withColumn("fingerprint", F.substring("text", 1, 160))
    compare = rows.where(F.array_contains("intents", "compare")) if per_document > 1 else None
    picked = diverse(rows if compare is None else rows.where(~F.array_contains("intents", "compare")), top_k, per_document, min_confidence)
    if compare is not None:
        picked = picked.unionByName(diverse(compare, top_k, 1, min_confidence))
    return picked.select("query_id", "rank", F.col("place").alias("result_rank")).join(rows.drop("doc_key", "fingerprint"), ["query_id", "rank"]).withColumn("score", F.round("score", 6)).withColumn("base_score", F.round("rrf", 6))
