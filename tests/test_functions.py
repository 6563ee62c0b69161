"""Scalars, operators and sources on small rows with known answers."""

import hashlib
import io
import zipfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestone.functions import classify as K
from lodestone.functions import text as T
from lodestone.functions import urls as U
from lodestone.operators import corpus, dense, graph, html, lexical, quality, retrieve
from lodestone.plans import corpus_queries
from lodestone.sources import files


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTPS://Shop.Example/A//b/?utm_source=x&b=2&a=1#top", "https://shop.example/a/b?a=1&b=2"),
        ("https://s.example/Retail%20Banking/", "https://s.example/retail%20banking"),
        ("https://s.example/Retail+Banking", "https://s.example/retail%20banking"),
        ("https://s.example/?csrt=123", "https://s.example/"),
        ("https://s.example/p%zz", "https://s.example/p%25zz"),
        ("https://s.example/x?page=2&ref=y", "https://s.example/x?page=2"),
    ],
)
def test_canon_url(spark, url, want):
    assert one(spark, url, U.canon_url) == want
    assert one(spark, want, U.canon_url) == want or "%25" in want


def test_scope_and_attachments(spark):
    assert one(spark, "https://a.example/file.PDF?x=1", U.in_scope)
    assert not one(spark, "https://a.example/logo.png", U.in_scope)
    assert not one(spark, "ftp://a.example/x", U.in_scope)
    assert one(spark, "https://a.example/-/media/rates", U.is_attachment)
    assert one(spark, "https://a.example/en/cards/gold", U.section_path) == ["cards", "gold"]
    assert one(spark, "en/cards/index.html", lambda c: U.mirror_url(c, "https://m.example")) == "https://m.example/en/cards"


def test_language(spark):
    none = F.lit(None).cast("string")
    assert one(spark, "https://a.example/ar/x", lambda u: T.detect_language(u, none, none, none)) == "ar"
    assert one(spark, "https://a.example/x", lambda u: T.detect_language(u, F.lit("en-GB"), none, none)) == "en"
    assert one(spark, "نص عربي طويل بما يكفي للعد", T.script_language) == "ar"
    assert one(spark, "short", T.script_language) == "unknown"


def test_tokenize_folds_arabic_and_drops_stopwords(spark):
    assert one(spark, "What is the FEE for أحمد؟ بطاقة ٣٥٠ a b", T.tokenize) == ["fee", "احمد", "بطاقه", "350"]
    assert one(spark, None, T.tokenize) == []


def test_labels(spark):
    assert one(spark, "https://b.example/news/new-card", K.page_type) == "news"
    assert one(spark, "https://b.example/cards/gold", K.page_type) == "product"
    assert one(spark, "https://b.example/home/smes/retail%20banking/pages/x", K.segment) == "consumer"
    assert one(spark, "https://b.example/retail/companies-cards/x", K.segment) == "corporate"
    assert one(spark, "https://b.example/smes/x", K.segment) == "unknown"
    assert one(spark, "Compare the annual fee of which card", K.intents) == ["fees", "compare"]
    assert one(spark, "payroll for my company", K.query_segment) == "corporate"


def test_response_classes(spark):
    kind = lambda h: one(spark, h, lambda c: K.response_class(K.visible_text(c), c))
    assert kind("<html><body>Sorry. Your support ID is 12.</body></html>") == "blocked"
    assert kind("<html><body>Error 404</body></html>") == "not_found"
    assert kind("<html><body>We use cookies. Accept?</body></html>") == "interstitial"
    assert kind("<html><script>404</script><body>Gold card</body></html>") == "content"


@pytest.mark.parametrize("head, ctype, want", [(b"%PDF-1.7", "text/html", "pdf"), (b"PK\x03\x04", "", "office_or_zip"), (b"<html>", "text/html; charset=x", "html"), (b"xx", "application/msword", "other"), (b"\xff\xd8\xff", None, "image"), (b"zz", "video/mp4", "other")])
def test_sniff(spark, head, ctype, want):
    df = spark.createDataFrame([(bytearray(head), ctype)], "h binary, c string")
    assert df.select(K.sniff_kind(F.col("c"), F.col("h")).alias("s")).first()["s"]["kind"] == want


def test_first_seen_and_short_first_variant(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(0, "https://a.example/x?ref=1", "too short"), (1, "https://a.example/x", long), (2, "https://a.example/y", long), (3, "https://a.example/z", long)]
    got = corpus.dedup_documents(spark.createDataFrame(rows, "ord long, url string, text string")).collect()
    assert [r["ord"] for r in got] == [2]


def test_section_records(spark):
    section = "array<struct<heading:string,level:int,text:string,anchor:string>>"
    schema = f"url string, title string, language string, text string, sections {section}, tables array<struct<markdown:string>>"
    words = "one two three four five six seven eight nine"
    rows = [("u1", "T", "en", "b", [("Fees", 2, words, "fees"), ("Short", 2, "x", None)], []), ("u2", "T2", "en", words, [], []), ("u3", "T3", "en", "b", [("A", 1, "x", "")], [("| t |",)])]
    got = {(r["source_url"], r["chunk_index"]): r for r in corpus.section_records(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {("u1", 0), ("u2", 0), ("u3", 0)}
    assert got["u1", 0]["citation"] == "u1#fees" and got["u1", 0]["text"].startswith("T - Fees\n")
    assert got["u3", 0]["has_table"] and got["u3", 0]["citation"] == "u3" and got["u3", 0]["text"].endswith("| t |")


def test_chunker():
    para = " ".join(f"a{i}" for i in range(100))
    big = " ".join(f"b{i}" for i in range(500))
    got = corpus.chunk_text("\n\n".join([para, para, para, big]))
    assert all(len(c.split()) <= 440 for c in got)
    assert got[1].split()[:40] == got[0].split()[-40:]
    assert {w for c in got for w in c.split()} >= set(para.split()) | set(big.split())
    assert corpus.chunk_text("  \n\n ") == [] and corpus.chunk_text(None) == []


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, s string, n int")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, s string")
    assert sorted(tuple(r) for r in corpus.upsert(base, new, "k", ["s"]).collect()) == [(1, "a", 1), (2, "c", 2), (3, "d", None)]


def test_greedy_diversity(spark):
    rows = [(1, 1, "a", "f1"), (1, 2, "a", "f2"), (1, 3, "a", "f3"), (1, 4, "b", "f3"), (1, 5, "b", "f1")]
    ranked = spark.createDataFrame(rows, "query_id long, rank long, doc_key string, fingerprint string").withColumn("confidence", F.lit(1.0))
    assert [(r["doc_key"], r["rank"]) for r in retrieve.diverse(ranked, 5, 2).orderBy("place").collect()] == [("a", 1), ("a", 2), ("b", 4)]
    assert retrieve.diverse(ranked, 5, 0).count() == 3


def test_confidence_and_boosts(spark):
    df = spark.createDataFrame([("Annual fees", "news", "corporate", True, "pdf", "what is the fee")], "h string, p string, s string, t boolean, d string, q string")
    q = F.col("q")
    got = df.select(retrieve.boosts(F.col("h"), F.col("p"), F.col("s"), F.col("t"), F.col("d"), K.intents(q), K.topics(q), K.query_segment(q)).alias("b"), retrieve.confidence(F.lit(0.5), F.lit(16.0), F.lit(True)).alias("c")).first()
    assert got["b"] == {"heading_match": 2.0, "page_news": -2.5, "segment_mismatch": -1.5, "has_table_fee_query": 0.8, "pdf_fee_query": 0.5}
    assert got["c"] == 0.675


def test_retrieve_prefers_products_over_news(spark):
    text = "the gold card annual fee is listed here with all charges and more words {}"
    rows = [(i, f"https://b.example/news/{i}", "", text.format(f"n{i}")) for i in range(4)] + [(i, f"https://b.example/cards/c{i}", "Fees", text.format(f"c{i}")) for i in range(4, 9)]
    rec = spark.createDataFrame(rows, "record_ord long, source_url string, section_heading string, text string").withColumns({"language": F.lit("en"), "document_type": F.lit("html"), "page_type": K.page_type(F.col("source_url")), "segment": F.lit("unknown"), "has_table": F.lit(False)})
    ask = spark.createDataFrame([(1, "gold card annual fee"), (2, " ")], "query_id long, query string")
    lex = lexical.top_k(lexical.bm25_scores(rec, ask, doc_id="record_ord"), 50).withColumnRenamed("doc_id", "record_ord")
    got = retrieve.retrieve(rec, ask, lex).orderBy("result_rank").collect()
    assert len(got) == 5 and {r["page_type"] for r in got} == {"product"} and {r["query_id"] for r in got} == {1}


def test_hash_embedding_matches_digest(spark):
    got = dense.hash_embed(spark.createDataFrame([(1, "alpha alpha beta")], "doc_id long, text string"), dim=16).collect()
    want = {}
    for tok in ("alpha", "alpha", "beta"):
        d = hashlib.md5(f"0:{tok}".encode()).digest()
        k = int.from_bytes(d[:4], "little") % 16
        want[k] = want.get(k, 0) + (1 if d[4] % 2 else -1)
    norm = sum(v * v for v in want.values()) ** 0.5
    assert {r["slot"]: round(r["value"], 9) for r in got} == {k: round(v / norm, 9) for k, v in want.items() if v}


def test_dense_top_k_breaks_ties_by_place(spark):
    v = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5)], "record_ord long, vector array<double>")
    q = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, vector array<double>")
    assert [r["record_ord"] for r in dense.dense_top_k(v, q, 3).orderBy("rank").collect()] == [0, 1, 2]
    assert dense.dense_top_k(v, q.limit(0), 3).count() == 0


def test_bfs_cycle_and_diamond(spark):
    e = spark.createDataFrame([("a", 0, "b"), ("a", 1, "c"), ("b", 0, "d"), ("c", 0, "d"), ("d", 0, "a"), ("d", 1, "e")], "source_url string, link_ord int, target_url string")
    s = spark.createDataFrame([("a", 0)], "url string, ord int")
    assert sorted(tuple(r)[:3] for r in graph.bfs(s, e, 2).collect()) == [("a", 0, None), ("b", 1, "a"), ("c", 1, "a"), ("d", 2, "b")]


def test_stop_after_three_blocks(spark):
    rows = [("s", i, b) for i, b in enumerate([False, True, True, False, True, True, True, False])]
    df = spark.createDataFrame(rows, "site string, t int, blocked boolean")
    assert sorted(r["t"] for r in graph.before_stop(df, "site", ["t"], "blocked").collect()) == list(range(7))


PAGE = """<html lang="en"><head><title>Gold  Card</title><meta name="description" content="d"></head><body>
<nav><a href="/x">x</a></nav><ol class="breadcrumb"><li><a href="/">Home</a></li><li>Cards</li></ol>
<main><h1>Gold</h1><p>Intro text <b>bold</b><p>Second paragraph that is long enough to count as content of the page, with some more words so that the main element is chosen. It goes on for a while and then some, until two hundred characters are there.
<h2 id="fees">Fees</h2><table><caption>Charges</caption><tr><th>Kind<th>Price<tr><td>Annual<td>10<tr><td>Late<td>5<td>extra</table>
<ul><li>One<li>Two</ul><a href="doc.pdf">pdf</a><a href="/cards/gold?utm_source=a">self</a><a href="mailto:x@y">m</a></main><footer>f</footer></body></html>"""


def test_parse_page(spark):
    df = spark.createDataFrame([("https://b.example/en/cards/gold", PAGE), ("https://b.example/e", None)], "url string, html string")
    got = {r["source_url"]: r for r in html.parse_pages(df).collect()}
    r = got["https://b.example/en/cards/gold"]
    assert r["title"] == "Gold Card" and r["language"] == "en" and r["breadcrumbs"] == ["Home", "Cards"] and r["meta_description"] == "d"
    assert [(s["heading"], s["anchor"]) for s in r["sections"]] == [("Gold", None), ("Fees", "fees")]
    t = r["tables"][0]
    assert t["headers"] == ["Kind", "Price"] and t["rows"] == [["Annual", "10"], ["Late", "5", "extra"]] and t["caption"] == "Charges"
    assert t["markdown"].splitlines()[1] == "| --- | --- | --- |"
    assert r["pdf_links"] == ["https://b.example/en/cards/doc.pdf"] and "https://b.example/cards/gold" in r["links"] and "footer" not in r["text"]
    assert got["https://b.example/e"]["word_count"] == 0


def test_page_documents_titles_equal_their_sql(spark, tmp_path):
    """Of references only those to <, > and & with their semicolons are decoded, and blanks inside stay."""
    titles = ["<title>a &amp &quot;x&quot; &#65; </title>", "<title>  two  blanks &amp;lt; &lt;b&gt; </title>", "<TITLE>Upper</TITLE>", "<title>A\tb</title>", "", None, "<title>no address</title>"]
    rows = [(i, f"https://a.example.org/{i}" if i < 6 else None, t and t + '<a href="/x">x</a>') for i, t in enumerate(titles)]
    pq.write_table(pa.table(dict(zip(("page_id", "url", "html"), map(list, zip(*rows))))), tmp_path / "pages.parquet")
    want = duckdb.sql(corpus_queries.sql()["page_documents"].replace("from pages)", f"from '{tmp_path}/pages.parquet')").replace("from pages ", f"from '{tmp_path}/pages.parquet' "))
    got = corpus_queries.page_documents(spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_sources(spark, tmp_path):
    assert files.read_manifest(spark, str(tmp_path / "none.jsonl")).count() == 0
    (tmp_path / "m.jsonl").write_text('{"url":"u","status":200,"outlinks":[]}\n\n{"url":"v","blocked":true}\n')
    assert {r["url"]: r["blocked"] for r in files.read_manifest(spark, str(tmp_path / "m.jsonl")).collect()} == {"u": False, "v": True}
    assert files.sitemap_locs('<urlset xmlns="x"><url><loc> a </loc></url></urlset>') == (["a"], [])
    assert files.sitemap_locs("<broken") == ([], [])
    maps = spark.createDataFrame([("r", "<sitemapindex><sitemap><loc>s</loc></sitemap></sitemapindex>"), ("s", "<urlset><url><loc>https://a.example/P/</loc></url></urlset>")], "url string, xml string")
    assert [r["url"] for r in files.sitemap_closure(maps, ["r"]).collect()] == ["https://a.example/p"]
    mem = io.BytesIO()
    with zipfile.ZipFile(mem, "w") as z:
        z.writestr("word/document.xml", "<d xmlns:w='w'><w:p><w:t>Hello</w:t><w:t> you</w:t></w:p></d>")
    assert files.office_text(mem.getvalue(), "docx") == "Hello you" and files.office_text(b"x", "xlsx") == ""
    site = tmp_path / "site" / "en"
    site.mkdir(parents=True)
    (site / "index.html").write_text("<p>x</p>")
    assert [r["url"] for r in files.read_mirror(spark, str(tmp_path / "site"), "https://m.example").collect()] == ["https://m.example/en"]
    b = spark.createDataFrame([("nav", ["https://a.example/1", "https://a.example/2"]), ("sitemap", ["https://a.example/2#x"])], "bucket string, urls array<string>")
    assert [r["url"] for r in files.seeds(b).orderBy("ord").collect()] == ["https://a.example/2", "https://a.example/1"]


def test_gate_verdicts(spark):
    from lodestone.plans import catalogue

    docs, manifest, held = catalogue._gate_inputs(spark, "/root/testdata/sf0.001")
    checks = quality.verify_gate(docs.limit(0), manifest, held, now="2024-02-01")
    assert {r["check"]: r["status"] for r in checks.collect()}["corpus non-empty"] == "FAIL"
    assert quality.worst(checks).first()["overall"] == "FAIL"


def test_stream_ingest(spark, tmp_path):
    from lodestone.streaming import ingest

    text = " ".join(f"w{i}" for i in range(25))
    rows = [("https://a.example/x", text), ("https://a.example/X?ref=1", text), ("https://a.example/y", "short")]
    spark.createDataFrame(rows, "url string, text string").withColumn("fetched_at", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = ingest.append_to(ingest.new_documents(ingest.landing_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert [r["url"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["https://a.example/x"]
