"""Crawl graph, attachments, refresh, soft not-found pages, full text, the index and the command line."""

import io
import json
import zipfile
import zlib
from urllib.parse import urldefrag, urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone import cli
from lodestone import index as I
from lodestone.functions import registry
from lodestone.functions import urls as U
from lodestone.operators import audit, dense, graph, html, quality, refresh, relational, soft404
from lodestone.operators.ordering import number_rows
from lodestone.plans import corpus_queries as CQ
from lodestone.sources import files

SF = "/root/testdata/sf0.001"


def test_bfs_on_a_deep_chain_keeps_the_order_of_discovery(spark):
    links = [(f"p{k}", 0, f"p{k + 1}") for k in range(12)] + [("p0", 1, "q"), ("q", 0, "p2"), ("p3", 1, "a.pdf"), ("a.pdf", 0, "hidden"), ("p5", 1, "p0")]
    edges = spark.createDataFrame(links, "source_url string, link_ord int, target_url string")
    seeds = spark.createDataFrame([("p0", 0), ("p0", 3)], "url string, ord long")
    leaves = spark.createDataFrame([("a.pdf",)], "url string")
    rows = {r["url"]: r for r in graph.bfs(seeds, edges, 20, leaves=leaves).collect()}
    assert {u: r["depth"] for u, r in rows.items()} == {**{f"p{k}": k for k in range(13)}, "q": 1, "a.pdf": 4}
    assert rows["p2"]["parent"] == "p1" and rows["p0"]["parent"] is None and sorted(r["place"] for r in rows.values()) == list(range(15))
    few = graph.bfs(seeds, edges, 20, max_pages=4).collect()
    assert sorted((r["place"], r["url"]) for r in few) == [(0, "p0"), (1, "p1"), (2, "q"), (3, "p2")]
    assert graph.bfs(seeds, edges, 1).count() == 3


def test_number_rows(spark):
    rows = spark.range(200).select((F.col("id") * 7 % 200).alias("k"))
    got, after = number_rows(rows.repartition(5), ["k"], "n", 10)
    assert after == 210 and all(r["n"] == r["k"] + 10 for r in got.collect())
    assert number_rows(rows.limit(0), ["k"], "n")[1] == 0


@pytest.mark.parametrize("base", ["https://a.b/c/d?x=1#f", "http://a.b", "https://a.b/c/"])
def test_resolve_like_a_browser(spark, base):
    hrefs = ["e", "../e", "../../e/./f", "/g/../h", "//x.y/z", "?q=1", "", "#s", "https://o.p/q", "e/", ".", "..", "mailto:a@b", "a/b/../c?d=../e"]
    got = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", U.resolve(F.lit(base), F.col("h")).alias("u")).collect()
    for r in got:
        want = urldefrag(urljoin(base, r["h"]))[0]
        assert r["u"].removesuffix("/") == want.removesuffix("/"), (base, r["h"], want)


def test_deep_and_broken_pages_parse():
    page = "<div>" * 3000 + "<p>x" + "<b>" * 3000 + "y"
    assert "x" in html.parse_page(page, "https://a.b/")["text"]


def test_breadcrumbs_follow_the_order_of_selectors():
    page = '<ol itemtype="https://schema.org/BreadcrumbList"><li>Late</li></ol><ul class="breadcrumb"><li><a>Home</a></li><li>home</li><li>Cards</li></ul>'
    assert html.parse_page(page, "https://a.b/")["breadcrumbs"] == ["Home", "Cards"]
    assert html.parse_page(page.replace('class="breadcrumb"', ""), "https://a.b/")["breadcrumbs"] == ["Late"]


def test_mirror_reads_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"caf\xe9 <p>")
    assert files.read_mirror(spark, str(tmp_path), "https://a.b").first()["html"] == "caf� <p>"


def test_robots(spark):
    urls = spark.createDataFrame([("https://a.b/x/1",), ("https://a.b/y",)], "url string")
    assert [r["url"] for r in files.robots_allowed(urls, "User-agent: *\nDisallow: /x/").collect()] == ["https://a.b/y"]
    assert files.robots_allowed(urls, None).count() == 2


def _pdf(lines, deflate):
    body = b"BT " + b" ".join(b"(" + x.encode() + b") Tj T*" for x in lines) + b" ET"
    body = zlib.compress(body) if deflate else body
    return b"%PDF-1.4\n1 0 obj <</Type /Page>> endobj\n2 0 obj <</Length 9" + (b" /Filter /FlateDecode" if deflate else b"") + b">>\nstream\n" + body + b"\nendstream endobj"


@pytest.mark.parametrize("deflate", [False, True])
def test_attachments_by_their_first_bytes(spark, deflate):
    docx = io.BytesIO()
    with zipfile.ZipFile(docx, "w") as z:
        z.writestr("word/document.xml", "<w:document xmlns:w='w'><w:p><w:r><w:t>Fee table</w:t></w:r></w:p></w:document>")
    rows = [("https://a.b/t.pdf", _pdf(["Annual fee \\(card\\)", "is 5"], deflate)), ("https://a.b/d", docx.getvalue()), ("https://a.b/i", b"\xff\xd8\xff\xe0"), ("https://a.b/page", b"<html>"), ("https://a.b/n", None)]
    got = {r["source_url"]: r for r in files.attachment_documents(spark.createDataFrame([(u, c, None) for u, c in rows], "url string, content binary, fetched_at string"), min_chars=8).collect()}
    assert got["https://a.b/t.pdf"]["text"] == "Annual fee (card)\nis 5" and got["https://a.b/t.pdf"]["pdf_pages"] == 1 and not got["https://a.b/t.pdf"]["needs_ocr"]
    assert got["https://a.b/d"]["text"] == "Fee table" and got["https://a.b/i"]["kind"] == "image" and got["https://a.b/i"]["needs_ocr"]
    assert "https://a.b/page" not in got


def test_csv_has_a_byte_order_mark(spark, tmp_path):
    assert files.write_csv(spark.createDataFrame([("é", 1)], "a string, b int"), str(tmp_path / "c"), ["a", "b"], byte_order_mark=True) == 1
    assert next((tmp_path / "c").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfa,b")


def test_soft_404_wording_decides_only_without_fingerprints(spark):
    pages = spark.createDataFrame([("a", "<p>Page not found here</p>", False), ("b", "<p>Flight 404 is late</p>", False), ("c", "<p>Fine text</p>", True), ("d", "Access denied", False)], "url string, html string, blocked boolean")
    probes = pages.where("url = 'a'").withColumn("status", F.lit(200))
    kept = lambda learned: {r["url"] for r in soft404.content_pages(pages, learned).collect()}
    assert kept(soft404.learn(probes)) == {"b"} and kept(soft404.learn(probes.limit(0))) == set()


def test_fingerprints_are_kept(spark, tmp_path):
    probes = spark.createDataFrame([("a", 200, "<p>Page not found</p>")], "url string, status int, html string")
    path = str(tmp_path / "f")
    assert files.read_fingerprints(spark, path).count() == 0
    files.write_fingerprints(soft404.learn(probes), path)
    assert files.read_fingerprints(spark, path).first()["kind"] == "soft_404"


def test_backoff(spark):
    got = spark.range(1).select(refresh.backoff_seconds(F.lit(2)).alias("a"), refresh.block_pause_seconds(F.lit(1)).alias("b"), refresh.block_pause_seconds(F.lit(9)).alias("c")).first()
    assert tuple(got) == (8.0, 10.0, 60.0)


def test_snippet_and_search(spark):
    sections = spark.createDataFrame([(1, "u", "Fees", "u#f", "The Annual fée is five " + "x " * 30), (2, "u", "Other", "u", "annual only")], "id long, url string, heading string, citation string, text string")
    asked = spark.createDataFrame([(7, "annual FEE"), (8, "missing")], "query_id long, query string")
    hits = relational.search(relational.postings(sections), sections, asked).collect()
    assert [(r["query_id"], r["id"]) for r in hits] == [(7, 1)]
    line = sections.where("id = 1").select(relational.snippet(F.col("text"), F.array(F.lit("annual"), F.lit("fee")), 5).alias("s")).first()["s"]
    assert line == "...[Annual] [fée] is five x..."


def test_tables_that_are_wrong(spark):
    rows = [([("c", ["a", "b"], [["1", "2", "3"]], ""), ("c", ["a"], [["1"]], ""), ("c", [], [], "")],), (None,)]
    got = spark.createDataFrame(rows, f"t {quality.TABLES}").select(quality.bad_tables(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [2, 0]


def test_dense_blocks_equal_broadcast(spark):
    rng = np.random.default_rng(1)
    rows = lambda n: [(i, rng.normal(size=8).tolist()) for i in range(n)]
    p = spark.createDataFrame(rows(300) + [(999, None)], "record_ord long, vector array<double>")
    q = spark.createDataFrame(rows(40), "query_id long, vector array<double>")
    key = lambda d: sorted((r["query_id"], r["rank"], r["record_ord"], round(r["score"], 9)) for r in d.collect())
    want = key(dense.dense_top_k(p, q, 5))
    assert key(dense.dense_top_k(p, q, 5, max_broadcast=3)) == want and len(want) == 200
    assert dense.dense_top_k(p, q.limit(0), 5).count() == 0


def test_embedders(spark):
    with pytest.raises(dense.ModelUnavailable):
        dense.build_embedder("some/e5-model")
    assert dense.build_embedder("hashing-16d").config.dim == 16


def test_sql_functions(spark):
    names = registry.register(spark)
    assert {"canon_url", "tokenize", "segment", "chunk_text", "parse_html"} <= set(names)
    row = spark.sql("select canon_url('HTTP://A.b/C%20d//e/?utm_source=1&b=2&a=1') u, segment('https://x/retail-banking/cards/1', 't') s, tokenize('The quick fee') t").first()
    assert tuple(row) == ("http://a.b/c%20d/e?a=1&b=2", "consumer", ["quick", "fee"])
    assert [r["text"] for r in spark.sql("select * from chunk_text('a b c', 220, 40)").collect()] == ["a b c"]
    assert spark.sql("select title from parse_html('<title>T</title>', 'https://a.b/')").first()["title"] == "T"


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    figures = [I.build_from_corpus(spark, CQ._documents(spark, SF), CQ._files(spark, SF), f"{folder}/ix", "hashing-64d", cache=f"{folder}/cache") for _ in range(2)]
    return f"{folder}/ix", figures


def test_index_is_built_once_and_asked_often(spark, index):
    path, (first, again) = index
    assert first["embedded_now"] > 300 and first["reused"] == 0 and again["embedded_now"] == 0 and again["reused"] == again["records"] == first["records"]
    r = I.Retriever(spark, path)
    passage = r.records.where("record_ord = 5").first()
    hits = r.retrieve(passage["text"][:120])
    assert hits[0]["record_ord"] == 5 and [h["rank"] for h in hits] == list(range(1, len(hits) + 1)) and len(hits) <= 5
    assert r.retrieve("  ") == [] and r.retrieve_with_status("zzzz qqqq", mode="bm25")["status"] == "no_results"
    status = r.retrieve_with_status(passage["text"][:120], min_confidence=0.2)
    assert status["status"] == "ok" and status["best_confidence"] >= 0.2
    asked = spark.createDataFrame([(3, passage["text"][:120])], "query_id long, query string")
    assert {x["mode"] for x in r.compare_modes(asked).collect()} == {"dense", "bm25", "hybrid"}
    assert r.explain(asked, 7).count() == 7
    assert I.Retriever(spark, path, enable_bm25=False).retrieve(passage["text"][:60])[0]["bm25_score"] is None
    heavy = r.retrieve_batch(asked, dense_weight=0.0, bm25_weight=1.0).orderBy("result_rank").first()
    assert heavy["base_score"] == pytest.approx(1 / (60 + heavy["bm25_rank"]), abs=1e-6)


def test_model_that_cannot_be_loaded_leaves_lexical_ranking(spark, index):
    r = I.Retriever(spark, index[0])
    r.manifest["embedder"]["model"] = "some/e5-model"
    assert all(h["dense_score"] is None for h in r.retrieve("Record cards"))


def test_missing_and_stale_index(spark, index, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError, match="build"):
        I.Retriever(spark, str(tmp_path / "none"))
    monkeypatch.setattr(I.K, "fingerprint", lambda: "other")
    with pytest.warns(UserWarning, match="labels"):
        assert I.Retriever(spark, index[0]).stale


def test_cache_of_another_dimension_is_ignored(spark, tmp_path):
    config = dense.EmbedderConfig(dim=4)
    dense.save_cache(spark.createDataFrame([("k", [1.0, 0.0])], "text_key string, vector array<double>"), str(tmp_path), config)
    assert dense.load_cache(spark, str(tmp_path), config).count() == 0 and dense.load_cache(spark, str(tmp_path / "no"), config).count() == 0


def test_command_line(spark, tmp_path, capsys, index):
    raw = tmp_path / "raw"
    raw.mkdir()
    page = "<html lang='en'><title>Card {0}</title><body><h2 id='fees'>Fees</h2><p>" + "annual fee of card {0} is {0} pounds " * 8 + "</p></body></html>"
    (raw / "p.json").write_text("\n".join(json.dumps({"url": f"https://a.b/cards/{k}", "html": page.format(k), "fetched_at": "2024-01-01T00:00:00Z"}) for k in range(4)))
    corpus = str(tmp_path / "corpus")
    assert cli.main(["extract", "--raw", str(raw), "--corpus", corpus, "--fingerprints", str(tmp_path / "none")]) == 0
    (tmp_path / "manifest").write_text("\n".join(json.dumps({"url": f"https://a.b/cards/{k}", "status": 200, "kind": "html", "outlinks": [f"https://a.b/cards/{k + 1}"]}) for k in range(4)))
    manifest = str(tmp_path / "manifest")
    assert cli.main(["verify", "--corpus", corpus, "--manifest", manifest, "--now", "2024-01-05"]) == 1
    assert "every citation URL fetched successfully | PASS" in capsys.readouterr().out
    assert cli.main(["build", "--corpus", corpus, "--index", str(tmp_path / "ix"), "--cache", str(tmp_path / "c")]) == 0
    capsys.readouterr()
    assert cli.main(["search", "annual fee card 2", "--index", str(tmp_path / "ix"), "--json"]) == 0
    hits = json.loads(capsys.readouterr().out)
    assert hits[0]["citation"].endswith("#fees")
    assert cli.main(["search", "annual fee", "--index", str(tmp_path / "ix")]) == 0 and "1. " in capsys.readouterr().out
    assert cli.main(["crawl", "--manifest", manifest, "--start", "https://a.b/cards/0", "--max-pages", "3", "--out", str(tmp_path / "order")]) == 0
    assert spark.read.json(str(tmp_path / "order")).count() == 3
    assert cli.main(["audit", "--corpus", corpus, "--manifest", manifest, "--seeds", str(tmp_path / "none")]) == 0 and "| crawled | 4 |" in capsys.readouterr().out
    assert cli.main(["export", "--corpus", corpus, "--manifest", manifest, "--out", str(tmp_path / "export")]) == 0 and "| documents | 4 |" in capsys.readouterr().out
    for options in (["--health"], ["--staleness"], ["--duplicates"], ["--record", "cards 2"], ["--show", "annual"], ["--topic", "fees=fee"], []):
        assert cli.main(["diagnose", "--index", str(tmp_path / "ix"), *options]) in (0, 1)
    assert cli.main(["search", "x", "--index", str(tmp_path / "no")]) == 1


def test_reports(spark):
    text = audit.site_report("https://m.example", CQ._manifest(spark, SF), CQ._seeds(spark, SF), CQ._documents(spark, SF), CQ._files(spark, SF))
    assert "| crawled | 50 |" in text and "## Areas" in text
    checks = spark.createDataFrame([("a", "WARN", 1), ("b", "PASS", 0)], "check string, status string, n long")
    assert audit.verification_report(checks)[1:] == ("WARN", 0) and audit.verification_report(checks, strict=True)[2] == 1
