"""Command line: extract, attachments, verify, crawl, audit, export, build, search, diagnose.

Tables are folders: JSON lines in and out, Parquet for the index.  Run as
``python -m lodestone.cli COMMAND --help``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import textwrap

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import index as I

from .operators import attachments, audit, corpus, graph, html, quality, soft404
from .operators.ordering import number_rows
from .session import get_session
from .sources import files

DOCUMENTS = "ord long, source_url string, fetched_at string, section_path array<string>, pdf_links array<string>, links array<string>, language string, " + html.SCHEMA.replace(", hrefs array<string>", "")
FILES = "ord long, url string, source_url string, title string, language string, fetched_at string, content_hash string, text string, word_count long, pdf_pages int, attachment_kind string, kind string, needs_ocr boolean"


def _corpus(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return files.read_jsonl(spark, f"{folder}/documents", DOCUMENTS), files.read_jsonl(spark, f"{folder}/attachments", FILES)


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    """Raw pages (url, html, fetched_at) to documents: content pages, each address and each text once."""
    raw = spark.read.schema("url string, html string, fetched_at string, blocked boolean, soft_404 boolean").json(a.raw)
    raw = soft404.content_pages(raw, files.read_fingerprints(spark, a.fingerprints))
    parsed = html.parse_pages(raw).join(raw.select(F.col("url").alias("source_url"), "fetched_at").dropDuplicates(["source_url"]), "source_url")
    placed, _ = number_rows(parsed, ["source_url"], "ord")
    docs = corpus.dedup_documents(placed.drop("content_hash"), a.min_words, a.keep_duplicates)
    files.write_jsonl(docs.drop("canon", "title_markup"), f"{a.corpus}/documents")
    return 0


def attach(spark: SparkSession, a: argparse.Namespace) -> int:
    """A folder of files (url, content, fetched_at) to attachment documents."""
    rows = spark.read.parquet(a.files).orderBy("url")
    docs, _ = number_rows(files.attachment_documents(rows.limit(a.limit) if a.limit else rows, a.min_chars), ["url"], "ord")
    files.write_jsonl(docs, f"{a.corpus}/attachments")
    for r in attachments.kinds(docs).collect():
        print(f"{r['kind']}: {r['n']}")
    return 0


def crawl(spark: SparkSession, a: argparse.Namespace) -> int:
    """Walk the links of a manifest from start addresses; what is within the limits, in order of discovery."""
    manifest = files.read_manifest(spark, a.manifest)
    seeds = spark.createDataFrame(list(enumerate(a.start)), "ord long, url string")
    leaves = manifest.where("soft_404 or kind <> 'html'").select("url")
    graph.bfs(seeds, graph.edges(manifest), a.max_depth, a.max_pages, leaves).orderBy("place").write.mode("overwrite").json(a.out)
    return 0


def _gate_input(docs: DataFrame) -> DataFrame:
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return docs.withColumns({"n_sections": size("sections"), "n_tables": size("tables"), "n_bad_tables": quality.bad_tables(F.col("tables")), "anchors": F.transform("sections", lambda s: s["anchor"])})


def verify(spark: SparkSession, a: argparse.Namespace) -> int:
    docs, held = _corpus(spark, a.corpus)
    checks = quality.verify_gate(_gate_input(docs), files.read_manifest(spark, a.manifest), held, a.now, a.max_age_days)
    report, _, code = audit.verification_report(checks, a.strict)
    print(report)
    return code


def report(spark: SparkSession, a: argparse.Namespace) -> int:
    docs, held = _corpus(spark, a.corpus)
    manifest = files.read_manifest(spark, a.manifest)
    if manifest.isEmpty():
        print(f"no manifest at {a.manifest}", file=sys.stderr)
        return 1
    seeds = audit.seed_sets(files.read_jsonl(spark, a.seeds, "bucket string, urls array<string>"))
    print(audit.site_report(a.base_url, manifest, seeds, docs, held))
    return 0


def export(spark: SparkSession, a: argparse.Namespace) -> int:
    """CSV tables and the dataset card."""
    docs, held = _corpus(spark, a.corpus)
    if docs.isEmpty() and held.isEmpty():
        print("the corpus is empty", file=sys.stderr)
        return 1
    tables = {"documents": files.all_documents_table(docs, held), "sections": files.sections_table(docs), "tables": files.tables_table(docs), "attachments": files.attachments_table(held), "links": files.links_table(docs)}
    counts = {n: files.write_csv(t, f"{a.out}/{n}", t.columns, byte_order_mark=True) for n, t in tables.items()}
    print(audit.corpus_card(a.base_url, docs, files.read_manifest(spark, a.manifest), held, counts))
    return 0


def build(spark: SparkSession, a: argparse.Namespace) -> int:
    print(json.dumps(I.build_from_corpus(spark, *_corpus(spark, a.corpus), a.index, a.model, a.min_words, a.chunk_words, None if a.no_cache else a.cache), indent=2))
    return 0


def render(results: list[dict], width: int = 96, chars: int = 320) -> str:
    """Results as text: a head line, where from, and the opening of the passage."""
    if not results:
        return "No results: the corpus may not hold these words, or a filter left everything out."
    out = []
    for r in results:
        out.append(f"{r['rank']}. {r['score']:.4f} [{r['language']}/{r['document_type']}] dense={r['dense_score']} bm25={r['bm25_score']}")
        page = f", page ~{r['pdf_page']}" if r.get("pdf_page") else ""
        out += [f"    {r['title']} / {r['section_heading'] or '-'}{page}", f"    {r['citation']}", textwrap.fill(" ".join(r["text"].split())[:chars], width, initial_indent="    ", subsequent_indent="    "), ""]
    return "\n".join(out)


def search(spark: SparkSession, a: argparse.Namespace) -> int:
    hits = I.Retriever(spark, a.index).retrieve(" ".join(a.query), a.top_k, language=a.language, document_type=a.document_type, mode=a.mode, per_document=a.per_document)
    print(json.dumps(hits, ensure_ascii=False, indent=2) if a.json else render(hits))
    return 0


def diagnose(spark: SparkSession, a: argparse.Namespace) -> int:
    r = I.Retriever(spark, a.index)
    asked = spark.createDataFrame(list(enumerate(a.query or ["How much is the annual fee?"])), "query_id long, query string")
    arabic = any("؀" <= c <= "ۿ" for q in a.query or [] for c in q)
    language = a.language or ("ar" if arabic else None)
    if a.health:
        rows = quality.health(r.records)
        rows.show(truncate=False)
        return int(not rows.where("warned").isEmpty())
    if a.staleness:
        rows = quality.stale_report(r.records)
        rows.show(truncate=False)
        return int(r.stale or not rows.where("segments + page_types > 0").isEmpty())
    if a.show:
        r.show(a.show, limit=a.top_k).show(truncate=False)
    elif a.record:
        found = r.record(a.record)
        (found if not found.isEmpty() else quality.near_matches(r.records, a.record)).show(truncate=False)
    elif a.duplicates:
        corpus.duplicate_openings(r.records).orderBy(F.desc("size"), "first_ord").show(15, truncate=False)
    elif a.topic:
        quality.topic_counts(r.records, dict(t.split("=", 1) for t in a.topic)).orderBy("topic", "field", F.desc("n")).show(200, truncate=False)
    elif a.explain:
        r.explain(asked, a.depth, language=language).orderBy("query_id", "result_rank").show(a.depth * 5, truncate=False)
    elif a.compare:
        r.compare_modes(asked, a.top_k, language=language).orderBy("query_id", "mode", "result_rank").show(200, truncate=False)
    else:
        quality.overview(r.records, ["document_type", "page_type", "segment", "language", "has_table"]).orderBy("field", F.desc("n")).show(100, truncate=False)
        quality.top_headings(r.records).show(truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestone", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *options: tuple) -> None:
        c = sub.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        c.set_defaults(run=run)
        for flags, kw in options:
            c.add_argument(*flags.split(), **kw)

    o = lambda flags, **kw: (flags, kw)
    corpus_dir, manifest, flag = o("--corpus", default="data/corpus"), o("--manifest", default="data/raw/manifest"), {"action": "store_true"}
    index_dir, base = o("--index", default="data/retrieval"), o("--base-url", default="https://example.org")
    command("extract", extract, o("--raw", default="data/raw/pages"), o("--fingerprints", default="data/raw/fingerprints"), corpus_dir, o("--min-words", type=int, default=20), o("--keep-duplicates", **flag))
    command("attachments", attach, o("--files", default="data/raw/files"), corpus_dir, o("--limit", type=int, default=0), o("--min-chars", type=int, default=200))
    command("verify", verify, corpus_dir, manifest, o("--max-age-days", type=int, default=30), o("--strict", **flag), o("--now", default=os.environ.get("LODESTONE_NOW") or __import__("datetime").date.today().isoformat()))
    command("crawl", crawl, manifest, o("--start", nargs="+", required=True), o("--max-pages", type=int, default=3000), o("--max-depth", type=int, default=6), o("--out", default="data/raw/order"))
    command("audit", report, corpus_dir, manifest, base, o("--seeds", default="data/raw/seeds"))
    command("export", export, corpus_dir, manifest, base, o("--out", default="data/export"))
    command("build", build, corpus_dir, index_dir, o("--cache", default="data/retrieval/cache"), o("--model", default="hashing"), o("--chunk-words", type=int, default=220), o("--min-words", type=int, default=8), o("--no-cache", **flag))
    ranking = [index_dir, o("--top-k", type=int, default=5), o("--language", choices=["en", "ar"])]
    command("search", search, o("query", nargs="+"), *ranking, o("--document-type", choices=["html", "pdf"]), o("--mode", choices=["hybrid", "dense", "bm25"], default="hybrid"), o("--per-document", type=int, default=2), o("--json", **flag))
    flags = [o(f"--{n}", **flag) for n in ("overview", "compare", "explain", "health", "staleness", "duplicates")]
    command("diagnose", diagnose, *ranking, *flags, o("--query", action="append"), o("--depth", type=int, default=20), o("--show"), o("--record"), o("--topic", action="append", help="NAME=PATTERN"))
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(get_session(), args)
    except I.IndexMissing as e:
        print(e, file=sys.stderr)
        return 1


__all__ = ["main", "parser", "render"]

if __name__ == "__main__":
    sys.exit(main())
