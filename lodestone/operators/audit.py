"""What a crawl brought in: audit figures, site map, dataset card, and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U

ROOT_AREA = "(root)"


def seed_sets(buckets: DataFrame) -> DataFrame:
    """``url, probe_only`` of ``buckets(bucket, urls)``: canonical addresses; probe-only ones were guessed and nothing else."""
    rows = buckets.select((F.col("bucket") == "guessed").alias("guessed"), F.explode("urls").alias("u")).select("guessed", U.canon_url(F.col("u")).alias("url"))
    return rows.groupBy("url").agg(F.min("guessed").alias("probe_only"))


def status_histogram(manifest: DataFrame) -> DataFrame:
    """``status, n`` in order of status; no status counts as 0."""
    return manifest.groupBy(F.coalesce("status", F.lit(0)).alias("status")).agg(F.count("*").alias("n")).orderBy("status")


def _failed(manifest: DataFrame, seeds: DataFrame) -> DataFrame:
    status = F.coalesce("status", F.lit(0))
    known = seeds.select("url", "probe_only")
    return manifest.join(known, "url", "left").withColumn("_probe", F.coalesce("probe_only", F.lit(False))).withColumn("_error", F.coalesce("error", F.lit("")) != "").withColumn("_bad", status >= 400).withColumn("_ok", status.between(200, 299))


def broken_links(manifest: DataFrame, seeds: DataFrame) -> DataFrame:
    """Manifest rows that failed, without addresses that were only guessed: a miss there is expected."""
    return _failed(manifest, seeds).where((F.col("_error") | F.col("_bad")) & ~F.col("_probe")).select(manifest.columns)


def probe_misses(manifest: DataFrame, seeds: DataFrame) -> DataFrame:
    return _failed(manifest, seeds).where(F.col("_bad") & F.col("_probe")).select(manifest.columns)


def figures(manifest: DataFrame, seeds: DataFrame, documents: DataFrame, attachments: DataFrame) -> DataFrame:
    """``metric, n``: the collection summary, one aggregate an input.

    ``documents``: url, word_count, sections (array), tables (array).
    """
    crawled = _failed(manifest, seeds).agg(
        F.count("*").alias("crawled"),
        F.count_if("_ok").alias("crawled_ok"),
        F.count_if((F.col("_error") | F.col("_bad")) & ~F.col("_probe")).alias("broken"),
        F.count_if(F.col("_bad") & F.col("_probe")).alias("probe_misses"),
        F.count_if("_error").alias("fetch_errors"),
        F.count_if(F.coalesce("looks_unrendered", F.lit(False))).alias("unrendered"),
        F.count_if(F.coalesce("soft_404", F.lit(False))).alias("soft_404s"),
    )
    found = seeds.select("url").union(manifest.select("url")).distinct().agg(F.count("*").alias("discovered"))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    held = documents.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(size("sections")), F.lit(0)).alias("sections"),
        F.coalesce(F.sum(size("tables")), F.lit(0)).alias("tables"),
        F.count_if(size("tables") > 0).alias("pages_with_tables"),
        F.count_if(F.col("word_count") < 80).alias("thin"),
    )
    files = attachments.agg(F.count("*").alias("attachments"), F.count_if(F.coalesce("needs_ocr", F.lit(False))).alias("needs_ocr"))
    out = None
    for one in (found, crawled, held, files):
        rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("n")) for c in one.columns])).alias("x")).select("x.*")
        out = rows if out is None else out.union(rows)
    return out


def _area(section_path: str = "section_path") -> Column:
    return F.coalesce(F.try_element_at(section_path, F.lit(1)), F.lit(ROOT_AREA))


def site_areas(documents: DataFrame, samples: int = 8) -> DataFrame:
    """``area, page_count, sample_urls, sub_sections`` by first path segment, largest first.

    ``documents``: ord, url, section_path.  Samples are the first pages of the area; they
    are kept as the smallest few while groups combine, never all of a group.
    """
    rows = documents.select(_area().alias("area"), F.try_element_at("section_path", F.lit(2)).alias("sub"), "ord", "url")
    counts = rows.groupBy("area").agg(F.count("*").alias("page_count"), F.min("ord").alias("first_ord"))
    subs = rows.where("sub is not null").select("area", "sub").distinct().groupBy("area").agg(F.array_sort(F.collect_list("sub")).alias("sub_sections"))
    from .attachments import first_rows

    first = first_rows(rows.select("area", "ord", "url"), "area", ["ord", "url"], samples)
    first = first.groupBy("area").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "url"))), lambda x: x["url"]).alias("sample_urls"))
    out = counts.join(first, "area").join(subs, "area", "left")
    return out.select("area", "page_count", "sample_urls", F.coalesce("sub_sections", F.array().cast("array<string>")).alias("sub_sections"), "first_ord").orderBy(F.desc("page_count"), "first_ord").drop("first_ord")


def link_graph(manifest: DataFrame) -> DataFrame:
    """``url, outlinks`` of pages that link anywhere."""
    return manifest.where(F.coalesce(F.size("outlinks"), F.lit(0)) > 0).select("url", "outlinks")


def card_figures(documents: DataFrame) -> DataFrame:
    """``field, value, n``: languages, areas, and the first and last fetch as values."""
    pair = lambda name, c: F.struct(F.lit(name).alias("field"), c.alias("value"))
    rows = documents.select(F.explode(F.array(pair("language", F.coalesce("language", F.lit(""))), pair("area", _area()))).alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))
    when = documents.where(F.coalesce("fetched_at", F.lit("")) != "")
    span = when.agg(F.min("fetched_at").alias("a"), F.max("fetched_at").alias("b"), F.count("*").alias("n"))
    return rows.union(span.where("n > 0").select(F.lit("first_fetch"), "a", "n")).union(span.where("n > 0").select(F.lit("last_fetch"), "b", "n"))


# ---------------------------------------------------------------- reports


def _table(header: list[str], rows: list[tuple]) -> list[str]:
    return ["| " + " | ".join(header) + " |", "|" + " --- |" * len(header), *["| " + " | ".join(map(str, r)) + " |" for r in rows]]


def site_report(base_url: str, manifest: DataFrame, seeds: DataFrame, documents: DataFrame, attachments: DataFrame, top: int = 20) -> str:
    """A markdown report from aggregates; only their few rows reach the driver."""
    from . import graph

    metric = {r["metric"]: r["n"] for r in figures(manifest, seeds, documents, attachments).collect()}
    areas = site_areas(documents).limit(200).collect()
    lines = [f"# Crawl report for {base_url}", "", "## Figures", "", *_table(["Figure", "Count"], sorted(metric.items())), "", "## Responses by status", ""]
    lines += [f"- {r['status']}: {r['n']}" for r in status_histogram(manifest).collect()]
    lines += ["", "## Areas", "", *_table(["Area", "Pages", "Parts"], [(r["area"], r["page_count"], ", ".join(r["sub_sections"][:8]) or "-") for r in areas])]
    linked = graph.inbound(graph.edges(manifest)).orderBy(F.desc("n_inbound"), "target_url").limit(top).collect()
    lines += ["", "## Most linked", "", *[f"- {r['n_inbound']} {r['target_url']}" for r in linked], "", "## To do", ""]
    todo = [("unrendered", "pages look as if a browser had to draw them"), ("soft_404s", "addresses gave a not-found page with a good status"), ("thin", "pages have fewer than 80 words"), ("needs_ocr", "attachments have no readable text")]
    lines += [f"- {metric[k]} {what}" for k, what in todo if metric.get(k)]
    return "\n".join(lines) + "\n"


def corpus_card(origin: str, documents: DataFrame, manifest: DataFrame, attachments: DataFrame, files: dict[str, int]) -> str:
    """A markdown card of the exported corpus: when, how much, in which languages and areas, which files."""
    rows = card_figures(documents).collect()  # languages and first path segments
    of = lambda field: sorted(((r["n"], r["value"]) for r in rows if r["field"] == field), key=lambda x: (-x[0], x[1]))
    counts = [("addresses visited", manifest.count()), ("pages", documents.count()), ("attachments", attachments.count())]
    lines = [f"# Corpus of {origin}", "", f"Fetched from {(of('first_fetch') or [(0, 'n/a')])[0][1]} to {(of('last_fetch') or [(0, 'n/a')])[0][1]}.", "", *_table(["Unit", "Count"], counts)]
    lines += ["", "## Languages", "", *_table(["Language", "Pages"], [(v, n) for n, v in of("language")]), "", "## Areas", "", *_table(["Area", "Pages"], [(v, n) for n, v in of("area")])]
    return "\n".join([*lines, "", "## Files", "", *_table(["File", "Rows"], sorted(files.items()))]) + "\n"


def verification_report(checks: DataFrame, strict: bool = False) -> tuple[str, str, int]:
    """Markdown of the gate's checks, the overall status, and an exit code (1 for FAIL, with ``strict`` for WARN, too)."""
    rows = checks.collect()  # one row a check
    worst = next((s for s in ("FAIL", "WARN") if any(r["status"] == s for r in rows)), "PASS")
    text = "\n".join(["# Corpus verification", "", f"Overall: **{worst}**", "", *_table(["Check", "Status", "Rows"], [(r["check"], r["status"], r["n"]) for r in rows])]) + "\n"
    return text, worst, int(worst == "FAIL" or (strict and worst == "WARN"))
