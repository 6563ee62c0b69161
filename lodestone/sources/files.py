"""Sources and sinks of a corpus: JSONL, mirrored sites, sitemaps, office files, exports."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

MANIFEST = (
    "url string, final_url string, status int, error string, depth int, discovered_from string, content_type string, kind string, raw_path string, fetched_at string, from_cache boolean, outlinks array<string>, "
    "looks_unrendered boolean, soft_404 boolean, blocked boolean, imported_from string, rendered boolean, refetched boolean, words_before int, words_after int"
)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a fixed schema; a missing file is an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    flags = ("looks_unrendered", "soft_404", "blocked")
    return read_jsonl(spark, path, MANIFEST).withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def read_mirror(spark: SparkSession, root: str, base_url: str) -> DataFrame:
    """``url, html, imported_from`` of the HTML files under a folder; bytes that are no UTF-8 become U+FFFD."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    inner = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^" + re.escape(root.rstrip("/")) + "/", "")
    kept = files.withColumn("inner", inner).where(F.lower("inner").rlike(r"\.(html?|xhtml)$|(^|/)[^./]+$"))
    return kept.select(U.mirror_url(F.col("inner"), base_url).alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"), F.col("inner").alias("imported_from")).orderBy("imported_from")


def sitemap_locs(xml: str | None) -> tuple[list[str], list[str]]:
    """Page addresses and nested sitemaps; broken XML gives neither."""
    try:
        root = ElementTree.fromstring((xml or "").strip().encode())
    except (ElementTree.ParseError, ValueError):
        return [], []
    locs = [e.text.strip() for e in root.iter() if e.tag.rsplit("}", 1)[-1] == "loc" and e.text]
    nested = root.tag.rsplit("}", 1)[-1] == "sitemapindex"
    return ([], locs) if nested else (locs, [])


def read_sitemaps(sitemaps: DataFrame) -> DataFrame:
    """``url, pages, nested`` from ``sitemaps(url, xml)``."""

    def run(batches):
        for b in batches:
            got = [sitemap_locs(x) for x in b.column("xml").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("url"), pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got], pa.list_(pa.string()))], names=["url", "pages", "nested"])

    return sitemaps.select("url", "xml").mapInArrow(run, "url string, pages array<string>, nested array<string>")


def sitemap_closure(sitemaps: DataFrame, roots: list[str], max_sitemaps: int = 50) -> DataFrame:
    """Canonical in-scope page addresses reachable from root sitemaps through nested ones."""
    parsed = read_sitemaps(sitemaps)
    seen, todo, pages = set(), list(dict.fromkeys(roots)), None
    while todo and len(seen) < max_sitemaps:
        todo = todo[: max_sitemaps - len(seen)]
        seen |= set(todo)
        level = parsed.where(F.col("url").isin(todo))
        found = level.select(F.explode("pages").alias("u"))
        pages = found if pages is None else pages.union(found)
        todo = [r["n"] for r in level.select(F.explode("nested").alias("n")).distinct().orderBy("n").limit(max_sitemaps).collect() if r["n"] not in seen]
    canon = (pages if pages is not None else parsed.select(F.explode("pages").alias("u")).limit(0)).select(U.canon_url(F.col("u")).alias("url"))
    return canon.where(U.in_scope(F.col("url"))).distinct()


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """Addresses of ``sitemap:`` lines of ``robots(text)``."""
    lines = robots.select(F.explode(F.split("text", r"\r?\n")).alias("line"))
    return lines.where(F.lower(F.trim("line")).startswith("sitemap:")).select(F.trim(F.regexp_extract("line", r"(?i)^\s*sitemap:\s*(.*)$", 1)).alias("url"))


def robots_allowed(urls: DataFrame, robots_text: str | None, agent: str = "*") -> DataFrame:
    """Rows of ``urls(url)`` that the rules allow; without rules all are allowed."""
    if not robots_text:
        return urls
    from urllib.robotparser import RobotFileParser

    def keep(batches):
        parser = RobotFileParser()  # read once a task
        parser.parse(robots_text.splitlines())
        for batch in batches:
            yield batch.filter(pa.array([parser.can_fetch(agent, u or "") for u in batch.column("url").to_pylist()], pa.bool_()))

    return urls.mapInArrow(keep, urls.schema)


def nav_links(pages: DataFrame, homes: list[str]) -> DataFrame:
    """``url``: canonical in-scope links of the home pages, each once, in order.  ``pages(url, html)``."""
    from ..operators.html import native_links

    found = pages.where(F.col("url").isin(homes)).select(F.explode(native_links(F.col("html"), F.col("url"))).alias("url"))
    return found.distinct().orderBy("url")


def seeds(buckets: DataFrame, order: tuple[str, ...] = ("sitemap", "nav", "guessed")) -> DataFrame:
    """``url, ord`` of ``buckets(bucket, urls)``: by bucket, then place; first seen wins; in scope."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("bucket"))
    rows = buckets.select(rank.alias("b"), F.posexplode("urls").alias("pos", "u")).select(U.canon_url(F.col("u")).alias("url"), F.struct("b", "pos").alias("at"))
    return rows.where(U.in_scope(F.col("url"))).groupBy("url").agg(F.min("at").alias("ord"))


def office_text(data: bytes, kind: str) -> str:
    """Text of an .xlsx (rows, cells by ' | ') or .docx (paragraphs); "" if it cannot be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            tag = lambda e: e.tag.rsplit("}", 1)[-1]
            if kind == "docx":
                root = ElementTree.fromstring(z.read("word/document.xml"))
                lines = ["".join(t.text or "" for t in p.iter() if tag(t) == "t") for p in root.iter() if tag(p) == "p"]
                return "\n".join(x for x in lines if x.strip())
            shared = []
            if "xl/sharedStrings.xml" in z.namelist():
                shared = ["".join(t.text or "" for t in si.iter() if tag(t) == "t") for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if tag(si) == "si"]
            names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if tag(s) == "sheet"]
            out = []
            for k, name in enumerate(names, 1):
                out.append(f"# {name}")
                for row in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{k}.xml")).iter():
                    if tag(row) != "row":
                        continue
                    cells = []
                    for c in row:
                        v = next((e.text or "" for e in c.iter() if tag(e) in ("v", "t")), "")
                        cells.append(shared[int(v)] if c.get("t") == "s" and v else v)
                    if any(x.strip() for x in cells):
                        out.append(" | ".join(cells))
            return "\n".join(out)
    except (KeyError, ValueError, IndexError, zipfile.BadZipFile, ElementTree.ParseError):
        return ""


_PDF_STREAM = re.compile(rb"<<(.{0,2000}?)>>\s*stream\r?\n(.*?)endstream", re.S)
_PDF_STRING = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|T\*|Td|TD|Tm|'|ET", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def pdf_text(data: bytes) -> tuple[str, int]:
    """Text and page count of a simple PDF: strings of plain or deflated content streams.

    Encrypted files and fonts with their own encodings give no text; such files end up as
    ``needs_ocr``.  Runs of blank lines become one.
    """
    pages = len(re.findall(rb"/Type\s*/Page(?![s\w])", data))
    if b"/Encrypt" in data:
        return "", pages
    blocks = []
    for head, body in _PDF_STREAM.findall(data):
        if b"/Image" in head or b"/FontFile" in head:
            continue
        if b"FlateDecode" in head:
            try:
                body = zlib.decompressobj().decompress(body)
            except zlib.error:
                continue
        if b"BT" not in body:
            continue
        out = []
        for m in _PDF_STRING.findall(body):
            if m[:1] == b"(":
                out.append(re.sub(rb"\\([0-7]{1,3}|.)", lambda e: bytes([int(e[1], 8) & 255]) if e[1].isdigit() else _ESCAPES.get(e[1], e[1]), m[1:-1], flags=re.S))
            elif m[:1] == b"<":
                digits = re.sub(rb"\s", b"", m[1:-1])
                out.append(bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()))
            else:
                out.append(b"\n")
        blocks.append(b"".join(out).decode("latin-1"))
    lines = (x.rstrip() for x in "\n\n".join(blocks).split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip(), pages


def read_attachment(data: bytes, kind: str) -> tuple[str, int]:
    """Text and pages of a file of any kind; images and unknown kinds have no text."""
    if kind == "pdf":
        return pdf_text(data)
    if kind in ("docx", "xlsx"):
        return office_text(data, kind), 0
    if kind == "office_or_zip":
        return office_text(data, "docx") or office_text(data, "xlsx"), 0
    return "", 0


def attachment_documents(files: DataFrame, min_chars: int = 200, reader=read_attachment) -> DataFrame:
    """Attachment documents of ``files(url, content, fetched_at)``: the kind is told by the first bytes.

    Pages served in place of a file are left out.  A file with less than ``min_chars``
    characters of text stays, marked ``needs_ocr``.  ``reader`` gives text and pages.
    """
    from ..operators.attachments import sniffed

    def run(batches):
        for b in batches:
            got = [reader(c or b"", k) for c, k in zip(b.column("content").to_pylist(), b.column("kind").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("url"), b.column("fetched_at"), b.column("kind"), pa.array([t for t, _ in got], pa.string()), pa.array([n for _, n in got], pa.int32())], names=["url", "fetched_at", "kind", "text", "pdf_pages"])

    rows = sniffed(files).where("kind <> 'html'").select("url", F.col("fetched_at").cast("string").alias("fetched_at"), "kind", "content")
    got = rows.mapInArrow(run, "url string, fetched_at string, kind string, text string, pdf_pages int")
    none = F.lit(None).cast("string")
    return got.select(
        U.canon_url(F.col("url")).alias("url"), F.col("url").alias("source_url"), U.last_segment(F.col("url")).alias("title"), T.detect_language(F.col("url"), none, F.col("text"), none).alias("language"), "fetched_at", F.left(F.sha2("text", 256), F.lit(16)).alias("content_hash"),
        "text", T.word_count(F.col("text")).alias("word_count"), "pdf_pages", F.col("kind").alias("attachment_kind"), "kind", (F.length("text") < min_chars).alias("needs_ocr"),
    )


def attachments(files: DataFrame, min_chars: int = 200, reader=office_text) -> DataFrame:
    """``url, title, kind, text, needs_ocr, content_hash`` of ``files(url, kind, content)``; pages served as HTML are left out."""

    def run(batches):
        for b in batches:
            texts = [reader(c or b"", k or "") for c, k in zip(b.column("content").to_pylist(), b.column("kind").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("url"), b.column("kind"), pa.array(texts, pa.string())], names=["url", "kind", "text"])

    got = files.where("kind <> 'html'").select("url", "kind", "content").mapInArrow(run, "url string, kind string, text string")
    return got.select("url", U.last_segment(F.col("url")).alias("title"), "kind", "text", (F.length("text") < min_chars).alias("needs_ocr"), F.left(F.sha2("text", 256), F.lit(16)).alias("content_hash"))


# ---------------------------------------------------------------- sinks


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, columns: list[str], byte_order_mark: bool = False) -> int:
    """Chosen columns with a header; returns the number of rows.

    Arrays and structs must be flattened before.  A byte-order mark goes in front of the
    first column's name, which is where it stands in every part file.
    """
    rows = df.select(*columns)
    if byte_order_mark:
        rows = rows.withColumnRenamed(columns[0], "\ufeff" + columns[0])
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return df.sparkSession.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count()


def append_jsonl(df: DataFrame, path: str) -> None:
    """Add rows to a JSON-lines table; what was written before stays, whatever happens after."""
    df.write.mode("append").json(path)


def raw_rows(fetched: DataFrame) -> DataFrame:
    """Rows of the raw store from ``fetched(url, final_url, status, content_type, html, fetched_at)``: bodies with their records, by key."""
    return fetched.select(U.url_key(U.canon_url(F.col("url"))).alias("url_key"), "url", F.coalesce("final_url", "url").alias("final_url"), "status", "content_type", "html", "fetched_at", F.lit(False).alias("from_cache"))


def write_raw(fetched: DataFrame, path: str) -> None:
    """Append fetched bodies to the raw store; readers take the last of each key."""
    raw_rows(fetched).write.mode("append").parquet(path)


def write_url_list(urls: DataFrame, path: str) -> None:
    """A list of addresses (an attachment queue, seeds): each once, in order, over what was there."""
    urls.select("url").distinct().orderBy("url").write.mode("overwrite").json(path)


def write_fingerprints(learned: DataFrame, path: str) -> None:
    learned.write.mode("overwrite").json(path)


def read_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """Learned fingerprints; none if nothing was learned yet."""
    return read_jsonl(spark, path, "kind string, text_hash string, words long, sample string")


def attachments_table(files: DataFrame) -> DataFrame:
    """Inventory of attachments for CSV."""
    return files.select("url", "title", "language", "pdf_pages", "word_count", "needs_ocr", "fetched_at")


def all_documents_table(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Flat form of pages, then of attachments, which have no parts to count."""
    none = F.lit(0).alias
    flat = files.select("url", "title", "language", "word_count", "content_hash", F.lit("").alias("section_path"), F.lit("").alias("breadcrumbs"), none("n_sections"), none("n_tables"), none("n_links"))
    return documents_table(docs).unionByName(flat)


def documents_table(docs: DataFrame) -> DataFrame:
    """Flat form of documents for CSV: arrays joined, nested arrays counted."""
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).alias(f"n_{c}")
    return docs.select("url", "title", "language", "word_count", "content_hash", F.concat_ws("/", "section_path").alias("section_path"), F.concat_ws(" > ", "breadcrumbs").alias("breadcrumbs"), count("sections"), count("tables"), count("links"))


def sections_table(docs: DataFrame) -> DataFrame:
    return docs.select("url", F.posexplode("sections").alias("section_ord", "s")).select("url", "section_ord", "s.heading", "s.level", "s.text", U.citation(F.col("url"), F.col("s.anchor")).alias("citation"))


def tables_table(docs: DataFrame) -> DataFrame:
    return docs.select("url", F.posexplode("tables").alias("table_ord", "t")).select("url", "table_ord", "t.caption", F.concat_ws(" | ", "t.headers").alias("headers"), F.size("t.rows").alias("n_rows"), "t.markdown")


def links_table(docs: DataFrame) -> DataFrame:
    one = lambda c, kind: docs.select("url", F.explode(c).alias("target_url"), F.lit(kind).alias("kind"))
    return one("links", "page").union(one("pdf_links", "pdf"))
