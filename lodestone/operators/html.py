"""HTML pages to documents: title, language, breadcrumbs, sections, tables, links.

The tree comes from the standard library's tokenizer with implied end tags; one Arrow
pass per page yields the whole document struct.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IMPLIED = {"p": "p div ul ol li table h1 h2 h3 h4 h5 h6 section article main header footer nav form dl dt dd blockquote pre tr td th".split(), "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr"], "td": ["td", "th", "tr"], "th": ["td", "th", "tr"], "option": ["option"]}

# --- fixed values: page furniture, content containers, breadcrumb containers ---
DROP_TAGS = {"script", "style", "noscript", "svg", "iframe", "nav", "header", "footer", "form"}
DROP_ROLES = {"navigation", "banner", "contentinfo"}
DROP_CLASSES = {"nav", "navbar", "menu", "mega-menu", "breadcrumb", "breadcrumbs", "footer", "header", "cookie", "cookie-banner", "social", "skip-link", "search-box"}
DROP_IDS = {"onetrust-consent-sdk"}
MAIN = [("tag", "main"), ("role", "main"), ("tag", "article"), ("id", "main"), ("id", "content"), ("class", "main-content"), ("class", "content"), ("class", "page-content")]
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = {"p", "li", "td", "th", "dd", "dt"}
#: A title without attributes, as it is written: no reference decoded, no space changed.
TITLE = re.compile("<title>([^<]*)</title>")
SKIP_SCHEMES = ("mailto:", "tel:", "javascript:")

SCHEMA = (
    "url string, title string, title_markup string, html_lang string, meta_lang string, meta_description string, breadcrumbs array<string>, text string, word_count int, content_hash string, "
    "sections array<struct<heading:string,level:int,text:string,anchor:string>>, "
    "tables array<struct<caption:string,headers:array<string>,rows:array<array<string>>,markdown:string>>, hrefs array<string>"
)


class El:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag, attrs=()):
        self.tag, self.attrs, self.kids = tag, {k: v or "" for k, v in attrs}, []

    def walk(self):
        """Elements and strings below, in page order; depth costs memory, not the call stack."""
        stack = [iter(self.kids)]
        while stack:
            for k in stack[-1]:
                yield k
                if isinstance(k, El) and k.kids:
                    stack.append(iter(k.kids))
                    break
            else:
                stack.pop()

    def all(self):
        return (k for k in self.walk() if isinstance(k, El))

    def text(self, sep=" "):
        return sep.join(s for s in (x.strip() for x in self.walk() if isinstance(x, str)) if s)


class Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = El("#root")
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        while len(self.stack) > 1 and tag in IMPLIED.get(self.stack[-1].tag, ()):
            self.stack.pop()
        el = El(tag, attrs)
        self.stack[-1].kids.append(el)
        if tag not in VOID:
            self.stack.append(el)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].kids.append(El(tag, attrs))

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.stack[-1].kids.append(data)


def tree(page: str) -> El:
    t = Tree()
    t.feed(page)
    t.close()
    return t.root


def _classes(el: El) -> set[str]:
    return set(el.attrs.get("class", "").split())


def _clean(s: str) -> str:
    return re.sub(r"[ \t ]+", " ", s).replace("\r", "").strip()


def strip_furniture(el: El) -> None:
    def bad(k: El) -> bool:
        return k.tag in DROP_TAGS or k.attrs.get("role") in DROP_ROLES or bool(_classes(k) & DROP_CLASSES) or k.attrs.get("id") in DROP_IDS

    todo = [el]
    while todo:
        now = todo.pop()
        now.kids = [k for k in now.kids if not (isinstance(k, El) and bad(k))]
        todo += [k for k in now.kids if isinstance(k, El)]


def find(root: El, kind: str, value: str) -> El | None:
    test = {"tag": lambda e: e.tag == value, "role": lambda e: e.attrs.get("role") == value, "id": lambda e: e.attrs.get("id") == value, "class": lambda e: value in _classes(e)}[kind]
    return next((e for e in root.all() if test(e)), None)


def main_content(root: El) -> El:
    for kind, value in MAIN:
        el = find(root, kind, value)
        if el is not None and len(el.text("")) > 200:
            return el
    return find(root, "tag", "body") or root


def breadcrumbs(root: El) -> list[str]:
    tests = [
        lambda e: "breadcrumb" in _classes(e),
        lambda e: "breadcrumbs" in _classes(e),
        lambda e: e.attrs.get("aria-label") == "breadcrumb",
        lambda e: "BreadcrumbList" in e.attrs.get("itemtype", ""),
    ]
    every = list(root.all())
    boxes = [box for box in (next((e for e in every if test(e)), None) for test in tests) if box is not None]
    for box in boxes:
        out, seen = [], set()
        for e in box.all():
            t = _clean(e.text()) if e.tag in ("a", "li", "span") else ""
            if t and len(t) < 80 and t.lower() not in seen:
                seen.add(t.lower())
                out.append(t)
        if out:
            return out
    return []


def table_record(el: El) -> dict | None:
    rows = [[_clean(c.text()) for c in r.all() if c.tag in ("td", "th")] for r in el.all() if r.tag == "tr"]
    rows = [r for r in rows if any(r)]
    headers = rows.pop(0) if rows and any(e.tag == "th" for e in el.all()) else []
    if not rows:
        return None
    width = max(len(r) for r in [headers, *rows])
    line = lambda r: "| " + " | ".join([*r, *[""] * (width - len(r))]) + " |"
    head = headers or rows[0]
    body = rows if headers else rows[1:]
    caption = next((_clean(e.text()) for e in el.all() if e.tag == "caption"), None)
    return {"caption": caption, "headers": headers, "rows": rows, "markdown": "\n".join([line(head), "|" + " --- |" * width, *map(line, body)])}


def sections(main: El) -> list[dict]:
    """Spans from heading to heading; text before the first has heading "" and level 0."""
    out: list[dict] = []
    now = {"heading": "", "level": 0, "anchor": None}
    lines: list[str] = []

    def close():
        text = "\n".join(lines).strip()
        if text or now["heading"]:
            out.append({**now, "text": text})
        lines.clear()

    for el in main.all():
        if el.tag in HEADINGS:
            close()
            anchor = el.attrs.get("id") or next((a.attrs["name"] for a in el.all() if a.tag == "a" and a.attrs.get("name")), None)
            now = {"heading": _clean(el.text()), "level": int(el.tag[1]), "anchor": anchor}
        elif el.tag in BLOCKS:
            t = _clean(el.text())
            if t and (not lines or lines[-1] != t):
                lines.append(t)
    close()
    return out


def parse_page(page: str, url: str) -> dict:
    root = tree(page or "")
    meta = {}
    for e in root.all():
        if e.tag == "meta" and e.attrs.get("content"):
            for key in ("name", "http-equiv", "property"):
                if e.attrs.get(key):
                    meta.setdefault(e.attrs[key].lower(), e.attrs["content"])
    html = find(root, "tag", "html")
    title = find(root, "tag", "title")
    plain = TITLE.search(page or "")
    hrefs = []
    for e in root.all():
        href = e.attrs.get("href", "").strip() if e.tag == "a" else ""
        if href and not href.startswith(SKIP_SCHEMES):
            try:
                hrefs.append(urljoin(url, href))
            except ValueError:
                pass
    crumbs = breadcrumbs(root)
    strip_furniture(root)
    main = main_content(root)
    text = re.sub(r"\n{3,}", "\n\n", main.text("\n")).strip()
    return {
        "url": url,
        "title": _clean(title.text()) if title is not None else "",
        "title_markup": plain[1] if plain else "",
        "html_lang": (html.attrs.get("lang") or html.attrs.get("xml:lang")) if html is not None else None,
        "meta_lang": meta.get("content-language") or meta.get("language") or meta.get("og:locale"),
        "meta_description": meta.get("description"),
        "breadcrumbs": crumbs,
        "text": text,
        "word_count": len(text.split()),
        "content_hash": hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:16],
        "sections": sections(main),
        "tables": [t for t in (table_record(e) for e in main.all() if e.tag == "table") if t],
        "hrefs": hrefs,
    }


_KINDS = pa.schema(
    [("url", pa.string()), ("title", pa.string()), ("title_markup", pa.string()), ("html_lang", pa.string()), ("meta_lang", pa.string()), ("meta_description", pa.string()), ("breadcrumbs", pa.list_(pa.string())), ("text", pa.string()), ("word_count", pa.int32()), ("content_hash", pa.string())]
    + [("sections", pa.list_(pa.struct([("heading", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("anchor", pa.string())])))]
    + [("tables", pa.list_(pa.struct([("caption", pa.string()), ("headers", pa.list_(pa.string())), ("rows", pa.list_(pa.list_(pa.string()))), ("markdown", pa.string())]))), ("hrefs", pa.list_(pa.string()))]
)


def parse_pages(pages: DataFrame) -> DataFrame:
    """Documents of ``pages(url, html)`` with links split, language and canonical url."""

    def run(batches):
        for batch in batches:
            rows = [{**parse_page(h, u or ""), "url": u} for u, h in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, schema=_KINDS)

    docs = pages.select("url", "html").mapInArrow(run, SCHEMA)
    links = F.transform("hrefs", lambda h: U.canon_url(h))
    return (
        docs.withColumn("source_url", F.col("url"))
        .withColumn("url", U.canon_url(F.col("url")))
        .withColumn("pdf_links", F.array_sort(F.array_distinct(F.filter(links, lambda u: U.is_pdf_url(u)))))
        .withColumn("links", F.array_sort(F.array_distinct(F.filter(links, lambda u: ~U.is_pdf_url(u) & U.in_scope(u)))))
        .withColumn("language", T.detect_language(F.col("source_url"), F.col("html_lang"), F.col("text"), F.col("meta_lang")))
        .withColumn("section_path", U.section_path(F.col("url")))
        .drop("hrefs", "html_lang", "meta_lang")
    )


def native_links(html, base):
    """Canonical in-scope links of a page with double-quoted hrefs, relative ones resolved."""
    found = F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))
    wanted = F.filter(F.transform(found, lambda h: F.trim(h)), lambda h: (h != "") & ~h.rlike("^(" + "|".join(SKIP_SCHEMES) + ")"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(wanted, lambda h: U.canon_url(U.resolve(base, h))), lambda u: U.in_scope(u))))
