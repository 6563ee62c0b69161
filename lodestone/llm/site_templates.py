"""Main text of HTML pages by site template removal.

A lenient tokenizer turns a page into a tree.  Every block subtree is hashed (tag names
and text, numbers taken out), and Spark counts, for each host, on how many different
pages a hash occurs.  Subtrees recurring across many pages of their host are deleted,
with elements that are never content (menus, forms, scripts, notices, adverts ...).

Elements that a page itself declares as its content (article, main) bound the text, but
what recurs inside them is deleted like anything else.  Pages of equal content count
once, so copies of a page do not make its text a template.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: A subtree recurs if it is on so many different pages of its host, whatever the host's size.
MIN_PAGES = 4
#: Html bytes of a cell, where templates are joined.
CELL_BYTES = 16 << 20
#: Hashes of all hosts' templates (8 bytes each) that may be broadcast.
MAX_BROADCAST = 500_000
SCHEMA = "page_id long, url string, text string, n_chars long, n_template long"

#: Fixed values of the HTML standard.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr", "label"}
NEVER = {"head", "script", "style", "noscript", "template", "iframe", "nav", "footer", "aside", "form", "button", "select", "textarea", "input", "option", "object", "embed", "canvas", "audio", "video", "svg", "math", "menu", "dialog", "title", "meta", "link", "applet", "frameset", "noframes"}
MAIN = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "menu", "menubar", "alert", "toolbar"}
#: Closing one of the first is implied by opening one of the second.
CLOSES = {
    "p": {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dd", "dt"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
    "thead": {"tbody", "tfoot"},
    "tbody": {"tbody", "tfoot"},
}
#: Words in class and id names of elements that are no content.
BAD_NAMES = re.compile(
    r"(?:^|[\s_\-])(?:ads?|advert\w*|adbox|adslot|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|topnav|sidenav|breadcrumb\w*|crumbs?|header|masthead|footer|foot|colophon|copyright|"
    r"side|sidebar\w*|rail|aside|widget\w*|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe\w*|signup|login|search\w*|form|comments?|comment\w*|disqus\w*|replies|reply|respond|discussion|feedback|"
    r"share|sharing|social\w*|related|recommend\w*|toolbar|skip\w*|pagination|pager|paging|tags|tagcloud)(?:$|[\s_\-]|\d)",
    re.I,
)

#: Inside declared content only whole names count, and fewer of them.
BAD_IN_MAIN = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|adbox|adslot|adsense|banner|sponsored|promo|nav|navbar|menu|breadcrumbs?|sidebar|cookie\w*|consent|newsletter|subscribe|comments?|disqus\w*|share|sharing|social|notice|popup|modal|overlay)(?:$|\s)",
    re.I,
)

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>")
#: Quotes are followed for so many characters of a tag; a longer tag ends at its first ">".
MAX_QUOTED = 4096
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Node:
    """An element with child nodes and text runs in page order.

    ``in_main``: it is, or lies in, declared content.  ``skipped``: it is never content,
    or lies in what never is.  ``filled``: it holds text that is not skipped.
    """

    __slots__ = ("tag", "names", "role", "hidden", "children", "in_main", "skipped", "filled", "digest")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.children = tag, []
        self.names = self.role = ""
        self.hidden = self.filled = False
        self.digest = b""
        if attrs and not attrs.isspace():
            for name, a, b, c in _ATTR.findall(attrs):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    self.names += " " + value
                elif name == "role":
                    self.role = value.strip().lower()
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
                    self.hidden = True
        above = parent is not None and parent.in_main
        self.in_main = above or tag in MAIN or self.role == "main"
        self.skipped = parent is not None and (parent.skipped or never_content(self, above))


def never_content(node: Node, in_main: bool) -> bool:
    """Elements that hold no main text whatever the site."""
    if node.tag in NEVER or node.hidden or node.role in ROLES:
        return True
    if node.tag == "header" and not in_main:
        return True
    if not node.names or node.tag in MAIN or node.tag in ("html", "body"):
        return False
    return (BAD_IN_MAIN if in_main else BAD_NAMES).search(node.names) is not None


def parse(page: str) -> list[Node]:
    """Elements in page order, the root first, for any input, in time linear in its length.

    Unknown ends are ignored, open elements end with their parent, a tag that the page's
    end cuts off is dropped.
    """
    root = Node("#root")
    nodes, stack, open_tags = [root], [root], {"#root": 1}
    at = pos = 0
    last = page.rfind(">")
    while True:
        m = _OPEN.search(page, pos)
        if m is None:
            if at < len(page):
                stack[-1].children.append(page[at:])
            return nodes
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.start()
        comment, data, other, closing, tag = m.groups()
        if comment or data:
            end = page.find("-->" if comment else "]]>", m.end())
            if end < 0:
                return nodes
            at = pos = end + 3
            continue
        if m.end() > last + 1 or last < 0:
            return nodes  # no tag ends from here on
        if other:
            end = page.find(">", m.end())
            if end < 0:
                return nodes
            at = pos = end + 1
            continue
        rest = _REST.match(page, m.end(), m.end() + MAX_QUOTED)
        end = rest.end() if rest else page.find(">", m.end()) + 1
        if not end:
            return nodes
        attrs = page[m.end() : end - 1]
        at = pos = end
        tag = tag.lower()
        if closing:
            if open_tags.get(tag):
                while True:
                    gone = stack.pop()
                    open_tags[gone.tag] -= 1
                    if gone.tag == tag:
                        break
            elif tag == "p":
                stack[-1].children.append(Node("p", "", stack[-1]))
                nodes.append(stack[-1].children[-1])
            continue
        while len(stack) > 1 and tag in CLOSES.get(stack[-1].tag, ()):
            open_tags[stack.pop().tag] -= 1
        if tag not in INLINE and open_tags.get("p") and tag in CLOSES["p"]:
            # an open paragraph ends even inside inline elements
            k = len(stack) - 1
            while stack[k].tag != "p" and stack[k].tag in INLINE:
                k -= 1
            if stack[k].tag == "p":
                for gone in stack[k:]:
                    open_tags[gone.tag] -= 1
                del stack[k:]
        node = Node(tag, attrs, stack[-1])
        stack[-1].children.append(node)
        nodes.append(node)
        if tag in RAW:
            end = _raw_end(page, at, tag)
            if end is None:
                node.children.append(page[at:])
                return nodes
            node.children.append(page[at : end[0]])
            at = pos = end[1]
        elif tag not in VOID and not attrs.rstrip().endswith("/"):
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1


def _raw_end(page: str, at: int, tag: str) -> tuple[int, int] | None:
    end = _RAW_END[tag].search(page, at)
    return end and end.span()


_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def digest_subtrees(nodes: list[Node]) -> None:
    """Set ``digest`` and ``filled`` of every element: a hash of its tag, texts and children's hashes.

    Children come after their parents in page order, so one backward pass is enough and
    each text is hashed once, however deep it lies.
    """
    for node in reversed(nodes):
        if node.skipped:
            continue
        parts = [node.tag.encode()]
        for c in node.children:
            if isinstance(c, str):
                t = _SPACE.sub(" ", c).strip()
                if t:
                    node.filled = True
                    parts.append(b"t" + _DIGITS.sub("0", t).encode("utf-8", "surrogatepass"))
            elif not c.skipped:
                node.filled = node.filled or c.filled
                parts.append(b"e" + c.digest)
        if len(parts) > 1 or node.tag not in INLINE:
            node.digest = hashlib.blake2b(b"\0".join(parts), digest_size=8).digest()


def hash_of(node: Node) -> int:
    return int.from_bytes(node.digest, "little", signed=True)


def subtrees(nodes: list[Node]) -> list[Node]:
    """Block elements with content that may be a template."""
    return [n for n in nodes if not n.skipped and n.tag not in INLINE and n.tag not in ("#root", "html", "body") and (n.filled or any(not isinstance(c, str) and not c.skipped for c in n.children))]


def main_roots(nodes: list[Node]) -> list[Node]:
    """The outermost declared content elements with text outside of non-content, or the whole page."""
    found, inside = [], set()
    for n in nodes:
        within = id(n) in inside
        if not within and n.in_main and not n.skipped:
            if n.filled:
                found.append(n)
            within = True
        if within:
            inside.update(id(c) for c in n.children if not isinstance(c, str))
    return found or [nodes[0]]


def block_texts(start: Node, dropped: set[int]) -> list[str]:
    """The texts of blocks in page order.

    A character reference is decoded in its own run of text, so none arises by removing a
    tag between its letters.
    """
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip()
            if text:
                out.append(text)
            run.clear()

    stack = [(start, iter(start.children))]
    while stack:
        node, rest = stack[-1]
        for c in rest:
            if isinstance(c, str):
                run.append(html_lib.unescape(c) if "&" in c else c)
                continue
            if c.tag not in INLINE:
                flush()
            if not c.skipped and id(c) not in dropped:
                stack.append((c, iter(c.children)))
                break
        else:
            stack.pop()
            if node.tag not in INLINE:
                flush()
    flush()
    return out


def candidates(page: str) -> tuple[list[int], list[int]]:
    """Hashes of a page's block subtrees, and of those that make up its content (all, if it declares none)."""
    nodes = parse(page)
    digest_subtrees(nodes)
    everything = sorted({hash_of(n) for n in subtrees(nodes)})
    roots = main_roots(nodes)
    return everything, everything if roots[0] is nodes[0] else sorted({hash_of(r) for r in roots})


def extract(page: str, template: set[int], salt: int = 0) -> tuple[str, int]:
    """Main text of a page and the number of template subtrees deleted (``template``: hashes ^ ``salt``)."""
    nodes = parse(page)
    digest_subtrees(nodes)
    dropped = {id(n) for n in subtrees(nodes) if hash_of(n) ^ salt in template} if template else set()
    out: list[str] = []
    for r in main_roots(nodes):
        if id(r) not in dropped:
            out += block_texts(r, dropped)
    return " ".join(out), len(dropped)


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``page_id, url, text, n_chars, n_template`` for every row of ``pages(page_id, url, html)``.

    Null and empty html give an empty text; a null url has the empty host.  Repeated
    rows give repeated results and count once as pages.  Any depth of nesting and any
    length are walked without recursion, in linear time.  Other columns are ignored; an
    empty table gives an empty result.  Text is never cut.
    """
    C.bound_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("salt", F.xxhash64(_host(F.col("url"))))

    def hash_rows(batches):
        for batch in batches:
            body, keys = [], []
            for salt, page in zip(batch.column("salt").to_pylist(), batch.column("html").to_pylist()):
                got, content = candidates(page)
                if got:
                    keys.append([h ^ salt for h in got])
                    body.append(int.from_bytes(hashlib.blake2b(np.array([salt, *content], "<i8").tobytes(), digest_size=8).digest(), "little", signed=True))
            yield pa.RecordBatch.from_arrays([pa.array(body, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["body", "keys"])

    # keys are hashes of a subtree with its host; pages of equal content count once, and
    # both counts combine before they are shuffled
    trees = rows.select("salt", "html").mapInArrow(hash_rows, "body long, keys array<long>").groupBy("body").agg(F.min("keys").alias("keys"))
    counts = trees.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("on"))
    recurring = C.cut(counts.where(F.col("on") >= min_pages).select("key"))
    if recurring.count() <= max_broadcast:
        # templates travel to every executor, and no page moves
        every = pages.sparkSession.sparkContext.broadcast(recurring.toArrow().column("key").to_numpy())

        def texts(batches):
            template = set(every.value.tolist())
            for batch in batches:
                yield from _texts(pa.Table.from_batches([batch]), template).to_batches()

        return rows.mapInArrow(texts, SCHEMA)

    # a cell asks once for each of its keys, so a template on all pages of a large host
    # costs an entry per cell
    n_cells = C.parts(C.column_bytes(rows, "html"), CELL_BYTES)
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(n_cells)).cast("int"))

    def ask(batches):
        for batch in batches:
            cells, keys = [], []
            for cell, salt, page in zip(*(batch.column(c).to_pylist() for c in ("cell", "salt", "html"))):
                got = candidates(page)[0]
                cells += [cell] * len(got)
                keys += [h ^ salt for h in got]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(keys, pa.int64())], names=["cell", "key"])

    asked = dealt.select("cell", "salt", "html").mapInArrow(ask, "cell int, key long").distinct().join(recurring, "key").select("cell", "key")

    def finish(key, table, back):
        return _texts(table, set(back.column("key").to_pylist()))

    return dealt.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(finish, SCHEMA)


def _texts(table: pa.Table, template: set[int]) -> pa.Table:
    got = [extract(p, template, s) for p, s in zip(table.column("html").to_pylist(), table.column("salt").to_pylist())]
    return pa.table(
        {"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array([t for t, _ in got], pa.string()), "n_chars": pa.array([len(t) for t, _ in got], pa.int64()), "n_template": pa.array([n for _, n in got], pa.int64())}
    )
