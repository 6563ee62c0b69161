"""Page, query, response and file classifiers as Column functions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _has(value: Column, pattern: str) -> Column:
    return F.coalesce(value, F.lit("")).rlike("(?iu)" + pattern)


def page_type(url: Column, title: Column | None = None, breadcrumbs: Column | None = None) -> Column:
    """product, news, about or other; the URL counts before the title."""
    title = F.lit("") if title is None else F.coalesce(title, F.lit(""))
    blob = F.concat_ws(" ", url, title, F.lit("") if breadcrumbs is None else F.coalesce(breadcrumbs, F.lit("")))
    out = F.when(_has(url, rules.NEWS) | _has(title, rules.NEWS), "news").when(_has(url, rules.ABOUT), "about").when(_has(url, rules.PRODUCT), "product")
    return out.when(_has(blob, rules.ABOUT), "about").when(_has(blob, rules.PRODUCT), "product").otherwise("other")


def record_page_type(url: Column, title: Column, document_type: Column) -> Column:
    """The one derivation used when records are built and when they are checked."""
    return F.when(document_type == "pdf", "product").otherwise(page_type(url, title))


def segment(url: Column, title: Column | None = None) -> Column:
    """consumer, corporate or unknown: the deepest telling path segment, else a clear title."""
    title = F.lit("") if title is None else title
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.\-]*://[^/?#]*)?([^?#]*)", 1)
    parts = F.reverse(F.split(F.lower(F.coalesce(F.try_url_decode(path), path)), "/"))

    def label(s: Column) -> Column:
        s = F.trim(s)
        return F.when((s == "") | _has(s, rules.PATH_IGNORE), F.lit(None).cast("string")).when(_has(s, rules.PATH_CONSUMER), "consumer").when(_has(s, rules.PATH_CORPORATE), "corporate")

    from_path = F.try_element_at(F.filter(F.transform(parts, label), lambda x: x.isNotNull()), F.lit(1))
    corp, cons = _has(title, rules.CORPORATE), _has(title, rules.CONSUMER)
    return F.coalesce(from_path, F.when(corp & ~cons, "corporate").when(cons & ~corp, "consumer").otherwise("unknown"))


def _names(tests: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(test, name) for name, test in tests]))


def intents(query: Column) -> Column:
    q = F.lower(query)
    return _names([(name, _has(q, "|".join(f"(?:{c})" for c in cues))) for name, (cues, _) in rules.INTENTS.items()])


def topics(query: Column) -> Column:
    return _names([(name, _has(query, p)) for name, p in rules.TOPICS.items()])


def query_segment(query: Column) -> Column:
    return F.when(_has(query, rules.CORPORATE), "corporate").when(_has(query, rules.CONSUMER), "consumer").otherwise("consumer_default")


def heading_matches(heading: Column, query_intents: Column) -> Column:
    """Whether a heading holds a word that one of the intents asks for."""
    h = F.lower(F.coalesce(heading, F.lit("")))
    test = F.lit(False)
    for name, (_, heads) in rules.INTENTS.items():
        if heads:
            hit = F.lit(False)
            for word in heads:
                hit = hit | h.contains(word)
            test = test | (F.array_contains(query_intents, name) & hit)
    return (h != "") & test


def visible_text(html: Column) -> Column:
    """Text without tags, scripts and styles, for well-formed pages; one line."""
    no_code = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(no_code, r"<[^>]*>", " "), r"[\s\x{a0}]+", " "))


def challenge_flags(visible: Column, html: Column) -> Column:
    """Names of the interstitial kinds whose markers occur."""
    blob = F.concat(F.lower(visible), F.lit(" "), F.substring(F.lower(html), 1, 4000))
    return _names([(name, _any(blob, marks)) for name, marks in rules.CHALLENGES.items()])


def _any(blob: Column, marks: list[str]) -> Column:
    test = F.lit(False)
    for m in marks:
        test = test | blob.contains(m)
    return test


def looks_not_found(visible: Column) -> Column:
    return _any(F.lower(visible), rules.NOT_FOUND_MARKERS)


def response_class(visible: Column, html: Column) -> Column:
    """blocked, not_found, interstitial or content, in this order."""
    flags = challenge_flags(visible, html)
    return F.when(F.arrays_overlap(flags, F.array(*map(F.lit, rules.BLOCKING))), "blocked").when(looks_not_found(visible), "not_found").when(F.size(flags) > 0, "interstitial").otherwise("content")


def text_hash(visible: Column) -> Column:
    return F.left(F.sha2(F.lower(visible), 256), F.lit(16))


def is_soft_404(visible: Column, learned: list[str] | None = None) -> Column:
    """By learned hashes where there are any, else by markers."""
    return text_hash(visible).isin(learned) if learned else looks_not_found(visible)


def sniff_kind(content_type: Column, head: Column) -> Column:
    """(kind, ext) of a file: its first bytes, then its declared type."""
    h = F.hex(F.substring(head, 1, 16))
    ctype = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    pair = lambda kind, ext: F.struct(F.lit(kind).alias("kind"), F.lit(ext).alias("ext"))
    out = None
    for magic, kind, ext in rules.MAGIC:
        out = (F if out is None else out).when(h.startswith(magic.hex().upper()), pair(kind, ext))
    for name, ext in rules.CONTENT_TYPES.items():
        kind = "pdf" if ext == ".pdf" else "image" if name.startswith("image/") else "other"
        out = out.when(ctype == name, pair(kind, ext))
    return out.when(ctype.isin("", "application/xhtml+xml"), pair("html", ".html")).when(ctype.startswith("text/"), pair("html", ".html")).otherwise(pair("other", ".bin"))


def block_verdict(plain: Column, after_pause: Column, headless: Column, headed: Column) -> Column:
    """Why requests fail, from the response classes of four probes."""
    plain_ok = (plain == "content") | (after_pause == "content")
    headless_blocked = headless == "blocked"
    return (
        F.when((plain == "blocked") & (after_pause == "content"), "rate_limit")
        .when(plain_ok & headless_blocked & (headed == "content"), "headless_fingerprint")
        .when(plain_ok & headless_blocked, "browsers_blocked")
        .when((plain == "blocked") & (after_pause == "blocked"), "address_blocked")
        .otherwise("not_reproduced")
    )


def fingerprint() -> str:
    """Identity of the rule tables, stored with an index to notice stale labels."""
    tables = [rules.NEWS, rules.ABOUT, rules.PRODUCT, rules.CORPORATE, rules.CONSUMER, rules.PATH_CONSUMER, rules.PATH_CORPORATE, rules.PATH_IGNORE, rules.INTENTS, rules.TOPICS]
    return hashlib.sha1(json.dumps(tables, ensure_ascii=False).encode()).hexdigest()[:12]
