"""URL scalars as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

_PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
#: Escapes that stay plain characters in a canonical path.
_PLAIN = [("%2F", "/"), ("%3A", ":"), ("%40", "@"), ("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%2B", "+"), ("%2C", ","), ("%3B", ";"), ("%3D", "="), ("%7E", "~")]


def canon_url(url: Column, case_sensitive: bool = False) -> Column:
    """One form for all spellings of a page's address.

    Fragment and noise parameters go, parameters are sorted, host and scheme are lower
    case, the path is decoded, squeezed, lower-cased and encoded again.
    """
    u = F.trim(url)
    part = lambda k: F.regexp_extract(u, _PARTS, k)
    kept = F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(rules.NOISE_PARAMS))
    query = F.array_join(F.array_sort(kept), "&")
    path = F.coalesce(F.try_url_decode(part(3)), part(3))
    path = F.regexp_replace(path, "/{2,}", "/")
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    path = path if case_sensitive else F.lower(path)
    path = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    for code, char in _PLAIN:
        path = F.replace(path, F.lit(code), F.lit(char))
    scheme, host = F.lower(part(1)), F.lower(part(2))
    front = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""))
    path = F.when((host != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.concat(front, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments carried out."""
    parts = F.split(path, "/")
    dot = lambda x: x.isin(".", "..")

    def step(done: Column, x: Column) -> Column:
        # the first element stands for the leading slash and is never taken away
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(x == "..", up).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(F.array_join(kept, "/"), F.when(dot(F.element_at(parts, -1)), "/").otherwise(""))


def resolve(base: Column, href: Column) -> Column:
    """The absolute address of a link on a page, as browsers find it, without its fragment."""
    h = F.regexp_replace(F.trim(href), "#.*$", "")
    part = lambda k: F.regexp_extract(base, _PARTS, k)
    scheme, origin = F.concat(part(1), F.lit(":")), F.concat(part(1), F.lit("://"), part(2))
    path, query = F.regexp_extract(h, r"^([^?]*)", 1), F.regexp_extract(h, r"(\?.*)$", 1)
    folder = F.concat(F.regexp_extract(F.when(part(3) == "", F.lit("/")).otherwise(part(3)), "^(.*/)", 1))
    own_query = F.when(base.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), part(4))).otherwise("")
    return (
        F.when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.\\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h == "", F.concat(origin, part(3), own_query))
        .when(h.startswith("?"), F.concat(origin, part(3), h))
        .when(h.startswith("/"), F.concat(origin, _without_dots(path), query))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), query))
    )


def url_key(canon: Column) -> Column:
    return F.sha1(canon)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def any_pattern(value: Column, patterns: list[str]) -> Column:
    return value.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def is_pdf_url(url: Column) -> Column:
    return any_pattern(url, [rules.PDF_PATTERN])


def is_attachment(url: Column) -> Column:
    return any_pattern(url, rules.ATTACHMENT_PATTERNS)


def in_scope(url: Column, hosts: list[str] | None = None) -> Column:
    """http(s), an allowed host (any if none are given), and a PDF or nothing to skip."""
    ok = url.rlike("(?i)^https?://")
    if hosts is not None:
        ok = ok & host_of(url).isin(hosts)
    return ok & (is_pdf_url(url) | ~any_pattern(url, rules.SKIP_PATTERNS))


def section_path(url: Column) -> Column:
    """Path segments without the empty ones and the language."""
    return F.filter(F.split(F.regexp_extract(url, _PARTS, 3), "/"), lambda s: ~s.isin("", "en", "ar"))


def last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def citation(url: Column, anchor: Column) -> Column:
    return F.concat_ws("#", url, F.nullif(anchor, F.lit("")))


def mirror_url(path: Column, base: str) -> Column:
    """Address of a file of a mirrored site, from its path under the mirror's root."""
    p = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"(?i)\.(html?|xhtml)$", "")
    p = F.regexp_replace(F.regexp_replace(p, "/index$", ""), "^index$", "")
    return canon_url(F.concat(F.lit(base.rstrip("/") + "/"), p))
