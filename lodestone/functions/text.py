"""Text scalars as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

#: Python's white space, as a Java character class.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; null counts as empty."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")).cast("long")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def clean_text(text: Column) -> Column:
    """Runs of blanks, tabs and no-break spaces as one blank; carriage returns go; trimmed."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[ \t ]+", " "), "\r", ""), f"^{SPACE}+|{SPACE}+$", "")


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "\n{3,}", "\n\n"), f"^{SPACE}+|{SPACE}+$", "")


def normalise_arabic(text: Column) -> Column:
    return F.translate(F.regexp_replace(text, rules.ARABIC_MARKS, ""), rules.ARABIC_FROM, rules.ARABIC_TO)


def tokenize(text: Column) -> Column:
    """Lower-cased tokens of two characters or more that are no stop words, in order."""
    plain = F.regexp_replace(normalise_arabic(F.lower(F.coalesce(text, F.lit("")))), rules.ARABIC_PUNCT, " ")
    found = F.regexp_extract_all(plain, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(rules.STOPWORDS))


def script_language(text: Column, threshold: float = 0.15) -> Column:
    """ar, en or unknown by counting letters of the first 20,000 characters."""
    sample = F.substring(F.coalesce(text, F.lit("")), 1, 20000)
    arabic = F.length(F.regexp_replace(sample, f"[^{rules.ARABIC_BLOCKS}]", ""))
    latin = F.length(F.regexp_replace(sample, "[^A-Za-z]", ""))
    total = arabic + latin
    return F.when(total < 20, "unknown").when(arabic / total >= threshold, "ar").when(latin / total >= 0.5, "en").otherwise("unknown")


def detect_language(url: Column, html_lang: Column, text: Column, meta_lang: Column) -> Column:
    """Declared language, then the URL, then the script."""
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    path = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^?#]*)", 1))
    query = F.lower(F.regexp_extract(url, r"\?([^#]*)", 1))
    in_path = lambda names: path.rlike(rf"(^|/)({names})(/|-|_|$)")
    in_query = lambda lang: query.rlike(rf"(^|[?&])(sc_)?lang(uage)?={lang}")
    out = F.when(low(html_lang).startswith("ar"), "ar").when(low(html_lang).startswith("en"), "en")
    out = out.when(low(meta_lang).startswith("ar"), "ar").when(low(meta_lang).startswith("en"), "en")
    out = out.when(in_path("ar|ar-eg|ar-sa|arabic") | in_query("ar"), "ar")
    out = out.when(in_path("en|en-us|en-eg|en-gb|english") | in_query("en"), "en")
    return out.when(F.coalesce(text, F.lit("")) != "", script_language(text)).otherwise("unknown")


def is_rtl(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike("[؀-ۿ]")


def snippet(text: Column, limit: int = 420) -> Column:
    """One line, cut at a word when longer than ``limit``, with an ellipsis."""
    line = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " "))
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(F.regexp_replace(F.substring(line, 1, limit), " [^ ]*$", ""), F.lit(" …")))


def lookup_form(text: Column) -> Column:
    """Decoded, lower-cased, everything but a-z, digits and Arabic as blanks."""
    decoded = F.coalesce(F.try_url_decode(F.coalesce(text, F.lit(""))), text, F.lit(""))
    return F.trim(F.regexp_replace(F.lower(decoded), "[^a-z0-9؀-ۿ]+", " "))


def content_hash(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(16))


def chunk_id(kind: Column, url: Column, index: Column, text: Column) -> Column:
    """Kind and the first 16 hex digits of a digest of place and opening text."""
    return F.concat(kind, F.lit("_"), F.left(F.sha1(F.concat_ws("|", url, kind, index.cast("string"), F.substring(text, 1, 200))), F.lit(16)))


def parse_ts(value: Column) -> Column:
    return F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
