"""Quality rules: distribution divergence, with DataFrame functions only.

Every document has two histograms: its characters by class, and its common words (a
short list for each language, and all other words as one bin).  A language's reference
is the sum of the histograms of all documents declared in it that are long enough.  The
distance of a document is the Jensen-Shannon distance (base 2, 0 to 1) to the nearest
reference, for each of the two.  Documents under the minimum lengths are not judged by
distance, as short texts have unsteady histograms; the base rules still hold for them.

Everything is computed row by row inside the scan: words and lines by regular
expressions, repeated windows by sorting the hashes of a document's own windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Very common words of four languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "be", "with", "an", "or", "as", "at", "by"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au", "sur", "pas", "avec"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "no", "una", "su", "al", "lo"],
}
#: Character classes, taken off the text one after the other; what is left is "other".
CHAR_CLASSES = [("lower_ascii", "[a-z]++"), ("space", r"[\x20\x09-\x0D]++"), ("stop", r"[.,;:!?'\"()\-]++"), ("upper", r"\p{Lu}++"), ("lower_other", r"\p{Ll}++"), ("digit", "[0-9]++"), ("symbol", r"[#*$%&|<>]++")]

#: Shorter texts are not judged by distance.
MIN_WORDS, MIN_CHARS = 50, 200
#: Alone, or both together, these distances reject a text.
MAX_CHAR_DISTANCE = 0.28
BOTH_CHAR_DISTANCE, BOTH_WORD_DISTANCE = 0.15, 0.29

WORD_BREAK = r"[\x20\x09-\x0D]++"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a lambda is the binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK), "")


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found at least twice in the text."""

    def count(w: Column) -> Column:
        n = F.size(w) - (width - 1)
        runs = F.arrays_zip(*[F.slice(w, k + 1, n).alias(f"w{k}") for k in range(width)])
        return let(F.transform(runs, lambda r: F.xxhash64(r)), windows)

    def windows(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, covered))

    def covered(s: Column) -> Column:
        after = F.concat(F.slice(s, 2, F.size(s)), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
        before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(s, 1, F.size(s) - 1))
        near = F.arrays_zip(s.alias("x"), before.alias("b"), after.alias("a"))
        same = F.filter(near, lambda r: (r["x"]["h"].eqNullSafe(r["b"]["h"])) | (r["x"]["h"].eqNullSafe(r["a"]["h"])))
        places = F.flatten(F.transform(same, lambda r: F.sequence(r["x"]["i"], r["x"]["i"] + (width - 1))))
        return F.size(F.array_distinct(places))

    return F.when(F.size(words) < width + 1, F.lit(0)).otherwise(count(words))


def word_list() -> list[str]:
    out: list[str] = []
    for words in COMMON_WORDS.values():
        out += [w for w in words if w not in out]
    return out


def with_histograms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang, n_words`` and so on, with ``chars`` and ``common`` histograms."""
    listed = word_list()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    first = docs.select(F.col(id_col).alias("doc_id"), lang.alias("lang"), text.alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left, counts = first.withColumn("left", F.col("text")), []
    for name, pattern in CHAR_CLASSES:
        left = left.withColumn(f"n_{name}", F.length("left")).withColumn("left", F.regexp_replace("left", pattern, ""))
        left = left.withColumn(f"n_{name}", (F.col(f"n_{name}") - F.length("left")).cast("double"))
        counts.append(f"n_{name}")
    counted = left.select(
        "row",
        "doc_id",
        "lang",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.col("n_symbol").cast("long").alias("n_symbols"),
        F.array(*counts, F.length("left").cast("double")).alias("chars"),
        F.length("text").cast("double").alias("n_chars"),
        (F.length("text") - F.col("n_space")).cast("long").alias("word_chars"),
    )
    found = F.filter("words", lambda w: w.isin(listed))
    counted = counted.select(
        "row",
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).cast("long").alias("n_repeat_words"),
        "chars",
        "n_chars",
        # one letter a common word, so that counting is a matter of string lengths
        let(F.array_join(F.transform(found, lambda w: _letter(w, listed)), ""), lambda s: F.array(*[(F.length(s) - F.length(F.replace(s, F.lit(chr(0x4E00 + k)), F.lit("")))).cast("double") for k in range(len(listed))])).alias("listed"),
    )
    return counted.withColumn("common", F.concat("listed", F.array(F.col("n_words") - F.aggregate("listed", F.lit(0.0), lambda a, x: a + x)))).drop("listed")


def _letter(w: Column, listed: list[str]) -> Column:
    pairs = [x for k, word in enumerate(listed) for x in (F.lit(word), F.lit(chr(0x4E00 + k)))]
    return F.element_at(F.create_map(*pairs), w)


def references(hist: DataFrame) -> list[dict]:
    """The languages' summed histograms as shares: one row a language of the fixed list."""
    n_chars, n_words = len(CHAR_CLASSES) + 1, len(word_list()) + 1
    long_enough = hist.where((F.col("n_words") >= MIN_WORDS) & (F.col("n_chars") >= MIN_CHARS) & F.col("lang").isin(list(COMMON_WORDS)))
    sums = long_enough.groupBy("lang").agg(*[F.sum(F.col("chars")[k]).alias(f"c{k}") for k in range(n_chars)], *[F.sum(F.col("common")[k]).alias(f"w{k}") for k in range(n_words)])
    out = []
    for r in sorted(sums.collect(), key=lambda r: r["lang"]):  # at most one row for each language of the list
        c, w = [r[f"c{k}"] for k in range(n_chars)], [r[f"w{k}"] for k in range(n_words)]
        out.append({"lang": r["lang"], "chars": [x / sum(c) for x in c], "common": [x / sum(w) for x in w]})
    return out


def divergence(hist: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2) between a histogram and shares; 0 for an empty histogram."""

    def term(x: Column, q: Column) -> Column:
        p = x / total
        half = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / half)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / half)).otherwise(0.0)

    terms = F.aggregate(F.zip_with(hist, F.array(*[F.lit(float(q)) for q in reference]), term), F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), terms / 2))).otherwise(0.0)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, ``base_failed``, both distances, and ``kept``.

    Null and empty texts have no words and fail the base rules.  Without a reference (no
    document long enough) distances are 0.  Only id, text and lang are read; other
    columns do not clash.  Repeated rows are judged alike; an empty table gives an empty
    result.
    """
    hist = with_histograms(docs, id_col, text_col)
    refs = references(hist)
    total = F.col("n_words").cast("double")
    base = F.col("n_words") < 50
    base_failed = base | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    nearest = lambda name, n: F.least(*[divergence(F.col(name), n, r[name]) for r in refs], *([F.lit(1.0)] if len(refs) == 1 else [])) if refs else F.lit(0.0)
    guard = (F.col("n_words") >= MIN_WORDS) & (F.col("n_chars") >= MIN_CHARS)
    far = (F.col("char_distance") > MAX_CHAR_DISTANCE) | ((F.col("char_distance") > BOTH_CHAR_DISTANCE) & (F.col("word_distance") > BOTH_WORD_DISTANCE))
    return (
        hist.withColumn("char_distance", F.round(nearest("chars", F.col("n_chars")), 6))
        .withColumn("word_distance", F.round(nearest("common", total), 6))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~(F.col("base_failed") | (guard & far)))
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, distances and the verdict of every row."""
    return judged(docs, id_col, text_col).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept.

    Null, empty and short texts fail the base rules and go; rows with null ids, repeated
    rows and very long texts are judged like others; an empty table gives an empty result.
    """
    # a filter would be pushed below the projections and compute all of them again in its
    # condition; unpacking an array of the row, or of none, is not
    return judged(docs, id_col, text_col).select(F.inline(F.when(F.col("kept"), F.array("row"))))
