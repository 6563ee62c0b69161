"""DuckDB SQL of the training-data queries that SQL can express over the driver tables."""

from __future__ import annotations

from . import quality as Q

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PAGES = """
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) body from pages),
b as (select page_id, url, regexp_replace(regexp_replace(regexp_replace(body, '(?s)<!--.*?-->', '', 'g'), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') body from a),
c as (select page_id, url, trim(regexp_replace(replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')) text from b)
select page_id, url, text, length(text) n_chars, 0 n_template from c"""

WINDOWS = f"""
with d as (select doc_id, {_WORDS} w from documents),
s as (select doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) h from (select doc_id, w, unnest(range(1, len(w) - 33)) i from d where len(w) >= 35)),
r as (select doc_id, i from s where h in (select h from s group by h having count(*) > 1)),
g as (select distinct doc_id, i + k p from r, range(35) x(k)),
k as (select d.doc_id, string_agg(w[i], ' ' order by i) kept, count(*) n from (select doc_id, w, unnest(range(1, len(w) + 1)) i from d) d left join g on d.doc_id = g.doc_id and d.i = g.p where g.p is null group by d.doc_id)
select d.doc_id, len(w) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 from d left join k using (doc_id)"""

COMPONENTS = f"""
with recursive d as (select doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') w from documents),
s as (select distinct doc_id, md5(array_to_string(w[i : i + 4], ' ')) h from (select doc_id, w, unnest(case when len(w) = 0 then [] when len(w) < 5 then [1] else range(1, len(w) - 3) end) i from d)),
n as (select doc_id, count(*) n from s group by doc_id),
x as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by all),
l as (select a, b from x join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 80 * (p.n + q.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id a, doc_id b from documents union select r.a, e.b from r join e on r.b = e.a)
select doc_id, coalesce(n, 0) n_shingles, (select min(b) from r where r.a = doc_id) component_id from documents left join n using (doc_id)"""

BYTES = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) x from documents),
s as (select doc_id, i, md5(substr(x, 2 * i + 1, 200)) h from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) i from d where length(x) >= 200)),
o as (select doc_id, i, row_number() over (partition by h order by doc_id, i) k from s),
p as (select doc_id, i, lag(i) over (partition by doc_id order by i) before from o where k > 1),
q as (select doc_id, i, sum(case when before is null or i > before + 100 then 1 else 0 end) over (partition by doc_id order by i) run from p),
g as (select doc_id, run, min(i) lo, max(i) + 100 hi from q group by all),
z as (select doc_id, run, hi from_, lead(lo) over (partition by doc_id order by run) to_ from g),
kept as (select d.doc_id, substr(x, 1, 2 * coalesce((select min(lo) from g where g.doc_id = d.doc_id), length(x) // 2)) || coalesce((select string_agg(substr(x, 2 * from_ + 1, 2 * (coalesce(to_, length(x) // 2) - from_)), '' order by run) from z where z.doc_id = d.doc_id), '') y, x from d)
select doc_id, length(x) // 2 n_bytes, (length(x) - length(y)) // 2 n_removed, (select count(*) from g where g.doc_id = kept.doc_id) n_spans, sha256(unhex(y)) kept_sha256 from kept"""


def quality_sql() -> str:
    listed = Q.word_list()
    left, columns, rest = "text", [], ["t0"]
    steps = ["select doc_id, lang, coalesce(text, '') t0, coalesce(text, '') text from documents"]
    for k, (name, pattern) in enumerate(Q.CHAR_CLASSES):
        re2 = pattern.replace("++", "+").replace("'", "''")
        steps.append(f"select *, regexp_replace(t{k}, '{re2}', '', 'g') t{k + 1} from c{k}")
        columns.append(f"(length(t{k}) - length(t{k + 1}))::double")
    n = len(Q.CHAR_CLASSES)
    columns.append(f"length(t{n})::double")
    ctes = ", ".join(f"c{k} as ({s})" for k, s in enumerate(steps))
    names = "[" + ", ".join(f"'{w}'" for w in listed) + "]"

    def distance(hist: str, total: str, ref: str) -> str:
        terms = (
            f"list_sum(list_transform(range(1, len({hist}) + 1), lambda k: "
            f"(case when {hist}[k] > 0 then {hist}[k] / {total} * log2({hist}[k] / {total} / (({hist}[k] / {total} + {ref}[k]) / 2)) else 0 end) "
            f"+ (case when {ref}[k] > 0 then {ref}[k] * log2({ref}[k] / (({hist}[k] / {total} + {ref}[k]) / 2)) else 0 end)))"
        )
        return f"case when {total} > 0 then sqrt(greatest(0.0, {terms} / 2)) else 0.0 end"

    return f"""
with {ctes},
h as (select doc_id, lang, text, {_WORDS} w, [{', '.join(columns)}] chars, length(text)::double n_chars, (length(t1) - length(t2)) spaces, (length(t6) - length(t7)) n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) lines from c{n}),
f as (select *, list_filter(w, lambda x: list_contains({names}, x)) hits from h),
u as (select *, list_transform({names}, lambda x: len(list_filter(hits, lambda y: y = x))::double) listed from f),
v as (select *, list_append(listed, len(w)::double - list_sum(listed)) common from u),
sums as (select lang, list_transform(range(1, {n + 2}), lambda k: list_sum(list_transform(cs, lambda x: x[k]))) cs, list_transform(range(1, {len(listed) + 2}), lambda k: list_sum(list_transform(ws, lambda x: x[k]))) ws
  from (select lang, list(chars) cs, list(common) ws from v where len(w) >= {Q.MIN_WORDS} and n_chars >= {Q.MIN_CHARS} and lang in ('en', 'fr', 'de', 'es') group by lang)),
refs as (select lang rl, list_transform(cs, lambda x: x / list_sum(cs)) rc, list_transform(ws, lambda x: x / list_sum(ws)) rw from sums),
dist as (select doc_id, round(min({distance('chars', 'n_chars', 'rc')}), 6) char_distance, round(min({distance('common', 'len(w)::double', 'rw')}), 6) word_distance from v, refs group by doc_id),
win as (select doc_id, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) k from (select doc_id, w, unnest(range(1, len(w) - 1)) i from h where len(w) >= 3)),
rep as (select doc_id, count(distinct i + j) n from (select doc_id, i, count(*) over (partition by doc_id, k) c from win), range(3) x(j) where c > 1 group by doc_id),
b as (select v.doc_id, len(w) n_words, length(text) - spaces word_chars, n_symbols, len(lines) - len(list_distinct(lines)) n_dup_lines, coalesce(rep.n, 0) n_repeat_words, n_chars, char_distance, word_distance from v join dist using (doc_id) left join rep using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or (n_words >= {Q.MIN_WORDS} and n_chars >= {Q.MIN_CHARS} and (char_distance > {Q.MAX_CHAR_DISTANCE} or (char_distance > {Q.BOTH_CHAR_DISTANCE} and word_distance > {Q.BOTH_WORD_DISTANCE})))) kept, char_distance, word_distance from b"""


def sql() -> dict[str, str]:
    return {
        "op1_site_template_removal": PAGES,
        "op3_distribution_divergence": quality_sql(),
        "op5_ngram_jaccard_join": COMPONENTS,
        "op9_substring_dedup": WINDOWS,
        "op10_suffix_array_dedup": BYTES,
    }
