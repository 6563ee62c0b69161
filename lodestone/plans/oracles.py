"""DuckDB SQL that gives the same rows as the queries of ``catalogue``."""

from __future__ import annotations

from ..functions import rules


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(_s, words)) + "]"


def _any_of(col: str, patterns: list[str]) -> str:
    return f"regexp_matches({col}, {_s('(?i)' + '|'.join(f'(?:{p})' for p in patterns))})"


def _tokens(col: str) -> str:
    plain = f"regexp_replace(translate(regexp_replace(lower(coalesce({col}, '')), {_s(rules.ARABIC_MARKS)}, '', 'g'), {_s(rules.ARABIC_FROM)}, {_s(rules.ARABIC_TO)}), {_s(rules.ARABIC_PUNCT)}, ' ', 'g')"
    return f"list_filter(regexp_extract_all({plain}, '[\\p{{L}}\\p{{N}}_]+'), lambda t: length(t) > 1 and not list_contains({_list(rules.STOPWORDS)}, t))"


def _words(col: str) -> str:
    return f"list_filter(string_split_regex(coalesce({col}, ''), '[\\s\\x0b]+'), lambda w: w <> '')"


_CANON = f"""
canon_parts as (
  select page_id, url, html, lower(regexp_extract(trim(url), '^([a-zA-Z][a-zA-Z0-9+.\\-]*):', 1)) scheme, lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)) host,
    regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) path, regexp_extract(trim(url), '^[^?#]*\\?([^#]*)', 1) query
  from pages),
canon as (
  select page_id, url, html, scheme || '://' || host || lower(case when length(p) > 1 then rtrim(p, '/') else p end) || case when q = '' then '' else '?' || q end canon,
    lower(case when length(p) > 1 then rtrim(p, '/') else p end) canon_path
  from (select *, regexp_replace(path, '/+', '/', 'g') p,
    array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' and not list_contains({_list(rules.NOISE_PARAMS)}, lower(string_split(x, '=')[1])))), '&') q from canon_parts))"""

_TOK = f"tok as (select doc_id, {_tokens('text')} tokens from documents), post as (select doc_id, term, count(*) tf from (select doc_id, unnest(tokens) term from tok) group by all)"
_STATS = "stats as (select count(*) n, avg(len(tokens)) avg_len from tok), term_stat as (select term, count(*) df, ln(1 + ((select n from stats) - count(*) + 0.5) / (count(*) + 0.5)) idf, (select n from stats) >= 25 and count(*) / (select n from stats) > 0.35 bp from post group by term)"


def _bm25(query: str) -> str:
    """BM25 of a query text, an expression over ``benchmark``."""
    return f"""{_TOK}, {_STATS},
asked as (select item_id, term, count(*) qtf from (select item_id, unnest({_tokens(query)}) term from benchmark) group by all),
scored as (select item_id, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.4 + 0.4 * len(tokens) / (select avg_len from stats)))), 4) score
  from asked join term_stat using (term) join post using (term) join tok using (doc_id) where not bp group by all having sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.4 + 0.4 * len(tokens) / (select avg_len from stats)))) > 0),
lex as (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from scored)"""


_BM25 = _bm25("text")
_DENSE = """dn as (select q.vec_id query_id, p.vec_id record_ord, list_inner_product(q.embedding::double[], p.embedding::double[]) score from embeddings q, embeddings p where q.vec_id % 100 = 0),
dr as (select *, row_number() over (partition by query_id order by round(score, 12) desc, record_ord) rank from dn)"""
#: The questions of the hybrid queries: a passage and words that show an intent.
QUESTION = "(text || ([' annual fee', ' who can apply', ' compare cards', ''])[item_id % 4 + 1])"
_SLOTS = """(('0x' || m[1:2])::bigint + ('0x' || m[3:4])::bigint * 256 + ('0x' || m[5:6])::bigint * 65536 + ('0x' || m[7:8])::bigint * 16777216)"""
_HASHED = f"""tk as (select 'd' k, doc_id id, md5('0:' || unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+'))) m from documents union all
  select 'q', item_id, md5('0:' || unnest(regexp_extract_all(lower({QUESTION}), '[\\p{{L}}\\p{{N}}_]+'))) from benchmark),
sl as (select k, id, {_SLOTS} % 64 slot, sum(case when ('0x' || m[9:10])::bigint % 2 = 1 then 1.0 else -1.0 end)::double w from tk group by all),
hv as (select k, id, slot, w / sqrt(sum(w * w) over (partition by k, id)) v from sl),
dn as (select q.id query_id, d.id record_ord, sum(q.v * d.v) score from hv q join hv d on q.slot = d.slot where q.k = 'q' and d.k = 'd' group by all),
dr as (select *, row_number() over (partition by query_id order by round(score, 12) desc, record_ord) rank from dn)"""
_FUSED = f"""{_bm25(QUESTION)}, {_HASHED},
fused as (select coalesce(d.query_id, l.item_id) query_id, coalesce(d.record_ord, l.doc_id) record_ord, d.score dense_score, l.score bm25_score, d.rank dense_rank, l.rank bm25_rank, coalesce(1.0::double / (60 + d.rank), 0) + coalesce(0.55::double / (60 + l.rank), 0) rrf
  from (select * from dr where rank <= 50) d full outer join (select * from lex where rank <= 50) l on d.query_id = l.item_id and d.record_ord = l.doc_id)"""
_TITLE = "coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '')"


def _has(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {_s('(?i)' + pattern)})"


def _page_type(url: str, title: str) -> str:
    blob = f"({url} || ' ' || {title} || ' ')"
    return (
        f"case when {_has(url, rules.NEWS)} or {_has(title, rules.NEWS)} then 'news' when {_has(url, rules.ABOUT)} then 'about' when {_has(url, rules.PRODUCT)} then 'product' "
        f"when {_has(blob, rules.ABOUT)} then 'about' when {_has(blob, rules.PRODUCT)} then 'product' else 'other' end"
    )


def _segment(url: str, title: str) -> str:
    path = f"lower(regexp_extract({url}, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1))"
    label = f"case when trim(s) = '' or {_has('trim(s)', rules.PATH_IGNORE)} then null when {_has('trim(s)', rules.PATH_CONSUMER)} then 'consumer' when {_has('trim(s)', rules.PATH_CORPORATE)} then 'corporate' end"
    corp, cons = _has(title, rules.CORPORATE), _has(title, rules.CONSUMER)
    return f"coalesce(list_filter(list_transform(list_reverse(string_split({path}, '/')), lambda s: {label}), lambda x: x is not null)[1], case when {corp} and not {cons} then 'corporate' when {cons} and not {corp} then 'consumer' else 'unknown' end)"


_VISIBLE = "trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<noscript\\b[^>]*>.*?</noscript\\s*>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[\\s\\x0b\\x{a0}]+', ' ', 'g'))"


def _marks(col: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({col}, {_s(w)})" for w in words) + ")"


_LANG = "case when regexp_matches(path, '(^|/)(ar|ar-eg|ar-sa|arabic)(/|-|_|$)') then 'ar' when regexp_matches(path, '(^|/)(en|en-us|en-eg|en-gb|english)(/|-|_|$)') then 'en' else 'unknown' end"
_SCRIPT = f"""select doc_id, case when a + l < 20 then 'unknown' when a / (a + l) >= 0.15 then 'ar' when l / (a + l) >= 0.5 then 'en' else 'unknown' end language
from (select doc_id, length(regexp_replace(x, '[^{rules.ARABIC_BLOCKS}]', '', 'g')) a, length(regexp_replace(x, '[^A-Za-z]', '', 'g')) l from (select doc_id, substring(coalesce(text, ''), 1, 20000) x from documents))"""
_RESPONSE = (
    f"resp as (select page_id, v, lower(v) || ' ' || substring(lower(html), 1, 4000) blob, lower(v) lv from (select page_id, html, {_VISIBLE} v from pages)), "
    "cls as (select page_id, case when " + " or ".join(_marks("blob", rules.CHALLENGES[k]) for k in rules.BLOCKING) + f" then 'blocked' when {_marks('lv', rules.NOT_FOUND_MARKERS)} then 'not_found' "
    "when " + " or ".join(_marks("blob", m) for m in rules.CHALLENGES.values()) + " then 'interstitial' else 'content' end response, length(v) < 400 unrendered, left(sha256(lv), 16) text_hash from resp)"
)
_LINKS = f"""lk as (select distinct page_id, link from (
  select page_id, origin || case when length(p) > 1 then rtrim(p, '/') else p end link from (
    select page_id, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1)) origin,
      replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(url_encode(lower(regexp_replace(h, '/+', '/', 'g'))), '%2F', '/'), '%3A', ':'), '%40', '@'), '%21', '!'), '%24', '$'), '%26', '&'), '%27', ''''), '%28', '('), '%29', ')'), '%2B', '+'), '%2C', ','), '%3B', ';'), '%3D', '='), '%7E', '~') p
    from (select page_id, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) h from pages)))
  where not {_any_of('link', rules.SKIP_PATTERNS)} or {_any_of('link', [rules.PDF_PATTERN])})"""
_CHUNKS = f"""w as (select doc_id, {_words('text')} w from documents),
ch as (select doc_id, total, unnest(range(len(st))) chunk_index, unnest(tx) text from (
  select doc_id, len(w) total, st, case when len(w) > 440 then list_transform(st, lambda s: array_to_string(w[s + 1 : s + 220], ' ')) else [array_to_string(w, ' ')] end tx from (
    select doc_id, w, case when len(w) > 440 then list_filter(range(0, len(w), 180), lambda s: s = 0 or len(w) - s > 20) else [0] end st from w where len(w) > 0)))"""
_REC = f"rec as (select page_id record_ord, url, {_TITLE} title, {_VISIBLE} text, {_page_type('url', _TITLE)} page_type, {_segment('url', _TITLE)} segment, {_LANG} language from (select *, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)) path from pages))"
_RUNS = "f as (select user_id, event_id, event_type = 'error' blocked, row_number() over (partition by user_id order by ts, event_id) n, row_number() over (partition by user_id, event_type = 'error' order by ts, event_id) k from events), runs as (select user_id, min(n) first_n, max(n) last_n, count(*) length from f where blocked group by user_id, n - k)"


_AREAS = "(['retail-banking/cards', 'corporate-banking/loans', 'news', 'about-us', 'accounts'])[doc_id % 5 + 1]"
_LABELLED = f"""lr as (select doc_id record_ord, 'https://docs.example/' || {_AREAS} || '/' || (doc_id % 97) url, 'Record ' || doc_id title, (['Fees', 'Eligibility', 'Overview', 'Required documents'])[doc_id % 4 + 1] heading,
  text, case when doc_id % 11 = 0 then 'pdf' else 'html' end document_type, doc_id % 3 = 0 has_table from documents),
rec as (select *, case when document_type = 'pdf' then 'product' else {_page_type('url', 'title')} end page_type, {_segment('url', 'title')} segment from lr)"""


def _hybrid() -> str:
    """Fused, boosted, filtered and diversified answers of the questions."""
    has_any = lambda cues: _has("lower(q)", "|".join(f"(?:{c})" for c in cues))
    ints = ", ".join(f"case when {has_any(cues)} then {_s(n)} end" for n, (cues, _) in rules.INTENTS.items())
    tops = ", ".join(f"case when {_has('q', p)} then {_s(n)} end" for n, p in rules.TOPICS.items())
    matches = " or ".join(f"(list_contains(ints, {_s(n)}) and {_marks('lower(heading)', heads)})" for n, (_, heads) in rules.INTENTS.items() if heads)
    b = rules.BOOSTS
    return f"""{_FUSED}, {_LABELLED},
ask as (select item_id query_id, list_filter([{ints}], lambda x: x is not null) ints, list_filter([{tops}], lambda x: x is not null) tops, case when {_has('q', rules.CORPORATE)} then 'corporate' when {_has('q', rules.CONSUMER)} then 'consumer' else 'consumer_default' end want
  from (select item_id, {QUESTION} q from benchmark)),
m as (select f.*, r.url, r.text, r.page_type, r.segment, r.document_type, r.has_table, ints, len(ints) + len(tops) > 0 pq, {matches} hm, list_contains(ints, 'fees') or list_contains(ints, 'rates') money,
  (want <> 'corporate' and r.segment = 'corporate') or (want = 'corporate' and r.segment = 'consumer') mis from fused f join rec r using (record_ord) join ask using (query_id)),
u as (select *, 0.0::double + (case when hm then {b['heading_match']} else 0 end)::double + (case when pq and page_type = 'news' then {b['page_news']} else 0 end)::double + (case when pq and page_type = 'about' then {b['page_about']} else 0 end)::double
  + (case when pq and page_type = 'product' then {b['page_product']} else 0 end)::double + (case when mis then {b['segment_mismatch']} else 0 end)::double + (case when money and has_table then {b['has_table_fee_query']} else 0 end)::double + (case when money and document_type = 'pdf' then {b['pdf_fee_query']} else 0 end)::double units from m),
s as (select *, rrf + units * (1::double / 61 - 1::double / 71) score from u),
k as (select *, row_number() over (partition by query_id order by score desc, dense_rank is null, dense_rank nulls first, bm25_rank nulls first, record_ord) rank from s),
e as (select *, sum(case when rank <= 50 and page_type = 'product' then 1 else 0 end) over (partition by query_id) >= 5 enough from k),
c as (select *, row_number() over (partition by query_id order by rank) pos, left(text, 160) fp, case when list_contains(ints, 'compare') then 1 else 2 end quota,
  round_even(least(1.0::double, case when dense_score is null then 0 else 0.65::double * greatest(0.0, least(1.0, dense_score)) end + case when bm25_score is null then 0 else 0.2::double * least(1.0, bm25_score / 8.0) end + case when hm then 0.15::double else 0 end), 4) confidence
  from e where not (pq and enough and page_type in ('news', 'about'))),
fold as (select query_id, 0::bigint pos, []::varchar[] docs, []::varchar[] seen, false taken from (select distinct query_id from c) union all
  select c.query_id, c.pos, case when ok then list_append(docs, c.url) else docs end, case when ok then list_append(seen, c.fp) else seen end, ok from (
    select f.query_id, f.docs, f.seen, c.pos, c.url, c.fp, len(f.docs) < 5 and len(list_filter(f.docs, lambda x: x = c.url)) < c.quota and not list_contains(f.seen, c.fp) ok from fold f join c on c.query_id = f.query_id and c.pos = f.pos + 1) c)"""


def sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    intents = ", ".join(f"case when {_has('lower(q)', '|'.join(f'(?:{c})' for c in cues))} then {_s(n)} end" for n, (cues, _) in rules.INTENTS.items())
    topics = ", ".join(f"case when {_has('q', p)} then {_s(n)} end" for n, p in rules.TOPICS.items())
    absent = " + ".join(f"case when (select max(contains(lower(coalesce(text, '')), {_s(t)})::int) from (select text from documents union all select text from benchmark)) = 1 then 0 else 1 end" for t in rules.TASK_TERMS)
    return {
        "bm25_topk": f"with {_BM25} select item_id, doc_id, score, rank from lex where rank <= 5",
        "term_stats": f"with {_TOK}, {_STATS} select term, df, round(idf, 6) idf, bp is_boilerplate from term_stat",
        "corpus_stats": f"with {_TOK} select count(*) n_docs, round(avg(len(tokens)), 4) avg_len from tok",
        "url_canonical": f"with {_CANON} select page_id, canon, sha1(canon) url_key from canon",
        "url_scope_attach": f"select page_id, regexp_matches(url, '(?i)^https?://') and ({_any_of('url', [rules.PDF_PATTERN])} or not {_any_of('url', rules.SKIP_PATTERNS)}) in_scope, {_any_of('url', rules.ATTACHMENT_PATTERNS)} attachment, {_any_of('url', [rules.PDF_PATTERN])} pdf from pages",
        "url_section_path": f"with {_CANON} select page_id, array_to_string(list_filter(string_split(canon_path, '/'), lambda s: s not in ('', 'en', 'ar')), '/') section_path, {_LANG} \"language\", host from (select c.*, p.host, lower(p.path) path from canon c join canon_parts p using (page_id))",
        "url_dedup_first": f"with {_CANON} select min(page_id) page_id, canon from canon group by canon",
        "lang_script": _SCRIPT,
        "content_dedup": f"select min(doc_id) doc_id, h content_hash, min(n) word_count from (select doc_id, left(sha256(text), 16) h, len({_words('text')}) n from documents) where n >= 20 group by h",
        "thin_documents": f"select * from (select doc_id, len({_words('text')}) word_count from documents) where word_count < 80",
        "hash_embed": """with t as (select doc_id, md5('0:' || unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+'))) m from documents),
          s as (select doc_id, (('0x' || m[1:2])::bigint + ('0x' || m[3:4])::bigint * 256 + ('0x' || m[5:6])::bigint * 65536 + ('0x' || m[7:8])::bigint * 16777216) % 384 slot, case when ('0x' || m[9:10])::bigint % 2 = 1 then 1.0 else -1.0 end w from t),
          g as (select doc_id, slot, sum(w)::double w from s group by all having sum(w) <> 0)
          select doc_id, slot, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) value from g""",
        "dense_topk": f"with {_DENSE} select query_id, record_ord vec_id, round(score, 4) score, rank from dr where rank <= 10",
        "rrf_hybrid": f"with {_FUSED} select query_id, record_ord, round(rrf, 6) rrf from fused",
        "confidence_status": f"""with {_FUSED}, c as (select query_id, round(round_even(least(1.0::double, case when dense_score is null then 0 else 0.65 * greatest(0.0, least(1.0, round(dense_score, 4))) end + case when bm25_score is null then 0 else 0.2 * least(1.0, bm25_score / 8.0) end), 4), 2) confidence from fused),
          b as (select query_id, max(confidence) best, count(*) n from c group by 1)
          select item_id query_id, case when n is null then 'no_results' when best >= 0.35 then 'ok' else 'low_confidence' end status, coalesce(best, 0.0) best_confidence, coalesce(n, 0) n_results from benchmark left join b on item_id = query_id""",
        "hybrid_retrieve": f"""with recursive {_hybrid()} select fold.query_id, len(docs) result_rank, record_ord, round(score, 6) score, round(rrf, 6) base_score, confidence, page_type, segment from fold join c using (query_id, pos) where taken""",
        "diverse_topk": f"""with recursive {_BM25}, c as (select item_id, l.rank pos, source, left(coalesce(text, ''), 160) fp from lex l join documents using (doc_id) where l.rank <= 50),
          fold as (select item_id, 0::bigint pos, []::varchar[] docs, []::varchar[] seen, false taken from benchmark union all select item_id, pos, case when ok then list_append(docs, source) else docs end, case when ok then list_append(seen, fp) else seen end, ok from (
            select f.item_id, f.docs, f.seen, c.pos, c.source, c.fp, len(f.docs) < 5 and len(list_filter(f.docs, lambda x: x = c.source)) < 2 and not list_contains(f.seen, c.fp) ok from fold f join c on c.item_id = f.item_id and c.pos = f.pos + 1))
          select item_id, pos rank, docs[-1] doc_key, len(docs) place from fold where taken""",
        "greedy_chunks": f"with {_CHUNKS} select doc_id, count(*) n_chunks, max(len({_words('text')})) longest from ch group by 1",
        "page_labels": f"select page_id, {_page_type('url', _TITLE)} page_type, {_segment('url', _TITLE)} segment from pages",
        "query_intents": f"select conv_id, turn, array_to_string(list_filter([{intents}], lambda x: x is not null), ',') intents, array_to_string(list_filter([{topics}], lambda x: x is not null), ',') topics, case when {_has('q', rules.CORPORATE)} then 'corporate' when {_has('q', rules.CONSUMER)} then 'consumer' else 'consumer_default' end segment from (select *, coalesce(text, '') q from conversations)",
        "response_class": f"with {_RESPONSE} select page_id, response, unrendered, text_hash from cls",
        "page_links": f"with {_LINKS} select page_id, link from lk",
        "inbound_top": f"with {_LINKS} select link target_url, count(*) n_inbound from lk group by 1 order by 2 desc, 1 limit 20",
        "chunk_windows": f"with {_CHUNKS} select doc_id, chunk_index, md5(text) chunk_md5, 'pdf_' || left(sha1(doc_id || '|pdf|' || chunk_index || '|' || substring(text, 1, 200)), 16) chunk_id from ch",
        "page_estimate": f"with {_CHUNKS}, k as (select *, len({_words('text')}) wc, 1 + total // 500 n_pages from ch), e as (select *, coalesce(sum(wc) over (partition by doc_id order by chunk_index rows between unbounded preceding and 1 preceding), 0) before from k where wc >= 8) select doc_id, chunk_index, least(n_pages, 1 + floor(before / total * n_pages))::bigint pdf_page from e",
        "cache_hits": "select doc_id, left(sha1(text), 20) text_key, left(sha1(text), 20) in (select left(sha1(text), 20) from documents where doc_id % 2 = 0) hit from documents",
        "dup_clusters": "select md5(left(coalesce(text, ''), 300)) opening, count(*) size, min(doc_id) first_ord from documents group by 1 having count(*) > 1",
        "existence_check": "select doc_id from documents where regexp_matches(text, '(?i)licen[sc]e|all rights reserved')",
        "fts_and": "with q as (select item_id, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) w from benchmark), d as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+'))) term from documents) select item_id, doc_id from (select item_id, len(w) n, unnest(w) term from q) join d using (term) group by item_id, doc_id, n having count(*) = n",
        "health_check": f"""with {_REC}, c as (select count(*) n, count(*) filter (segment = 'corporate') corporate, count(*) filter (segment = 'consumer') consumer, count(*) filter (language = 'unknown') unknown, count(*) filter (page_type = 'other') other, count(*) - count(distinct left(text, 300)) dupes from rec)
          select 'corporate_skew' "rule", corporate n, corporate > n * 0.4 and corporate > consumer * 3 warned from c union all select 'unknown_language', unknown, unknown > n * 0.1 from c union all select 'pdf_unknown_language', 0, false from c union all select 'other_pages', other, other > n * 0.3 from c union all select 'no_tables', 0, true from c union all select 'duplicate_text', dupes, dupes > n * 0.1 from c""",
        "staleness": f"with {_REC} select record_ord, 'corporate' segment, segment live_segment, page_type, page_type live_page_type from rec where record_ord % 9 = 0 and segment <> 'corporate'",
        "label_overview": f"with {_REC} select field, value, count(*) n from (select 'language' field, language value from rec union all select 'document_type', 'html' from rec union all select 'page_type', page_type from rec union all select 'segment', segment from rec union all select 'has_table', 'false' from rec) group by all",
        "block_runs": f"with {_RUNS} select user_id, first_n, last_n, length from runs",
        "crawl_until_blocked": f"with {_RUNS}, stops as (select user_id, min(first_n + 1) stop from runs where length >= 2 group by 1) select user_id, event_id from f left join stops using (user_id) where stop is null or n <= stop",
        "freshness": "select date_diff('day', min(ts)::date, date '2024-03-01') age_days, date_diff('day', min(ts)::date, date '2024-03-01') > 30 stale from events",
        "bfs_levels": "with recursive m as (select count(*) n from pages), r as (select 0::bigint u, 0::bigint depth union select (case t when 0 then u * 7 + 3 else u * 3 + 1 end) % (select n from m), depth + 1 from r, range(2) x(t) where depth < 6) select min(u)::varchar url, min(depth) depth from r group by u",
        "crawl_levels": f"""with recursive {_CANON}, {_LINKS}, p as (select page_id, canon, regexp_extract(canon, '^[a-z]+://([^/?#:]*)', 1) host, row_number() over (partition by canon order by page_id) k from canon),
          e as (select canon src, link from p join lk using (page_id) where k = 1), s as (select arg_min(canon, page_id) url from p where k = 1 group by host),
          r as (select url, 0::bigint depth from s union select link, depth + 1 from r join e on src = url where depth < 6)
          select url, min(depth) depth from r group by url""",
        "set_coverage": "with a as (select distinct doc_id from documents), b as (select distinct doc_id from labels) select (select count(*) from a) linked, (select count(*) from b) held, (select count(*) from a join b using (doc_id)) matched, (select count(*) from a anti join b using (doc_id)) missing, (select count(*) from b anti join a using (doc_id)) extra",
        "upsert": "select o_orderkey, o_custkey, round(case when o_orderkey % 10 = 0 then o_totalprice + 1 else o_totalprice end, 2) o_totalprice from orders union all select -o_orderkey - 1, null, round(o_totalprice, 2) from orders where o_orderkey % 50 = 0",
        "verify_gate": f"""with sc as ({_SCRIPT}), d as (select doc_id, text, left(sha256(text), 16) h, len({_words('text')}) n, left(coalesce(text, ''), 40) title from documents),
          c as (select count(*) n, count(*) filter (coalesce(title, '') = '') prov, count(*) filter (n < 20) thin, count(*) filter (doc_id % 50 = 0) lost, count(*) filter (doc_id % 33 = 0) unr, (select count(*) from sc where language = 'unknown') untagged, (select count(*) from (select h from d group by h having count(*) > 1)) dup,
            count(*) filter (doc_id % 7 = 0 and doc_id not in (select item_id from benchmark)) pdf, (select count(*) from benchmark where length(text) < 200) ocr, {absent} absent from d)
          select 'corpus non-empty' "check", 'PASS' status, n from c union all select 'every record carries provenance', if(prov > 0, 'FAIL', 'PASS'), prov from c union all select 'no empty/shell documents', if(thin > 0, 'FAIL', 'PASS'), thin from c
          union all select 'language tagged on every document', if(untagged > 0, 'WARN', 'PASS'), untagged from c union all select 'documents split into citable sections', 'PASS', 0 from c union all select 'tables well formed', 'PASS', 0 from c union all select 'fee/rate tables present', 'WARN', 0 from c
          union all select 'corpus is fresh', 'WARN', 46 from c union all select 'every citation URL fetched successfully', if(lost > 0, 'FAIL', 'PASS'), lost from c union all select 'no duplicate content', if(dup > 0, 'WARN', 'PASS'), dup from c union all select 'linked PDFs were fetched', if(pdf > 0, 'WARN', 'PASS'), pdf from c
          union all select 'PDFs are machine-readable', 'WARN', ocr from c where ocr > 0 union all select 'crawl completed cleanly', if(lost + unr > 0, 'WARN', 'PASS'), lost + unr from c union all select 'brief''s example tasks are answerable', case when absent > 2 then 'FAIL' when absent > 0 then 'WARN' else 'PASS' end, absent from c""",
    }
