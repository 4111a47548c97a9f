"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from .licenses import COVERAGE, NEIGHBOUR, template_rows

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER}, '[^\\x{{00}}-\\x{{2F}}\\x{{3A}}-\\x{{60}}\\x{{7B}}-\\x{{7F}}]+')"
_SPACED = "regexp_extract_all(coalesce(text, ''), '[^\\x{20}\\x{09}-\\x{0D}]+')"

OP2 = f"""
with items as (select item_id, {_ALNUM} ws from benchmark),
sized as (select item_id, ws, least(10, len(ws)) n from items where len(ws) > 0),
wins as (select distinct item_id, n, array_to_string(ws[i + 1 : i + n], ' ') k
  from (select item_id, ws, n, unnest(range(len(ws) - n + 1)) i from sized)),
docs as (select doc_id, {_ALNUM} ws from documents),
lens as (select distinct n from wins),
places as (select doc_id, n, i, array_to_string(ws[i + 1 : i + n], ' ') k
  from (select doc_id, ws, n, unnest(range(greatest(0, len(ws) - n + 1))) i from docs cross join lens)),
hits as (select p.doc_id, p.n, p.i, w.item_id from places p join wins w on p.n = w.n and p.k = w.k),
covered as (select doc_id, count(*) n_hit from (
  select distinct doc_id, i + j p from (select distinct doc_id, n, i, unnest(range(n)) j from hits)) group by 1),
named as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items
  from (select distinct doc_id, cast(item_id as varchar) item from hits where item_id is not null) group by 1)
select d.doc_id, cast(len(ws) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from docs d left join covered using (doc_id) left join named using (doc_id)
"""

OP6 = f"""
with docs as (select doc_id, {_SPACED} ws from documents),
win as (select doc_id, i, array_to_string(ws[i + 1 : i + 20], ' ') k
  from (select doc_id, ws, unnest(range(greatest(0, len(ws) - 19))) i from docs)),
ranked as (select doc_id, i, row_number() over (partition by k order by doc_id, i) r from win),
gone as (select distinct doc_id, i + j p from (select doc_id, i, unnest(range(20)) j from ranked where r > 1)),
word as (select doc_id, w, p from (select doc_id, unnest(ws) w, unnest(range(len(ws))) p from docs)),
kept as (select word.doc_id, string_agg(w, ' ' order by word.p) t
  from word left join gone on word.doc_id = gone.doc_id and word.p = gone.p where gone.p is null group by 1),
lost as (select doc_id, count(*) n from gone group by 1)
select d.doc_id, cast(len(ws) as bigint) n_words, coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
from docs d left join lost using (doc_id) left join kept using (doc_id)
"""

_TEMPLATES = ", ".join(
    f"({t}, '{label}', {str(phrase).lower()}, {n}, {p}, '{a}', '{b}')" for t, label, phrase, n, p, a, b in template_rows(2)
)
OP8 = f"""
with tpl(t, label, phrase, n_grams, tp, a, b) as (values {_TEMPLATES}),
docs as (select doc_id, {_ALNUM} ws from documents),
gram as (select doc_id, p, ws[p + 1] a, ws[p + 2] b from (select doc_id, ws, unnest(range(greatest(0, len(ws) - 1))) p from docs)),
hit as (select doc_id, t, label, phrase, n_grams, tp, p, p - tp diagonal from gram join tpl using (a, b)),
diagonals as (select doc_id, t, label, phrase, n_grams, diagonal, list(distinct tp) covered, min(p) low, max(p) high
  from hit group by all),
marked as (select *, case when phrase or diagonal - lag(diagonal) over w <= {NEIGHBOUR} is not true then 1 else 0 end new
  from diagonals window w as (partition by doc_id, t order by diagonal)),
numbered as (select *, sum(new) over (partition by doc_id, t order by diagonal rows unbounded preceding) run from marked),
spans as (select doc_id, label, phrase, n_grams, len(list_distinct(flatten(list(covered)))) n_covered, min(low) low, max(high) + 2 high
  from numbered group by doc_id, t, label, phrase, n_grams, run),
judged as (select *, round(n_covered / n_grams, 6) part,
  case when phrase then n_covered = n_grams
       else round(n_covered / n_grams, 6) >= {COVERAGE} and high - low <= 2 * (n_grams + 1) end ok from spans),
found as (select doc_id, count(*) filter (ok and phrase) n_base, min(low) filter (ok and phrase) first_word,
    max(low) filter (ok and phrase) last_word, string_agg(distinct label, ',' order by label) filter (ok and phrase) base_labels,
    string_agg(distinct label, ',' order by label) filter (ok) labels, max(part) filter (ok) score
  from judged group by 1)
select d.doc_id, cast(len(ws) as bigint) n_words, coalesce(n_base, 0) n_base, cast(first_word as bigint) first_word,
  cast(last_word as bigint) last_word, coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0) score
from docs d left join found using (doc_id)
"""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP9 = f"""
with p as (select page_id, coalesce(html, '') html from pages),
h as (select page_id, strlen(html) payload_bytes, sha1(html) hex from p),
parts as (select *, [cast('0x' || substr(hex, 10 * g + 1, 10) as bigint) for g in [0, 1, 2, 3]] g5 from h),
coded as (select page_id, payload_bytes, array_to_string(
    [substr({_BASE32}, cast((g5[c // 8 + 1] >> (35 - 5 * (c % 8))) & 31 as int) + 1, 1) for c in range(32)], '') payload_digest
  from parts),
top as (select payload_digest, max(page_id) top from coded group by 1)
select page_id, payload_bytes, payload_digest, case when page_id = top then 'response' else 'revisit' end record_type,
  case when page_id <> top then top end refers_to
from coded join top using (payload_digest)
"""

#: On hexadecimal digits, two per byte; repeated starts are joined to islands before any byte is looked at.
OP10 = """
with docs as (select doc_id, hex(encode(coalesce(text, ''))) hx, strlen(coalesce(text, '')) n from documents),
win as (select doc_id, i, md5_number(substr(hx, 2 * i + 1, 200)) k from (select doc_id, hx, unnest(range(greatest(0, n - 99))) i from docs)),
firsts as (select k, min({'d': doc_id, 'i': i}) f from win group by k having count(*) > 1),
again as (select w.doc_id, w.i from win w join firsts using (k) where f.d <> w.doc_id or f.i <> w.i),
marked as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 100 then 0 else 1 end new from again),
islands as (select doc_id, min(i) s, max(i) + 100 e from (
  select doc_id, i, sum(new) over (partition by doc_id order by i rows unbounded preceding) island from marked) group by doc_id, island),
before as (select doc_id, s, e, coalesce(lag(e) over (partition by doc_id order by s), 0) kept_from from islands),
cut as (select d.doc_id, sum(e - s) n_removed, count(*) n_spans,
    string_agg(substr(hx, 2 * kept_from + 1, 2 * (s - kept_from)), '' order by s) || substr(any_value(hx), 2 * max(e) + 1) kept
  from before b join docs d using (doc_id) group by d.doc_id)
select d.doc_id, n n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(unhex(coalesce(kept, hx))) kept_sha256
from docs d left join cut using (doc_id)
"""

OP12 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label,
    [floor(256 * cast(x as double)) for x in embedding] e
  from embeddings where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id anchor_id, b.vec_id, a.label = b.label same, cast(list_inner_product(a.e, b.e) as bigint) score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
pos as (select anchor_id, vec_id positive_id, score positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over w as int) rank, n.vec_id negative_id, p.positive_score, n.score negative_score
from pos p join s n on n.anchor_id = p.anchor_id and not n.same and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)
qualify row_number() over w <= 5
"""

OP13 = f"""
with d as (select doc_id, {_LOWER} t from documents)
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size, doc_id = max(doc_id) over same kept,
  sha256(t) text_sha256
from d window same as (partition by t)
"""

ORACLE_SQL = {
    "op2_decontaminate": OP2,
    "op6_substrings": OP6,
    "op8_licenses": OP8,
    "op9_warc": OP9,
    "op10_suffixes": OP10,
    "op12_negatives": OP12,
    "op13_exact": OP13,
}
