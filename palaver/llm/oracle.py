"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_salvage"] = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), c as (
  select *, max(page_id) over (partition by payload_digest) as last_id from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id < last_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id < last_id then last_id end as refers_to
from c
"""

ORACLE["op6_repeated_windows"] = f"""
with w as (
  select doc_id, {WORDS.format(text="coalesce(text, '')")} as ws from documents
), starts as (
  select doc_id, i, array_to_string(ws[i:i+12], ' ') as win
  from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13)
), late as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by win) as first_id from starts) where doc_id > first_id
), gone as (
  select doc_id, list_distinct(list(p)) as ps from (select doc_id, unnest(range(i, i + 13)) as p from late) group by doc_id
), split as (
  select w.doc_id, ws, coalesce(ps, []) as ps from w left join gone using (doc_id)
)
select doc_id, len(ws) as n_words, len(ps) as n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda k: not list_contains(ps, k)), lambda k: ws[k]), ' '), '')) as kept_sha256
from split
"""

ORACLE["op7_near_duplicates"] = f"""
with recursive w as (
  select doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents
), s as materialized (
  select distinct doc_id, array_to_string(ws[i:i+3], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) as i from w where len(ws) > 0)
), n as materialized (
  select doc_id, count(*) as n from s group by doc_id
), links as materialized (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all
  ) join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)
), both_ways as (
  select a, b from links union all select b, a from links
), reach(id, c) as (
  select doc_id, doc_id from documents
  union
  select e.b, r.c from reach r join both_ways e on e.a = r.id
), comp as (
  select id, min(c) as component_id from reach group by id
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n using (doc_id) join comp on comp.id = d.doc_id
"""

ORACLE["op10_decontamination"] = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), wins as (
  select distinct item_id, least(13, len(ws)) as k, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') as win
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 11, 2))) as i from b where len(ws) > 0)
), ks as (select distinct k from wins
), runs as (
  select doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') as win
  from (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, ks where len(ws) >= k)
), found as (
  select doc_id, item_id, r.k, i from runs r join wins x on x.win = r.win and x.k = r.k
), hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from found) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from found) group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(ws), false) as contaminated
from w left join hit using (doc_id) left join named using (doc_id)
"""

ORACLE["op11_hard_negatives"] = """
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as materialized (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, positive_id, cast(row_number() over w as integer) as rank, s.other_id as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * positive_score <= 100 * s.score and s.score <= positive_score
window w as (partition by p.anchor_id, positive_id order by s.score desc, s.other_id)
qualify row_number() over w <= 5
"""

# For the tables given, whose pages have one article each and only these character references in it.
ORACLE["op13_wrapper_induction"] = r"""
with inside as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|\z)', 1) as body from pages
), split as (
  select page_id, url, string_split_regex(replace(body, '<br>', ' '), '</?(p|h1)>') as parts from inside
), bare as (
  select page_id, url, list_transform(parts, lambda x: regexp_replace(x, '<[^>]*>?', '', 'g')) as lines from split
), decoded as (
  select page_id, url, list_transform(lines, lambda x: regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    x, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) as lines from bare
), plain as (
  select page_id, url, list_transform(lines, lambda x: trim(regexp_replace(x, '[ \t\r\n]+', ' ', 'g'))) as lines from decoded
), text as (
  select page_id, url, coalesce(array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)), '') as text from plain
)
select page_id, url, text, length(text) as n_chars from text
"""
