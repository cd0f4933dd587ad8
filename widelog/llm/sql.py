"""What DuckDB SQL can say of the operators here, over whole tables, without any of their methods."""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
#: Smallest vertex that each one reaches, from (a, b) in links, over those in nodes.
REACHED = """
reach(a, b) as (select a, a from nodes union select r.a, l.b from reach r join links l on r.b = l.a)"""

NEAR_DUP = f"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, {LOWER}), '[^\\x20\\x09-\\x0D]+') as w from documents),
grams as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') || case when len(w) < 5 then ' #' || len(w) else '' end as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from w where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
links as (select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
nodes as (select doc_id as a from documents), {REACHED}
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.c as component_id, d.doc_id = r.c as kept
from documents d join (select a, min(b) as c from reach group by a) r on r.a = d.doc_id left join sizes s on s.doc_id = d.doc_id"""

DECONTAMINATE = f"""
with words as (select doc_id, coalesce(regexp_extract_all(translate(text, {LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w from documents),
items as (select item_id::varchar as item, regexp_extract_all(translate(text, {LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
windows as (select distinct item, least(10, len(w)) as n, array_to_string(w[k:k + 9], ' ') as g from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k from items where len(w) > 0)),
places as (select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from words, (select distinct n from windows))),
found as (select doc_id, k, p.n, item from places p join windows v on p.n = v.n and p.g = v.g),
hit as (select doc_id, count(distinct i) as n from (select doc_id, unnest(range(k, k + n)) as i from found) group by doc_id),
named as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as said from (select distinct doc_id, item from found) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(h.n, 0) as n_hit, coalesce(m.n, 0) as n_items, sha256(coalesce(m.said, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from words d left join hit h on h.doc_id = d.doc_id left join named m on m.doc_id = d.doc_id"""

NEAR_VECTORS = f"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
nodes as (select vec_id as a from embeddings), {REACHED}
select r.a as vec_id, coalesce(n.n, 0) as n_links, r.c as component_id, r.a = r.c as kept
from (select a, min(b) as c from reach group by a) r left join (select a, count(*) as n from links group by a) n on n.a = r.a"""

SUBSTRING_DEDUP = """
with texts as (select doc_id, lower(hex(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
windows as (select doc_id, k, substr(h, 2 * k + 1, 100) as s from (select doc_id, h, unnest(range(0, n - 49)) as k from texts where n >= 50)),
first as (select s, min(doc_id) as least from windows group by s),
hit as (select doc_id, k, k > coalesce(lag(k) over (partition by doc_id order by k) + 50, -1) as fresh from windows join first using (s) where least < doc_id),
spans as (select doc_id, min(k) as a, max(k) + 50 as b from (select doc_id, k, sum(fresh::int) over (partition by doc_id order by k) as g from hit) group by doc_id, g),
gaps as (select s.doc_id, coalesce(lag(b) over (partition by s.doc_id order by a), 0) as a, a as b from spans s union all select t.doc_id, coalesce(max(s.b), 0), t.n from texts t left join spans s on s.doc_id = t.doc_id group by t.doc_id, t.n),
kept as (select g.doc_id, string_agg(substr(t.h, 2 * a::bigint + 1, 2 * (b - a)::bigint), '' order by a) as h from gaps g join texts t on t.doc_id = g.doc_id group by g.doc_id),
sums as (select doc_id, sum(b - a)::bigint as n, count(*) as spans from spans group by doc_id)
select t.doc_id, t.n as n_bytes, coalesce(s.n, 0) as n_removed, coalesce(s.spans, 0) as n_spans, sha256(unhex(k.h)) as kept_sha256
from texts t join kept k on k.doc_id = t.doc_id left join sums s on s.doc_id = t.doc_id"""
