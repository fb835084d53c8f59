"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op9_exact_dedup"] = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
  from documents),
g as (
  select *, count(*) over (partition by bare) as group_size,
         first_value(doc_id) over (partition by bare order by points desc, doc_id) as keep_id
  from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256
from g
"""

ORACLE["op3_mixing"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(concat_ws('|', 'mix', doc_id::varchar, coalesce(text, ''))) as k
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, 2.0::double * source_size as lim,
             [3.0::double, 1.0, 2.0][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int] as weight
      from s),
o as (select *, row_number() over (order by lim / weight, source is null, source) as k from w),
l as (select a.source, a.source_size, a.lim, a.weight, a.k,
             (1.5 * (select sum(source_size) from o)
              - coalesce((select sum(lim) from o b where b.k < a.k), 0))
             / (select sum(weight) from o b where b.k >= a.k) as level
      from o a),
f as (select min(k) as k from l where level * weight <= lim),
t as (select source, source_size,
             case when l.k >= f.k then (select level from l m where m.k = f.k) * weight else lim end::double as target
      from l, f),
p as (select d.doc_id, d.size, t.source_size, t.target, floor(t.target)::bigint as budget,
             (sum(size) over (partition by d.source order by d.k, doc_id, size rows unbounded preceding) - size)::bigint as before
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when source_size > 0 then (budget // source_size) * size
         + greatest(0, least(size, budget % source_size - before)) else 0 end)::bigint as taken
from p
"""

ORACLE["op4_warc"] = r"""
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, '')))::bigint as n from pages),
m as (select html, max(page_id) as first from p where n >= 1000 group by html having count(*) > 1)
select page_id, n as payload_bytes, sha1(p.html) as payload_digest,
       case when first <> page_id then 'revisit' else 'response' end as record_type,
       case when first <> page_id then first end as refers_to
from p left join m on p.html = m.html
"""

ORACLE["op6_substring_dedup"] = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (select doc_id, i, list_slice(ws, i, i + 34) as win
      from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from d where len(ws) >= 35)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by win) as n from w) where n > 1),
c as (select distinct doc_id, unnest(range(i, i + 35)) as i from r),
k as (select d.doc_id, string_agg(x.word, ' ' order by x.i) as kept, count(*) as n
      from (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from d) x
      join d using (doc_id) left join c on c.doc_id = x.doc_id and c.i = x.i
      where c.i is null group by d.doc_id)
select d.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id)
"""

ORACLE["op10_near_dedup"] = r"""
with recursive
d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select distinct doc_id, list_slice(ws, i, i + 4) as shingle
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
e as (
  select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
  where 100 * shared >= 85 * (x.n + y.n - shared)),
r(doc_id, reached) as (
  select doc_id, doc_id from d
  union
  select r.doc_id, e.b from r join e on e.a = r.reached)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from d left join n using (doc_id)
join (select doc_id, min(reached) as component_id from r group by doc_id) c using (doc_id)
"""

# Whole components and exact products, over the vectors that take part.
_WHOLE = """
  select vec_id, {label} as label, list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where embedding is not null and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
"""

ORACLE["op11_hard_negatives"] = f"""
with v as ({_WHOLE.format(label="case when vec_id % 7 = 0 then (label + 1) % 10 else label end")} and label is not null),
s as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, (row_number() over w)::int as rank, s.vec_id as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
     and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
window w as (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)
qualify row_number() over w <= 3
"""

ORACLE["op13_top_products"] = f"""
with v as ({_WHOLE.format(label="0")}),
s as (
  select a.vec_id as query_id, b.vec_id, list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0)
select query_id, (row_number() over w)::int as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id)
qualify row_number() over w <= 5
"""

# crc32 by its table of 256 remainders (made by the polynomial's rule); two words
# are near if one without a code point is the other, or both without the one at
# the same place are equal.
ORACLE["op12_spelling"] = r"""
with recursive
t as (
  select list(list_reduce([n] || range(8), lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)::bigint order by n) as crc
  from (select unnest(range(256)) as n)),
r as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents) where length(run) >= 7),
u as (select doc_id, run, count(*) as n from r group by all),
h as (
  select run, n, xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split(doc_id || ':' || run, ''),
           lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [195::bigint, unicode(x)::bigint - 64] end)),
           lambda c, b: xor(c // 256, crc[(xor(c, b) % 256 + 1)::int])), 4294967295::bigint) as h
  from u, t),
c as (
  select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
         sum(n)::bigint as n
  from h group by 1),
w as (select word, n from c where length(word) >= 7 and n >= 2),
d as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
      from (select word, n, unnest(range(1, length(word) + 1))::int as i from w)),
e as (
  select a.word, b.word as near, b.n as near_n from d a join d b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select w.word, d.word, d.n from w join d on d.rest = w.word
  union select d.word, w.word, w.n from w join d on d.rest = w.word),
b as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from e group by word),
f as (select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when near_n >= 10 * n then near end as form,
             case when near_n >= 10 * n then near_n end as form_n from w left join b using (word)),
o(word, root) as (
  select word, word from f
  union all select o.word, f.form from o join f on f.word = o.root where f.form is not null),
z as (select o.word, o.root from o join f on f.word = o.root where f.form is null)
select f.word, f.form, z.root, f.n, f.n_near, f.form_n from f join z using (word)
"""
