"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op5_top_k"] = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as cells from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.cells, c.cells) as bigint) as score
  from rows q join rows c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""

ORACLE["op9_warc"] = """
with rows as (select page_id, coalesce(html, '') as payload from pages),
told as (select page_id, strlen(payload) as payload_bytes, sha1(payload) as hex, min(page_id) over (partition by payload) as first_id from rows),
parts as (select *, list_transform(range(0, 8), lambda g: cast('0x' || substr(hex, 5 * g + 1, 5) as integer)) as fives from told)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  array_to_string(list_transform(fives, lambda v: array_to_string(list_transform([32768, 1024, 32, 1], lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v // d) % 32 as integer) + 1, 1)), '')), '') as payload_digest,
  case when first_id is null or page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
  case when first_id is null or page_id is not distinct from first_id then null else first_id end as refers_to
from parts
"""

ORACLE["op13_ranked_search"] = r"""
with held as (select row_number() over () as row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents where text is not null),
docs as (select row, doc_id, len(terms) as n from held where len(terms) > 0),
told as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from docs),
tf as (select row, term, count(*) as tf from (select row, unnest(terms) as term from held) group by row, term),
df as (select term, count(*) as df from tf group by term),
asked as (
  select item_id, term, count(*) as repeats from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from (select distinct item_id, text from benchmark where text is not null)
  ) group by item_id, term
),
weighed as (select asked.*, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w from asked join df using (term), told),
scored as (
  select item_id, row, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) as score
  from weighed join tf using (term) join docs using (row), told group by item_id, row
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as integer) as rank, doc_id, cast(score as bigint) as score
from scored join docs using (row) where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id nulls last) <= 20
"""

ORACLE["op12_collocations"] = r"""
with rows as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from rows),
words as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as w from pieces),
runs as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase from words, (select unnest(range(1, 6)) as k) where len(w) >= k),
f as (select lang, k, phrase, count(*) as f from runs group by lang, k, phrase having count(*) >= 100),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k >= 2),
inner_parts as (
  select lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) as phrase
  from (select lang, k, a as f, w from candidates)
),
inside as (select lang, phrase, max(f) as most from inner_parts group by lang, phrase),
cuts as (select c.*, cut, array_to_string(w[1:cut], ' ') as head, array_to_string(w[cut + 1:], ' ') as tail from candidates c, (select unnest(range(1, 5)) as cut) where cut < k),
scored as (
  select c.lang, c.phrase, c.a, h.f as l, t.f as r, totals.n, cut, (1000 * cast(c.a as hugeint) * totals.n) // (cast(h.f as hugeint) * t.f) as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.head join f t on t.lang = c.lang and t.phrase = c.tail join totals on totals.lang = c.lang
),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (select lowest.* from lowest left join inside using (lang, phrase) where most is null or 100 * most < 100 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from kept qualify row_number() over (partition by lang order by score desc, a desc, encode(phrase)) <= 2000
"""
