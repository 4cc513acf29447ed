"""DuckDB SQL of the queries that SQL can express, over the whole tables."""

SUBSTRING_DEDUP = r"""
with d as (
  select doc_id, text, row_number() over () as r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select r, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
v as (select p.r, p.i, array_to_string(d.w[p.i : p.i + 34], ' ') as g from p join d using (r)),
c as (select r, i, count(*) over (partition by g) as n from v),
x as (select distinct r, i + k as i from c, range(35) as t(k) where n > 1),
k as (
  select r, string_agg(word, ' ' order by i) as kept, count(*) as n
  from (select d.r, unnest(d.w) as word, unnest(range(1, len(d.w) + 1)) as i from d) as a
  anti join x using (r, i) group by r)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(k.n, 0))::bigint as n_removed,
  sha256(coalesce(k.kept, '')) as kept_sha256
from d left join k using (r)
"""

MIXING = r"""
with d as (
  select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    cast(('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 15)) as bigint) as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size,
    [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as weight
  from d group by source),
r as (select *, (source_size * 2)::double / weight as ratio from s),
l as (
  select *, ((sum(source_size) over ())::double * 1.5 - coalesce(sum(source_size * 2) over b, 0)::double)
    / ((sum(weight) over ()) - coalesce(sum(weight) over b, 0))::double as level
  from r window b as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)),
t as (
  select source, source_size,
    case when ratio > level then weight * max(case when ratio > level then level end) over ()
      else (source_size * 2)::double end as target
  from l),
k as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as times from t),
m as (select *, greatest(target - times * source_size, 0) as rest from k),
w as (
  select doc_id, source, size, h, sum(size) over (partition by source order by h) as upto from d),
g as (select source, h, sum(size) as words from d group by source, h)
select w.doc_id, w.size, m.source_size::bigint as source_size, m.target,
  (w.size * (m.times + case when w.upto * 2 - g.words < m.rest * 2 then 1 else 0 end))::bigint as taken
from w join m on w.source is not distinct from m.source
  join g on g.source is not distinct from w.source and g.h = w.h
"""

WARC = r"""
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
    sha256(coalesce(html, '')) as address, sha1(coalesce(html, '')) as hex
  from pages),
f as (select address, min(page_id) as first_page from p group by address)
select page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, (i // 8 * 10 + 1)::int, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31)::int + 1, 1)), '') as payload_digest,
  case when page_id is not distinct from first_page then 'response' else 'revisit' end as record_type,
  case when page_id is not distinct from first_page then null else first_page end as refers_to
from p join f using (address)
"""

URL_RULES = r"""
with p as (
  select page_id, row_number() over () as r,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
h(h_host, h_path, h_verdict) as (values
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
b as (
  select r, arg_max(h_host || h_path, length(h_host || h_path)) as rule,
    arg_max(h_verdict, length(h_host || h_path)) as rule_verdict
  from p join h on (host = h_host or ends_with(host, '.' || h_host)) and starts_with(path, h_path)
  group by r),
t(start_) as (values ('casino-'), ('free-bets.'), ('cheap-pills.'), ('spam-'), ('adult-'), ('ads-track.')),
m as (
  select r, arg_max('||' || start_, (length(start_), -ascii(start_))) as pattern
  from p join t on starts_with(host, start_) or contains(host, '.' || start_) group by r)
select page_id, host, path, rule, coalesce(rule_verdict, case when pattern is null then 'allow' else 'block' end) as verdict,
  case when rule is null then pattern end as pattern
from p left join b using (r) left join m using (r)
"""


def _centroid_rounds(rounds: int) -> str:
    """Assignment and replacement, one pair of tables per round."""
    made = []
    for i in range(rounds):
        made.append(f"""
a{i} as materialized (
  select r, arg_min(j, (list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), j)) as j
  from v cross join c{i} group by r),
s{i} as (
  select j, g as i, sum(x[g])::bigint as s, count(*) as n
  from a{i} join v using (r) cross join range(1, 65) as t(g) group by j, g),
m{i} as (select j, list((s - ((s % n) + n) % n) // n order by i) as c from s{i} group by j),
c{i + 1} as materialized (select c{i}.j, coalesce(m{i}.c, c{i}.c) as c from c{i} left join m{i} using (j))""")
    return ",".join(made)


CENTROIDS = rf"""
with v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as x
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
c0 as materialized (
  select (row_number() over (order by sha256('3:' || vec_id)) - 1)::int as j, x as c
  from v order by sha256('3:' || vec_id) limit 8),{_centroid_rounds(10)},
d as (
  select r, vec_id, j, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
  from v cross join c10),
f as materialized (select r, any_value(vec_id) as vec_id, arg_min(j, (d, j)) as j, min(d) as d from d group by r),
t as (select j, sum(d)::bigint as own from f group by j)
select f.vec_id, f.j::int as cluster, f.d::bigint as distance, t.own as cluster_inertia,
  (select sum(own) from t)::bigint as inertia,
  sha256(array_to_string(c10.c, ',')) as centroid_sha256
from f join t using (j) join c10 using (j)
"""
