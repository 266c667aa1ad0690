"""SQL for the queries that SQL can express."""

from __future__ import annotations

OP4 = r"""
with d as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
  from documents),
o as (select *, length(bin(size)) as odds from d),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from s),
w2 as (select *, source_size * 6 // weight as per_weight from w),
w3 as (
  select *, sum(source_size) over () - 3 * coalesce(sum(source_size) over (
           order by per_weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as left_over,
         sum(weight) over (
           order by per_weight, source nulls last rows between current row and unbounded following) as left_weight
  from w2),
w4 as (select *, min(cast(3 * source_size * left_weight <= left_over * weight as int)) over (
           order by per_weight, source nulls last rows between unbounded preceding and current row) as stops
       from w3),
t as (
  select source, source_size,
         case when stops = 1 then cast(3 * source_size as double)
              else cast(max(case when stops = 0 then left_over end) over () * weight as double)
                   / cast(max(case when stops = 0 then left_weight end) over () as double) end as target
  from w4),
lv as (
  select o.source, odds, sum(size) as words, any_value(target) as target
  from o join t on o.source is not distinct from t.source where size > 0 group by o.source, odds),
lv2 as (
  select *, target - cast(3 * coalesce(sum(words) over (
           partition by source order by odds desc rows between unbounded preceding and 1 preceding), 0) as double) as left_over,
         cast(sum(odds * words) over (
           partition by source order by odds desc rows between current row and unbounded following) as double) as mass
  from lv),
lv3 as (select *, min(cast(left_over * odds >= 3 * mass as int)) over (
           partition by source order by odds desc rows between unbounded preceding and current row) as stops
        from lv2),
lv4 as (
  select source, odds, words, target,
         case when stops = 1 then 3.0::double
              else odds * max(case when stops = 0 then left_over / mass end) over (partition by source) end as copies
  from lv3),
q as (
  select source, cast(round(any_value(target)) as bigint) - cast(sum(cast(floor(copies) as bigint) * words) as bigint) as quota
  from lv4 group by source),
r as (
  select o.doc_id, o.source, o.size, cast(floor(copies) as bigint) as whole, quota,
         case when copies - floor(copies) > 0 then
           (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) end as rnk,
         row_number() over () as row_no
  from (select *, (cast('0x' || substr(md5('20:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5::double)
                  / 4503599627370496::double as u from o) o
  join lv4 on o.source is not distinct from lv4.source and o.odds = lv4.odds
  join q on o.source is not distinct from q.source
  where o.size > 0),
c as (
  select *, sum(size) over (partition by source order by rnk, doc_id, size, row_no) as words from r where rnk is not null),
g as (
  select source, any_value(quota) - coalesce(max(case when words <= quota then words end), 0) as gap
  from c group by source having max(words) > any_value(quota)),
m as (
  select arg_min(row_no, (abs(gap - size), rnk, doc_id, size, row_no)) as row_no
  from c join g on c.source is not distinct from g.source
  where words > quota and abs(gap - size) < gap group by c.source),
n as (
  select r.doc_id, r.source, r.size, r.size * (r.whole + coalesce(cast(c.words <= r.quota as int), 0)
         + cast(m.row_no is not null as int)) as taken
  from r left join c on r.row_no = c.row_no left join m on r.row_no = m.row_no
  union all select doc_id, source, size, 0 from d where size = 0)
select n.doc_id, n.size, t.source_size, t.target, cast(n.taken as bigint) as taken
from n join t on n.source is not distinct from t.source
"""

OP10 = r"""
with p0 as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from p0),
rules(rule_host, rule_path, rule_verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u as (select distinct host, path from p),
f as (
  select u.host, u.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) as rule_verdict
  from u join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by u.host, u.path),
j as (select p.*, rule, rule_verdict from p left join f on p.host = f.host and p.path = f.path),
h0 as (
  select host, count(rule) as n, count(case when rule_verdict = 'block' then 1 end) as bad,
         regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') as name from j group by host),
h1 as (
  select *, regexp_matches(name, '^[0-9.]+$|^\[') as number, string_split(name, '.') as l,
         regexp_extract(name, '([^.]*\.)?[^.]*$') as two
  from h0),
h2 as (select *, two in ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'com.br', 'co.jp', 'co.in', 'co.nz') as long from h1),
h as (
  select host, n, bad,
         case when number then name when long then regexp_extract(name, '([^.]*\.){0,2}[^.]*$') else two end as domain,
         case when number then '' when long then two else l[len(l)] end as suffix
  from h2),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from h group by all),
s as (select suffix, sum(n) as n, sum(bad) as bad, (sum(sum(bad)) over () + 0.5) / (sum(sum(n)) over () + 1) as p from d group by suffix),
sm as (select coalesce(sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / nullif(sum(n * (n - 1.0) * p * (1 - p)), 0), 1.0) as x from s),
sv as (select *, 0.0::double as v from s),
sr as (select suffix, rate, rate * (1 - rate) / (n + m + 1) + m / (n + m) * (m / (n + m)) * v as spread
       from (select *, (bad + m * p) / (n + m) as rate from (select sv.*, 1 / least(greatest(x, 0.0001), 0.5) - 1 as m from sv, sm))),
dp as (select d.*, rate as p, spread as v from d join sr using (suffix)),
dm as (select coalesce(sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / nullif(sum(n * (n - 1.0) * p * (1 - p)), 0), 1.0) as x from dp),
dr as (select domain, rate, rate * (1 - rate) / (n + m + 1) + m / (n + m) * (m / (n + m)) * v as spread
       from (select *, (bad + m * p) / (n + m) as rate from (select dp.*, 1 / least(greatest(x, 0.0001), 0.5) - 1 as m from dp, dm))),
hp as (select h.host, h.n, h.bad, rate as p, spread as v from (select host, n, bad, domain from h) h join dr using (domain)),
hm as (select coalesce(sum((bad - n * p) * (bad - n * p) - n * p * (1 - p)) / nullif(sum(n * (n - 1.0) * p * (1 - p)), 0), 1.0) as x from hp),
hr as (select host, rate, rate * (1 - rate) / (n + m + 1) + m / (n + m) * (m / (n + m)) * v as spread
       from (select *, (bad + m * p) / (n + m) as rate from (select hp.*, 1 / least(greatest(x, 0.0001), 0.5) - 1 as m from hp, hm))),
v as (select host, rate - 1.645 * sqrt(spread) as low from hr)
select page_id, j.host, path, rule,
       coalesce(rule_verdict, case when low > 0.5 then 'block' else 'allow' end) as verdict
from j left join v on j.host = v.host
"""

OP6 = r"""
with r as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e as (
  select *, '<turn ' || regexp_replace(coalesce(role, ''), '([\\<>])', '\\\1', 'g') || '>'
         || regexp_replace(text, '([\\<>])', '\\\1', 'g') || '</turn>' || chr(10) as formatted
  from r)
select conv_id, count(*) as n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(formatted)) as bigint) as formatted_chars
from e group by conv_id
"""

OP8 = r"""
with d as (
  select doc_id, row_number() over () as row_no,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
p as (
  select distinct item, least(13, len(w)) as n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as phrase
  from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
x as (
  select row_no, i, n, array_to_string(w[i : i + n - 1], ' ') as phrase
  from (select row_no, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from p) where len(w) >= n)),
m as (select row_no, i, x.n, item from x join p on x.phrase = p.phrase and x.n = p.n),
h as (select row_no, count(distinct k) as n_hit from (select row_no, unnest(range(i, i + n)) as k from m) group by row_no),
t as (
  select row_no, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct row_no, item from m where item is not null) group by row_no),
q as (select distinct phrase, n from p),
k as (
  select phrase, n, unnest(range(0, n)) as off, unnest(string_split(phrase, ' ')) as term from q),
o as materialized (
  select row_no, unnest(w) as term, unnest(range(0, len(w))) as pos from d),
o2 as materialized (select * from o where term in (select term from k)),
f as (select term, count(*) as frequency from o2 group by term),
a as materialized (
  select k.phrase, n, off, k.term, row_number() over (partition by k.phrase order by frequency, off, k.term) as turn,
         count(*) over (partition by k.phrase) as met
  from k join f on k.term = f.term),
l as materialized (
  select phrase, a.n, off, term, turn, least(met, 4) - cast(n > 4 as int) as need
  from a where turn <= 4 and a.n - met <= 4 and met >= least(4, a.n)),
c as materialized (
  select row_no, phrase, l.n, count(*) as held, min(turn) as lead
  from (select distinct row_no, term from o2) t join l on t.term = l.term group by row_no, phrase, l.n, need
  having count(*) >= need),
s1 as materialized (
  select distinct row_no, c.phrase, c.n, held, pos - off as start
  from c join l on l.phrase = c.phrase and l.turn = c.lead join o2 using (row_no, term)),
s2 as (
  select row_no, phrase, n, held, start, l.turn
  from s1 join l using (phrase, n) join o2 using (row_no, term) where abs(o2.pos - start - l.off) <= 4
  group by all),
s3 as (select row_no, phrase, n, start from s2 group by row_no, phrase, n, start, held having count(*) = held),
z as (
  select row_no, count(distinct phrase) as n_near from s3
  where not exists (select 1 from x where x.row_no = s3.row_no and x.i = s3.start + 1 and x.phrase = s3.phrase and x.n = s3.n)
  group by row_no)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated, coalesce(n_near, 0) as n_near
from d left join h on d.row_no = h.row_no left join t on d.row_no = t.row_no left join z on d.row_no = z.row_no
"""


OP11 = r"""
with d as (
  select * from (
    select doc_id, row_number() over () as row_no,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from documents)
  where len(w) > 0),
g as (select count(*) as n_docs, cast(sum(len(w)) as bigint) as n_terms from d),
b as (
  select item_id, query_no, unnest(list_distinct(w)) as term
  from (
    select item_id, row_number() over () as query_no,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
    from benchmark)),
t as (
  select row_no, doc_id, n, term, count(*) as tf from (select row_no, doc_id, len(w) as n, unnest(w) as term from d)
  where term in (select term from b) group by row_no, doc_id, n, term),
f as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(n_docs) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as weight
  from t, g group by term),
s as (
  select query_no, item_id, row_no, doc_id,
         cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) as bigint) as score
  from b join t on b.term = t.term join f on t.term = f.term, g group by query_no, item_id, row_no, doc_id)
select item_id, rank, doc_id, score
from (
  select *, cast(row_number() over (partition by query_no order by score desc, doc_id nulls last, row_no) as int) as rank
  from s where score > 0)
where rank <= 10
"""


def _op13(k: int = 40, rounds: int = 5) -> str:
    """Each round of Lloyd's algorithm is two tables: the assignment, and the centroids after it."""
    part = "(v.x[i] - c.x[i]) * (v.x[i] - c.x[i])"
    near = (
        "select vec_id, x, row_no, d.c as c, d.d as d from (select vec_id, x, row_no, min({{'d': d, 'c': c}}) as d from ("
        f"select v.*, c.c, cast(list_sum(list_transform(range(1, 65), lambda i: {part})) as bigint) as d "
        "from v, c{0} c) group by vec_id, x, row_no)"
    )
    move = (
        "select c.c, coalesce(n.x, c.x) as x from c{0} c left join (select c, list(m order by i) as x from ("
        "select c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m from ("
        "select c, unnest(x) as x, unnest(range(1, 65)) as i from a{0}) group by c, i) group by c) n on c.c = n.c"
    )
    steps = [
        """v as materialized (
  select vec_id, list_transform(embedding, lambda e: cast(floor(256 * cast(e as double)) as bigint)) as x, row_number() over () as row_no
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64)""",
        f"""c0 as materialized (
  select row_number() over (order by h, x) - 1 as c, x
  from (select x, sha256('2:' || coalesce(cast(vec_id as varchar), '')) as h from v order by h, x limit {k}))""",
    ]
    for r in range(rounds):
        steps += [f"a{r} as materialized ({near.format(r)})", f"c{r + 1} as materialized ({move.format(r)})"]
    steps += [f"a{rounds} as materialized ({near.format(rounds)})"]
    return (
        "with " + ",\n".join(steps) + f"""
select vec_id, cast(a.c as int) as cluster, d as distance,
       cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.c = c.c
"""
    )


OP13 = _op13()

ORACLES: dict[str, str] = {
    "op4_mixing": OP4,
    "op6_chat": OP6,
    "op8_decontaminate": OP8,
    "op10_url_reputation": OP10,
    "op11_ranked": OP11,
    "op13_centroids": OP13,
}
