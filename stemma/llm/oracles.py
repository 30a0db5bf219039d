"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_OP1 = r"""
with low as (select doc_id, row_number() over () as r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
words as (select doc_id, r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from low),
items as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null),
wins as (select distinct item, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
  from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)),
sizes as (select distinct n from wins),
spots as (select r, i, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where len(w) >= n)),
hits as (select r, i, spots.n, item from spots join wins on spots.win = wins.win and spots.n = wins.n),
hit_words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
hit_items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hits) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit_words using (r) left join hit_items using (r)
"""

_OP2 = r"""
with p as (select page_id, url, nullif(regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', ''), '') as host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)', 1), '/'), lambda x: x <> '') as parts from pages),
k as (select *, string_split(host, '.') as labels from p),
log as (select case when page_id % 5 < 2 then 'adult' when page_id % 5 < 4 then 'malware' else 'spam' end as list_name,
    case when page_id % 4 = 0 then host
      when page_id % 4 = 1 and len(labels) > 3 then array_to_string(labels[2:], '.')
      when page_id % 4 = 2 then case when len(parts) > 0 then host || '/' || parts[1] end
      when len(parts) > 0 then host || '/' || array_to_string(parts, '/')
      else array_to_string(labels[greatest(len(labels) - 1, 1):], '.') end as key,
    1704067200 + page_id * 37 % 360 * 86400 as ts, page_id % 3 <> 2 as added from k),
days as (select list_name, key, ts, bool_or(added) as added from log where list_name is not null and key is not null and ts is not null group by all),
turns as (select * from (select *, coalesce(lag(added) over (partition by list_name, key order by ts), false) as was from days) where added <> was),
spans as (select list_name, key, ts as since, until from (select *, lead(ts) over (partition by list_name, key order by ts) as until from turns) where added),
caps as (select page_id, url, host, 1704067200 + page_id * 101 % 360 * 86400 + page_id * 977 % 86400 as fetched_at, row_number() over () as r, labels, parts from k),
keyed as (select distinct r, key from (
    select r, array_to_string(labels[i:], '.') as key from (select r, labels, unnest(range(1, greatest(len(labels) - 1, 1) + 1)) as i from caps where host is not null)
    union all select r, host || '/' || array_to_string(parts[1:i], '/') from (select r, host, parts, unnest(range(1, len(parts) + 1)) as i from caps where host is not null))),
met as (select caps.r, list_name, spans.key from keyed join caps using (r) join spans on spans.key = keyed.key and fetched_at >= since and (until is null or fetched_at < until)),
found as (select r, count(*) as n, string_agg(distinct list_name, ',' order by list_name) as lists, first(key order by length(key) desc, key) as entry from met group by r)
select page_id, url, fetched_at, host, coalesce(n, 0) as n_entries, coalesce(lists, '') as lists, entry, coalesce(n, 0) > 0 as blocked from caps left join found using (r)
"""

# Bytes as pairs of hexadecimal digits: a window of 50 bytes is a string of 100.
_OP4 = r"""
with d as (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as h from documents),
w as (select r, doc_id, i, substr(h, 2 * i + 1, 100) as s from (select r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from d where doc_id is not null and length(h) >= 100)),
f as (select s, min(doc_id) as first from w group by s),
hit as (select r, i from w join f using (s) where first < doc_id),
steps as (select r, i, lag(i) over (partition by r order by i) as p from hit),
runs as (select r, i, sum(case when p is null or i > p + 50 then 1 else 0 end) over (partition by r order by i) as k from steps),
spans as (select r, min(i) as a, max(i) + 50 as b from runs group by r, k),
gaps as (select r, lag(b, 1, 0) over (partition by r order by a) as x, a as y from spans union all select r, max(b), null from spans group by r),
kept as (select r, string_agg(case when y is null then substr(h, 2 * x + 1) else substr(h, 2 * x + 1, 2 * (y - x)) end, '' order by x) as k from gaps join d using (r) group by r),
sums as (select r, sum(b - a) as n, count(*) as spans from spans group by r)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed, cast(coalesce(spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from d left join sums using (r) left join kept using (r)
"""

# Documents of one set of shingles are a class; classes that share a shingle are compared by what they share.
_OP11 = r"""
with recursive words as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, r, list_sort(list_distinct(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) end)) as s from words),
named as (select doc_id, r, len(s) as n, md5(array_to_string(s, chr(10))) as k, s from sets),
classes as (select k, n, any_value(s) as s, min(doc_id) as least from named where n > 0 group by k, n),
each as (select k, n, unnest(s) as shingle from classes),
links as (select a.k as a, b.k as b from each a join each b on a.shingle = b.shingle and a.k <> b.k and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.k, b.k, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(k, m) as (select k, k from classes union select l.b, reach.m from reach join links l on l.a = reach.k),
roots as (select reach.k, min(least) as c from reach join classes on classes.k = reach.m group by reach.k)
select doc_id, n as n_shingles, case when n = 0 then doc_id else c end as component_id from named left join roots using (k)
"""

# Every order and step counts the documents by their failures' bits; a filter's letter is its bit's place.
_OP12 = r"""
with recursive lab as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as bad from labels where doc_id is not null group by doc_id),
d as (select doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
f as (select t as ft, min(doc_id) as first from d group by t),
w as (select d.*, f.first, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words from d join f on d.t = f.ft),
m as (select part, coalesce(good, false) as good, coalesce(bad, false) as bad,
    (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(first < w.doc_id, false)::int as fails
  from w left join lab on lab.doc_id = w.doc_id),
c as (select part, fails, count(*) as n, sum(good::int) as g, sum(bad::int) as x from m group by part, fails),
orders(o) as (select '' union all select o || l from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as l) where not contains(o, l) and length(o) < 5),
steps as (select o, k, 1 << (ascii(o[k]) - 65) as bit, (select coalesce(sum(1 << (ascii(o[j]) - 65)), 0) from unnest(range(1, k)) as q(j)) as before
  from orders, (select unnest(range(1, 6)) as k) where length(o) = 5),
r as (select part, o, k, bit,
    sum(case when (fails & (before::bigint | bit)) = 0 then n else 0 end) as kept,
    sum(case when (fails & before::bigint) = 0 and (fails & bit) <> 0 then n else 0 end) as removed,
    sum(case when (fails & before::bigint) <> 0 and (fails & bit) <> 0 then n else 0 end) as redundant,
    sum(case when fails = bit then n else 0 end) as unique_fails,
    sum(case when (fails & before::bigint) = 0 and (fails & bit) <> 0 then g else 0 end) as good_lost,
    sum(case when (fails & before::bigint) = 0 and (fails & bit) <> 0 then x else 0 end) as toxic_lost
  from c, steps group by part, o, k, bit)
select part, o as filter_order, k::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley from r
"""

ORACLES: dict[str, str] = {"op1_decontaminate": _OP1, "op2_urlfilter": _OP2, "op4_suffixes": _OP4, "op11_jaccard": _OP11, "op12_filter_audit": _OP12}
