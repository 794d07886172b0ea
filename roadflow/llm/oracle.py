"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from roadflow.llm.licenses import _PROSE, HEAD, KNOWN, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    plain = rf"trim(regexp_replace(lower({line}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for pattern, spelling in SPELLINGS:
        plain = rf"regexp_replace({plain}, '\b{pattern}\b', '{spelling.replace('$', chr(92))}', 'g')"
    low = f"lower({line})"
    signed = rf"regexp_matches({low}, '^\s*(?:\(c\)\s*(?:copyright\b|©|[0-9]{{4}}|<year>)|©|all rights reserved)')"
    stated = rf"regexp_matches({low}, '^\s*copyright\b') and not regexp_matches({low}, '^\s*copyright\b\s*[.,;:/)]*\s*(?:$|{_PROSE})')"
    return f"case when {signed} or ({stated}) then '' else {plain} end"


def _op6() -> str:
    values = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)
    return rf"""
with known as (
  select min(license) as license, c from (
    select license, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: {_canonical('x')}), lambda x: x <> ''), ' ') as c
    from (values {values}) as v(license, text)) where c <> '' group by c),
d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
p as (
  select r, i, list_filter(list_transform(string_split(para[i], chr(10)), lambda x: {_canonical('x')}), lambda x: x <> '') as ls
  from (select r, string_split_regex(t, '
[ 	
]*
\s*') as para from d), unnest(range(1, len(para) + 1)) as u(i)),
unit as (
  select r, 'line' as kind, unnest(ls) as c from p
  union all select r, 'paragraph', array_to_string(ls, ' ') from p
  union all select r, 'text', string_agg(array_to_string(ls, ' '), ' ' order by i) filter (len(ls) > 0) from p group by r),
heads as (select distinct left(c, least({HEAD}, (select min(length(c)) from known))) as h from known),
para as (select r, list(array_to_string(ls, ' ') order by i) filter (len(ls) > 0) as ps from p group by r),
start as (
  select r, ps, i from para, unnest(range(1, len(ps) + 1)) as u(i)
  where left(array_to_string(ps[i:i + {HEAD} - 1], ' '), least({HEAD}, (select min(length(c)) from known))) in (select h from heads)),
run as (select r, 'run' as kind, array_to_string(ps[i:j], ' ') as c from start, unnest(range(i, len(ps) + 1)) as u(j)),
hit as (select r, kind, license from (select * from unit union all select * from run) join known using (c)),
agg as (
  select r, max(license) filter (kind = 'text') as text_license, count(*) filter (kind = 'line') as n_lines,
    string_agg(distinct license, ',' order by license) as licenses
  from hit group by r)
select doc_id, text_license, coalesce(n_lines, 0) as n_lines, coalesce(licenses, '') as licenses
from d left join agg using (r)
"""


_OP7 = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (
  select r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g
  from d, unnest(range(1, len(w) - 48)) as u(i) where len(w) >= 50),
least as (select g, min(coalesce(doc_id, 9223372036854775807)) as first from win group by g),
hit as (select r, i from win join least using (g) where first < coalesce(doc_id, 9223372036854775807)),
gone as (select distinct r, j from hit, unnest(range(i, i + 50)) as u(j)),
marks as (select r, list(j) as js from gone group by r),
kept as (
  select doc_id, w, coalesce(len(js), 0) as n_removed,
    case when js is null then w else list_filter(list_transform(w, lambda x, i: case when not list_contains(js, i) then x end), lambda x: x is not null) end as k
  from d left join marks using (r))
select doc_id, cast(len(w) as bigint) as n_words, cast(n_removed as bigint) as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256
from kept
"""

_OP9 = r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
tok as (
  select r, i, w[i] as x, case when i > 1 then w[i - 1] end as v, case when i > 2 then w[i - 2] end as u
  from d, unnest(range(1, len(w) + 1)) as u(i)),
uni as (select x, count(*) as c from tok group by x),
bi as (select v, x, count(*) as c from tok where v is not null group by v, x),
tri as (select u, v, x, count(*) as c from tok where u is not null group by u, v, x),
total as (select count(*) as t from tok),
s as (
  select r, case when tok.v is null then ln(uni.c / t) when tok.u is null then ln(bi.c / one.c) else ln(tri.c / two.c) end as p,
    case when tok.v is null then 1 else 0 end as alone
  from tok join uni on uni.x = tok.x
    left join bi on bi.v = tok.v and bi.x = tok.x left join uni as one on one.x = tok.v
    left join tri on tri.u = tok.u and tri.v = tok.v and tri.x = tok.x left join bi as two on two.v = tok.u and two.x = tok.v, total),
agg as (select r, avg(p) as score, sum(alone) as n_unigram from s group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_unigram, 0) as bigint) as n_unigram, round(score, 6) as score
from d left join agg using (r)
"""

_OP8 = r"""
with d as (
  select rowid as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select row_number() over () as rowid, * from documents)),
b as (
  select coalesce(cast(item_id as varchar), 'null') as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
p as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as g
  from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i) where len(w) > 0),
lens as (select distinct k from p),
occ as (
  select r, i, k, array_to_string(w[i:i + k - 1], ' ') as g
  from d, lens, unnest(range(1, len(w) - k + 2)) as u(i) where len(w) >= k),
hit as (select r, i, k, item_id from occ join p using (k, g)),
words as (select r, count(distinct j) as n_hit from hit, unnest(range(i, i + k)) as u(j) group by r),
items as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""

_OP10 = """
with p as (
  select page_id, encode(coalesce(html, '')) as body, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, max(page_id) as newest from p group by 1)
select page_id, cast(octet_length(body) as bigint) as payload_bytes, payload_digest,
  case when octet_length(body) >= 1000 and page_id is distinct from newest then 'revisit' else 'response' end as record_type,
  case when octet_length(body) >= 1000 and page_id is distinct from newest then newest end as refers_to
from p join g using (payload_digest)
"""

ORACLE_SQL: dict[str, str] = {
    "op6_license_scan": _op6(),
    "op7_recompression_dedup": _OP7,
    "op8_benchmark_decontamination": _OP8,
    "op9_stupid_backoff": _OP9,
    "op10_warc": _OP10,
}
