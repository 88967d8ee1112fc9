"""DuckDB SQL for the operators whose whole contract SQL can express."""

from __future__ import annotations

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ITEM_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SPACE_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x20\\x09-\\x0D]+')"

DECONTAMINATION = f"""
with items as (select distinct item_id, {ITEM_WORDS} as w from benchmark where item_id is not null),
windows as (
    select item_id, 10 as n, array_to_string(w[i+1:i+10], ' ') as win from items, lateral (select unnest(range(len(w)-9)) as i) where len(w) >= 10
    union select item_id, len(w), array_to_string(w, ' ') from items where len(w) between 1 and 9),
docs as (select row_number() over () as k, doc_id, {ITEM_WORDS} as w from documents),
places as (select k, n, i, array_to_string(w[i+1:i+n], ' ') as win from docs, (select distinct n from windows) s, lateral (select unnest(range(len(w)-n+1)) as i) where len(w) >= n),
hits as (select k, i, n, item_id from places join windows using (n, win)),
words as (select k, count(distinct p) as n_hit from hits, lateral (select unnest(range(i, i+n)) as p) group by k),
found as (select k, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from hits group by k)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (k) left join found using (k)
"""


def either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The rules of the scan, in the order in which kinds are listed; group and least length as there.
RULES = (
    ("assign", f"({either('password')}|{either('passwd')}|{either('secret')}|{either('token')}|{either('api')}_?{either('key')})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8, True),
    ("access", "AKIA[A-Z0-9]+", 0, 16, True),
    ("hex", "[0-9a-f]+", 0, 32, True),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, False),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40, False),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15, False),
    ("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 1, False),
)


def _spans(order: int, kind: str, pattern: str, group: int, least: int, base: bool) -> str:
    return f"""select k, '{kind}' as kind, {order} as o, {base} as base, start, start + length(m) as stop from (
        select k, m, tested, sum(gap + length(m)) over (partition by k order by i) - length(m) as start from (
            select k, i, found[i] as m, tested[i] as tested, length(gaps[i]) as gap from (
                select k, regexp_extract_all(t, '{pattern}', 0) as found, regexp_extract_all(t, '{pattern}', {group}) as tested, string_split_regex(t, '{pattern}') as gaps from docs
            ), lateral (select unnest(range(1, len(found)+1)) as i)))
        where length(tested) >= {least}"""


SECRETS = f"""
with docs as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents),
spans as ({' union all '.join(_spans(i, *r) for i, r in enumerate(RULES))}),
named as (select k, count(*) filter (kind='assign') as a, count(*) filter (kind='access') as b, count(*) filter (kind='hex') as c,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, o) filter (base) as base, string_agg(kind || ':' || start || ':' || stop, ',' order by start, o) as spans from spans group by k)
select doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(b, 0)::bigint as n_access, coalesce(c, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join named using (k)
"""

# A document whose text has a span is new to all rules once it is redacted, any other is known; nothing is left in either.
RESCAN = f"select doc_id, (case when spans = '' then 0 else {len(RULES)} end)::bigint as n_unseen, 0::bigint as n_spans from ({SECRETS})"

JACCARD = f"""
with recursive docs as (select doc_id, {SPACE_WORDS} as w from documents),
sets as (select distinct doc_id, array_to_string(w[i+1:i+5], ' ') as s from docs, lateral (select unnest(range(greatest(1, len(w)-4))) as i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as o from sets a join sets b using (s) where a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100*o >= 80*(p.n + q.n - o)),
both_ways as (select x, y from links union select y, x from links),
reach as (select x as a, x as b from both_ways union select a, y from reach join both_ways on b = x),
lowest as (select a as doc_id, min(b) as c from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c, doc_id) as component_id, coalesce(k, 1)::bigint as class_size
from docs left join sizes using (doc_id) left join lowest using (doc_id)
left join (select doc_id, count(*) over (partition by members) as k from (select doc_id, list(s order by s) as members from sets group by doc_id)) using (doc_id)
"""

ORACLES = {
    "op2_benchmark_decontamination": DECONTAMINATION,
    "op5_secret_scans": SECRETS,
    "op8_ngram_jaccard_join": JACCARD,
    "secret_rescan": RESCAN,
}
