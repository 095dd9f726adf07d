"""DuckDB SQL for the operators that SQL can express over whole tables.

The others have none: tokenizer merges, trained models, edit distances, span
linking, randomised fingerprints and byte windows (all windows of all texts are
too many for SQL); tests/llm holds those against brute-force versions.
"""

from __future__ import annotations

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

NEAR_DUPLICATES = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}), '[^\x20\x09-\x0D]+') as words from documents
),
sets as (
  select doc_id, case
    when len(words) >= 5 then list_distinct([array_to_string(words[i:i+4], ' ') for i in range(1, len(words) - 3)])
    when len(words) > 0 then [array_to_string(words, ' ')]
    else cast([] as varchar[]) end as shingles
  from w
),
flat as (select doc_id, len(shingles) as n, unnest(shingles) as s from sets),
links as (
  select a.doc_id as a, b.doc_id as b from flat a join flat b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach(a, b) as (
  select doc_id, doc_id from sets
  union
  select r.a, l.b from reach r join links l on r.b = l.a
),
found as (select a as doc_id, min(b) as component_id from reach group by a)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, f.component_id, s.doc_id = f.component_id as kept
from sets s join found f on s.doc_id = f.doc_id
"""

URL_FILTER = rf"""
with rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
),
named as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
parsed as (
  select page_id, translate(raw, {UPPER}) as host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from named
),
ruled as (
  select *, case
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from parsed
)
select page_id, host, path, rule, case
  when rule in ('net/', 'example.com/de/') then 'block'
  when rule is not null then 'allow'
  when list_has_any(regexp_split_to_array(host, '[-.]'),
    ['ads', 'adult', 'bets', 'casino', 'pills', 'porn', 'spam', 'track']) then 'block'
  else 'allow' end as verdict
from ruled
"""

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), {UPPER}), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
grams as (
  select lang, words, len(words) as m, unnest(range(1, len(words) + 1)) as i from worded where len(words) > 0
),
f as (
  select lang, size, phrase, count(*) as f from (
    select lang, 1 as size, words[i] as phrase from grams
    union all select lang, 2, array_to_string(words[i:i+1], ' ') from grams where i + 1 <= m
    union all select lang, 3, array_to_string(words[i:i+2], ' ') from grams where i + 2 <= m
    union all select lang, 4, array_to_string(words[i:i+3], ' ') from grams where i + 3 <= m
  ) group by lang, size, phrase
),
totals as (select lang, sum(f) as n from f where size = 1 group by lang),
often as (select *, string_split(phrase, ' ') as w from f where f >= 30),
cuts as (
  select lang, size, phrase, f as a, w, unnest(range(1, size)) as k from often where size >= 2
),
sides as (
  select c.lang, c.phrase, c.a, c.k, h.f as l, t.f as r, (cast(2000000 as hugeint) * c.a) // (h.f + t.f) as score
  from cuts c
  join often h on h.lang = c.lang and h.phrase = array_to_string(c.w[1:c.k], ' ')
  join often t on t.lang = c.lang and t.phrase = array_to_string(c.w[c.k+1:c.size], ' ')
),
best as (
  select * from (select *, row_number() over (partition by lang, phrase order by score, k) as nth from sides) where nth = 1
),
longer as (
  select lang, phrase, max(f) as most from (
    select lang, f, array_to_string(w[1:size-1], ' ') as phrase from often where size >= 3
    union all select lang, f, array_to_string(w[2:size], ' ') from often where size >= 3
    union all select lang, f, array_to_string(w[1:2], ' ') from often where size = 4
    union all select lang, f, array_to_string(w[2:3], ' ') from often where size = 4
    union all select lang, f, array_to_string(w[3:4], ' ') from often where size = 4
  ) group by lang, phrase
),
kept as (
  select b.* from best b left join longer g on g.lang = b.lang and g.phrase = b.phrase
  where g.most is null or cast(100 as hugeint) * g.most < cast(80 as hugeint) * b.a
),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select k.lang, k.rank, k.phrase, k.a, k.l, k.r, cast(t.n as bigint) as n, cast(k.score as bigint) as score
from ranked k join totals t on t.lang = k.lang where k.rank <= 2000
"""

FILTER_AUDIT = r"""
with worded as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
),
firsts as (select text, min(doc_id) as first from worded group by text),
flags as (
  select w.part, w.doc_id,
    len(words) < 100 as a,
    100 * len(list_distinct(words)) < 80 * len(words) as b,
    100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 10 * length(w.text) as c,
    regexp_matches(w.text, '[#$%&*|]') as d,
    coalesce(w.doc_id > f.first, false) as e
  from worded w join firsts f on f.text = w.text
),
known as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
docs as (
  select part, [a, b, c, d, e] as fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from flags left join known using (doc_id) group by all
),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select v.x || w.x || y.x || z.x || u.x as filter_order
  from letters v
  join letters w on w.x <> v.x
  join letters y on y.x not in (v.x, w.x)
  join letters z on z.x not in (v.x, w.x, y.x)
  join letters u on u.x not in (v.x, w.x, y.x, z.x)
),
steps as (select filter_order, unnest(range(1, 6)) as step from orders),
placed as (
  select part, filter_order, step, n, good, toxic,
    fails[strpos('ABCDE', filter_order[step])] as own,
    len([i for i in range(1, step) if fails[strpos('ABCDE', filter_order[i])]]) > 0 as gone,
    len([x for x in fails if x]) as m
  from docs cross join steps
),
summed as (
  select part, filter_order, step,
    sum(case when not gone and not own then n else 0 end) as kept,
    sum(case when own and not gone then n else 0 end) as removed,
    sum(case when own and gone then n else 0 end) as redundant,
    sum(case when own and m = 1 then n else 0 end) as unique_fails,
    sum(case when own and not gone and good then n else 0 end) as good_lost,
    sum(case when own and not gone and toxic then n else 0 end) as toxic_lost
  from placed group by part, filter_order, step
),
total as (
  select part, filter_order[step] as x, sum(removed) as shapley from summed group by part, filter_order[step]
)
select s.part, s.filter_order, cast(s.step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(t.shapley as bigint) as shapley
from summed s join total t on t.part = s.part and t.x = s.filter_order[s.step]
"""

CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
escaped as (
  select *, length(regexp_replace(regexp_replace(role || chr(10) || text,
    '\[(\\*/?INST\])', '[\\\1', 'g'), '<(\\*/?s>)', '<\\\1', 'g')) - 1 as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(3 + sum(chars + 20) as bigint) as formatted_chars
from escaped group by conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": NEAR_DUPLICATES,
        "op9_url_filter": URL_FILTER,
        "op11_collocations": COLLOCATIONS,
        "op12_filter_audit": FILTER_AUDIT,
        "op13_chat_format": CHAT,
    }
