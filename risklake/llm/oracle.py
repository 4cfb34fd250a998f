"""The queries that SQL can express, for DuckDB."""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
with recursive texts as (
  select doc_id, regexp_extract_all({_LOWER}, {_WORDS}) as w from documents
), shingles as (
  select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) = 1 then w
         else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)) as s
  from texts
), sizes as (
  select doc_id, count(s) as n from documents left join shingles using (doc_id) group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * pairs.n >= 80 * (x.n + y.n - pairs.n)
), both_ways as (
  select a, b from links union all select b, a from links
), reached as (
  select doc_id, doc_id as other from documents
  union
  select reached.doc_id, both_ways.b from reached join both_ways on both_ways.a = reached.other
)
select doc_id, n as n_shingles, min(other) as component_id, min(other) = doc_id as kept
from reached join sizes using (doc_id) group by doc_id, n
"""

QUALITY = rf"""
with texts as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_WORDS}) as w from documents
), lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line from texts
), copies as (
  select doc_id, count(*) - count(distinct line) as n from lines
  where regexp_matches(line, {_WORDS}) group by doc_id
), windows as (
  select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as g
  from texts, (values (3), (8), (101)) as sizes(k), unnest(range(1, len(w) - k + 2)) as places(i)
), repeated as (
  select doc_id, k, i from windows qualify count(*) over (partition by doc_id, k, g) > 1
), covered as (
  select doc_id, count(distinct i + j) filter (where k = 3) as three, count(distinct i + j) filter (where k = 8) as eight
  from repeated, unnest(range(0, k)) as steps(j) where k < 101 group by doc_id
), long as (
  select distinct doc_id from repeated where k = 101
), figures as (
  select doc_id, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         coalesce(copies.n, 0) as n_dup_lines, coalesce(three, 0) as n_repeat_words,
         coalesce(eight, 0) as repeat_covered, long.doc_id is not null as long_repeat
  from texts left join copies using (doc_id) left join covered using (doc_id) left join long using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 10 * repeat_covered <= 3 * n_words
         and not long_repeat as kept
from figures
"""

ORACLE_SQL = {"op1_near_dedup": NEAR_DEDUP, "op2_quality": QUALITY}
