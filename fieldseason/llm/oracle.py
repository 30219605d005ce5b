"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

# The white space of every statement, a fixed value.
SPACE = r"[\x20\x09-\x0D]+"

OP7 = f"""
with rows as (
  select doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') as content from documents)
select doc_id, min(doc_id) over (partition by content) as keep_id,
       count(*) over (partition by content) as group_size,
       doc_id = min(doc_id) over (partition by content) as kept, sha256(content) as text_sha256
from rows
"""

OP10 = rf"""
with docs as (select doc_id, source, coalesce(text, '') as text from documents),
words as (
  select *, list_filter(string_split_regex(text, '{SPACE}'), lambda x: x <> '') as w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from docs),
windows as (
  select doc_id, unnest(range(1, len(w) - 3)) as i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as x
  from words where len(w) >= 5),
repeats as (
  select doc_id, unnest(list(i)) as i from windows group by doc_id, x having count(*) > 1),
covered as (
  select doc_id, count(distinct i + k) as n from repeats, (select unnest(range(0, 5)) as k) group by doc_id),
counts as (
  select doc_id, source, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words
  from words left join covered using (doc_id)),
lines as (
  select doc_id, source, text, lower(trim(regexp_replace(x, '{SPACE}', ' ', 'g'), ' ')) as line,
         len(list_filter(string_split_regex(x, '{SPACE}'), lambda y: y <> '')) as n
  from (select doc_id, source, text, unnest(l) as x from words)),
frequent as (select source, line from lines group by source, line having count(distinct text) > 20),
lost as (
  select doc_id, cast(sum(n) as bigint) as lost_words from lines semi join frequent using (source, line) group by doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
         and coalesce(lost_words, 0) <= 0.8 * n_words as kept,
       coalesce(lost_words, 0) as lost_words
from counts left join lost using (doc_id)
"""

OP11 = """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
named as (
  select conv_id, turn, dense_rank() over (order by role, text) as id, strlen(text) as bytes,
         sha256(concat(cast(length(role) as varchar), ':', role, text)) as digest
  from turns),
own as (
  select conv_id, list({'id': id, 'bytes': bytes} order by turn nulls first, digest, id) as t from named group by conv_id),
-- The crc32 of a text: 8 times 8 halvings of a byte, each xor-ed with the polynomial when the last bit was 1.
sums as (
  select conv_id, list_reduce(
           list_prepend(4294967295::ubigint, list_transform(string_split(cast(conv_id as varchar), ''), lambda x: ascii(x)::ubigint)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda k: 0::ubigint)),
             lambda x, k: xor(x >> 1, (x & 1) * 3988292384::ubigint))) as s
  from own),
rebuilt as (
  select o.conv_id, list_concat(list_slice(coalesce(b.t, []), 1, h), list_slice(o.t, h + 1, len(o.t))) as t
  from (select conv_id, t, cast(xor(s, 4294967295::ubigint) % 9 as bigint) as h from own join sums using (conv_id)) o
  left join own b on b.conv_id = o.conv_id - o.conv_id % 5),
prefixes as (
  select conv_id, len(t) as turns, unnest(range(0, len(t) + 1)) as depth, t from rebuilt),
members as (
  select conv_id, turns, depth, list_transform(t[1:depth], lambda x: x.id) as node,
         list_transform(t[1:depth-1], lambda x: x.id) as parent, case when depth = 0 then 0 else t[depth].bytes end as bytes
  from prefixes),
nodes as (
  select node, depth, any_value(parent) as parent, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where turns = depth), '')) as ends_sha256
  from members group by node, depth),
kids as (select parent, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by all),
sized as (
  select nodes.*, coalesce(kids.n, 0) as n_children, (n_convs - 1) * bytes as own
  from nodes left join kids on kids.parent = nodes.node and kids.depth = nodes.depth),
above as (
  select node, own, n_children, unnest(range(0, depth + 1)) as up from sized),
under as (
  select node[1:up] as top, up as depth, sum(own) as saved, count(*) filter (where n_children = 0) as leaves from above group by all)
select s.conv_id, cast(s.depth as bigint) as depth, p.conv_id as parent_conv_id, s.n_convs, s.n_children, u.leaves as n_leaves,
       cast(u.saved as bigint) as saved_tokens, s.ends_sha256
from sized s join under u on u.top = s.node and u.depth = s.depth
left join nodes p on s.depth > 0 and p.node = s.parent and p.depth = s.depth - 1
"""


def texts() -> dict[str, str]:
    return {"op7_exact_dedup": OP7, "op10_quality_rules": OP10, "op11_prefix_trie": OP11}
