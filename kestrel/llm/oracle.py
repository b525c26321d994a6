"""DuckDB SQL for the queries that SQL can express, written from the contracts."""

_OP1 = r"""
with d as (
  select row_number() over () rid, doc_id, source, coalesce(text, '') text, text is null nul from documents),
w as (
  select rid, unnest(ws) word, unnest(range(1, len(ws) + 1)) pos
  from (select rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') ws from d)),
words as (select rid, count(*) n_words, sum(length(word)) word_chars from w group by rid),
tri as (
  select rid, pos, word || ' ' || lead(word) over p || ' ' || lead(word, 2) over p g
  from w window p as (partition by rid order by pos)),
rep as (select rid, pos, count(*) over (partition by rid, g) c from tri where g is not null),
repeated as (
  select rid, count(distinct pos + i) n from rep, (select unnest([0, 1, 2]) i) where c > 1 group by rid),
lines as (
  select rid, unnest(ls) line, unnest(range(1, len(ls) + 1)) i
  from (select rid, string_split(text, chr(10)) ls from d)),
worded as (
  select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') ws from lines),
normal as (
  select rid, line, i, len(ws) n, regexp_replace(
    translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9]', '0', 'g') norm
  from worded where len(ws) > 0),
dups as (select rid, count(*) - count(distinct line) n from normal group by rid),
per_line as (
  select source, norm, count(distinct text) c from normal join d using (rid) group by 1, 2),
hosts as (select source, count(distinct (nul, text)) n from d group by 1),
frequent as (
  select p.source, norm from per_line p join hosts h on p.source is not distinct from h.source
  where c > 10 and c > 0.1::double * n),
removed as (
  select rid, sum(n) n from normal join d using (rid) join frequent f
    on f.norm = normal.norm and f.source is not distinct from d.source group by rid),
m as (
  select doc_id, coalesce(words.n_words, 0)::bigint n_words, coalesce(word_chars, 0)::bigint word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
    coalesce(dups.n, 0)::bigint n_dup_lines, coalesce(repeated.n, 0)::bigint n_repeat_words,
    (coalesce(words.n_words, 0) - coalesce(removed.n, 0))::bigint n_kept_words
  from d left join words using (rid) left join dups using (rid) left join repeated using (rid)
    left join removed using (rid))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and 100 * n_kept_words >= 50 * n_words as kept
from m
"""

_OP2 = r"""
with d as (
  select row_number() over () rid, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
b as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
win as (
  select distinct item_id, least(13, len(ws)) size,
    array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') g
  from (select *, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) i from b where len(ws) > 0)),
sizes as (select distinct size from win),
grams as (
  select rid, i, size, array_to_string(ws[i : i + size - 1], ' ') g
  from (select rid, ws, size, unnest(range(1, len(ws) - size + 2)) i from d, sizes where len(ws) >= size)),
hit as (select distinct rid, i, win.size, item_id from grams join win using (size, g)),
covered as (select rid, count(distinct p) n from
  (select rid, unnest(range(i, i + size)) p from (select distinct rid, i, size from hit)) group by rid),
items as (
  select rid, count(*) n, string_agg(id, ',' order by id) ids
  from (select distinct rid, item_id::varchar id from hit) group by rid)
select doc_id, coalesce(len(ws), 0)::bigint n_words, coalesce(covered.n, 0)::bigint n_hit,
  coalesce(items.n, 0)::bigint n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(covered.n, 0) > 0 and 20 * coalesce(covered.n, 0) >= coalesce(len(ws), 0) as contaminated
from d left join covered using (rid) left join items using (rid)
"""

_OP3 = """
with p as (
  select page_id, coalesce(html, '') html, sha256(coalesce(html, '')) digest,
    octet_length(encode(coalesce(html, ''))) n from pages),
o as (select digest, min(page_id) first from p where n >= 100 group by 1)
select page_id, n::bigint payload_bytes, digest payload_digest,
  case when n >= 100 and page_id <> first then 'revisit' else 'response' end record_type,
  case when n >= 100 and page_id <> first then first end refers_to
from p left join o using (digest)
"""

_OP4 = """
with d as (
  select doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint h,
    coalesce(octet_length(encode(text)), 0) b from documents),
l as (select doc_id, b, depth, h >> (60 - depth) prefix from d, (select unnest(range(0, 31)) depth)),
s as (select depth, prefix, sum(b)::bigint shard_bytes, count(*)::bigint shard_rows from l group by 1, 2),
f as (
  select doc_id, depth, prefix, shard_bytes, shard_rows,
    row_number() over (partition by doc_id order by depth) r
  from l join s using (depth, prefix) where shard_bytes <= 16777216 or shard_rows = 1)
select doc_id, depth::bigint as depth,
  case when depth = 0 then '' else lpad(bin(prefix), depth::int, '0') end as shard,
  shard_bytes, shard_rows, shard_bytes > 16777216 as oversized
from f where r = 1
"""

_OP10 = r"""
with t as (
  select conv_id, turn, role, text from conversations
  union all
  select -1, i, case when i = 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok'
  from range(2) x(i)),
c as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x, row_number() over w i,
    coalesce(lag(coalesce(role, '')) over w, 'start') before
  from t window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first))
select conv_id, count(*)::bigint n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' order by i)) turns_sha256,
  coalesce(sum(length(x)) filter (r = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(x, '' order by i) filter (r = 'assistant'), '')) loss_sha256,
  sum(12 + length(replace(replace(r, '\', '\\'), '<|', '<\|')) + 1
    + length(replace(replace(x, '\', '\\'), '<|', '<\|')) + 11)::bigint formatted_chars,
  bool_and(ok) as valid, bool_and(ok) and last(r order by i) = 'assistant' as complete
from (select *, (before, r) in (('start', 'system'), ('start', 'user'), ('system', 'user'),
  ('user', 'assistant'), ('assistant', 'user'), ('assistant', 'tool'), ('tool', 'assistant')) ok from c)
group by conv_id
"""

_OP11 = r"""
with d as (
  select doc_id, coalesce(text, '') x, sha256('1:' || coalesce(doc_id::varchar, '')) h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') ts from documents),
k as (
  select *, len(ts) n, ('0x' || h[1:8])::bigint % (len(ts) + 1) c1, ('0x' || h[9:16])::bigint % (len(ts) + 1) c2,
    case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>')
        or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
      when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end form
  from d),
p as (
  select doc_id, n, form, x, array_to_string(ts[1 : least(c1, c2)], '') p,
    array_to_string(ts[least(c1, c2) + 1 : greatest(c1, c2)], '') m,
    array_to_string(ts[greatest(c1, c2) + 1 : n], '') s
  from k)
select doc_id, n::bigint n, form, case when form <> 'plain' then length(p) end::bigint prefix_chars,
  case when form <> 'plain' then length(m) end::bigint middle_chars,
  sha256(case form when 'plain' then x when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256,
  sha256(x) restored_sha256
from p
"""

ORACLE = {"op1_quality_rules": _OP1, "op2_decontamination": _OP2, "op3_warc": _OP3, "op4_sharding": _OP4,
          "op10_chat": _OP10, "op11_fill_in_middle": _OP11}
