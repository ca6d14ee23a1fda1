"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_CONTROL = r"'\### Assistant: </turn> ok'"

OP1 = f"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, {_SPACED}) as w from documents),
s as (select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else array_to_string(w[p:p + 2], ' ') end as g
      from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) as p from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
link as (select a.doc_id as x, b.doc_id as y
         from (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b using (g) where a.doc_id <> b.doc_id group by 1, 2) p
         join n a on a.doc_id = p.a join n b on b.doc_id = p.b where 100 * k >= 85 * (a.n + b.n - k)),
reach as (select doc_id as x, doc_id as y from documents union select r.x, l.y from reach r join link l on l.x = r.y),
low as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join low l on l.x = d.doc_id left join n on n.doc_id = d.doc_id
"""

OP2 = f"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents),
win as (select doc_id, p, array_to_string(w[p:p + 19], ' ') as g
        from (select doc_id, w, unnest(generate_series(1, len(w) - 19)) as p from w where len(w) >= 20)),
again as (select doc_id, p from (select doc_id, p, row_number() over (partition by g order by doc_id, p) as k from win) where k > 1),
gone as (select distinct doc_id, unnest(generate_series(p, p + 19)) as i from again),
word as (select doc_id, unnest(w) as t, unnest(generate_series(1, len(w))) as i from w),
kept as (select word.doc_id, string_agg(t, ' ' order by i) as t, count(*) as n
         from word anti join gone on gone.doc_id = word.doc_id and gone.i = word.i group by word.doc_id)
select w.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(kept.n, 0))::bigint as n_removed,
       sha256(coalesce(kept.t, '')) as kept_sha256
from w left join kept on kept.doc_id = w.doc_id
"""

OP4 = rf"""
with r as (select conv_id, turn, role, text from conversations
           union all values (-7, 0, 'user', {_CONTROL}), (-7, 1, 'assistant', {_CONTROL})),
t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
          partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n from r),
e as (select *, replace(replace(replace(replace(role, '\', '\b'), '### ', '\h'), '</turn>', '\l'), ': ', '\c') as er,
             replace(replace(replace(text, '\', '\b'), '### ', '\h'), '</turn>', '\l') as et from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length(er) + length(et) + 14)::bigint as formatted_chars
from e group by conv_id
"""

OP6 = f"""
with d as (select doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from documents),
b as (select item_id::varchar as item, regexp_extract_all({_LOWER}, {_ALNUM}) as w from benchmark),
win as (select distinct item, least(13, len(w)) as n, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') as g
        from (select item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as p from b where len(w) > 0)),
found as (select doc_id, p, x.n, item from (
              select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p
              from d join (select distinct n from win) on len(w) >= n) x
          join win on win.n = x.n and win.g = array_to_string(w[p:p + x.n - 1], ' ')),
hit as (select doc_id, count(distinct i) as n_hit from (select doc_id, unnest(generate_series(p, p + n - 1)) as i from found) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from found) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit on hit.doc_id = d.doc_id left join it on it.doc_id = d.doc_id
"""

OP9 = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
win as (select doc_id, p, substr(h, 2 * p - 1, 100) as s
        from (select doc_id, h, unnest(generate_series(1, length(h) // 2 - 49)) as p from h where length(h) >= 100)),
again as (select doc_id, p from (select doc_id, p, min(doc_id) over (partition by s) as low from win) where low < doc_id),
byte as (select doc_id, i, substr(h, 2 * i - 1, 2) as b
         from (select doc_id, h, unnest(generate_series(1, length(h) // 2)) as i from h)),
-- a byte is covered if one of the 50 windows that reach it is repeated
marked as (select byte.*, again.p is not null as struck from byte left join again on again.doc_id = byte.doc_id and again.p = byte.i),
cover as (select doc_id, i, b, max(case when struck then i end) over (partition by doc_id order by i rows between 49 preceding and current row) is not null as gone from marked),
edge as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from cover),
total as (select doc_id, count(*) as n, count(*) filter (where gone) as r, count(*) filter (where opens) as k,
                 string_agg(b, '' order by i) filter (where not gone) as kept from edge group by doc_id)
select h.doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(r, 0)::bigint as n_removed, coalesce(k, 0)::bigint as n_spans,
       sha256(unhex(coalesce(kept, ''))) as kept_sha256
from h left join total on total.doc_id = h.doc_id
"""

# A prefix of edits is its cost in nine digits and its letters: the least string
# is the cheapest prefix, and the ASCII-least of equal ones.
def _edit(state: int, cost: str, letter: str, when: str = "") -> str:
    new = f"lpad((substr(b[{state}], 1, 9)::bigint + {cost})::varchar, 9, '0') || substr(b[{state}], 10) || '{letter}'"
    return f"case when {when} then {new} end" if when else new


def _stay(state: int, initial: str) -> str:
    ok = "x[3] = ''"
    keep = _edit(state, "x[4]::bigint", "K", f"{ok} and x[2] = '{initial}'")
    return f"{keep}, {_edit(state, 'x[4]::bigint + 3', 'R', ok)}" if initial != "s" else keep


_INSERTS = f"[b[1], b[2], least(b[3], {', '.join(_edit(s, '3', 'I') for s in (1, 2, 4))}), least(b[4], {_edit(3, '3', 'I')})]"
_ROW = (f"[{_edit(1, '4', 'D')}, least({_edit(2, '4', 'D')}, {_stay(1, 's')}), "
        f"least({_edit(3, '4', 'D')}, {', '.join(_stay(s, 'u') for s in (1, 2, 4))}), least({_edit(4, '4', 'D')}, {_stay(3, 'a')})]")
_CRC = ("xor(list_reduce(flatten(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), "
        "lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])), "
        "lambda r, c: case when c >= 0 then xor(r, c) when r % 2 = 1 then xor(r >> 1, 3988292384) else r >> 1 end, 4294967295::bigint), 4294967295)")
_BODY = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP12 = f"""
with r as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC} % 20 as d from conversations),
damaged as (
    select conv_id, turn, case d when 4 then 'user' else role end as role,
           case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest([1, 2][:case d when 3 then 2 else 1 end]) as copy
    from r where d <> 0),
t as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n, {_BODY} as body from damaged),
f as (select *, case when body = '' then 'blank' when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
                     when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
             substr(role, 1, 1) as i, lag(substr(role, 1, 1)) over (partition by conv_id order by n) as before from t),
c as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'blank') as blank,
             count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
             count(*) filter (where n > 1 and (before || i) not in ('su', 'ua', 'au')) as illegal,
             list(['row', i, case when fault in ('blank', 'duplicate') then 'must' else '' end, case fault when 'truncated' then '3' else '0' end] order by n) as rows
      from f group by conv_id),
best as (select * exclude (rows), list_reduce(flatten(list_transform(rows || [['end', '', '', '']], lambda x: [['I', '', '', ''], ['I', '', '', ''], ['I', '', '', ''], x])),
                                lambda b, x: case x[1] when 'I' then {_INSERTS} when 'row' then {_ROW} else b end,
                                ['000000000', null, null, null]::varchar[]) as b from c),
a as (select *, least(b[1], b[4]) as w, substr(least(b[1], b[4]), 10) as audit from best),
letter as (select conv_id, unnest(string_split(audit, '')) as e, unnest(generate_series(1, length(audit))) as p from a where audit <> ''),
step as (select *, count(*) filter (where e <> 'I') over (partition by conv_id order by p) as n,
                count(*) filter (where e <> 'D') over (partition by conv_id order by p) as q from letter),
kept as (select s.conv_id, p, e, q, f.role, f.text, max(case when q = 1 and e = 'K' and f.i = 's' then 1 else 0 end) over (partition by s.conv_id) as shift
         from step s left join f on f.conv_id is not distinct from s.conv_id and f.n = s.n and s.e <> 'I' where e <> 'D'),
done as (select conv_id, sha256(string_agg(case e when 'K' then role else case (q - shift) % 2 when 1 then 'user' else 'assistant' end end
                                           || ':' || case e when 'I' then '' else text end, chr(10) order by p)) as sha from kept group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(substr(w, 1, 9)::bigint, 0) as cost, coalesce(audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o left join a on a.conv_id is not distinct from o.conv_id
left join done on done.conv_id is not distinct from o.conv_id
"""

OP13 = """
with line as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as t,
                     unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as i from documents),
k as (select *, translate(trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from line),
low as (select k, min(doc_id) as low from k where length(k) >= 10 group by k having count(distinct doc_id) > 1)
select doc_id, count(*) as n_lines, count(*) filter (where low < doc_id) as n_dropped,
       sha256(coalesce(string_agg(t, chr(10) order by i) filter (where low is null or low = doc_id), '')) as kept_sha256
from k left join low using (k) group by doc_id
"""

ORACLES = {"op1_near_duplicates": OP1, "op2_substring_dedup": OP2, "op4_chat_format": OP4, "op6_decontaminate": OP6,
           "op9_suffix_dedup": OP9, "op12_conversation_repair": OP12,
           "op13_line_dedup": OP13}
