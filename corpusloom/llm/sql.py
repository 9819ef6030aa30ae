"""DuckDB SQL of the newer queries: each states its contract as plainly as SQL can."""

from __future__ import annotations


def _moved(state: str, paid: str, letters: str) -> str:
    """A state's ``cost || letters`` after paying and writing some more; null stays null."""
    return f"(lpad((substr({state}, 1, 8)::int + {paid})::varchar, 8, '0') || substr({state}, 9) || '{letters}')"


def _step() -> str:
    """The next list of best strings for nothing, system, user and assistant last, from list ``z`` and symbol ``e[1]``."""
    nothing, system, user, assistant = (f"z[{i}]" for i in range(1, 5))
    late = "(e[1][2:] = '+')::int"
    fits = lambda c, x: f"case when e[1][1] = '{c}' then {x} end"
    new = lambda s, k: _moved(s, f"{late} + {k}", "R" if k == 2 else "IR")
    to_user = [fits("u", _moved(s, late, "K")) for s in (nothing, system, assistant)] + [new(s, 2) for s in (nothing, system, assistant)]
    to_user += [fits("u", _moved(user, f"{late} + 2", "IK")), new(user, 4)]
    to_assistant = [fits("a", _moved(user, late, "K")), new(user, 2)]
    to_assistant += [fits("a", _moved(s, f"{late} + 2", "IK")) for s in (nothing, system, assistant)] + [new(s, 4) for s in (nothing, system, assistant)]
    ways = [[], [fits("s", _moved(nothing, late, "K"))], to_user, to_assistant]
    gone = [_moved(s, "3", "D") for s in (nothing, system, user, assistant)]
    kept = [f"case when e[1] <> 'x' then least({', '.join(w)}, null) end" if w else "null" for w in ways]
    return "[" + ", ".join(f"least({g}, {k})" for g, k in zip(gone, kept)) + "]"


CRC_TABLE = """
crc_table as (
  select list(c order by n) as t from (
    select n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(n)
  )
)"""

OP11_SQL = f"""
with {CRC_TABLE},
base as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_concat([4294967295::bigint], [('0x' || b)::bigint for b in regexp_extract_all(hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))), '..')]),
                         lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1])), 4294967295) % 20 as kind
  from conversations, crc_table t
),
hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from base where kind <> 0
),
placed as (
  select conv_id, turn, role, text, substr(role, 1, 1) as c, row_number() over w as i, lag(substr(role, 1, 1)) over w as before,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as last
  from hurt window w as (partition by conv_id order by turn nulls first, role, text)
),
faults as (
  select *, case when last = '' then 1 when row_number() over (partition by conv_id, role, text order by i) > 1 then 2 when last not in ('.', '!', '?') then 3 else 0 end as fault from placed
),
sums as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
         count(*) filter (before is not null and before || c not in ('su', 'ua', 'au')) as illegal,
         list([case when fault in (1, 2) then 'x' else case when c in ('s', 'u', 'a') then c else 'o' end || case when fault = 3 then '+' else '' end end] order by i) as sig
  from faults group by conv_id
),
layers as (
  select *, list_reduce(list_concat([['00000000', null, null, null]::varchar[]], sig), lambda z, e: {_step()}) as z from sums
),
solved as (
  select conv_id, gaps, blank, duplicate, truncated, illegal, least(z[1], z[4], {_moved('z[3]', '2', 'I')}, {_moved('z[2]', '4', 'II')}) as best from layers
),
letters as (
  select conv_id, unnest(range(1, len(best) - 7)) as j, unnest(string_split(substr(best, 9), '')) as letter from solved where len(best) > 8
),
counted as (select *, sum((letter <> 'I')::int) over (partition by conv_id order by j) as i from letters),
kept as (
  select l.conv_id, l.j, l.letter, f.role, f.text, row_number() over w as o,
         first_value(case when l.letter = 'K' and f.c = 's' then 1 else 0 end) over w as led
  from counted l left join faults f on l.letter <> 'I' and l.conv_id is not distinct from f.conv_id and l.i = f.i
  where l.letter <> 'D' window w as (partition by l.conv_id order by l.j)
),
texts as (
  select conv_id, string_agg(case letter when 'K' then role when 'I' then case when (o - led) % 2 = 1 then 'user' else 'assistant' end
                               else case when (o - led) % 2 = 1 then 'user' else 'assistant' end end
                             || ':' || case when letter = 'I' then '' else text end, chr(10) order by j) as body
  from kept group by conv_id
)
select d.conv_id, cast(coalesce(s.gaps, 0) as bigint) as gaps, cast(coalesce(s.blank, 0) as bigint) as blank,
       cast(coalesce(s.duplicate, 0) as bigint) as duplicate, cast(coalesce(s.truncated, 0) as bigint) as truncated,
       cast(coalesce(s.illegal, 0) as bigint) as illegal, coalesce(substr(s.best, 1, 8)::bigint, 0) as cost,
       coalesce(substr(s.best, 9), '') as audit, sha256(coalesce(t.body, '')) as repaired_sha256
from (select distinct conv_id from conversations) d
left join solved s on d.conv_id is not distinct from s.conv_id
left join texts t on d.conv_id is not distinct from t.conv_id
"""

#: The terms of a text: letters and digits of ASCII, and everything beyond ASCII. A fixed pattern.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
with rows as (select doc_id, row_number() over () as r, {_LOWER.format('text')} as text from documents),
terms as (select doc_id, r, unnest(regexp_extract_all(text, '{TERM}')) as term from rows),
sizes as (select r, any_value(doc_id) as doc_id, count(*) as n from terms group by r),
totals as (select count(*) as big_n, sum(n)::bigint as l from sizes),
asked as (
  select item_id, q, term, count(*) as times from (
    select item_id, row_number() over () as q, unnest(regexp_extract_all({_LOWER.format('text')}, '{TERM}')) as term from benchmark
  ) group by all
),
tfs as (select r, term, count(*) as tf from terms where term in (select term from asked) group by all),
dfs as (select term, count(*) as df from tfs group by term),
scored as (
  select a.item_id, a.q, s.doc_id, f.r,
         sum(a.times * floor(1000 * ln((2 * t.big_n + 2)::double / (2 * d.df + 1)::double))::bigint
             * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * s.n * t.big_n) // t.l))))::bigint as score
  from tfs f join asked a using (term) join dfs d using (term) join sizes s on s.r = f.r, totals t group by all
)
select item_id, cast(row_number() over w as int) as rank, doc_id, score from scored where score > 0
window w as (partition by q order by score desc, doc_id nulls last) qualify row_number() over w <= 20
"""

#: Windows are named by their MD5; of each text's bytes, those that no repeated window covers are kept.
OP13_SQL = """
with texts as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as t from documents),
windows as (
  select r, i, md5(t[i:i + 199]) as w
  from (select r, t, unnest(range(1, octet_length(t) - 198)) as i from texts where octet_length(t) >= 200)
),
often as (select w from windows group by w having count(*) > 1),
hits as (select r, i from windows where w in (select w from often)),
edges as (select *, coalesce(i - lag(i) over (partition by r order by i) > 200, true)::int as fresh from hits),
runs as (select *, sum(fresh) over (partition by r order by i) as run from edges),
spans as (select r, min(i) as a, max(i) + 200 as z from runs group by r, run),
bounds as (
  select r, coalesce(lag(z) over (partition by r order by a), 1) as a, a as z from spans
  union all
  select s.r, max(s.z) as a, octet_length(any_value(x.t)) + 1 as z from spans s join texts x using (r) group by s.r
),
kept as (select b.r, string_agg(hex(x.t[b.a:b.z - 1]), '' order by b.a) as body from bounds b join texts x using (r) where b.z > b.a group by b.r),
counts as (select r, sum(z - a) as n_removed, count(*) as n_spans from spans group by r)
select x.doc_id, cast(octet_length(x.t) as bigint) as n_bytes, cast(coalesce(c.n_removed, 0) as bigint) as n_removed,
       cast(coalesce(c.n_spans, 0) as bigint) as n_spans,
       sha256(case when c.r is null then x.t else unhex(coalesce(k.body, '')) end) as kept_sha256
from texts x left join counts c using (r) left join kept k using (r)
"""
