"""SQL with the same result as the registered queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (
        f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )


#: All pairs of vectors of one label, then the least id reachable.
_VECTORS = """
with recursive v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
), links as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
)
select vec_id, cast((select count(*) from links l where l.a = v.vec_id) as bigint) as n_links,
  least(vec_id, coalesce((select min(b) from reach r where r.a = v.vec_id), vec_id)) as component_id,
  vec_id = least(vec_id, coalesce((select min(b) from reach r where r.a = v.vec_id), vec_id)) as kept
from v
"""

#: Every 100-byte string with its place in the order of documents and starts.
_REPEATS = """
with d as materialized (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), windows as materialized (
  select doc_id, p, hash(substr(h, 2 * p + 1, 200)) as s from (select doc_id, h, unnest(range(0, n - 99)) as p from d)
), firsts as (
  select s, min((doc_id, p)) as f from windows group by s having count(*) > 1
), hits as materialized (
  select doc_id, p, p > lag(p) over (partition by doc_id order by p) + 100 as gap
  from windows join firsts using (s) where (doc_id, p) > f
), numbered as (
  select doc_id, p, sum(case when gap then 1 else 0 end) over (partition by doc_id order by p) as run from hits
), runs as materialized (
  select doc_id, min(p) as s, max(p) + 100 as e from numbered group by doc_id, run
), pieces as (
  select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as s, s as e from runs
  union all select d.doc_id, coalesce(max(r.e), 0), max(d.n) from d left join runs r using (doc_id) group by d.doc_id
), kept as (
  select doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' order by s) as h, sum(e - s) as n
  from pieces join (select doc_id, h from d) using (doc_id) group by doc_id
)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(d.n - k.n as bigint) as n_removed,
  cast((select count(*) from runs r where r.doc_id = d.doc_id) as bigint) as n_spans,
  sha256(unhex(k.h)) as kept_sha256
from d join kept k using (doc_id)
"""

_CONTAMINATION = f"""
with d as materialized (select doc_id, {_words("text")} as w from documents),
i as materialized (
  select item_id, w, least(10, len(w)) as n from (select item_id, {_words("text")} as w from benchmark) where len(w) > 0
), item_windows as materialized (
  select distinct item_id, n, array_to_string(w[k : k + n - 1], ' ') as s
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as k from i)
), hits as materialized (
  select distinct t.doc_id, t.k, t.n, iw.item_id
  from (
    select doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') as s
    from (
      select doc_id, w, z.n, unnest(range(1, len(w) - z.n + 2)) as k
      from d, (select distinct n from item_windows) z where len(w) >= z.n
    )
  ) t join item_windows iw on iw.n = t.n and iw.s = t.s
), words_hit as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(k, k + n)) as place from (select distinct doc_id, k, n from hits)) group by doc_id
), items_hit as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join words_hit using (doc_id) left join items_hit using (doc_id)
"""

_LM_SCORES = f"""
with d as materialized (select doc_id, {_words("text")} as w from documents),
t as materialized (
  select doc_id, len(w) as n, place, w[place] as word, case when place > 1 then w[place - 1] end as before
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as place from d)
), own1 as (select doc_id, word, count(*) as c from t group by all),
one as (select word, sum(c) as c from own1 group by word),
rest1 as materialized (
  select doc_id, word, one.c - own1.c as c from own1 join one using (word)
), own2 as (select doc_id, before, word, count(*) as c from t where before is not null group by all),
two as (select before, word, sum(c) as c from own2 group by all),
rest2 as materialized (
  select doc_id, before, word, two.c - own2.c as c from own2 join two using (before, word)
), total as (select count(*) as n from t),
scored as (
  select t.doc_id, t.n, t.before is not null and coalesce(r2.c, 0) = 0 as backed,
    case when coalesce(r2.c, 0) > 0 then ln(r2.c / h.c)
      else case when t.before is null then 0 else ln(0.4) end
        + case when r1.c > 0 then ln(r1.c / (total.n - t.n)) else ln(0.4 / (total.n - t.n)) end end as s
  from t cross join total
  join rest1 r1 on r1.doc_id = t.doc_id and r1.word = t.word
  left join rest1 h on h.doc_id = t.doc_id and h.word = t.before
  left join rest2 r2 on r2.doc_id = t.doc_id and r2.before = t.before and r2.word = t.word
)
select d.doc_id, cast(len(d.w) as bigint) as n_words,
  cast(coalesce(sum(case when backed then 1 else 0 end), 0) as bigint) as n_backoff, round(sum(s) / len(d.w), 6) as lm_score
from d left join scored using (doc_id) group by d.doc_id, d.w
"""

def _more(state: str, cost: str, edit: str) -> str:
    """A state's cost and audit with one edit more; null if it cannot be reached."""
    return f"case when {state} is not null then struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}') end"


def _kept(state: str, initial: str) -> str:
    return f"case when stays and initial = '{initial}' then {_more(state, 'extra', 'K')} end"


def _other_role(state: str) -> str:
    return f"case when stays then {_more(state, '2 + extra', 'R')} end"


def _inserted(v: str) -> str:
    """States before a row and those that up to two insertions reach; ``v`` has columns v0 to v3."""
    second = f"list_min([v2, {_more('v0', '2', 'I')}, {_more('v1', '2', 'I')}, {_more('v3', '2', 'I')}])"
    return (
        f"select conv_id, i, v0, v1, w2 as v2, list_min([v3, {_more('w2', '2', 'I')}]) as v3 "
        f"from (select *, {second} as w2 from {v})"
    )


_VISIBLE = r"[^\x20\x09-\x0D]"

#: CRC-32 by its table, damage, faults, then least costs and audits by row and role before.
_REPAIRS = f"""
with recursive crc_table as materialized (
  select list(list_reduce([n] || range(8), lambda c, _: xor(c >> 1, (c & 1) * 3988292384)) order by n) as t
  from range(256) r(n)
), raw as materialized (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
      lambda x: cast(ascii(x) as bigint)) as bytes
  from conversations
), marked as (
  select conv_id, turn, role, text,
    xor(list_reduce([4294967295] || bytes, lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as int) + 1])), 4294967295) % 20 as kind
  from raw, crc_table
), damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case kind when 3 then [0, 1] else [0] end) as copy
  from marked where kind <> 0
), placed as materialized (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as place from damaged
), faulty as materialized (
  select *, left(role, 1) as initial,
    case when not regexp_matches(text, '{_VISIBLE}') then 'blank'
      when row_number() over (partition by conv_id, role, text order by place) > 1 then 'duplicate'
      when not contains('.!?', right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)) then 'truncated'
      else '' end as fault
  from placed
), rows as materialized (
  select *, fault not in ('blank', 'duplicate') as stays, cast(fault = 'truncated' as bigint) as extra,
    lag(initial) over (partition by conv_id order by place) || initial as pair from faulty
), counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from rows group by conv_id
), states as (
  select conv_id, cast(0 as bigint) as i, struct_pack(c := cast(0 as bigint), a := '') as v0,
    cast(null as struct(c bigint, a varchar)) as v1, cast(null as struct(c bigint, a varchar)) as v2,
    cast(null as struct(c bigint, a varchar)) as v3 from counts
  union all
  select s.conv_id, s.i + 1, {_more("v0", "3", "D")},
    list_min([{_more("v1", "3", "D")}, {_kept("v0", "s")}]),
    list_min([{_more("v2", "3", "D")}, {_kept("v0", "u")}, {_kept("v1", "u")}, {_kept("v3", "u")},
      {_other_role("v0")}, {_other_role("v1")}, {_other_role("v3")}]),
    list_min([{_more("v3", "3", "D")}, {_kept("v2", "a")}, {_other_role("v2")}])
  from ({_inserted("states")}) s join rows r on r.conv_id is not distinct from s.conv_id and r.place = s.i + 1
), best as materialized (
  select conv_id, list_min([v0, v3]) as v
  from ({_inserted("(select s.* from states s join counts c on c.conv_id is not distinct from s.conv_id and c.n = s.i)")})
), edits as (
  select conv_id, k, v.a[k] as edit, length(replace(left(v.a, k), 'I', '')) as place
  from (select conv_id, v, unnest(range(1, length(v.a) + 1)) as k from best)
), lines as (
  select e.conv_id, e.k, e.edit, r.role, r.text, r.initial,
    row_number() over (partition by e.conv_id order by e.k) as line
  from edits e left join rows r on r.conv_id is not distinct from e.conv_id and r.place = e.place and e.edit <> 'I'
  where e.edit <> 'D'
), repaired as (
  select conv_id, string_agg(case when edit = 'K' then role when (line - headed) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case when edit = 'I' then '' else text end, chr(10) order by line) as whole
  from (select *, max(cast(line = 1 and edit = 'K' and initial = 's' as int)) over (partition by conv_id) as headed from lines)
  group by conv_id
)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank,
  cast(coalesce(duplicate, 0) as bigint) as duplicate, cast(coalesce(truncated, 0) as bigint) as truncated,
  cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(v.c, 0) as bigint) as cost, coalesce(v.a, '') as audit,
  sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id
left join repaired p on p.conv_id is not distinct from o.conv_id
"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Codebooks round by round; every distance is computed."""

    def assigned(r: int) -> str:
        return f"""a{r} as materialized (
  select p.vec_id, p.label, p.part, p.x, min(struct_pack(d := list_sum(list_transform(range(1, len(x) + 1),
    lambda i: (x[i] - c[i]) * (x[i] - c[i]))), entry := entry)) as near
  from pieces p join b{r} b using (part) group by all
)"""

    def moved(r: int) -> str:
        return f"""b{r + 1} as materialized (
  select b.part, b.entry, coalesce(m.c, b.c) as c from b{r} b left join (
    select part, entry, list(cast(floor(total / n) as bigint) order by i) as c from (
      select part, near.entry as entry, i, sum(x[i]) as total, count(*) as n
      from (select *, unnest(range(1, len(x) + 1)) as i from a{r}) group by all
    ) group by all
  ) m using (part, entry)
)"""

    steps = [f"{assigned(r)}, {moved(r)}" for r in range(rounds)]
    return f"""
with v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as e
  from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pieces as materialized (
  select vec_id, label, part, e[part * (len(e) // {parts}) + 1 : (part + 1) * (len(e) // {parts})] as x
  from (select *, unnest(range({parts})) as part from v)
), b0 as materialized (
  select part, row_number() over (partition by part order by vec_id) - 1 as entry, x as c
  from pieces where vec_id in (select vec_id from v order by vec_id limit {entries})
), {", ".join(steps)}, {assigned(rounds)}, coded as materialized (
  select vec_id, label, string_agg(printf('%02x', near.entry), '' order by part) as code, sum(near.d) as error
  from a{rounds} group by all
), hashed as (
  select sha256(string_agg(cast(x as varchar), ',' order by part, entry, i)) as h
  from (select part, entry, unnest(c) as x, unnest(range(len(c))) as i from b{rounds})
)
select vec_id, code, cast(error as bigint) as error, cast(sum(error) over (partition by label) as bigint) as label_error,
  h as codebooks_sha256
from coded, hashed
"""


ORACLES: dict[str, str] = {
    "op3_embedding_dedup": _VECTORS,
    "op6_suffix_index": _REPEATS,
    "op7_decontamination": _CONTAMINATION,
    "op8_lm_scores": _LM_SCORES,
    "op11_conversation_repair": _REPAIRS,
    "op13_vector_codes": _codes(),
}
