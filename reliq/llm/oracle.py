"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

WORD_CLASS = "[^\\x20\\x09-\\x0D]+"

OP2 = r"""
with split as (
  select doc_id, u.pos, u.line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents) d,
       lateral (select unnest(ls) as line, generate_subscripts(ls, 1) as pos) u
), hot as (
  select k, max(doc_id) as top from split where length(k) >= 20
  group by k having count(distinct doc_id) >= 3
), marked as (
  select s.doc_id, s.pos, s.line, (h.k is not null and s.doc_id <> h.top) as gone
  from split s left join hot h on s.k = h.k
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

OP10 = r"""
with words as (
  select doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
  from documents
), windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows) where n > 1
), covered as (
  select doc_id, count(distinct i + o) as n from twice, (select unnest([0, 1, 2]) as o) group by doc_id
), measured as (
  select w.doc_id, len(w) as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::bigint as n_symbols,
         len(regexp_extract_all(coalesce(text, ''), '[A-Z]'))::bigint as n_upper,
         len(ls) as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words
  from words w left join covered c using (doc_id)
), ruled as (
  select *, ((n_words < 50)::bigint + 2 * (100 * n_repeat_words > 50 * n_words)::bigint
         + 4 * (10 * n_symbols > n_words)::bigint + 8 * (2 * n_dup_lines > n_lines)::bigint
         + 16 * (n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words))::bigint
         + 32 * (10 * n_upper > 3 * word_chars)::bigint)::bigint as bits
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 as base_failed, bits = 0 as kept, bits, (bits & 3) = 0 as kept_by_policy_1, sole_rule,
       case when sole_rule is not null then count(*) over (partition by sole_rule) end as n_alone
from (select *, case bits when 1 then 'few_words' when 2 then 'repeated_words' when 4 then 'many_symbols'
                          when 8 then 'duplicate_lines' when 16 then 'word_length' when 32 then 'upper_case' end as sole_rule
      from ruled)
"""

OP3 = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), tests as (
  select distinct item_id, least(len(w), 10) as m, array_to_string(w[i:i + 9], ' ') as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from bw where len(w) > 0)
), widths as (select distinct m from tests),
places as (
  select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as g
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from dw, widths where len(w) >= m)
), found as (
  select p.doc_id, p.i, p.m, t.item_id from places p join tests t on p.m = t.m and p.g = t.g
), hit as (
  select doc_id, count(distinct i + o) as n_hit
  from (select distinct doc_id, i, unnest(range(0, m)) as o from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from found) group by doc_id
), spots as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from dw
), often as (select word, count(*) as n from spots group by word),
sets as (select distinct g, string_split(g, ' ') as terms from tests),
pivots as (
  select g, any_value(terms) as terms, len(any_value(terms)) + 5 as room, arg_min(word, (n, word)) as word
  from (select g, terms, unnest(terms) as word from sets) join often using (word) group by g
), rooms as (
  select s.doc_id, v.g, v.terms, v.room, d.w[greatest(s.p - v.room + 1, 1):s.p + v.room - 1] as part
  from pivots v join spots s using (word) join dw d on d.doc_id = s.doc_id
), stretches as (
  select doc_id, g, terms, part[k:k + room - 1] as part
  from (select *, unnest(range(1, greatest(len(part) - room + 1, 1) + 1)) as k from rooms where list_has_all(part, terms))
), close as (
  select distinct doc_id, g from stretches
  where len(list_filter(terms, lambda t: len(list_filter(part, lambda x: x = t)) < len(list_filter(terms, lambda x: x = t)))) = 0
), near as (
  select doc_id, count(*) as n_near, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from close join tests using (g)) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated,
       coalesce(n_near, 0) as n_near, sha256(coalesce(near.ids, '')) as near_sha256
from dw d left join hit h using (doc_id) left join items using (doc_id) left join near using (doc_id)
"""

#: CRC-32 of the decimal text of a number, bit by bit.
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
  list_transform(range(1, length({0}::varchar) + 1), lambda i: ascii(substr({0}::varchar, i::int, 1))::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                           lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))))"""

OP11 = r"""
with turns as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as i,
         struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) as t
  from conversations where conv_id is not null
), convs as (
  select c, c - c % 5 as base, CRC_OF_C % 9 as h, list(t order by i) as own from turns group by c
), rebuilt as (
  select a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) as s
  from convs a left join convs b on b.c = a.base
), prefixes as (
  select c, d, len(s) as m, md5(s[1:d]::json::varchar) as k, s[d].text as last
  from (select c, s, unnest(range(0, len(s) + 1)) as d from rebuilt)
), nodes as (
  select k, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * coalesce(octet_length(encode(any_value(last))), 0) as own,
         sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (m = d), '')) as ends
  from prefixes group by k, d
), linked as (
  select n.*, p.k as up, q.conv_id as parent
  from nodes n left join prefixes p on p.c = n.conv_id and p.d = n.d - 1 left join nodes q on q.k = p.k and q.d = p.d
), children as (
  select up as k, d - 1 as d, count(*) as n from linked where up is not null group by all
), sums as (
  select p.k, p.d, sum((x.n is null)::bigint) as n_leaves, sum(n.own) as saved
  from nodes n join prefixes p on p.c = n.conv_id and p.d <= n.d left join children x on x.k = n.k and x.d = n.d
  group by p.k, p.d
)
select l.conv_id, l.d::bigint as depth, l.parent as parent_conv_id, l.n_convs, coalesce(x.n, 0) as n_children,
       s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, l.ends as ends_sha256
from linked l join sums s on s.k = l.k and s.d = l.d left join children x on x.k = l.k and x.d = l.d
""".replace("CRC_OF_C", CRC.format("c"))

OP12 = r"""
with plain as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
       row_number() over (partition by t order by doc_id) = 1 as kept, sha256(t) as text_sha256
from plain window same as (partition by t)
"""

_FIELD = "coalesce(octet_length(encode(({0})::varchar))::varchar || ':' || ({0})::varchar, '-')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(name) for name in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_NEXT = """select tree, lev + 1 as lev, i // 8 as i, (n + 7) // 8 as n, sha256(string_agg(h, '' order by i)) as h
  from {0} where n > 1 group by tree, lev, i // 8, n"""
_RUNS = "select tree, lev, i // 8 as run, list(h order by i) as hs from {0} where n > 1 group by tree, lev, i // 8"
_STEP = """select doc_id, {1} f.lev + 1 as lev, f.i // 8 as i,
         sha256(array_to_string(r.hs[1:f.i % 8], '') || f.h || array_to_string(r.hs[f.i % 8 + 2:], '')) as h,
         f.proof || array_to_string(r.hs[1:f.i % 8], '') || array_to_string(r.hs[f.i % 8 + 2:], '') as proof
  from {0} f join {2} r on r.tree = f.tree and r.lev = f.lev and r.run = f.i // 8"""

OP13 = f"""
with recursive read as (
  select doc_id, coalesce('=' || lang, '') as tree, {_leaf('text')} as leaf,
         case when {CRC.format('doc_id')} % 3 = 0 then {_leaf(_LOWER)} else {_leaf('text')} end as altered
  from documents
), leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n
  from read
), nodes as (
  select tree, 0::bigint as lev, i, n, leaf as h from leaves union all {_NEXT.format('nodes')}
), runs as ({_RUNS.format('nodes')}),
subroots as (select tree, h from nodes where n = 1),
tops as (
  select '' as tree, 0::bigint as lev, row_number() over (order by tree) - 1 as i, count(*) over () as n, h from subroots
  union all {_NEXT.format('tops')}
), top_runs as ({_RUNS.format('tops')}),
inner_folds as (
  select doc_id, tree, 0::bigint as lev, i, altered as h, '' as proof from leaves
  union all {_STEP.format('inner_folds', 'f.tree,', 'runs')}
), at_subroot as (
  select doc_id, tree, arg_max(h, lev) as h, arg_max(proof, lev) as proof from inner_folds group by doc_id, tree
), folds as (
  select doc_id, '' as tree, 0::bigint as lev, p.i, a.h, a.proof
  from at_subroot a join (select tree, row_number() over (order by tree) - 1 as i from subroots) p using (tree)
  union all {_STEP.format('folds', "'' as tree,", 'top_runs')}
), done as (
  select doc_id, arg_max(h, lev) as folded_root, arg_max(proof, lev) as proof from folds group by doc_id
)
select l.doc_id, l.leaf, s.h as subroot, r.h as root, sha256(d.proof) as proof_sha256, d.folded_root, d.folded_root = r.h as verified
from leaves l join subroots s on s.tree = l.tree join done d on d.doc_id = l.doc_id, (select h from tops where n = 1) r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": OP2,
        "op3_benchmark_decontamination": OP3,
        "op10_quality_rules": OP10,
        "op11_prefix_trie": OP11,
        "op12_exact_dedup": OP12,
        "op13_merkle_manifest": OP13,
    }
