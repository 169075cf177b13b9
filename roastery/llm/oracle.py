"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from roastery.llm.decontaminate import AGREE, MASKS, RUN
from roastery.llm.line_dedup import BASE as CHUNK_BASE
from roastery.llm.line_dedup import DIVISOR, ROLL
from roastery.llm.line_dedup import LEAST_WORDS as PASSAGE_WORDS
from roastery.llm.line_dedup import PRIME as CHUNK_PRIME
from roastery.llm.quality_rules import LEAST_LEFT, LEAST_WORDS, LINE_DOCUMENTS, LINE_SHARE, MOST_REPEATED
from roastery.llm.secret_scan import BASE, RULES
from roastery.llm.sharding import KEY, PRIME, SHARDS, round_keys

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
with w as (select doc_id, {WORDS} as ws from documents),
     win as (select doc_id, s, array_to_string(ws[s:s + 19], ' ') as k
             from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as s from w where len(ws) >= 20)),
     first as (select k, min({{'d': doc_id, 's': s}}) as f from win group by k),
     gone as (select distinct doc_id, unnest(range(s, s + 20)) as i
              from win join first using (k) where {{'d': doc_id, 's': s}} <> f),
     lost as (select doc_id, list(i) as l, count(*) as c from gone group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, coalesce(c, 0)::bigint as n_removed,
       sha256(coalesce((select string_agg(x, ' ' order by i) from (select unnest(ws) as x, unnest(range(1, len(ws) + 1)) as i)
                        where l is null or not list_contains(l, i)), '')) as kept_sha256
from w left join lost using (doc_id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
with recursive w as (select doc_id, {WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))} as ws from documents),
     s as (select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as k
           from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from w where len(ws) > 0)),
     n as (select doc_id, count(*) as n from s group by doc_id),
     pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (k) where a.doc_id <> b.doc_id group by 1, 2),
     links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
     reach as (select doc_id as node, doc_id as other from w union select r.node, l.b from reach r join links l on l.a = r.other),
     comp as (select node, min(other) as component_id from reach group by node)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, w.doc_id = component_id as kept
from w left join n using (doc_id) join comp on node = w.doc_id
"""

def _feistel_round(keys: tuple[int, int]) -> str:
    scrambled = f"((((low % {PRIME}) + {keys[0]}) % {PRIME}) * (((low % {PRIME}) + {keys[1]}) % {PRIME}) % {PRIME}) & mask"
    return f"select r, n, bits, mask, low as high, xor(high, {scrambled}) as low from"


def _feistel() -> str:
    """One pass of the network over the rows that still walk."""
    inner = "(select r, n, bits, mask, x >> bits as high, x & mask as low from walk where x >= n or step = 0)"
    for keys in round_keys(KEY):
        inner = f"({_feistel_round(keys)} {inner})"
    return inner


_NUMBER = "(('0x' || substr(md5(l), 1, 8))::bigint % {p})".format(p=CHUNK_PRIME)


def _rolled() -> str:
    out = "0::bigint"
    for back in range(ROLL - 1, -1, -1):
        value = "n" if not back else f"coalesce(lag(n, {back}) over (partition by doc_id order by i), 0)"
        out = f"(({out} * {CHUNK_BASE} + {value}) % {CHUNK_PRIME})"
    return out


OP4 = rf"""
with l as (select doc_id, unnest(range(len(ls))) as i, unnest(ls) as l from (select doc_id, string_split(text, chr(10)) as ls from documents)),
     r as (select doc_id, i, l, {_rolled()} % {DIVISOR} = 0 as cut from (select *, {_NUMBER} as n from l)),
     c as (select doc_id, i, l, coalesce(sum(cut::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as place from r),
     chunks as (select doc_id, place, string_agg(l, chr(10) order by i) as chunk, count(*) as size from c group by 1, 2),
     first as (select chunk, min({{'d': doc_id, 'p': place}}) as f from chunks
               where size > 1 and regexp_matches(chunk, '[^\x20\x09-\x0D]') group by chunk),
     judged as (select doc_id, place, chunk, f is not null and f <> {{'d': doc_id, 'p': place}} as gone from chunks left join first using (chunk))
select doc_id, count(*) filter (where gone) as n_chunks_removed,
       sha256(coalesce(string_agg(chunk, chr(10) order by place) filter (where not gone), '')) as text_sha256
from judged group by doc_id
union all select doc_id, 0, null from documents where text is null
"""

OP4_PASSAGES = rf"""
with l as (select doc_id, unnest(range(len(ls))) as i, unnest(ls) as l from (select doc_id, string_split(text, chr(10)) as ls from documents)),
     w as (select *, row_number() over (partition by doc_id order by i) as k, sum(n) over (partition by doc_id order by i) as till
           from (select *, len({WORDS.replace("coalesce(text, '')", "l")}) as n from l) where n > 0),
     runs as (select a.doc_id, a.k as s, b.k as e from w a join w b
              on a.doc_id = b.doc_id and b.k between a.k and a.k + {PASSAGE_WORDS} and b.till - a.till + a.n >= {PASSAGE_WORDS}),
     spans as (select doc_id, s, min(e) as e from runs group by doc_id, s union select doc_id, max(s), e from runs group by doc_id, e),
     win as (select spans.doc_id, s, e, min(i) as start, max(i) as stop, string_agg(l, chr(10) order by k) as passage
             from spans join w on w.doc_id = spans.doc_id and k between s and e group by 1, 2, 3),
     first as (select passage, min({{'d': doc_id, 's': start}}) as f from win group by passage),
     gone as (select distinct doc_id, unnest(range(start, stop + 1)) as i from win join first using (passage) where f <> {{'d': doc_id, 's': start}})
select l.doc_id, count(gone.i) as n_lines_removed, sha256(coalesce(string_agg(l, chr(10) order by l.i) filter (where gone.i is null), '')) as text_sha256
from l left join gone on gone.doc_id = l.doc_id and gone.i = l.i group by l.doc_id
union all select doc_id, 0, null from documents where text is null
"""


def _masked(ws: str, mask: str) -> str:
    """The kept words of a stretch from place p on, as one text."""
    return " || ' ' || ".join(f"{ws}[p + {i + 1}]" for i, c in enumerate(mask) if c == "1")


def _seeds(table: str, key: str, ws: str) -> str:
    return " union all ".join(
        f"select {key}, p, '{m}' as mask, {_masked(ws, m)} as seed from (select {key}, {ws}, unnest(range(len({ws}) - {len(m) - 1})) as p "
        f"from {table} where len({ws}) >= {len(m)})"
        for m in MASKS
    )


_TOKENS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
OP5 = rf"""
with d as (select doc_id, {_TOKENS} as ws from documents),
     b as (select distinct item_id, {_TOKENS} as item from benchmark),
     ds as ({_seeds("d", "doc_id", "ws")}),
     bs as ({_seeds("b", "item_id", "item")}),
     hits as (select distinct doc_id, item_id, ds.p - bs.p as shift from ds join bs using (mask, seed)),
     runs as (select doc_id, item_id, shift, ws, item, unnest(range(len(item) - least(len(item), {RUN}) + 1)) as o
              from hits join d using (doc_id) join b using (item_id)),
     agree as (select doc_id, item_id, o + shift as doc_start, least(len(item), {RUN}) as n_run,
                      len(list_filter(range(least(len(item), {RUN})), lambda j: o + shift + j >= 0 and ws[o + shift + j + 1] = item[o + j + 1])) as n_agree
               from runs)
select doc_id, item_id, max(n_agree)::bigint as n_agree, max(n_run)::bigint as n_run,
       (arg_max(doc_start, n_agree * 1000000000 - doc_start))::bigint as doc_start
from agree where 100 * n_agree >= {AGREE} * n_run group by doc_id, item_id
"""

# Fixed value: the reversed polynomial of the usual CRC-32.
_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: xor(c >> 1, 3988292384 * (c & 1))))"
_BYTES = "list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)"

OP6 = rf"""
with recursive crc as (select {_CRC_TABLE} as entry),
     sized as (
       select doc_id, (strlen(coalesce(text, '')) + 16)::bigint as size, text,
              row_number() over (order by doc_id) - 1 as r, count(*) over () as n from documents),
     half as (select greatest(1, ceil(ceil(log2(greatest(count(*), 2))) / 2))::bigint as b from documents),
     walk as (
       select r, n, b as bits, (1::bigint << b) - 1 as mask, r as x, 0 as step from sized, half
       union all
       select r, n, bits, mask, (high << bits) | low, 1 from {_feistel()}),
     moved as (select r, x from walk where step = 1 and x < n)
select doc_id, size,
       xor(list_reduce(list_prepend(4294967295::bigint, {_BYTES}), lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32,
       'rows' as law, (x % {SHARDS})::int as shard, (x // {SHARDS})::bigint as slot, null::int as grown_shard
from sized join moved using (r), crc
"""

def _spans(rule) -> str:
    """Spans of one rule: the texts between matches and the matches alternate, so their lengths add up to places."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
select doc_id, '{rule.kind}' as kind, {[r.kind for r in RULES].index(rule.kind)} as rk, e - length(m) as s, e
from (select doc_id, i, m, g, sum(length(b) + length(m)) over (partition by doc_id order by i) as e
      from (select doc_id, unnest(range(len(ms))) as i, unnest(ms) as m, unnest(gs) as g, unnest(bs[:len(ms)]) as b
            from (select doc_id, regexp_extract_all(text, '{pattern}') as ms, regexp_extract_all(text, '{pattern}', {rule.group}) as gs,
                         string_split_regex(text, '{pattern}') as bs from documents where text is not null)))
where length(g) >= {rule.least}"""


_JOINED = "coalesce(string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, rk){}, '')"
_BASE_KINDS = ", ".join(f"'{r.kind}'" for r in BASE)
OP8 = rf"""
with spans as ({" union all ".join(_spans(r) for r in RULES)})
select doc_id, {", ".join(f"count(*) filter (where kind = '{r.kind}') as n_{r.kind}" for r in BASE)},
       sha256({_JOINED.format(f" filter (where kind in ({_BASE_KINDS}))")}) as base_sha256, {_JOINED.format("")} as spans
from documents left join spans using (doc_id) group by doc_id
"""

_NORMAL = r"lower(trim(regexp_replace({}, '[\x20\x09-\x0D]+', ' ', 'g'), ' '))"
_HAS_WORD = r"regexp_matches({}, '[^\x20\x09-\x0D]')"

OP10 = rf"""
with w as (select doc_id, coalesce(source, chr(1)) as host, coalesce(text, '') as text, {WORDS} as ws from documents),
     l as (select doc_id, host, x, {_NORMAL.format("x")} as norm from (select doc_id, host, unnest(string_split(text, chr(10))) as x from w)
           where {_HAS_WORD.format("x")}),
     hosts as (select host, count(*) as docs from w group by host),
     often as (select host, norm from (select host, norm, count(distinct doc_id) as n from l group by host, norm) join hosts using (host)
               where n > {LINE_DOCUMENTS} and n > {LINE_SHARE}::double * docs),
     lines as (select doc_id, count(*) - count(distinct x) as dup,
                      sum(case when often.norm is null then 0 else len(list_filter(string_split_regex(x, '[ 	-
]+'), lambda t: t <> '')) end) as often
               from l left join often using (host, norm) group by doc_id),
     win as (select doc_id, s, array_to_string(ws[s:s + 7], ' ') as k
             from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as s from w where len(ws) >= 8)),
     twice as (select doc_id, k from win group by doc_id, k having count(*) > 1),
     again as (select doc_id, count(distinct i) as c from (select doc_id, unnest(range(s, s + 8)) as i from win semi join twice using (doc_id, k)) group by doc_id),
     m as (select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
                  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
                  coalesce(dup, 0)::bigint as n_dup_lines, coalesce(c, 0)::bigint as n_repeat_words, coalesce(often, 0)::bigint as n_frequent_words
           from w left join lines using (doc_id) left join again using (doc_id)),
     f as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * (n_words - n_frequent_words) >= {LEAST_LEFT} * n_words as kept, n_frequent_words
from f
"""

_FAILS = {
    "A": "len(ws) < 200",
    "B": "100 * len(list_distinct(ws)) < 50 * len(ws)",
    "C": "100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text)",
    "D": "regexp_matches(text, '[#$%&*|]')",
    "E": "doc_id > min(doc_id) over (partition by text)",
}
OP11 = rf"""
with w as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, {WORDS} as ws from documents),
     f as (select doc_id, part, {", ".join(f"{test} as {x}" for x, test in _FAILS.items())} from w),
     combos as (select part, A, B, C, D, E, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic, count(*) as n
                from f left join labels using (doc_id) group by all),
     letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
     orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e
                where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     steps as (select filter_order, step::integer as step, filter_order[step] as own, filter_order[1:step - 1] as before
               from orders, (select unnest(range(1, 6)) as step)),
     failed as (select *, concat(case when A then 'A' end, case when B then 'B' end, case when C then 'C' end,
                                 case when D then 'D' end, case when E then 'E' end) as letters from combos),
     hit as (select part, filter_order, step, own, good, toxic, n, contains(letters, own) as fails, letters = own as alone,
                    regexp_matches(letters, case when before = '' then 'none' else '[' || before || ']' end) as gone
             from failed, steps),
     m as (select part, filter_order, step, own, sum(n) filter (where not fails and not gone) as kept,
                  sum(n) filter (where fails and not gone) as removed, sum(n) filter (where fails and gone) as redundant,
                  sum(n) filter (where alone) as unique_fails, sum(n) filter (where fails and not gone and good) as good_lost,
                  sum(n) filter (where fails and not gone and toxic) as toxic_lost
           from hit group by all)
select part, filter_order, step, {", ".join(f"coalesce({c}, 0)::bigint as {c}" for c in "kept removed redundant unique_fails good_lost toxic_lost".split())},
       coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley, own as filter
from m
"""

OP13 = r"""
with terms as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
     asked as (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
     tf as (select doc_id, term, count(*) as tf from terms group by all),
     lengths as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
     whole as (select count(*) as N_docs, sum(n)::bigint as L from lengths),
     df as (select term, count(*) as df from tf group by term),
     weights as (select term, floor(1000 * ln((2 * N_docs + 2)::double / (2 * df + 1)))::bigint as w from df, whole),
     m as (select doc_id, 100 - 25 + ((25 * n * N_docs) // L) as m from lengths, whole),
     scores as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
                from asked join tf using (term) join weights using (term) join m using (doc_id) group by all),
     ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
                from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

ORACLE = {
    "op1_substring_dedup": OP1,
    "op2_minhash_dedup": OP2,
    "op4_line_dedup": OP4,
    "op4_passage_dedup": OP4_PASSAGES,
    "op5_decontaminate": OP5,
    "op6_sharding": OP6,
    "op8_secret_scan": OP8,
    "op10_quality_rules": OP10,
    "op11_filter_audit": OP11,
    "op13_lexical_search": OP13,
}
