"""For the operators that SQL can express, the DuckDB statement that must give the same rows on the same tables."""

from __future__ import annotations

from crossroads.llm.chat import CONTROLS, END, TEXT, TURN
from crossroads.llm.quality import STOP_WORDS, THRESHOLDS

WORD = r"[^\x20\x09-\x0D]+"
ORACLE: dict[str, str] = {}

_RATIOS = {
    "n_words": "n_words", "repeat_word_ratio": "n_repeat_words / n_words", "mean_word_chars": "word_chars / n_words",
    "symbol_word_ratio": "n_symbols / n_words", "stop_word_ratio": "n_stop_words / n_words", "letter_word_ratio": "n_letter_words / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines", "ellipsis_line_ratio": "n_ellipsis_lines / n_lines",
}
_TESTS = [f"coalesce({_RATIOS[n]}, 0) >= {low}::double" for n, low, _ in THRESHOLDS if low is not None]
_TESTS += [f"coalesce({_RATIOS[n]}, 0) <= {high}::double" for n, _, high in THRESHOLDS if high is not None]
_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLE["op9_quality_rules"] = f"""with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{WORD}') as ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
g as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as three from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
r as (select doc_id, count(distinct i + k) as n from (select *, count(*) over (partition by doc_id, three) as c from g),
  (values (0), (1), (2)) x(k) where c > 1 group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
  cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
  coalesce(r.n, 0) as n_repeat_words, cast(len(ls) as bigint) as n_lines,
  cast(len(list_filter(ws, lambda x: lower(x) in ({_STOPS}))) as bigint) as n_stop_words,
  cast(len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) as bigint) as n_ellipsis_lines,
  cast(len(list_filter(ws, lambda x: regexp_matches(x, '\\p{{L}}'))) as bigint) as n_letter_words
  from w left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select *, not base_failed and {' and '.join(_TESTS)} as kept from b"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BENCH_WORD}')"


ORACLE["op8_benchmark_hits"] = f"""with b as (select cast(item_id as varchar) as item_id, {_lowered('text')} as ws from benchmark),
pat as (select distinct item_id, least(10, len(ws)) as n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as k
  from (select *, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from b where len(ws) > 0)),
sizes as (select distinct n from pat),
d as (select doc_id, {_lowered('text')} as ws from documents),
win as (select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') as k
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, sizes where len(ws) >= n)),
hit as (select doc_id, i, win.n, item_id from win join pat on pat.n = win.n and pat.k = win.k),
own as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + n)) as x from hit) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct doc_id, item_id from hit where item_id is not null) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join own using (doc_id) left join items using (doc_id)"""

ORACLE["op6_substring_dedup"] = f"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from d where len(ws) >= 13)),
late as (select doc_id, i from (select *, min(doc_id) over (partition by k) as first_id from win) where first_id < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as i from late),
kept as (select doc_id, string_agg(word, ' ' order by i) as words, count(*) as n from
  (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from d) w anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(words, '')) as kept_sha256
from d left join kept using (doc_id)"""


def _crc_table() -> str:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(str(c))
    return "[" + ", ".join(out) + "]::bigint[]"


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; ``crc_table`` is a common table of one row with the list ``t``."""
    return f"""xor(list_reduce(list_concat([4294967295::bigint], list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint)"""


ORACLE["op13_spelling_variants"] = f"""with recursive crc_table as (select {_crc_table()} as t),
runs as (select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
low as (select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs where length(run) >= 7 group by all),
hashed as (select run, n, {_crc32("id || ':' || run")} as h from low, crc_table),
kept as (select case when h % 31 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from hashed),
w as (select word, cast(sum(n) as bigint) as n from kept where length(word) >= 7 group by word having sum(n) >= 2),
cut as (select word, n, i, word[:i - 1] || word[i + 1:] as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
pairs as (select distinct a.word, b.word as other, b.n as m from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select c.word, w.word, w.n from cut c join w on c.rest = w.word union select w.word, c.word, c.n from cut c join w on c.rest = w.word),
best as (select word, count(*) as n_near, max(m) as m from pairs group by word),
named as (select best.word, n_near, best.m, min(other) as form from best join pairs on pairs.word = best.word and pairs.m = best.m group by all),
f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * w.n then form end as form, case when m >= 10 * w.n then m end as form_n from w left join named using (word)),
walk as (select word, word as at, form as next from f union all select walk.word, f.word, f.form from walk join f on walk.next = f.word)
select f.*, walk.at as root from f join walk on walk.word = f.word and walk.next is null"""

ORACLE["op12_prefix_trie"] = f"""with crc_table as (select {_crc_table()} as t),
own as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as i,
  coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
ids as (select c, c - ((c % 100) + 100) % 100 as donor, {_crc32("cast(c as varchar)")} % 6 as h from (select distinct c from own), crc_table),
made as (select ids.c, o.i, o.r, o.x from ids join own o on o.c = ids.donor and o.i <= h
  union all select o.c, o.i, o.r, o.x from own o join ids on ids.c = o.c where o.i > h),
seq as (select c, row_number() over (partition by c order by i) as d, length(r) || ':' || r || x as turn, length(x) as chars from made),
mem as (select c, d, chars, md5(string_agg(md5(turn), '') over (partition by c order by d)) as k from seq),
with_root as (select c, d, chars, k, coalesce(lag(k) over (partition by c order by d), 'root') as up from mem
  union all select c, 0, 0, 'root', null from ids),
node as (select d, k, min(up) as up, min(c) as c, count(*) as n, min(chars) as chars from with_root group by d, k),
leaf as (select d, k from node where not exists (select 1 from node x where x.d = node.d + 1 and x.up = node.k)),
anc as (select n.d, n.k, m.d as ad, m.k as ak, (n.n - 1) * n.chars as saved, cast(exists (select 1 from leaf where leaf.d = n.d and leaf.k = n.k) as bigint) as one
  from node n join with_root m on m.c = n.c and m.d <= n.d),
tot as (select ad as d, ak as k, sum(saved) as saved, sum(one) as leaves from anc group by all),
deepest as (select c, max(d) as d from with_root group by c),
fin as (select with_root.d, k, string_agg(c, ',' order by c) as ids from with_root join deepest using (c, d) group by all)
select node.c as conv_id, cast(node.d as bigint) as depth, p.c as parent_conv_id, cast(node.n as bigint) as n_convs,
  (select count(*) from node x where x.d = node.d + 1 and x.up = node.k) as n_children, cast(leaves as bigint) as n_leaves,
  cast(saved as bigint) as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from node join tot on tot.d = node.d and tot.k = node.k left join node p on p.d = node.d - 1 and p.k = node.up left join fin on fin.d = node.d and fin.k = node.k"""


def _escaped_length(column: str) -> str:
    return f"length(regexp_replace({column}, '{CONTROLS}', '\\1\\\\\\2\\3', 'g'))"


ORACLE["op11_chat_formatting"] = f"""with rows as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first, r, md5(x))) as turns_sha256,
  cast(coalesce(sum(length(x)) filter (r = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(x, '' order by turn nulls first, r, md5(x)) filter (r = 'assistant'), '')) as loss_sha256,
  cast(sum({len(TURN + TEXT + END)} + {_escaped_length('r')} + {_escaped_length('x')}) as bigint) as formatted_chars
from rows group by conv_id"""
