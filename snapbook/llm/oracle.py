"""DuckDB SQL for the queries that SQL can express.

The others are compared with plain versions in the tests: SQL has no latent space, page parser, segmentations, tokenizer or learned
languages.
"""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"

# Limits of the repetition rules, as in the operator.
GRAM_LIMITS = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
LINE_LIMIT = 0.30


def _window(n: int) -> str:
    """The words of the window of n words that starts at a row, or null near the end."""
    frame = f"over (partition by doc_id order by i rows between current row and {n - 1} following)"
    return f"case when count(*) {frame} = {n} then string_agg(word, ' ') {frame} end"


def _windows(n: int) -> str:
    """Words inside a window of n words that the text has twice or more."""
    return f"""
    g{n} as (select doc_id, i, word, {_window(n)} as gram from places),
    t{n} as (select doc_id, i, word, gram is not null and count(*) over (partition by doc_id, gram) > 1 as twice from g{n}),
    c{n} as (
      select doc_id, length(word) as size, bool_or(twice) over (partition by doc_id order by i rows between {n - 1} preceding and current row) as inside
      from t{n}
    ),
    s{n} as (
      select doc_id, count(*) filter (where inside) as words, coalesce(sum(size) filter (where inside), 0) / sum(size)::double as share
      from c{n} group by doc_id
    )"""


OP2 = f"""
with split as (select doc_id, text, coalesce(regexp_extract_all(text, {WORDS}), []) as ws from documents),
places as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from split),
{",".join(_windows(n) for n in (3, *GRAM_LIMITS))},
lines as (
  select doc_id, line, row_number() over (partition by doc_id, line order by place) as n
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as place from documents)
  where regexp_matches(line, {WORDS})
),
repeats as (
  select doc_id, count(*) as n_dup_lines, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) as chars from lines where n > 1 group by doc_id
),
measures as (
  select doc_id, len(ws)::bigint as n_words,
    coalesce(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')), 0)::bigint as word_chars,
    coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(s3.words, 0)::bigint as n_repeat_words,
    case when word_chars = 0 then 0.0 else coalesce(chars, 0) / word_chars::double end as line_share,
    {", ".join(f"coalesce(s{n}.share, 0.0)::double as gram{n}_share" for n in GRAM_LIMITS)}
  from split left join repeats using (doc_id) left join s3 using (doc_id) {" ".join(f"left join s{n} using (doc_id)" for n in GRAM_LIMITS)}
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and line_share <= {LINE_LIMIT}
    and {" and ".join(f"gram{n}_share <= {limit}" for n, limit in GRAM_LIMITS.items())} as kept
from measures
"""

OP3 = f"""
with split as (select doc_id, coalesce(regexp_extract_all(text, {WORDS}), []) as ws from documents),
places as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as i from split),
windows as (select doc_id, i, word, {_window(50)} as gram from places),
found as (select doc_id, i, word, gram is not null and min(doc_id) over (partition by gram) < doc_id as earlier from windows),
words as (
  select doc_id, i, word, bool_or(earlier) over (partition by doc_id order by i rows between 49 preceding and current row) as gone from found
),
kept as (
  select doc_id, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as left_over from words group by doc_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(left_over, '')) as kept_sha256
from split left join kept using (doc_id)
"""

OP6 = """
with recursive polynomial as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, s: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab
),
sums as (
  select doc_id, strlen(coalesce(text, ''))::bigint + 8 as size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)::bigint as text_crc32
  from documents, polynomial
),
walk as (
  select distinct doc_id, n, (case when doc_id < 0 then doc_id::hugeint + 18446744073709551616::hugeint else coalesce(doc_id, 0)::hugeint end) as key, -1::bigint as shard, 0::bigint as jump
  from documents, (values (24), (25)) counts(n)
  union all
  select doc_id, n, mixed, jump, floor((jump + 1)::double * (2147483648.0::double / ((mixed // 8589934592)::double + 1.0::double)))::bigint
  from (select doc_id, n, jump, (key * 2862933555777941757::hugeint + 1) % 18446744073709551616::hugeint as mixed from walk where jump < n)
),
placed as (
  select s.doc_id, s.size, s.text_crc32, a.shard::int as shard, b.shard::int as grown_shard
  from sums s join walk a on a.doc_id is not distinct from s.doc_id and a.n = 24 and a.jump >= 24
    join walk b on b.doc_id is not distinct from s.doc_id and b.n = 25 and b.jump >= 25
)
select *, 'key' as law, row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot from placed
"""

OP9 = f"""
with bytes as (select doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as bs from documents),
places as (select doc_id, unnest(bs) as word, generate_subscripts(bs, 1) as i from bytes),
windows as (select doc_id, i, word, md5({_window(100).replace("' '", "''")}) as gram from places),
found as (
  select doc_id, i, word, gram is not null and row_number() over (partition by gram order by doc_id, i) > 1 as earlier from windows
),
marked as (
  select doc_id, i, word, bool_or(earlier) over (partition by doc_id order by i rows between 99 preceding and current row) as gone from found
),
edges as (select *, coalesce(lag(gone) over (partition by doc_id order by i), false) as before from marked),
kept as (
  select doc_id, count(*) filter (where gone) as n_removed, count(*) filter (where gone and not before) as n_spans,
    string_agg(word, '' order by i) filter (where not gone) as left_over
  from edges group by doc_id
)
select doc_id, len(bs)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(left_over, ''))) as kept_sha256
from bytes left join kept using (doc_id)
"""

OP10 = f"""
with recursive split as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}), []) as ws from documents
),
shingles as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as gram
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from split where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b using (gram) where a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common o join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * o.n >= 80 * (x.n + y.n - o.n)
),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
lowest as (select a, min(b) as low from reach group by a)
select s.doc_id, coalesce(n, 0)::bigint as n_shingles, least(s.doc_id, coalesce(low, s.doc_id)) as component_id
from split s left join sizes using (doc_id) left join lowest on a = s.doc_id
"""

OP11 = f"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::bigint as size, md5(concat_ws(':', 'mix', doc_id)) as mixed from documents
),
numbered as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as number from sized group by source
),
weighed as (select *, (number - 1) % 3 + 1 as weight, 3 * source_size as most from numbered),
totals as (
  select *, coalesce(sum(most) over (order by most / weight, number rows between unbounded preceding and 1 preceding), 0) as spent_before,
    sum(weight) over (order by most / weight, number rows between current row and unbounded following) as weight_from,
    sum(source_size) over () as budget
  from weighed
),
judged as (select *, most * weight_from <= (budget - spent_before) * weight as stops from totals),
targets as (
  select *, case when stops then most::double else ((budget - coalesce(sum(most) filter (where stops) over (), 0)) * weight)::double
    / (sum(weight) filter (where not stops) over ())::double end as target
  from judged
),
offers as (
  select doc_id, source, size, source_size, number, target, budget,
    sum(size) over (partition by number order by mixed, doc_id nulls first, size rows between unbounded preceding and current row)::bigint as upto
  from sized join targets using (source) where source is not null
  union all
  select doc_id, null, size, source_size, number, target, budget,
    sum(size) over (order by mixed, doc_id nulls first, size rows between unbounded preceding and current row)::bigint
  from sized, targets where sized.source is null and targets.source is null
),
rows as (select *, row_number() over () as line from offers),
copies as (
  select line, size, number, budget, upto + turn * source_size as handed, (upto + turn * source_size)::double / target as finish
  from rows, (values (0), (1), (2)) turns(turn) where size > 0 and target > 0
),
placed as (select *, sum(size) over (order by finish, number, handed rows between unbounded preceding and current row) as position from copies),
taken as (select line, count(*) as times from placed where 2 * position - size <= 2 * budget group by line)
select doc_id, source, size, source_size, target, size * coalesce(times, 0) as taken from rows left join taken using (line)
"""

OP12 = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q, row_number() over () as line
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.line as anchor, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, b.line as line,
    coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::bigint as score
  from rows a join rows b on a.vec_id % 100 = 0
),
positives as (
  select anchor, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by anchor order by score desc, vec_id) as place
  from scored where same and vec_id <> anchor_id qualify place <= 5
)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor, place order by score desc, vec_id)::int as rank, vec_id as negative_id,
  positive_score, score as negative_score
from positives p join scored s on s.anchor = p.anchor and not same and 100 * score between 80 * positive_score and 100 * positive_score
qualify rank <= 5
"""

OP13 = f"""
with recursive polynomial as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, s: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as tab
),
turns as (
  select conv_id, turn, coalesce(role, '') as role, md5(md5(coalesce(role, '')) || coalesce(text, '')) as digest,
    coalesce(len(regexp_extract_all(text, {WORDS})), 0)::bigint as words
  from conversations where conv_id is not null
),
own as (select conv_id, list({{'digest': digest, 'words': words}} order by turn nulls first, role, digest) as said from turns group by conv_id),
heads as (
  select conv_id, said,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 4 as h
  from own, polynomial
),
rebuilt as (
  select c.conv_id, list_concat(case when b.conv_id is null then [] else b.said[1:c.h] end, c.said[c.h + 1:]) as said
  from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
),
steps as (select conv_id, said, unnest(range(0, len(said) + 1)) as depth from rebuilt),
members as (
  select conv_id, depth, md5(array_to_string(list_transform(said[1:depth], lambda t: t.digest), '')) as node,
    case when depth > 0 then md5(array_to_string(list_transform(said[1:depth - 1], lambda t: t.digest), '')) end as parent,
    case when depth > 0 then said[depth].words else 0 end as words, depth = len(said) as ends
  from steps
),
nodes as (
  select depth, node, any_value(parent) as parent, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by depth, node
),
children as (select depth - 1 as depth, parent as node, count(*) as n_children from nodes where depth > 0 group by 1, 2),
subtrees as (
  select m.depth, m.node, count(*) filter (where n_children is null) as n_leaves, sum((n_convs - 1) * n.words)::bigint as saved_tokens
  from nodes n left join children using (depth, node) join members m on m.conv_id = n.conv_id and m.depth <= n.depth
  group by 1, 2
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, n.ends_sha256
from nodes n left join children using (depth, node) join subtrees using (depth, node) left join nodes p on p.depth = n.depth - 1 and p.node = n.parent
"""

ORACLE: dict[str, str] = {"op2_quality": OP2, "op3_substrings": OP3, "op6_sharding": OP6, "op9_suffixes": OP9, "op10_jaccard": OP10, "op11_mixing": OP11, "op12_negatives": OP12, "op13_prefixes": OP13}
