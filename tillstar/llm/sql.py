"""Independent SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tillstar.llm import licenses, mixing, prefix_trie, quality_rules

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
with recursive words as (
  select doc_id, {_WORDS.format(text=_LOWER)} as w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [w] else
    list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) end) as s from words
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all
), links as (
  select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 85 * (p.n + q.n - c)
), edges as (
  select a, b from links union select b, a from links
), reach as (
  select doc_id as node, doc_id as seen from words
  union
  select e.b, r.seen from reach r join edges e on e.a = r.node where r.seen < e.b
)
select w.doc_id, coalesce(s.n, 0)::bigint as n_shingles, least(w.doc_id, min(r.seen)) as component_id, least(w.doc_id, min(r.seen)) = w.doc_id as kept
from words w left join sizes s on s.doc_id = w.doc_id left join reach r on r.node = w.doc_id group by w.doc_id, s.n
"""

MIXING = rf"""
with sized as (
  select doc_id, source, coalesce(len({_WORDS.format(text='text')}), 0)::bigint as size,
    md5('{mixing.SEED}:' || coalesce(doc_id::varchar, '')) as hash
  from documents
), sources as (
  select source, source_size, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1]::bigint as weight
  from (select source, sum(size)::bigint as source_size from sized group by source)
), ordered as (
  select *, row_number() over (order by 2.0 * source_size / weight, source nulls last) as place from sources
), prefixes as (
  select k.place as clamped,
    (select sum(source_size) from ordered) * 150 - coalesce((select sum(source_size) from ordered o where o.place <= k.place), 0) * 200 as space,
    coalesce((select sum(weight) from ordered o where o.place > k.place), 0) as weights,
    coalesce((select min(2.0 * source_size / weight) from ordered o where o.place > k.place), 'infinity'::double) as next
  from (select unnest(range(0, (select count(*) + 1 from ordered))) as place) k
), chosen as (
  select * from prefixes where weights = 0 or next > space::double / (100.0 * weights) order by clamped limit 1
), goals as (
  select source, source_size, case when place <= clamped then (2 * source_size)::double
    else weight * space::double / (100.0::double * greatest(1, weights)::double) end as target
  from ordered, chosen
), parts as (
  select s.*, source_size, target, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
    sum(size) over (partition by s.source order by hash) as reached, sum(size) over (partition by s.source, hash) as together
  from sized s join goals g on s.source is not distinct from g.source
)
select doc_id, size, source_size, target,
  (size * (whole::bigint + case when reached - together / 2.0::double <= target - whole * source_size then 1 else 0 end))::bigint as taken
from parts
"""


NEAREST = """
with v as (
  select vec_id, min(list_transform(embedding, lambda x: x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0 group by vec_id
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from scored qualify rank <= 20
"""


def _quality_rules() -> str:
    grid = ", ".join(f"('{n}', {p}, {c})" for n, cuts in quality_rules.CUTOFFS.items() for p, c in enumerate(cuts))
    rates = {
        "symbols": ("n_symbols", "word_chars"), "shouting": ("n_shouts", "word_chars"), "long_words": ("word_chars", "n_words"),
        "dup_lines": ("n_dup_lines", "n_words"), "repeats": ("n_repeat_words", "n_words"),
    }
    each = " union all ".join(
        f"select row, doc_id, lang, base_failed, '{n}' as rule, case when {b} > 0 then ({a} * 1000) // {b} else 0 end as rate from figures"
        for n, (a, b) in rates.items()
    )
    share = quality_rules.ALPHA / len(rates)
    return rf"""
with docs as (
  select row_number() over () as row, doc_id, lang, coalesce(text, '') as text, {_WORDS.format(text="coalesce(text, '')")} as w from documents
), windows as (
  select row, i, count(*) over (partition by row, s) as times from (
    select row, w[i:i + 2] as s, i from (select row, w, unnest(range(1, len(w) - 1)) as i from docs)
  )
), covered as (
  select row, count(distinct p) as n from (select row, unnest([i, i + 1, i + 2]) as p from windows where times > 1) group by row
), lines as (
  select row, count(*) - count(distinct line) as n from (select row, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by row
), counted as (
  select d.row, doc_id, lang, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, coalesce(l.n, 0)::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, length(regexp_replace(text, '[^A-Z!]+', '', 'g'))::bigint as n_shouts
  from docs d left join covered c on c.row = d.row left join lines l on l.row = d.row
), figures as (
  select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words as base_failed from counted
), rates as ({each}), truth as (
  select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id
), grid(rule, place, cutoff) as (values {grid}), tested as (
  select lang, r.rule, place, cutoff, count(*) filter (quality = 1) as n, count(*) filter (quality = 1 and rate > cutoff) as k,
    count(*) filter (quality = 0 and rate > cutoff) as bad
  from rates r join truth using (doc_id) join grid g on g.rule = r.rule where not base_failed group by all
), bounds as (
  select *, k < n * {share}::double and list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}::double) + (n - i) * ln(1 - {share}::double))))
    <= {quality_rules.DELTA} / ((select count(distinct coalesce(lang, chr(1))) from tested) * {len(rates)}) as passed
  from tested
), certified as (
  select *, bad - {quality_rules.COST_OF_GOOD} * k as gain, bool_and(passed) over (partition by lang, rule order by place) as valid from bounds
), chosen as (
  select lang, rule, cutoff from certified where valid and gain > 0 qualify row_number() over (partition by lang, rule order by gain desc, place) = 1
), rejected as (
  select distinct row from rates r join chosen c on r.lang is not distinct from c.lang and r.rule = c.rule and rate > cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and row not in (select row from rejected) as kept
from figures
"""


def _licenses() -> str:
    listed = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(licenses.NOTICES))
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    pairs = "case when len(w) < 2 then [] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end"
    percent = licenses.PERCENT
    return rf"""
with notices(notice, license, text) as (values {listed}), known as (
  select notice, license, {pairs} as p, len(w) - 1 as m from (select *, {words.format("text")} as w from notices)
), listed as (
  select notice, m, len(list_distinct(p)) as b, unnest(list_distinct(p)) as pair from known
), docs as (
  select row_number() over () as row, doc_id, {words.format("coalesce(text, '')")} as w from documents
), placed as (
  select row, generate_subscripts(p, 1) - 1 as position, unnest(p) as pair from (select row, {pairs} as p from docs)
), near as (
  select row, notice from placed join listed using (pair) group by row, notice, b having count(distinct pair) * (200 - {percent}) >= {percent} * b
), hits as (
  select row, notice, m, b, position, pair from placed join listed using (pair) join near using (row, notice)
), windows as (
  select row, notice, m, b, s.position as start, count(distinct h.pair) as c, count(*) as n
  from hits s join hits h using (row, notice, m, b) where h.position >= s.position and h.position < s.position + m group by all
), matches as (
  select *, 2.0::double * c / (c + m - n + b) as dice from windows where 200 * c >= {percent} * (c + m - n + b)
), ranked as (
  select row_number() over (partition by row order by c desc, dice desc, notice) as place, * from (
    select * from matches qualify row_number() over (partition by row, notice order by dice desc, c desc, start) = 1
  ) join (select notice, license from known) using (notice)
), kept as (
  select * from ranked r where not exists (
    select 1 from ranked o where o.row = r.row and o.place < r.place and o.start < r.start + r.m and r.start < o.start + o.m
  )
), told as (
  select row, count(*) as n_notices, string_agg(distinct license, ',' order by license) as licenses from kept group by row
)
select d.doc_id, f.license, f.dice, f.start::bigint as first_word, coalesce(t.n_notices, 0)::bigint as n_notices, coalesce(t.licenses, '') as licenses
from docs d left join ranked f on f.row = d.row and f.place = 1 left join told t on t.row = d.row
"""

_SAID = r"\### Assistant: </turn> ok"
_ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', '')) + (length({0}) - length(replace({0}, '</turn>', ''))) // 7 + (length({0}) - length(replace({0}, '### ', ''))) // 4"

#: Each turn is written as "### role: text</turn>" and a line feed, with a backslash more for each control string inside.
CHAT_FORMATTING = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{_SAID}'), (-7, 1, 'assistant', '{_SAID}')
), told as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
    sum(4 + {_ESCAPED.format("role")} + (length(role) - length(replace(role, ': ', ''))) // 2 + 2 + {_ESCAPED.format("text")} + 8) as formatted_chars
  from rows group by conv_id
)
select conv_id, 1::integer as place, n_turns::bigint as n_turns, sha256(said) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
  formatted_chars::bigint as formatted_chars
from told
"""

#: crc32 bit by bit: its polynomial is a fixed value.
PREFIX_TRIE = rf"""
with recursive own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), ids as (
  select conv_id, conv_id - conv_id % {prefix_trie.GROUP} as base, conv_id::varchar as name, max(pos) as own from own group by conv_id
), bits as (
  select conv_id, name, 0 as step, 4294967295::bigint as crc from ids
  union all
  select conv_id, name, step + 1, case when fed % 2 = 1 then xor(fed >> 1, 3988292384) else fed >> 1 end from (
    select *, case when step % 8 = 0 then xor(crc, ascii(substring(name, step // 8 + 1, 1))::bigint) else crc end as fed from bits
  ) where step < 8 * length(name)
), plan as (
  select i.conv_id, i.base, i.own, xor(b.crc, 4294967295) % {prefix_trie.HEADS} as h
  from ids i join bits b on b.conv_id = i.conv_id and b.step = 8 * length(i.name)
), placed as (
  select p.conv_id, o.pos as place, o.role, o.text from plan p join own o on o.conv_id = p.base and o.pos <= p.h
  union all
  select p.conv_id, {prefix_trie.HEADS} + o.pos, o.role, o.text from plan p join own o on o.conv_id = p.conv_id and o.pos > p.h
), rebuilt as (
  select p.conv_id, coalesce(list(struct_pack(role := role, text := text) order by place) filter (place is not null), []) as turns
  from plan p left join placed using (conv_id) group by p.conv_id
), members as (
  select conv_id, turns, d, turns[1:d] as prefix from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from rebuilt)
), nodes as (
  select prefix, d, min(conv_id) as conv_id, count(*) as n_convs, case when d = 0 then 0 else octet_length(encode(prefix[d].text)) end as size,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (d = len(turns)) as ends
  from members group by prefix, d
), parents as (
  select c.*, p.conv_id as parent_conv_id from nodes c left join nodes p on p.d = c.d - 1 and p.prefix = c.prefix[1:c.d - 1]
), children as (
  select parent_conv_id as conv_id, d - 1 as d, count(*) as n from parents where d > 0 group by all
), counted as (
  select p.*, coalesce(c.n, 0) as n_children from parents p left join children c on c.conv_id = p.conv_id and c.d = p.d
), below as (
  select prefix[1:up] as prefix, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum((n_convs - 1) * size) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as up from counted) group by 1
)
select c.conv_id, c.d as depth, c.parent_conv_id, c.n_convs, c.n_children, b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens,
  sha256(coalesce(c.ends, '')) as ends_sha256
from counted c join below b on b.prefix = c.prefix
"""

EMBEDDING_NEAR_DEDUP = """
with recursive v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: x::double) as e,
    coalesce(vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0, false) as fit
  from embeddings
), links as (
  select x.r, y.r as other, x.vec_id as a, y.vec_id as b from v x join v y on x.r <> y.r and x.fit and y.fit and len(x.e) = len(y.e)
  where list_cosine_similarity(x.e, y.e) >= 0.95
), edges as (
  select distinct a, b from links
), reach as (
  select distinct vec_id as node, vec_id as seen from v
  union
  select e.b, r.seen from reach r join edges e on e.a = r.node where r.seen < e.b
), labels as (
  select node, min(seen) as component_id from reach where node is not null group by node
)
select v.vec_id, (select count(*) from links l where l.r = v.r)::bigint as n_links, component_id, coalesce(v.vec_id = component_id, true) as kept
from v left join labels on labels.node = v.vec_id
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = f"""
with docs as (
  select r, doc_id, unnest(w) as term, len(w)::bigint as n from (select row_number() over () as r, doc_id, {_TERMS} as w from documents)
), postings as (
  select r, doc_id, n, term, count(*)::bigint as tf from docs group by all
), sizes as (
  select count(*)::bigint as nn, sum(n)::bigint as l from (select distinct r, n from docs)
), items as (
  select item_id, term, count(*)::bigint as times from (
    select item_id, unnest({_TERMS}) as term from (select item_id, min(text) as text from benchmark group by item_id)
  ) group by all
), weights as (
  select term, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)))::bigint as w from postings, sizes group by term, nn
), scored as (
  select item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::bigint as score
  from items join weights using (term) join postings using (term), sizes group by item_id, r, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::integer as rank, doc_id, score
from scored where score > 0 qualify rank <= 20
"""


def statements() -> dict[str, str]:
    return {
        "op1_chat_formatting": CHAT_FORMATTING,
        "op3_minhash_near_dedup": NEAR_DEDUP,
        "op4_source_mixing": MIXING,
        "op8_license_scan": _licenses(),
        "op9_nearest_neighbours": NEAREST,
        "op10_quality_rules": _quality_rules(),
        "op11_prefix_trie": PREFIX_TRIE,
        "op12_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
        "op13_ranked_search": RANKED_SEARCH,
    }
