"""The same results in SQL, where SQL can express them."""

from __future__ import annotations

# Blocks and orders come from the first twelve hexadecimal digits of MD5; the exponent from
# bisection to 32 bits, rounded like the operator's.
OP1 = r"""
with recursive rows as (
  select doc_id, source, coalesce('s' || source, 'n') as key, coalesce(cast(doc_id as varchar), 'null') as ord,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as tokens
  from documents),
src as (select key, sum(tokens)::bigint as tokens from rows group by key),
shares as (select list(tokens / (select sum(tokens) from src)::double) as p from src where tokens > 0),
bis as (
  select 0 as i, 0.0::double as low, 1.0::double as high, p from shares
  union all
  select i + 1,
    case when flat then (low + high) / 2 else low end, case when flat then high else (low + high) / 2 end, p
  from (select *, list_min(p) ** ((low + high) / 2 - 1)
      / list_sum(list_transform(p, lambda x: x ** ((low + high) / 2))) > 1.5 + 1e-12 as flat from bis where i < 32)),
flattest as (select list_min(p) ** (-1) / len(p) > 1.5 + 1e-12 as needed from shares),
power as (select case when needed then round(high, 6) else 0.0 end as a from bis, flattest where i = 32),
raised as (select key, tokens, case when tokens > 0 then tokens::double ** a else 0.0 end as share from src, power),
mix as (
  select key, tokens, round(share / z, 9) as weight, round(share * (everything / z))::bigint as budget,
    greatest(1, ceil(tokens / 65536.0))::bigint as n_blocks
  from raised, (select sum(share) as z, sum(tokens)::double as everything from raised)),
dealt as (
  select r.*, m.tokens as source_tokens, weight, budget,
    ('0x' || substr(md5('block of ' || ord), 1, 12))::bigint % n_blocks as block
  from rows r join mix m using (key)),
inner_sums as (
  select *, coalesce(sum(tokens) over (partition by key, block order by md5(ord), ord, tokens
    rows between unbounded preceding and 1 preceding), 0) as inside from dealt),
sizes as (
  select key, block, sum(tokens) as size, any_value(source_tokens) as source_tokens, any_value(budget) as budget
  from dealt group by key, block),
passes as (
  select *, unnest(range(0, greatest(1, ceil(budget / greatest(source_tokens, 1)::double))::bigint)) as pass from sizes),
ranked as (
  select *, pass * source_tokens + coalesce(sum(size) over (partition by key, pass
    order by ('0x' || substr(md5('block/' || key || '/' || pass || '/' || block), 1, 12))::bigint, block
    rows between unbounded preceding and 1 preceding), 0) as before from passes)
select doc_id, source, tokens, weight, r.pass::int as pass, i.block, round((before + inside) / greatest(i.budget, 1), 9) as position
from inner_sums i join ranked r on i.key = r.key and i.block = r.block
where before < i.budget and before + inside < i.budget
"""

OP3 = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
d as (
  select *, strlen(html)::bigint as payload_bytes, min(page_id) over (partition by h) as first_id,
    array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(h, (k // 8 * 10 + 1)::int, 10))::bigint >> (35 - 5 * (k % 8))::int) & 31) + 1)::int, 1)), '') as payload_digest
  from p)
select page_id, payload_bytes, payload_digest,
  case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
  case when first_id is null or page_id = first_id then null else first_id end as refers_to
from d
"""

OP7 = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null),
pairs as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, p.b from reach r join pairs p on r.b = p.a),
named as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from pairs group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings join named on vec_id = named.a left join counts on vec_id = counts.a
"""

OP9 = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
s as (
  select rid, i, md5(array_to_string(w[i:i + 34], ' ')) as h
  from (select rid, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
again as (select h from s group by h having count(*) > 1),
gone as (select distinct rid, unnest(range(i, i + 35)) as p from s where h in (select h from again)),
words as (select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (
  select rid, count(*) as n, string_agg(word, ' ' order by p) as t
  from words anti join gone using (rid, p) group by rid)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (rid)
"""

OP10 = """
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
last as (select conv_id, max(turn) filter (role = 'assistant') as last from c group by conv_id),
ends as (
  select l.conv_id, l.last, max(c.text) filter (c.turn = l.last) as answer,
    coalesce(arg_max(c.text, c.turn) filter (c.turn < l.last), '') as echo
  from last l join c using (conv_id) group by l.conv_id, l.last),
e as (select *, last is null or answer = echo as same from ends),
prompts as (
  select conv_id, count(*)::int as n, string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' order by turn) as prompt
  from c join e using (conv_id) where last is null or turn < last or (same and turn = last) group by conv_id)
select conv_id, coalesce(n, 0)::int as prompt_turns, coalesce(prompt, '') as prompt,
  case when same then '' else '<|assistant|>' || chr(10) || answer || '<|end|>' || chr(10) end as chosen,
  case when same then '' else '<|assistant|>' || chr(10) || echo || '<|end|>' || chr(10) end as rejected,
  case when same then '' else '14:' || (22 + length(answer)) end as chosen_mask,
  case when same then '' else '14:' || (22 + length(echo)) end as rejected_mask
from e left join prompts using (conv_id)
"""

OP11 = """with vectors as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
      list_transform(embedding, lambda x: floor(256 * cast(x as double))) as parts
    from embeddings where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  scores as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as is_same,
      cast(list_inner_product(a.parts, b.parts) as bigint) as score
    from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
  positives as (select * from scores where is_same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
  select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as integer) as rank
  from positives p join scores n on n.anchor_id = p.anchor_id and not n.is_same
    and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
  qualify rank <= 5"""

OP12 = r"""with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
  lists as (select lang, row_number() over () as piece_id, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
  places as (select lang, piece_id, unnest(words) as w1, unnest(range(len(words))) as place from lists),
  runs as (select lang, w1, lead(w1) over p as w2, lead(w1, 2) over p as w3 from places
    window p as (partition by piece_id order by place)),
  phrases as (select lang, 1 as words, w1 as phrase from runs
    union all select lang, 2, w1 || ' ' || w2 from runs where w2 is not null
    union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from runs where w3 is not null),
  counts as (select lang, words, phrase, count(*) as f from phrases group by all),
  sizes as (select lang, cast(sum(f) as bigint) as n from counts where words = 1 group by 1),
  candidates as (select lang, words, phrase, f as a, string_split(phrase, ' ') as parts from counts where words > 1 and f >= 10),
  cuts as (select lang, phrase, a, k, array_to_string(parts[1:k], ' ') as head, array_to_string(parts[k + 1:], ' ') as rest
    from candidates, (values (1), (2)) t(k) where k < words),
  scored as (select c.lang, c.phrase, c.a, k, h.f as l, r.f as r,
      cast((1000000::hugeint * c.a * c.a) // (h.f::hugeint * r.f) as bigint) as score
    from cuts c join counts h on h.lang = c.lang and h.phrase = head join counts r on r.lang = c.lang and r.phrase = rest),
  worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
  held as (select lang, part, max(a) as longer from (
    select lang, a, unnest([array_to_string(parts[1:2], ' '), array_to_string(parts[2:3], ' ')]) as part
    from candidates where words = 3) group by all),
  kept as (select w.* from worst w left join held h on h.lang = w.lang and h.part = w.phrase
    where h.longer is null or 100 * h.longer < 50 * w.a)
  select k.lang, phrase, a, l, r, n, score, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank
  from kept k join sizes s on s.lang = k.lang qualify rank <= 2000"""

# Every given page marks its article, in which only headings and paragraphs are blocks.
OP13 = r"""with blocks as (
    select page_id, url, unnest(blocks) as block, unnest(range(len(blocks))) as place
    from (select page_id, url, string_split_regex(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>') as blocks from pages)),
  decoded as (select page_id, url, place, trim(regexp_replace(replace(regexp_replace(regexp_replace(replace(replace(
      regexp_replace(replace(block, '<br>', ' '), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&#39;|&#x27;|&apos;', chr(39), 'g'),
      '&nbsp;', ' '), '[\s\x{00a0}]+', ' ', 'g')) as block from blocks),
  written as (select page_id, url, place, regexp_replace(block, '&amp;?', '&', 'g') as block from decoded),
  joined as (select page_id, url, coalesce(string_agg(block, chr(10) order by place) filter (block <> ''), '') as text from written group by 1, 2)
  select page_id, url, text, cast(length(text) as bigint) as n_chars from joined"""

SQL = {
    "op1_mixing": OP1,
    "op3_warc": OP3,
    "op7_embeddings": OP7,
    "op9_spans": OP9,
    "op10_preferences": OP10,
    "op11_negatives": OP11,
    "op12_phrases": OP12,
    "op13_templates": OP13,
}
