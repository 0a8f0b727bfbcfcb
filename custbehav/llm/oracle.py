"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"
_MENU = r"(?i)^(home|menu|login|log in|sign in|sign up|register|search|next|previous|back|top|contact|about|sitemap|share|print)$"
_NOTICE = (
    r"(?i)(all rights reserved|accept (all )?cookies|uses cookies|cookie policy|privacy policy|terms of (use|service)"
    r"|enable javascript|subscribe to our|sign up for our|click here to|lorem ipsum)"
)

QUALITY = rf"""
with texts as (
    select doc_id, coalesce(text, '') as text, row_number() over () as rn from documents
), parts as (
    select *, list_filter(regexp_split_to_array(text, '{_SPACE}+'), lambda w: w <> '') as ws, string_split(text, chr(10)) as lines
    from texts
), windows as (
    select rn, p, hash(ws[p:p + 4]) as h, array_to_string(ws[p:p + 4], ' ') as w
    from (select rn, ws, unnest(range(1, len(ws) - 3)) as p from parts)
), repeated as (
    select rn, p from (select rn, p, count(*) over (partition by rn, w) as n from windows) where n > 1
), cover as (
    select rn, sum(least(5, gap)) as n_repeat_words
    from (select rn, coalesce(p - lag(p) over (partition by rn order by p), 5) as gap from repeated) group by rn
), lines as (
    select rn, line, i, regexp_replace(line, '{_SPACE}', '', 'g') as bare
    from (select rn, unnest(lines) as line, generate_subscripts(lines, 1) as i from parts)
), ruled as (
    select *, length(bare) as size,
        length(bare) - length(regexp_replace(bare, '[#*$%&|<>]', '', 'g')) as symbols,
        length(bare) - length(regexp_replace(bare, '[!?]{{2,}}', '', 'g')) as shouts,
        length(bare) - length(regexp_replace(bare, '[A-Z]', '', 'g')) as capitals,
        length(bare) - length(regexp_replace(bare, '[a-z]', '', 'g')) as small,
        length(bare) - length(regexp_replace(bare, '[|»›•·]', '', 'g')) as dividers,
        regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', '') as plain
    from lines
), verdicts as (
    select rn, size, bare, size = 0 or not (
        symbols > size * 0.1::double or shouts > size * 0.1::double or (size >= 40 and capitals > small * 4)
        or (dividers >= 3 and dividers * 12 >= size) or regexp_matches(plain, '{_MENU}')
        or (length(plain) <= 200 and regexp_matches(plain, '{_NOTICE}'))) as ok
    from ruled
), lost as (
    select rn, sum(case when ok then 0 else size end) as lost from verdicts group by rn
), duplicates as (
    select rn, count(*) filter (where bare <> '') - count(distinct line) filter (where bare <> '') as n_dup_lines
    from lines group by rn
), counted as (
    select doc_id, len(ws)::bigint as n_words, length(regexp_replace(text, '{_SPACE}', '', 'g'))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        n_dup_lines::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, lost
    from parts left join cover using (rn) left join lost using (rn) left join duplicates using (rn)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and lost <= word_chars * 0.3::double as kept
from counted
"""

RESAMPLING = r"""
with table_steps as (
    select n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as step
    from (select unnest(range(256))::bigint as n)
), crc_table as (
    select list(step order by n) as steps from table_steps
), texts as (
    select row_number() over () as rn, false as target, doc_id, text from documents
    union all
    select row_number() over () as rn, true as target, null as doc_id, text from benchmark
), parts as (
    select rn, target, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws
    from texts
), features as (
    select rn, target, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as feature
    from parts
), distinct_features as (
    select distinct feature from features
), buckets as (
    select feature, xor(list_reduce(
        list_concat([4294967295::bigint],
            list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda h: ('0x' || h)::bigint)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
    from distinct_features, crc_table
), totals as (
    select bucket, count(*) filter (where not target) as s, count(*) filter (where target) as t
    from features join buckets using (feature) group by bucket
), sums as (
    select coalesce(sum(s), 0)::double as ss, coalesce(sum(t), 0)::double as tt from totals
), gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (ss + 10000) / ((s + 1)::double * (tt + 10000))))::bigint as gain
    from totals, sums
), weighed as (
    select rn, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
    from features join buckets using (feature) join gains using (bucket) where not target group by rn
), scored as (
    select rn, doc_id, len(ws) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
    from parts left join weighed using (rn) where not target
), keyed as (
    select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored
), drawn as (
    select rn, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () as n
    from keyed where n_words >= 20
)
select doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank
from keyed left join drawn using (rn)
"""

NEGATIVES = r"""
with usable as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, list_inner_product(a.v, b.v)::bigint as score
    from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
    select * from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), found as (
    select p.anchor_id, p.id as positive_id, p.score as positive_score, n.id as negative_id, n.score as negative_score,
        row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as rank
    from positives p join scored n
        on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from found where rank <= 5
"""


def statements() -> dict[str, str]:
    return {"op8_quality": QUALITY, "op11_hard_negatives": NEGATIVES, "op13_resampling": RESAMPLING}
