"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from lakerec.llm import mixing, quality

WORD = r"[^\x20\x09-\x0D]+"

def _jaccard(width: int, columns: str) -> str:
    return rf"""
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                    'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
        from documents),
    shingles as (
        select distinct doc_id, array_to_string(w[i : i + {width - 1}], ' ') as s
        from (select doc_id, w, unnest(range(1, greatest(len(w) - {width - 1}, least(len(w), 1)) + 1)) as i from words)),
    sizes as (select doc_id, count(s) as n from words left join shingles using (doc_id) group by 1),
    shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as o
        from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
    links as (
        select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * o >= 80 * (x.n + y.n - o)),
    reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
    select doc_id, n as n_shingles, least(doc_id, coalesce(min(b), doc_id)) as component_id{columns}
    from sizes left join reach on a = doc_id group by doc_id, n"""


OP2 = _jaccard(5, "")
OP11 = _jaccard(4, ", doc_id <= coalesce(min(b), doc_id) as kept")


def _op3() -> str:
    values = ", ".join(
        f"('{m}', case when {per} > 0 then ({scale} * {count}) // {per} else 0 end, {least})"
        for m, (count, per, scale, least) in quality.MEASURES.items()
    )
    outside = " or ".join(
        [f"(measure = '{m}' and v > high)" for m in quality.MEASURES]
        + [f"(measure = '{m}' and v < low)" for m in quality.LOWER_FENCED]
    )
    return rf"""
    with words as (
        select doc_id, lang, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w
        from documents),
    windows as (
        select doc_id, i, array_to_string(w[i : i + 7], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from words)),
    often as (select doc_id, i from (select *, count(*) over (partition by doc_id, s) as n from windows) where n > 1),
    repeats as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 8)) as p from often) group by 1),
    lines as (
        select doc_id, count(*) as n, count(*) - count(distinct line) as dup
        from (select doc_id, unnest(string_split(t, chr(10))) as line from words)
        where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
    counted as (
        select doc_id, lang, source, len(w) as n_words, length(array_to_string(w, ''))::bigint as word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
               coalesce(l.dup, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words, coalesce(l.n, 0) as n_lines,
               length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper,
               length(t) - length(regexp_replace(t, '[!-/:-@\[-`{{-~]', '', 'g')) as n_marks
        from words left join lines l using (doc_id) left join repeats r using (doc_id)),
    judged as (
        select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed
        from counted),
    measured as (
        select doc_id, lang, source, base_failed, measure, v, least_spread
        from judged, lateral (values {values}) as m(measure, v, least_spread)),
    bins as (
        select *, v - v % (1::bigint << greatest(length(bin(v::bigint)) - 6, 0)) as bin from measured where not base_failed),
    levels as (
        select level, case when level >= 1 then lang end as lang, case when level >= 2 then source end as source,
               measure, bin, least_spread, count(*) as n
        from bins, (values (0), (1), (2)) as l(level) group by all),
    running as (
        select *, sum(n) over (partition by level, lang, source, measure order by bin) as upto,
               sum(n) over (partition by level, lang, source, measure) as total
        from levels),
    quartiles as (
        select level, lang, source, measure, any_value(least_spread) as least_spread, max(total) as total,
               min(bin) filter (4 * upto >= total) as q1, min(bin) filter (4 * upto >= 3 * total) as q3
        from running group by 1, 2, 3, 4),
    fences as (
        select *, q3 + 3 * greatest(q3 - q1, q3 // 8, least_spread) as high, q1 - 3 * greatest(q3 - q1, q3 // 8, least_spread) as low
        from quartiles where level = 0 or total >= 30),
    held as (
        select m.doc_id, m.measure, m.v, f.high, f.low,
               row_number() over (partition by m.doc_id, m.measure order by f.level desc) as k
        from measured m join fences f on f.measure = m.measure and (
            f.level = 0 or (f.lang is not distinct from m.lang and (f.level = 1 or f.source is not distinct from m.source)))),
    outside as (select distinct doc_id from held where k = 1 and ({outside}))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and o.doc_id is null as kept
    from judged left join outside o using (doc_id)"""


OP4 = rf"""
    with sized as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
               md5(coalesce(cast(doc_id as varchar), 'null') || ':' || coalesce(text, '')) as ticket
        from documents),
    rows as (
        select *, length(bin(size::bigint)) as appeal,
               (('0x' || substr(ticket, 1, 13))::bigint + 0.5) / 4503599627370496.0 as draw
        from sized),
    classes as (select source, appeal, sum(size)::double as words from rows group by 1, 2),
    sources as (
        select source, sum(words) as source_size,
               [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
        from classes group by 1),
    filling as (
        select *, 2 * source_size as room,
               {mixing.SHARE} * sum(source_size) over ()
               - coalesce(sum(2 * source_size) over (order by 2 * source_size / weight, source nulls last
                                                     rows between unbounded preceding and 1 preceding), 0) as lefts,
               sum(weight) over (order by 2 * source_size / weight, source nulls last
                                 rows between current row and unbounded following) as sharing,
               row_number() over (order by 2 * source_size / weight, source nulls last) as k
        from sources),
    level as (select lefts, sharing from filling where lefts * weight <= room * sharing order by k limit 1),
    targets as (
        select source, source_size, least(room, coalesce(l.lefts * weight / l.sharing, room)) as target
        from filling left join level l on true),
    spread as (
        select c.source, appeal, words, target,
               target - 2 * coalesce(sum(words) over (partition by c.source order by appeal desc
                                                      rows between unbounded preceding and 1 preceding), 0) as lefts,
               sum(words * appeal) over (partition by c.source order by appeal desc
                                         rows between current row and unbounded following) as sharing
        from classes c join targets t on c.source is not distinct from t.source),
    levels as (
        select source, arg_max(lefts, appeal) as lefts, arg_max(sharing, appeal) as sharing
        from spread where lefts * appeal <= 2 * sharing group by 1),
    expected as (
        select s.source, appeal, words, target,
               least(2.0, coalesce(case when l.sharing = 0 then 0.0 else greatest(0.0, l.lefts * appeal / l.sharing) end, 2.0)) as e
        from spread s left join levels l on s.source is not distinct from l.source),
    wanted as (select source, any_value(target) - sum(floor(e) * words) as wanted from expected group by 1),
    ranked as (
        select r.*, floor(e) as whole, target,
               case when e > floor(e) and size > 0
                    then draw * (1 - (e - floor(e))) / ((1 - draw) * (e - floor(e))) end as ratio
        from rows r join expected x on r.source is not distinct from x.source and r.appeal = x.appeal),
    ordered as (
        select *, sum(size) over (partition by source, ratio is null order by ratio, ticket rows between unbounded preceding and 1 preceding) as ahead
        from ranked)
    select doc_id, size, source_size::bigint as source_size, t.target,
           (whole::bigint + case when ratio is not null and wanted > 0 and coalesce(ahead, 0) + size / 2 <= wanted then 1 else 0 end)
               * size as taken
    from ordered o join targets t on o.source is not distinct from t.source
         join wanted w on o.source is not distinct from w.source"""

OP10 = r"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all
        select -1, t, case when t = 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) r(t)),
    written as (
        select *, regexp_replace(text, '<(\\*)\|im_(start|end)\|>', '<\\\1|im_\2|>', 'g') as escaped from turns)
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
           coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
           sum(length(role) + length(escaped) + 24)::bigint as formatted_chars
    from written group by conv_id"""

OP13 = """
    with vectors as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
               [floor(256 * x::double) for x in embedding] as units
        from embeddings
        where label is not null and embedding is not null
              and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
    scores as (
        select a.vec_id as anchor_id, a.label <> b.label as other, b.vec_id, list_inner_product(a.units, b.units)::bigint as score
        from vectors a join vectors b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
    positives as (
        select anchor_id, vec_id as positive_id, score as positive_score from scores where not other
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
           vec_id as negative_id, positive_score, score as negative_score
    from positives join scores using (anchor_id)
    where other and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
    qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10"""

ORACLES = {
    "op2_ngram_jaccard_join": OP2,
    "op3_quality_rules": _op3(),
    "op4_mixing_sources": OP4,
    "op10_chat_formatting": OP10,
    "op11_chosen_path_dedup": OP11,
    "op13_hard_negatives": OP13,
}
