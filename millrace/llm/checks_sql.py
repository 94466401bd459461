"""DuckDB SQL for the rows of the queries on lines, periodic runs and hard negatives."""

LINES_SQL = """
with lines as (
    select doc_id, i, string_split(coalesce(text, ''), chr(10))[i] as line
    from documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as t(i)
), keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), common as (
    select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10
), marked as (
    select keyed.*, common.key is not null as gone from keyed left join common using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

# crc32 bit by bit over the digits of doc_id; pairs of equal words make stretches of one period; a stretch is
# a run unless a smaller period covers it.
RUNS_SQL = """
with hashed as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') as words,
        xor(4294967295, list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda d: ascii(d)::bigint)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) as h
    from documents
), placed as (
    select doc_id, words, h, len(words) as n, case when len(words) > 0 then (h // 10) % len(words) end as a from hashed
), planted as (
    select doc_id, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i:
        words[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) end]) else words end as words
    from placed
), word as (
    select doc_id, unnest(range(len(words))) as i, unnest(words) as w from planted
), pairs as (
    select l.doc_id, l.i, r.i - l.i as q from word l join word r on l.doc_id = r.doc_id and l.w = r.w and r.i > l.i
), stretches as (
    select doc_id, q, min(i) as s, count(*) + q as m
    from (select *, i - row_number() over (partition by doc_id, q order by i) as island from pairs)
    group by doc_id, q, island having count(*) + q >= greatest(12, 2 * q)
), runs as (
    select * from stretches r where not exists (
        select 1 from stretches o where o.doc_id = r.doc_id and o.q < r.q and o.s <= r.s and o.s + o.m >= r.s + r.m)
), gone as (
    select distinct doc_id, unnest(range(s + q, s + m)) as i from runs
), collapsed as (
    select doc_id, string_agg(w, ' ' order by i) as t from word anti join gone using (doc_id, i) group by doc_id
), listed as (
    select doc_id, count(*) as n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' order by s, q) as t,
        list([m, -s, -q] order by m desc, s, q)[1] as best
    from runs group by doc_id
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, (-best[2])::bigint as start, best[1]::bigint as length, (-best[3])::bigint as period,
    (1000 * best[1] // -best[3])::bigint as exponent_milli, sha256(coalesce(listed.t, '')) as runs_sha256, sha256(coalesce(collapsed.t, '')) as collapsed_sha256
from documents left join listed using (doc_id) left join collapsed using (doc_id)
"""

NEGATIVES_SQL = """
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.q, r.q)::bigint as score
    from usable a join usable r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
    select p.*, n.vec_id as negative_id, n.score as negative_score,
        row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) as rank
    from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
        and 100 * n.score between 30 * p.positive_score and 90 * p.positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""
