"""Sentiment of whole texts with context rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import context as c
from millrace.functions.text import DEFAULT_LEXICON, lexicon_frame
from millrace.plans.registry import query
from millrace.session import spread, table

POSITIVE_SEEDS, NEGATIVE_SEEDS = ("best",), ("no",)


def _listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_BOOSTS = " + ".join(
    f"case when w{k} in {_listed(c.BOOSTERS)} then sign(v0) * {c.BOOST * decay}"
    f" when w{k} in {_listed(c.DAMPENERS)} then sign(v0) * {-c.BOOST * decay} else 0.0 end"
    for k, decay in zip((1, 2, 3), c.BOOST_DECAY))
_TURNED = " or ".join(f"coalesce(w{k} in {_listed(c.NEGATIONS)} or w{k} like '%n''t', false)" for k in (1, 2, 3))

CONTEXT_SQL = """(
    with sentences as (
        select {keys}, len(whole) - len(replace(whole, '!', '')) as exclaimed, len(whole) - len(replace(whole, '?', '')) as asked,
               unnest(case when len(parts) = 0 then [''] else parts end) as sentence
        from (select *, regexp_extract_all(whole, '[^.!?\\n]+') as parts from (select {keys}, coalesce(text, '') as whole from {table}))),
    numbered as (
        select row_number() over () as sid, *, regexp_extract_all(sentence, '""" + c.WORD.replace("'", "''") + """') as words from sentences),
    words as (
        select {keys}, sid, exclaimed, asked, unnest(generate_series(1, greatest(len(words), 1))) as i, words from numbered),
    placed as (
        select {keys}, sid, exclaimed, asked, i, words[i] as said, case when i > 1 then lower(words[i - 1]) end as w1,
               case when i > 2 then lower(words[i - 2]) end as w2, case when i > 3 then lower(words[i - 3]) end as w3
        from words),
    told as (
        select *, bool_or(len(said) > 1 and said = upper(said)) over s and bool_or(said <> upper(said)) over s as mixed,
               min(case when lower(said) = 'but' then i end) over s as but
        from placed window s as (partition by sid)),
    known as (
        select told.*, coalesce(valence, 0.0)::double as v0
        from told left join (values """ + ", ".join(f"('{w}', {v}::double)" for w, v in DEFAULT_LEXICON) + f""") l(word, valence) on lower(said) = word),
    valued as (
        select *, (v0 + case when mixed and len(said) > 1 and said = upper(said) then sign(v0) * {c.CAPITALS} else 0.0 end + {_BOOSTS})
                  * case when {_TURNED} then {c.NEGATED} else 1.0 end
                  * case when but is null or but = i then 1.0 when i < but then {c.BEFORE_BUT} else {c.AFTER_BUT} end as v
        from known),
    sums as (
        select {{keys}}, sum(v) as s0, sum(case when v > 0 then v + 1 else 0.0 end) as p0, sum(case when v < 0 then 1 - v else 0.0 end) as n0,
               sum(case when said is not null and v = 0 then 1.0 else 0.0 end)::double as u,
               least(max(exclaimed), {c.MOST_EXCLAMATIONS}) * {c.EXCLAMATION} + case when max(asked) < 2 then 0.0
                   when max(asked) <= {c.MOST_QUESTIONS} then max(asked) * {c.QUESTION} else {c.MANY_QUESTIONS} end as e
        from valued group by {{keys}}),
    marked as (
        select {{keys}}, s0 + sign(s0) * e as s, u, p0 + case when p0 > n0 then e else 0.0 end as p, n0 + case when n0 > p0 then e else 0.0 end as n
        from sums)
    select {{keys}}, round(case when p + n + u > 0 then n / (p + n + u) else 0.0 end, 6) as neg,
           round(case when p + n + u > 0 then u / (p + n + u) else 0.0 end, 6) as neu,
           round(case when p + n + u > 0 then p / (p + n + u) else 0.0 end, 6) as pos, round(s / sqrt(s * s + 15), 6) as compound,
           case when s / sqrt(s * s + 15) >= 0.05 then 'POSITIVE' when s / sqrt(s * s + 15) <= -0.05 then 'NEGATIVE' else 'NEUTRAL' end as sentiment
    from marked)"""


def _rounded(scores):
    return scores.withColumns({name: F.round(name, 6) for name in ("neg", "neu", "pos", "compound")})


@query("sentiment_context", f"select * from {CONTEXT_SQL.format(keys='doc_id', table='documents')}")
def sentiment_context(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return _rounded(c.context_scores(spread(documents), ["doc_id"], "text", lexicon_frame(spark)))


@query("sentiment_context_by_group", f"""
    select source, count(*) as n, sum(case sentiment when 'POSITIVE' then 1 when 'NEGATIVE' then -1 else 0 end)::bigint as net_sentiment
    from {CONTEXT_SQL.format(keys='doc_id, source', table='documents')} group by source
""")
def sentiment_context_by_group(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "text")
    scores = c.context_scores(spread(documents), ["doc_id", "source"], "text", lexicon_frame(spark))
    points = F.when(F.col("sentiment") == "NEGATIVE", -1).when(F.col("sentiment") == "POSITIVE", 1).otherwise(0)
    return scores.groupBy("source").agg(F.count("*").alias("n"), F.sum(points).alias("net_sentiment"))


@query("sentiment_lexicon", f"""
    with docs as (select list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '{c.WORD.replace("'", "''")}'), lambda w: lower(w))) as words from documents),
    flagged as (select words, list_has_any(words, {list(POSITIVE_SEEDS)}) as good, list_has_any(words, {list(NEGATIVE_SEEDS)}) as bad from docs),
    totals as (select sum(good::int) as all_g, sum(bad::int) as all_b from flagged),
    counted as (select word, count(*) as n_docs, sum(good::int) as g, sum(bad::int) as b
                from (select unnest(words) as word, good, bad from flagged where good or bad) group by word)
    select word, n_docs, round(greatest(least(log2(((g + 0.5) / (all_g + 1)) / ((b + 0.5) / (all_b + 1))), 4.0), -4.0), 6)::double as valence
    from counted, totals where n_docs >= 5 and word not in {_listed(POSITIVE_SEEDS + NEGATIVE_SEEDS)}
""")
def sentiment_lexicon(spark, sf):
    """Valences of all words that occur in five documents with a seed, from two seeds the corpus holds."""
    documents = spread(table(spark, sf, "documents").select("text"))
    return c.grow_lexicon(documents, "text", POSITIVE_SEEDS, NEGATIVE_SEEDS).withColumn("valence", F.round("valence", 6))
