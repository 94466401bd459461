"""Sentiment of whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import DEFAULT_LEXICON, lexicon_frame, sentiment_scores
from millrace.plans.registry import query
from millrace.session import scratch_dir, spread, table
from millrace.sources.readers import text_files
from millrace.sources.writers import write

SCORES_SQL = """
    select {keys}, case when total > 0 then neg / total else 0.0 end as neg, case when total > 0 then neu / total else 0.0 end as neu,
           case when total > 0 then pos / total else 0.0 end as pos, s / sqrt(s * s + 15) as compound,
           case when s / sqrt(s * s + 15) >= 0.05 then 'POSITIVE' when s / sqrt(s * s + 15) <= -0.05 then 'NEGATIVE'
                else 'NEUTRAL' end as sentiment
    from (select *, pos + neg + neu as total from (
        select {keys}, sum(v) as s, sum(case when v > 0 then v + 1 else 0.0 end) as pos, sum(case when v < 0 then 1 - v else 0.0 end) as neg,
               sum(case when word is not null and v = 0 then 1.0 else 0.0 end) as neu
        from (select {keys}, w.word, coalesce(valence, 0.0)::double as v from (
                  select {keys}, unnest(case when len(words) = 0 then [null] else words end) as word
                  from (select {keys}, regexp_extract_all(lower(text), '[a-z]+') as words from {table})) w
              left join (values """ + ", ".join(f"('{w}', {v}::double)" for w, v in DEFAULT_LEXICON) + """) l(word, valence)
              on w.word = l.word)
        group by all))
"""


def _rounded(scores):
    return scores.withColumns({c: F.round(c, 6) for c in ("neg", "neu", "pos", "compound")})


@query("sentiment_score", f"""
    select doc_id, round(neg, 6) as neg, round(neu, 6) as neu, round(pos, 6) as pos, round(compound, 6) as compound,
           sentiment, text as review
    from ({SCORES_SQL.format(keys='doc_id', table='documents')}) join documents using (doc_id)
""")
def sentiment_score(spark, sf):
    """Scores per document, with its text. Texts are joined back, not carried through the word rows."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    scores = _rounded(sentiment_scores(spread(documents), ["doc_id"], "text", lexicon_frame(spark)))
    return scores.join(documents, "doc_id").withColumnRenamed("text", "review")


@query("sentiment_label", f"""
    select lang, sentiment, count(*) as n from ({SCORES_SQL.format(keys='doc_id', table='documents')})
    join documents using (doc_id) group by 1, 2
""")
def sentiment_label(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "text")
    scores = sentiment_scores(spread(documents), ["doc_id", "lang"], "text", lexicon_frame(spark))
    return scores.groupBy("lang", "sentiment").agg(F.count("*").alias("n"))


@query("score_text_dir", f"""
    select conv_id, turn, round(compound, 6) as compound, sentiment
    from ({SCORES_SQL.format(keys='conv_id, turn', table='conversations')})
""")
def score_text_dir(spark, sf):
    """Texts of a directory scored into a table, key taken from the record's name."""
    source, out = scratch_dir(spark, "texts"), scratch_dir(spark, "scored")
    turns = table(spark, sf, "conversations")
    turns.select(F.to_json(F.struct(F.concat("conv_id", F.lit("_"), "turn", F.lit(".txt")).alias("name"), "text")).alias("line")).write.option(
        "maxRecordsPerFile", 1000).text(source)
    lines = text_files(spark, source).select(F.explode(F.split(F.rtrim(F.col("text")), "\n")).alias("line"))
    named = lines.select(F.get_json_object("line", "$.name").alias("name"), F.get_json_object("line", "$.text").alias("text")).select(
        F.split_part("name", F.lit("_"), F.lit(1)).cast("bigint").alias("conv_id"),
        F.replace(F.split_part("name", F.lit("_"), F.lit(2)), F.lit(".txt"), F.lit("")).cast("bigint").alias("turn"), "text")
    scores = sentiment_scores(named, ["conv_id", "turn"], "text", lexicon_frame(spark))
    return write(_rounded(scores).select("conv_id", "turn", "compound", "sentiment"), out)
