"""Sentiment with context rules, and lexicons grown from a few seed words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import MAX_BROADCAST_WORDS, NORMALISATION, sentiment_label
from millrace.operators.rangebuckets import broadcast_if_small

# Fixed values of the published rule-based analyser (Hutto and Gilbert, 2014).
CAPITALS = 0.733
BOOST = 0.293
BOOST_DECAY = (1.0, 0.95, 0.9)
NEGATED = -0.74
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, MOST_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

# Words that strengthen, weaken or turn round the word after them.
BOOSTERS = ("absolutely", "completely", "especially", "extremely", "highly", "most", "particularly", "really", "so", "totally", "very")
DAMPENERS = ("almost", "barely", "hardly", "partly", "scarcely", "slightly", "somewhat")
NEGATIONS = ("cannot", "neither", "never", "no", "nobody", "none", "nor", "not", "nothing", "without")

SENTENCE = "[^.!?\\n]+"
WORD = "[A-Za-z]+(?:'[A-Za-z]+)?"


def _lowered(words: Column) -> Column:
    return F.transform(words, F.lower)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _earlier(words: Column, steps: int) -> Column:
    """The words ``steps`` places before each word, NULL at the start, in an array of the same length."""
    return F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), steps), words), F.lit(1), F.size(words))


def _marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def context_scores(docs: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Per document: shares of negative, neutral and positive words, a compound score and its label.

    Rules, all within a sentence: a word in capitals among others counts for more; boosters and
    dampeners up to three words before change it, less from further away; a negation up to three
    words before turns it round; words before the first "but" count for half, those after it for half
    as much again. Exclamation and question marks of the text strengthen whichever side it is on.

    Whole texts are split; a document's words stay in one task and are summed before the shuffle,
    which carries one row per document, as the lexicon is sent to the words; one of more than
    ``MAX_BROADCAST_WORDS`` words is joined by a shuffle of all words. ``lexicon`` holds ``word`` (lower case, once each) and
    ``valence``. ``keys`` must identify a document. Texts that are NULL or without words score 0.
    """
    words, whole, sentence = F.col("_words"), F.coalesce(F.col(text), F.lit("")), F.coalesce("_sentence", F.lit(""))
    sentences = docs.select(
        *keys, _marks(whole, "!").alias("_exclaimed"), _marks(whole, "?").alias("_asked"),
        F.explode_outer(F.regexp_extract_all(whole, F.lit(SENTENCE), F.lit(0))).alias("_sentence"),
    )
    capital = lambda w: (F.length(w) > 1) & (w == F.upper(w))
    split = sentences.select(*keys, "_exclaimed", "_asked", _words(sentence).alias("_words")).select(
        *keys, "_exclaimed", "_asked", "_words", F.array_position(_lowered(words), F.lit("but")).alias("_but"),
        (F.exists(words, capital) & F.exists(words, lambda w: w != F.upper(w))).alias("_mixed"),
    )
    rows = split.select(
        *keys, "_exclaimed", "_asked", "_but", "_mixed",
        F.posexplode_outer(F.arrays_zip(
            words.alias("word"), *[_earlier(words, k).alias(f"w{k}") for k in (1, 2, 3)])).alias("_at", "_word"),
    ).select(
        *keys, "_exclaimed", "_asked", "_but", "_mixed", (F.col("_at") + 1).alias("_at"), F.col("_word.word").alias("_said"),
        F.lower("_word.word").alias("_lower"), *[F.lower(f"_word.w{k}").alias(f"_w{k}") for k in (1, 2, 3)])

    known = lexicon.select(F.col("word").alias("_lower"), F.col("valence").alias("_valence"))
    plain = F.coalesce("_valence", F.lit(0.0))
    side = F.signum(plain)
    strength = plain + F.when(F.col("_mixed") & capital(F.col("_said")), side * CAPITALS).otherwise(0.0)
    turned = F.lit(False)
    for k, decay in zip((1, 2, 3), BOOST_DECAY):
        before = F.col(f"_w{k}")
        strength = strength + F.when(before.isin(*BOOSTERS), side * (BOOST * decay)).when(
            before.isin(*DAMPENERS), side * (-BOOST * decay)).otherwise(0.0)
        turned = turned | F.coalesce(before.isin(*NEGATIONS) | before.endswith("n't"), F.lit(False))
    clause = F.when((F.col("_but") == 0) | (F.col("_at") == F.col("_but")), 1.0).when(
        F.col("_at") < F.col("_but"), BEFORE_BUT).otherwise(AFTER_BUT)
    value = strength * F.when(turned, NEGATED).otherwise(1.0) * clause
    valued = rows.join(broadcast_if_small(known, MAX_BROADCAST_WORDS), "_lower", "left").withColumn("_value", value)

    v = F.col("_value")
    sums = valued.groupBy(*keys).agg(
        F.max("_exclaimed").alias("_exclaimed"), F.max("_asked").alias("_asked"), F.sum(v).alias("_s"),
        F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("_p"), F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("_n"),
        F.sum(F.when(F.col("_said").isNotNull() & (v == 0), 1.0).otherwise(0.0)).alias("_u"),
    )
    asked = F.col("_asked")
    emphasis = F.least("_exclaimed", F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + F.when(asked < 2, 0.0).when(
        asked <= MOST_QUESTIONS, asked * QUESTION).otherwise(MANY_QUESTIONS)
    s = F.col("_s") + F.signum("_s") * emphasis
    p = F.col("_p") + F.when(F.col("_p") > F.col("_n"), emphasis).otherwise(0.0)
    n = F.col("_n") + F.when(F.col("_n") > F.col("_p"), emphasis).otherwise(0.0)
    parts = sums.select(*keys, s.alias("_s"), p.alias("_p"), n.alias("_n"), "_u")
    total = F.col("_p") + F.col("_n") + F.col("_u")
    share = lambda name: F.when(total > 0, F.col(name) / total).otherwise(0.0)
    compound = F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + NORMALISATION)
    return parts.select(*keys, share("_n").alias("neg"), share("_u").alias("neu"), share("_p").alias("pos"),
                        compound.alias("compound"), sentiment_label(compound).alias("sentiment"))


def grow_lexicon(docs: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str],
                 least_docs: int = 5, widest: float = 4.0) -> DataFrame:
    """Valences learned from the company that words keep: (word, n_docs, valence).

    A word's valence is the log2 ratio of its smoothed shares among the documents with a positive and
    those with a negative seed, cut to +-``widest``. Words count once per document; seeds, and words in
    under ``least_docs`` documents with a seed, are left out. One aggregation of whole texts, combined
    before the shuffle; its row of the empty word holds the totals.
    """
    found = docs.select(F.array_distinct(_lowered(_words(F.coalesce(F.col(text), F.lit(""))))).alias("_words"))
    flagged = found.select("_words", *[
        F.arrays_overlap("_words", F.array(*[F.lit(w) for w in seeds])).alias(name)
        for name, seeds in (("_good", positive), ("_bad", negative))]).where("_good or _bad")
    counted = flagged.select("_good", "_bad", F.explode(F.concat("_words", F.array(F.lit("")))).alias("word")).groupBy("word").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("_good").cast("bigint")).alias("g"), F.sum(F.col("_bad").cast("bigint")).alias("b"))
    totals = counted.where("word = ''").select(F.col("g").alias("all_g"), F.col("b").alias("all_b"))
    ratio = (F.col("g") + 0.5) / (F.col("all_g") + 1) / ((F.col("b") + 0.5) / (F.col("all_b") + 1))
    valence = F.greatest(F.least(F.log2(ratio), F.lit(widest)), F.lit(-widest))
    learned = counted.where((F.col("n_docs") >= least_docs) & ~F.col("word").isin("", *positive, *negative))
    return learned.crossJoin(F.broadcast(totals)).select("word", "n_docs", valence.alias("valence"))
