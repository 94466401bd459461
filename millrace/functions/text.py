"""Lexicon sentiment as a Spark job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.rangebuckets import broadcast_if_small

# A lexicon of any language fits; without the hint Spark cannot know its size and shuffles every word.
MAX_BROADCAST_WORDS = 200_000
# Fixed values of the published rule-based analyser (Hutto and Gilbert, 2014):
# normalisation constant, and the compound cut-offs of the three labels.
NORMALISATION = 15.0
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05

# A small general-purpose lexicon: word and valence from -4 to 4. Pass your own frame for real use.
DEFAULT_LEXICON = [
    ("amazing", 2.8), ("awful", -2.0), ("bad", -2.5), ("best", 3.2), ("crisp", 0.8), ("damage", -2.2),
    ("delicious", 2.7), ("disappointing", -2.2), ("excellent", 2.7), ("fresh", 1.3), ("good", 1.9), ("great", 3.1),
    ("hate", -2.7), ("horrible", -2.5), ("love", 3.2), ("no", -1.2), ("poor", -2.1), ("rest", 0.6),
    ("terrible", -2.1), ("tasty", 2.2), ("warm", 0.9), ("worst", -3.1),
]


def lexicon_frame(spark: SparkSession, entries=DEFAULT_LEXICON) -> DataFrame:
    return spark.createDataFrame(entries, "word string, valence double")


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def sentiment_label(compound: Column) -> Column:
    return (
        F.when(compound >= POSITIVE_FROM, "POSITIVE").when(compound <= NEGATIVE_TO, "NEGATIVE").otherwise("NEUTRAL")
    )


def sentiment_scores(docs: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Per document: shares of negative, neutral and positive words, and a compound score.

    Whole texts are split into words and joined to the lexicon, which is sent to them. A document's words stay
    in one task, so the sums are complete before the shuffle, which carries one row per document; a lexicon of
    more than ``MAX_BROADCAST_WORDS`` words is joined by a shuffle of all words.
    ``keys`` must identify a document; one without words scores 0.
    """
    words = docs.select(*keys, F.explode_outer(tokens(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    valence = F.coalesce(F.col("valence"), F.lit(0.0))
    word = F.col("word").isNotNull()
    sums = words.join(broadcast_if_small(lexicon, MAX_BROADCAST_WORDS), "word", "left").groupBy(*keys).agg(
        F.sum(valence).alias("s"),
        F.sum(F.when(valence > 0, valence + 1).otherwise(0.0)).alias("p"),
        F.sum(F.when(valence < 0, 1 - valence).otherwise(0.0)).alias("n"),
        F.sum(F.when(word & (valence == 0), 1.0).otherwise(0.0)).alias("u"),
    )
    total = F.col("p") + F.col("n") + F.col("u")

    def part(name: str) -> Column:
        return F.when(total > 0, F.col(name) / total).otherwise(0.0)

    compound = F.col("s") / F.sqrt(F.col("s") * F.col("s") + F.lit(NORMALISATION))
    return sums.select(
        *keys, part("n").alias("neg"), part("u").alias("neu"), part("p").alias("pos"), compound.alias("compound"),
        sentiment_label(compound).alias("sentiment"),
    )
