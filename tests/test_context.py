"""Sentiment rules one by one, and lexicons grown from seeds."""

import math

import pytest

from millrace.functions.context import context_scores, grow_lexicon
from millrace.functions.text import lexicon_frame, sentiment_scores


def _sum(compound: float) -> float:
    """The sum of valences behind a compound score."""
    return math.copysign(math.sqrt(15 * compound**2 / (1 - compound**2)), compound) if compound else 0.0


@pytest.fixture(scope="module")
def scored(spark):
    texts = {
        "plain": "a good day", "not": "not a good day", "contracted": "it isn't good", "far": "not in any sense of it good",
        "next sentence": "not now. good", "very": "a very good day", "further": "a very big good day", "slightly": "a slightly good day",
        "very bad": "a very bad day", "capitals": "a GOOD day", "shouted": "A GOOD DAY", "but": "good food but bad service",
        "but elsewhere": "good but odd. bad", "marks": "a good day!!", "many marks": "a good day!!!!!!!", "bad marks": "a bad day!",
        "asked": "a good day??", "asked often": "a good day?????", "no": "no good", "empty": "", "null": None, "signs": "... 12 !?",
        "long": "good " * 50_000, "cent": "äöü good ÄÖÜ",
    }
    docs = spark.createDataFrame(list(texts.items()), "name string, text string")
    return {r["name"]: r for r in context_scores(docs, ["name"], "text", lexicon_frame(spark)).collect()}


@pytest.mark.parametrize("name, total", [
    ("plain", 1.9), ("not", 1.9 * -0.74), ("contracted", 1.9 * -0.74), ("far", 1.9), ("next sentence", 1.9),
    ("very", 1.9 + 0.293), ("further", 1.9 + 0.293 * 0.95), ("slightly", 1.9 - 0.293), ("very bad", -2.5 - 0.293),
    ("capitals", 1.9 + 0.733), ("shouted", 1.9), ("but", 1.9 * 0.5 - 2.5 * 1.5), ("but elsewhere", 1.9 * 0.5 - 2.5),
    ("marks", 1.9 + 2 * 0.292), ("many marks", 1.9 + 4 * 0.292), ("bad marks", -2.5 - 0.292), ("asked", 1.9 + 2 * 0.18),
    ("asked often", 1.9 + 0.96), ("no", -1.2 + 1.9 * -0.74), ("empty", 0.0), ("null", 0.0), ("signs", 0.0), ("cent", 1.9),
])
def test_rules(scored, name, total):
    assert _sum(scored[name]["compound"]) == pytest.approx(total)


def test_shares_and_labels(scored):
    assert scored["not"]["sentiment"] == "NEGATIVE" and scored["plain"]["sentiment"] == "POSITIVE"
    assert scored["plain"]["pos"] == pytest.approx(2.9 / 4.9) and scored["plain"]["neu"] == pytest.approx(2 / 4.9)
    assert scored["bad marks"]["neg"] == pytest.approx((3.5 + 0.292) / (5.5 + 0.292))
    assert scored["long"]["compound"] == pytest.approx(1.0) and scored["long"]["pos"] == 1.0
    assert {scored[n]["sentiment"] for n in ("empty", "null", "signs")} == {"NEUTRAL"}


def test_every_document_has_a_row(spark, scored):
    assert len(scored) == 24
    none = spark.createDataFrame([], "name string, text string")
    assert context_scores(none, ["name"], "text", lexicon_frame(spark)).count() == 0


def test_lexicon_grows_from_seeds(spark):
    texts = ["great tasty soup"] * 6 + ["awful stale soup"] * 6 + ["stale bread"] * 9 + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    grown = {r["word"]: r for r in grow_lexicon(docs, "text", ["great"], ["awful"]).collect()}
    assert set(grown) == {"tasty", "stale", "soup"}  # bread never meets a seed
    assert grown["tasty"]["valence"] == pytest.approx(math.log2(6.5 / 0.5)) and grown["soup"]["valence"] == pytest.approx(0.0)
    assert grown["stale"]["valence"] == pytest.approx(-math.log2(6.5 / 0.5)) and grown["stale"]["n_docs"] == 6
    assert grow_lexicon(docs.limit(0), "text", ["great"], ["awful"]).count() == 0
    lexicon = grow_lexicon(docs, "text", ["great"], ["awful"]).select("word", "valence")
    new = spark.createDataFrame([(1, "so tasty"), (2, "not tasty")], "id int, text string")
    assert {r["id"]: r["sentiment"] for r in context_scores(new, ["id"], "text", lexicon).collect()} == {1: "POSITIVE", 2: "NEGATIVE"}


@pytest.mark.parametrize("score", [context_scores, sentiment_scores])
def test_words_are_not_shuffled(spark, score):
    docs = spark.createDataFrame([(i, "not a good day. " * 20) for i in range(40)], "id int, text string").repartition(16)
    plan = score(docs, ["id"], "text", lexicon_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
