"""Toxicity: lexicon terms found through Levenshtein automata, weighed by their context.

The lexicon is learned from labelled texts and kept as a trie. A term is a word, or a stem (``abus*``) that any
ending may follow. Each distinct word of a text is an automaton of the strings within its edit distance; walking
the trie and the automaton together gives the terms that the word may misspell. Two runs of letters around one digit
or sign are tried as one word too, and so are words with two neighbouring letters swapped. A hit counts less inside
quotation marks or beside words of reporting.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fold, stored

MOST_ROWS = 20_000
MOST_TERMS = 20_000
MIN_EVIDENCE = 24.0
MIN_FUZZY = 5
MIN_FUZZY_STEM = 6
STEM_LENGTHS = (4, 5, 6, 7, 8)
WINDOW = 6
CACHE = 200_000
N_FEATURES = 5
_TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»‘’]")
# A run of letters, one digit or sign, and the next run: what a word with an inner sign looks like.
_JOINED = re.compile(r"(?<![^\W\d_])([^\W\d_]++)(?=([^\w\s\"“”„«»‘’]|[\d_])([^\W\d_]++))")
_QUOTES = frozenset("\"“”„«»‘’")
REPORTING = frozenset(
    "said says say called calls quote quoted quotes wrote writes word term phrase means reported alleged "
    "sagte sagt nannte zitat wort dit disait cité mot dijo dice cita palabra".split())
ADDRESS = frozenset("you your youre yourself du dein ihr sie tu vous ton votre usted tú vosotros".split())


def joined_words(lowered: str) -> list[str]:
    """Both runs of letters with the digit or sign between them, for each place where there is just one."""
    return ["".join(parts) for parts in _JOINED.findall(lowered)]


def swaps(letters: str) -> set[str]:
    """The strings with two neighbouring letters swapped."""
    return {letters[:i] + letters[i + 1] + letters[i] + letters[i + 2:] for i in range(len(letters) - 1)} - {letters}


class LevenshteinAutomaton:
    """Accepts the strings within one edit of a word, or the word alone if ``most`` is 0.

    A state holds, for zero and for one edit, the positions in the word that the letters read so far may have
    led to, as bits of a number.
    """

    def __init__(self, word: str, most: int = 1):
        self.most, self.end = most, 1 << len(word)
        self.places: dict[str, int] = {}
        for i, letter in enumerate(word):
            self.places[letter] = self.places.get(letter, 0) | 1 << i

    def start(self) -> tuple[int, int]:
        return 1, 2 if self.most else 0

    def step(self, state: tuple[int, int], letter: str) -> tuple[int, int]:
        exact, edited = state
        here = self.places.get(letter, 0)
        onward = (exact & here) << 1
        if not self.most:
            return onward, 0
        # Read on after an edit, or edit now: a letter too many, another letter, or the next letter left out.
        edited = (edited & here) << 1 | exact | exact << 1 | onward << 1
        return onward, edited & (self.end << 1) - 1

    def edits(self, state: tuple[int, int], stem: bool = False) -> int | None:
        """Edits with which the state accepts, if it does. For a stem the word may go on."""
        if stem:
            return 0 if state[0] else 1 if state[1] else None
        return 0 if state[0] & self.end else 1 if state[1] & self.end else None


class Trie:
    """Terms by letter, and by word length the pieces that rule most words out before any walk."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.stem_lengths = sorted({len(t) for t in self.stems})
        self.children: list[dict[str, int]] = [{}]
        self.terms_at: list[tuple[str, ...]] = [()]
        # One edit leaves the first or the second half of a term as it is, and moves the second by one place at most.
        self.pieces: dict[int, tuple[dict[int, set[str]], dict[int, set[str]]]] = {}
        self.stem_pieces: dict[int, set[str]] = {}
        self.stem_rests: dict[tuple[int, int], set[str]] = {}
        for term in terms:
            at, letters = 0, term.removesuffix("*")
            for letter in letters:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.terms_at.append(())
                at = self.children[at][letter]
            self.terms_at[at] += (term,)
            half, size = len(letters) // 2, len(letters)
            if letters != term and size >= MIN_FUZZY_STEM:
                self.stem_pieces.setdefault(half, set()).add(letters[:half])
                for start in (half - 1, half, half + 1):
                    self.stem_rests.setdefault((start, size - half), set()).add(letters[half:])
            elif letters == term and size >= MIN_FUZZY:
                for length in (size - 1, size, size + 1):
                    heads, tails = self.pieces.setdefault(length, ({}, {}))
                    heads.setdefault(half, set()).add(letters[:half])
                    tails.setdefault(size - half, set()).add(letters[half:])

    def within(self, word: str, most: int) -> list[tuple[str, int]]:
        """Terms within ``most`` edits of the word, or of a beginning of it for stems, with the edits."""
        automaton = LevenshteinAutomaton(word, most)
        found, stack = [], [(0, automaton.start())]
        while stack:
            node, state = stack.pop()
            for term in self.terms_at[node]:
                if (edits := automaton.edits(state, term.endswith("*"))) is not None:
                    found.append((term, edits))
            for letter, child in self.children[node].items():
                after = automaton.step(state, letter)
                if after != (0, 0):
                    stack.append((child, after))
        return found

    def may_match(self, word: str) -> bool:
        """False only if no term is one edit away."""
        heads, tails = self.pieces.get(len(word), ({}, {}))
        return (
            any(word[:n] in some for n, some in heads.items()) or any(word[-n:] in some for n, some in tails.items())
            or any(word[:n] in some for n, some in self.stem_pieces.items())
            or any(word[at:at + n] in some for (at, n), some in self.stem_rests.items())
        )

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the best term for a word: exact, or one edit away from a term that is long enough."""
        exact = [self.stems[word[:n]] for n in self.stem_lengths if word[:n] in self.stems]
        if word in self.terms:
            exact.append(self.terms[word])
        if exact:
            return max(exact), 0
        if not self.may_match(word):
            return None
        near = [(self.terms[t], e) for t, e in self.within(word, 1) if len(t) >= (MIN_FUZZY_STEM + 1 if t.endswith("*") else MIN_FUZZY)]
        return max(near, default=None)


@dataclass
class Lexicon:
    terms: dict[str, float]
    trie: Trie = field(init=False)
    known: dict = field(init=False, default_factory=dict)
    swapped: dict = field(init=False, default_factory=dict)
    swapped_stems: dict = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.trie = Trie(self.terms)
        for term, weight in self.terms.items():
            letters = term.removesuffix("*")
            if len(letters) >= (MIN_FUZZY if letters == term else MIN_FUZZY_STEM):
                found = self.swapped if letters == term else self.swapped_stems
                for other in swaps(letters):
                    found[other] = max(weight, found.get(other, weight))
        self.swapped_lengths = sorted({len(t) for t in self.swapped_stems})

    def match_swapped(self, word: str) -> tuple[float, int] | None:
        """The best term that two swapped neighbours make of the word; that counts as one edit."""
        near = [self.swapped_stems[word[:n]] for n in self.swapped_lengths if word[:n] in self.swapped_stems]
        if word in self.swapped:
            near.append(self.swapped[word])
        return (max(near), 1) if near else None

    def match(self, word: str) -> tuple[float, int] | None:
        if word not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = self.trie.match(word) or self.match_swapped(word)
        return self.known[word]

    @staticmethod
    def join(lowered: str, joined: dict, hits: dict) -> list[str]:
        """The words, where two runs of letters are one word if that is a hit and neither of them is one without edits."""
        exact = {w for w, (_, edits) in hits.items() if not edits}
        words, end, last = [], -1, ""
        for m in _TOKEN.finditer(lowered):
            word = m.group()
            # The run before may already be part of a joined word: then it is not free to join again.
            if last and m.start() == end + 1 and exact.isdisjoint((last, word)) and (whole := last + lowered[end] + word) in joined:
                words[-1], last = whole, ""
            else:
                words.append(word)
                last = "" if word in _QUOTES else word
            end = m.end()
        return words

    def features(self, text: str | None) -> list[float]:
        """Weight of plain, misspelled and quoted hits, their number, and whether there is any."""
        lowered = (text or "").lower()
        words = _TOKEN.findall(lowered)
        hits = {w: m for w in set(words) if (m := self.match(w)) is not None}
        if joined := {w: m for w in set(joined_words(lowered)) if (m := self.match(w)) is not None}:
            words = self.join(lowered, joined, hits)
            hits |= joined
        if not hits:
            return [0.0] * N_FEATURES
        quotes = np.cumsum([w in _QUOTES for w in words])
        plain = misspelled = quoted = 0.0
        n = 0
        for i, word in enumerate(words):
            if word not in hits:
                continue
            weight, edits = hits[word]
            window = words[max(0, i - WINDOW):i + WINDOW + 1]
            near = range(max(0, i - WINDOW), min(len(words), i + WINDOW + 1))
            in_quotes = quotes[i] % 2 == 1 and any(words[j] in _QUOTES for j in near if j > i)
            n += 1
            if in_quotes or not REPORTING.isdisjoint(window):
                quoted += weight
            elif edits:
                misspelled += weight
            else:
                plain += weight * (1.25 if not ADDRESS.isdisjoint(window) else 1.0)
        return [math.log1p(plain), math.log1p(misspelled), math.log1p(quoted), math.log1p(n), float(plain > 0)]


@dataclass
class Model:
    lexicon: dict[str, float]
    beta: np.ndarray

    def score(self, lexicon: Lexicon, text: str | None) -> float:
        x = float(self.beta[0] + self.beta[1:] @ np.array(lexicon.features(text)))
        return 1 / (1 + math.exp(-min(max(x, -500.0), 500.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first coefficient is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-9
    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def select_terms(found: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Words and stems to keep, from ``term: (toxic texts, other texts, weight)``.

    A stem stands for its words where it is held by clearly more toxic texts than any one longer stem or word that
    starts with it, and by few others. Words and stems that start with a kept stem are left out, unless misspellings
    are found of them but not of the stem, as it is too short.
    """
    def covered(letters: str, stem: bool) -> bool:
        fuzzy = len(letters) >= (MIN_FUZZY_STEM if stem else MIN_FUZZY)
        return any(letters[:n] in stems for n in STEM_LENGTHS if n <= len(letters) and (n >= MIN_FUZZY_STEM or not fuzzy))

    longest: dict[str, int] = {}
    for term, (a, _, _) in found.items():
        letters = term.removesuffix("*")
        for n in STEM_LENGTHS:
            if n < len(letters) or (n == len(letters) and letters == term):
                longest[letters[:n]] = max(longest.get(letters[:n], 0), a)
    stems: set[str] = set()
    for term, (a, b, _) in sorted(found.items(), key=lambda t: (len(t[0]), t[0])):
        letters = term.removesuffix("*")
        if letters != term and 10 * b <= a and a >= 1.3 * longest.get(letters, 0) and not covered(letters, True):
            stems.add(letters)
    return {
        t: w for t, (_, _, w) in found.items()
        if (t[:-1] in stems if t.endswith("*") else not covered(t, False))
    }


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = MOST_ROWS,
    most_terms: int = MOST_TERMS, min_evidence: float = MIN_EVIDENCE,
) -> Model:
    """Learn lexicon and weights on labelled rows outside fold 0, at most ``most_rows`` by a hash of the id, one of
    each group of copies: rows of one label with the same words and signs in the same order, whatever their case and
    spacing. Near copies count each.

    A word or stem is a term if its document counts differ between toxic and other texts by a likelihood ratio of
    ``min_evidence`` at least, towards toxic; of the ``most_terms`` strongest, ``select_terms`` chooses. Its weight
    is the log odds ratio. Labels other than 0 and 1, and ids with both, are not used. Without rows of both classes no word is a
    term and all texts get one score.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("known_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where((fold("known_id") != 0) & F.col("label").isin(0, 1)).groupBy("known_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    known = known.orderBy(F.xxhash64("known_id"), "known_id").limit(most_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("known_id")).select("known_id", "label", "text")

    def key_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [xxhash.xxh3_128_digest(" ".join((t or "").lower().split())) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["known_id"].cast(pa.int64()), batch["label"], pa.array(keys, pa.binary())], ["known_id", "label", "key"])

    # One of several copies is evidence enough for their words; the 128 bits are of the whole text.
    single = rows.select("known_id", "label", "text").mapInArrow(key_of, "known_id long, label int, key binary").groupBy("label", "key").agg(F.min("known_id").alias("one_id"))
    single = stored(single.select("one_id"), "toxicity-sample")
    rows = stored(rows.join(F.broadcast(single), F.col("known_id") == F.col("one_id"), "left_semi").select("label", "text"), "toxicity-texts")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        share = (ones + 1) / (ones + zeros + 2)
        return Model({}, np.array([math.log(share / (1 - share))] + [0.0] * N_FEATURES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist()):
                lowered = (text or "").lower()
                words = {w for w in _TOKEN.findall(lowered) if len(w) > 2}
                counts[label].update(words.union(joined_words(lowered)))
                counts[label].update({w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) >= n})
            both = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(both), pa.array([counts[1][w] for w in both], pa.int64()), pa.array([counts[0][w] for w in both], pa.int64())], ["term", "a", "b"])

    counts = rows.mapInArrow(count, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    held = F.col("a") + F.col("b")
    share = ones / (ones + zeros)
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    evidence = 2 * (part(F.col("a"), held * share) + part(F.col("b"), held * (1 - share)))
    odds = F.log((F.col("a") + 0.5) / (ones - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (zeros - F.col("b") + 0.5))
    terms = counts.select("term", "a", "b", evidence.alias("evidence"), odds.alias("odds")).where((F.col("evidence") >= min_evidence) & (F.col("odds") > 2))
    lexicon = select_terms({r["term"]: (r["a"], r["b"], r["odds"]) for r in terms.orderBy(F.desc("evidence"), "term").limit(most_terms).collect()})
    shared = spark.sparkContext.broadcast(lexicon)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(shared.value)
        for batch in batches:
            x = [own.features(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    # A bounded sample of five numbers each; equal rows are counted together.
    points = rows.mapInArrow(extract, "label int, x array<double>").groupBy("label", "x").count().collect()
    x = np.repeat(np.array([p["x"] for p in points]), [p["count"] for p in points], axis=0)
    y = np.repeat(np.array([p["label"] for p in points], np.float64), [p["count"] for p in points])
    return Model(lexicon, fit_logistic(x, y))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` per row, from the whole text alone.

    Null and wordless texts get the score of a text without terms. Repeated rows and null ids are scored like any
    other; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lexicon = Lexicon(own.lexicon)
        for batch in batches:
            scores = [own.score(lexicon, t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
