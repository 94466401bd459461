"""Periodic runs against brute force."""

import random

import numpy as np
import pytest

from millrace.llm import periodic_runs as pr


def brute_runs(words, least):
    """All runs: for every period the maximal stretches, less those that a smaller period covers."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= 2 * q and not any(s <= i and i + length <= s + m for s, m, _ in found):
                found.append((i, length, q))
            i = j + 1
    return sorted(((s, m, q) for s, m, q in found if m >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    kind = rng.random()
    letters = "ab" if kind < 0.4 else "abc" if kind < 0.7 else "abcdefgh"
    out = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
    while rng.random() < 0.7:
        root = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        out += (root * 8)[:rng.randint(1, 8 * len(root))] + [rng.choice(letters) for _ in range(rng.randint(0, 6))]
    return out


def brute_lyndon(s):
    """The next smaller suffix ends the longest Lyndon word."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


@pytest.mark.parametrize("seed", range(40))
def test_lyndon_array(seed):
    rng = random.Random(seed)
    texts = [[ord(w) for w in random_words(rng)] for _ in range(4)]
    joined = np.array([x for t in texts for x in [0, *t]] + [0])
    lengths, at = pr.lyndon_lengths(joined), 0
    for t in texts:
        assert lengths[at + 1:at + 1 + len(t)].tolist() == brute_lyndon(t)
        at += len(t) + 1


@pytest.mark.parametrize("seed", range(40))
@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_letters(seed, least):
    rng = random.Random(seed)
    words = random_words(rng)
    found = pr.runs_of(np.array([0, *map(ord, words), 0]), least)
    assert [(s - 1, m, q) for s, m, q in zip(*map(np.ndarray.tolist, found))] == brute_runs(words, least)


def texts(seed, n):
    rng = random.Random(seed)
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t"), (4, "w " * 5000), (None, "x y " * 9), (5, "a b c"), (5, "é ü " * 10 + "\x0b z")]
    for i in range(10, 10 + n):
        words = random_words(rng)
        tail = [f"u{rng.randrange(9999)}" for _ in range(rng.randint(0, 30))]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(tail[:10] + words + tail[10:])))
    return rows + [rows[-1], (9, " ".join(str(i * i % 77) for i in range(2500)))]


@pytest.mark.parametrize("least", [2, 7, 12])
def test_documents_against_brute_force(spark, least, monkeypatch):
    rows = texts(least, 120)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, runs long, n_words string").repartition(3)
    got = pr.periodic_runs(docs, min_length=least).collect()
    want = []
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        found = brute_runs(words, least) if len(words) != 5000 else [(0, 5000, 1)]
        want.append((doc_id, len(words), found, collapse(words, found)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed.decode()) for r in got), key=repr) == sorted(want, key=repr)


def test_stretches_in_several_pieces(monkeypatch):
    monkeypatch.setattr(pr, "MOST_WORDS", 40)
    raw = b" ".join(b"ab cd " * 7 + b"u%d" % i for i in range(30))
    data = np.frombuffer(raw, np.uint8)
    starts, stops, text = pr.word_bounds(data, np.array([0, len(raw)]))
    words = [raw[a:b] for a, b in zip(starts, stops)]
    found = pr._block_runs(raw, starts, stops, text, pr.word_hashes(data, starts, stops), 12)
    assert [(s, m, q) for s, q, m in found.tolist()] == brute_runs(words, 12)


def test_no_documents(spark):
    assert pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text_in_linear_time():
    """400,000 words of one period, and as many of a Fibonacci word, which holds a run at nearly every place."""
    a, b = [1], [1, 2]
    while len(b) < 400_000:
        a, b = b, b + a
    for words in (list(range(1, 21)) * 20_000, b[:400_000]):
        start, length, period = pr.runs_of(np.array([0, *words, 0]), 12)
        assert len(start) < len(words)
        assert (length >= 2 * period).all()
