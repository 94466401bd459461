"""Periodic runs in word sequences: Lyndon roots by grouping, extended by longest common extensions.

A run is a maximal stretch of words with a smallest period of at most half its length. Every run has a root
that is the longest Lyndon word at its place under one of the two orders of the words (Bannai et al., the runs theorem).
Phase one of Baier's suffix sorter groups suffixes by exactly that Lyndon word, so that it yields
the Lyndon array under either order directly, without the sort of phase two. Each root is then extended to
both sides by common extensions, found exactly through ranks of stretches of 1, 2, 4, ... words.

Before that, stretches that cannot hold a run are left out: each word of a run lies in a sequence of
``(min_length + 1) // 2`` words that occurs twice in the run, so words whose sequences all occur once in their stretch are
in no run. What is left is cut at them and looked at again until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, text_buffers, word_bounds
from millrace.llm.hashing import U64, Prefix, mix, word_hashes

MIN_LENGTH = 12
MOST_WORDS = 1 << 17
ROUNDS = 12
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lyndon_lengths(letters: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of a sequence. Zeros end words: a text is cut there, and must begin with one.

    Phase one of Baier's suffix sorter. Suffixes with the same known prefix form a group; groups are
    ordered, and taken from the greatest down. A suffix whose next smaller group to the left is that of
    suffix j extends what is known of j; as many times as suffixes of one group point at j. The
    extended suffixes leave their group for new ones right above it. When a group is taken, the known prefix
    of its suffixes is their longest Lyndon word.
    """
    symbols, group_of = np.unique(letters, return_inverse=True)
    if symbols[0] != 0 or letters[0] != 0:
        raise ValueError("the sequence must begin with a zero")
    by_letter = np.argsort(group_of, kind="stable")
    members = [part.tolist() for part in np.split(by_letter, np.cumsum(np.bincount(group_of))[:-1])]
    top = len(members) - 1
    length = [1] * len(members)
    lower = list(range(-1, top))
    higher = list(range(1, top + 2))
    group_of = group_of.tolist()
    left = list(range(len(letters)))  # the nearest place at or before this one whose group was not taken yet, with shortcuts
    group = top
    while group > 0:
        own = members[group]
        leaving: dict[tuple[int, int], list[int]] = {}
        if len(own) == 1:
            i = own[0]
            found = i - 1
            while left[found] != found:
                left[found] = found = left[left[found]]
            if group_of[i] == group:
                left[i] = found
                if group_of[found]:
                    leaving[1, group_of[found]] = [found]
        else:
            pointed: dict[int, int] = {}
            own.sort()
            for i in own:
                if group_of[i] == group:
                    found = i - 1
                    while left[found] != found:
                        left[found] = found = left[left[found]]
                    left[i] = found
                    if group_of[found]:
                        pointed[found] = pointed.get(found, 0) + 1
            for j, times in pointed.items():
                leaving.setdefault((times, group_of[j]), []).append(j)
        known = length[group]
        for times, old in leaving if len(leaving) < 2 else sorted(leaving, reverse=True):
            new = len(members)
            moved = leaving[times, old]
            members.append(moved)
            length.append(length[old] + times * known)
            above = higher[old]
            lower.append(old)
            higher.append(above)
            higher[old] = lower[above] = new
            for j in moved:
                group_of[j] = new
        group = lower[group]
    return np.array(length)[group_of]


class Extensions:
    """Longest common extensions between places of one sequence, exact, for whole arrays of pairs."""

    def __init__(self, letters: np.ndarray, longest: int):
        """``longest`` bounds the extensions; zeros never match, not even each other."""
        ranks = letters.astype(np.int64)
        zeros = np.flatnonzero(ranks == 0)
        ranks[zeros] = ranks.max() + 1 + np.arange(len(zeros))
        self.ranks = [ranks]
        half = 1
        while half * 2 <= longest:
            pairs = ranks[:len(ranks) - half] * (int(ranks.max()) + 1) + ranks[half:]
            kinds, ranks = np.unique(pairs, return_inverse=True)
            if len(kinds) == len(pairs):
                break
            self.ranks.append(ranks.astype(np.int32))
            half *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, for a < b."""
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            ranks = self.ranks[level]
            inside = np.flatnonzero(b + done < len(ranks))
            same = inside[ranks[a[inside] + done[inside]] == ranks[b[inside] + done[inside]]]
            done[same] += 1 << level
        return done

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words back from ``a`` on, itself included, equal those back from ``b`` on, for a < b."""
        done = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            ranks, width = self.ranks[level], (1 << level) - 1
            inside = np.flatnonzero(a - done - width >= 0)
            same = inside[ranks[a[inside] - done[inside] - width] == ranks[b[inside] - done[inside] - width]]
            done[same] += 1 << level
        return done


def runs_of(letters: np.ndarray, min_length: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of all runs of ``min_length`` or more, by start, then period.

    ``letters`` are positive, zeros cut the sequence into texts; it begins and ends with one.
    """
    cuts = np.flatnonzero(letters == 0)
    extend = Extensions(letters, int(np.diff(cuts).max()) if len(cuts) > 1 else 1)
    turned = np.where(letters > 0, letters.max() + 1 - letters, 0)
    places = np.flatnonzero(letters)
    found = [np.zeros((0, 3), np.int64)]
    for order in (letters, turned):
        period = lyndon_lengths(order)[places]
        before = extend.left(places - 1, places + period - 1)
        length = before + period + extend.right(places, places + period)
        long = length >= np.maximum(2 * period, min_length)
        found.append(np.stack([places - before, period, length], axis=1)[long])
    start, period, length = np.unique(np.concatenate(found), axis=0).T
    return start, length, period


def _repetitive(words: np.ndarray, text: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in a run, and the number of the stretch of neighbours each belongs to."""
    k = max(1, (min_length + 1) // 2)
    places, stretch = np.arange(len(words)), text
    for _ in range(ROUNDS):
        if len(places) < min_length:
            return places[:0], stretch[:0]
        grams = Prefix(words[places]).runs(k)
        whole = stretch[:len(grams)] == stretch[k - 1:]
        grams = mix(grams + stretch[:len(grams)].astype(U64) * U64(0x9E3779B97F4A7C15))
        at = np.flatnonzero(whole)
        order = at[np.argsort(grams[at])]
        equal = grams[order[1:]] == grams[order[:-1]]
        edges = np.zeros(len(places) + 1, np.int64)
        twice = np.unique(np.concatenate([order[1:][equal], order[:-1][equal]]))
        edges[twice] += 1
        edges[twice + k] -= 1
        stays = np.cumsum(edges[:-1]) > 0
        number = np.cumsum(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | ~stays[1:] | ~stays[:-1]]))
        sizes = np.bincount(number[stays], minlength=int(number[-1]) + 1)
        stays &= sizes[number] >= min_length
        if stays.all() and (stretch[1:] != stretch[:-1]).sum() + 1 == number[-1]:
            break
        places, stretch = places[stays], number[stays]
    return places, stretch


def _block_runs(raw: bytes, starts: np.ndarray, stops: np.ndarray, text: np.ndarray, hashes: np.ndarray, min_length: int) -> np.ndarray:
    """Rows (start, period, length) of all runs, places counted over all words of the block, by start, then period."""
    places, stretch = _repetitive(hashes, text, min_length)
    out = [np.zeros((0, 3), np.int64)]
    if len(places):
        firsts = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
        ends = np.append(firsts[1:], len(places))
        first = 0
        while first < len(firsts):  # some stretches at a time, to bound what is in memory
            last = max(first + 1, int(np.searchsorted(ends, firsts[first] + MOST_WORDS, "right")))
            own = places[firsts[first]:ends[last - 1]]
            numbers: dict[bytes, int] = {}
            letters = np.array([numbers.setdefault(raw[a:b], len(numbers) + 1) for a, b in zip(starts[own].tolist(), stops[own].tolist())], np.int64)
            cut = np.concatenate([firsts[first:last], [ends[last - 1]]]) - firsts[first]
            start, length, period = runs_of(np.insert(letters, cut, 0), min_length)
            # Zeros before a place move it on by one each.
            out.append(np.stack([own[start - np.searchsorted(cut + np.arange(len(cut)), start)], period, length], axis=1))
            first = last
    return np.concatenate(out)


def periodic_runs(docs: DataFrame, id_col: str | Column = "doc_id", text_col: str | Column = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` per row.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte and numbered from 0. ``runs`` holds every run of ``min_length`` words or
    more that spans its smallest period at least twice, by start, then period. ``collapsed`` is the text with words joined by one
    space, without the words that lie behind the first period of a run: what repeats stays once.

    Null texts and texts without words have no words, no runs and empty bytes as ``collapsed``. Rows do not depend on
    each other: repeated rows and equal or null ids each give their row. An empty table gives no rows; other columns are
    not read. There is no shuffle, so no key can gather rows in one task; a text of n words takes about 400 bytes of memory per
    word of its periodic stretches, and n log n time.
    """
    if min_length < 2:
        raise ValueError("a run has two words or more")
    column = lambda c: F.col(c) if isinstance(c, str) else c

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for first, last in blocks(offsets):
                own, limits = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
                raw = own.tobytes()
                starts, stops, text = word_bounds(own, limits)
                cuts = np.searchsorted(text, np.arange(last - first + 1))
                found = _block_runs(raw, starts, stops, text, word_hashes(own, starts, stops), min_length)
                edges = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edges, found[:, 0] + found[:, 1], 1)
                np.add.at(edges, found[:, 0] + found[:, 2], -1)
                gone = np.cumsum(edges[:-1]) > 0
                owner = text[found[:, 0]]
                runs, collapsed = [], []
                at = np.searchsorted(owner, np.arange(last - first + 1))
                for i in range(last - first):
                    a, b = cuts[i], cuts[i + 1]
                    if at[i] == at[i + 1]:
                        runs.append([])
                        collapsed.append(b" ".join(raw[limits[i]:limits[i + 1]].split()))
                        continue
                    runs.append([{"start": s - a, "length": n, "period": p} for s, p, n in found[at[i]:at[i + 1]].tolist()])
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
                    stay = np.concatenate([[0], edge, [b - a]]) + a
                    collapsed.append(b" ".join(b" ".join(raw[starts[x]:stops[y - 1]].split()) for x, y in zip(stay[::2], stay[1::2]) if y > x))
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(first, last - first), pa.array(np.diff(cuts), pa.int64()), pa.array(runs, _RUNS), pa.array(collapsed, pa.binary()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find, SCHEMA)


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def with_period_from(text: Column, begin: Column, period: Column) -> Column:
    """The text's words, joined by spaces, where those from number ``begin`` on repeat the first ``period`` of them."""
    words = word_list(text)
    n = F.size(words)
    times = F.ceil((n - begin) / period).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, (begin + 1).cast("int"), period.cast("int")), times))
    return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), begin.cast("int")), again), F.lit(1), n), " ")
