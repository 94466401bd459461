"""Byte-substring deduplication with a hash-compared suffix sort.

Which regions may share a substring at all is found by ``repeats``: they hold the same k-gram. Here the
regions of one k-gram are sorted as suffixes, once rightwards and once leftwards from it. Two suffixes are
compared through prefix polynomial hashes: a binary search finds their common extension, and the byte after
it decides. The sort is a mergesort whose merges place all elements of a level at once. Extensions claimed by
hashes are verified on the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import blocks, text_buffers
from millrace.llm.hashing import BYTE_VALUES, U64, Prefix, mix, spread_ranges
from millrace.llm.repeats import H_BYTES, Search, byte_blocks, mark_repeats, message_table, pack, unpack

LENGTH = 50
SCHEMA = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Suffixes:
    """Suffixes ``data[start:start + length]`` that are compared through hashes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data, self.start, self.length = data, start, length
        self.prefix = Prefix(BYTE_VALUES[data])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes a and b, by binary search on the hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.length[a], self.length[b])
        a, b = self.start[a], self.start[b]
        while (active := low < high).any():
            middle = (low + high + 1) >> 1
            equal = self.prefix.between(a, a + middle) == self.prefix.between(b, b + middle)
            low = np.where(active & equal, middle, low)
            high = np.where(active & ~equal, middle - 1, high)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b; a suffix sorts before its extensions."""
        common = self.common(a, b)
        over_a, over_b = common >= self.length[a], common >= self.length[b]
        last = len(self.data) - 1
        differ = self.data[np.minimum(self.start[a] + common, last)] < self.data[np.minimum(self.start[b] + common, last)]
        return np.where(over_a | over_b, over_a & (~over_b | or_equal), differ)

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes within their groups, and each one's common extension with the one before it.

        The first suffix of a group has -1. ``group`` numbers are given in ascending order.
        """
        n = len(group)
        order = np.arange(n)
        new = np.ones(n, bool)
        new[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        end = np.append(np.flatnonzero(new)[1:], n)[np.cumsum(new) - 1]
        width = 1
        while (at := np.flatnonzero(end - first > width)).size:
            begin, inside = first[at], at - first[at]
            run = inside // width
            low = np.minimum(begin + (run ^ 1) * width, end[at])
            other = low.copy()
            high = np.minimum(low + width, end[at])
            right = (run & 1).astype(bool)
            while (active := np.flatnonzero(low < high)).size:
                middle = (low[active] + high[active]) >> 1
                goes = self.before(order[middle], order[at[active]], right[active])
                low[active] = np.where(goes, middle + 1, low[active])
                high[active] = np.where(goes, high[active], middle)
            place = begin + (run >> 1) * 2 * width + inside - run * width + low - other
            merged = order.copy()
            merged[place] = order[at]
            order = merged
            width *= 2
        extension = np.full(n, -1, np.int64)
        inner = np.flatnonzero(~new)
        extension[inner] = self.common(order[inner - 1], order[inner])
        if not self.verified(order[inner - 1], order[inner], extension[inner]):
            return self.sort_bytes(group, new)
        return order, extension

    def verified(self, a: np.ndarray, b: np.ndarray, common: np.ndarray) -> bool:
        """Whether the bytes agree wherever the hashes say so."""
        return bool((self.data[spread_ranges(self.start[a], common)] == self.data[spread_ranges(self.start[b], common)]).all())

    def sort_bytes(self, group: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same on the bytes themselves, for the case that hashes collided."""
        text = [self.data[s:s + n].tobytes() for s, n in zip(self.start, self.length)]
        order = np.array(sorted(range(len(text)), key=lambda i: (group[i], text[i])), np.int64)
        extension = np.full(len(text), -1, np.int64)
        for i in np.flatnonzero(~new):
            a, b = text[order[i - 1]], text[order[i]]
            both = min(len(a), len(b))
            extension[i] = next((j for j in range(both) if a[j] != b[j]), both)
        return order, extension


def _classes(order: np.ndarray, extension: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of suffixes that agree for ``depth`` bytes, by suffix."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(extension < depth)
    return out


def _least_by(kind: np.ndarray, least: np.ndarray) -> np.ndarray:
    _, inverse = np.unique(kind, return_inverse=True)
    best = np.full(inverse.max() + 1 if len(inverse) else 0, np.iinfo(U64).max, U64)
    np.minimum.at(best, inverse, least)
    return best[inverse]


def settle_segments(table: pa.Table, search: Search) -> pa.Table:
    """One bucket of regions: the least id of each window that some other region holds under a smaller id."""
    rows = table.to_pylist()
    if not rows:
        return message_table([])
    heads, bodies = [], []
    for row in rows:
        n = int.from_bytes(row["payload"][:4], "little")
        size = n * (4 + H_BYTES + 8 + 4)
        heads.append(unpack(row["payload"][4:4 + size], 4, H_BYTES, 8, 4))
        bodies.append(row["payload"][4 + size:])
    index, h, least, length = [np.concatenate(x) for x in zip(*heads)]
    part = np.repeat(np.arange(len(rows)), [len(x[0]) for x in heads])
    length = length.astype(np.int64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.cumsum(length) - length
    order = np.argsort(h, kind="stable")
    index, h, least, length, part, begin = (x[order] for x in (index, h, least, length, part, begin))
    data = data[spread_ranges(begin, length)]
    begin = np.cumsum(length) - length
    _, group = np.unique(h, return_inverse=True)
    # Where each region holds the k-gram. Windows of a region that holds it once are ordered by what lies on both sides of it.
    grams = mix(Prefix(BYTE_VALUES[data]).runs(search.k)) >> U64(24)
    owner = np.repeat(np.arange(len(begin)), length)[:len(grams)]
    place = np.arange(len(grams))
    places = np.flatnonzero((grams == h[owner]) & (place + search.k <= begin[owner] + length[owner]))
    held = np.bincount(owner[places], minlength=len(begin))
    anchor = np.zeros(len(begin), np.int64)
    anchor[owner[places]] = places
    count = length - search.width + 1
    once = (held == 1) & (anchor >= begin + count - 1) & (anchor + search.k <= begin + search.width)
    plain = np.ones(group.max() + 1, bool)
    plain[group[~once]] = False
    who, offset, best = [], [], []

    chosen = np.flatnonzero(plain[group])
    if len(chosen):
        right = Suffixes(data, anchor[chosen], begin[chosen] + length[chosen] - anchor[chosen]).sort(group[chosen])
        left = Suffixes(data[::-1], len(data) - anchor[chosen], anchor[chosen] - begin[chosen]).sort(group[chosen])
        ahead = anchor[chosen] - begin[chosen]
        for depth in range(search.width - search.k + 1):
            on = np.flatnonzero((ahead >= depth) & (ahead - depth < count[chosen]))
            if len(on):
                kind = _classes(*right, search.width - depth)[on] * (len(chosen) + 1) + _classes(*left, depth)[on]
                who.append(chosen[on])
                offset.append(ahead[on] - depth)
                best.append(_least_by(kind, least[chosen[on]]))

    rest = np.flatnonzero(~plain[group])
    if len(rest):
        starts = spread_ranges(begin[rest], count[rest])
        whose = np.repeat(rest, count[rest])
        sorted_windows = Suffixes(data, starts, np.full(len(starts), search.width)).sort(group[whose])
        who.append(whose)
        offset.append(starts - begin[whose])
        best.append(_least_by(_classes(*sorted_windows, search.width), least[whose]))

    who, offset, best = (np.concatenate(x) for x in (who, offset, best))
    smaller = best < least[who]
    who, offset, best = who[smaller], offset[smaller], best[smaller]
    out = []
    for p in np.unique(part[who]):
        own = part[who] == p
        out.append((rows[p]["to"], rows[p]["part"], 3, pack((index[who[own]], 4), (offset[own], 4), (best[own], 8))))
    return message_table(out)


def _finish(ids: pa.ChunkedArray, texts: pa.ChunkedArray, part) -> pa.Table:
    removed, spans, kept = [], [], []
    data, offsets = text_buffers(texts)
    marks = {block.first_row: marked for block, marked in part.marked()} if part else {}
    for first, last in blocks(offsets):
        own, limits = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        marked = marks.get(first)
        raw = own.tobytes()
        for i in range(last - first):
            a, b = limits[i], limits[i + 1]
            gone = marked[a:b] if marked is not None else None
            if gone is None or not gone.any():
                removed.append(0)
                spans.append([])
                kept.append(raw[a:b])
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            removed.append(int(gone.sum()))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            kept.append(own[a:b][~gone].tobytes())
    return pa.table([
        ids.cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary()),
    ], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: bytes, removed bytes, the maximal removed spans (byte offsets, end exclusive) and the kept bytes.

    A byte of the UTF-8 text goes if it lies in a string of ``length`` bytes that also starts in a document with
    a smaller id. Matches never cross documents, overlapping strings count, and strings are judged on the input.
    What is kept need not be valid UTF-8, so it is binary.

    Null texts count as empty: no bytes, no spans. Texts shorter than ``length`` lose nothing. Rows with equal
    ids never remove from each other, exact copies under a larger id lose everything, a null id neither gives
    nor takes. An empty table gives no rows; other columns are not read. Regions that agree wholly are settled
    by 91 bits of hashes; regions that agree in part are sorted and verified on their bytes, or, where more
    than 256 regions surround one k-gram, compared by 64-bit window hashes. A task holds one part of the
    documents and about thirty times its longest text.
    """
    if length < 2:
        raise ValueError("a string has two bytes or more")
    k = max(1, min(24, length // 2))
    return mark_repeats(docs, id_col, text_col, Search(length, k, byte_blocks, settle_segments), _finish, SCHEMA)
