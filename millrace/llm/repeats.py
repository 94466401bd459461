"""Which fixed-length windows of a text also start in a document with a smaller id.

Used on bytes and on words. The windows of all documents together are many times the text, so they are
not shuffled one by one:

1. Every window contains one least k-gram hash, the same wherever the window occurs. Neighbouring windows
   with the same least hash form a *run*; a run's region is the stretch of tokens its windows cover. About
   one window in ``(width - k) / 2`` starts a run.
2. Each part of the documents sends its distinct runs (hash, region hash, least doc id). Where a k-gram
   hash has one region only, equal runs are equal window for window, and the least id settles all of them.
3. Where a k-gram hash has several regions, their windows may still agree in part. Those regions alone are
   compared window by window: ``compare`` receives their tokens' bytes or window hashes.
4. The answers go back to the parts, which recompute their runs from the text and mark the windows.

Parts and buckets grow with the data, and a run that many documents share is sent once per part, so no key
gathers in one task. Answers are by run, not by document: repeated ids do no harm, and equal ids never
remove from each other. A row without an id neither removes nor is removed from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, parts_for, text_buffers, word_bounds
from millrace.llm.hashing import BYTE_VALUES, U64, Prefix, mix, sliding_min, spread_ranges, word_hashes

SIGN = U64(1 << 63)
H_BYTES, R_BYTES = 5, 6
BY_BYTES, BY_HASH = 1, 2
MOST_SEGMENTS = 256
MESSAGE = "to int, part int, kind int, payload binary"


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Unsigned columns as byte planes, the lowest ``size`` bytes of each: sorted or small values compress well."""
    planes = [np.ascontiguousarray(c, U64).view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes() for c, size in columns]
    return b"".join(planes)


def unpack(payload: bytes, *sizes: int) -> list[np.ndarray]:
    raw, out, at = np.frombuffer(payload, np.uint8), [], 0
    n = len(raw) // sum(sizes)
    for size in sizes:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :size] = raw[at:at + n * size].reshape(size, n).T
        out.append(wide.view(U64).reshape(-1))
        at += n * size
    return out


def ordered(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers in the same order."""
    return ids.astype(np.int64).view(U64) ^ SIGN


@dataclass
class Block:
    """Some documents of a part as one token sequence; ``edges`` are the documents' limits in it."""

    first_row: int
    tokens: np.ndarray
    edges: np.ndarray


def byte_blocks(texts: pa.ChunkedArray) -> Iterator[Block]:
    data, offsets = text_buffers(texts)
    for first, last in blocks(offsets):
        yield Block(first, BYTE_VALUES[data[offsets[first]:offsets[last]]], offsets[first:last + 1] - offsets[first])


def word_blocks(texts: pa.ChunkedArray) -> Iterator[Block]:
    data, offsets = text_buffers(texts)
    for first, last in blocks(offsets):
        limits = offsets[first:last + 1] - offsets[first]
        own = data[offsets[first]:offsets[last]]
        starts, stops, row = word_bounds(own, limits)
        yield Block(first, word_hashes(own, starts, stops), np.searchsorted(row, np.arange(last - first + 1)))


@dataclass(frozen=True)
class Search:
    """``segments`` sends the regions to compare as bytes; without it every window of them is sent as a hash."""

    width: int
    k: int
    read: Callable[[pa.ChunkedArray], Iterator[Block]]
    segments: Callable[[pa.Table, Search], pa.Table] | None = None

    def runs(self, block: Block):
        """First and last window start, document and two hashes of every run of the block."""
        n = len(block.tokens) - self.width + 1
        if n <= 0:
            return None
        prefix = Prefix(block.tokens)
        least = sliding_min(prefix.runs(self.k), self.width - self.k + 1)
        ends = np.repeat(block.edges[1:], np.diff(block.edges))[:n]
        fits = np.arange(self.width, n + self.width) <= ends
        changes = np.ones(n + 1, bool)
        changes[1:n] = (least[1:] != least[:-1]) | (fits[1:] != fits[:-1]) | (ends[1:] != ends[:-1])
        limits = np.flatnonzero(changes)
        first, last = limits[:-1], limits[1:] - 1
        keep = fits[first]
        first, last = first[keep], last[keep]
        row = np.searchsorted(block.edges, first, "right") - 1 + block.first_row
        region = mix(prefix.between(first, last + self.width) + (last - first).astype(U64))
        return first, last, row, mix(least[first]), region


class Part:
    """The distinct runs of one part, in an order that depends on the part's texts alone."""

    def __init__(self, search: Search, ids: pa.ChunkedArray, texts: pa.ChunkedArray, buckets: int):
        self.search, self.buckets, self.texts = search, buckets, texts
        known = ids.is_valid().to_numpy()
        self.ids = ordered(ids.fill_null(0).to_numpy())
        self.blocks: list[Block] = []
        found = []
        for block in search.read(texts):
            runs = search.runs(block)
            if runs is None:
                continue
            keep = known[runs[2]]
            found.append([x[keep] for x in runs])
            self.blocks.append(block)
        self.cuts = np.concatenate([[0], np.cumsum([len(f[0]) for f in found], dtype=np.int64)]).astype(np.int64)
        empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, U64)] * 2
        self.first, self.last, self.row, h, region = [np.concatenate(x) for x in zip(*found)] if found else empty
        # One sort by both hashes: 40 bits of the first above 24 of the second. Ties are sorted out in full.
        h >>= U64(24)
        key = (h << U64(24)) | (region >> U64(40))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        if (same & (region[order][1:] != region[order][:-1])).any():
            order = np.lexsort((region, key))
            same = key[order][1:] == key[order][:-1]
        new = np.ones(len(order), bool)
        new[1:] = ~(same & (region[order][1:] == region[order][:-1]))
        starts = np.flatnonzero(new)
        self.kind = np.empty(len(order), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        self.example = order[starts]
        self.h, self.region = h[self.example], region[self.example] >> U64(64 - 8 * R_BYTES + 1)
        doc = self.ids[self.row[order]]
        self.least = self.least_here = np.minimum.reduceat(doc, starts) if len(starts) else np.zeros(0, U64)
        self.many = self.least < np.maximum.reduceat(doc, starts) if len(starts) else np.zeros(0, bool)
        self.bucket_cuts = np.searchsorted(self.h, bucket_limits(buckets))

    def offers(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket: hash, region hash with a mark for several ids in its lowest bit, least id."""
        region = (self.region << U64(1)) | self.many.astype(U64)
        for b, (i, j) in enumerate(zip(self.bucket_cuts[:-1], self.bucket_cuts[1:])):
            if j > i:
                yield b, pack((self.h[i:j], H_BYTES), (region[i:j], R_BYTES), (self.least[i:j], 8))

    def settle(self, messages: list[tuple[int, bytes]]) -> None:
        """Take in the least id of each run anywhere, and how the windows of those still open are compared."""
        self.least = self.least_here.copy()
        self.route = np.zeros(len(self.h), np.int8)
        for bucket, payload in messages:
            index, least, route = unpack(payload, 4, 8, 1)
            at = self.bucket_cuts[bucket] + index.astype(np.int64)
            self.least[at] = least
            self.route[at] = route
        self.open = np.flatnonzero(self.route)
        example = self.example[self.open]
        self.count = self.last[example] - self.first[example] + 1
        self.offset = np.zeros(len(self.h), np.int64)
        self.offset[self.open] = np.cumsum(self.count) - self.count
        self.slot_least = np.repeat(self.least_here[self.open], self.count)

    def open_windows(self) -> np.ndarray:
        """Hash of every window of the runs to be compared by hash: distinct and sorted."""
        hashes, slots = [], []
        example = self.example[self.open]
        by_hash = self.route[self.open] == BY_HASH
        for b, (i, j) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            here = np.flatnonzero(by_hash & (example >= i) & (example < j))
            if len(here):
                starts = spread_ranges(self.first[example[here]], self.count[here])
                prefix = Prefix(self.blocks[b].tokens)
                hashes.append(mix(prefix.between(starts, starts + self.search.width)))
                slots.append(spread_ranges(self.offset[self.open[here]], self.count[here]))
        self.slots = np.concatenate(slots) if slots else np.zeros(0, np.int64)
        windows, self.window = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, U64), return_inverse=True)
        self.window_least = np.full(len(windows), np.iinfo(U64).max, U64)
        np.minimum.at(self.window_least, self.window, self.slot_least[self.slots])
        return windows

    def open_segments(self) -> Iterator[tuple[int, bytes]]:
        """Per bucket: index, hash, least id, length and bytes of the regions to be compared as they are."""
        data, offsets = text_buffers(self.texts)
        kinds = self.open[self.route[self.open] == BY_BYTES]
        example = self.example[kinds]
        begin = np.array([offsets[b.first_row] for b in self.blocks], np.int64)[np.searchsorted(self.cuts, example, "right") - 1] + self.first[example]
        length = self.last[example] - self.first[example] + self.search.width
        limits = np.searchsorted(kinds, self.bucket_cuts)
        for b, (i, j) in enumerate(zip(limits[:-1], limits[1:])):
            if j > i:
                index = (kinds[i:j] - self.bucket_cuts[b]).astype(U64)
                head = pack((index, 4), (self.h[kinds[i:j]], H_BYTES), (self.least_here[kinds[i:j]], 8), (length[i:j].astype(U64), 4))
                yield b, int(j - i).to_bytes(4, "little") + head + data[spread_ranges(begin[i:j], length[i:j])].tobytes()

    def marked(self) -> Iterator[tuple[Block, np.ndarray]]:
        """Per block: which tokens lie in a window that starts under a smaller id."""
        self.slot_least[self.slots] = np.minimum(self.slot_least[self.slots], self.window_least[self.window])
        for b, block in enumerate(self.blocks):
            here = slice(self.cuts[b], self.cuts[b + 1])
            first, last, kind, doc = self.first[here], self.last[here], self.kind[here], self.ids[self.row[here]]
            whole = self.least[kind] < doc
            some = np.flatnonzero(~whole & (self.route[kind] > 0))
            count = last[some] - first[some] + 1
            starts = spread_ranges(first[some], count)
            starts = starts[self.slot_least[spread_ranges(self.offset[kind[some]], count)] < np.repeat(doc[some], count)]
            size = len(block.tokens) + 1
            edge = np.bincount(np.concatenate([first[whole], starts]), minlength=size)
            edge -= np.bincount(np.concatenate([last[whole], starts]) + self.search.width, minlength=size)[:size]
            yield block, np.cumsum(edge[:-1]) > 0


def bucket_limits(buckets: int) -> np.ndarray:
    """Where the buckets of 40-bit hashes begin, and the end of the last."""
    return np.array([((b << 40) + buckets - 1) // buckets for b in range(buckets + 1)], U64)


def _messages(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    return [(r["to"], r["payload"]) for r in table.to_pylist() if r["kind"] == kind]


def message_table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["to", "part", "kind", "payload"])


def _settle_runs(table: pa.Table, most_segments: int) -> pa.Table:
    """One bucket: answers for the runs that other parts have too, or that share a k-gram hash with another region."""
    rows = table.to_pylist()
    if not rows:
        return message_table([])
    bucket = rows[0]["to"]
    sent = [unpack(r["payload"], H_BYTES, R_BYTES, 8) for r in rows]
    sizes = [len(s[0]) for s in sent]
    h, region, least = [np.concatenate(x) for x in zip(*sent)]
    many, region = (region & U64(1)).astype(bool), region >> U64(1)
    # Only hashes that occur twice need a look.
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    at = at[np.lexsort((region[at], h[at]))]
    new_h = np.ones(len(at), bool)
    new_h[1:] = h[at][1:] != h[at][:-1]
    new_run = new_h.copy()
    new_run[1:] |= region[at][1:] != region[at][:-1]
    if len(at):
        by_run, by_h = np.cumsum(new_run) - 1, np.cumsum(new_h) - 1
        run_least = np.minimum.reduceat(least[at], np.flatnonzero(new_run))[by_run]
        h_first = np.flatnonzero(new_h)
        regions = np.add.reduceat(new_run.astype(np.int64), h_first)[by_h]
        ids_differ = (np.minimum.reduceat(least[at], h_first) != np.maximum.reduceat(least[at], h_first)) | np.logical_or.reduceat(many[at], h_first)
        # Under larger ids than its least one a run is settled by that; the least one alone stands for its region.
        several = (regions > 1) & ids_differ[by_h] & (run_least == least[at])
        route = np.where(several, np.where(regions > most_segments, BY_HASH, BY_BYTES), 0)
        useful = several | (run_least < least[at])
        at, run_least, route = at[useful], run_least[useful], route[useful]
    else:
        run_least, route = least[at], at
    part = np.repeat(np.arange(len(rows)), sizes)[at]
    index = (np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[at]
    out = []
    for p in np.unique(part):
        own = part == p
        out.append((bucket, rows[p]["part"], 1, pack((index[own], 4), (run_least[own], 8), (route[own], 1))))
    return message_table(out)


def _settle_windows(table: pa.Table) -> pa.Table:
    """One bucket of window hashes: the least id of each, for the parts that know only a larger one."""
    rows = table.to_pylist()
    if not rows:
        return message_table([])
    bucket = rows[0]["to"]
    sent = [unpack(r["payload"], 8, 8) for r in rows]
    sizes = [len(s[0]) for s in sent]
    value, least = [np.concatenate(x) for x in zip(*sent)]
    _, kind = np.unique(value, return_inverse=True)
    best = np.full(kind.max() + 1 if len(kind) else 0, np.iinfo(U64).max, U64)
    np.minimum.at(best, kind, least)
    at = np.flatnonzero(best[kind] < least)
    part = np.repeat(np.arange(len(rows)), sizes)[at]
    index = (np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[at]
    best = best[kind][at]
    out = []
    for p in np.unique(part):
        own = part == p
        out.append((bucket, rows[p]["part"], 2, pack((index[own], 4), (best[own], 8))))
    return message_table(out)


def _window_cuts(windows: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by hash range, so that sorted windows need no further sort."""
    limits = np.array([(b << 64) // buckets for b in range(1, buckets)], U64)
    return np.concatenate([[0], np.searchsorted(windows, limits), [len(windows)]]).astype(np.int64)


def mark_repeats(docs: DataFrame, id_col: str, text_col: str, search: Search, finish: Callable, schema: str) -> DataFrame:
    """Run the search and hand each part, with its marked blocks, to ``finish``.

    ``finish(ids, texts, part)`` gets the Arrow columns of one part and the settled ``Part``, and returns an
    Arrow table of ``schema``.
    """
    buckets = parts_for(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")).repartition(buckets, "part")

    most_segments = MOST_SEGMENTS if search.segments else 0

    def offer(table: pa.Table) -> pa.Table:
        part = Part(search, table["id"], table["text"], buckets)
        number = table["part"][0].as_py()
        return message_table([(b, number, 0, payload) for b, payload in part.offers()])

    def ask(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return message_table([])
        part = Part(search, table["id"], table["text"], buckets)
        part.settle(_messages(answers, 1))
        number = table["part"][0].as_py()
        windows = part.open_windows()
        cuts = _window_cuts(windows, buckets)
        out = [
            (b, number, BY_HASH, pack((windows[i:j], 8), (part.window_least[i:j], 8))) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i
        ]
        if search.segments:
            out += [(b, number, BY_BYTES, payload) for b, payload in part.open_segments()]
        return message_table(out)

    def compare(table: pa.Table) -> pa.Table:
        out = [_settle_windows(table.filter(pc.equal(table["kind"], BY_HASH)))]
        if search.segments:
            out.append(search.segments(table.filter(pc.equal(table["kind"], BY_BYTES)), search))
        return pa.concat_tables(out)

    def close(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return finish(table["id"], table["text"], None)
        part = Part(search, table["id"], table["text"], buckets)
        part.settle(_messages(answers, 1))
        cuts = _window_cuts(part.open_windows(), buckets)
        for bucket, payload in _messages(answers, 2):
            index, least = unpack(payload, 4, 8)
            part.window_least[cuts[bucket] + index.astype(np.int64)] = least
        for bucket, payload in _messages(answers, 3):
            index, place, least = unpack(payload, 4, 4, 8)
            slot = part.offset[part.bucket_cuts[bucket] + index.astype(np.int64)] + place.astype(np.int64)
            part.slot_least[slot] = least
        return finish(table["id"], table["text"], part)

    first = rows.groupBy("part").applyInArrow(offer, MESSAGE)
    first = first.groupBy("to").applyInArrow(lambda table: _settle_runs(table, most_segments), MESSAGE)
    second = rows.groupBy("part").cogroup(first.groupBy("part")).applyInArrow(ask, MESSAGE).groupBy("to").applyInArrow(compare, MESSAGE)
    answers = first.unionByName(second)
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(close, schema)
