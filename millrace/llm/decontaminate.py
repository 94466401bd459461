"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import empty_frame

SEED_TOKENS = 5
COVERAGE = 0.8
BLOCK_TOKENS = 200_000
SCHEMA = (
    "doc_id long, item_id long, n_tokens int, covered int, coverage double, "
    "tiles array<struct<doc_start:int,item_start:int,length:int>>"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_tokens", pa.int32()), ("covered", pa.int32()), ("coverage", pa.float64()),
    ("tiles", pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))),
])
_WORD = re.compile(r"\w+")
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _free_stretches(marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Stretches of unmarked tokens that are ``size`` long at least."""
    start = 0
    for i in range(len(marked) + 1):
        if i == len(marked) or marked[i]:
            if i - start >= size:
                yield start, i
            start = i + 1


def _rolling(tokens: list[int], stretches: Iterator[tuple[int, int]], size: int) -> Iterator[tuple[int, int]]:
    """Running Karp-Rabin hash of every window of the stretches, with its start."""
    drop = pow(_BASE, size - 1, _MOD)
    for first, last in stretches:
        value = 0
        for i in range(first, last):
            if i - first >= size:
                value = (value - tokens[i - size] * drop) % _MOD
            value = (value * _BASE + tokens[i]) % _MOD
            if i - first >= size - 1:
                yield value, i - size + 1


def _matches(item: list[int], doc: list[int], item_marked: list[bool], doc_marked: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal common unmarked runs of ``size`` tokens or more, as (length, item start, doc start)."""
    index = defaultdict(list)
    for value, at in _rolling(item, _free_stretches(item_marked, size), size):
        index[value].append(at)
    found = {}
    for value, d in _rolling(doc, _free_stretches(doc_marked, size), size):
        for i in index.get(value, ()):
            if i and d and not item_marked[i - 1] and not doc_marked[d - 1] and item[i - 1] == doc[d - 1]:
                continue  # part of a longer run that starts before it
            length = 0
            while (
                i + length < len(item) and d + length < len(doc) and not item_marked[i + length] and not doc_marked[d + length]
                and item[i + length] == doc[d + length]
            ):
                length += 1
            if length >= size:
                found[(i, d)] = length
    return sorted(((n, i, d) for (i, d), n in found.items()), key=lambda m: (-m[0], m[1], m[2]))


def tile(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: non-overlapping common runs, longest first, as (doc start, item start, length).

    Runs are looked for from long to short. A pass that meets a run of twice its length or more is repeated at
    that run's length, so longer runs are marked first. Equal lengths go by item, then by document position.
    """
    item_marked, doc_marked = [False] * len(item), [False] * len(doc)
    tiles, size = [], max(least, min(len(item), len(doc)) // 2)
    while size >= least:
        found = _matches(item, doc, item_marked, doc_marked, size)
        if found and found[0][0] >= 2 * size:
            size = found[0][0]
            continue
        while found:
            again = False
            for length, i, d in found:
                if any(item_marked[i:i + length]) or any(doc_marked[d:d + length]):
                    again = True
                    continue
                item_marked[i:i + length] = [True] * length
                doc_marked[d:d + length] = [True] * length
                tiles.append((d, i, length))
            # What is left of overlapped runs may still be long enough for this pass.
            found = _matches(item, doc, item_marked, doc_marked, size) if again else []
        size = size // 2 if size >= 2 * least else least if size > least else 0
    return sorted(tiles)


class Items:
    """A block of benchmark items, with their seeds: the runs of ``seed`` tokens that occur in them."""

    def __init__(self, rows: list[tuple[int, str | None]], seed: int):
        self.vocabulary: dict[str, int] = {}
        self.seed, self.short = seed, defaultdict(set)
        self.ids, self.items = [], []
        self.seeds: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item_id, text in rows:
            words = tokens(text)
            if not words:
                continue
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            number = len(self.items)
            self.ids.append(item_id)
            self.items.append(codes)
            size = min(seed, len(codes))
            for i in range(len(codes) - size + 1):
                self.seeds[tuple(codes[i:i + size])].add(number)
        self.sizes = sorted({len(s) for s in self.seeds})

    def places(self, codes: list[int]) -> dict[int, list[int]]:
        """Where the document shares a seed with each item."""
        out = defaultdict(list)
        for size in self.sizes:
            run = 0
            for at, code in enumerate(codes):
                run = run + 1 if code else 0
                if run >= size:
                    for number in self.seeds.get(tuple(codes[at - size + 1:at + 1]), ()):
                        out[number].append(at - size + 1)
        return out

    def leaks(self, text: str | None, coverage: float) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
        """Items of which the document holds the share ``coverage`` at least: (id, tokens, covered, tiles)."""
        codes = [self.vocabulary.get(w, 0) for w in tokens(text)]
        for number, places in self.places(codes).items():
            item = self.items[number]
            # Only text within an item's length of a seed can be part of a run with one.
            near, real, reach = [], [], len(item)
            for at in places:
                first = max(at - reach, real[-1] + 1 if real else 0)
                if real and first > real[-1] + 1:
                    near.append(-1)
                    real.append(first - 1)
                for i in range(first, min(at + reach, len(codes))):
                    near.append(codes[i] or -1)
                    real.append(i)
            tiles = tile(item, near, min(self.seed, len(item)))
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(item):
                yield self.ids[number], len(item), covered, [(real[d], i, n) for d, i, n in tiles]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[int, str | None]]]:
    """The items, a block of about ``most`` tokens at a time; the driver holds one block."""
    block, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(id_col).isNotNull()).distinct().toLocalIterator():
        block.append(tuple(row))
        size += len(row[1] or "") // 4 + 1
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", seed: int = SEED_TOKENS, coverage: float = COVERAGE, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document and benchmark item of which the document holds ``coverage`` or more of the tokens.

    Tokens are lower-cased words. A document that shares a run of ``seed`` tokens with an item is tiled: the
    longest common runs are marked, each token once, until no run of ``seed`` tokens is left. So passages that
    were cut and put into another order still count in full. Items shorter than ``seed`` must occur whole.

    The benchmark is a query set held against all documents, ``block_tokens`` tokens at a time (a bounded
    broadcast); documents are not shuffled. Null and empty texts and items give no rows, nor do items without
    an id; repeated documents give repeated rows, repeated items count once; two texts under one item id are
    two items. A null document id is kept. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _item_blocks(benchmark, item_id_col, item_text_col, block_tokens):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, seed)
            for batch in batches:
                found = [
                    {"doc_id": doc_id, "item_id": item_id, "n_tokens": n, "covered": covered, "coverage": covered / n,
                     "tiles": [{"doc_start": d, "item_start": i, "length": size} for d, i, size in tiles]}
                    for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                    for item_id, n, covered, tiles in items.leaks(text, coverage)
                ]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=_ARROW)

        part = rows.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else empty_frame(spark, SCHEMA)
