"""Substring deduplication by Rabin-Karp hashes of fixed-length token windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import blocks, text_buffers, word_bounds
from millrace.llm.repeats import Search, mark_repeats, word_blocks

WINDOW_WORDS = 50
SCHEMA = "doc_id long, n_words long, n_removed long, intervals array<struct<first:int,last:int>>, kept binary"
_INTERVALS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _finish(ids: pa.ChunkedArray, texts: pa.ChunkedArray, part) -> pa.Table:
    total, removed, intervals, kept = [], [], [], []
    marks = {block.first_row: marked for block, marked in part.marked()} if part else {}
    data, offsets = text_buffers(texts)
    for first, last in blocks(offsets):
        own, limits = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        starts, stops, row = word_bounds(own, limits)
        cuts = np.searchsorted(row, np.arange(last - first + 1))
        marked = marks.get(first, np.zeros(len(starts), bool))
        raw = own.tobytes()
        for i in range(last - first):
            a, b = cuts[i], cuts[i + 1]
            gone = marked[a:b]
            n = int(gone.sum())
            total.append(int(b - a))
            removed.append(n)
            if n == 0:
                intervals.append([])
                kept.append(b" ".join(raw[limits[i]:limits[i + 1]].split()))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            intervals.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edge[::2], edge[1::2])])
            # Words between removed intervals stay together, so they are cut out of the text in stretches.
            stay = np.concatenate([[0], edge, [b - a]]) + a
            kept.append(b" ".join(b" ".join(raw[starts[x]:stops[y - 1]].split()) for x, y in zip(stay[::2], stay[1::2]) if y > x))
    return pa.table([
        ids.cast(pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(intervals, _INTERVALS), pa.array(kept, pa.binary()),
    ], names=["doc_id", "n_words", "n_removed", "intervals", "kept"])


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """Per row: words, removed words, the maximal removed intervals (word numbers, both ends in) and the kept words.

    A word goes if it lies in a run of ``window`` consecutive words whose sequence also starts in a document
    with a smaller id. Rabin-Karp hashes of the windows are grouped in Spark: first by run of windows that
    share their least k-gram, then one by one where a k-gram occurs in different surroundings; overlapping
    repeated windows merge into one interval.

    Null texts and texts without words have zero words and empty bytes as ``kept``; shorter texts than a
    window lose nothing. Rows with equal ids never remove from each other, exact copies under a larger id lose
    everything, a null id neither gives nor takes. An empty table gives no rows; other columns are not read.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    k = max(1, min(16, window // 2))
    return mark_repeats(docs, id_col, text_col, Search(window, k, word_blocks), _finish, SCHEMA)
