"""Helpers that several operators share: sizes, folds, stored intermediates, text buffers in tasks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written as a table in the shared scratch folder and read again: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, part_mb: int = 8) -> int:
    """How many parts to deal rows to: the shuffle width, or more where a part would exceed ``part_mb``."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = math.ceil(size / (part_mb << 20)) if size < 1 << 60 else 1
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % 5


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the n + 1 offsets between them. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each; a row is never cut."""
    out, first = [], 0
    n = len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        out.append((first, last))
        first = last
    return out


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+`` in joined texts, and the text it is in.

    Texts end words too: a word never spans two texts.
    """
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1
