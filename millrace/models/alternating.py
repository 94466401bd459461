"""Alternating least squares over blocks of users and items.

Each side's ratings are packed into chunks, sorted by the vector they fit, and stay on disk with the block of that vector.
A half step sends every vector of the other side once to each block that rates it. A task keeps the vectors sent to it in a
mapped temporary file and reads its chunks one at a time, so its memory does not grow with its block.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import ensure_checkpoint_dir

# Ratings of one packed chunk, about eight bytes each; a vector with more has several chunks.
CHUNK_RATINGS = 131_072
# Ratings whose vectors are sorted together, on average.
RANGE_RATINGS = 1_000_000
VECTORS, RATINGS, FITTED = 0, 1, 2
FACTORS = "id int, features array<float>"


@dataclass(frozen=True)
class Half:
    """What a task needs to know to fit one side's vectors from the other's, and to send them back."""

    rank: int
    reg: float
    blocks: int
    others: int
    seed: int
    send: bool = True
    keep: bool = False


def first_vectors(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """A random direction for each id, from a hash of the id, so that no layout changes it."""
    x = (ids.astype(np.uint64)[:, None] * np.uint64(2 * rank) + np.arange(2 * rank, dtype=np.uint64)
         + np.uint64(seed * 0xD1342543DE82EF95 % 2**64))
    x += np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53
    normal = np.sqrt(-2 * np.log1p(-u[:, :rank])) * np.cos(2 * np.pi * u[:, rank:])
    return (normal / np.maximum(np.linalg.norm(normal, axis=1, keepdims=True), 1e-300)).astype(np.float32)


def _pack(chunk: int):
    """Sorted ratings as chunks of about so many; a chunk never holds vectors of two blocks."""
    schema = pa.schema([("block", pa.int32()), *((c, pa.binary()) for c in ("ids", "counts", "others", "ratings"))])

    def chunks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, to, other, rating = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(4))
        edges = (np.flatnonzero(np.diff(block)) + 1).tolist()
        for a, b in zip([0, *edges], [*edges, len(block)]):
            ids, counts = np.unique(to[a:b], return_counts=True)
            row = [int(block[a]), ids.tobytes(), counts.astype(np.int32).tobytes(), other[a:b].tobytes(), rating[a:b].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += [batch.slice(x, chunk) for x in range(0, batch.num_rows, chunk)]
            if sum(b.num_rows for b in held) >= chunk:
                yield from chunks(held)
                held = []
        if held:
            yield from chunks(held)

    return run


def _by_block(key: int) -> int:
    return key


def packed(numbered: DataFrame, to: str, other: str, rating: str, blocks: int, width: int, chunk: int = CHUNK_RATINGS) -> RDD:
    """(block, (RATINGS, ids, counts, others, ratings)) of one side, kept on disk in the partition of the block.

    Ids are sorted by ranges of ``width``.
    """
    rows = numbered.select(F.col(to).cast("int").alias("to"), F.col(other).cast("int").alias("other"), F.col(rating).cast("float").alias("rating"))
    ranges = rows.repartition(F.floor(F.col("to") / F.lit(width))).select(F.pmod("to", F.lit(blocks)).alias("block"), "to", "other", "rating")
    chunks = ranges.sortWithinPartitions("block", "to", "other", "rating").mapInArrow(
        _pack(chunk), "block int, ids binary, counts binary, others binary, ratings binary")
    return chunks.rdd.map(lambda r: (r[0], (RATINGS, *(bytes(v) for v in r[1:])))).partitionBy(blocks, _by_block).persist(StorageLevel.DISK_ONLY)


def normal_equations(x: np.ndarray, counts: np.ndarray, ratings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the outer products and of the rated vectors of each run of ``counts`` rows, runs of one length together."""
    rank, starts = x.shape[1], np.concatenate([[0], np.cumsum(counts)[:-1]])
    gram, right = np.empty((len(counts), rank, rank)), np.empty((len(counts), rank))
    order = np.argsort(counts, kind="stable")
    cuts = np.flatnonzero(np.diff(counts[order])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(order)]):
        runs = order[a:b]
        rows = starts[runs][:, None] + np.arange(counts[runs[0]])
        part = x[rows]
        turned = part.transpose(0, 2, 1)
        gram[runs] = turned @ part
        right[runs] = (turned @ ratings[rows][:, :, None])[:, :, 0]
    return gram, right


def solved(gram: np.ndarray, right: np.ndarray, counts: np.ndarray, reg: float) -> np.ndarray:
    """Least squares with a penalty that grows with the number of ratings."""
    penalty = (reg * counts)[:, None, None] * np.eye(right.shape[1])
    return np.linalg.solve(gram + penalty, right[:, :, None])[:, :, 0].astype(np.float32)


def _sent(half: Half, block: int, ids: np.ndarray, vectors: np.ndarray, rates: np.ndarray) -> Iterator[tuple]:
    """Each vector once for every block that rates it; ids as steps, which compress."""
    for to in range(half.blocks if half.send else 0):
        if (mine := rates[:, to]).any():
            yield to, (VECTORS, np.diff(ids[mine], prepend=np.int32(0)).astype(np.int32).tobytes(), vectors[mine].tobytes())
    if half.keep:
        yield block, (FITTED, ids.tobytes(), vectors.tobytes())


def _rating_blocks(others: np.ndarray, counts: np.ndarray, blocks: int) -> np.ndarray:
    rates = np.zeros((len(counts), blocks), bool)
    rates[np.repeat(np.arange(len(counts)), counts), others % blocks] = True
    return rates


def _first(half: Half):
    def run(block: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, (_, ids, counts, others, _) in rows:
            ids, counts, others = (np.frombuffer(v, np.int32) for v in (ids, counts, others))
            yield from _sent(half, block, ids, first_vectors(ids, half.rank, half.seed), _rating_blocks(others, counts, half.blocks))

    return run


def _fit(half: Half):
    def run(block: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        parts: dict[int, list] = {}
        rated = False
        with tempfile.TemporaryFile() as file:
            file.truncate(max(1, half.others) * half.rank * 4)
            known = np.memmap(file, np.float32, "r+", shape=(max(1, half.others), half.rank))
            for _, (kind, ids, *data) in rows:
                ids = np.frombuffer(ids, np.int32)
                if kind == VECTORS:
                    if rated:
                        raise RuntimeError("a vector came after ratings")
                    known[np.cumsum(ids)] = np.frombuffer(data[0], np.float32).reshape(-1, half.rank)
                if kind != RATINGS:
                    continue
                rated = True
                (counts, others), ratings = (np.frombuffer(v, np.int32) for v in data[:2]), np.frombuffer(data[2], np.float32)
                gram, right = normal_equations(known[others].astype(np.float64), counts, ratings.astype(np.float64))
                rates = _rating_blocks(others, counts, half.blocks)
                # The outer two may have ratings in other chunks too.
                for i in {0, len(ids) - 1}:
                    parts.setdefault(int(ids[i]), []).append((int(others[0]), int(counts[i]), gram[i].copy(), right[i].copy(), rates[i].copy()))
                inner = slice(1, -1)
                if len(ids) > 2:
                    yield from _sent(half, block, ids[inner], solved(gram[inner], right[inner], counts[inner], half.reg), rates[inner])
            del known
        if parts:
            ids = np.array(sorted(parts), np.int32)
            # In an order of their own, so that sums do not hang on how chunks arrive.
            pieces = [zip(*sorted(parts[i], key=lambda p: p[:2])) for i in ids.tolist()]
            counts, gram, right, rates = (np.array(v) for v in zip(*([sum(v) for v in list(p)[1:]] for p in pieces)))
            yield from _sent(half, block, ids, solved(gram, right, counts, half.reg), rates > 0)

    return run


def _unpacked(rank: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(ids, np.int32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(ids) + 1, dtype=np.int32) * rank), pa.array(np.frombuffer(vectors, np.float32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["id", "features"])

    return run


def _table(numbered: DataFrame, rows: RDD, rank: int) -> DataFrame:
    spark = numbered.sparkSession
    fitted = rows.filter(lambda r: r[1][0] == FITTED).map(lambda r: (r[1][1], r[1][2]))
    return spark.createDataFrame(fitted, "ids binary, vectors binary").mapInArrow(_unpacked(rank), FACTORS).checkpoint()


def fit(numbered: DataFrame, user: str, item: str, rating: str, rank: int = 10, iterations: int = 10, reg: float = 0.1,
        seed: int = 0, blocks: int = 4, chunk: int = CHUNK_RATINGS) -> tuple[DataFrame, DataFrame]:
    """(id, features) of users and of items, in ``blocks`` partitions each.

    Ids are whole numbers from 0 on, with few gaps. In every iteration first the items, then the users become the least
    squares solutions given the other side, with ``reg`` times the number of ratings as penalty. Sums are in double
    precision, vectors are stored as floats. Repeated rows each count. But for rounding, the vectors depend on the rows and
    ``seed`` only, not on their partitioning, ``blocks`` or ``chunk``.
    """
    ensure_checkpoint_dir(numbered.sparkSession)
    value = F.col(rating).cast("double")
    unknown = F.count_if(value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf"))))
    n, users, items, bad = numbered.agg(F.count("*"), F.max(user) + 1, F.max(item) + 1, unknown).first()
    if not n or bad or iterations < 1:
        raise ValueError("no ratings" if not n else f"{bad} ratings are NULL, NaN or infinite" if bad else "iterations must be 1 or more")
    by_user, by_item = (
        packed(numbered, to, other, rating, blocks, math.ceil(ids * RANGE_RATINGS / n), chunk)
        for to, other, ids in ((user, item, users), (item, user, items)))

    def fitted(sent: RDD, own: RDD, half: Half) -> RDD:
        # Dealt alike, both sides' partitions of a block become one, which reads the vectors first.
        both = sent.union(own)
        if both.getNumPartitions() != own.getNumPartitions():
            raise RuntimeError("vectors and ratings are not dealt alike")
        return both.mapPartitionsWithIndex(_fit(half))

    try:
        to_items = by_user.mapPartitionsWithIndex(_first(Half(rank, reg, blocks, items, seed))).partitionBy(blocks, _by_block)
        for left in reversed(range(iterations)):
            to_users = fitted(to_items, by_item, Half(rank, reg, blocks, users, seed, keep=not left)).partitionBy(blocks, _by_block)
            of_users = fitted(to_users, by_user, Half(rank, reg, blocks, items, seed, send=left > 0, keep=not left))
            to_items = of_users.partitionBy(blocks, _by_block)
        # The last iteration's items lie among the vectors sent to the users, so they are not fitted twice.
        return _table(numbered, of_users, rank), _table(numbered, to_users, rank)
    finally:
        by_user.unpersist()
        by_item.unpersist()
