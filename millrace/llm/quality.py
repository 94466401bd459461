"""Quality scores: a linear classifier on n-gram indicators scaled by class log-count ratios.

The indicators are hashed words, word pairs and pairs of word shapes with their neighbours. A feature's value
is the log of the ratio of its smoothed shares in the two classes; on these values a hinge-loss model is fitted
by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, fold, text_buffers, word_bounds
from millrace.llm.hashing import U64, mix, word_hashes

FEATURE_BITS = 18
MOST_ROWS = 8_000
ROUNDS = 12

# Character classes of bytes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 part of a longer character.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 1, 2, 3, 4


def text_features(data: np.ndarray, offsets: np.ndarray, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text: feature numbers in a row, and the limits between texts."""
    starts, stops, row = word_bounds(data, offsets)
    n_rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(n_rows + 1, np.int64)
    words = word_hashes(data, starts, stops)
    same_row = np.zeros(len(words), bool)
    same_row[1:] = row[1:] == row[:-1]
    again = np.zeros(len(words), bool)
    again[1:] = same_row[1:] & (words[1:] == words[:-1])
    size = np.minimum((stops - starts).astype(np.uint64) // U64(4), U64(7))
    shapes = (
        CLASS[data[starts]].astype(np.uint64) + CLASS[data[stops - 1]].astype(np.uint64) * U64(5)
        + CLASS[data[np.maximum(stops - 2, starts)]].astype(np.uint64) * U64(25) + size * U64(125) + again.astype(np.uint64) * U64(1000)
    )
    last = np.array(words[:-1], U64)
    pairs = mix(words[1:] * U64(3) + last * U64(0x9E3779B97F4A7C15))[same_row[1:]]
    shape_pairs = mix(shapes[1:] * U64(0x100000001) + shapes[:-1] + U64(1 << 60))[same_row[1:]]
    found = np.concatenate([words, pairs, mix(shapes + U64(1 << 62)), shape_pairs])
    owner = np.concatenate([row, row[1:][same_row[1:]], row, row[1:][same_row[1:]]]).astype(np.uint64)
    keys = np.unique((owner << U64(bits)) | (found >> U64(64 - bits)))
    return (keys & U64((1 << bits) - 1)).astype(np.int64), np.searchsorted(keys >> U64(bits), np.arange(n_rows + 1))


@dataclass
class Model:
    """``weights`` already hold the log-count ratios; the margin goes through a sigmoid ``slope * m + offset``."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, features: np.ndarray, limits: np.ndarray) -> np.ndarray:
        totals = np.concatenate([[0.0], np.cumsum(self.weights[features], dtype=np.float64)])
        counts = np.diff(limits)
        margins = (totals[limits[1:]] - totals[limits[:-1]]) / np.sqrt(np.maximum(counts, 1)) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, smoothing: float = 1.0) -> np.ndarray:
    counts = [smoothing + sum((np.bincount(r, minlength=size) for r, y in zip(rows, labels) if y == c), np.zeros(size)) for c in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, costs: np.ndarray, size: int, rounds: int, seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of ``min |w|^2 / 2 + sum cost * max(0, 1 - sign * margin)``, one dual variable at a time."""
    weights, bias = np.zeros(size), 0.0
    duals = np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1 for v in values])
    shuffle = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in shuffle.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(duals[i] - gradient / norms[i], 0.0), costs[i])
            step = (new - duals[i]) * signs[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                duals[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton steps on softened labels."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margins, np.ones(len(margins))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (target - p))
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def train(rows: list[np.ndarray], labels: np.ndarray, size: int, cost: float = 0.1, rounds: int = ROUNDS) -> Model:
    """Fit on four fifths, put the curve through the margins of the rest, then fit on all."""
    if len(rows) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(rows) + 2)
        return Model(np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))

    def solve(chosen: np.ndarray) -> tuple[np.ndarray, float]:
        some = [rows[i] for i in chosen]
        y = labels[chosen]
        ratios = log_count_ratios(some, y, size)
        values = [ratios[r] / np.sqrt(max(len(r), 1)) for r in some]
        share = np.array([(y == 0).mean(), (y == 1).mean()])
        costs = cost * 0.5 / np.maximum(share[y], 1e-9)
        weights, bias = dual_coordinate_descent(some, values, np.where(y == 1, 1.0, -1.0), costs, size, rounds)
        return weights * ratios, bias

    every = np.arange(len(rows))
    checked = every % 5 == 4
    if checked.any() and labels[checked].min() < labels[checked].max() and labels[~checked].min() < labels[~checked].max():
        weights, bias = solve(every[~checked])
        margins = np.array([weights[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + bias for i in every[checked]])
        slope, offset = fit_sigmoid(margins, labels[checked])
    else:
        slope, offset = 1.0, 0.0
    weights, bias = solve(every)
    return Model(weights, float(bias), slope, offset)


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most_rows: int = MOST_ROWS, bits: int = FEATURE_BITS,
) -> Model:
    """Fit on the labelled rows outside fold 0, at most ``most_rows`` of them, chosen by a hash of the id.

    The sample is a stated bound: one task reads it and fits. Labels other than 0 and 1 are not used, nor ids
    with both labels; an id with several texts counts with one of them. Without rows of both classes the model gives one score to all texts.
    """
    known = labels.select(F.col(id_col).alias("known_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where((fold("known_id") != 0) & F.col("label").isin(0, 1)).groupBy("known_id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    known = known.orderBy(F.xxhash64("known_id"), "known_id").limit(most_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("known_id"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                features, limits = text_features(*text_buffers(batch["text"]), bits)
                lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(features, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch["id"].cast(pa.int64()), batch["label"], lists], ["id", "label", "features"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        lists = [np.array(f.values) for f in table["features"]]
        model = train(lists, np.array(table["label"]).astype(np.int64), 1 << bits)
        packed = model.weights.astype(np.float32).tobytes()
        return pa.table({"weights": pa.array([packed], pa.binary()), "bias": [model.bias], "slope": [model.slope], "offset": [model.offset]})

    found = rows.select("id", "label", "text").mapInArrow(extract, "id long, label int, features array<int>")
    # Of several texts of one id the one with the least features, so that the model is the same under any partitioning.
    found = found.groupBy("id").agg(F.min(F.struct("label", "features")).alias("row")).select("id", "row.*")
    fitted = found.withColumn("every", F.lit(0)).groupBy("every").applyInArrow(fit, "weights binary, bias double, slope double, offset double").collect()
    if not fitted:
        return Model(np.zeros(1 << bits, np.float32), 0.0, 0.0, 0.0)
    row = fitted[0]
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["offset"])


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", bits: int = FEATURE_BITS) -> DataFrame:
    """``(doc_id, score)`` per row, from the whole text alone.

    Null and wordless texts get the score of a text without features. Repeated rows and null ids are scored like
    any other; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            scores = [
                own.scores(*text_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], bits)) for a, b in blocks(offsets, 1 << 19)
            ]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
