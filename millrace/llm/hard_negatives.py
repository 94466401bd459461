"""Hard negatives by anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster, rows are sorted once by an upper bound of their inner product with any unit
vector in the cluster: the norm times the cosine of what is left of the angle to the centre after taking
off the cluster's widest angle. Every anchor of the cluster walks this list, and stops where its own norm times the bound
falls below what it still needs: then no later row can enter its result, which is exact.

On Spark the rows are dealt to cells by their nearest centre, large cells to several shards, and a list is sorted
per cluster and shard. An anchor first walks the shards of its own cell; what it found there is the bar for the others, and it
is sent only to cells whose bound reaches that bar. The results of its shards are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

CENTRES = 32
SAMPLE_ANCHORS = 20_000
SHARD_ROWS = 100_000
ANCHOR_ROWS = 20_000
STEP = 1024
LOWEST, HIGHEST = -(1 << 62), 1 << 62
_ROWS = "cell int, id long, label {label}, vector array<long>, norm double, angle double"
_FOUND = "anchor long, place int, id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as ``floor(scale * x)`` in double precision; null if one is null or not finite, or the vector is."""
    ordinary = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ordinary, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _stack(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of one array; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(vectors.astype(np.float64), axis=1)
    return vectors / np.where(norms > 0, norms, 1.0)[:, None], norms


def _centres(sample: np.ndarray, most: int, rounds: int = 8) -> np.ndarray:
    """Directions of clusters of the sample, by a few rounds of spherical k-means."""
    units, norms = _units(sample)
    units = np.unique(units[norms > 0], axis=0)
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    centres = units[np.linspace(0, len(units) - 1, min(most, len(units))).astype(int)]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        sums, sizes = _units(sums)
        centres = np.where(sizes[:, None] > 0, sums, centres)
    return centres


def _bound(angle: np.ndarray, widest: np.ndarray | float) -> np.ndarray:
    """The greatest cosine left at ``angle`` from a centre whose members lie up to ``widest`` from it."""
    return np.cos(np.maximum(angle - widest - 1e-7, 0.0)) + 1e-9


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by doubles where these are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class _Best:
    """The first ``most`` rows of each slot, by score, then id."""

    def __init__(self, slots: int, most: int):
        self.slots, self.most = slots, most
        self.slot = self.id = self.score = np.zeros(0, np.int64)
        self.bar = np.full(slots, LOWEST)

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, ids, score = np.append(self.slot, slot), np.append(self.id, ids), np.append(self.score, score)
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        begins = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - begins
        stays = rank < self.most
        self.slot, self.id, self.score = slot[stays], ids[stays], score[stays]
        last = rank == self.most - 1
        self.bar[slot[last]] = score[last]


def _walk(rows: dict, bounds: np.ndarray, anchors: dict, same_label: bool, most: int) -> _Best:
    """Members of one cluster walk a shared list, sorted by ``bounds``, greatest first. One slot per member and window."""
    n, windows = anchors["low"].shape
    best = _Best(n * windows, most)
    need = np.maximum(anchors["low"], anchors["bar"])
    for at in range(0, len(bounds), STEP):
        bar = np.maximum(need, best.bar.reshape(n, windows))
        open_ = (bar <= anchors["high"]) & (anchors["norm"][:, None] * bounds[at] + 1e-3 >= bar)
        active = np.flatnonzero(open_.any(axis=1))
        if not len(active):
            break
        some = slice(at, at + STEP)
        scores = _products(anchors["vector"][active], rows["vector"][some])
        label = anchors["label"][active][:, None] == rows["label"][some][None, :]
        allowed = (label & (anchors["id"][active][:, None] != rows["id"][some][None, :])) if same_label else ~label
        for w in range(windows):
            enters = allowed & (scores >= bar[active, w][:, None]) & (scores <= anchors["high"][active, w][:, None])
            a, r = np.nonzero(enters)
            best.add(active[a] * windows + w, rows["id"][some][r], scores[a, r])
    return best


def _shard_walk(centres: np.ndarray, same_label: bool, most: int):
    def walk(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """All anchors sent to one shard, cluster by cluster."""
        out = [np.zeros((0, 4), np.int64)]
        if rows.num_rows and anchors.num_rows:
            # A repeated row is one row; it has reached the same shard.
            labels = {v: i for i, v in enumerate(dict.fromkeys(rows["label"].to_pylist() + anchors["label"].to_pylist()))}
            vectors = _stack(rows["vector"], centres.shape[1])
            ids = rows["id"].to_numpy()
            label = np.array([labels[v] for v in rows["label"].to_pylist()], np.int64)
            _, once = np.unique(np.column_stack([ids, label, vectors]), axis=0, return_index=True)
            ids, label, vectors = ids[once], label[once], vectors[once]
            units, norms = _units(vectors)
            cluster = anchors["cluster"].to_numpy()
            anchor_label = np.array([labels[v] for v in anchors["label"].to_pylist()], np.int64)
            anchor_vectors = _stack(anchors["vector"], centres.shape[1])
            width = len(anchors["low"][0].as_py())
            own = {c: np.array(anchors[c].combine_chunks().flatten()).reshape(-1, width) for c in ("low", "high", "bar")}
            names, anchor_ids, anchor_norms, angles = (anchors[c].to_numpy() for c in ("anchor", "id", "norm", "angle"))
            for c in np.unique(cluster):
                member = np.flatnonzero(cluster == c)
                bounds = norms * _bound(np.arccos(np.clip(units @ centres[c], -1, 1)), angles[member].max())
                order = np.argsort(-bounds, kind="stable")
                # The same label's rows are a list of their own, so that positives do not walk past the others.
                groups = [(member[anchor_label[member] == v], order[label[order] == v]) for v in np.unique(anchor_label[member])] if same_label else [(member, order)]
                for some, listed in groups:
                    best = _walk(
                        {"vector": vectors[listed], "id": ids[listed], "label": label[listed]}, bounds[listed],
                        {"vector": anchor_vectors[some], "id": anchor_ids[some], "label": anchor_label[some], "norm": anchor_norms[some], **{k: v[some] for k, v in own.items()}},
                        same_label, most)
                    out.append(np.column_stack([names[some][best.slot // width], best.slot % width, best.id, best.score]))
        anchor, place, found, score = np.concatenate(out).T
        return pa.table({"anchor": anchor, "place": place.astype(np.int32), "id": found, "score": score})

    return walk


class _Search:
    """Rows in cells, and walks of anchors over them."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, centres: np.ndarray, shard_rows: int, anchor_rows: int):
        self.spark, self.centres = rows.sparkSession, centres
        self.anchor_rows = anchor_rows
        label = rows.schema["label"].dataType.simpleString()
        held = self.spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                units, norms = _units(_stack(batch["vector"], held.value.shape[1]))
                close = units @ held.value.T
                cell = close.argmax(axis=1)
                angle = np.arccos(np.clip(close[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), batch["id"], batch["label"], batch["vector"], pa.array(norms), pa.array(angle)],
                    names=["cell", "id", "label", "vector", "norm", "angle"])

        schema = _ROWS.format(label=label)
        self.rows = stored(rows.mapInArrow(assign, schema), "negative-rows")
        placed = anchors.mapInArrow(assign, schema).withColumnRenamed("cell", "cluster")
        self.anchors = stored(placed.dropDuplicates(["id", "label", "vector"]).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
        cells = self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("norm").alias("norm"), F.max("angle").alias("angle")).collect()
        self.cells = {r["cell"]: (r["norm"], r["angle"], -(-r["n"] // shard_rows)) for r in cells}  # as many as there are centres

    def _routes(self, windows: DataFrame, home: bool) -> DataFrame:
        """Each anchor once for every cell that may hold a row it needs: its own, or all others."""
        centres, cells = self.centres, self.cells

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            targets = np.array(sorted(cells), np.int32)
            norm, widest = (np.array([cells[c][i] for c in targets.tolist()]) for i in (0, 1))
            for batch in batches:
                units, _ = _units(_stack(batch["vector"], centres.shape[1]))
                own = np.asarray(batch["cluster"])[:, None] == targets
                if home:
                    go = own
                else:
                    low, high, bar = (np.stack(batch[c].to_numpy(zero_copy_only=False)) for c in ("low", "high", "bar"))
                    bar = np.maximum(low, bar)
                    least = np.where(bar <= high, bar, np.inf).min(axis=1)
                    angle = np.arccos(np.clip(units @ centres[targets].T, -1, 1))
                    reach = np.asarray(batch["norm"])[:, None] * norm * _bound(angle, widest) + 1e-3
                    go = ~own & (reach >= least[:, None]) & np.isfinite(least)[:, None]
                a, c = np.nonzero(go)
                yield pa.RecordBatch.from_arrays([batch["anchor"].take(pa.array(a)), pa.array(targets[c])], names=["anchor", "cell"])

        full = self.anchors.join(windows, "anchor")
        return full.select("anchor", "cluster", "vector", "norm", "low", "high", "bar").mapInArrow(route, "anchor long, cell int")

    def walk(self, windows: DataFrame, home: bool, same_label: bool, most: int) -> DataFrame:
        """``(anchor, place, id, score)``: per shard, the first rows of each of the anchor's windows."""
        routes = stored(self._routes(windows, home), "routes")
        blocks = {r["cell"]: -(-r["count"] // self.anchor_rows) for r in routes.groupBy("cell").count().collect()}
        if not blocks:
            return self.spark.createDataFrame([], _FOUND)
        shards = F.create_map(*[F.lit(x) for c in blocks for x in (c, self.cells[c][2])])
        parts = F.create_map(*[F.lit(x) for c, n in blocks.items() for x in (c, n)])
        every = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
        sent = routes.join(self.anchors, "anchor").join(windows, "anchor").withColumn("block", F.pmod(F.xxhash64("anchor"), parts[F.col("cell")]).cast("int"))
        sent = sent.withColumn("shard", every(shards[F.col("cell")]))
        dealt = self.rows.where(F.col("cell").isin(*blocks)).withColumn("shard", F.pmod(F.xxhash64("id"), shards[F.col("cell")]).cast("int"))
        dealt = dealt.withColumn("block", every(parts[F.col("cell")]))
        key = ["cell", "shard", "block"]
        found = dealt.select(*key, "id", "label", "vector").groupBy(*key).cogroup(
            sent.select(*key, "anchor", "id", "label", "vector", "cluster", "norm", "angle", "low", "high", "bar").groupBy(*key)
        ).applyInArrow(_shard_walk(self.centres, same_label, most), _FOUND)
        return stored(found, "found")

    def first(self, windows: DataFrame, same_label: bool, most: int) -> DataFrame:
        """The first ``most`` rows in each window of each anchor, over all cells, with their ``rank``."""
        near = _ranked(self.walk(windows, True, same_label, most), most)
        bars = near.where(F.col("rank") == most).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("bars"))
        raised = windows.join(bars, "anchor", "left").select(
            "anchor", "low", "high",
            F.transform("low", lambda low, i: F.coalesce(F.col("bars")[i], F.lit(LOWEST))).alias("bar"))
        far = self.walk(stored(raised, "windows"), False, same_label, most)
        return stored(_ranked(near.drop("rank").unionByName(far), most), "first")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(
    vectors: DataFrame, anchors: str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
    positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
    centres: int = CENTRES, sample_anchors: int = SAMPLE_ANCHORS, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition that picks anchors among the rows. A row's score is its integer inner product with the anchor, of
    components ``floor(scale * x)``; greater scores come first, then smaller ids. An anchor's positives are its first
    ``positives`` other rows of its label. For each, the first ``negatives`` rows of another label follow whose score is
    ``window`` percent of the positive's, both ends included. Results are exact for any number of centres and shards.

    ``centres`` directions are fitted on at most ``sample_anchors`` anchors (the first by a hash); all rows are searched.
    Rows with a null id, label or vector, or a null or non-finite component, take no part. Shorter vectors
    end in zeros; zero vectors score 0. Another row is one with another id; rows that agree in id, label and vector are one
    row, and anchors of one id that differ are anchors of their own. Fewer positives or negatives than asked for are
    all there are; an anchor without either gives no rows, nor does an empty table. Other columns are read only
    by ``anchors``. Scores must fit a long.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), quantised(F.col(vector_col), scale).alias("vector"),
        F.coalesce(F.expr(anchors), F.lit(False)).alias("is_anchor")).where("vector is not null")
    rows, chosen = usable.drop("is_anchor"), usable.where("is_anchor").drop("is_anchor")
    width = usable.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        return _no_result(spark)
    sample = chosen.orderBy(F.xxhash64("id"), "id").limit(sample_anchors).select("vector").collect()
    if not sample:
        return _no_result(spark)
    padded = np.array([[*r["vector"], *[0] * (width - len(r["vector"]))] for r in sample], np.int64)
    search = _Search(rows, chosen, _centres(padded, centres), shard_rows, anchor_rows)

    whole = search.anchors.select(
        "anchor", F.array(F.lit(LOWEST)).alias("low"), F.array(F.lit(HIGHEST)).alias("high"), F.array(F.lit(LOWEST)).alias("bar"))
    liked = search.first(whole, True, positives).select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("place"))
    least, greatest = window
    # ceil(least * s / 100) and floor(greatest * s / 100) in integers.
    low = -F.floor(-F.col("positive_score").cast("decimal(38,0)") * least / 100)
    high = F.floor(F.col("positive_score").cast("decimal(38,0)") * greatest / 100)
    listed = liked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", low.cast("long").alias("low"), high.cast("long").alias("high")))).alias("w"))
    padding = lambda name, end: F.concat(F.col(f"w.{name}"), F.array_repeat(F.lit(end), F.lit(positives) - F.size("w")))
    # Missing positives get a window that nothing can enter.
    windows = stored(listed.select("anchor", padding("low", HIGHEST).alias("low"), padding("high", LOWEST).alias("high"), F.array_repeat(F.lit(LOWEST), positives).alias("bar")), "windows")
    hard = search.first(windows, False, negatives).select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = search.anchors.select("anchor", F.col("id").alias("anchor_id"))
    return hard.join(liked, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _no_result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
