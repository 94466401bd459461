"""Near duplicates among embeddings by E8 lattice hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.llm.components import components

MIN_COSINE = 0.98
TABLES = 6
PROBES = 6
CELL = 0.7
SHARD = 1024


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries +-1, or all entries +-1/2 with an even number of minus signs."""
    pairs = [(i, j, a, b) for i, j in combinations(range(8), 2) for a, b in product((1, -1), repeat=2)]
    whole = np.zeros((len(pairs), 8))
    for row, (i, j, a, b) in enumerate(pairs):
        whole[row, i], whole[row, j] = a, b
    halves = np.array([s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0])
    return np.concatenate([whole, halves])


NEIGHBOURS = _minimal_vectors()


def _nearest_d8(points: np.ndarray) -> np.ndarray:
    """Nearest integer vectors with an even sum."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    error = points[odd] - near[odd]
    worst = np.abs(error).argmax(axis=1)
    near[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 shifted by one half."""
    whole, half = _nearest_d8(points), _nearest_d8(points - 0.5) + 0.5
    closer = ((points - half) ** 2).sum(axis=1) < ((points - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def _keys(cells: np.ndarray) -> np.ndarray:
    """One long per lattice point."""
    doubled = np.rint(cells * 2).astype(np.int64)
    key = np.zeros(doubled.shape[:-1], np.int64)
    for i in range(8):
        key = key * np.int64(1_000_003) + doubled[..., i]
    return key


def lattice_keys(units: np.ndarray, tables: int, probes: int, cell: float, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Home cell per vector and table, and the neighbouring cells nearest to its projection, nearest first."""
    random = np.random.default_rng(seed)
    home = np.zeros((len(units), tables), np.int64)
    probed = np.zeros((len(units), tables, probes), np.int64)
    for t in range(tables):
        points = units @ random.standard_normal((units.shape[1], 8)) / cell + random.random(8)
        near = nearest_e8(points)
        home[:, t] = _keys(near)
        # |p - c - v|^2 differs between neighbours v by -2 (p - c).v + |v|^2, and all |v|^2 are 2.
        gain = (points - near) @ NEIGHBOURS.T
        chosen = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        probed[:, t] = _keys(near[:, None, :] + NEIGHBOURS[chosen])
    return home, probed


def _roots(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id that each row reaches over the links."""
    root = ids.copy()
    while True:
        reached = np.minimum(root, np.where(links, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (reached == root).all():
            return root
        root = reached


def _compare(table: pa.Table, number: int, min_cosine: float) -> pa.Table:
    """Links within one pair of shards of a cell: per vector their weight, and the least id they lead to."""
    ids, weight, role, side = (np.array(table[c]) for c in ("rep", "copies", "home", "side"))
    units = np.stack(table["unit"].to_numpy(zero_copy_only=False)).astype(np.float64)
    homes = np.stack(table["homes"].to_numpy(zero_copy_only=False))
    probes = np.stack(table["probes"].to_numpy(zero_copy_only=False)).reshape(len(ids), homes.shape[1], -1)
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1) if (side == 1).any() else a
    linked = (units[a] @ units[b].T >= min_cosine) & (role[a][:, None] | role[b][None, :]) & (ids[a][:, None] != ids[b][None, :])

    def meet(t: int) -> np.ndarray:
        out = homes[a, t][:, None] == homes[b, t][None, :]
        for p in range(probes.shape[2]):
            out |= probes[a, t, p][:, None] == homes[b, t][None, :]
            out |= homes[a, t][:, None] == probes[b, t, p][None, :]
        return out

    # A pair counts in its first table, and there in the cell that is home to both or else to its lesser id.
    for t in range(number):
        if not linked.any():
            break
        linked &= ~meet(t)
    cell = np.array(table["cell"])[0]
    if linked.any():
        both = homes[a, number][:, None] == homes[b, number][None, :]
        at_a, at_b = homes[a, number] == cell, homes[b, number] == cell
        first = np.where(ids[a][:, None] < ids[b][None, :], at_a[:, None], at_b[None, :])
        lesser_probed = np.where(
            ids[a][:, None] < ids[b][None, :],
            (probes[b, number][None, :, :] == homes[a, number][:, None, None]).any(axis=2),
            (probes[a, number][:, None, :] == homes[b, number][None, :, None]).any(axis=2),
        )
        linked &= both | first | ~lesser_probed
    rows = np.concatenate([a, b]) if b is not a else a
    counts = np.concatenate([linked @ weight[b], linked.T @ weight[a]]) if b is not a else linked @ weight[b]
    if b is not a:
        square = np.zeros((len(rows), len(rows)), bool)
        square[:len(a), len(a):], square[len(a):, :len(a)] = linked, linked.T
    else:
        square = linked
    some = np.flatnonzero(counts > 0)
    root = _roots(square[np.ix_(some, some)], ids[rows[some]])
    return pa.table({"rep": ids[rows[some]], "n": counts[some].astype(np.int64), "root": root})


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", min_cosine: float = MIN_COSINE,
    tables: int = TABLES, probes: int = PROBES, cell: float = CELL, shard: int = SHARD,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per vector; vectors link if their labels are equal and their cosine is
    ``min_cosine`` or more.

    Unit vectors are projected to eight dimensions and decoded to the nearest point of the E8 lattice, in several
    tables with projections of their own. A pair is compared where the home cell of one is the home cell of the other
    or among its ``probes`` nearest neighbouring cells; every pair compared is verified in double precision and counted
    once. A cell of over ``shard`` vectors is cut into shards, each pair of shards in a task of its own. Of the links
    in a task, counts and as many as connect its vectors are returned, never all pairs. Equal vectors of a label are
    one row with a count.

    Null, empty and zero vectors, those with null or non-finite components and those without a label link with
    nothing; vectors of different lengths never link. A repeated row counts as one vector; an id with several vectors
    stands for the first by label, then by vector. A null id stays in its row and links with nothing. An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    ordinary = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ordinary & some)
    usable = usable.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    usable = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("own")).select("vec_id", "own.*")
    reps = stored(usable.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            for i, n in enumerate(batch["size"].to_pylist()):
                by_size.setdefault(n, []).append(i)
            for chosen in by_size.values():
                for at in range(0, len(chosen), 2048):
                    own = batch.take(pa.array(chosen[at:at + 2048]))
                    raw = np.stack(own["vector"].to_numpy(zero_copy_only=False)).astype(np.float64)
                    raw /= np.abs(raw).max(axis=1, keepdims=True)
                    units = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                    home, probed = lattice_keys(units, tables, probes, cell)
                    yield pa.RecordBatch.from_pydict({
                        "rep": own["rep"], "copies": own["copies"], "label": own["label"], "size": own["size"],
                        "unit": pa.array(list(units), pa.list_(pa.float64())), "homes": pa.array(list(home), pa.list_(pa.int64())),
                        "probes": pa.array(list(probed.reshape(len(home), -1)), pa.list_(pa.int64())),
                    })

    label_type = reps.schema["label"].dataType.simpleString()
    hashed = stored(reps.withColumn("size", F.size("vector")).mapInArrow(
        hash_rows, f"rep long, copies long, label {label_type}, size int, unit array<double>, homes array<long>, probes array<long>"), "lattice")

    # Cells first, without vectors: only cells with a home vector and another vector go on.
    at_home = hashed.select("rep", "label", "size", F.posexplode("homes").alias("number", "cell"), F.lit(True).alias("home"))
    around = hashed.select("rep", "label", "size", F.posexplode("probes").alias("place", "cell")).select(
        "rep", "label", "size", F.floor(F.col("place") / probes).cast("int").alias("number"), "cell", F.lit(False).alias("home"))
    members = at_home.unionByName(around)
    key = ["label", "size", "number", "cell"]
    sizes = members.groupBy(*key).agg(F.count("*").alias("members"), F.max("home").alias("held")).where("held and members > 1")
    dealt = members.join(sizes, key).withColumn("shards", F.ceil(F.col("members") / shard)).withColumn("shard", F.pmod(F.xxhash64("rep"), "shards"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    pairs = dealt.select(*key, "rep", "home", "shard", other.alias("other")).select(
        *key, "rep", "home", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"),
        F.when(F.col("shard") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    full = pairs.join(hashed.select("rep", "copies", "unit", "homes", "probes"), "rep")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        return _compare(table, key[2].as_py(), min_cosine)

    found = full.select(*key, "low", "high", "rep", "copies", "home", "side", "unit", "homes", "probes").groupBy(*key, "low", "high").applyInArrow(
        compare, "rep long, n long, root long")
    found = stored(found, "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found.where("rep <> root"), "rep", "root")
    settled = reps.join(counts, "rep", "left").join(joined, reps["rep"] == joined["node"], "left").select(
        "label", "vector", F.col("rep").alias("least"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    best = usable.join(settled, ["label", "vector"]).select(F.col("vec_id").alias("named"), "n_links", "component_id")
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    return ids.join(best, F.col("vec_id") == F.col("named"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
