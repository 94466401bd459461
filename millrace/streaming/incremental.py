"""Change feeds, high-water-mark appends and incremental refresh on Structured Streaming.

A table's directory is the change stream, the query checkpoint is its offset, and an
``availableNow`` run is one scheduled task run. Every sink here is idempotent: a batch that is
replayed after a failure overwrites its own ``batch=<id>`` folder, so nothing is added twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.versions import children, exists


def change_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000,
                  **options) -> DataFrame:
    """Rows added to a Parquet directory since the consuming query last ran."""
    return spark.readStream.schema(schema).options(maxFilesPerTrigger=files_per_batch, **options).parquet(path)


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def load_once(spark: SparkSession, inbox: str, out: str, state: str, schema: T.StructType, purge: bool = False) -> None:
    """Load each file of ``inbox`` into ``out`` exactly once; ``purge`` deletes consumed files."""
    options = {"cleanSource": "delete"} if purge else {}
    stream = change_stream(spark, inbox, schema, **options)
    run_to_files(stream, out, state)


def run_to_files(stream: DataFrame, out: str, state: str, every: str | None = None):
    """Append a streaming frame to a Parquet directory with an exactly-once commit log."""
    started = (
        stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(**_trigger(every)).start(out)
    )
    if every is None:
        started.awaitTermination()
    return started


def run_batches(stream: DataFrame, state: str, handle: Callable[[DataFrame, int], None], every: str | None = None):
    """Call ``handle(rows, batch_id)`` for each batch that has rows.

    Without ``every`` it handles what is there and returns, as one run of a scheduled task would.
    """

    def guarded(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            if not rows.isEmpty():
                handle(rows, batch_id)
        finally:
            rows.unpersist()

    started = stream.writeStream.option("checkpointLocation", state).foreachBatch(guarded).trigger(**_trigger(every)).start()
    if every is None:
        started.awaitTermination()
    return started


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent batch sink."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """All rows of a batch sink; the batch number is the ``batch`` column."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(full).parquet(path)
    return rows if upto is None else rows.where(F.col("batch") <= upto)


def append_children(keys: DataFrame, batch_id: int, tables: dict[str, tuple[DataFrame, str]], key: str, out: str) -> None:
    """For each new parent row, append its rows of each child table.

    ``tables`` maps an output name to (child frame, child key). Keys are made unique first, so a
    parent delivered twice in one batch does not double its children; the join is an ordinary
    equi-join, broadcast only if the optimizer finds the batch small enough.
    """
    fresh = keys.select(F.col(key).alias("_key")).distinct()
    for name, (child, child_key) in tables.items():
        write_batch(child.join(fresh, child[child_key] == F.col("_key"), "left_semi"), f"{out}/{name}", batch_id)


def append_new(spark: SparkSession, source: DataFrame, ts: str, target: str, now) -> int:
    """High-water-mark append of source rows with ``mark < ts <= now``; returns the run number.

    The mark of a run is committed as a one-row file after its rows are written. A run that died
    in between is repeated under its own number and overwrites what it had written.
    """
    marks = f"{target}/marks"
    # Newest first: one listing, and as a rule one look for a commit, however many runs there were.
    started = sorted((int(c.split("=")[1]) for c in children(spark, marks)), reverse=True)
    last = next((n for n in started if exists(spark, f"{marks}/run={n}/_SUCCESS")), None)
    run = 0 if last is None else last + 1
    moment = F.lit(str(now)).cast(source.schema[ts].dataType)
    rows = source.where(F.col(ts) <= moment)
    if last is not None:
        mark = spark.read.parquet(f"{marks}/run={last}").first()["mark"]
        rows = rows.where(F.col(ts) > F.lit(str(mark)).cast(source.schema[ts].dataType))
    else:
        mark = None
    write_batch(rows, f"{target}/rows", run)
    seen = spark.read.schema(source.schema).parquet(f"{target}/rows/batch={run}").agg(F.max(ts).alias("mark"))
    old = F.lit(None if mark is None else str(mark)).cast(source.schema[ts].dataType)
    seen.select(F.coalesce("mark", old).alias("mark")).coalesce(1).write.mode("overwrite").parquet(f"{marks}/run={run}")
    return run


def preload(source: DataFrame, ts: str, now) -> tuple[DataFrame, DataFrame]:
    """Rows of the past for the first load, and the rest for later appends. ``now`` is passed in."""
    moment = F.lit(str(now)).cast(source.schema[ts].dataType)
    return source.where(F.col(ts) < moment), source.where(F.col(ts) >= moment)


ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """State of the streams started inside lies on local disk, keyed, with its changes in the checkpoint; a session that
    names a state store keeps its own. A stream keeps the settings that it was first started with."""
    own = {} if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider") else ROCKSDB
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class FeatureRefresh:
    """Keeps a per-key feature table up to date from a stream of new rows.

    ``features`` is one grouped aggregation by ``keys``. What it has summed up per key (counts, sums, extremes,
    sketches) is kept in Spark's state store below the root: a batch reads its own rows and the state of their keys, never
    older rows, and writes the features of those keys. The state's partitions are fixed by the first run and
    stored with the checkpoint, so later sessions may have any shuffle width. ``history`` holds rows from before the stream;
    they are written below the root once and enter the state in the first run. ``then`` adds dependent
    views that are refreshed from the new feature rows in the same batch.

    Each ``compact_every`` batches the newest rows of all keys are written as a new base, from which reading goes on.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], features: Callable[[DataFrame], DataFrame],
                 history: DataFrame | None = None, compact_every: int = 16):
        self.spark, self.root, self.keys, self.features = spark, root.rstrip("/"), list(keys), features
        self.compact_every = compact_every
        self.dependents: list[tuple[str, Callable[[DataFrame], DataFrame]]] = []
        self.schemas: dict[str, T.StructType] = {}
        if exists(spark, f"{self.root}/history"):
            raise ValueError(f"{self.root} holds a history of rows, not keyed state: start a new root")
        if history is not None and not exists(spark, f"{self.root}/seed/_SUCCESS"):
            if exists(spark, f"{self.root}/state"):
                raise ValueError("history has to be there before the first run")
            history.write.mode("overwrite").parquet(f"{self.root}/seed")

    def then(self, name: str, derive: Callable[[DataFrame], DataFrame]) -> FeatureRefresh:
        self.dependents.append((name, derive))
        return self

    def handle(self, fresh: DataFrame, batch_id: int) -> None:
        """Stores the new feature rows of a batch and what derives from them. A repeated batch overwrites its own folder."""
        self._store("features", fresh, batch_id)
        for name, derive in self.dependents:
            done = self.spark.read.schema(self.schemas["features"]).parquet(f"{self.root}/features/batch={batch_id}")
            self._store(name, derive(done), batch_id)

    def _store(self, name: str, rows: DataFrame, batch_id: int) -> None:
        self.schemas[name] = rows.schema
        write_batch(rows, f"{self.root}/{name}", batch_id)
        if batch_id % self.compact_every == self.compact_every - 1:
            self.current(name).write.mode("overwrite").parquet(f"{self.root}/base/{name}/upto={batch_id}")

    def run(self, stream: DataFrame, every: str | None = None):
        """One run over what is there, or with ``every`` a running query that looks again at that interval."""
        if exists(self.spark, f"{self.root}/seed/_SUCCESS"):
            stream = change_stream(self.spark, f"{self.root}/seed", stream.schema).unionByName(stream)
        fresh = self.features(stream)
        writer = fresh.writeStream.outputMode("update").option("checkpointLocation", f"{self.root}/state")
        with keyed_state(self.spark):
            started = writer.foreachBatch(self.handle).trigger(**_trigger(every)).start()
        if every is None:
            started.awaitTermination()
        return started

    def current(self, name: str = "features") -> DataFrame:
        """The newest row of every key: the last base, and the batches after it."""
        path, spark = f"{self.root}/{name}", self.spark
        if name not in self.schemas:  # written by an earlier run
            stored = spark.read.parquet(path).schema
            self.schemas[name] = T.StructType([f for f in stored if f.name != "batch"])
        schema = self.schemas[name]
        bases = sorted((int(c.split("=")[1]) for c in children(spark, f"{self.root}/base/{name}")), reverse=True)
        base = next((n for n in bases if exists(spark, f"{self.root}/base/{name}/upto={n}/_SUCCESS")), -1)
        late = [c for c in children(spark, path) if c.startswith("batch=") and int(c.split("=")[1]) > base]
        rows = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
        if late:
            rows = spark.read.schema(rows.schema).option("basePath", path).parquet(*[f"{path}/{c}" for c in late])
        if base >= 0:
            rows = rows.unionByName(spark.read.schema(schema).parquet(f"{self.root}/base/{name}/upto={base}").withColumn("batch", F.lit(base).cast("long")))
        values = F.struct(*[c for c in schema.names if c not in self.keys])
        newest = rows.groupBy(*self.keys).agg(F.max_by(values, F.col("batch")).alias("_v"))
        return newest.select(*self.keys, "_v.*")
