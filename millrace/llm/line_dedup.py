"""Reversible line deduplication: sharded cuckoo filters backed by exact reference-count tables.

The index counts, per line key, the documents that hold it. Keys of ``min_docs`` documents or more are *common*: each
shard's cuckoo filter holds their fingerprints. Inserting or deleting documents changes the counts; the keys that
cross the threshold are added to or deleted from the filters, and a filter that gets too full is rebuilt at
twice the size from the counts. The counts also settle what a filter wrongly claims: a shard lists the counted keys that
its filter holds by accident, so that filter and list together are exact for all documents of the index.

Everything lies below one folder. Every change is a generation of its own with the change of the counts and the new
filters; it counts once its last file is committed, and an unfinished one is overwritten by the next. Every
eighth generation, and any that needs more shards, holds the full counts, so that older ones need no longer be read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.hashing import U64, mix
from millrace.sources.versions import children, exists

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = 4
MOST_KICKS = 500
SHARD_KEYS = 1_000_000
FULL_EVERY = 8
BROADCAST_BYTES = 64 << 20
_COUNTS = "shard int, h1 long, h2 long, n long"
_FILTERS = "shard int, shards int, common long, slots binary, wrong binary"


def line_keys(text: Column) -> Column:
    """The key of each line: outer blanks stripped, A-Z in lower case. Null and empty texts are one empty line."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(lines, lambda line: F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER))


def _hash_pair(key: Column) -> Column:
    """128 bits: two independent 64-bit hashes. Among 10^12 keys two are equal with a chance of 10^-15."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class CuckooFilter:
    """Four slots a bucket, 32-bit fingerprints, 0 for an empty slot; a key has two buckets. Whole arrays at a time."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def holding(cls, h1: np.ndarray, h2: np.ndarray, least_buckets: int = 4) -> CuckooFilter:
        """A filter of these keys, with room to grow; as large as it takes."""
        buckets = max(least_buckets, 1 << int(np.ceil(np.log2(max(1.0, len(h1) / (0.7 * SLOTS))))))
        while True:
            found = cls(np.zeros(buckets * SLOTS, np.uint32))
            if found.insert(h1, h2):
                return found
            buckets *= 2

    @staticmethod
    def _places(h1: np.ndarray, h2: np.ndarray, masks: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first and second bucket of each key."""
        prints = (h2.view(U64) >> U64(32)).astype(np.uint32)
        prints[prints == 0] = 1
        first = mix(h1.view(U64).copy()) & masks
        return prints, first.astype(np.int64), ((first ^ mix(prints.astype(U64))) & masks).astype(np.int64)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """Adds one fingerprint per key. False if there is no room; the filter must then be rebuilt."""
        mask = len(self.slots) - 1
        prints, bucket, other = self._places(h1, h2, U64(mask))
        turn = 0
        for _ in range(MOST_KICKS):
            if not len(prints):
                return True
            # Keys that want one bucket take its free slots in turn; the rest try their other bucket, then push others out.
            order = np.argsort(bucket, kind="stable")
            prints, bucket, other = prints[order], bucket[order], other[order]
            begins = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            rank = np.arange(len(bucket)) - np.repeat(begins, np.diff(np.append(begins, len(bucket))))
            free = self.slots[bucket] == 0
            which = free.cumsum(axis=1) == (rank + 1)[:, None]
            slot = (which & free).argmax(axis=1)
            fits = (which & free).any(axis=1)
            self.slots[bucket[fits], slot[fits]] = prints[fits]
            prints, bucket, other = prints[~fits], bucket[~fits], other[~fits]
            if not len(prints):
                return True
            if turn:
                lead = np.concatenate([[True], bucket[1:] != bucket[:-1]])
                at = (mix(prints[lead].astype(U64) + U64(turn)) % U64(SLOTS)).astype(np.int64)
                pushed = self.slots[bucket[lead], at]
                self.slots[bucket[lead], at] = prints[lead]
                prints[lead] = pushed
                other[lead] = bucket[lead] ^ (mix(pushed.astype(U64)) & U64(mask)).astype(np.int64)
            bucket, other = other, bucket
            turn += 1
        return False

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Removes one fingerprint per key. The keys must have been inserted."""
        prints, first, second = self._places(h1, h2, U64(len(self.slots) - 1))
        for fingerprint, *buckets in zip(prints, first, second):
            for bucket in buckets:
                at = np.flatnonzero(self.slots[bucket] == fingerprint)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(h1, h2, U64(len(self.slots) - 1))
        return ((self.slots[first] == prints[:, None]) | (self.slots[second] == prints[:, None])).any(axis=1)


class _Shards:
    """The filters of all shards side by side, for lookups of keys of any shard at once."""

    def __init__(self, shards: int, rows: list):
        self.shards = shards
        sizes = np.full(shards, SLOTS, np.int64)
        for row in rows:
            sizes[row["shard"]] = len(row["slots"]) // 4
        self.base = np.concatenate([[0], np.cumsum(sizes // SLOTS)])
        self.masks = (sizes // SLOTS - 1).astype(U64)
        self.slots = np.zeros((int(self.base[-1]), SLOTS), np.uint32)
        wrong = [np.zeros((0, 2), np.int64)]
        for row in rows:
            at = row["shard"]
            self.slots[self.base[at]:self.base[at + 1]] = np.frombuffer(row["slots"], np.uint32).reshape(-1, SLOTS)
            wrong.append(np.frombuffer(row["wrong"], np.int64).reshape(-1, 2))
        self.wrong = {(int(a), int(b)) for a, b in np.concatenate(wrong)}

    def common(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not len(h1):
            return np.zeros(0, bool)
        shard = h1 % self.shards
        prints, first, second = CuckooFilter._places(h1, h2, self.masks[shard])
        base = self.base[shard]
        found = ((self.slots[base + first] == prints[:, None]) | (self.slots[base + second] == prints[:, None])).any(axis=1)
        if self.wrong:
            some = np.flatnonzero(found)
            found[some] = [(int(a), int(b)) not in self.wrong for a, b in zip(h1[some], h2[some])]
        return found


def _next_filter(min_docs: int, shards: int):
    def change(key: tuple, old: pa.Table, counts: pa.Table) -> pa.Table:
        """The filter of one shard after its counts changed."""
        h1, h2, before, after = (counts[c].to_numpy() for c in ("h1", "h2", "before", "after"))
        common, was = after >= min_docs, before >= min_docs
        if old.num_rows:
            own = CuckooFilter(np.frombuffer(old["slots"][0].as_py(), np.uint32).copy())
            own.delete(h1[was & ~common], h2[was & ~common])
            if not own.insert(h1[common & ~was], h2[common & ~was]):
                own = CuckooFilter.holding(h1[common], h2[common], 2 * len(own.slots))
        else:
            own = CuckooFilter.holding(h1[common], h2[common])
        rare = (after > 0) & ~common
        claimed = own.contains(h1[rare], h2[rare])
        wrong = np.stack([h1[rare][claimed], h2[rare][claimed]], axis=1)
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "shards": pa.array([shards], pa.int32()), "common": pa.array([int(common.sum())], pa.int64()),
            "slots": pa.array([own.slots.tobytes()], pa.binary()), "wrong": pa.array([wrong.tobytes()], pa.binary()),
        })

    return change


class LineIndex:
    """Reference counts and filters of the lines of a growing and shrinking set of documents.

    A row is a document: rows with equal or null ids count each, and a document is deleted by passing the row that was
    inserted. A line counts once per document. Keys shorter than ``min_length`` code points, thus empty lines
    by default, are never counted. ``min_docs`` and ``min_length`` belong to the folder and must stay the same.
    """

    def __init__(self, spark: SparkSession, root: str, min_docs: int = 10, min_length: int = 1, shard_keys: int = SHARD_KEYS):
        if min_docs < 1 or min_length < 1:
            raise ValueError("a common line has one document and one code point or more")
        self.spark, self.root, self.shard_keys = spark, root.rstrip("/"), shard_keys
        self.min_docs, self.min_length = min_docs, min_length
        settings = f"{self.root}/settings-docs={min_docs}-length={min_length}"
        if not exists(spark, settings):
            if any(c.startswith("settings-") for c in children(spark, self.root)):
                raise ValueError(f"{self.root} was made with other settings")
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(settings)

    def generations(self) -> list[int]:
        """Committed generations, oldest first."""
        found = (re.fullmatch(r"generation=(\d+)", c) for c in children(self.spark, self.root))
        return sorted(int(m[1]) for m in found if m and exists(self.spark, f"{self._folder(int(m[1]))}/filters/_SUCCESS"))

    def _folder(self, generation: int) -> str:
        return f"{self.root}/generation={generation}"

    def _parts(self) -> list[str]:
        """Folders whose counts add up to the present ones: the last full one and the changes after it."""
        out = []
        for g in reversed(self.generations()):
            if exists(self.spark, f"{self._folder(g)}/full"):
                return [*out, f"{self._folder(g)}/full"]
            out.append(f"{self._folder(g)}/change")
        return out

    def counts(self) -> DataFrame:
        """``(h1, h2, n)``: the number of documents that hold each key."""
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long")
        return self.spark.read.schema(_COUNTS).parquet(*parts).groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 0")

    def filters(self) -> DataFrame:
        done = self.generations()
        if not done:
            return self.spark.createDataFrame([], _FILTERS)
        return self.spark.read.schema(_FILTERS).parquet(f"{self._folder(done[-1])}/filters")

    def _hashes(self, keys: Column) -> Column:
        """Hash pairs of all lines; null for keys that are too short."""
        return F.transform(keys, lambda key: F.when(F.length(key) >= self.min_length, _hash_pair(key)))

    def _key_counts(self, docs: DataFrame, text_col: str) -> DataFrame:
        held = F.array_compact(F.array_distinct(self._hashes(line_keys(F.col(text_col).cast("string")))))
        return docs.select(F.explode(held).alias("key")).groupBy("key.h1", "key.h2").agg(F.count("*").alias("n"))

    def insert(self, docs: DataFrame, text_col: str = "text") -> None:
        """Counts the lines of these documents."""
        self._change(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> None:
        """Takes the lines of these documents out again; fails if they were not all inserted before."""
        self._change(docs, text_col, -1)

    def _change(self, docs: DataFrame, text_col: str, sign: int) -> None:
        spark, done = self.spark, self.generations()
        number = done[-1] + 1 if done else 0
        folder = self._folder(number)
        parts = self._parts()
        had = self.filters().agg(F.max("shards")).first()[0] or 0
        keyed = self._key_counts(docs, text_col).select(F.lit(0).alias("shard"), "h1", "h2", (F.col("n") * sign).alias("n"))
        keyed.write.mode("overwrite").parquet(f"{folder}/change")
        change = spark.read.schema(_COUNTS).parquet(f"{folder}/change")
        old = spark.read.schema(_COUNTS).parquet(*parts) if parts else spark.createDataFrame([], _COUNTS)
        # Rows of the files, without a scan: at least as many as there are keys.
        most_keys = change.count() + (old.count() if parts else 0)
        shards = had if had and most_keys <= had * self.shard_keys else max(
            had, -(-most_keys // self.shard_keys) * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        merged = old.select("h1", "h2", F.col("n").alias("before"), F.lit(0).cast("long").alias("change")).unionByName(
            change.select("h1", "h2", F.lit(0).cast("long").alias("before"), F.col("n").alias("change"))
        ).groupBy("h1", "h2").agg(F.sum("before").alias("before"), F.sum("change").alias("change"))
        after = F.col("before") + F.col("change")
        checked = F.when(after >= 0, after).otherwise(F.raise_error(F.lit("a deleted document was not inserted before")))
        merged = merged.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "h1", "h2", "before", checked.alias("after"))
        if shards != had or number % FULL_EVERY == 0:
            merged.select("shard", "h1", "h2", F.col("after").alias("n")).where("n > 0").write.mode("overwrite").parquet(f"{folder}/full")
        known = self.filters().where(F.col("shards") == shards)
        known.groupBy("shard").cogroup(merged.groupBy("shard")).applyInArrow(
            _next_filter(self.min_docs, shards), _FILTERS).write.mode("overwrite").parquet(f"{folder}/filters")

    def clean(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``(doc_id, n_lines, n_dropped, kept)`` per row of ``docs``, which are documents of the index: lines with a common
        key go, the others are joined by line breaks in ``kept``.

        The filters are looked up in every task while they take ``broadcast_bytes`` or less together; beyond that, lines
        are joined with the counts. Null and empty texts are one empty line, which is kept: ``kept`` is
        empty then. An empty table gives no rows, other columns are not read, and very long texts are never cut.
        """
        text = F.col(text_col).cast("string")
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
        sizes = self.filters().agg(F.sum(F.length("slots") + F.length("wrong")), F.max("shards")).first()
        if (sizes[0] or 0) <= broadcast_bytes:
            marked = self._look_up(rows, sizes[1] or 1)
        else:
            marked = self._join_counts(rows)
        lines = F.split("text", "\n", -1)
        kept = F.filter(lines, lambda line, i: ~F.array_contains("common", i))
        return marked.select(
            "doc_id", F.size(lines).cast("long").alias("n_lines"), F.size("common").cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept"))

    def _look_up(self, rows: DataFrame, shards: int) -> DataFrame:
        """Adds ``common``, the numbers of the lines to drop, by the filters of all shards."""
        held = self.spark.sparkContext.broadcast(_Shards(shards, self.filters().collect()))

        def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                pairs = batch.flatten()
                known = np.flatnonzero(pairs.is_valid().to_numpy(zero_copy_only=False))
                own = pairs.take(pa.array(known))
                hit = known[held.value.common(own.field("h1").to_numpy(), own.field("h2").to_numpy())]
                sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                number = hit - np.repeat(ends - sizes, sizes)[hit]
                yield pa.ListArray.from_arrays(pa.array(np.append(0, np.searchsorted(hit, ends)), pa.int32()), pa.array(number, pa.int32()))

        return rows.withColumn("common", F.arrow_udf(find, "array<int>")(self._hashes(line_keys(F.col("text")))))

    def _join_counts(self, rows: DataFrame) -> DataFrame:
        """Adds ``common`` by a join with the counts. A row is named by its id and text, so equal rows share the answer."""
        name = ["doc_id", "t1", "t2"]
        named = rows.select("*", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
        lines = named.dropDuplicates(name).select(*name, F.posexplode(self._hashes(line_keys(F.col("text")))).alias("i", "key"))
        common = self.counts().where(F.col("n") >= self.min_docs).select("h1", "h2")
        hits = lines.select(*name, "i", "key.h1", "key.h2").join(common, ["h1", "h2"], "left_semi").groupBy(*name).agg(F.collect_list("i").alias("common"))
        hits = hits.select(*[F.col(c).alias(f"hit_{c}") for c in name], "common")
        same = F.col("doc_id").eqNullSafe(F.col("hit_doc_id")) & (F.col("t1") == F.col("hit_t1")) & (F.col("t2") == F.col("hit_t2"))
        return named.join(hits, same, "left").select("doc_id", "text", F.coalesce("common", F.array().cast("array<int>")).alias("common"))
