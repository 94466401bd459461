"""Repeatable samples and splits.

``DataFrame.sample(seed)`` and ``randomSplit`` depend on how rows are partitioned. Here a row's
fate depends on a hash of a stable key only, so any layout and any rerun gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_SPAN = 1 << 32
# Spark sorts this many rows and fewer by a heap in each task.
TOP_ROWS = 10_000


def key_hash(keys: Sequence[str | Column], seed: int | str) -> Column:
    """32-bit hash of the key values as a long; the same in any engine that has md5."""
    text = F.concat_ws("|", *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys],
                       F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str], seed: int) -> DataFrame:
    """Each row kept with the given probability, decided by its key."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction is a proportion between 0 and 1")
    return df.where(key_hash(keys, seed) < int(fraction * HASH_SPAN))


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are fewer): those with the smallest (hash, key).

    ``keys`` should identify a row: rows with equal keys share a hash and are ranked together.

    Up to ``TOP_ROWS`` rows are a top-k in one scan: each task keeps its first ``n``. For more, two counting
    passes over 65,536 hash ranges each find the exact cut-off, each one a scan of the keys with a small
    aggregate, and only rows on the cut-off hash itself are ranked. Both ways give the same rows.
    """
    hashed = df.withColumn("_h", key_hash(keys, seed))
    if n <= TOP_ROWS:
        return hashed.orderBy("_h", *keys).limit(n).drop("_h")
    low, width, room = 0, HASH_SPAN, n
    for parts in (1 << 16, 1 << 16):
        step = width // parts
        inside = hashed.where((F.col("_h") >= low) & (F.col("_h") < low + width))
        counts = {
            r["part"]: r["n"]
            for r in inside.groupBy(F.floor((F.col("_h") - low) / step).alias("part"))
            .agg(F.count(F.lit(1)).alias("n")).collect()
        }
        for part in range(parts):
            if counts.get(part, 0) > room:
                low, width = low + part * step, step
                break
            room -= counts.get(part, 0)
        else:
            return df  # no more than n rows in all
    below = hashed.where(F.col("_h") < low)
    rank = F.row_number().over(Window.partitionBy("_h").orderBy(*keys))
    edge = hashed.where(F.col("_h") == low).withColumn("_rank", rank).where(F.col("_rank") <= room).drop("_rank")
    return below.unionByName(edge).drop("_h")


def sample_blocks(df: DataFrame, fraction: float, seed: int, block_rows: int = 1024) -> DataFrame:
    """Whole blocks of a file scan: less even than a row sample, cheaper to decide.

    A block is a run of ``block_rows`` rows of one file. ``df`` must be a direct Parquet scan.
    """
    block = F.concat_ws(
        "|", F.col("_metadata.file_name"), F.floor(F.col("_metadata.row_index") / block_rows).cast("string"), F.lit(str(seed))
    )
    return df.where(F.pmod(F.xxhash64(block), F.lit(1_000_000)) < int(fraction * 1_000_000))


def sample_files(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Whole files of a file scan, drawn by their names: files that are not drawn are never opened.

    The rule reads file metadata only, so Spark applies it to the listing. ``df`` must be a direct file
    scan of many files; for a few large files, `sample_blocks` draws finer but reads all of them.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction is a proportion between 0 and 1")
    name = F.concat_ws("|", F.col("_metadata.file_path"), F.lit(str(seed)))
    return df.where(F.pmod(F.xxhash64(name), F.lit(1_000_000)) < int(fraction * 1_000_000))


def split_random(df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int) -> list[DataFrame]:
    """Disjoint parts that together hold every row, cut at cumulative weights of the key hash."""
    numbered = with_split(df, weights, keys, seed)
    return [numbered.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def with_split(df: DataFrame, weights: Sequence[float], keys: Sequence[str], seed: int, name: str = "_part") -> DataFrame:
    """Number each row with the part it belongs to."""
    total, upto, part = sum(weights), 0.0, F.lit(len(weights) - 1)
    cuts = []
    for weight in weights[:-1]:
        upto += weight / total
        cuts.append(int(upto * HASH_SPAN))
    hashed = key_hash(keys, seed)
    for i in range(len(cuts) - 1, -1, -1):
        part = F.when(hashed < cuts[i], i).otherwise(part)
    return df.withColumn(name, part)
