"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8, **conf) -> SparkSession:
    """Session for tests and single-node benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Expose tables to SQL text under their own names."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def shuffle_width(spark: SparkSession, upper: int = 512) -> int:
    """How many range buckets to cut data into: the shuffle width, within a driver-safe bound."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), upper))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for written tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which every executor can reach. Only a master within
    this process and without that setting gets a temporary folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` and MLlib a checkpoint folder if the context has none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "checkpoint"))


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan with fewer partitions than cores one partition per core.

    For work that is heavy per row. A table large enough to fill the cluster is left alone, so the
    extra shuffle only ever moves a few file blocks.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
