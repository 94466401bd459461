"""From raw documents to a mixture: language, near duplicates, benchmark leaks, secrets, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; all but the last return the columns of
documents. ``run`` writes every stage's result as Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, language, mixing, secrets, simhash
from millrace.llm.common import stored
from millrace.session import table


def _free(docs: DataFrame, name: str) -> str:
    """The name, or one made from it, that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language stays unknown: no letters, no language at half the posterior, or a text unlike all languages of the model.

    A row without an id is kept, as no verdict can be assigned to it.
    """
    found = language.identify(language.document_rows(docs), language.fit_text_model(docs))
    verdicts = found.groupBy("id").agg(F.max((F.col("lang") != language.UNKNOWN).cast("int")).alias("known"))
    rejected = stored(verdicts.where("known = 0 and id is not null").select(F.col("id").alias("rejected_id")), "rejected")
    return docs.join(rejected, docs["doc_id"] == rejected["rejected_id"], "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the group's smallest id, and one row of it.

    Rows without an id are kept.
    """
    found = simhash.near_duplicates(docs, shingle=3, radius=3)
    dropped = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct(), "dropped")
    kept = docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")
    repeated = stored(kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("repeated_id")), "repeated")
    once = kept.join(repeated, kept["doc_id"] == repeated["repeated_id"], "left_anti")
    again = kept.join(repeated, kept["doc_id"] == repeated["repeated_id"], "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(again)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold four fifths or more of a benchmark item. Rows without an id are kept."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    leaking = stored(found.where("doc_id is not null").select(F.col("doc_id").alias("leaking_id")).distinct(), "leaking")
    return docs.join(leaking, docs["doc_id"] == leaking["leaking_id"], "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; all documents stay. ``n_chars`` follows the text; null texts stay null."""
    spotted_id, spotted_hash, own_hash, spans = (_free(docs, c) for c in ("spotted_id", "spotted_hash", "own_hash", "spans"))
    found = secrets.find_secrets(docs).where("size(spans) > 0")
    spotted = found.select(F.col("doc_id").alias(spotted_id), F.xxhash64("text").alias(spotted_hash), F.col("spans").alias(spans))
    spotted = stored(spotted.dropDuplicates([spotted_id, spotted_hash]), "spotted")
    rows = docs.withColumn(own_hash, F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = rows.join(spotted, F.col("doc_id").eqNullSafe(F.col(spotted_id)) & (F.col(own_hash) == F.col(spotted_hash)), "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(secrets.redacted(F.col("text"), F.col(spans)))
    n_chars = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return joined.select(*[{"text": text.alias("text"), "n_chars": n_chars.alias("n_chars")}.get(c, F.col(f"`{c}`")) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that enter the mixture, with their ``rate`` and number of ``copies``. Columns of these names are replaced."""
    docs = docs.drop("rate", "copies")
    rated_id, rated_hash, own_hash = (_free(docs, c) for c in ("rated_id", "rated_hash", "own_hash"))
    rates = mixing.mix_to_targets(docs, table(spark, sf_dir, "labels")).select(
        F.col("doc_id").alias(rated_id), F.col("text_hash").alias(rated_hash), "rate", "copies")
    rates = stored(rates.where("copies > 0"), "rates")
    rows = docs.withColumn(own_hash, F.xxhash64("text"))
    return rows.join(rates, F.col("doc_id").eqNullSafe(F.col(rated_id)) & (F.col(own_hash) == F.col(rated_hash))).select(
        *[F.col(f"`{c}`") for c in docs.columns], "rate", "copies")


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

# Several stages classify or hash in ways that SQL has no functions for; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
