"""One query per operator, over its whole table with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    decontaminate, embeddings, hard_negatives, language, mixing, periodic_runs, quality, secrets, simhash, suffix_dedup, toxicity, window_dedup)
from millrace.llm.checks_sql import LINES_SQL, NEGATIVES_SQL, RUNS_SQL
from millrace.llm.common import fold
from millrace.llm.line_dedup import LineIndex
from millrace.llm.secrets_sql import SECRETS_SQL
from millrace.session import scratch_dir, table


def _of_kind(kind: str, span: Column) -> Column:
    return span["kind"] == kind


def _held_out() -> Column:
    """A row without an id is in no fold, so it is not held out."""
    return F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    number = [F.size(F.filter("spans", partial(_of_kind, k))).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *number, F.sha2(secrets.span_text(own), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.remove_repeated_bytes(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle=3, radius=3)


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and web pages: a document has a ``doc_id``, a page a ``page_id``."""
    docs, pages = table(spark, sf, "documents"), table(spark, sf, "pages")
    rows = language.document_rows(docs).unionByName(language.page_rows(pages))
    found = language.identify(rows, language.fit_text_model(docs))
    return found.select(
        "kind", F.when(F.col("kind") == "document", F.col("id")).alias("doc_id"), F.when(F.col("kind") == "page", F.col("id")).alias("page_id"),
        "lang", "posterior", "text_lang", "declared", "host")


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", _held_out(), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(table(spark, sf, "embeddings"))


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_to_targets(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", _held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_window_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = window_dedup.remove_repeated_windows(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(table(spark, sf, "embeddings").withColumn("label", label), "vec_id % 100 = 0")


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    index = LineIndex(spark, scratch_dir(spark, "line-index"), min_docs=10, min_length=1)
    index.insert(docs)
    return index.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One document in ten repeats a stretch of its words to the end."""
    docs = table(spark, sf, "documents")
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.size(periodic_runs.word_list(F.col("text")))
    g = F.floor(h / 10)
    begin = g % n
    period = 1 + F.floor((n - begin) / (3 + g % 8))
    text = F.when(h % 10 == 0, F.when(n > 0, periodic_runs.with_period_from(F.col("text"), begin, period)).otherwise("")).otherwise(F.col("text"))
    found = periodic_runs.periodic_runs(docs, text_col=text)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.shorter")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_suffix_dedup, op3_decontamination, op4_simhash, op5_language_id, op6_quality, op7_embedding_dedup, op8_mixing,
        op9_toxicity, op10_window_dedup, op11_hard_negatives, op12_line_dedup, op13_periodic_runs)
}
ORACLES = {
    "op1_secret_scan": SECRETS_SQL,
    "op11_hard_negatives": NEGATIVES_SQL,
    "op12_line_dedup": LINES_SQL,
    "op13_periodic_runs": RUNS_SQL,
}
