"""Mixing documents to target weights by soft domain membership. DataFrame functions only.

A naive Bayes classifier, fitted on the labels table, gives each document a posterior over the domains.
Document rates are then fitted: nonnegative, as close to one as they can be, such that the expected tokens of
each domain meet its target. The fit is a projected gradient descent whose gradient needs one sum per domain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

TARGETS = {"clean": 0.90, "poor": 0.07, "toxic": 0.03}
MOST_ROWS = 20_000
MOST_TERMS = 4_000
TEMPER = 0.5


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a labelled document; null if neither label is known."""
    return F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 0, "poor").when(F.col(quality) == 1, "clean")


def with_terms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``n_tokens`` and ``terms``: the distinct lower-cased words, and marks for how varied and long the words are."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[ \t-\r]+"), lambda w: w != "")
    rows = docs.withColumn("words", words)
    rows = rows.withColumn("n_tokens", F.size("words").cast("long")).withColumn("terms", F.array_distinct("words")).drop("words")
    varied = F.concat(F.lit("\n#varied "), F.floor(F.size("terms") * 10 / F.greatest("n_tokens", F.lit(1))).cast("string"))
    long = F.concat(F.lit("\n#long "), F.least(F.floor(F.length(F.coalesce(F.col(text_col), F.lit(""))) / F.greatest("n_tokens", F.lit(1))), F.lit(20)).cast("string"))
    return rows.withColumn("terms", F.when(F.col("n_tokens") > 0, F.concat("terms", F.array(varied, long))).otherwise(F.col("terms")))


def fit_domains(
    docs: DataFrame, labels: DataFrame, domains: Sequence[str], domain: Column, id_col: str = "doc_id", text_col: str = "text",
    most_rows: int = MOST_ROWS, most_terms: int = MOST_TERMS,
) -> tuple[DataFrame, list[float]]:
    """Term weights per domain, ``(term, w0, w1, ...)``, and each domain's log score without terms.

    At most ``most_rows`` labelled ids are used, chosen by a hash of the id; an id with several domains counts for
    the first by name. Of the terms that occur in five documents or more, the ``most_terms`` with the greatest
    likelihood ratio between domains are kept.
    """
    known = labels.select(F.col(id_col).alias("known_id"), domain.alias("domain")).where(F.col("domain").isin(*domains) & F.col("known_id").isNotNull())
    known = known.groupBy("known_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("known_id"), "known_id").limit(most_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("known_id"))
    rows = stored(with_terms(rows).select("domain", "terms"), "mixing-sample")
    sizes = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    n = [float(sizes.get(d, 0)) for d in domains]
    total = sum(n)
    prior = [(c + 1) / (total + len(domains)) for c in n]
    counts = rows.select("domain", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("held"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"c{i}") for i, d in enumerate(domains)])
    counts = counts.where("held >= 5")

    def log_odds(i: int) -> Column:
        share = (F.col(f"c{i}") + F.col("held") / max(total, 1) + 0.01) / (n[i] + 1.02)
        return F.log(share / (1 - share))

    def absent(i: int) -> Column:
        share = (F.col(f"c{i}") + F.col("held") / max(total, 1) + 0.01) / (n[i] + 1.02)
        return F.log(1 - share)

    ratio = sum((F.when(F.col(f"c{i}") > 0, F.col(f"c{i}") * F.log(F.col(f"c{i}") * total / (F.col("held") * max(n[i], 1)))).otherwise(0.0) for i in range(len(domains))), F.lit(0.0))
    chosen = counts.orderBy(ratio.desc(), "term").limit(most_terms)
    weights = stored(chosen.select(
        "term", *[log_odds(i).alias(f"w{i}") for i in range(len(domains))], *[absent(i).alias(f"a{i}") for i in range(len(domains))]), "mixing-terms")
    sums = weights.agg(*[F.sum(f"a{i}") for i in range(len(domains))]).first()
    base = [math.log(p) + (s or 0.0) for p, s in zip(prior, sums)]
    return weights.select("term", *[f"w{i}" for i in range(len(domains))]), base


def domain_posteriors(docs: DataFrame, weights: DataFrame, base: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_tokens, p0, p1, ...)`` for each distinct id and text."""
    width = len(base)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = with_terms(rows).select("doc_id", "text_hash", "n_tokens", F.explode_outer("terms").alias("term"))
    # The term table has a stated bound of rows, so it is broadcast. Terms are few per document by then.
    held = rows.join(F.broadcast(weights), "term", "left")
    sums = held.groupBy("doc_id", "text_hash", "n_tokens").agg(*[F.sum(F.coalesce(f"w{i}", F.lit(0.0))).alias(f"w{i}") for i in range(width)])
    logs = [(F.col(f"w{i}") + base[i]) * TEMPER for i in range(width)]
    top = F.greatest(*logs) if width > 1 else logs[0]
    powers = [F.exp(x - top) for x in logs]
    total = sum(powers[1:], powers[0])
    return sums.select("doc_id", "text_hash", "n_tokens", *[(p / total).alias(f"p{i}") for i, p in enumerate(powers)])


def rate_of(steps: list[list[float]], width: int) -> Column:
    """The rate after the steps taken so far: from one, each step goes down by its product with the posterior, not below zero."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    literal = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    shift = lambda step: sum((step[i] * F.col(f"p{i}") for i in range(1, width)), step[0] * F.col("p0"))
    return F.aggregate(literal, rate, lambda r, step: F.greatest(F.lit(0.0), r - shift(step)))


def fit_rates(posteriors: DataFrame, targets: list[float], most_steps: int = 40, tolerance: float = 1e-6) -> tuple[list[list[float]], list[float]]:
    """Projected gradient steps towards rates whose expected domain tokens are ``targets``, and what they reach.

    Each step is one aggregation to a few sums per domain. The gradient is scaled by the inverse of the domains' token
    overlaps among documents whose rate is not held at zero, so a step that meets no further zero is exact. The number
    of steps is bounded; targets that no nonnegative rates meet are met as closely as the steps allow.
    """
    width = len(targets)
    p = [F.col(f"p{i}") for i in range(width)]
    steps: list[list[float]] = []
    total = max(sum(targets), 1e-12)
    best: tuple[float, int, list[float]] | None = None
    for taken in range(most_steps + 1):
        rated = posteriors.withColumn("rate", rate_of(steps, width))
        moving = F.when(F.col("rate") > 0, F.col("n_tokens")).otherwise(0)
        row = rated.agg(
            *[F.sum(F.col("n_tokens") * F.col("rate") * x) for x in p], *[F.sum(moving * x * y) for i, x in enumerate(p) for y in p[:i + 1]]).first()
        sums = [float(x or 0) for x in row]
        reached = sums[:width]
        excess = np.array(reached) - np.array(targets)
        error = float(np.abs(excess).max()) / total
        if best is None or error < best[0]:
            best = (error, taken, reached)
        if error <= tolerance:
            break
        overlap = np.zeros((width, width))
        overlap[np.tril_indices(width)] = sums[width:]
        overlap += np.tril(overlap, -1).T
        scale = np.linalg.pinv(overlap, rcond=1e-9) if overlap.any() else np.zeros((width, width))
        steps.append([float(x) for x in scale @ excess])
    return steps[:best[1]], best[2]


def mix_to_targets(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, size: float = 1.0, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, text_hash, n_tokens, p_<domain>..., rate, copies)`` for each distinct id and text.

    ``targets`` are the shares of the domains in the mixture, ``size`` its tokens as a multiple of the input's. A rate
    is the expected number of times a document enters the mixture; ``copies`` rounds it up or down by a hash of id and
    text, so the expected tokens stay as fitted and a rerun draws the same.

    Repeated rows of one id and text are one row here and share its rate. Null and empty texts have no tokens, so they
    add to no domain; their rate follows the prior. Null ids are kept. Without labels, or without documents of some
    domain, posteriors follow the prior and targets may be out of reach, see ``fit_rates``. An empty table gives no rows.
    """
    targets = targets or TARGETS
    domains = sorted(targets)
    weights, base = fit_domains(docs, labels, domains, domain_of(), id_col, text_col)
    posteriors = stored(domain_posteriors(docs, weights, base, id_col, text_col), "mixing-posteriors")
    tokens = float(posteriors.agg(F.sum("n_tokens")).first()[0] or 0) * size
    whole = sum(targets.values())
    steps, _ = fit_rates(posteriors, [tokens * targets[d] / whole for d in domains])
    rate = rate_of(steps, len(domains))
    drawn = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    rows = posteriors.select("doc_id", "text_hash", "n_tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)], rate.alias("rate"))
    return rows.withColumn("copies", (F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("int")).cast("int"))
