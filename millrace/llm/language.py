"""Language identification by fusing evidence: text likelihoods, declared language, address suffix, host priors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, empty_frame, stored, text_buffers

GRAM_BITS = 16
MOST_ROWS = 20_000
TEMPER = 0.2
STRENGTH = 5.0
MIN_POSTERIOR = 0.5
# A text of this many trigrams must be likelier in its best language than as noise; no trigram counts for more than so much against it.
OPEN_GRAMS = 50
OPEN_FLOOR = 3.0
UNKNOWN = "und"
ROWS = "kind string, id long, text string, declared string, host string"

# Bytes as they count in a gram: letters in lower case, all other ASCII as a gap.
LETTERS = np.full(256, 32, np.uint32)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)
HASHES = 1 << 62


@dataclass
class TextModel:
    languages: list[str]
    log_shares: np.ndarray  # gram x language


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Per text, the hashed letter trigrams that do not consist of gaps alone."""
    if len(data) < 3:
        yield from (np.zeros(0, np.int64) for _ in range(len(offsets) - 1))
        return
    codes = LETTERS[data]
    grams = (codes[:-2] << np.uint32(16)) | (codes[1:-1] << np.uint32(8)) | codes[2:]
    useful = grams != 0x202020
    hashed = ((grams * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
    for a, b in zip(offsets[:-1], offsets[1:]):
        stop = max(b - 2, a)
        yield hashed[a:stop][useful[a:stop]]


def sample_bar(total: int, most_rows: int) -> int:
    """Rows whose hash modulo ``HASHES`` lies below this are about ``most_rows`` of ``total``, however many there are."""
    return HASHES * most_rows // total


def fit_text_model(rows: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", most_rows: int = MOST_ROWS) -> TextModel:
    """Gram shares per language from about ``most_rows`` labelled rows, chosen by a hash of the id.

    Rows without a label or an id are not used. Shares are smoothed by the grams of all languages together.
    """
    known = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text")).where("label is not null and id is not null")
    total = known.count()
    if total > most_rows:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(HASHES)) < sample_bar(total, most_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for label, grams in zip(batch["label"].to_pylist(), gram_counts(data, offsets)):
                sums[label] = sums.get(label, 0) + np.bincount(grams, minlength=1 << GRAM_BITS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.astype(np.int64).tobytes() for s in sums.values()], pa.binary())], ["label", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
        return pa.table({"label": pa.array(table["label"][:1]), "counts": pa.array([total.tobytes()], pa.binary())})

    # The sample is bounded, so eight tasks and one pair of arrays per language are too.
    found = known.select("label", "text").repartition(8).mapInArrow(count, "label string, counts binary")
    sums = {r["label"]: np.frombuffer(r["counts"], np.int64) for r in found.groupBy("label").applyInArrow(add, "label string, counts binary").collect()}
    languages = sorted(sums)
    counts = np.stack([sums[k] for k in languages], axis=1).astype(np.float64) if languages else np.zeros((1 << GRAM_BITS, 0))
    overall = (counts.sum(axis=1, keepdims=True) + 0.5) / (counts.sum() + 0.5 * len(counts))
    smoothed = counts + 1e4 * overall
    return TextModel(languages, np.log(smoothed / np.maximum(smoothed.sum(axis=0, keepdims=True), 1e-9)))


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """Each row without its text: ``grams`` used, the log likelihood of the whole text per language, and ``fit``.

    ``fit`` is how much likelier a trigram of the text is in its best language than in noise of all trigrams alike: the
    mean log ratio, each at least ``-OPEN_FLOOR``, so that it does not hang on the size of the sample. 0.0 without trigrams.
    """
    ratios = np.maximum(model.log_shares + np.log(1 << GRAM_BITS), -OPEN_FLOOR)
    shared = rows.sparkSession.sparkContext.broadcast(np.hstack([model.log_shares, ratios]))
    width = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            counts, logs, fits = [], [], []
            for first, last in blocks(offsets):
                own = data[offsets[first]:offsets[last]]
                for grams in gram_counts(own, offsets[first:last + 1] - offsets[first]):
                    sums = shares[grams].sum(axis=0)
                    counts.append(len(grams))
                    logs.append(sums[:width])
                    fits.append(sums[width:].max() / max(len(grams), 1))
            flat = np.concatenate(logs) if logs else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * width, pa.int32()), pa.array(flat, pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("kind", "id", "declared", "host")] + [pa.array(counts, pa.int64()), lists, pa.array(fits, pa.float64())],
                ["kind", "id", "declared", "host", "grams", "logs", "fit"])

    return rows.mapInArrow(run, "kind string, id long, declared string, host string, grams long, logs array<double>, fit double")


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    powers = [F.exp(x - top) for x in logs]
    total = reduce(lambda a, b: a + b, powers)
    return [p / total for p in powers]


def _sums(rows: DataFrame, key: str | None, width: int, prefix: str) -> DataFrame:
    sums = [F.sum(f"q{i}").alias(f"{prefix}{i}") for i in range(width)]
    return rows.groupBy(key).agg(*sums) if key else rows.agg(*sums)


def _smoothed(own: list[Column], parent: list[Column], less: list[Column] | None = None) -> list[Column]:
    """Shares of a node, drawn towards its parent's; ``less`` leaves the row itself out."""
    counts = [F.coalesce(c, F.lit(0.0)) for c in own]
    if less:
        counts = [F.greatest(c - x, F.lit(0.0)) for c, x in zip(counts, less)]
    total = reduce(lambda a, b: a + b, counts)
    return [(c + STRENGTH * p) / (total + STRENGTH) for c, p in zip(counts, parent)]


def identify(rows: DataFrame, model: TextModel, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """``(kind, id, lang, posterior, text_lang, declared, host)`` per row of ``kind, id, text, declared, host``.

    The log posterior of a language adds up the tempered log likelihood of the whole text's letter trigrams, the
    log share of the declared language and of the address suffix among texts of that language, and the log prior of
    the host. Shares and priors are grouped sums of the text-only posteriors over all rows; a host's prior is drawn
    towards its domain's, that towards its suffix's, that towards the prior of all rows, and leaves the row out.

    ``lang`` is ``und`` for a row whose text has no letter trigram (null and empty texts), whose best posterior is
    below ``min_posterior``, or whose text of ``OPEN_GRAMS`` trigrams or more fits no language of the model better
    than noise (``fit`` below 0: other languages, letter soup), whatever it declares. Null or empty declarations and hosts add no evidence. Ties go to the language that sorts
    first. Repeated rows and null ids are judged like any other; an empty table gives no rows.
    """
    width = len(model.languages)
    schema = "kind string, id long, lang string, posterior double, text_lang string, declared string, host string"
    if not width:
        return rows.select("kind", "id", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("posterior"), F.lit(UNKNOWN).alias("text_lang"), "declared", "host")
    clean = rows.select(
        "kind", F.col("id").cast("long").alias("id"), "text",
        F.nullif(F.lower(F.trim("declared")), F.lit("")).alias("declared"), F.nullif(F.lower(F.trim("host")), F.lit("")).alias("host"),
    )
    seen = stored(text_evidence(clean, model), "language-text")
    logs = [F.col("logs")[i] * TEMPER for i in range(width)]
    alone = _softmax(logs)
    seen = seen.withColumns({f"q{i}": F.when(F.col("grams") > 0, q).otherwise(0.0) for i, q in enumerate(alone)})
    seen = seen.withColumns({
        "suffix": F.when(F.contains("host", F.lit(".")), F.element_at(F.split("host", r"\."), -1)),
        "domain": F.when(F.contains("host", F.lit(".")), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)),
    })
    overall = _sums(seen, None, width, "n").first()
    if overall is None or overall[0] is None:
        return empty_frame(rows.sparkSession, schema)
    totals = [float(v) for v in overall]
    prior = [(v + 1) / (sum(totals) + width) for v in totals]

    suffixes = stored(_sums(seen.where("suffix is not null"), "suffix", width, "s"), "language-suffixes")
    domains = stored(_sums(seen.where("domain is not null"), "domain", width, "d"), "language-domains")
    hosts = stored(_sums(seen.where("host is not null"), "host", width, "h"), "language-hosts")
    declared = stored(_sums(seen.where("declared is not null"), "declared", width, "c"), "language-declared")
    kinds = {"suffix": max(suffixes.count(), 1), "declared": max(declared.count(), 1)}
    joined = seen.join(suffixes, "suffix", "left").join(domains, "domain", "left").join(hosts, "host", "left").join(declared, "declared", "left")

    own = [F.col(f"q{i}") for i in range(width)]
    of = lambda prefix: [F.col(f"{prefix}{i}") for i in range(width)]
    by_suffix = _smoothed(of("s"), [F.lit(p) for p in prior], own)
    by_domain = _smoothed(of("d"), by_suffix, own)
    by_host = _smoothed(of("h"), by_domain, own)

    def share(column: str, prefix: str, i: int) -> Column:
        count = F.greatest(F.coalesce(F.col(f"{prefix}{i}"), F.lit(0.0)) - own[i], F.lit(0.0))
        return F.when(F.col(column).isNull(), 0.0).otherwise(F.log((count + 0.5) / (totals[i] + 0.5 * kinds[column])))

    fused = [logs[i] + F.log(by_host[i]) + share("suffix", "s", i) + share("declared", "c", i) for i in range(width)]
    names = F.array(*[F.lit(n) for n in model.languages])
    best = F.array(*_softmax(fused))
    out = joined.select("kind", "id", "grams", "fit", "declared", "host", best.alias("best"), F.array(*own).alias("own"))
    top, text_top = F.array_max("best"), F.array_max("own")
    known = (F.col("grams") < OPEN_GRAMS) | (F.col("fit") >= 0)
    sure = (F.col("grams") > 0) & (top >= min_posterior) & known
    return out.select(
        "kind", "id", F.when(sure, names[F.array_position("best", top) - 1]).otherwise(UNKNOWN).alias("lang"), top.alias("posterior"),
        F.when(F.col("grams") > 0, names[F.array_position("own", text_top) - 1]).otherwise(UNKNOWN).alias("text_lang"), "declared", "host",
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents as rows to identify: ``lang`` is what they declare, ``source`` stands for the host."""
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Web pages as rows to identify: visible text, language declared in the markup, host of the address."""
    html = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", " "), r"&[a-zA-Z#0-9]{1,10};", " ")
    declared = F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)
    host = F.regexp_extract("url", r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("long").alias("id"), text.alias("text"), declared.alias("declared"), host.alias("host"))
