"""URL filter: rules first, then a ratio of two character language models.

One smoothed variable-order Markov model is learned from accepted URLs and one
from rejected ones (those that a rule decides).  The difference of their
log-likelihoods, divided by the URL's length, is compared with a threshold that
is calibrated on labelled URLs the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, ship, small_batches, texts_of
from quarry.llm.ppm import Model, gram_counts

ALLOW, BLOCK = "allow", "block"
#: scores (bits a byte) are counted in bins of this width for the calibration
BIN, LIMIT = 0.01, 16.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits (host/path text), and its verdict; null if none."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        own, start = rule[:at], rule[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, judged).otherwise(verdict)
    return text, verdict


def interpolated(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Witten-Bell smoothing: a context's counts mixed with the next shorter context."""
    total, distinct = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    weight = np.where(total > 0, total + distinct, 1)
    return np.where(total > 0, (counts + distinct * lower) / weight, lower)


def judge(pages: DataFrame, rules: list[tuple[str, str]], sample: int = 200_000, max_contexts: int = 24_000) -> DataFrame:
    """page_id, host, path, rule, verdict, and score of every row.

    score: bits a byte by which the accepted model beats the rejected one (null
    for URLs that a rule decides), threshold: what it is compared with.
    ``sample``: about so many URLs of a verdict are learned from, chosen by a
    hash of page_id and leaving out crc32(page_id) mod 5 = 1, on which the
    threshold is calibrated for balanced accuracy.  Defined cases: a null url,
    or one without ``://``, has empty host and path, and scores 0; if the rules
    accept or reject nothing, all other URLs are allowed; rows without an id
    neither teach nor calibrate; repeated rows give repeated results; other
    columns are not read.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    labelled = parsed.filter(F.col("by_rule").isNotNull())
    seen = labelled.filter(crc_mod(F.col("page_id"), 5) != 1)
    labels, grams = gram_counts(seen.select("page_id", F.col("by_rule").alias("label"), F.concat("host", "path").alias("text")),
                                "page_id", sample, 2, max_contexts)
    if labels != [ALLOW, BLOCK]:
        score, threshold = F.lit(0.0), 0.0
        scored = parsed.withColumn("score", score)
    else:
        shared = spark.sparkContext.broadcast(Model(labels, grams, max_contexts, interpolated))
        threshold = _calibrated(_scored(labelled.filter(crc_mod(F.col("page_id"), 5) == 1), shared))
        scored = _scored(parsed, shared)
    by_model = F.when(F.col("score") >= threshold, ALLOW).otherwise(BLOCK)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"),
                         F.when(F.col("by_rule").isNull(), F.col("score")).alias("score"))


def _scored(parsed: DataFrame, shared) -> DataFrame:
    """``parsed`` with the score of host and path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            texts = texts_of(b, "text")
            bits = shared.value.lengths(texts)
            scores = (bits[:, 1] - bits[:, 0]) / np.array([max(1, len(t)) for t in texts])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], [*b.schema.names[:-1], "score"])

    return parsed.withColumn("text", F.concat("host", "path")).mapInArrow(
        run, "page_id long, host string, path string, rule string, by_rule string, score double")


def _calibrated(scored: DataFrame) -> float:
    """The threshold of best balanced accuracy, from counts in bins of scores."""
    place = F.floor(F.greatest(F.least("score", F.lit(LIMIT)), F.lit(-LIMIT)) / BIN).cast("int")
    found = scored.groupBy(place.alias("place"), "by_rule").count().collect()
    bins = int(2 * LIMIT / BIN) + 1
    counts = {ALLOW: np.zeros(bins), BLOCK: np.zeros(bins)}
    for r in found:
        counts[r["by_rule"]][r["place"] + bins // 2] += r["count"]
    if not counts[ALLOW].sum() or not counts[BLOCK].sum():
        return 0.0
    # share of rejected URLs below, and of accepted URLs at or above, each bin's lower edge
    below = (np.cumsum(counts[BLOCK]) - counts[BLOCK]) / counts[BLOCK].sum()
    above = np.cumsum(counts[ALLOW][::-1])[::-1] / counts[ALLOW].sum()
    best = np.flatnonzero(below + above >= (below + above).max() - 1e-12)
    return float((best[np.argmin(np.abs(best - bins // 2))] - bins // 2) * BIN)
