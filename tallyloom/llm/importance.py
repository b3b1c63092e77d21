"""Quality classifier by importance resampling of hashed n-grams.

Two bag models over the words and word pairs of a text, as they are between white space,
hashed into BUCKETS: one of target texts (labelled good and not toxic), one of the whole raw
corpus. Every bucket has a log ratio of target over raw probability. What a count can tell is
limited, so the ratio is the posterior mean under a normal prior of variance PRIOR: the
measured log ratio, less the more its own variance (about one over the expected count)
outweighs the prior's. With many counts it is the measured ratio. A document's log weight is
the sum over all its n-grams, whatever its length, and documents are drawn without replacement
in proportion to the weight by the Gumbel trick: noise is added to the log weight and the k
largest stay. The noise comes from a hash of id and text, so a repeated run draws the same
documents.

Counts cover all documents; a task sums its own before they are shuffled, so BUCKETS rows a
task travel, and BUCKETS rows go to the driver, whatever the size. The k-th largest is found
from a distributed sort and the sizes of its partitions.

Cases: a text without words, null ones too, has log weight 0. Rows with equal ids and texts
draw the same noise. Conflicting or null labels of an id make it no target. Without targets, or with
only targets, all weights are alike and the draw is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, U64, Words, bounded_batches, cut, flat, mix, pieces

BUCKETS = 1 << 17
PRIOR = 0.05  # variance of the log ratios before anything is counted
SEED = 20


def features(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs of neighbours, and the text of each."""
    hashes, docs = w.hashes(), w.doc()
    pairs = np.flatnonzero(docs[1:] == docs[:-1])
    both = mix(hashes[pairs] * U64(3) ^ mix(hashes[pairs + 1]))
    return (np.concatenate([hashes, both]) % U64(buckets)).astype(np.int64), np.concatenate(
        [docs, docs[pairs]])


def bucket_counts(documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, target, raw: counts over all documents (text, target)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in pieces(batches):
            found, docs = features(Words(*flat(batch.column("text")), SPACED, True), buckets)
            raw += np.bincount(found, minlength=buckets)
            target = np.asarray(batch.column("target").to_numpy(zero_copy_only=False), bool)
            good += np.bincount(found[target[docs]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.record_batch({"bucket": pa.array(some), "target": pa.array(good[some]),
                               "raw": pa.array(raw[some])})

    return documents.select("text", "target").mapInArrow(
        task, "bucket long, target long, raw long").groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target over raw probability of each bucket; a bounded number of rows."""
    rows = counts.toArrow()
    bucket = np.asarray(rows.column("bucket"))
    target, raw = np.zeros(buckets), np.zeros(buckets)
    target[bucket], raw[bucket] = np.asarray(rows.column("target")), np.asarray(rows.column("raw"))
    if not target.sum():
        return np.zeros(buckets)
    expected = raw * (target.sum() / raw.sum())
    sure = PRIOR * (expected + 1)
    return (np.log(target + 1) - np.log(expected + 1)) * sure / (sure + 1)


def targets(labels: DataFrame) -> DataFrame:
    """doc_id, target of every labelled document."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(good).alias("target"))


def weigh(documents: DataFrame, ratios: np.ndarray, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_words, log_weight of every document."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = Words(*flat(batch.column("text")), SPACED, True)
            found, docs = features(w, len(ratios))
            weight = np.bincount(docs, ratios[found], minlength=batch.num_rows)
            yield pa.record_batch({"doc_id": batch.column("doc_id"),
                                   "text_hash": batch.column("text_hash"),
                                   "n_words": pa.array(w.counts),
                                   "log_weight": pa.array(weight.astype(np.float64))})

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.xxhash64(text).alias("text_hash")).mapInArrow(
        task, "doc_id long, text_hash long, n_words long, log_weight double")


def draw(weighed: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """All rows with gumbel_key, place (from 1) and selected: the k largest keys."""
    uniform = (F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(2.0 ** 52)
    keyed = weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    ordered = cut(keyed.orderBy(F.desc("gumbel_key"), "doc_id", "text_hash")).withColumn(
        "at", F.monotonically_increasing_id())
    # the id holds the partition above bit 33 and the place in it below
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part")
    before, offsets = 0, []
    for r in sizes.collect():  # one row for each partition
        offsets.append((r["part"], before))
        before += r["n"]
    if not offsets:
        return ordered.withColumn("place", F.col("at")).withColumn(
            "selected", F.lit(False)).drop("at", "text_hash")
    starts = ordered.sparkSession.createDataFrame(offsets, "part long, before long")
    return ordered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).withColumn(
        "selected", F.col("place") <= k).drop("at", "part", "before", "text_hash")


def resample(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             share: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Draws a share of the documents; by default the share of targets among the labelled."""
    bounded_batches(documents.sparkSession)
    known = targets(labels)
    slim = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # merged at every size: the labels grow with the corpus
    marked = slim.join(known.hint("merge"), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target"))
    ratios = log_ratios(bucket_counts(marked, buckets), buckets)
    if share is None:
        share = known.agg(F.avg(F.col("target").cast("double"))).first()[0]
        share = 1.0 if share is None else share
    return draw(weigh(documents, ratios, key, text), round(share * documents.count()))
