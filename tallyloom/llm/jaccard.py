"""N-gram Jaccard join: pairs of documents with similar shingle sets, by Bayesian pruning.

A document's set holds its runs of five consecutive words (a shorter text: all its words).
Documents with equal sets are one class; only classes are compared. MinHash bands gather
classes that may be similar into clusters (components over shared bands). Within a cluster,
MinHash values are compared STEP at a time; a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold, given the matches so far and a uniform
prior, falls below TOLERANCE. What is left is verified on the sets themselves.

A cluster is cut into blocks of bounded bytes and a task compares two blocks, so no group,
however hot, meets in one task. No pair leaves a task: a task returns for each class how many
documents it is linked with, and one edge to the smallest class of its part.

Cases: a text without words, null ones too, is linked with nothing. Each row is a document of
its own, also if its doc_id repeats. Rows with a null doc_id take part, but name no component
as long as another id is there. Equal similarities are no matter: at the threshold is linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (ALNUM, U64, Words, bounded_batches, components, cut, flat, least_labels,
                     mix, pieces, settle, windows_hash)

SHINGLE = 5  # words
SIMILAR = 0.8
BANDS, ROWS = 24, 5  # a pair at the threshold misses all bands once in 14,000 times
HASHES = BANDS * ROWS
STEP = 12  # MinHash values compared at a time
TOLERANCE = 1e-5
BLOCK_BYTES = 8 << 20  # of sets in a block
GROUP_BYTES = 16 << 20  # of small clusters dealt to one group

_A = (mix(np.arange(1, HASHES + 1, dtype=U64)) | U64(1)).astype(np.uint32)
_B = mix(np.arange(1001, HASHES + 1001, dtype=U64)).astype(np.uint32)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, 64 bits each."""
    w = Words(*flat(column), ALNUM)
    hashes = w.hashes()
    counts = w.counts
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.repeat(w.offsets[:-1] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    length = np.repeat(np.minimum(counts, size), n)
    shingles = windows_hash(hashes, first, first + length)
    ends = np.cumsum(n)
    out = []
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        own = np.sort(shingles[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if b - a > 1 else own)
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES values for each set that is not empty; 0 for an empty one."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        values = (np.concatenate([sets[i] for i in full]) >> U64(32)).astype(np.uint32)
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for k in range(HASHES):
            mixed = values * _A[k] + _B[k]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            out[full, k] = np.minimum.reduceat(mixed, starts)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key for each band, the band's number mixed in."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS).astype(U64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), parts.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix(keys ^ mix(parts[:, :, r] + U64(r * 977 + 1)))
    return keys.astype(np.int64)


def least_matches(similar: float = SIMILAR, tolerance: float = TOLERANCE,
                  hashes: int = HASHES, step: int = STEP) -> dict[int, int]:
    """How many of the first n values must match for a pair to stay, for each step.

    With a uniform prior the posterior is Beta(matches + 1, n - matches + 1); its tail is a
    sum of binomials.
    """
    def stays(n: int, m: int) -> bool:
        tail = sum(comb(n + 1, k) * similar ** k * (1 - similar) ** (n + 1 - k)
                   for k in range(m + 1))  # P(similarity >= threshold)
        return tail >= tolerance

    return {n: next(m for m in range(n + 1) if stays(n, m))
            for n in range(step, hashes + 1, step)}


def possible_pairs(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which rows of a may be similar to which of b: MinHash values by steps."""
    matches = np.zeros((len(a), len(b)), np.int16)
    alive = np.ones(matches.shape, bool)
    at = 0
    for n, m in least.items():
        if alive.mean() < 0.1:  # few pairs are left: one by one
            i, j = np.nonzero(alive)
            for more, need in least.items():
                if more > at:
                    now = matches[i, j] + (a[i, at:more] == b[j, at:more]).sum(1)
                    matches[i, j] = now
                    keep = now >= need
                    i, j, at = i[keep], j[keep], more
            alive[:] = False
            alive[i, j] = True
            return alive
        for k in range(at, n):
            matches += a[:, k, None] == b[None, :, k]
        alive &= matches >= m
        at = n
    return alive


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of a with sets of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    both = [np.concatenate(x) if x else np.zeros(0, U64) for x in (a, b)]
    common = np.intersect1d(*both)
    if not len(common):
        return out
    places = []
    for sets, values in zip((a, b), both):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(common, values), len(common) - 1)
        keep = common[at] == values
        order = np.argsort(at[keep], kind="stable")
        places.append((owner[keep][order], at[keep][order]))
    wide = max(256, (16 << 20) // max(len(a), len(b), 1) // 4)
    for low in range(0, len(common), wide):
        high = min(low + wide, len(common))
        parts = []
        for (owner, at), sets in zip(places, (a, b)):
            x, y = np.searchsorted(at, [low, high])
            m = np.zeros((len(sets), high - low), np.float32)
            m[owner[x:y], at[x:y] - low] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T  # exact: counts stay below 2**24
    return out


def linked_within(rows: pd.DataFrame, least: dict[int, int], similar: float,
                  sides: tuple[int, int]) -> Iterator[tuple[int, int, int]]:
    """(uid, documents linked, smallest uid of its part) in one cluster's two blocks."""
    rows = rows.sort_values("uid")
    uid = rows["uid"].to_numpy()
    weight = rows["members"].to_numpy()
    block = rows["block"].to_numpy()
    sets = [np.frombuffer(x, U64) for x in rows["shingles"]]
    sizes = np.array([len(s) for s in sets], np.float32)
    signatures = minhash(sets)
    own = sides[0] == sides[1]
    left, right = np.flatnonzero(block == sides[0]), np.flatnonzero(block == sides[1])
    total = np.zeros(len(uid), np.int64)
    links = []
    for at in range(0, len(left), 512):
        some = left[at:at + 512]
        keep = possible_pairs(signatures[some], signatures[right], least)
        if own:
            keep &= some[:, None] < right[None, :]
        used, against = np.flatnonzero(keep.any(1)), np.flatnonzero(keep.any(0))
        if not len(used):
            continue
        some, other = some[used], right[against]
        shared = shared_counts([sets[i] for i in some], [sets[i] for i in other])
        union = sizes[some][:, None] + sizes[other][None, :] - shared
        i, j = np.nonzero(keep[np.ix_(used, against)]
                          & (shared.astype(float) >= similar * union.astype(float) - 1e-9))
        np.add.at(total, some[i], weight[other[j]])
        np.add.at(total, other[j], weight[some[i]])
        if len(i):  # pairs of this slice, thinned to a forest at once
            label = least_labels([(some[i], other[j])], len(uid))
            moved = np.flatnonzero(label != np.arange(len(uid)))
            links.append((label[moved], moved))
    label = least_labels(links, len(uid))
    for k in np.flatnonzero(total):
        yield int(uid[k]), int(total[k]), int(uid[label[k]])


def described(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """uid, doc_id, text_hash, digest (null: no words), bytes of the set, band keys."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets(batch.column("text"), size)
            keys = band_keys(minhash(sets))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                                    if len(s) else None for s in sets], pa.binary()),
                "bytes": pa.array([s.nbytes for s in sets], pa.int64()),
                "bands": pa.array([k.tolist() if len(s) else [] for s, k in zip(sets, keys)],
                                  pa.list_(pa.int64()))})

    slim = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            F.xxhash64(text).alias("text_hash"))
    found = slim.mapInArrow(task, "doc_id long, text_hash long, digest binary, bytes long, "
                                  "bands array<long>")
    return cut(found).withColumn("uid", F.monotonically_increasing_id())


def join_similar(documents: DataFrame, key: str = "doc_id", text: str = "text",
                 size: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """doc_id, text_hash, class_id, n_links, component_id, kept of every row.

    class_id: smallest doc_id with the same set. n_links: other documents at or above the
    threshold. component_id: smallest doc_id reachable over links. kept: the one row of its
    component that stays.
    """
    bounded_batches(documents.sparkSession)
    rows = described(documents, key, text, size)
    slim = rows.select("uid", "doc_id", "text_hash", "digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid"))
    classes = cut(rows.where("digest is not null").groupBy("digest").agg(
        first.alias("first"), F.count("*").alias("members"), F.min("bytes").alias("bytes"),
    ).select("digest", "members", "bytes", F.col("first.uid").alias("uid"),
             F.col("first.doc_id").alias("class_id")))

    firsts = rows.join(classes.select("uid"), "uid", "left_semi")
    bands = firsts.select("uid", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("uid").alias("to"), F.count("*").alias("n")).where(
        "n > 1")
    near = components(bands.join(shared, "band").where("uid <> to").select(
        F.col("uid").alias("a"), F.col("to").alias("b")))
    near = cut(near.withColumnsRenamed({"id": "uid", "component": "cluster"}).join(
        classes.select("uid", "members", "bytes", "class_id", "digest"), "uid"))
    links = cut(compare_clusters(documents, near, slim, key, text, size, similar))

    named = settle(classes.withColumnRenamed("class_id", "id"), links).join(
        classes.select("uid", "digest"), "uid").select(
        "digest", F.col("id").alias("class_id"), "component_id", "kept_uid", "n_links")
    # a set that a third of all rows share: the classes are few rows, the join may be skewed
    out = slim.join(named, "digest", "left")
    return out.select(
        "doc_id", "text_hash", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("uid") == F.col("kept_uid"), F.lit(True)).alias("kept"))


def compare_clusters(documents: DataFrame, near: DataFrame, slim: DataFrame, key: str,
                     text: str, size: int, similar: float) -> DataFrame:
    """uid, n, to: links found within the clusters, block against block."""
    least = least_matches(similar)
    sizes = near.groupBy("cluster").agg(F.sum("bytes").alias("total"), F.count("*").alias("n"))
    total = sizes.where(F.col("total") <= BLOCK_BYTES).agg(F.sum("total")).first()[0] or 0
    groups = max(1, -(-total // GROUP_BYTES))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("total") / BLOCK_BYTES)).cast("int")
    dealt = near.join(sizes.where("n > 1").select("cluster", blocks.alias("blocks")), "cluster")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    wanted = dealt.select("uid", "cluster", "blocks", "block", "members").join(
        slim.select("uid", F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")),
        "uid")

    texts = documents.select(F.col(key).cast("long").alias("doc_id"),
                             F.col(text).alias("text")).where("text is not null")
    # equal ids with equal texts give the same set several times: one of them is enough
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id"))
                       & (F.xxhash64("text") == F.col("__hash")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [s.tobytes() for s in shingle_sets(batch.column("text"), size)]
            yield pa.record_batch(
                [*batch.select(["uid", "cluster", "blocks", "block", "members"]).columns,
                 pa.array(found, pa.binary())],
                names=["uid", "cluster", "blocks", "block", "members", "shingles"])

    held = texts.select("uid", "cluster", "blocks", "block", "members", "text").mapInArrow(
        sets, "uid long, cluster long, blocks int, block int, members long, shingles binary")
    against = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    held = held.withColumn("other", against).select(
        "uid", "cluster", "block", "members", "shingles",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(groups)))
        .otherwise(F.lit(groups) + F.pmod(F.xxhash64("cluster", F.least("block", "other"),
                                                     F.greatest("block", "other")),
                                          F.lit(1 << 40))).alias("deal"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        rows = rows.drop_duplicates(["uid", "cluster", "i", "j"])
        for (_, i, j), own in rows.groupby(["cluster", "i", "j"], sort=False):
            if len(own) > 1:
                out += linked_within(own, least, similar, (i, j))
        return pd.DataFrame(out, columns=["uid", "n", "to"]).astype("int64")

    return held.groupBy("deal").applyInPandas(compare, "uid long, n long, to long")


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text",
             size: int = SHINGLE, similar: float = SIMILAR) -> DataFrame:
    """The documents, all columns as they were, one of each component.

    Of rows with equal id and text the one that comes first when written as text stays.
    """
    found = join_similar(documents, key, text, size, similar)
    gone = cut(found.groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("stay")).where(
        "n <> stay"))
    names = documents.columns
    inner = documents.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
                             F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    whole = inner.join(gone, on, "left_anti")
    # where rows are equal in id and text and one of them is kept, the first as text stays
    some = inner.join(gone.where("stay > 0"), on).groupBy("id", "hash").agg(
        F.min_by("row", F.col("row").cast("string")).alias("row"))
    return whole.select("row.*").union(some.select("row.*"))
