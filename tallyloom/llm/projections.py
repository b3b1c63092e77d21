"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Equal vectors are one class. Classes are dealt into cells by the signs of a few projections,
in several tables, so that a pair at the threshold meets in some cell with probability
MEET. In a cell all vectors are projected on PROJECTIONS directions; the rows are sorted by
the first, and a query's window there is all that is compared with it. A pair collides in a
direction if it lies in the query-centred window there; pairs with enough collisions are
verified by their cosine in double precision. Window and count are calibrated: a pair at the
threshold reaches the count with probability REACH. A pair that met in an earlier table is
left to that table, so each is counted once.

A cell above CELL_ROWS rows is cut into blocks and a task compares two of them. No pair
leaves a task: it returns how many vectors each one is linked with, and edges of a forest.

Cases: a vector that is null, empty, zero, or has null or non-finite components is linked
with nothing. Vectors of different lengths are never linked. Rows with equal ids are vectors
of their own. A null id names no component as long as another id is there.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, least_labels, settle

SIMILAR = 0.9
PROJECTIONS = 24
WINDOW = 2.0  # half a window, in standard deviations of a pair at the threshold
MEET, REACH = 0.985, 0.995
CELL = 256  # rows a cell should have
CELL_ROWS = 4096  # rows that are compared at once
GROUP_ROWS = 8192  # rows of small cells in a group
SLICE = 256


def tables_for(rows: int, similar: float = SIMILAR) -> tuple[int, int]:
    """Signs of a cell and number of tables, from how many rows there are."""
    bits = max(0, round(log2(max(1, rows) / CELL)))
    meet = (1 - acos(similar) / pi) ** bits
    return bits, 1 if bits == 0 else ceil(log(1 - MEET) / log(1 - meet))


def least_collisions(window: float = WINDOW, reach: float = REACH,
                     n: int = PROJECTIONS) -> int:
    """How many windows a pair at the threshold shares with probability `reach` or more."""
    p = erf(window / sqrt(2))
    tail, k = 0.0, n + 1
    while tail < reach:
        k -= 1
        tail += comb(n, k) * p ** k * (1 - p) ** (n - k)
    return k


def directions(n: int, dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def compare(unit: np.ndarray, left: np.ndarray, right: np.ndarray, similar: float,
            ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of left, row of right) of unit vectors at or above the threshold.

    If left is right, each pair once.
    """
    own = left is right
    values = unit @ directions(PROJECTIONS, unit.shape[1], 99)
    half = WINDOW * sqrt(2 - 2 * similar)
    need = least_collisions()
    left = left[np.argsort(values[left, 0], kind="stable")]
    right = left if own else right[np.argsort(values[right, 0], kind="stable")]
    first = values[right, 0]
    for at in range(0, len(left), SLICE):
        some = left[at:at + SLICE]
        low = np.searchsorted(first, values[some[0], 0] - half, "left")
        high = np.searchsorted(first, values[some[-1], 0] + half, "right")
        low = max(low, at) if own else low
        other = right[low:high]
        if not len(other):
            continue
        count = np.zeros((len(some), len(other)), np.int8)
        for k in range(PROJECTIONS):
            count += np.abs(values[some, k, None] - values[other, k]) <= half
        keep = count >= need
        if own:
            keep &= np.arange(at, at + len(some))[:, None] < np.arange(low, high)
        i, j = np.nonzero(keep)
        i, j = some[i], other[j]
        for part in range(0, len(i), 1 << 18):
            a, b = i[part:part + (1 << 18)], j[part:part + (1 << 18)]
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= similar
            yield a[near], b[near]


def linked_within(rows: pd.DataFrame, table: int, sides: tuple[int, int],
                  similar: float) -> list[tuple[int, int, int]]:
    """(uid, vectors linked, smallest uid of its part) in two blocks of one cell."""
    rows = rows.sort_values("uid")
    uid, weight = rows["uid"].to_numpy(), rows["members"].to_numpy()
    block = rows["block"].to_numpy()
    vectors = np.stack([np.frombuffer(x, np.float64) for x in rows["vector"]])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    keys = np.stack([np.frombuffer(x, np.int32) for x in rows["cells"]])[:, :table]
    left = np.flatnonzero(block == sides[0])
    right = left if sides[0] == sides[1] else np.flatnonzero(block == sides[1])
    total = np.zeros(len(uid), np.int64)
    links = []
    for a, b in compare(unit, left, right, similar):
        fresh = ~(keys[a] == keys[b]).any(1)
        a, b = a[fresh], b[fresh]
        np.add.at(total, a, weight[b])
        np.add.at(total, b, weight[a])
        if len(a):
            label = least_labels([(a, b)], len(uid))
            moved = np.flatnonzero(label != np.arange(len(uid)))
            links.append((label[moved], moved))
    label = least_labels(links, len(uid))
    return [(int(uid[k]), int(total[k]), int(uid[label[k]])) for k in np.flatnonzero(total)]


def near_duplicates(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    similar: float = SIMILAR) -> DataFrame:
    """id, n_links, component_id of every row (see the module)."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = cut(embeddings.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
    ).withColumn("vector", F.when(finite & F.exists(v, lambda x: x != 0), v)))
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "uid"))
    classes = cut(rows.where("vector is not null").groupBy("vector").agg(
        first.alias("first"), F.count("*").alias("members")).select(
        F.col("first.uid").alias("uid"), F.col("first.id").alias("id"), "members", "vector"))
    bits, tables = tables_for(classes.count(), similar)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            vectors = column.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(np.asarray(column.offsets))
            offsets = np.cumsum(sizes) - sizes
            cells = np.zeros((len(sizes), tables), np.int32)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                block = vectors[offsets[own][:, None] + np.arange(dim)]
                signs = (block @ directions(bits * tables, int(dim), 7) > 0) if bits else None
                for t in range(tables if bits else 0):
                    cells[own, t] = signs[:, t * bits:(t + 1) * bits] @ (1 << np.arange(bits))
            yield pa.record_batch({
                "uid": batch.column("uid"), "members": batch.column("members"),
                "dim": pa.array(sizes.astype(np.int32)),
                "vector": pa.array([vectors[a:a + n].tobytes() for a, n in zip(offsets, sizes)],
                                   pa.binary()),
                "cells": pa.array([c.tobytes() for c in cells], pa.binary()),
                "cell": pa.array(cells.tolist(), pa.list_(pa.int32()))})

    held = classes.select("uid", "members", "vector").mapInArrow(
        dealt, "uid long, members long, dim int, vector binary, cells binary, cell array<int>")
    held = held.select("uid", "members", "dim", "vector", "cells",
                       F.posexplode("cell").alias("table", "cell"))
    place = ["dim", "table", "cell"]
    large = held.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS)
    blocks = F.coalesce(F.ceil(F.col("n") / CELL_ROWS), F.lit(1)).cast("int")
    held = held.join(large, place, "left").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    groups = max(1, classes.count() * tables // GROUP_ROWS)
    held = held.select(
        "uid", "members", "vector", "cells", *place, "block", i.alias("i"), j.alias("j"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64(*place), F.lit(groups)))
        .otherwise(groups + F.pmod(F.xxhash64(*place, i, j), F.lit(1 << 40))).alias("deal"))

    def task(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, t, _, x, y), own in part.groupby([*place, "i", "j"], sort=False):
            if len(own) > 1:
                out += linked_within(own, t, (x, y), similar)
        return pd.DataFrame(out, columns=["uid", "n", "to"]).astype("int64")

    links = cut(held.groupBy("deal").applyInPandas(task, "uid long, n long, to long"))
    named = settle(classes, links).join(classes.select("uid", "vector"), "uid").select(
        "vector", "n_links", "component_id")
    return rows.select("id", "vector").join(named, "vector", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
