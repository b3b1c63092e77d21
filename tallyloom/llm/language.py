"""Language ID: rank-order profiles of n-grams, compared by out-of-place distance.

A text is put in lower case; whatever is not a letter, or beyond ASCII, becomes one space.
Its n-grams are 1 to 4 bytes of a word with a space before and behind. A language's profile
ranks the KEPT most frequent n-grams of all its training texts; a document's n-grams are
ranked the same way, and the distance to a language is the sum of how far each stands from
its rank there, KEPT for those that are not in the profile. The nearest language wins.

Training counts are summed in each task before they are shuffled, and ranked with a limit in
each partition, so a language with most of the rows is no hot spot. Profiles go to the driver
and, broadcast once, into the tasks as postings: for each n-gram the languages that have it
and its place there. That is some 10 bytes an n-gram, 4 KB a language, and grows with the
number of labels only, of which any number may be. A text looks at the postings of its own
n-grams, so it pays for the languages it has something in common with.

Cases: null text or text without a letter is `und` with score 0, and so is any text if
nothing was learned. Equal distances: the language first in order. A null doc_id is neither
learned from nor held out. Repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from . import common
from .common import bounded_batches, flat, ragged

KEPT = 400  # n-grams in a profile
LONGEST = 4  # bytes of an n-gram
HELD = 500_000  # n-grams a training task holds before it passes its counts on
TEXT_BYTES = 1 << 18  # of text whose n-grams are numbered together, some 100 bytes for each

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def pieces(batches: Iterator[pa.RecordBatch],
           column: str = "text") -> Iterator[pa.RecordBatch]:
    return common.pieces(batches, column, TEXT_BYTES)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as numbers, and the text of each."""
    data, offsets = flat(pc.utf8_lower(pc.fill_null(column, "")))
    # one space before each text and one behind the last
    n = len(offsets) - 1
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded = np.full(len(data) + n + 1, 32, np.uint8)
    padded[at] = _LETTERS[data]
    doc = np.zeros(len(padded), np.int64)
    doc[offsets[:-1] + np.arange(n)] = 1
    doc = np.cumsum(doc) - 1
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 32) | (padded[:-1] != 32)
    keep[offsets[:-1] + np.arange(n)] = True  # the first space of each text stays
    padded, doc = padded[keep].astype(np.uint32), doc[keep]
    space = padded == 32
    total = len(padded)
    keys, docs = [], []
    value = np.zeros(total, np.uint32)
    for size in range(1, LONGEST + 1):
        m = total - size + 1
        if m <= 0:
            break
        value = (value[:m] << np.uint32(8)) | padded[size - 1:]
        inner = np.zeros(m, bool)
        for i in range(1, size - 1):
            inner |= space[i:i + m]
        # the space behind a text is the one before the next
        good = ~inner & ~(space[:m] & space[size - 1:])
        keys.append(value[good])
        docs.append(doc[:m][good])
    if not keys:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(docs)


def counted(keys: np.ndarray, weights: np.ndarray | None = None,
            ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their counts, or the sums of their weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    if weights is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def ranked(keys: np.ndarray, counts: np.ndarray, kept: int) -> np.ndarray:
    """The most frequent n-grams, equal ones in their own order."""
    return keys[np.argsort(-counts, kind="stable")[:kept]]


def train(documents: DataFrame, text: str = "text", lang: str = "lang",
          kept: int = KEPT) -> DataFrame:
    """lang, gram, place (from 0): the profile of every language, from all the rows."""

    bounded_batches(documents.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}  # of the labels the task has seen
        held: list[tuple[np.ndarray, np.ndarray]] = []  # (label, n-gram) as one key, counts

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return counted(np.concatenate([k for k, _ in held]),
                           np.concatenate([n for _, n in held]))

        def out() -> pa.RecordBatch:
            keys, counts = merged()
            label = pa.array(list(numbers), pa.string())
            return pa.record_batch({
                "lang": label.take(pa.array((keys >> np.uint64(32)).astype(np.int64))),
                "gram": pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                "n": pa.array(counts.astype(np.int64))})

        for batch in pieces(batches):
            own = np.array([numbers.setdefault(x, len(numbers))
                            for x in batch.column("lang").to_pylist()], np.uint64)
            keys, docs = grams(batch.column("text"))
            held.append(counted((own[docs] << np.uint64(32)) | keys))
            if sum(len(k) for k, _ in held) > HELD:
                held[:] = [merged()]
                if len(held[0][0]) > HELD // 2:
                    yield out()
                    held.clear()
                    numbers.clear()
        if held:
            yield out()

    found = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null").mapInArrow(task, "lang string, gram long, n long")
    found = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return found.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= kept).select("lang", "gram", (F.col("place") - 1).alias("place"))


@dataclass
class Profiles:
    names: list[str]
    grams: np.ndarray  # all that are in a profile, sorted
    starts: np.ndarray  # first posting of each, and the end
    langs: np.ndarray  # language of each posting, in order
    places: np.ndarray  # place of the n-gram in that language
    kept: int

    def nearest(self, top: np.ndarray) -> tuple[str, float]:
        """Language of ranked n-grams, and how near it is: 1 for the profile itself.

        Every n-gram a profile has takes KEPT less its distance off the largest one possible.
        """
        at = np.minimum(np.searchsorted(self.grams, top), max(len(self.grams) - 1, 0))
        rank = np.flatnonzero(self.grams[at] == top) if len(self.grams) else at[:0]
        first, after = self.starts[at[rank]], self.starts[at[rank] + 1]
        posting = ragged(first, after - first)
        apart = np.abs(self.places[posting] - np.repeat(rank, after - first))
        langs, of = np.unique(self.langs[posting], return_inverse=True)
        most = self.kept * len(top)
        if not len(langs):
            return self.names[0], 0.0
        near = np.bincount(of.reshape(-1), self.kept - apart)
        best = int(np.argmax(near))
        return self.names[langs[best]], 1.0 - float(most - near[best]) / most


def collect_profiles(profiles: DataFrame, kept: int = KEPT) -> Profiles:
    """At most `kept` rows a language."""
    rows = profiles.select("lang", F.col("gram").cast("long").alias("gram"),
                           F.col("place").cast("int").alias("place")).toArrow()
    label = rows.column("lang").combine_chunks().dictionary_encode()
    if isinstance(label, pa.ChunkedArray):
        label = label.combine_chunks()
    names = label.dictionary.to_pylist()
    order = np.argsort(np.array(names, object), kind="stable")
    number = np.empty(len(names), np.int32)
    number[order] = np.arange(len(names))
    langs = number[np.asarray(label.indices)] if len(names) else np.zeros(0, np.int32)
    grams_ = np.asarray(rows.column("gram")).astype(np.uint32)
    places = np.asarray(rows.column("place")).astype(np.int32)
    by = np.lexsort((langs, grams_))
    keys, starts = np.unique(grams_[by], return_index=True)
    return Profiles([names[i] for i in order], keys, np.append(starts, len(by)), langs[by],
                    places[by], kept)


def letters_in(column: pa.Array) -> np.ndarray:
    """Which texts have a letter."""
    found = np.array(pc.match_substring_regex(pc.fill_null(column, ""), "[A-Za-z]"))
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, column[int(i)].as_py() or ""))
    return found


def predict(documents: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The documents, all columns, with lang_pred and score behind them."""
    bounded_batches(documents.sparkSession)
    schema = StructType([*documents.schema.fields]).add("lang_pred", StringType()).add(
        "score", DoubleType())
    shared = documents.sparkSession.sparkContext.broadcast(profiles)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in pieces(batches, text):
            column = batch.column(text)
            keys, docs = grams(column)
            both, counts = counted((docs.astype(np.uint64) << np.uint64(32)) | keys)
            owner = (both >> np.uint64(32)).astype(np.int64)
            bounds = np.searchsorted(owner, np.arange(len(column) + 1))
            keys = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            known = letters_in(column)
            names, scores = [], []
            for d in range(len(column)):
                a, b = bounds[d], bounds[d + 1]
                if not known[d] or a == b or not profiles.names:
                    names.append("und")
                    scores.append(0.0)
                    continue
                name, score = profiles.nearest(ranked(keys[a:b], counts[a:b], profiles.kept))
                names.append(name)
                scores.append(score)
            yield pa.record_batch(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return documents.mapInArrow(task, schema)


def third(key: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(key.cast("string").cast("binary")) % 3


def learned(documents: DataFrame, key: str = "doc_id") -> Profiles:
    """Profiles from the documents that are not held out."""
    return collect_profiles(train(documents.where(third(F.col(key)) != 1)))


def keep_recognised(documents: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The documents, all columns as they were, without those that no language is found for.

    These are texts without a letter, null ones too, and texts that have no n-gram in common
    with any profile.
    """
    names = documents.columns
    inner = documents.select(F.col(text).alias("text"),
                             F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    return predict(inner, profiles).where("lang_pred <> 'und' and score > 0").select("row.*")
