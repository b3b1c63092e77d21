"""Substring dedup by recompression: word runs that start in a smaller document go.

A document's words are recompressed in rounds. In a round, runs of one symbol get a name,
then neighbouring symbols of which the left one falls to the left half of all symbols and the
right one to the right half get a common name. Names are hashes of what they stand for, so
all tasks give equal substrings equal names without a dictionary. For each symbol the words
that its being there depends on are known; if they all lie inside a window of WINDOW words,
every other place of this window has the same symbol with the same words around it.

1. Documents are dealt into shards. Exact copies of a smaller document are told from slim
   rows (id and digest); they are removed whole and take no further part.
2. Every shard asks which of its high-level symbols occur in more than one document. A window
   with a symbol that occurs in one document only has no second place and is ruled out.
3. For the windows left (few), shards ask with 96-bit fingerprints for the smallest document
   of each. Words of windows that start in a smaller document are removed.

A shard asks for each distinct key once and gets one bit back, so a passage that is in a
third of all documents costs a key for each shard, wherever its documents are. Keys are dealt
to buckets whose number grows with the corpus. The text is shuffled once; the three passes
read the same exchange.

Cases: null text has no words. A null doc_id counts as the largest 64-bit number, and comes
back as null. Rows with equal ids are not smaller than each other. A text of fewer than WINDOW words keeps them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, U64, Words, flat, mix, pieces, windows_hash

WINDOW = 13  # words
ROUNDS = 2
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # of text for each bucket of keys
FAR = 1 << 40

NOTES = "shard int, kind int, bucket int, doc_id long, h long, bits binary"
ASKED = "bucket int, shard int, keys binary, docs binary"
RESULT = "doc_id long, no_id boolean, h long, n_words long, n_removed long, kept_sha256 string"


@dataclass
class Symbols:
    """Symbols of some texts: their words, and the words they depend on (inclusive)."""

    name: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    low: np.ndarray
    high: np.ndarray


def name_runs(s: Symbols) -> Symbols:
    """Maximal runs of a symbol as one; it depends on the symbols beside it."""
    n = len(s.name)
    same_doc = s.doc[1:] == s.doc[:-1]
    begin = np.ones(n, bool)
    begin[1:] = ~(same_doc & (s.name[1:] == s.name[:-1]))
    a = np.flatnonzero(begin)
    b = np.append(a[1:], n) - 1
    length = (b - a + 1).astype(U64)
    name = np.where(length > 1, mix(s.name[a] ^ mix(length)), s.name[a])
    inner = np.zeros(n + 1, bool)  # place k: symbols k-1 and k belong to one document
    inner[1:n] = same_doc
    low = np.where(inner[a], np.minimum(s.low[a - 1], s.low[a]), -FAR)
    after = np.minimum(b + 1, n - 1)
    high = np.where(inner[b + 1], np.maximum(s.high[after], s.high[b]), FAR)
    return Symbols(name, s.doc[a], s.first[a], s.last[b], low, high)


def name_pairs(s: Symbols, turn: int) -> Symbols:
    """A left symbol and the right one behind it as one; others depend on their neighbour."""
    n = len(s.name)
    right = (mix(s.name + U64(turn * 2 + 1)) & U64(1)).astype(bool)
    same_doc = s.doc[1:] == s.doc[:-1]
    joins = np.zeros(n, bool)  # with the next
    joins[:-1] = same_doc & ~right[:-1] & right[1:]
    second = np.zeros(n, bool)
    second[1:] = joins[:-1]
    a = np.flatnonzero(~second)
    b = a + joins[a]
    name = np.where(joins[a], mix(mix(s.name[a] + U64(turn + 77)) * U64(3) ^ s.name[b]),
                    s.name[a])
    inner = np.zeros(n + 1, bool)
    inner[1:n] = same_doc
    alone = ~joins[a]
    before, after = np.maximum(a - 1, 0), np.minimum(b + 1, n - 1)
    low = np.where(alone & right[a], np.where(
        inner[a], np.minimum(s.low[before], s.low[a]), -FAR), s.low[a])
    high = np.where(alone & ~right[a], np.where(
        inner[b + 1], np.maximum(s.high[after], s.high[b]), FAR), s.high[b])
    return Symbols(name, s.doc[a], s.first[a], s.last[b], low, high)


def recompress(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    place = np.arange(len(words))
    s = Symbols(words, doc, place, place, place, place)
    for turn in range(rounds):
        if len(s.name):
            s = name_pairs(name_runs(s), turn)
    return s


class Shard:
    """Documents of a shard with what has been answered so far."""

    def __init__(self, texts: pa.Table, notes: pa.Table, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        texts = texts.combine_chunks()
        notes = notes.to_pydict()
        self.bits = {k: {} for k in (1, 2)}
        copies = set()
        for kind, bucket, doc, h, bits in zip(*(notes[c] for c in (
                "kind", "bucket", "doc_id", "h", "bits"))):
            if kind == 0:
                copies.add((doc, h))
            else:
                self.bits[kind][bucket] = np.unpackbits(np.frombuffer(bits, np.uint8))
        self.parts = [Part(batch, copies, window) for batch in pieces(
            texts.to_batches()) if batch.num_rows]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct symbol keys of the shard: bucket in the upper half, 31 bits and a flag
        (in several documents) in the lower; and for each symbol its place among them."""
        key = np.concatenate([p.symbol_keys() for p in self.parts] or [np.zeros(0, U64)])
        doc = np.concatenate([p.symbol_docs for p in self.parts] or [np.zeros(0, np.int64)])
        own = ((key % U64(self.buckets)) << U64(32)) | ((key >> U64(20)) & U64(0x7FFFFFFF))
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        new = np.ones(len(own), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.cumsum(new) - 1
        place = np.empty(len(own), np.int64)
        place[order] = at
        starts = np.flatnonzero(new)
        several = np.zeros(len(starts), bool)
        if len(starts):
            docs = doc[order]
            several = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
        return (ranked[starts] << U64(1)) | several.astype(U64), place

    def answered(self, kind: int, bucket_of: np.ndarray) -> np.ndarray:
        """The answers to distinct keys, which are sorted by bucket."""
        out = np.zeros(len(bucket_of), bool)
        for b, bits in self.bits[kind].items():
            x, y = np.searchsorted(bucket_of, [b, b + 1])
            out[x:y] = bits[:y - x]
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows that may have a second place: bucket, fingerprints, smallest
        document; and of all such windows the place among them."""
        keys, place = self.keys()
        shared = self.answered(1, (keys >> U64(33)).astype(np.int64))[place]
        at = 0
        found = []
        for p in self.parts:
            n = len(p.symbol_docs)
            found.append(p.open_windows(shared[at:at + n]))
            at += n
        one, two, doc = (np.concatenate(x) for x in zip(*found)) if found else (
            np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        bucket = (one % U64(self.buckets)).astype(np.int64)
        order = np.lexsort((two, one, bucket))
        bucket, one, two, docs = bucket[order], one[order], two[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        starts = np.flatnonzero(new)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(docs, starts) if len(starts) else docs
        return bucket[starts], pack_prints(one[starts], two[starts]), least, place


_PRINT = np.dtype([("one", "<u8"), ("two", "<u4")])


def pack_prints(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.empty(len(one), _PRINT)
    out["one"], out["two"] = one, two
    return out


class Part:
    """A few megabytes of a shard's texts."""

    def __init__(self, batch: pa.RecordBatch, copies: set, window: int):
        self.window = window
        self.batch = batch
        ids = batch.column("doc_id").to_pylist()
        self.ids = np.array(ids, np.int64)
        self.copy = np.array([x in copies for x in zip(ids, batch.column("h").to_pylist())], bool)
        self.column = batch.column("text")
        data, offsets = flat(self.column)
        words = Words(data, offsets, SPACED, True)
        self.counts, self.offsets = words.counts, words.offsets
        doc = words.doc()
        keep = ~self.copy[doc]  # copies take no further part
        self.place = np.flatnonzero(keep)
        self.words, self.doc = words.hashes()[keep], doc[keep]
        s = recompress(self.words, self.doc)
        inside = s.high - s.low < window
        self.low, self.high = s.low[inside], s.high[inside]
        self.symbol_docs = self.ids[s.doc[inside]]
        self.names = s.name[inside]

    def symbol_keys(self) -> np.ndarray:
        return mix(windows_hash(self.words, self.low, self.high + 1) ^ self.names)

    def open_windows(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and documents of the windows that no symbol rules out."""
        n, w = len(self.words), self.window
        ruled = np.zeros(n + 1, np.int64)
        low, high = self.low[~shared], self.high[~shared]
        np.add.at(ruled, np.maximum(high - w + 1, 0), 1)
        np.add.at(ruled, low + 1, -1)
        fits = np.zeros(n, bool)
        if n >= w:
            fits[:n - w + 1] = self.doc[w - 1:] == self.doc[:n - w + 1]
        self.open = np.flatnonzero(fits & (np.cumsum(ruled[:n]) == 0))
        return (windows_hash(self.words, self.open, self.open + w, 1),
                (windows_hash(self.words, self.open, self.open + w, 2) >> U64(32)).astype(
                    np.uint32), self.ids[self.doc[self.open]])

    def results(self, gone: np.ndarray) -> pa.RecordBatch:
        """What is left; gone: of the open windows those that start in a smaller document."""
        step = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(step, self.open[gone], 1)
        np.add.at(step, self.open[gone] + self.window, -1)
        keep = np.ones(int(self.offsets[-1]), bool)
        keep[self.place] = np.cumsum(step[:-1]) == 0
        removed, digests = [], []
        for d, text in enumerate(self.column.cast(pa.large_binary())):
            words = (text.as_py() or b"").split()
            own = keep[self.offsets[d]:self.offsets[d + 1]]
            if self.copy[d]:
                own = np.full(len(own), len(own) < self.window)
            left = words if own.all() else list(compress(words, own.tolist()))
            removed.append(len(words) - len(left))
            digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return pa.record_batch({
            "doc_id": self.batch.column("doc_id"), "no_id": self.batch.column("no_id"),
            "h": self.batch.column("h"),
            "n_words": pa.array(self.counts), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string())})


def asked_rows(shard: int, bucket: np.ndarray, keys: np.ndarray, docs: np.ndarray | None,
               ) -> pa.Table:
    """A row for each bucket the shard asks; keys are sorted by bucket."""
    numbers = np.unique(bucket)
    bounds = np.searchsorted(bucket, np.append(numbers, numbers[-1:] + 1))
    spans = list(zip(bounds[:-1], bounds[1:]))
    return pa.table({
        "bucket": pa.array(numbers, pa.int32()),
        "shard": pa.array([shard] * len(numbers), pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
        "docs": pa.array([docs[a:b].tobytes() if docs is not None else b"" for a, b in spans],
                         pa.binary())})


def note_rows(kind: int, bucket: int, shards: list[int], answers: list[np.ndarray]) -> pa.Table:
    n = len(shards)
    return pa.table({
        "shard": pa.array(shards, pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
        "bucket": pa.array([bucket] * n, pa.int32()), "doc_id": pa.nulls(n, pa.int64()),
        "h": pa.nulls(n, pa.int64()),
        "bits": pa.array([np.packbits(a).tobytes() for a in answers], pa.binary())})


def answer_symbols(asked: pa.Table) -> pa.Table:
    """For each key whether it is in more than one document."""
    rows = asked.to_pydict()
    sent = [np.frombuffer(k, np.uint32) for k in rows["keys"]]
    every = np.concatenate(sent)
    ranked = np.sort(every >> np.uint32(1))
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    shared = np.unique(np.concatenate([again, every[(every & np.uint32(1)) > 0] >> np.uint32(1)]))
    answers = []
    for keys in sent:
        if len(shared):
            at = np.minimum(np.searchsorted(shared, keys >> np.uint32(1)), len(shared) - 1)
            answers.append(shared[at] == keys >> np.uint32(1))
        else:
            answers.append(np.zeros(len(keys), bool))
    return note_rows(1, rows["bucket"][0], rows["shard"], answers)


def answer_windows(asked: pa.Table) -> pa.Table:
    """For each window whether it is in a document smaller than all of the shard that asks."""
    rows = asked.to_pydict()
    sent = [np.frombuffer(k, _PRINT) for k in rows["keys"]]
    every, docs = np.concatenate(sent), np.concatenate(
        [np.frombuffer(d, np.int64) for d in rows["docs"]])
    order = np.lexsort((every["two"], every["one"]))
    ranked = every[order]
    new = np.ones(len(every), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(docs[order], starts)
    smaller = np.empty(len(every), bool)
    smaller[order] = least[np.cumsum(new) - 1] < docs[order]
    ends = np.cumsum([len(k) for k in sent])
    return note_rows(2, rows["bucket"][0], rows["shard"],
                     [smaller[e - len(k):e] for e, k in zip(ends, sent)])


def dedup_substrings(documents: DataFrame, key: str = "doc_id", text: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row (see the module)."""
    largest = (1 << 63) - 1
    slim = documents.select(
        F.coalesce(F.col(key).cast("long"), F.lit(largest)).alias("doc_id"),
        F.col(key).cast("long").isNull().alias("no_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, buckets = max(1, size // SHARD_BYTES), max(1, size // BUCKET_BYTES)
    shard = F.pmod(F.xxhash64("doc_id", "h"), F.lit(shards)).cast("int")
    texts = slim.select(shard.alias("shard"), "doc_id", "no_id", "h", "text")

    digests = slim.select("doc_id", "h", F.md5("text").alias("digest"))
    smallest = digests.groupBy("digest").agg(F.min("doc_id").alias("least"),
                                             F.max("doc_id").alias("most"))
    copies = digests.join(smallest.where("least < most"), "digest").where("doc_id > least")
    empty = F.lit(None)
    copies = copies.select(
        shard.alias("shard"), F.lit(0).alias("kind"), F.lit(0).alias("bucket"),
        F.col("doc_id").alias("doc_id"), F.col("h").alias("h"),
        empty.cast("binary").alias("bits")).distinct()

    def ask_symbols(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, _ = Shard(left, right, window, buckets).keys()
        return asked_rows(key[0].as_py(), (keys >> U64(33)).astype(np.int64),
                          (keys & U64(0xFFFFFFFF)).astype(np.uint32), None)

    def ask_windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        bucket, prints, least, _ = Shard(left, right, window, buckets).windows()
        return asked_rows(key[0].as_py(), bucket, prints, least)

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        held = Shard(left, right, window, buckets)
        bucket, _, least, place = held.windows()
        smaller = held.answered(2, bucket)
        out, at = [], 0
        for p in held.parts:
            own = place[at:at + len(p.open)]
            at += len(p.open)
            doc = p.ids[p.doc[p.open]]
            out.append(p.results(smaller[own] | (doc > least[own])))
        schema = pa.schema([("doc_id", pa.int64()), ("no_id", pa.bool_()), ("h", pa.int64()),
                            ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
        return pa.Table.from_batches(out, schema)

    def pass_over(notes: DataFrame, task, schema: str) -> DataFrame:
        return texts.groupBy("shard").cogroup(notes.groupBy("shard")).applyInArrow(task, schema)

    def answers(asked: DataFrame, task) -> DataFrame:
        return asked.groupBy("bucket").applyInArrow(task, NOTES)

    notes = copies
    notes = notes.union(answers(pass_over(notes, ask_symbols, ASKED), answer_symbols))
    notes = notes.union(answers(pass_over(notes, ask_windows, ASKED), answer_windows))
    return pass_over(notes, finish, RESULT).select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "n_words",
        "n_removed", "kept_sha256")
