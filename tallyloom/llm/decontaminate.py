"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

A shard is about a megabyte of documents. Its words are numbered by the benchmark's
vocabulary; only runs of such words that are long enough to hold a phrase are indexed, since
a phrase cannot reach over a foreign word. The shard's suffixes are sorted, the last column
is kept as a wavelet tree, all phrases are searched backwards at once by rank, and the
occurrences are found by walking to sampled suffix positions. Spans of hit words are merged.

Documents stay where they are: no shuffle, and memory is bounded by a shard. The benchmark
goes to the tasks in blocks of bounded size, however large it is.

Cases: null text, or text without words, has no hits. Null or repeated doc_ids are rows like
others, each with its own result. An item without words has no phrase, one with fewer words
than a phrase is a phrase itself. Repeated items count once, a null item_id counts as ''.
With an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, bounded_batches, covered, flat, pieces, ragged, two_columns

PHRASE = 10  # words
SHARD_BYTES = 1 << 20  # of text in an index
BLOCK_BYTES = 8 << 20  # of benchmark text in one broadcast
SAMPLED = 8  # every so manieth word of a run keeps its place

SCHEMA = ("doc_id long, n_words long, n_hit long, items array<string>, "
          "spans array<struct<start:int,end:int>>")


@dataclass
class Phrases:
    """A block of the benchmark: its vocabulary, its phrases, and whose they are."""

    hashes: np.ndarray  # of the vocabulary, sorted
    words: list[bytes]  # in the same order
    phrases: dict[int, np.ndarray]  # by length: a row of word numbers (from 1) per phrase
    owners: dict[int, list[list[str]]]  # by length: the items of each phrase


def compile_phrases(items: list[tuple[str, str]], length: int) -> Phrases:
    column = pa.array([text for _, text in items], pa.large_string())
    w = Words(*flat(column), ALNUM)
    hashes, first, number = np.unique(w.hashes(), return_index=True, return_inverse=True)
    found: dict[int, dict[tuple, set[str]]] = {}
    for k, (item, _) in enumerate(items):
        own = number[w.offsets[k]:w.offsets[k + 1]] + 1
        size = min(length, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            phrase = tuple(own[i:i + size].tolist())
            found.setdefault(size, {}).setdefault(phrase, set()).add(item)
    return Phrases(hashes, [w.text(i) for i in first],
                   {k: np.array(list(v), np.int64).reshape(-1, k) for k, v in found.items()},
                   {k: [sorted(x) for x in v.values()] for k, v in found.items()})


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; a 0 ends a run and sorts by its place."""
    n = len(symbols)
    stops = symbols == 0
    n_stops = int(stops.sum())
    rank = symbols + n_stops
    rank[stops] = np.arange(n_stops)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        ranked = rank[order]
        new = np.ones(n, bool)
        new[1:] = ranked[1:] != ranked[:-1]
        if new.all():
            return order
        place = np.flatnonzero(new)[np.cumsum(new) - 1]  # first place of each equal group
        rank = np.empty(n, np.int64)
        rank[order] = place
        open_ = ~new
        open_[:-1] |= ~new[1:]
        at = np.flatnonzero(open_)  # places of suffixes that share their rank
        rows = order[at]
        # an open suffix has no stop within `step`, so there is a suffix behind it
        key = rank[rows] * n + rank[np.minimum(rows + step, n - 1)]
        within = np.argsort(key, kind="stable")
        order[at] = rows[within]
        sorted_key = key[within]
        new = np.ones(len(at), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank[rows[within]] = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        step *= 2


class WaveletTree:
    """Ranks of symbols in a column, a bit vector with running counts for each bit."""

    def __init__(self, column: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = ((column >> bit) & 1).astype(bool)
            zeros_before = np.zeros(len(column) + 1, np.int32)
            np.cumsum(~ones, out=zeros_before[1:])
            self.levels.append((bit, zeros_before))
            column = np.concatenate([column[~ones], column[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        low = np.zeros(len(symbol), np.int64)
        at = at.astype(np.int64)
        for bit, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            total = zeros[-1]
            low, at = (np.where(one, total + low - zeros[low], zeros[low]),
                       np.where(one, total + at - zeros[at], zeros[at]))
        return at - low


class FMIndex:
    """Index over runs of word numbers; every run ends with a 0."""

    def __init__(self, symbols: np.ndarray, run_place: np.ndarray, sigma: int):
        order = suffix_order(symbols.copy())
        self.last = symbols[order - 1]
        self.tree = WaveletTree(self.last, max(1, int(sigma).bit_length()))
        self.before = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=sigma + 1), out=self.before[1:])
        self.n = len(symbols)
        sampled = run_place[order] % SAMPLED == 0
        self.sample_rank = np.zeros(self.n + 1, np.int64)
        np.cumsum(sampled, out=self.sample_rank[1:])
        self.samples = order[sampled]
        self.sampled = sampled

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, j]
            low[alive] = self.before[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.tree.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        low[dead] = high[dead] = 0
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these ranks begin."""
        out = np.zeros(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(left):
            there = self.sampled[rows]
            out[left[there]] = self.samples[self.sample_rank[rows[there]]] + steps
            left, rows = left[~there], rows[~there]
            symbol = self.last[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return out


def occurrences(w: Words, hashes: np.ndarray,
                block: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(phrase length, first word of each occurrence, its phrase) in a shard."""
    if not block.phrases or not len(w):
        return
    at = np.minimum(np.searchsorted(block.hashes, hashes), len(block.hashes) - 1)
    number = np.where(block.hashes[at] == hashes, at + 1, 0)
    known = number > 0
    first = np.zeros(len(w) + 1, bool)
    first[w.offsets] = True
    begins = known & (first[:-1] | ~np.concatenate([[False], known[:-1]]))
    finish = known & (first[1:] | ~np.concatenate([known[1:], [False]]))
    starts, sizes = np.flatnonzero(begins), np.flatnonzero(finish) - np.flatnonzero(begins) + 1
    keep = sizes >= min(block.phrases)
    starts, sizes = starts[keep], sizes[keep]
    if not len(starts):
        return
    place = ragged(starts, sizes + 1)
    run_place = ragged(np.zeros(len(sizes), np.int64), sizes + 1)
    symbols = number[np.minimum(place, len(w) - 1)]
    symbols[np.cumsum(sizes + 1) - 1] = 0
    index = FMIndex(symbols, run_place, len(block.hashes))
    for length, phrases in block.phrases.items():
        low, high = index.search(phrases)
        count = high - low
        found = place[index.locate(ragged(low, count))]
        which = np.repeat(np.arange(len(phrases)), count)
        # equal hashes are not yet equal words
        spots = ragged(found, np.full(len(found), length))
        same = np.fromiter((w.text(i) == block.words[number[i] - 1] for i in spots), bool,
                           len(spots)).reshape(-1, length).all(1)
        yield length, found[same], which[same]


def scan_shard(column: pa.Array, blocks: Iterator[Phrases],
               ) -> tuple[Words, np.ndarray, list[set[str]]]:
    """Words of a shard, which of them are hit, and the items found in each text."""
    w = Words(*flat(column), ALNUM)
    hashes = w.hashes()
    hit = np.zeros(len(w), bool)
    items: list[set[str]] = [set() for _ in range(len(column))]
    for block in blocks:
        for length, found, which in occurrences(w, hashes, block):
            hit |= covered(found, length, len(w))
            docs = np.searchsorted(w.offsets, found, "right") - 1
            pairs = np.unique(docs * len(block.owners[length]) + which)
            for pair in pairs.tolist():
                doc, phrase = divmod(pair, len(block.owners[length]))
                items[doc].update(block.owners[length][phrase])
    return w, hit, items


def hit_spans(w: Words, hit: np.ndarray, data: np.ndarray, offsets: np.ndarray,
              doc: int) -> list[tuple[int, int]]:
    """Runs of hit words of a text, in code points."""
    a, b = w.offsets[doc], w.offsets[doc + 1]
    own = np.flatnonzero(hit[a:b]) + a
    if not len(own):
        return []
    text = data[offsets[doc]:offsets[doc + 1]]
    points = np.zeros(len(text) + 1, np.int64)
    np.cumsum((text & 0xC0) != 0x80, out=points[1:])
    split = np.flatnonzero(np.diff(own) > 1)
    heads = np.concatenate([own[:1], own[split + 1]])
    tails = np.concatenate([own[split], own[-1:]])
    return list(zip(points[w.starts[heads] - offsets[doc]].tolist(),
                    points[w.ends[tails] - offsets[doc]].tolist()))


def phrase_blocks(benchmark: DataFrame, key: str, text: str, length: int) -> list:
    """The benchmark as broadcasts of bounded size, one after the other."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"),
                            F.col(text).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    out = []
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        out.append(spark.sparkContext.broadcast(
            compile_phrases([(r["item"], r["text"]) for r in part], length)))
    return out


def find_hits(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id",
              text: str = "text", item_key: str = "item_id", item_text: str = "text",
              length: int = PHRASE) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans of every document (see the module)."""
    blocks = phrase_blocks(benchmark, item_key, item_text, length)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[Phrases]:
            for b in blocks:
                yield b.value
                if len(blocks) > 1:
                    b.__dict__.pop("_value", None)  # one block in memory at a time

        for batch in pieces(batches, limit=SHARD_BYTES):
            column = batch.column("text")
            w, hit, items = scan_shard(column, each())
            data, offsets = flat(column)
            hits = np.add.reduceat(np.append(hit, False), w.offsets[:-1]) * (w.counts > 0)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(w.counts),
                "n_hit": pa.array(hits.astype(np.int64)),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                "spans": pa.array(
                    [[{"start": a, "end": b} for a, b in hit_spans(w, hit, data, offsets, d)]
                     if hits[d] else [] for d in range(len(column))],
                    pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))),
            })

    return two_columns(documents, key, text).mapInArrow(task, SCHEMA)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return "".join([*out, text[at:]])


def remove_hits(documents: DataFrame, benchmark: DataFrame, text: str = "text",
                item_key: str = "item_id", item_text: str = "text",
                length: int = PHRASE) -> DataFrame:
    """The documents, all columns as they were, with the hit spans cut out of the text.

    A column n_chars, where there is one, is set anew for texts that change.
    """
    bounded_batches(documents.sparkSession)
    blocks = phrase_blocks(benchmark, item_key, item_text, length)
    names = documents.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, SHARD_BYTES):
            column = batch.column(text)
            w, hit, _ = scan_shard(column, (b.value for b in blocks))
            if hit.any():
                data, offsets = flat(column)
                texts = column.to_pylist()
                changed = np.unique(np.searchsorted(w.offsets, np.flatnonzero(hit), "right") - 1)
                for d in changed.tolist():
                    texts[d] = cut_text(texts[d], hit_spans(w, hit, data, offsets, d))
                columns = {n: batch.column(n) for n in names}
                columns[text] = pa.array(texts, column.type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for d in changed.tolist():
                        sizes[d] = len(texts[d])
                    columns["n_chars"] = pa.array(sizes, batch.column("n_chars").type)
                batch = pa.record_batch(list(columns.values()), names=names)
            yield batch

    return documents.mapInArrow(task, documents.schema)


def digest(items: Column) -> Column:
    """Hash of the items, comma-joined."""
    return F.sha2(F.array_join(items, ","), 256)


def brute_force(texts: list[str | None], items: list[tuple], length: int = PHRASE) -> list:
    """(n_words, n_hit, items_sha256) of each text, word by word; for tests."""
    import re

    def split(text: str | None) -> list[str]:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    out = []
    for text in texts:
        own, hit, found = split(text), set(), set()
        for item, phrase_text in items:
            words = split(phrase_text)
            size = min(length, len(words))
            windows = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
            for i in range(len(own) - size + 1 if size else 0):
                if tuple(own[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((len(own), len(hit),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out
