"""Best-fit packing: token pieces into sequences of a fixed size, by linear grouping.

Tokens: texts are split at ASCII white space, which the vocabulary drops and no token
crosses, so the ids of a text are the ids of its parts in turn. Each task numbers distinct
parts once (Arrow's dictionary) and gathers their ids; words met before come from a bounded
cache of Arrow arrays, the others are encoded some thousands at a time. Only id, place, length
and checksum of each piece leave the task.

Packing: the pieces are dealt at random into groups of about GROUP pieces, each packed by
one task, so neither driver nor task ever sees more; a group loses less than one sequence.
In a group, lengths above a limit are sorted and cut into classes of equal cardinality, and
each rounded up to the largest of its class. Over these few sizes a linear program finds how
often each configuration is used; its columns come from a knapsack by dynamic programming.
Whole multiples are taken, the few sizes left over are configured one by one. Actual
documents take the places of the rounded ones. Sequences that are then not well filled are
dissolved, and their pieces, with all small ones, go best-fit into the free space, longest
first.

Cases: null text is an empty one, whose piece is the end token alone. Rows with equal or
null doc_ids are packed each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, pieces

SIZE = 4096  # tokens in a sequence
END = 1  # id that ends a document
GROUP = 1 << 16  # pieces packed together
CLASSES = 64  # of large lengths
SMALL = SIZE // 16  # lengths up to this are small
SLACK = SIZE // 64  # free space a configuration may leave
DISSOLVE = SIZE // 128  # sequences with more free space are filled anew
BATCH_BYTES = 16 << 20  # of text whose parts are numbered together
JOINED = 4000  # plain words numbered at once
MISSED = 16_000  # unknown words numbered at once
CACHED = 150_000  # entries in a generation of a worker's cache
KEPT = 256  # bytes of the longest words that are kept

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Letters that turn to lower case one by one, then marks that stand for themselves.
_LOWER = re.compile("[a-zß-öø-ÿ]+")
_PLAIN = r"\A(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)\z"


class Recent:
    """Ids of words looked up of late: at most two generations of so many, as Arrow arrays."""

    def __init__(self, limit: int):
        self.limit = limit
        self.new = self.old = pa.table({"word": pa.array([], pa.large_string()),
                                        "ids": pa.array([], pa.large_binary())})

    def find(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The ids, null where they are not here, and which of them are in the new generation."""
        known = pa.concat_tables([self.new, self.old]).combine_chunks()
        if not len(known):
            return pa.nulls(len(words), pa.large_binary()), np.zeros(len(words), bool)
        at = pc.index_in(words, value_set=known["word"].chunk(0))
        recent = pc.fill_null(pc.less(at, len(self.new)), False)
        return known["ids"].chunk(0).take(at), recent.to_numpy(zero_copy_only=False)

    def keep(self, words: pa.Array, ids: pa.Array) -> None:
        """A full generation becomes the old one, and the old one goes."""
        if len(self.new) + len(words) > self.limit:
            self.new, self.old = self.new.slice(0, 0), self.new
        fresh = pa.table({"word": words, "ids": ids}).slice(0, self.limit)
        self.new = pa.concat_tables([self.new, fresh]).combine_chunks()


class Tokens:
    """Ids of parts of texts, as bytes of little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Recent(CACHED)

    def _of_words(self, words: pa.Array) -> pa.Array:
        """Ids of what is numbered as one text, each word once."""
        ids, recent = self.words.find(words)
        unknown = ids.is_null()
        missing = np.flatnonzero(unknown)
        if len(missing):
            fresh = [pa.array(self._numbered(words.take(pa.array(missing[at:at + MISSED]))
                                             .to_pylist()), pa.large_binary())
                     for at in range(0, len(missing), MISSED)]
            ids = pc.replace_with_mask(ids, unknown, pa.concat_arrays(fresh))
        short = pc.less_equal(pc.binary_length(words), KEPT).to_numpy(zero_copy_only=False)
        some = pa.array(np.flatnonzero(short & ~recent)[:CACHED])
        self.words.keep(words.take(some), ids.take(some))
        return ids

    def _numbered(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not known."""
        values = [b""] * len(words)
        plain, other = [], []
        for i, word in enumerate(words):
            (plain if _LOWER.fullmatch(word) else other).append(i)
        for at in range(0, len(plain), JOINED):
            some = plain[at:at + JOINED]
            for i, ids in zip(some, self._joined([words[i] for i in some])):
                values[i] = ids
        found = self.tokenizer.encode_batch_fast([words[i] for i in other],
                                                 add_special_tokens=False)
        for i, x in zip(other, found):
            values[i] = np.array(x.ids, "<u4").tobytes()
        return values

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of plain words, numbered as one text: each is one word to the vocabulary."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))
        if len(counts) != len(words):
            raise ValueError("the vocabulary splits words that it should keep")
        data, ends = np.array(found.ids, "<u4").tobytes(), np.cumsum(counts) * 4
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def of_parts(self, parts: pa.Array) -> pa.Array:
        """A plain word and marks behind it are numbered apart, the word in lower case.

        Only words are kept: what a part adds to them is soon put together again. Python
        sees no part and no known word, only the words that are not known.
        """
        parts = parts.cast(pa.large_string())
        pairs = pc.extract_regex(parts, _PLAIN)
        word = pc.coalesce(pc.utf8_lower(pc.struct_field(pairs, "word")), parts)
        marks = pc.fill_null(pc.struct_field(pairs, "marks"), "")
        del pairs
        both = pa.concat_arrays([word, marks]).dictionary_encode()
        del word, marks
        ids = self._of_words(both.dictionary)
        at, n = both.indices, len(parts)
        return pc.binary_join_element_wise(ids.take(at[:n]), ids.take(at[n:]),
                                           pa.scalar(b"", pa.large_binary()))

    def of(self, parts: list[str]) -> list[bytes]:
        """The same for a list."""
        return self.of_parts(pa.array(parts, pa.large_string())).to_pylist()


_TOKENS: dict[str, Tokens] = {}


def worker_tokens(path: str) -> Tokens:
    """One for all tasks of a Python worker: a task's own copy of _TOKENS would be empty."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def batch_ids(column: pa.Array, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in turn, without end tokens, and the number of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    bounds = np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()
    parts = split.flatten().dictionary_encode()
    del split
    ids = tokens.of_parts(parts.dictionary).take(parts.indices)
    _, offsets, data = ids.buffers()
    sums = np.frombuffer(offsets, np.int64, len(ids) + 1) // 4 if len(ids) else np.zeros(1, int)
    flat_ids = np.frombuffer(data, "<u4", sums[-1]) if sums[-1] else np.zeros(0, "<u4")
    return flat_ids, np.diff(sums[bounds])


def token_pieces(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(path)
        for batch in pieces(batches, limit=BATCH_BYTES):
            ids, counts = batch_ids(batch.column("text"), tokens)
            rows: list[tuple] = []
            at = 0
            for doc, n in enumerate(counts.tolist()):
                whole = np.append(ids[at:at + n], np.uint32(end)).astype("<u4")
                at += n
                for piece, start in enumerate(range(0, n + 1, size)):
                    part = whole[start:start + size]
                    rows.append((doc, piece, start, len(part), zlib.crc32(part)))
            doc, piece, start, length, crc = zip(*rows)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(doc)),
                "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    slim = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(task, PIECES)


def best_configuration(sizes: np.ndarray, counts: np.ndarray, size: int,
                       slack: int = 0) -> np.ndarray:
    """How many of each size (largest first) fill this much space, up to `slack`, or best."""
    if size <= slack:
        return np.zeros(len(sizes), np.int64)
    top = np.full(size + 1, -1)  # the size that reached this sum last
    top[0] = len(sizes)
    used = {}
    for k in np.flatnonzero((counts > 0) & (sizes <= size)):
        s = int(sizes[k])
        fresh = np.zeros(size + 1, np.int64)  # how many of this size a sum uses
        reached = top >= 0
        for turn in range(1, min(int(counts[k]), size // s) + 1):
            new = np.zeros(size + 1, bool)
            new[s:] = reached[:-s] if turn == 1 else last[:-s]
            new &= top < 0
            if not new.any():
                break
            top[new] = k
            fresh[new] = turn
            last = new
        used[k] = fresh
        if (top[size - slack:] >= 0).any():
            break  # larger sizes come first: they are the harder ones to place
    at = int(np.flatnonzero(top >= 0)[-1])
    out = np.zeros(len(sizes), np.int64)
    while at > 0:
        k = top[at]
        out[k] = used[k][at]
        at -= int(out[k] * sizes[k])
    return out


def knapsack(sizes: np.ndarray, worth: np.ndarray, size: int) -> np.ndarray:
    """How many of each size are worth most together in this much space."""
    best = np.zeros(size + 1)
    last = np.full(size + 1, -1)
    for k in np.argsort(-worth / sizes, kind="stable"):
        s, w = int(sizes[k]), float(worth[k])
        if w <= 1e-12:
            break
        for low in range(s, size + 1, s):  # one more of this size in each turn
            block = slice(low, min(low + s, size + 1))
            found = best[low - s:block.stop - s] + w
            better = found > best[block] + 1e-12
            best[block][better] = found[better]
            last[block][better] = k
    out = np.zeros(len(sizes), np.int64)
    at = size
    while at > 0:
        if last[at] < 0:
            at -= 1
            continue
        out[last[at]] += 1
        at -= int(sizes[last[at]])
    return out


def configurations(sizes: np.ndarray, counts: np.ndarray, size: int) -> tuple:
    """Configurations (columns) and how often each is used, by column generation."""
    k = len(sizes)
    columns = np.diag(size // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amounts = counts / np.diag(columns)
    for _ in range(20 * k):
        worth = inverse.sum(0)
        column = knapsack(sizes, np.maximum(worth, 0), size).astype(float)
        if worth @ column <= 1 + 1e-7:
            break
        step = inverse @ column
        can = step > 1e-9
        ratio = np.where(can, amounts / np.where(can, step, 1), np.inf)
        out = int(np.argmin(ratio))
        amounts = np.maximum(amounts - ratio[out] * step, 0)
        amounts[out] = ratio[out]
        columns[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return columns.astype(np.int64), amounts


def pack(lengths: np.ndarray, size: int = SIZE, classes: int = CLASSES,
         small: int = SMALL, slack: int = SLACK,
         dissolve: int = DISSOLVE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece of one group."""
    sequence = np.full(len(lengths), -1, np.int64)
    offset = np.zeros(len(lengths), np.int64)
    free: list[int] = []

    order = np.argsort(-lengths, kind="stable")
    large = order[lengths[order] > small]
    bounds = np.unique(np.linspace(0, len(large), classes + 1).astype(np.int64))
    queues = [list(large[a:b][::-1]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([lengths[large[a]] for a in bounds[:-1]], np.int64)
    counts = np.diff(bounds)

    def place(config: np.ndarray, times: int) -> None:
        for _ in range(times):
            at = 0
            for k in np.flatnonzero(config):
                for _ in range(config[k]):
                    item = queues[k].pop()
                    sequence[item], offset[item] = len(free), at
                    at += int(lengths[item])
            free.append(size - at)
        counts[:] -= config * times

    if len(sizes):
        columns, amounts = configurations(sizes, counts, size)
        for k, amount in enumerate(amounts):
            config = columns[:, k]
            used = config > 0
            place(config, min(int(amount + 1e-6), int((counts[used] // config[used]).min())))
    while counts.any():
        largest = int(np.flatnonzero(counts)[0])
        counts[largest] -= 1
        best = best_configuration(sizes, counts, size - int(sizes[largest]), slack)
        counts[largest] += 1
        best[largest] += 1
        place(best, 1)

    loose = np.array([*free, 0])[sequence] > dissolve
    kept = np.array(free, np.int64) <= dissolve
    number = np.cumsum(kept) - 1
    sequence = np.where(loose | (sequence < 0), -1, np.append(number, -1)[sequence])
    free = [f for f in free if f <= dissolve]
    by_free: dict[int, list[int]] = {}
    mask = 0  # bit f: some sequence has f tokens free
    for s, f in enumerate(free):
        by_free.setdefault(f, []).append(s)
        mask |= 1 << f
    for i in order[sequence[order] < 0].tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            s = by_free[f].pop()
            if not by_free[f]:
                mask &= ~(1 << f)
        else:
            f, s = size, len(free)
            free.append(size)
        sequence[i], offset[i] = s, size - f
        by_free.setdefault(f - n, []).append(s)
        mask |= 1 << (f - n)
    return sequence, offset


def pack_pieces(found: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset. They are written once, so that groups hold."""
    found = cut(found)
    groups = max(1, -(-found.count() // group))
    dealt = found.withColumn(
        "pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack(rows["length"].to_numpy(), size)
        rows["sequence_id"] = rows.pop("pack_group").to_numpy() * (1 << 32) + sequence
        rows["offset"] = offset
        return rows

    return dealt.groupBy("pack_group").applyInPandas(
        task, f"{PIECES}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                   size: int = SIZE, end: int = END) -> DataFrame:
    return pack_pieces(token_pieces(documents, path, key, text, size, end), size)
