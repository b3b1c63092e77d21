"""Suffix-array dedup: bytes of 100-byte strings that also start earlier go.

1. Documents are dealt into shards; exact copies of a smaller document are told from slim
   rows (id and digest) and removed whole.
2. Every 100-byte window has an anchor, the 32-byte string in it with the least hash, which
   equal windows share. Shards ask which anchors occur more than once; a window whose anchor
   occurs once has no second place and is done.
3. Each anchor left is sent, with the bytes of the windows it stands for, to a bucket where
   all anchors of its name meet. The suffixes of the bucket's texts are sorted by induction:
   suffixes are classified as smaller or larger than the next, the leftmost-smaller
   substrings are sorted and named, the order of these is found on the names, and that of all
   suffixes is induced from it bucket by bucket. Permuted common prefixes then tell which
   windows are equal. The shard gets a bit for each window: it starts in a smaller document.
4. Windows that start again in their own document are found the same way in the shard.

A shard sends equal texts once, and a bucket sorts equal texts once, so a passage costs one
entry for each shard, wherever its documents are. Buckets grow in number with the corpus and
are sorted in portions; the text is shuffled once, the three passes read the same exchange.

Cases: null text is empty. A null doc_id counts as the largest 64-bit number, and comes back
as null; rows with equal ids are not smaller than each other. A text below 100 bytes stays as it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PIECE_BYTES, U64, flat, pieces, ragged, ranges_hash, windows_hash
from .decontaminate import suffix_order
from .recompression import ASKED, NOTES, answer_symbols, asked_rows, note_rows

LENGTH = 100  # bytes
ANCHOR = 32
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # of text for each bucket
PORTION = 4 << 20  # bytes whose suffixes are sorted together, unless one anchor has more

RESULT = ("doc_id long, no_id boolean, h long, n_bytes long, n_removed long, n_spans long, "
          "kept_sha256 string")


# --- suffix sorting -------------------------------------------------------------------------

def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last counts as such."""
    n = len(t)
    differs = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    runs = np.diff(np.concatenate([[-1], differs]))
    below = np.append(t[1:] > t[:-1], True)
    return np.repeat(below[differs], runs)


def deal(places: np.ndarray, t: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Appends the places, in their order, to the lists of their symbols."""
    if not len(places):
        return
    symbols = t[places]
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(places)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        into[symbols[a]].append(places[a:b])


def induce(t: np.ndarray, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Order of all suffixes from that of the leftmost-smaller ones.

    Symbol 0 ends a text; it is another, larger one at every later place. A bucket is worked
    on in turns: what a turn adds to its own bucket is the next one's work.
    """
    sigma = int(t.max()) + 1
    stops = np.flatnonzero(t == 0).astype(np.int32)
    seeds: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    deal(leftmost[t[leftmost] != 0], t, seeds)
    seeds[0] = [stops]
    none = np.zeros(0, np.int32)

    larger: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for c in range(sigma):
        done, turn = 0, larger[c]
        while done < len(turn):
            now = np.concatenate(turn[done:])
            done = len(turn)
            before = now[now > 0] - 1
            before = before[~small[before]]
            deal(before, t, larger)
        if seeds[c]:
            before = np.concatenate(seeds[c])
            before = before[before > 0] - 1
            before = before[~small[before]]
            deal(before, t, larger)
    ordered = [np.concatenate(x) if x else none for x in larger]

    smaller: list[list[np.ndarray]] = [[] for _ in range(sigma)]  # from the largest down
    for c in range(sigma - 1, 0, -1):
        done, turn = 0, smaller[c]
        while done < len(turn):
            now = np.concatenate(turn[done:])
            done = len(turn)
            before = now[now > 0] - 1
            before = before[small[before] & (t[before] != 0)]
            deal(before, t, smaller)
        before = ordered[c][::-1]
        before = before[before > 0] - 1
        before = before[small[before] & (t[before] != 0)]
        deal(before, t, smaller)
    out = [stops]
    for c in range(1, sigma):
        out.append(ordered[c])
        if smaller[c]:
            out.append(np.concatenate(smaller[c])[::-1])
    return np.concatenate(out)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of all suffixes of texts that each end with a 0, by induced sorting."""
    small = smaller_than_next(t)
    first = np.zeros(len(t), bool)
    first[1:] = small[1:] & ~small[:-1]
    leftmost = np.flatnonzero(first).astype(np.int32)
    if not len(leftmost):
        return induce(t, small, leftmost)
    # sort the substrings between leftmost-smaller places, then name them in this order
    order = induce(t, small, leftmost)
    ranked = order[first[order]]
    place = np.cumsum(first, dtype=np.int32)[ranked] - 1
    prints = substring_prints(t, leftmost)[place]
    new = np.ones(len(ranked), bool)
    new[1:] = prints[1:] != prints[:-1]
    reduced = np.empty(len(ranked), np.int64)
    reduced[place] = np.cumsum(new)
    reduced[t[leftmost] == 0] = 0  # no two ends are alike: the later one is larger
    return induce(t, small, leftmost[suffix_order(reduced)])


def substring_prints(t: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """A hash of the substring from each leftmost-smaller place to the next one, in portions
    of the text."""
    out = np.empty(len(leftmost), U64)
    ends = np.append(leftmost[1:], len(t) - 1) + 1
    low = 0
    while low < len(leftmost):
        begin = int(leftmost[low])
        high = max(low + 1, int(np.searchsorted(leftmost, begin + PIECE_BYTES)))
        part = t[begin:int(ends[high - 1])].astype(U64)
        out[low:high] = windows_hash(part, leftmost[low:high].astype(np.int64) - begin,
                                     ends[low:high].astype(np.int64) - begin)
        low = high
    return out


def common_prefixes(t: np.ndarray, order: np.ndarray, until: np.ndarray) -> np.ndarray:
    """For each place the length its suffix has in common with the one before it in order.

    until: how many symbols are left in the place's text. Only where the neighbour is not
    the one behind the last place's neighbour is anything compared; elsewhere the length is
    one less than before.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1] + 1) | (before[1:] < 1) | (t[:-1] == 0)
    at = np.flatnonzero(head & (before >= 0))
    raw = np.zeros(n + 8, np.uint8)
    raw[:n] = np.maximum(t, 1) - 1
    eight = np.zeros(n + 1, U64)
    for k in range(8):
        eight[:n] |= raw[k:n + k].astype(U64) << U64(8 * k)
    most = np.minimum(until[at], until[before[at]])
    length = np.zeros(len(at), np.int64)
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        x = (eight[np.minimum(at[open_] + length[open_], n)]
             ^ eight[np.minimum(before[at[open_]] + length[open_], n)])
        same = np.full(len(open_), 8, np.int64)
        for k in range(7, -1, -1):
            same[(x >> U64(8 * k)) & U64(0xFF) != 0] = k
        length[open_] += same
        open_ = open_[(same == 8) & (length[open_] < most[open_])]
    del eight, raw
    heads = np.flatnonzero(head).astype(np.int32)
    reach = np.zeros(len(heads), np.int32)  # what a head has in common, and where it is
    reach[np.searchsorted(heads, at)] = np.minimum(length, most)
    reach += heads
    out = reach[np.cumsum(head, dtype=np.int32) - 1]
    out -= np.arange(n, dtype=np.int32)
    return np.maximum(out, 0, out=out)


def equal_windows(data: np.ndarray, lengths: np.ndarray, size: int = LENGTH) -> np.ndarray:
    """A class for each window of `size` bytes of the texts in turn; equal ones share it."""
    n = len(lengths)
    ends = np.cumsum(lengths + 1).astype(np.int32)  # with a stop behind each text
    t = np.zeros(int(ends[-1]), np.int16)
    inside = np.ones(len(t), bool)
    inside[ends - 1] = False
    t[inside] = data.astype(np.int16) + 1
    del inside
    order = suffix_array(t)
    until = np.repeat(ends - 1, lengths + 1) - np.arange(len(t), dtype=np.int32)
    shared = common_prefixes(t, order, until)
    label = np.empty(len(t), np.int32)
    label[order] = np.cumsum(shared[order] < size, dtype=np.int32)
    windows = np.maximum(lengths - size + 1, 0)
    return label[ragged(ends - 1 - lengths, windows)] if n else np.zeros(0, np.int64)


# --- shards ---------------------------------------------------------------------------------

_PLACE = U64((1 << 31) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the anchor, first and last window) for each run of windows that share it."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty
    at = np.arange(n - anchor + 1)
    least = ranges_hash(data, at, at + anchor, 5) & ~_PLACE | at.astype(U64)
    span, have = length - anchor + 1, 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:len(least) - (span - have)], least[span - have:])
    place = (least & _PLACE).astype(np.int64)[:n - length + 1]
    doc_end = np.repeat(offsets[1:], np.diff(offsets))[:n - length + 1]
    fits = np.arange(len(place)) + length <= doc_end
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (fits[1:] != fits[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    keep = fits[first]
    return place[first[keep]], first[keep], last[keep]


class Part:
    """A few megabytes of a shard's texts."""

    def __init__(self, batch: pa.RecordBatch, copies: set, length: int, anchor: int):
        self.batch = batch
        ids = batch.column("doc_id").to_pylist()
        self.ids = np.array(ids, np.int64)
        self.copy = np.array([x in copies for x in zip(ids, batch.column("h").to_pylist())], bool)
        self.data, self.offsets = flat(batch.column("text"))
        place, first, last = anchors(self.data, self.offsets, length, anchor)
        doc = np.searchsorted(self.offsets, first, "right") - 1
        keep = ~self.copy[doc]
        self.doc, self.first, self.last = doc[keep], first[keep], last[keep]
        place = place[keep]
        self.key = ranges_hash(self.data, place, place + anchor, 6)

    def results(self, gone: np.ndarray, length: int) -> pa.RecordBatch:
        """What is left; gone: starts of the windows that start earlier elsewhere."""
        step = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(step, gone, 1)
        np.add.at(step, gone + length, -1)
        removed = np.cumsum(step[:-1]) > 0
        sizes = np.diff(self.offsets)
        whole = self.copy & (sizes >= length)
        removed |= np.repeat(whole, sizes)
        begins = removed.copy()
        begins[1:] &= ~removed[:-1]
        edges = self.offsets[:-1][sizes > 0]
        begins[edges] = removed[edges]
        counts = [np.concatenate([[0], np.cumsum(x)]) for x in (removed, begins)]
        n, spans = (c[self.offsets[1:]] - c[self.offsets[:-1]] for c in counts)
        digests = []
        for a, b, k in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), n.tolist()):
            text = self.data[a:b]
            digests.append(hashlib.sha256(
                (text[~removed[a:b]] if k else text).tobytes()).hexdigest())
        return pa.record_batch({
            "doc_id": self.batch.column("doc_id"), "no_id": self.batch.column("no_id"),
            "h": self.batch.column("h"),
            "n_bytes": pa.array(sizes), "n_removed": pa.array(n), "n_spans": pa.array(spans),
            "kept_sha256": pa.array(digests, pa.string())})


class Shard:
    """Documents of a shard with what has been answered so far."""

    def __init__(self, texts: pa.Table, notes: pa.Table, buckets: int, length: int,
                 anchor: int):
        self.buckets, self.length = buckets, length
        notes = notes.to_pydict()
        self.bits = {k: {} for k in (1, 2)}
        copies = set()
        for kind, bucket, doc, h, bits in zip(*(notes[c] for c in (
                "kind", "bucket", "doc_id", "h", "bits"))):
            if kind == 0:
                copies.add((doc, h))
            else:
                self.bits[kind][bucket] = np.unpackbits(np.frombuffer(bits, np.uint8))
        self.parts = [Part(b, copies, length, anchor)
                      for b in pieces(texts.combine_chunks().to_batches())]
        none = np.zeros(0, np.int64)
        self.key = np.concatenate([p.key for p in self.parts] or [none.astype(U64)])
        self.own = np.concatenate([[0], np.cumsum([len(p.key) for p in self.parts])])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, as asked (bucket above, 31 bits and `several` below), and the
        place of each run's anchor among them."""
        short = ((self.key % U64(self.buckets)) << U64(32)) | (
            (self.key >> U64(20)) & U64(0x7FFFFFFF))
        keys, place, count = np.unique(short, return_inverse=True, return_counts=True)
        return (keys << U64(1)) | (count > 1).astype(U64), place.reshape(-1)

    def texts(self) -> None:
        """The distinct texts of the open runs, sorted by bucket."""
        keys, place = self.keys()
        open_ = np.zeros(len(keys), bool)
        bucket = (keys >> U64(33)).astype(np.int64)
        for b, bits in self.bits[1].items():
            x, y = np.searchsorted(bucket, [b, b + 1])
            open_[x:y] = bits[:y - x]
        open_ = open_[place]
        found = []
        for k, p in enumerate(self.parts):
            run = np.flatnonzero(open_[self.own[k]:self.own[k + 1]])
            a, b = p.first[run], p.last[run] + self.length
            found.append((np.full(len(run), k), run, a, b, p.key[run], p.ids[p.doc[run]],
                          ranges_hash(p.data, a, b, 8), ranges_hash(p.data, a, b, 9)))
        part, self.run, a, b, key, doc, one, two = (
            np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 8
        self.part = part
        bucket = (key.astype(U64) % U64(self.buckets)).astype(np.int64)
        order = np.lexsort((two, one, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        starts = np.flatnonzero(new)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        some = order[starts]
        self.least = np.minimum.reduceat(doc[order], starts) if len(starts) else doc
        self.bucket, self.text_key = bucket[some], key[some].astype(U64)
        self.text_at = list(zip(part[some].tolist(), a[some].tolist(), b[some].tolist()))
        self.sizes = (b - a)[some]

    def text(self, i: int) -> np.ndarray:
        k, a, b = self.text_at[i]
        return self.parts[k].data[a:b]

    def asked(self, shard: int) -> pa.Table:
        """One row for each bucket: keys, sizes and bytes of the texts, smallest documents."""
        self.texts()
        numbers = np.unique(self.bucket)
        rows = []
        for b in numbers:
            x, y = np.searchsorted(self.bucket, [b, b + 1])
            head = np.array([y - x], np.int64).tobytes()
            rows.append((head + self.text_key[x:y].tobytes() + self.sizes[x:y].tobytes()
                         + b"".join(self.text(i).tobytes() for i in range(x, y)),
                         self.least[x:y].tobytes()))
        return pa.table({
            "bucket": pa.array(numbers, pa.int32()),
            "shard": pa.array([shard] * len(numbers), pa.int32()),
            "keys": pa.array([r[0] for r in rows], pa.binary()),
            "docs": pa.array([r[1] for r in rows], pa.binary())})

    def finish(self) -> pa.Table:
        self.texts()
        windows = self.sizes - self.length + 1
        at = np.cumsum(windows) - windows
        smaller = np.zeros(int(windows.sum()), bool)
        for b, bits in self.bits[2].items():
            x, y = np.searchsorted(self.bucket, [b, b + 1])
            if x < y:
                n = int(windows[x:y].sum())
                smaller[at[x]:at[x] + n] = bits[:n]
        again = self.repeated()
        out = []
        for k, p in enumerate(self.parts):
            mine = np.flatnonzero(self.part == k)
            run, text = self.run[mine], self.which[mine]
            n = windows[text]
            place = ragged(p.first[run], n)
            hit = smaller[ragged(at[text], n)] | np.repeat(p.ids[p.doc[run]] > self.least[text], n)
            gone = np.concatenate([place[hit], again[k]])
            out.append(p.results(gone, self.length))
        return pa.Table.from_batches(out) if out else RESULT_SCHEMA.empty_table()

    def repeated(self) -> list[np.ndarray]:
        """For each part, windows that start earlier in their own document."""
        out = []
        for k, p in enumerate(self.parts):
            mine = np.flatnonzero(self.part == k)
            run, text = self.run[mine], self.which[mine]
            doc, key = p.doc[run], p.key[run]
            order = np.lexsort((key, doc))
            same = np.zeros(len(order), bool)
            pair = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
            same[1:] |= pair
            same[:-1] |= pair
            chosen = order[same]
            if not len(chosen):
                out.append(np.zeros(0, np.int64))
                continue
            texts, of = np.unique(text[chosen], return_inverse=True)
            label = class_texts([self.text(i) for i in texts], self.text_key[texts],
                                self.length)
            n = self.sizes[texts] - self.length + 1
            at = np.cumsum(n) - n
            own = n[of]
            classes = label[ragged(at[of], own)]
            docs = np.repeat(doc[chosen], own)
            place = ragged(p.first[run[chosen]], own)
            order = np.lexsort((place, classes, docs))
            later = np.zeros(len(order), bool)
            later[1:] = ((docs[order][1:] == docs[order][:-1])
                         & (classes[order][1:] == classes[order][:-1]))
            out.append(place[order[later]])
        return out


RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("no_id", pa.bool_()), ("h", pa.int64()),
                           ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                           ("n_spans", pa.int64()),
                           ("kept_sha256", pa.string())])


def class_texts(texts: list[np.ndarray], keys: np.ndarray, length: int) -> np.ndarray:
    """Classes of all windows of the texts in turn; portions hold whole anchors."""
    sizes = np.array([len(x) for x in texts], np.int64)
    windows = sizes - length + 1
    at = np.cumsum(windows) - windows
    out = np.zeros(int(windows.sum()), np.int64)
    order = np.argsort(keys, kind="stable")
    ends = np.cumsum(sizes[order])
    low = base = 0
    while low < len(order):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PORTION)))
        while high < len(order) and keys[order[high]] == keys[order[high - 1]]:
            high += 1
        some = order[low:high]
        label = equal_windows(np.concatenate([texts[i] for i in some]), sizes[some], length)
        out[ragged(at[some], windows[some])] = label + base
        base += int(label.max()) + 1 if len(label) else 0
        low = high
    return out


def answer_texts(asked: pa.Table, length: int) -> pa.Table:
    """For each window sent, whether it is in a document smaller than the one sent with it."""
    rows = asked.to_pydict()
    texts, keys, counts = [], [], []
    for body in rows["keys"]:
        n = int(np.frombuffer(body, np.int64, 1)[0])
        keys.append(np.frombuffer(body, U64, n, 8))
        sizes = np.frombuffer(body, np.int64, n, 8 + 8 * n)
        data = np.frombuffer(body, np.uint8, offset=8 + 16 * n)
        ends = np.cumsum(sizes)
        texts += [data[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist())]
        counts.append(n)
    docs = np.concatenate([np.frombuffer(d, np.int64) for d in rows["docs"]])
    key = np.concatenate(keys)
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(x.tobytes(), len(number)) for x in texts], np.int64)
    _, first = np.unique(which, return_index=True)
    distinct = [texts[i] for i in first]
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    windows = np.array([len(x) for x in distinct], np.int64) - length + 1
    classes = class_texts(distinct, key[first], length)
    smallest = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, classes, np.repeat(least, windows))
    at = np.cumsum(windows) - windows
    answers, done = [], 0
    for n in counts:
        own = which[done:done + n]
        w = windows[own]
        answers.append(smallest[classes[ragged(at[own], w)]]
                       < np.repeat(docs[done:done + n], w))
        done += n
    return note_rows(2, rows["bucket"][0], rows["shard"], answers)


def dedup_bytes(documents: DataFrame, key: str = "doc_id", text: str = "text",
                length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (see the module)."""
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
    copies = copies.select(
        shard.alias("shard"), F.lit(0).alias("kind"), F.lit(0).alias("bucket"),
        F.col("doc_id").alias("doc_id"), F.col("h").alias("h"),
        F.lit(None).cast("binary").alias("bits")).distinct()

    def ask_anchors(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, _ = Shard(left, right, buckets, length, anchor).keys()
        return asked_rows(key[0].as_py(), (keys >> U64(33)).astype(np.int64),
                          (keys & U64(0xFFFFFFFF)).astype(np.uint32), None)

    def ask_texts(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return Shard(left, right, buckets, length, anchor).asked(key[0].as_py())

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return Shard(left, right, buckets, length, anchor).finish()

    def pass_over(notes: DataFrame, task, schema: str) -> DataFrame:
        return texts.groupBy("shard").cogroup(notes.groupBy("shard")).applyInArrow(task, schema)

    notes = copies.union(pass_over(copies, ask_anchors, ASKED).groupBy("bucket").applyInArrow(
        answer_symbols, NOTES))
    notes = notes.union(pass_over(notes, ask_texts, ASKED).groupBy("bucket").applyInArrow(
        lambda asked: answer_texts(asked, length), NOTES))
    return pass_over(notes, finish, RESULT).select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "n_bytes",
        "n_removed", "n_spans", "kept_sha256")
