"""Toxicity: a small convolutional network over hashed words, trained in numpy.

A word (letters and digits, ASCII letters in lower case) is the sum of the embeddings of its
hash and of the hashes of its beginnings (PREFIXES, in characters), so that words of one stem
share what was learned. Filters of several widths slide over the words of the whole text, each
keeps its largest value (max pooling), and a linear layer makes a logit of them. Buckets that
fewer than LEAST_ROWS training texts hold stay zero: what is rare cannot be learned by heart,
and words never met say nothing.

Training takes all labelled rows that are not held out, whatever their number and the size of
their texts, repeated texts once. They are dealt to shards by a hash, of about SHARD_ROWS rows
or SHARD_BYTES of text at most, and coded once. In each of the EPOCHS every shard trains from
the common model over all its rows, in a task of its own, and the shards' models are averaged:
a bucket by how many rows of each shard hold it, all else by rows. One shard is plain training.
A lost task is run again with the same result, as all random numbers are seeded. One row in
UNSEEN is kept from the network and sets the thresholds: where a logistic curve over these rows
is a half, one curve for all and one for each language, drawn towards the common one where rows
are few. The language of a text is told by its own words (a bag model learned from the lang of
training rows, of the LANGUAGES that have most of them); lang itself is no input of a score.
The score is the logistic of the logit less the threshold, so 0.5 is the threshold of every
language.

What is shuffled: for each labelled text its id and hashes, then the text itself once, then the
models of the shards. Texts without a label stay where they are: a bit array of the labelled
ids, 16 MB at most, tells nearly all of them. The driver holds a model, of a size that the
parameters bound, and seven bytes for each row that sets thresholds. Scoring is one pass over
the documents, and the model is broadcast.

Cases: a null or empty text, or one without words, gets the score of an empty text. A null
doc_id is never a training row and is not held out; repeated ids are scored each for
themselves. If an id has several labels, the largest counts; null labels and labels other than
0 and 1 are left out. Without a positive and a negative training row every score is 0. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import copy
import io
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import (ALNUM, Words, bounded_batches, cut, flat, pieces, ragged, ranges_hash,
                     two_columns)

SHARD_ROWS = 8_192  # training texts of a shard
SHARD_BYTES = 32 << 20  # of their text; a longer text is a shard of its own size
BUCKETS = 1 << 18
LANGUAGE_BUCKETS = 1 << 12
PREFIXES = (3, 4, 5, 6)
WIDTHS = (1, 2, 3)
DIM, FILTERS = 12, 8  # FILTERS of each width
LEAST_ROWS = 3  # training texts that hold a bucket
EPOCHS, BATCH, RATE = 6, 64, 0.1
UNSEEN = 5  # one training row in so many sets thresholds instead
RIDGE = 1.0  # pulls the curve of few rows towards the bare logit
LEAST_LANGUAGE = 30  # training rows of a language that is told apart
LANGUAGES = 256  # so many are told apart at most
PART = 1 << 12  # buckets that are averaged together
MOST_BITS = 27  # of the array that tells labelled ids
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SCHEMA = "doc_id long, score double"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5; rows with 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


@dataclass
class Coded:
    """Texts as numbers of distinct words, and the buckets of each distinct word."""

    features: np.ndarray  # distinct words x (1 + prefixes); BUCKETS where there is none
    seq: np.ndarray  # all words, by number
    offsets: np.ndarray  # of texts in seq
    hashes: np.ndarray | None = None  # of distinct words


def coded(data: np.ndarray, offsets: np.ndarray) -> Coded:
    w = Words(data, offsets, ALNUM)
    hashes, first, seq = np.unique(w.hashes(), return_index=True, return_inverse=True)
    starts, ends = w.starts[first], w.ends[first]
    heads = np.flatnonzero((w.bytes & 0xC0) != 0x80)
    at = np.searchsorted(heads, starts)
    heads = np.append(heads, len(w.bytes) + np.arange(max(PREFIXES) + 1))
    out = np.full((len(first), 1 + len(PREFIXES)), BUCKETS, np.int64)
    out[:, 0] = hashes % np.uint64(BUCKETS)
    for j, k in enumerate(PREFIXES, start=1):
        to = heads[at + k]
        has = np.flatnonzero(to <= ends)
        out[has, j] = ranges_hash(w.bytes, starts[has], to[has], k) % np.uint64(BUCKETS)
    return Coded(out, seq.astype(np.int64), w.offsets, hashes)


def joined(codes: list[Coded]) -> Coded:
    """The texts of several portions, their words numbered anew."""
    hashes, first, number = np.unique(np.concatenate([c.hashes for c in codes]),
                                      return_index=True, return_inverse=True)
    before = np.cumsum([0] + [len(c.features) for c in codes])
    counts = np.concatenate([np.diff(c.offsets) for c in codes])
    return Coded(np.concatenate([c.features for c in codes])[first],
                 np.concatenate([number[c.seq + at] for c, at in zip(codes, before)]),
                 np.concatenate([[0], np.cumsum(counts)]), hashes)


@dataclass
class Network:
    """Embeddings (last row: no word), filters by width, the linear layer."""

    embedding: np.ndarray
    filters: list[np.ndarray] = field(default_factory=list)  # width x DIM x FILTERS
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray = None
    shift: np.ndarray = None

    def parts(self) -> list[np.ndarray]:
        return [*self.filters, *self.bias, self.out, self.shift]

    def pool(self, vectors: np.ndarray, seq: np.ndarray, offsets: np.ndarray,
             places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest value of each filter in each text, before the bias, and where it lies.

        vectors: of distinct words, the last one for no word. Windows over the end of a text
        see no word there.
        """
        n, room = len(offsets) - 1, max(WIDTHS)
        counts = np.diff(offsets)
        starts = offsets[:-1] + np.arange(n) * room
        padded = np.full(len(seq) + n * room, len(vectors) - 1, np.int64)
        padded[ragged(starts, counts)] = seq
        closed = np.ones(len(padded), bool)
        closed[ragged(starts, np.maximum(counts, 1))] = False
        best, where = [], []
        for width, filters in zip(WIDTHS, self.filters):
            value = (vectors @ filters[0])[padded]
            for j in range(1, width):
                value[:len(padded) - j] += (vectors @ filters[j])[padded[j:]]
            value[closed] = -np.inf
            top = np.maximum.reduceat(value, starts, axis=0) if n else value[:0]
            best.append(top)
            if places:
                row = np.repeat(np.arange(n), counts + room)
                hits, f = np.nonzero(value == top[row])
                place = np.zeros((n, FILTERS), np.int64)
                place[row[hits[::-1]], f[::-1]] = hits[::-1]  # the first one stays
                where.append((padded, place))
        return np.concatenate(best, axis=1), where

    def logits(self, c: Coded) -> np.ndarray:
        vectors = np.zeros((len(c.features) + 1, DIM), np.float32)
        vectors[:-1] = self.embedding[c.features].sum(axis=1)
        best, _ = self.pool(vectors, c.seq, c.offsets)
        return np.maximum(best + np.concatenate(self.bias), 0) @ self.out + self.shift[0]


def take(c: Coded, rows: np.ndarray) -> Coded:
    """Some of the texts."""
    counts = np.diff(c.offsets)[rows]
    seq = c.seq[ragged(c.offsets[rows], counts)]
    used = np.zeros(len(c.features), bool)
    used[seq] = True
    number = np.cumsum(used) - 1
    return Coded(c.features[used], number[seq], np.concatenate([[0], np.cumsum(counts)]))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.diff(x, prepend=-1) != 0]


def rows_of(c: Coded, *weights: np.ndarray) -> list[np.ndarray]:
    """For each bucket how many texts hold it, each counted with its weights."""
    n = max(len(c.features), 1)
    row = np.repeat(np.arange(len(c.offsets) - 1), np.diff(c.offsets))
    word = _distinct(row * n + c.seq)
    pair = _distinct(((word // n)[:, None] * (BUCKETS + 1) + c.features[word % n]).ravel())
    return [np.bincount(pair % (BUCKETS + 1), w[pair // (BUCKETS + 1)], BUCKETS + 1)
            for w in weights]


@dataclass
class State:
    """A network under training, with what Adagrad remembers."""

    net: Network
    held: np.ndarray  # buckets that are learned
    squares: list[np.ndarray]
    rows_squares: np.ndarray
    balance: tuple[float, float]  # weights of a row without and with the label

    def dense(self) -> np.ndarray:
        """All but the embedding, one after the other."""
        return np.concatenate([x.ravel() for x in [*self.net.parts(), *self.squares]])

    def put(self, values: np.ndarray) -> None:
        at = 0
        for x in [*self.net.parts(), *self.squares]:
            x[...] = values[at:at + x.size].reshape(x.shape)
            at += x.size

    def sparse(self, buckets: np.ndarray) -> np.ndarray:
        return np.column_stack([self.net.embedding[buckets], self.rows_squares[buckets]])


def begin(yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float, seed: int = 0) -> State:
    """The network before the first epoch; both labels weigh the same."""
    rng = np.random.default_rng(seed)
    held = yes + no >= LEAST_ROWS
    held[BUCKETS] = False
    embedding = rng.normal(0, 0.02, (BUCKETS + 1, DIM)).astype(np.float32)
    # the first component begins as the shrunk log-odds of the bucket, the rest is learned
    odds = np.log((yes + 0.5) / (n_yes + 1)) - np.log((no + 0.5) / (n_no + 1))
    embedding[:, 0] = odds * (yes + no) / (yes + no + 4) / 4
    embedding[~held] = 0
    net = Network(embedding)
    for width in WIDTHS:
        filters = rng.normal(0, 0.3, (width, DIM, FILTERS)).astype(np.float32)
        filters[:, 0, :] = np.abs(filters[:, 0, :]) + 0.5 / width
        net.filters.append(filters)
        net.bias.append(np.zeros(FILTERS, np.float32))
    net.out = np.full(FILTERS * len(WIDTHS), 1.5 / FILTERS / len(WIDTHS), np.float32)
    net.shift = np.full(1, -1.0, np.float32)
    n = n_yes + n_no
    return State(net, held, [np.full_like(p, 1e-2) for p in net.parts()],
                 np.full(len(embedding), 1e-2, np.float32),
                 (0.5 / max(n_no / n, 1e-9), 0.5 / max(n_yes / n, 1e-9)) if n else (0.0, 0.0))


def epoch(state: State, c: Coded, label: np.ndarray, seed: list[int]) -> None:
    """Train by Adagrad on the logistic loss, once over all rows."""
    weight = np.where(label > 0, state.balance[1], state.balance[0])
    order = np.random.default_rng(seed).permutation(len(label))
    for k in range(0, len(order), BATCH):
        rows = np.sort(order[k:k + BATCH])
        step(state.net, take(c, rows), label[rows], weight[rows], state.held, state.squares,
             state.rows_squares)


def step(net: Network, c: Coded, label: np.ndarray, weight: np.ndarray, held: np.ndarray,
         squares: list[np.ndarray], rows_squares: np.ndarray) -> None:
    """One gradient step. Only the windows that were pooled have a gradient."""
    vectors = np.zeros((len(c.features) + 1, DIM), np.float32)
    vectors[:-1] = net.embedding[c.features].sum(axis=1)
    best, where = net.pool(vectors, c.seq, c.offsets, places=True)
    pooled = np.maximum(best + np.concatenate(net.bias), 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.shift[0], -30, 30)))
    d = ((p - label) * weight / len(label)).astype(np.float32)
    back = d[:, None] * net.out * (pooled > 0)
    grad_v = np.zeros_like(vectors)
    filters, bias = [], []
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS:(i + 1) * FILTERS]
        padded, place = where[i]
        grad = np.zeros_like(net.filters[i])
        for j in range(width):
            words = padded[np.minimum(place + j, len(padded) - 1)]
            grad[j] = np.einsum("nf,nfd->df", own, vectors[words])
            np.add.at(grad_v, words.ravel(), (
                own[:, :, None] * net.filters[i][j].T[None]).reshape(-1, DIM))
        filters.append(grad)
        bias.append(own.sum(axis=0))
    grads = [*filters, *bias, pooled.T @ d, np.array([d.sum()], np.float32)]
    for part, grad, square in zip(net.parts(), grads, squares):
        square += grad * grad
        part -= RATE * grad / np.sqrt(square)
    used = np.flatnonzero(np.abs(grad_v[:-1]).sum(axis=1))
    feature = c.features[used]
    touched, back_to = np.unique(feature.ravel(), return_inverse=True)
    grad = np.zeros((len(touched), DIM), np.float32)
    np.add.at(grad, back_to, np.repeat(grad_v[used], feature.shape[1], axis=0))
    grad[~held[touched]] = 0
    rows_squares[touched] += (grad * grad).mean(axis=1)
    net.embedding[touched] -= RATE * grad / np.sqrt(rows_squares[touched])[:, None]


def language_bags(c: Coded, lang: np.ndarray, names: list[str]) -> np.ndarray:
    """How often each language has the word buckets."""
    out = np.zeros((LANGUAGE_BUCKETS, len(names)))
    row = np.repeat(np.arange(len(c.offsets) - 1), np.diff(c.offsets))
    bucket = c.features[c.seq, 0] % LANGUAGE_BUCKETS
    for k, name in enumerate(names):
        out[:, k] = np.bincount(bucket[(lang == name)[row]], minlength=LANGUAGE_BUCKETS)
    return out


def log_frequency(counts: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.1) / (counts + 0.1).sum(axis=0)).astype(np.float32)


def told_language(c: Coded, bags: np.ndarray) -> np.ndarray:
    """The likeliest language of each text by its words; -1 where it has none."""
    n = len(c.offsets) - 1
    if not bags.shape[1] or not len(c.seq):
        return np.full(n, -1)
    each = bags[c.features[:, 0] % LANGUAGE_BUCKETS]
    sums = np.zeros((n, bags.shape[1]))
    row = np.repeat(np.arange(n), np.diff(c.offsets))
    for k in range(bags.shape[1]):
        sums[:, k] = np.bincount(row, each[c.seq, k], n)
    return np.where(np.diff(c.offsets) > 0, sums.argmax(axis=1), -1)


def curve(logit: np.ndarray, label: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Slope and shift of a logistic curve over unseen rows: Platt's targets, Newton steps,
    few rows stay near the prior."""
    yes = label.sum()
    aim = np.where(label > 0, (yes + 1) / (yes + 2), 1 / (len(label) - yes + 2))
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - aim) + RIDGE * (w - prior)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2), slope)
        w[0] = max(w[0], 0.1)
    return w


def saved(net: Network, bags: np.ndarray, names: list[str], logit: np.ndarray,
          label: np.ndarray, own: np.ndarray) -> bytes:
    """The whole model as one compressed array file; thresholds come from unseen rows."""
    curves = [curve(logit, label, np.array([1.0, 0.0]))]
    for k in range(len(names)):
        curves.append(curve(logit[own == k], label[own == k], curves[0]))
    cuts = np.array([-w[1] / w[0] for w in curves[1:] + curves[:1]])  # the last: no language
    rows = np.flatnonzero(np.abs(net.embedding).sum(axis=1)).astype(np.int32)
    out = io.BytesIO()
    np.savez_compressed(
        out, rows=rows, embedding=net.embedding[rows], out=net.out, shift=net.shift,
        bags=bags, cuts=cuts, names=np.array(names, dtype=str),
        **{f"filters{i}": x for i, x in enumerate(net.filters)},
        **{f"bias{i}": x for i, x in enumerate(net.bias)})
    return out.getvalue()


class Model:
    """A trained model, ready to score."""

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as x:
            embedding = np.zeros((BUCKETS + 1, DIM), np.float32)
            embedding[x["rows"]] = x["embedding"]
            self.net = Network(embedding, [x[f"filters{i}"] for i in range(len(WIDTHS))],
                               [x[f"bias{i}"] for i in range(len(WIDTHS))], x["out"], x["shift"])
            self.bags, self.cuts, self.names = x["bags"], x["cuts"], list(x["names"])

    def scores(self, column: pa.Array) -> np.ndarray:
        c = coded(*flat(column))
        cut = self.cuts[told_language(c, self.bags)]
        return 1 / (1 + np.exp(-np.clip(self.net.logits(c) - cut, -30, 30)))


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, h1, h2 (of the text), size, toxic, lang: one row for each text to learn from."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id")) != 0)
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit("")
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), *_hashes(),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("at"),
        F.octet_length("text").cast("long").alias("size"),
        F.coalesce(lang, F.lit("")).alias("lang")).where("size > 0 and doc_id is not null")
    first = F.row_number().over(W.partitionBy("h1", "h2").orderBy("at", "doc_id", "lang"))
    return texts.join(chosen, "doc_id").withColumn("first", first).where("first = 1").drop(
        "first", "at")


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(11), "text").alias("h2")]


def _place(bits: int) -> Column:
    """The bit of an id."""
    return F.xxhash64("doc_id").bitwiseAND((1 << bits) - 1)


def labelled_ids(rows: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """Which bits the ids of these rows have; how many bits there are is told as a power of 2."""
    bits = min(MOST_BITS, max(16, (8 * n).bit_length()))

    def task(table: pa.Table) -> pa.Table:
        own = np.zeros(1 << 16, np.uint8)
        places = np.asarray(table.column("place"))
        own[places & 0xFFFF] = 1
        return pa.table({"part": pa.array(places[:1] >> 16, pa.int64()),
                         "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    places = rows.select(_place(bits).alias("place")).distinct()
    found = places.withColumn("part", F.shiftright("place", 16)).groupBy("part").applyInArrow(
        task, "part long, bits binary").collect()  # 2048 rows of 8 KB at most
    out = np.zeros((1 << bits) >> 3, np.uint8)
    for r in found:
        at = r["part"] << 13
        out[at:at + (1 << 13)] = np.frombuffer(r["bits"], np.uint8)
    return bits, out


def _of_ids(documents: DataFrame, bits: int, ids: np.ndarray) -> DataFrame:
    """doc_id and text of rows whose id has its bit."""
    shared = documents.sparkSession.sparkContext.broadcast(ids)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column("place"))
            keep = shared.value[place >> 3] >> (7 - (place & 7)) & 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(keep.astype(bool)))

    return two_columns(documents, "doc_id", "text").where(
        "doc_id is not null and text <> ''").withColumn("place", _place(bits)).mapInArrow(
        task, "doc_id long, text string")


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def code_shard(table: pa.Table) -> pa.Table:
    """One row: the texts of a shard as numbers of words, with their labels."""
    table = table.sort_by([("h1", "ascending"), ("h2", "ascending"), ("doc_id", "ascending")])
    h1, h2 = (np.asarray(table.column(n)) for n in ("h1", "h2"))
    new = np.ones(len(h1), bool)  # a row may be there several times
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    table = table.filter(pa.array(new))
    codes = [coded(*flat(piece.column("text")))
             for piece in pieces(table.combine_chunks().to_batches())]
    c, shard = joined(codes), table.column("shard")[0].as_py()
    turn = np.random.default_rng([1, shard]).permutation(table.num_rows) % UNSEEN
    arrays = {}
    for kind, rows in (("seen", np.flatnonzero(turn)), ("unseen", np.flatnonzero(turn == 0))):
        part = take(c, rows)
        arrays |= {f"{kind}_features": part.features.astype(np.int32),
                   f"{kind}_seq": part.seq.astype(np.int32), f"{kind}_offsets": part.offsets,
                   f"{kind}_label": np.asarray(table.column("toxic"), dtype=np.int8)[rows],
                   f"{kind}_lang": np.asarray(table.column("lang"), dtype=np.int16)[rows]}
        if kind == "seen":
            label = arrays["seen_label"].astype(float)
            yes, no = (x[:BUCKETS] for x in rows_of(part, label, 1.0 - label))
            held = np.flatnonzero(yes + no)
            arrays |= {"buckets": held, "yes": yes[held], "no": no[held]}
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return pa.table({"shard": pa.array([shard], pa.int64()),
                     "data": pa.array([out.getvalue()], pa.binary())})


class Shard:
    """What code_shard has made: rows to train on, unseen ones, and the buckets that the former
    hold."""

    def __init__(self, number: int, data: bytes):
        self.number, self._arrays = number, np.load(io.BytesIO(data))
        self.buckets, self.yes, self.no = (self._arrays[n] for n in ("buckets", "yes", "no"))

    def rows(self, kind: str) -> tuple[Coded, np.ndarray, np.ndarray]:
        """Texts, labels and languages of the "seen" or "unseen" rows."""
        features, seq, offsets, label, lang = (self._arrays[f"{kind}_{n}"] for n in (
            "features", "seq", "offsets", "label", "lang"))
        return Coded(features.astype(np.int64), seq, offsets), label.astype(float), lang


def _over_shards(shards: DataFrame, work: Callable[[Shard], Iterator[tuple[int, bytes]]]
                 ) -> DataFrame:
    """(part, shard, data) of what `work` yields for each shard."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column("shard").to_pylist(), batch.column("data")):
                for part, found in work(Shard(number, data.as_py())):
                    yield pa.record_batch({
                        "part": pa.array([part], pa.int32()),
                        "shard": pa.array([number], pa.int64()),
                        "data": pa.array([found], pa.binary())})

    return shards.mapInArrow(task, "part int, shard long, data binary")


def _added(found: DataFrame) -> dict[int, np.ndarray]:
    """The sums of the arrays (place, rows of numbers) of each part, shard after shard."""
    def task(table: pa.Table) -> pa.Table:
        table, total = table.sort_by("shard"), None
        for data in table.column("data"):
            with np.load(io.BytesIO(data.as_py())) as x:
                if total is None:
                    total = np.zeros((int(x["size"]), x["rows"].shape[1]))
                total[x["place"]] += x["rows"]
        return pa.table({"part": table.column("part")[:1],
                         "data": pa.array([_packed(total=total)], pa.binary())})

    out = {}
    for r in found.groupBy("part").applyInArrow(task, "part int, data binary").collect():
        with np.load(io.BytesIO(r["data"])) as x:
            out[r["part"]] = x["total"]
    return out


def _by_part(buckets: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows of numbers for ascending buckets, PART buckets together."""
    ends = np.searchsorted(buckets, np.arange(0, BUCKETS + PART, PART))
    for part, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        if b > a:
            yield part, _packed(size=np.array(PART), place=buckets[a:b] - part * PART,
                                rows=rows[a:b])


def _whole(numbers: np.ndarray) -> bytes:
    return _packed(size=np.array(len(numbers)), place=np.arange(len(numbers)), rows=numbers)


def _gathered(parts: dict[int, np.ndarray], columns: int) -> np.ndarray:
    out = np.zeros((BUCKETS + 1, columns))
    for part, rows in parts.items():
        if part >= 0:
            out[part * PART:(part + 1) * PART] = rows
    return out


def train(shards: DataFrame, names: list[str]) -> bytes:
    """A model of all rows in all shards."""
    context = shards.sparkSession.sparkContext

    def counts(s: Shard) -> Iterator[tuple[int, bytes]]:
        seen, label, lang = s.rows("seen")
        yield from _by_part(s.buckets, np.column_stack([s.yes, s.no]))
        yield -1, _whole(np.array([[label.sum()], [len(label) - label.sum()]]))
        if names:
            yield -2, _whole(language_bags(seen, lang, list(range(len(names)))))

    found = _added(_over_shards(shards, counts))
    yes, no = _gathered(found, 2).T
    state = begin(yes, no, *found[-1][:, 0])
    bags = log_frequency(found[-2]) if names else np.zeros((LANGUAGE_BUCKETS, 0), np.float32)
    for number in range(EPOCHS):
        shared = context.broadcast(state)

        def turn(s: Shard) -> Iterator[tuple[int, bytes]]:
            seen, label, _ = s.rows("seen")
            if not len(label):
                return
            own = copy.deepcopy(shared.value)
            epoch(own, seen, label, [0, number, s.number])
            held = own.held[s.buckets]
            buckets, weight = s.buckets[held], (s.yes + s.no)[held, None].astype(np.float32)
            yield from _by_part(buckets, np.column_stack([own.sparse(buckets) * weight, weight]))
            yield -1, _whole(np.append(own.dense().astype(float), 1.0)[:, None] * len(label))

        found = _added(_over_shards(shards, turn))
        rows = _gathered(found, DIM + 2)
        buckets = np.flatnonzero(rows[:, -1])
        mean = rows[buckets, :-1] / rows[buckets, -1:]
        state.net.embedding[buckets], state.rows_squares[buckets] = mean[:, :DIM], mean[:, DIM]
        state.put(found[-1][:-1, 0] / found[-1][-1, 0])
        shared.destroy()

    shared = context.broadcast((state.net, bags))

    def judge(s: Shard) -> Iterator[tuple[int, bytes]]:
        net, known = shared.value
        unseen, label, _ = s.rows("unseen")
        yield 0, _packed(logit=net.logits(unseen).astype(np.float32),
                         label=label.astype(np.int8),
                         own=told_language(unseen, known).astype(np.int16))

    each = [np.load(io.BytesIO(r["data"])) for r in sorted(
        _over_shards(shards, judge).collect(), key=lambda r: r["shard"])]
    shared.destroy()
    logit, label, own = (np.concatenate([x[k] for x in each]) for k in ("logit", "label", "own"))
    return saved(state.net, bags, names, logit.astype(float), label.astype(float), own)


def learned(documents: DataFrame, labels: DataFrame) -> bytes | None:
    """The trained model, or None if there are no training rows of either label."""
    conf = documents.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")  # each round leaves a model a shard: not until the driver collects
    try:
        return _learned(documents, labels)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def _learned(documents: DataFrame, labels: DataFrame) -> bytes | None:
    bounded_batches(documents.sparkSession)
    rows = cut(training_rows(documents, labels))
    n, yes, size = rows.agg(F.count(F.lit(1)), F.sum("toxic"), F.sum("size")).first()
    if not n or yes in (0, n):
        return None
    known = rows.where("lang <> ''").groupBy("lang").count().where(
        F.col("count") >= LEAST_LANGUAGE).orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    names = sorted(r["lang"] for r in known.collect())
    shards = math.ceil(max(n / SHARD_ROWS, size / SHARD_BYTES))
    shard = F.pmod(F.xxhash64("h1", F.lit(3)), F.lit(shards))
    number = F.coalesce(F.array_position(F.array(*map(F.lit, names)).cast("array<string>"),
                                         F.col("lang")) - 1, F.lit(-1))
    texts = _of_ids(documents, *labelled_ids(rows, n)).select("doc_id", "text", *_hashes())
    keys = ["shard", "doc_id", "h1", "h2"]
    wanted = rows.select(shard.alias("shard"), *keys[1:], "toxic",
                         F.when(number >= 0, number).otherwise(-1).cast("short").alias("lang"))
    dealt = texts.withColumn("shard", shard).repartition(shards, "shard").join(
        wanted.repartition(shards, "shard"), keys)
    return train(cut(dealt.groupBy("shard").applyInArrow(
        code_shard, "shard long, data binary")), names)


def score(documents: DataFrame, model: bytes | None, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    docs = two_columns(documents, key, text)
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = None
        for batch in pieces(batches):
            ready = ready or Model(shared.value)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(ready.scores(batch.column("text")), pa.float64())})

    return docs.mapInArrow(task, SCHEMA)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = score(documents, learned(documents, labels))
    return found.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
