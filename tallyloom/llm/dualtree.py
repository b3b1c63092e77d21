"""Ranked lexical search: the best documents for each item, by two trees that prune each other.

A document's share of a term is larger the more often it has the term and the shorter it is;
the score of an item and a document sums weight times share over the item's terms (see
`share` and `weight`; all in 64-bit integers). So a score is a product of two sparse vectors
without negative parts, and the largest value in each coordinate over a group of items and
over a group of documents bounds all scores between the groups.

1. Tasks cut the items into distinct terms, named by a 64-bit hash that no two terms share
   (another seed is taken if two do), and write them to the shared folder as vocabulary files
   of at most VOCABULARY terms each.
2. One pass over the documents: a task opens one vocabulary file after the other and keeps of
   each document its length and its counts of item terms, compared by two hashes. These slim
   vectors are written once. Sums over them give the number of documents, their length and
   the documents that hold each term.
3. Items are dealt into blocks of at most about CELLS items times terms; a task compiles a
   block: weights, the items in similar order, and above them a hierarchy of coordinate maxima,
   FAN children to a node. Blocks are files in the shared folder, too.
4. A task takes the vectors of one partition, opens one block after the other, builds the
   hierarchy of its documents over the block's terms, and descends both trees, batches of node
   pairs at a time. A pair whose bound lies below the weakest of the item node's kth scores, or
   equals it where all its documents come later, is dropped with all below it. What is left at
   the leaves is an exact score. The task gives its best k for each item.
5. Spark ranks those by item; at most k of an item leave a task.

Nothing of the size of items or documents passes the driver: it sees one path per file. A
task holds the vectors of one partition and one block. Files have new names for every attempt
of a task and only those of finished tasks are read.

Cases: a null or empty text has no terms; such documents count nowhere, such items have no
rows. Repeated item rows are ranked each for itself, repeated document rows are documents of
their own. Equal scores go by doc_id, null ids last. Without documents or items there are no
rows. Other columns are not read.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import (ALNUM, Words, bounded_batches, cut, flat, pieces, ragged, ranges_hash,
                     shared_folder, two_columns)

BEST = 10
VOCABULARY = 1 << 20  # terms in a vocabulary file
CELLS = 4 << 20  # items times terms of a block
FAN = 8  # children of a tree node
START = 3  # levels above the documents at which a descent starts
PART_CELLS = 1 << 20  # products made at a time

TERMS = "no long, first array<long>, second array<long>"
VECTORS = "doc_id long, n long, terms array<long>, counts array<long>"
FOUND = "no long, doc_id long, score long"


def put(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays to a new file of the folder; returns its path."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    data, path = io.BytesIO(), f"{root}/{uuid.uuid4().hex}.npz"
    np.savez(data, **arrays)
    with store.open_output_stream(path) as out:
        out.write(data.getbuffer())
    return path


def fetch(folder: str, path: str) -> dict[str, np.ndarray]:
    store, _ = fs.FileSystem.from_uri(folder)
    with store.open_input_file(path) as source:
        with np.load(io.BytesIO(source.read())) as arrays:
            return dict(arrays)


def new_folder(documents: DataFrame) -> str:
    folder = shared_folder(documents.sparkSession, "search")
    return folder if "://" in folder else f"file://{folder}"


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def hashed_terms(column: pa.Array, seed: int) -> tuple[Words, np.ndarray]:
    """Words of the texts and the first hash of each."""
    w = Words(*flat(column), ALNUM)
    return w, signed(w.hashes(2 * seed))


def second_hash(w: Words, at: np.ndarray, seed: int) -> np.ndarray:
    return signed(ranges_hash(w.bytes, w.starts[at], w.ends[at], 2 * seed + 1))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values))


def item_terms(items: DataFrame, seed: int) -> DataFrame:
    """no and both hashes of each distinct term of an item, in order of the first."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w, first = hashed_terms(batch.column("text"), seed)
            pairs = np.stack([w.doc(), first, second_hash(w, np.arange(len(w)), seed)])
            pairs = np.unique(pairs, axis=1) if len(w) else pairs
            counts = np.bincount(pairs[0], minlength=batch.num_rows)
            yield pa.record_batch({"no": batch.column("no"), "first": lists(pairs[1], counts),
                                   "second": lists(pairs[2], counts)})

    return items.select("no", "text").mapInArrow(task, TERMS).where(F.size("first") > 0)


def named_terms(items: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The items' terms, the vocabulary, and the seed under which all names differ."""
    seed = 0
    while True:
        terms = cut(item_terms(items, seed))
        words = cut(terms.select(F.explode(F.arrays_zip("first", "second")).alias("t")).select(
            "t.first", "t.second").distinct())
        if words.select("first").distinct().count() == words.count():
            return terms, words, seed
        seed += 1


def vocabulary_files(words: DataFrame, folder: str) -> list[str]:
    n = max(1, -(-words.count() // VOCABULARY))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            first, second = (np.concatenate([np.asarray(b.column(c)) for b in held])
                             for c in ("first", "second"))
            order = np.argsort(first)
            path = put(folder, {"first": first[order], "second": second[order]})
            yield pa.record_batch({"path": pa.array([path])})

    made = cut(words.repartitionByRange(n, "first").mapInArrow(task, "path string"))
    return [r["path"] for r in made.collect()]  # one of up to VOCABULARY terms


def vectors(documents: DataFrame, folder: str, paths: list[str], seed: int, key: str,
            text: str) -> DataFrame:
    """doc_id, number of terms, and counts of item terms of every document with a term."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict] = {}
        for batch in pieces(batches):
            w, first = hashed_terms(batch.column("text"), seed)
            docs, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for path in paths:
                if path not in kept:
                    kept = {path: fetch(folder, path)}  # one file in memory at a time
                known = kept[path]
                place = np.minimum(np.searchsorted(known["first"], first),
                                   len(known["first"]) - 1)
                at = np.flatnonzero(known["first"][place] == first)
                at = at[second_hash(w, at, seed) == known["second"][place[at]]]
                docs.append(np.searchsorted(w.offsets, at, "right") - 1)
                names.append(first[at])
            doc, name = np.concatenate(docs), np.concatenate(names)
            order = np.lexsort((name, doc))
            doc, name = doc[order], name[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
            heads = np.flatnonzero(new)
            counts = np.diff(np.append(heads, len(doc)))
            out = pa.record_batch({
                "doc_id": batch.column("doc_id"), "n": pa.array(w.counts),
                "terms": lists(name[heads], np.bincount(doc[heads], minlength=batch.num_rows)),
                "counts": lists(counts, np.bincount(doc[heads], minlength=batch.num_rows))})
            yield out.filter(pa.array(w.counts > 0))

    return cut(two_columns(documents, key, text).mapInArrow(task, VECTORS))


def statistics(found: DataFrame) -> DataFrame:
    """term, documents that hold it; in the row without a term all documents and their length."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, df = np.unique(np.asarray(batch.column("terms").flatten()), return_counts=True)
            total = int(np.asarray(batch.column("n")).sum())
            yield pa.record_batch({
                "term": pa.array([None, *terms.tolist()], pa.int64()),
                "df": pa.array([batch.num_rows, *df.tolist()], pa.int64()),
                "length": pa.array([total] + [0] * len(terms), pa.int64())})

    return cut(found.select("n", "terms").mapInArrow(task, "term long, df long, length long")
               .groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length")))


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def share(count: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term that a document has `count` times, of n terms, is worth there."""
    if 90 * int(n.max(initial=0)) * documents >= 1 << 63:
        n = n.astype(object)  # the product alone needs more than 64 bits
    m = np.asarray(10 + 90 * n * documents // length, dtype=np.int64)
    return 1_000_000_000 * count // (1000 * count + 8 * m)


@dataclass
class Level:
    """Nodes of one level: sparse coordinate maxima, and the first document below each."""

    ptr: np.ndarray
    term: np.ndarray
    value: np.ndarray
    earliest: np.ndarray

    def __len__(self) -> int:
        return len(self.ptr) - 1


def above(level: Level, terms: int) -> Level:
    """The level above: FAN neighbours make a node."""
    node = np.repeat(np.arange(len(level)) // FAN, np.diff(level.ptr))
    at = node * terms + level.term
    order = np.argsort(at, kind="stable")
    heads = np.flatnonzero(np.diff(at[order], prepend=-1))
    value = np.maximum.reduceat(level.value[order], heads) if len(heads) else level.value[:0]
    first = at[order][heads]
    count = -(-len(level) // FAN)
    return Level(np.searchsorted(first, np.arange(count + 1) * terms), first % terms, value,
                 np.minimum.reduceat(level.earliest, np.arange(0, len(level), FAN)))


def hierarchy(leaves: Level, terms: int) -> list[Level]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(above(levels[-1], terms))
    return levels


def similar_order(ptr: np.ndarray, term: np.ndarray, weights: np.ndarray,
                  last: np.ndarray) -> np.ndarray:
    """Rows by their two commonest terms, so that neighbours have much in common."""
    row = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.lexsort((term, weights[term], row))
    term = np.append(term[order], -1)
    one = term[ptr[:-1]]
    two = np.where(np.diff(ptr) > 1, term[np.minimum(ptr[:-1] + 1, len(term) - 1)], -1)
    return np.lexsort((last, two, one))


def reordered(ptr: np.ndarray, rows: np.ndarray, *arrays: np.ndarray) -> tuple:
    counts = np.diff(ptr)[rows]
    at = ragged(ptr[rows], counts)
    return (np.concatenate([[0], np.cumsum(counts)]), *[a[at] for a in arrays])


def dealt(terms: DataFrame) -> DataFrame:
    """The items with the number of their block."""
    classed = terms.withColumn("class", F.ceil(F.log2(F.size("first"))).cast("int"))
    sizes = classed.groupBy("class").count().collect()  # one row per power of two
    blocks = {r["class"]: -(-r["count"] // max(1, math.isqrt(CELLS >> r["class"])))
              for r in sizes}
    if not blocks:
        return classed.withColumn("block", F.lit(0).cast("long"))
    count = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col("class")]
    return classed.withColumn("block", F.shiftleft(F.col("class").cast("long"), 40)
                              + F.pmod(F.xxhash64("no"), count))


def block_files(terms: DataFrame, stats: DataFrame, folder: str, documents: int) -> list[str]:
    """Compiled blocks of items."""
    items = cut(dealt(terms).select("block", "no", "first"))
    used = items.select(F.col("block").alias("of"), F.explode("first").alias("term")).distinct().join(
        stats.where("term is not null").select("term", "df"), "term")

    def compiled(items: pa.Table, used: pa.Table) -> pa.Table:
        path = None
        if items.num_rows and used.num_rows:
            term, df = (used.column(c).to_numpy() for c in ("term", "df"))
            order = np.argsort(term)
            term = term[order]
            weights = np.array([weight(int(x), documents) for x in df[order]], np.int64)
            rows = items.column("first").combine_chunks()
            names = rows.flatten().to_numpy()
            of = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(term, names), len(term) - 1)
            held = term[at] == names  # terms of no document score nothing
            of, at = of[held], at[held]
            ptr = np.searchsorted(of, np.arange(len(rows) + 1))
            some = np.flatnonzero(np.diff(ptr))
            ptr, at = reordered(ptr, some, at)
            order = similar_order(ptr, at, weights, some)
            ptr, at = reordered(ptr, order, at)
            path = put(folder, {"term": term, "weight": weights, "ptr": ptr, "at": at,
                                "no": items.column("no").to_numpy()[some[order]]})
        return pa.table({"path": pa.array([path], pa.string())})

    made = cut(items.groupBy("block").cogroup(used.groupBy("of")).applyInArrow(
        compiled, "path string").where("path is not null"))
    return [r["path"] for r in made.collect()]  # one of about CELLS items times terms


class Search:
    """The trees of one block of items and of some documents, and the best pairs so far."""

    def __init__(self, block: dict[str, np.ndarray], docs: Level, best: int):
        self.best, n = best, len(block["ptr"]) - 1
        terms = len(block["term"])
        items = hierarchy(Level(block["ptr"], block["at"], block["weight"][block["at"]],
                                np.zeros(n, np.int64)), terms)
        #: for each item level the maxima by term and node
        self.sides = []
        for level in items:
            side = np.zeros((terms, len(level)), np.int64)
            side[level.term, np.repeat(np.arange(len(level)), np.diff(level.ptr))] = level.value
            self.sides.append(side)
        self.docs = hierarchy(docs, terms)
        self.scores = np.zeros((n, best), np.int64)
        self.places = np.full((n, best), -1, np.int64)
        self.exact = 0  # pairs scored

    def bounds(self, a: int, rows: np.ndarray, b: int, cols: np.ndarray) -> np.ndarray:
        """Bounds, or at the leaves scores, of these item nodes and document nodes."""
        level, side = self.docs[b], self.sides[a]
        side = side if len(rows) == side.shape[1] else side[:, rows]
        counts = level.ptr[cols + 1] - level.ptr[cols]
        out = np.empty((len(rows), len(cols)), np.int64)
        ends, at = np.cumsum(counts), 0
        while at < len(cols):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + PART_CELLS // len(rows), "right")))
            own = ragged(level.ptr[cols[at:to]], counts[at:to])
            product = side[level.term[own]] * level.value[own][:, None]
            out[:, at:to] = np.add.reduceat(product, ends[at:to] - counts[at:to] - before).T
            at = to
        return out

    def weakest(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        """For each item node its least kth score, and the last place it is held by."""
        score, place = self.scores[:, -1], self.places[:, -1]
        for _ in range(a):
            heads = np.arange(0, len(score), FAN)
            least = np.minimum.reduceat(score, heads)
            held = score == np.repeat(least, np.diff(np.append(heads, len(score))))
            score, place = least, np.maximum.reduceat(np.where(held, place, -1), heads)
        return score, place

    def alive(self, a: int, rows: np.ndarray, b: int, cols: np.ndarray,
              bound: np.ndarray) -> np.ndarray:
        score, place = self.weakest(a)
        tie = self.docs[b].earliest[cols][None, :] < place[rows][:, None]
        return (bound > score[rows][:, None]) | ((bound == score[rows][:, None]) & tie)

    def run(self) -> None:
        """All documents, one subtree after the other, the most promising first."""
        b, a = min(START, len(self.docs) - 1), len(self.sides) - 1
        cols, root = np.arange(len(self.docs[b])), np.zeros(1, np.int64)
        for k in np.argsort(-self.bounds(a, root, b, cols)[0], kind="stable").tolist():
            self.descend(a, root, b, cols[k:k + 1])

    def descend(self, a: int, rows: np.ndarray, b: int, cols: np.ndarray) -> None:
        open_pairs = np.ones((len(rows), len(cols)), bool)
        while True:
            bound = self.bounds(a, rows, b, cols)
            open_pairs &= self.alive(a, rows, b, cols, bound)
            some = open_pairs.any(axis=1), open_pairs.any(axis=0)
            if not some[0].any():
                return
            rows, cols = rows[some[0]], cols[some[1]]
            open_pairs = open_pairs[np.ix_(*some)]
            if not a and not b:
                self.exact += int(open_pairs.sum())
                self.keep(rows, cols, bound[np.ix_(*some)], open_pairs)
                return
            if b >= a:
                b -= 1
                cols, of = children(cols, len(self.docs[b]))
                open_pairs = open_pairs[:, of]
            else:
                a -= 1
                rows, of = children(rows, self.sides[a].shape[1])
                open_pairs = open_pairs[of]

    def keep(self, rows: np.ndarray, cols: np.ndarray, score: np.ndarray,
             open_pairs: np.ndarray) -> None:
        place = self.docs[0].earliest[cols]
        for i, row in enumerate(rows.tolist()):
            own = np.flatnonzero(open_pairs[i])
            s = np.concatenate([self.scores[row], score[i, own]])
            p = np.concatenate([self.places[row], place[own]])
            order = np.lexsort((p, -s))[:self.best]
            self.scores[row], self.places[row] = s[order], p[order]


def children(nodes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes one level below, and which of the given ones each belongs to."""
    below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
    of = np.repeat(np.arange(len(nodes)), FAN)
    return below[below < count], of[below < count]


def document_leaves(block: dict[str, np.ndarray], n: np.ndarray, ptr: np.ndarray,
                    terms: np.ndarray, counts: np.ndarray, documents: int,
                    length: int) -> Level | None:
    """The documents that hold a term of the block, in similar order; `earliest` is the row."""
    row = np.repeat(np.arange(len(n)), np.diff(ptr))
    at = np.minimum(np.searchsorted(block["term"], terms), len(block["term"]) - 1)
    held = np.flatnonzero(block["term"][at] == terms)
    if not len(held):
        return None
    row, at = row[held], at[held]
    value = share(counts[held], n[row], documents, length)
    ptr = np.searchsorted(row, np.arange(len(n) + 1))
    some = np.flatnonzero(np.diff(ptr))
    ptr, at, value = reordered(ptr, some, at, value)
    order = similar_order(ptr, at, block["weight"], n[some])
    ptr, at, value = reordered(ptr, order, at, value)
    return Level(ptr, at, value, some[order])


def best_documents(found: DataFrame, folder: str, paths: list[str], documents: int, length: int,
                   best: int) -> DataFrame:
    """The best documents of each partition for each item."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by([("doc_id", "ascending")])  # null last
        n, ids = table.column("n").to_numpy(), table.column("doc_id").combine_chunks()
        ptr = np.concatenate([[0], np.cumsum(
            table.column("terms").combine_chunks().value_lengths().to_numpy())])
        terms, counts = (table.column(c).combine_chunks().flatten().to_numpy()
                         for c in ("terms", "counts"))
        for path in paths:
            block = fetch(folder, path)
            leaves = document_leaves(block, n, ptr, terms, counts, documents, length)
            if leaves is None:
                continue
            search = Search(block, leaves, best)
            search.run()
            item, k = np.nonzero(search.scores > 0)
            yield pa.record_batch({
                "no": pa.array(block["no"][item]),
                "doc_id": ids.take(pa.array(search.places[item, k])),
                "score": pa.array(search.scores[item, k])})

    return found.where(F.size("terms") > 0).mapInArrow(task, FOUND)


def rank_documents(documents: DataFrame, items: DataFrame, best: int = BEST,
                   key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                   item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each item (see the module)."""
    bounded_batches(documents.sparkSession)
    folder = new_folder(documents)
    items = cut(items.select(F.monotonically_increasing_id().alias("no"),
                             F.col(item_key).alias("item_id"), F.col(item_text).alias("text")))
    terms, words, seed = named_terms(items)
    found = vectors(documents, folder, vocabulary_files(words, folder), seed, key, text)
    stats = statistics(found)
    total = stats.where("term is null").first()
    n, length = (total["df"], total["length"]) if total else (0, 1)
    paths = block_files(terms, stats, folder, n)
    each = best_documents(found, folder, paths, n, length, best)
    order = W.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(items.select("no", "item_id"), "no").select(
        "item_id", "rank", "doc_id", "score")
