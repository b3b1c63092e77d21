"""Conversation prefix trie: every shared beginning of conversations, with what caching it saves.

A turn is named by 128 bits of the SHA-256 of its role and text, a conversation is the row of
its turns' names, and the trie comes out of sorting such rows. Spark range-partitions the rows
by (names, conv_id), so a shard holds neighbours and a conversation that very many ids repeat
is dealt over several shards. In a shard the names become numbers in their order, the rows a
matrix padded with 0, taken COLUMNS columns at a time so that one long conversation does not
widen all others. numpy.lexsort orders the rows; comparing each row with the one before it
gives change masks by column, and OR-accumulated along the columns they mark the rows at which
a node of each depth starts. The aggregates of every depth are reduceat sums over these starts.

A node that holds neither the first nor the last row of its shard lies in this shard alone and
is done. The nodes of those two rows may go on in other shards: each shard gives its part of
them, and Spark adds the parts by node (a digest of its names). What lies below such a node is
summed without walking the trie as a whole: a node's own share counts in one shard only, the
first it lies in; shards sum these shares along their two rows, and the sums are added by node.
No task sees more than one shard, or two rows of each.

`ends_sha256` hashes a list of ids in order, one state from first to last. A shard hashes the
lists of the nodes it finishes; for shared nodes it writes the ids as text in chunks, which
one task per node hashes as a stream, a batch at a time.

A conversation is one row: its names (16 bytes a turn) must fit a task, as one text must.
Sizes: names instead of texts are shuffled, some 50 bytes a turn.

Cases: null role or text is empty. Turns are ordered by turn, null first, equal ones by their
names' digests; repeated rows are turns of their own. Rows without a conv_id belong to no
conversation and are left out. A table without conversations has no node, not even a root.
`c - c%100` keeps the sign of the remainder as SQL does. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, ragged

SHARD_BYTES = 8 << 20  # of names
COLUMNS = 8  # of the matrix that is compared at a time
CHUNK_BYTES = 1 << 20  # of listed ids
NAME = 16  # bytes of a turn's name
HEADS = 6  # a conversation takes up to HEADS - 1 turns of its group's first one
GROUP = 100

EMPTY = hashlib.sha256(b"").hexdigest()
DONE, WAITING, SHARED, LISTED = range(4)  # kinds of what a shard gives
PARTS = ("kind int, shard int, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
         "node binary, parent binary, side int, fork long, size long, seq long, chunk binary")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256"]


def turn_name(role: Column, text: Column) -> Column:
    """Hex digits that name a turn; the length in front keeps role and text apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, names (binary), sizes: each conversation with the head of its group's first."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"),
                 F.substring(turn_name(F.col("role"), F.col("text")), 1, 2 * NAME).alias("name"),
                 F.length(F.coalesce("text", F.lit(""))).alias("size")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.col("t.name").alias("names"), F.col("t.size").alias("sizes"))
    own = own.withColumn("first", F.expr(f"conv_id - conv_id % {GROUP}")).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"))
    heads = own.where("conv_id = first").select(
        "first", F.slice("names", 1, HEADS - 1).alias("head_names"),
        F.slice("sizes", 1, HEADS - 1).alias("head_sizes"))

    def joined(kind: str, empty: str) -> Column:
        return F.expr(f"concat(slice(coalesce(head_{kind}, {empty}), 1, h), "
                      f"slice({kind}, h + 1, greatest(size({kind}) - h, 0)))")

    return own.join(heads, "first", "left").select(
        "conv_id",
        F.unhex(F.array_join(joined("names", "cast(array() as array<string>)"), "")).alias("names"),
        joined("sizes", "cast(array() as array<int>)").alias("sizes"))


def numbered(data: np.ndarray) -> np.ndarray:
    """Numbers from 1 for 128-bit names, in the order of the names."""
    if not len(data):
        return np.zeros(0, np.int64)
    high, low = data[:, 0], data[:, 1]
    order = np.lexsort((low, high))
    new = np.ones(len(order), np.int64)
    new[1:] = ((high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]))
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def block(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Columns k*COLUMNS and on of the padded matrix, for these rows."""
    start = offsets[rows] + k * COLUMNS
    width = np.minimum(offsets[rows + 1] - start, COLUMNS)
    out = np.zeros((len(rows), COLUMNS), np.int64)
    at = np.repeat(np.arange(len(rows)) * COLUMNS, width) + ragged(
        np.zeros(len(rows), np.int64), width)
    out.ravel()[at] = ids[ragged(start, width)]
    return out


def sorted_rows(ids: np.ndarray, offsets: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows by (names, conv_id), shorter first. The last columns are sorted first, each time
    only the rows that reach so far."""
    lengths = np.diff(offsets)
    by_id = np.argsort(conv, kind="stable")
    blocks = -(-lengths[by_id] // COLUMNS)
    done = np.zeros(0, np.int64)
    for k in range(int(blocks.max(initial=0)) - 1, -1, -1):
        rows = np.concatenate([by_id[blocks == k + 1], done])
        done = rows[np.lexsort(block(ids, offsets, rows, k).T[::-1])]
    return np.concatenate([by_id[blocks == 0], done])


def shared_lengths(ids: np.ndarray, offsets: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many first turns each row shares with the row before it."""
    lengths = np.diff(offsets)[order]
    out = np.zeros(len(order), np.int64)
    changed = np.zeros(len(order), bool)
    changed[:1] = True
    for k in range(-(-int(lengths.max(initial=0)) // COLUMNS)):
        at = np.flatnonzero(lengths > k * COLUMNS)
        matrix = block(ids, offsets, order[at], k)
        mask = np.ones(matrix.shape, bool)
        mask[1:] = matrix[1:] != matrix[:-1]
        mask[1:][np.diff(at) > 1] = True  # the row before ends here
        mask[:, 0] |= changed[at]
        mask = np.logical_or.accumulate(mask, axis=1)
        out[at] += (~mask).sum(axis=1)
        changed[at] = mask[:, -1]
    return np.minimum(out, lengths)


def chain(names: np.ndarray) -> list[bytes]:
    """The digest of every first so many names of a row."""
    out = [b""]
    for name in names:
        out.append(hashlib.sha256(out[-1] + name.tobytes()).digest()[:NAME])
    return out


def listed(conv: np.ndarray) -> str:
    return ",".join(map(str, conv.tolist()))


def shard_parts(shard: int, conv: np.ndarray, names: np.ndarray, offsets: np.ndarray,
                sizes: np.ndarray) -> Iterator[dict]:
    """Columns of a shard's parts, depth by depth from the deepest (see the module)."""
    ids = numbered(names)
    order = sorted_rows(ids, offsets, conv)
    lengths, shared, conv = np.diff(offsets)[order], shared_lengths(ids, offsets, order), conv[order]
    n, begin = len(order), offsets[order]
    first, last = (chain(names[offsets[r]:offsets[r + 1]]) for r in (order[0], order[-1]))
    fork = sum(a == b for a, b in zip(first, last)) - 1  # turns that both rows begin with
    below = None  # of the nodes one deeper: start row, open, n_leaves, saved_tokens
    waiting: dict | None = None
    for d in range(int(lengths.max()), -1, -1):
        alive = np.flatnonzero(lengths >= d)
        starts = np.flatnonzero(shared[alive] < d) if d else np.zeros(1, np.int64)
        at = alive[starts]
        n_convs = np.diff(np.append(starts, len(alive)))
        least = np.minimum.reduceat(conv[alive], starts)
        is_end = (lengths[alive] == d).astype(np.int64)
        n_ends = np.add.reduceat(is_end, starts)
        size = sizes[begin[at] + d - 1].astype(np.int64) if d else np.zeros(1, np.int64)
        is_open = np.zeros(len(at), bool)
        is_open[0] |= lengths[0] >= d
        is_open[-1] |= lengths[-1] >= d
        children, leaves, saved = (np.zeros(len(at), np.int64) for _ in range(3))
        if below is not None:
            own = np.searchsorted(at, below["at"], "right") - 1
            closed = ~below["open"]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            for total, values in ((children, closed.astype(np.int64)),
                                  (leaves, below["leaves"] * closed),
                                  (saved, below["saved"] * closed)):
                total[own[heads]] = np.add.reduceat(values, heads)
            waiting["parent_conv_id"] = np.where(is_open[own], 0, least[own])
            waiting["waits"] = is_open[own]
            yield from closed_parts(shard, waiting, d, first, last, at[own] == 0)
        whole = ~is_open
        leaves[whole] += children[whole] == 0
        saved[whole] += ((n_convs - 1) * size)[whole]
        ends = [hashlib.sha256(listed(conv[a:a + k]).encode()).hexdigest() if k else EMPTY
                for a, k in zip(at[whole].tolist(), n_ends[whole].tolist())]
        for side, path in ((0, first), (1, last)):
            k = 0 if side == 0 else len(at) - 1
            if len(path) <= d or (side and d <= fork):
                continue  # the row has no such node, or it is the other row's as well
            yield dict(kind=[SHARED], shard=[shard], conv_id=least[k:k + 1], depth=[d],
                       n_convs=n_convs[k:k + 1], n_children=children[k:k + 1],
                       n_leaves=leaves[k:k + 1], saved_tokens=saved[k:k + 1], node=[path[d]],
                       parent=[path[d - 1] if d else None], side=[side], fork=[fork],
                       size=size[k:k + 1])
            for seq, (a, b) in enumerate(chunks(int(at[k]), int(n_ends[k]))):
                yield dict(kind=[LISTED], shard=[shard], node=[path[d]], seq=[seq],
                           chunk=[listed(conv[a:b]).encode()])
        waiting = dict(conv_id=least[whole], depth=np.full(whole.sum(), d), ends_sha256=ends,
                       n_convs=n_convs[whole], n_children=children[whole],
                       n_leaves=leaves[whole], saved_tokens=saved[whole], whole=whole)
        below = dict(at=at, open=is_open, leaves=leaves, saved=saved)


def chunks(start: int, count: int) -> Iterator[tuple[int, int]]:
    step = CHUNK_BYTES // 20
    for a in range(start, start + count, step):
        yield a, min(a + step, start + count)


def closed_parts(shard: int, nodes: dict, parent_depth: int, first: list[bytes],
                 last: list[bytes], under_first: np.ndarray) -> Iterator[dict]:
    """Nodes of this shard alone, whose parents are now known or are shared themselves."""
    whole = nodes.pop("whole")
    waits, parent = nodes.pop("waits")[whole], nodes.pop("parent_conv_id")[whole]
    if not len(waits):
        return
    left = first[parent_depth] if len(first) > parent_depth else None
    right = last[parent_depth] if len(last) > parent_depth else None
    key = [(left if a and left is not None else right) if w else None
           for w, a in zip(waits.tolist(), under_first[whole].tolist())]
    yield dict(nodes, kind=np.where(waits, WAITING, DONE), shard=[shard] * len(waits),
               parent_conv_id=pa.array(parent, pa.int64(), mask=waits), parent=key)


TYPES = pa.schema([
    ("kind", pa.int32()), ("shard", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("node", pa.binary()), ("parent", pa.binary()), ("side", pa.int32()), ("fork", pa.int64()),
    ("size", pa.int64()), ("seq", pa.int64()), ("chunk", pa.binary())])


def parts(conversations: DataFrame) -> DataFrame:
    """What the shards give: finished nodes, parts of shared ones, listed ids."""
    spark = conversations.sparkSession
    rows = cut(rebuilt(conversations))
    size = rows.agg(F.sum(F.octet_length("names") + 2 * NAME)).first()[0] or 0
    shards = max(-(-size // SHARD_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        column = table.column("names").chunk(0).cast(pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64)[
            column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        names = data.view(">u8").astype(np.uint64).reshape(-1, 2) if len(data) else np.zeros(
            (0, 2), np.uint64)
        sizes = table.column("sizes").chunk(0).flatten()
        for part in shard_parts(TaskContext.get().partitionId(), np.asarray(table.column("conv_id")),
                                names, (at - at[0]) // NAME, np.asarray(sizes)):
            n = len(part["kind"])
            yield pa.record_batch([
                x if isinstance(x, pa.Array) else pa.array(x, f.type)
                for f in TYPES for x in (part.get(f.name, pa.nulls(n, f.type)),)], schema=TYPES)

    return cut(rows.repartitionByRange(int(shards), "names", "conv_id").mapInArrow(task, PARTS))


def hashed_lists(listing: DataFrame) -> DataFrame:
    """node, ends_sha256: the chunks of each node hashed in order, as a stream."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out() -> pa.RecordBatch:
            return pa.record_batch({"node": pa.array([node], pa.binary()),
                                    "ends_sha256": pa.array([state.hexdigest()])})

        for batch in batches:
            for key, chunk in zip(batch.column("node").to_pylist(),
                                  batch.column("chunk").to_pylist()):
                if state is None or key != node:
                    if state is not None:
                        yield out()
                    node, state = key, hashlib.sha256(chunk)
                else:
                    state.update(b"," + chunk)
        if state is not None:
            yield out()

    return listing.repartition("node").sortWithinPartitions("node", "shard", "seq").select(
        "node", "chunk").mapInArrow(task, "node binary, ends_sha256 string")


def shared_nodes(given: DataFrame) -> DataFrame:
    """The nodes that lie in several shards, their parts added up; with node and parent."""
    own = given.where(F.col("kind") == SHARED)
    merged = own.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"),
        F.first("size").alias("size"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("closed"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.min("shard").alias("owner"))
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("shared_children"))
    merged = cut(merged.join(below, "node", "left").withColumn(
        "n_children", F.col("closed") + F.coalesce("shared_children", F.lit(0))).withColumn(
        "leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("size")))

    # each shard sums the shares it owns along its two rows, from the deepest node up
    places = own.select("shard", "side", "fork", "depth", "node").join(
        merged.select("node", "owner", "leaves", "saved"), "node")
    deeper = W.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    both = (F.col("side") == 0) & (F.col("depth") <= F.col("fork"))

    def summed(name: str) -> Column:
        share = F.when(F.col("owner") == F.col("shard"), F.col(name)).otherwise(0)
        other = F.sum(F.when(F.col("side") == 1, share).otherwise(0)).over(W.partitionBy("shard"))
        return F.sum(share).over(deeper) + F.when(both, other).otherwise(0)

    sums = places.select("node", summed("leaves").alias("n_leaves"),
                         summed("saved").alias("saved_tokens")).groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    lists = hashed_lists(given.where(F.col("kind") == LISTED))
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return cut(merged.drop("leaves", "saved").join(sums, "node").join(lists, "node", "left").join(
        parents, "parent", "left").select(
        "node", *[F.coalesce(c, F.lit(EMPTY)).alias(c) if c == "ends_sha256" else c for c in NODE]))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node (see the module and NODE)."""
    given = parts(conversations)
    shared = shared_nodes(given)
    # closed nodes below a shared one: its id comes by shard, so no node is a hot key
    known = given.where(F.col("kind") == SHARED).select(
        "shard", F.col("node").alias("parent")).join(
        shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("found")), "parent")
    waiting = given.where(F.col("kind") == WAITING).drop("parent_conv_id").join(
        known, ["shard", "parent"]).withColumnRenamed("found", "parent_conv_id")
    return given.where(F.col("kind") == DONE).select(NODE).unionByName(
        waiting.select(NODE)).unionByName(shared.select(NODE))
