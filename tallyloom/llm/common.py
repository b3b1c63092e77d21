"""What several operators share: texts as flat byte arrays, word hashes, components.

Inside tasks a text column is one flat byte array with offsets, taken from Arrow as it is;
no Python object is made per text or word. Word hashes are 64 bit; operators that must be
exact compare the words, or a second independent hash, before they decide.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
PIECE_BYTES = 1 << 20  # texts are worked on in pieces of about this size
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT = "67108864b"
BATCH_BYTES = 8 << 20
LONG_WORD = 256  # words above this many bytes are hashed by BLAKE2


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    The setting must be there, except on a local master, where one process does all.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(os.environ.get("TMPDIR", "/tmp"), "tallyloom-llm")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about BATCH_BYTES, unless the session says else."""
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and read back from the shared folder."""
    shared_folder(df.sparkSession, "cut")
    return df.checkpoint()


def two_columns(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only id and text, whatever other columns there are."""
    bounded_batches(df.sparkSession)
    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text; a longer text is one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def word_map(separators: bytes, lower: bool) -> np.ndarray:
    """For each byte the byte it counts as, or 0 where it separates words."""
    table = np.arange(256, dtype=np.uint8)
    table[list(separators)] = 0
    if lower:
        table[65:91] = np.arange(97, 123)
    return table


#: ASCII letters and digits and everything beyond ASCII make words, letters in lower case.
ALNUM = word_map(bytes([*range(0, 48), *range(58, 65), *range(91, 97), *range(123, 128)]), True)
#: Everything but ASCII white space makes words.
SPACED = word_map(bytes([0x20, *range(9, 14)]), False)


class Words:
    """The words of some texts: where they are, which text they belong to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray,
                 zero_is_word: bool = False):
        self.bytes = table[data]
        inside = self.bytes != 0
        if zero_is_word:  # byte 0 is a word byte of its own
            inside |= data == 0
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        #: first word of each text, and the end
        self.offsets = np.searchsorted(self.starts, offsets).astype(np.int64)
        self.counts = np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        """The text of each word, by number."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits for each word."""
        return ranges_hash(self.bytes, self.starts, self.ends, seed)

    def text(self, i: int) -> bytes:
        return self.bytes[self.starts[i]:self.ends[i]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_TABLES: dict[int, tuple[np.ndarray, int]] = {}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _family(seed: int) -> tuple[np.ndarray, int]:
    if seed not in _TABLES:
        values = mix(np.arange(1, 258, dtype=U64) + U64(seed * 1000003 + 17))
        _TABLES[seed] = values[:256], int(values[256]) | 5
    return _TABLES[seed]


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the family's base and of its inverse modulo 2**64."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < n:
        base = _family(seed)[1]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.empty(n, U64)
            p[:1] = 1
            done = 1
            while done < n:
                step = min(done, n - done)
                p[done:done + step] = p[:step] * U64(pow(b, done, 1 << 64))
                done += step
            out.append(p)
        if n > 2 * PIECE_BYTES:  # a very long text: not kept
            return out[0], out[1]
        _POWERS[seed] = out[0], out[1]
    return _POWERS[seed]


def ranges_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                seed: int = 0) -> np.ndarray:
    """64 bits for each range of bytes, from running sums of a polynomial."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, U64)
    power, inverse = _powers(seed, n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_family(seed)[0][data] * power[:n], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8,
                                 salt=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def windows_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 seed: int = 0) -> np.ndarray:
    """64 bits for each range of 64-bit symbols."""
    n = len(symbols)
    if not len(starts):
        return np.zeros(0, U64)
    power, inverse = _powers(seed + 100, n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(mix(symbols + U64(seed * 7919 + 3)) * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(U64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:n]) > 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable over the edges (a, b), for ids with an edge.

    Large star and small star by turns: each node hangs its larger neighbours on the
    smallest one it knows. Minima are pre-aggregated before they are shuffled, hubs are split
    by the adaptive skew join, and every second round is written to the shared folder. No
    list of neighbours is ever built.
    """
    def hang(both: DataFrame) -> DataFrame:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(least, "u")

    edges = cut(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = hang(large)
        edges = cut(small.select(F.col("v").alias("u"), "m").union(small.select("u", "m"))
                    .where("u <> m").select("u", F.col("m").alias("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")),
                        F.sum(F.col("v").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots).distinct()


def least_labels(link: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Smallest reachable number for each of n places over linked pairs."""
    label = np.arange(n)
    if not link:
        return label
    i = np.concatenate([x for x, _ in link])
    j = np.concatenate([y for _, y in link])
    while True:
        new = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def settle(classes: DataFrame, links: DataFrame) -> DataFrame:
    """uid, id, n_links, component_id, kept_uid of each class of equal rows.

    classes: uid, id (of its first row), members. links: uid, n (linked documents of other
    classes), to (one of them, so that these edges join all that is linked).
    """
    counts = links.groupBy("uid").agg(F.sum("n").alias("n"))
    part = components(links.select(F.col("uid").alias("a"), F.col("to").alias("b")))
    named = classes.select("uid", "id", "members").join(counts, "uid", "left").join(
        part.withColumnRenamed("id", "uid"), "uid", "left").select(
        "uid", "id", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("component", "uid").alias("component"))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "uid")
    names = named.groupBy("component").agg(F.min(order).alias("first")).select(
        "component", F.col("first.id").alias("component_id"),
        F.col("first.uid").alias("kept_uid"))
    return named.join(names, "component").drop("component")
