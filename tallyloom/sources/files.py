"""Source files: fingerprints, CSV and entity scans, source row numbers."""

from __future__ import annotations

import csv
import hashlib
import io
import re
from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import iso_text
from ..schemas import ENTITIES, FEEDS, SALES_FILE_PATTERN, Feed

HEADER_BYTES = 1 << 20  # a longer first record is no header
SPLIT_BYTES = 32 << 20  # of files with line breaks inside quotes, for each task

_FINGERPRINT = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("header", T.ArrayType(T.StringType())),
    T.StructField("quoted_newlines", T.BooleanType()),
    T.StructField("record_starts", T.ArrayType(T.LongType())),
    T.StructField("crlf", T.BooleanType()),
])


def _open(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    uri = re.sub("^s3[an]:", "s3:", path)  # Spark's names for the same store
    filesystem, inner = pafs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


class _Quotes:
    """Follows the quotes of a file through its pieces: where records begin, and whether every
    quote opens or closes a whole field, so that a count of quotes says what is inside, and all
    lines end alike."""

    OUTSIDE = np.array([44, 10, 13, 34])  # what may stand before an opening, behind a closing

    def __init__(self, split_bytes: int):
        self.split, self.at, self.inside, self.before = split_bytes, 0, 0, 10
        self.regular, self.broken, self.starts = True, False, []
        self.wanted, self.closing_last = split_bytes, False
        self.lone, self.crlf, self.return_last = False, False, False

    def piece(self, data: np.ndarray) -> np.ndarray:
        """Where in the piece line ends stand outside quotes."""
        quote = data == 34
        inside = (self.inside + np.cumsum(quote)) & 1
        line_end = (data == 10) | (data == 13)
        self.broken = self.broken or bool((inside[line_end] == 1).any())
        previous = np.concatenate([[self.before], data[:-1]])
        opening = quote & (inside == 1)
        if not self.at and data[:4].tobytes() == b'\xef\xbb\xbf"':
            opening[3] = False  # the mark at the start of a text file
        closing = np.flatnonzero(quote & (inside == 0))
        if self.closing_last and data[0] not in self.OUTSIDE:
            self.regular = False
        self.closing_last = bool(len(closing)) and closing[-1] == len(data) - 1
        following = data[closing[closing < len(data) - 1] + 1]
        if not (np.isin(previous[opening], self.OUTSIDE).all()
                and np.isin(following, self.OUTSIDE).all()):
            self.regular = False
        outside = inside == 0
        feed, back = (data == 10) & outside, (data == 13) & outside
        self.crlf = self.crlf or bool((feed & (previous == 13)).any())
        self.lone = self.lone or bool((feed & (previous != 13)).any())
        if (self.return_last and data[0] != 10) or (back[:-1] & (data[1:] != 10)).any():
            self.regular = False
        self.return_last = bool(back[-1])
        if self.crlf and self.lone:
            self.regular = False
        ends = np.flatnonzero(line_end & outside)
        while self.wanted <= self.at + len(data):
            k = np.searchsorted(ends, self.wanted - self.at - 1)
            if k == len(ends):
                break
            self.starts.append(int(self.at + ends[k] + 1))
            self.wanted = (self.starts[-1] // self.split + 1) * self.split
        self.at, self.inside, self.before = self.at + len(data), int(inside[-1]), int(data[-1])
        return ends


def fingerprint(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file: SHA-256 of its bytes, size, modification time, header columns,
    whether a quoted field holds a line break, and where records begin near every multiple of
    SPLIT_BYTES (null if stray quotes leave that open).

    The listing reads no content. Each file is then streamed once in 1 MB pieces, so a
    file may be larger than memory; files spread over tasks by size.
    """
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
              .load(folder).select("path", "length", "modificationTime"))
    split_bytes = SPLIT_BYTES

    def inspect(batches):
        def read(path):
            digest, head, head_done, quotes = hashlib.sha256(), b"", False, _Quotes(split_bytes)
            with _open(path) as file:
                while piece := file.read(1 << 20):
                    digest.update(piece)
                    data = np.frombuffer(piece, dtype=np.uint8)
                    ends = quotes.piece(data)
                    if not head_done and (0 in data or len(head) > HEADER_BYTES):
                        head, head_done = b"\xff", True  # binary, or no line at all: no header
                    if not head_done:
                        head += piece[: ends[0]] if len(ends) else piece
                        head_done = len(ends) > 0
            try:
                rows = list(csv.reader(io.StringIO(head.decode("utf-8-sig"), newline="")))
            except (UnicodeDecodeError, csv.Error):
                rows = []  # not a text file: no header
            known = quotes.regular and not quotes.inside and not quotes.return_last
            return (digest.hexdigest(), rows[0] if rows else None, quotes.broken,
                    quotes.starts if known else None, quotes.crlf)

        for batch in batches:
            found = [read(path) for path in batch["path"]]
            yield pd.DataFrame({
                "source_name": batch["path"].str.rsplit("/", n=1).str[-1],
                "path": batch["path"],
                "sha256": [f[0] for f in found],
                "size_bytes": batch["length"],
                "modified_at": batch["modificationTime"],
                "header": [f[1] for f in found],
                "quoted_newlines": [f[2] for f in found],
                "record_starts": [f[3] for f in found],
                "crlf": [f[4] for f in found],
            })

    return listed.mapInPandas(inspect, _FINGERPRINT)


def records(spark: SparkSession, files: list) -> DataFrame:
    """(record, source_file, split_start): the data records of files with line breaks inside
    quotes, each file read by many tasks, from one record start to the next."""
    ranges = []
    for f in files:
        cuts = [0, *(c for c in f["record_starts"] if c < f["size_bytes"]), f["size_bytes"]]
        ranges += [(f["path"], a, b, f["crlf"]) for a, b in zip(cuts, cuts[1:])]

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, start, end, crlf in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(path) as file:
                    file.seek(start)
                    data = np.frombuffer(file.read(end - start), np.uint8)
                if not start and data[:3].tobytes() == b"\xef\xbb\xbf":
                    data = data[3:]
                outside = (np.cumsum(data == 34) & 1) == 0
                line_end = ((data == 10) | (data == 13)) & outside
                kept = np.concatenate([[0], np.cumsum(~line_end)])
                bounds = np.concatenate([[0], kept[np.flatnonzero(line_end)], kept[-1:]])
                bounds = bounds[np.concatenate([[True], np.diff(bounds) > 0])]  # no empty lines
                text = np.ascontiguousarray(data[~line_end])
                out = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(bounds) - 1,
                    [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)])
                out = out[1:] if not start else out  # the header
                name = path.rsplit("/", 1)[-1]
                for k in range(0, len(out), 50_000):
                    part = out[k:k + 50_000].cast(pa.binary())
                    yield pa.record_batch({
                        "record": part, "source_file": pa.array([name] * len(part)),
                        "split_start": pa.array([start] * len(part), pa.int64()),
                        "crlf": pa.array([crlf] * len(part))})

    listed = spark.createDataFrame(ranges, "path string, start long, end long, crlf boolean")
    found = listed.repartition(max(1, len(ranges))).mapInArrow(
        read, "record binary, source_file string, split_start long, crlf boolean")
    text = F.col("record").cast("string")
    # where lines end in two characters, Spark's reader makes one of them inside quotes as well
    text = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    return found.select(text.alias("record"), _decoded("source_file").alias("source_file"),
                        "split_start")


def check_columns(received: list[str] | None, expected: list[str]) -> None:
    """Column names must match as a set; their order does not matter."""
    if received is None:
        raise ValueError("File does not contain a header.")
    missing = [c for c in expected if c not in received]
    unexpected = [c for c in received if c not in expected]
    if missing or unexpected:
        raise ValueError(
            f"Unexpected columns. Missing: {missing} Unexpected: {unexpected} "
            f"Expected: {expected} Received: {received}")


def _plain_number(text: Column) -> Column:
    """The text of a float without exponent, every digit kept, and without a fraction that is
    zero; NaN and infinities stay as they are."""
    form = r"^(-?)(\d+)\.(\d+)(?:E(-?\d+))?$"

    def part(k: int) -> Column:
        return F.regexp_extract(text, form, k)

    digits = F.concat(part(2), part(3))
    point = F.length(part(2)) + F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0))
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= F.length(digits),
              F.concat(digits, F.repeat(F.lit("0"), point - F.length(digits))))
        .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."),
                            F.substr(digits, point + 1))))
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    plain = F.concat(part(1), F.regexp_replace(plain, r"^0+(?=\d)", ""))
    return F.when(F.regexp_like(text, F.lit(form)), plain).otherwise(text)


def _canonical(field: T.StructField) -> Column:
    """A typed cell as text: timestamps in ISO form, floats without exponent and without
    a fraction that is zero, as whole numbers of a sheet are stored."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        text, size = c.cast("string"), F.abs(c)
        # as a function over one value: written out for each column it is too much code
        plain = F.element_at(F.transform(F.array(text), _plain_number), 1)
        # from a thousandth to ten millions Spark writes no exponent
        usual = (F.when(text.endswith(".0"), F.left(text, F.length(text) - 2))
                 .when(text.endswith("0"), plain).otherwise(text))
        found = F.when((size >= 1e-3) & (size < 1e7), usual)
        if isinstance(field.dataType, T.DoubleType):  # whole numbers that a double holds exactly
            whole = (size >= 1e7) & (size < 1e15) & (F.floor(c) == c)
            found = found.when(whole, c.cast("bigint").cast("string"))
        return found.otherwise(plain)
    return c.cast("string")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _decoded(column: str) -> Column:
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _place() -> list[Column]:
    """Where a row was read: file name and start of the split within the file."""
    return [_decoded("_metadata.file_name").alias("source_file"),
            F.col("_metadata.file_block_start").alias("split_start")]


def _layouts(files: list, feed: Feed) -> dict:
    """Paths by header layout. Spark names the columns of a read after its first file, so
    files that order their columns differently must not be read together."""
    groups = defaultdict(list)
    for f in files:
        header = tuple(name.strip() for name in f["header"] or [])
        check_columns(list(header) or None, feed.source_columns)
        groups[header, _way(f)].append(f)
    return groups


def _way(file) -> str:
    """How a CSV file is read: by lines, by the record starts found in it, or in one piece."""
    if not file["quoted_newlines"]:
        return "lines"
    return "whole" if file["record_starts"] is None else "records"


def scan_csv(spark: SparkSession, files: list, feed: Feed) -> DataFrame:
    """Rows of CSV files as RAW text columns plus source_file and split_start.

    `files` are collected fingerprint rows, one per file. Files are split over tasks; those
    with line breaks inside quotes by record starts, and only if stray quotes leave these open
    a file is read in one piece.
    """
    parts = []
    for (header, way), group in _layouts(files, feed).items():
        position = {name: i for i, name in enumerate(header)}
        schema = ", ".join([f"c{i} string" for i in range(len(header))] + ["irregular string"])
        if way == "records":
            row = F.from_csv("record", schema, {
                "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "irregular"})
            rows = records(spark, group).select(row.alias("row"), "source_file", "split_start")
            rows, place = rows.select("row.*", "source_file", "split_start"), [
                "source_file", "split_start"]
        else:
            rows = spark.read.csv(
                [f["path"] for f in group], schema=schema, header=True,
                multiLine=way == "whole", escape='"', columnNameOfCorruptRecord="irregular")
            place = _place()
        cells = []
        for source, raw, _ in feed.columns:
            cell = F.col(f"c{position[source]}")
            if feed.sheet:  # master data: an empty cell is no value
                cell = F.nullif(cell, F.lit(""))
            else:  # sales: an empty cell is '', cells a short row lacks are NULL
                cell = F.when(F.col("irregular").isNull(), F.coalesce(cell, F.lit(""))
                              ).otherwise(cell)
            cells.append(cell.alias(raw))
        parts.append(rows.select(*cells, *place))
    out = _union(parts)
    return out.na.drop(how="all", subset=feed.raw_columns) if feed.sheet else out


def scan_parquet(spark: SparkSession, paths: list[str], feed: Feed) -> DataFrame:
    """Rows of typed entity exports as RAW text; rows without any value are dropped."""
    parts = []
    for path in paths:
        rows = spark.read.parquet(path)
        fields = {f.name.strip(): f for f in rows.schema.fields}
        check_columns(list(fields), feed.source_columns)
        parts.append(rows.select(
            *[_canonical(fields[source]).alias(raw) for source, raw, _ in feed.columns],
            *_place()))
    return _union(parts).na.drop(how="all", subset=feed.raw_columns)


def read_sales_csv(spark: SparkSession, folder: str) -> DataFrame:
    """All sales files of a folder as RAW text rows, sorted discovery, error if none."""
    files = fingerprint(spark, folder, SALES_FILE_PATTERN).orderBy("source_name").collect()
    if not files:
        raise FileNotFoundError(f"No sales files found in: {folder}")
    return scan_csv(spark, files, FEEDS["sales"])


def read_entity(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """One master-data entity export (CSV or Parquet) as RAW text rows."""
    feed = ENTITIES[entity]
    if path.endswith(".parquet"):
        return scan_parquet(spark, [path], feed)
    return scan_csv(spark, fingerprint(spark, path).collect(), feed)


def with_scan_id(rows: DataFrame) -> DataFrame:
    """An id that grows by one from row to row within a split."""
    return rows.withColumn("scan_id", F.monotonically_increasing_id())


def number_rows(landed: DataFrame) -> DataFrame:
    """source_row_number: data rows of each file counted from 2 (row 1 is the header).

    `landed` was written with a scan id, so the numbers do not change when tasks are
    repeated. Only one row per file split is shuffled and ordered, never the data.
    """
    splits = landed.groupBy("source_file", "split_start").agg(
        F.min("scan_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("source_file").orderBy("split_start").rowsBetween(
        W.unboundedPreceding, -1)
    starts = splits.withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    number = F.lit(2) + F.col("rows_before") + F.col("scan_id") - F.col("first_id")
    return (landed.join(starts.drop("n"), ["source_file", "split_start"])
            .withColumn("source_row_number", number)
            .drop("split_start", "scan_id", "first_id", "rows_before"))


def file_rows(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(source_name, rows): records of every CSV file without its header."""
    files = fingerprint(spark, folder, pattern).filter("header is not null").collect()
    parts = []
    for way in ("lines", "whole", "records"):
        group = [f for f in files if _way(f) == way]
        if group and way == "records":
            parts.append(records(spark, group).select("source_file"))
        elif group:
            parts.append(spark.read.csv(
                [f["path"] for f in group], schema="c0 string", header=True, escape='"',
                multiLine=way == "whole").select(_place()[0]))
    return _union(parts).groupBy(F.col("source_file").alias("source_name")).agg(
        F.count(F.lit(1)).alias("rows"))
