"""The lake folder: RAW tables, logs and published marts as Parquet.

Data is written first and becomes visible by one small entry afterwards, so a half-written
load or mart is never read. All models of a build become visible together: a snapshot is one
document that says in which files every model lies, with the rows counted while they were
written. Readers take a snapshot and stay with it; what is published meanwhile does not show.

A model lies in one folder of its build, in several (a table that grows by parts), or in hash
buckets of its key, so that a later build may replace single buckets. Files are never changed.
`expire` removes the files that no kept or pinned snapshot needs.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import CommitLog, Conflict, Store

BUCKET = "_bucket"
SLICE_ROWS = 1 << 25  # rows that are dealt to buckets at once


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    """The models of one moment."""

    lake: Lake
    version: int
    document: dict

    @property
    def models(self) -> dict[str, dict]:
        return self.document.get("models", {})

    def rows(self) -> dict[str, int]:
        """Rows of the models and of the RAW tables they were made from."""
        return {**self.document.get("raw_rows", {}),
                **{name: entry["rows"] for name, entry in self.models.items()}}

    def table(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A model, or only some buckets of it."""
        if name not in self.models:
            raise LookupError(f"mart {name} was never built")
        return self.lake.read_entry(self.models[name], buckets)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.store = Store(spark, self.root)
        self._snapshots = CommitLog(spark, self.path("metadata", "snapshots"))

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str, schema: str | None = None) -> DataFrame:
        """A table of a layer; empty with the given schema if nothing was written yet."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if layer == "metadata":  # a folder for every entry
            reader = reader.option("recursiveFileLookup", "true")
        try:
            return reader.parquet(self.path(layer, name))
        except AnalysisException as error:
            if schema is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append_log(self, name: str, rows: DataFrame) -> None:
        """Add entries to a log. Logs hold a few rows per load, one file per entry batch, in a
        folder of its own: jobs that write to one folder at once remove each other's files."""
        rows.coalesce(1).write.parquet(self.path("metadata", f"{name}/{uuid.uuid4().hex}"))

    def log(self, name: str, schema: str) -> DataFrame:
        return self.read("metadata", name, schema)

    def write_partitions(self, df: DataFrame, layer: str, name: str, *columns: str) -> None:
        """Write rows by partition; partitions that are written again are replaced."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*columns).parquet(self.path(layer, name)))

    # -------------------------------------------------------------- models and snapshots

    def write_model(self, df: DataFrame, name: str) -> dict:
        """Write a model's files; returns the entry that a snapshot has of them."""
        folder = f"warehouse/{name}/build={uuid.uuid4().hex[:16]}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(
            f"{self.root}/{folder}")
        return {"schema": df.schema.json(), "rows": counted.get["rows"], "folders": [folder]}

    def write_buckets(self, df: DataFrame, name: str, keys: list[str], buckets: int,
                      rows: int = 0, dealt: bool = False) -> dict:
        """The same in hash buckets. The rows of each bucket are counted from the files' footers.

        About SLICE_ROWS of some `rows` are written in one query, some buckets in each, so that
        what a query shuffles has a bound. `dealt`: the rows are read from such buckets of the
        same keys and stay where they are; else a bucket is a file.
        """
        folder = f"warehouse/{name}/build={uuid.uuid4().hex[:16]}"
        slices = 1 if dealt else min(buckets, max(1, math.ceil(rows / SLICE_ROWS)))
        placed = df.withColumn(BUCKET, bucket_of(keys, buckets))
        for i in range(slices):
            own = placed if slices == 1 else placed.where(F.col(BUCKET) % slices == i)
            own = own if dealt else own.repartition(buckets, BUCKET)
            own.write.mode("append").partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        schema = T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}").groupBy(
            BUCKET).count().collect()  # one row per bucket
        lies = {str(r[BUCKET]): [f"{folder}/{BUCKET}={r[BUCKET]}", r["count"]] for r in rows}
        return {"schema": df.schema.json(), "rows": sum(n for _, n in lies.values()),
                "keys": keys, "buckets": buckets, "lies": lies}

    def read_entry(self, entry: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        if "lies" in entry:
            wanted = entry["lies"] if buckets is None else [
                str(b) for b in buckets if str(b) in entry["lies"]]
            folders = [entry["lies"][b][0] for b in wanted]
        else:
            folders = entry["folders"]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def commit(self, models: dict[str, dict], base: Snapshot | None = None,
               raw_rows: dict[str, int] | None = None,
               streams: dict[str, int] | None = None) -> Snapshot:
        """Publish the written models together.

        With `base`, none of them may have been published by others since then: Conflict.
        `streams` says up to which batch the event models go.
        """
        def change(document: dict) -> dict:
            now = document.get("models", {})
            if base is not None:
                lost = [n for n in models if now.get(n) != base.models.get(n)]
                if lost or document.get("streams") != base.document.get("streams"):
                    raise Conflict(f"published by others meanwhile: {sorted(lost)}")
            return {**document, "models": {**now, **models},
                    "raw_rows": {**document.get("raw_rows", {}), **(raw_rows or {})},
                    **({} if streams is None else {"streams": streams}), "at": time.time()}

        version, document = self._snapshots.update(change)
        return Snapshot(self, version, document)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The last snapshot, or an earlier one that is still kept."""
        if version is None:
            return Snapshot(self, *self._snapshots.latest())
        return Snapshot(self, version, self._snapshots.read(version))

    def publish(self, df: DataFrame, name: str) -> DataFrame:
        """Write and publish one model by itself."""
        return self.commit({name: self.write_model(df, name)}).table(name)

    def mart(self, name: str) -> DataFrame:
        """The model as it was published last."""
        return self.snapshot().table(name)

    def published(self) -> set[str]:
        return set(self.snapshot().models)

    def register(self, name: str, df: DataFrame) -> None:
        """A lazy view for SQL, under the model's own name."""
        df.createOrReplaceTempView(name)

    def pin(self, snapshot: Snapshot, holder: str) -> None:
        """Keep a snapshot until `unpin`; a holder has one pin."""
        self.store.write(f"metadata/pins/{holder}", str(snapshot.version))

    def unpin(self, holder: str) -> None:
        self.store.delete(f"metadata/pins/{holder}")

    def expire(self, keep: int = 1, spare_seconds: float = 24 * 3600) -> list[str]:
        """Remove what neither the last `keep` snapshots nor pinned ones need; returns it.

        Folders changed within `spare_seconds` stay: a build that is under way, or that broke a
        moment ago, has files which no snapshot names yet.
        """
        last, _ = self._snapshots.latest()
        pinned = {int(self.store.read(f"metadata/pins/{h}"))
                  for h in self.store.names("metadata/pins") if not h.startswith(".")}
        kept = {v for v in self._snapshots.versions() if v > last - keep or v in pinned}
        needed = {"/".join(folder.split("/")[:3]) for v in kept
                  for entry in self._snapshots.read(v).get("models", {}).values()
                  for folder in [*entry.get("folders", []),
                                 *(f for f, _ in entry.get("lies", {}).values())]}
        removed = []
        for name in self.store.names("warehouse"):
            for build, changed in self.store.names(f"warehouse/{name}").items():
                folder = f"warehouse/{name}/{build}"
                if folder not in needed and time.time() - changed >= spare_seconds:
                    self.store.delete(folder)
                    removed.append(folder)
        self._snapshots.drop_before(min(kept, default=last))
        return removed
