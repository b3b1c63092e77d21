"""Writing the run log and the source state log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.versioning import active_state, backfill, current_runs, seed_state
from ..schemas import RUN_LOG_SCHEMA, STATE_LOG_SCHEMA
from .commits import CommitLog
from .layers import Lake


class Ledger:
    """Entries are only added. Ids are taken from a counter in a commit log before they are
    used, so loads that run at once never share one."""

    def __init__(self, lake: Lake):
        self.lake, self.spark = lake, lake.spark

    def _take(self, counter: str, count: int, log: DataFrame, column: str) -> int:
        """The first of `count` new ids; they follow those of the log and of the counter."""
        used = log.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
        ids = CommitLog(self.spark, self.lake.path("metadata", f"counters/{counter}"))
        _, taken = ids.update(lambda d: {"last": max(d.get("last", 0), used) + count})
        return taken["last"] - count + 1

    def run_log(self) -> DataFrame:
        return self.lake.log("pipeline_runs", RUN_LOG_SCHEMA)

    def runs(self) -> DataFrame:
        return current_runs(self.run_log())

    def state_log(self) -> DataFrame:
        return self.lake.log("source_state", STATE_LOG_SCHEMA)

    def state(self) -> DataFrame:
        return active_state(self.state_log())

    def _append(self, rows: list[dict]) -> None:
        """Add run entries; fields that are not given stay as they were."""
        if not rows:
            return
        schema = T.StructType.fromDDL(RUN_LOG_SCHEMA)
        now = F.current_timestamp()
        filled = [tuple(r.get(f) for f in schema.names) for r in rows]
        df = self.spark.createDataFrame(filled, schema).withColumn("logged_at", now)
        df = (df.withColumn("started_at", F.when(F.col("step") == 0, now))
              .withColumn("finished_at", F.when(F.col("step") == 1, now)))
        self.lake.append_log("pipeline_runs", df)

    def start(self, pipeline: str, files: list) -> dict[str, int]:
        """RUNNING entries for the files of a load; run ids by source name."""
        first = self._take("run_id", len(files), self.run_log(), "run_id")
        ids = {f["source_name"]: first + i for i, f in enumerate(files)}
        self._append([dict(
            run_id=ids[f["source_name"]], pipeline_name=pipeline,
            source_name=f["source_name"], source_hash=f["sha256"],
            source_size_bytes=f["size_bytes"], source_modified_at=f["modified_at"],
            records_received=0, records_inserted=0, records_rejected=0,
            status="RUNNING", step=0) for f in files])
        return ids

    def complete(self, rows_by_run: dict[int, int]) -> None:
        self._append([dict(
            run_id=run, records_received=n, records_inserted=n, records_rejected=0,
            status="SUCCESS", step=1) for run, n in rows_by_run.items()])

    def fail(self, run_ids: list[int], message: str) -> None:
        self._append([dict(run_id=run, status="FAILED", error_message=message, step=1)
                      for run in run_ids])

    def set_active(self, pipeline: str, versions: list[tuple[str, int, str]]) -> None:
        """Make (source, run, hash) the versions the current tables show."""
        if not versions:
            return
        seq = self._take("state_seq", 1, self.state_log(), "seq")
        rows = [(pipeline, source, run, sha, None, seq) for source, run, sha in versions]
        df = self.spark.createDataFrame(rows, STATE_LOG_SCHEMA)
        self.lake.append_log(
            "source_state", df.withColumn("last_observed_at", F.current_timestamp()))

    def seed(self) -> DataFrame:
        """Make the latest hashed successful run of every source its active version; sources
        without one stay as they are. Returns the state."""
        seq = self._take("state_seq", 1, self.state_log(), "seq")
        kept = self.lake.path("metadata", "seeded_state")
        rows = seed_state(self.runs()).withColumn(
            "last_observed_at", F.current_timestamp()).withColumn(
            "seq", F.lit(seq).cast("bigint"))
        names = T.StructType.fromDDL(STATE_LOG_SCHEMA).names
        # written out first: the log must not be read while it is appended to
        rows.select(*names).write.mode("overwrite").parquet(kept)
        self.lake.append_log("source_state", self.spark.read.parquet(kept))
        return self.state()

    def backfill(self, files: DataFrame) -> DataFrame:
        """Give successful runs without a hash the fingerprint of their file now.

        `files` needs pipeline_name, source_name, sha256, size_bytes, modified_at. Returns the
        report.
        """
        schema = T.StructType.fromDDL(RUN_LOG_SCHEMA)
        # written out, because the entries appended below change what it is read from
        kept = self.lake.path("metadata", "backfill_report")
        backfill(self.runs(), files).write.mode("overwrite").parquet(kept)
        report = self.spark.read.parquet(kept)
        found = report.filter("decision = 'UPDATE'").select(
            "run_id", F.col("sha256").alias("source_hash"),
            F.col("size_bytes").alias("source_size_bytes"),
            F.col("modified_at").alias("source_modified_at"),
            F.lit(2).alias("step"), F.current_timestamp().alias("logged_at"))
        entry = found.select(*[
            F.col(f.name) if f.name in found.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        self.lake.append_log("pipeline_runs", entry)
        return report
