"""Queries over the run log and the source state log.

Both logs are append-only; what an update would have changed is the latest entry here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .unify import first_by

_RUN_FIELDS = ["pipeline_name", "source_name", "source_hash", "source_size_bytes",
               "source_modified_at", "started_at", "finished_at", "records_received",
               "records_inserted", "records_rejected", "status", "error_message"]

SOURCE = ["pipeline_name", "source_name"]


def current_runs(run_log: DataFrame) -> DataFrame:
    """One row per run: each field as last set."""
    when = F.struct("step", "logged_at")
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in _RUN_FIELDS]
    return run_log.groupBy("run_id").agg(*last)


def processed_runs(runs: DataFrame) -> DataFrame:
    """Newest successful run of every (pipeline, source, content hash)."""
    done = runs.filter((F.col("status") == "SUCCESS") & F.col("source_hash").isNotNull())
    return done.groupBy(*SOURCE, "source_hash").agg(F.max("run_id").alias("run_id"))


def decide(files: DataFrame, runs: DataFrame, pipeline: str) -> DataFrame:
    """Found files against the ledger: SKIP content loaded before, LOAD the rest."""
    known = processed_runs(runs.filter(F.col("pipeline_name") == pipeline)).select(
        "source_name", F.col("source_hash").alias("sha256"), F.col("run_id").alias("known_run"))
    return files.join(known, ["source_name", "sha256"], "left").withColumn(
        "decision", F.when(F.col("known_run").isNull(), "LOAD").otherwise("SKIP"))


def active_state(state_log: DataFrame) -> DataFrame:
    """The active version of every source: its latest state entry."""
    entry = F.struct("active_run_id", "active_source_hash", "last_observed_at")
    latest = state_log.groupBy(*SOURCE).agg(F.max_by(entry, "seq").alias("s"))
    return latest.select(*SOURCE, "s.*")


def latest_versions(runs: DataFrame) -> DataFrame:
    """Latest successful run per source by finish time. An unknown finish time ranks first."""
    latest = first_by(runs.filter("status = 'SUCCESS'"), SOURCE, [
        F.col("finished_at").desc_nulls_first(), F.col("run_id").desc()])
    return latest.select(*SOURCE, "run_id", "source_hash", "source_size_bytes",
                         "source_modified_at", "started_at", "finished_at")


def seed_state(runs: DataFrame) -> DataFrame:
    """Active versions derived from the ledger alone. An unknown finish time ranks last."""
    hashed = runs.filter((F.col("status") == "SUCCESS") & F.col("source_hash").isNotNull())
    latest = first_by(hashed, SOURCE, [
        F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()])
    return latest.select(*SOURCE, F.col("run_id").alias("active_run_id"),
                         F.col("source_hash").alias("active_source_hash"))


def current_raw(raw: DataFrame, state: DataFrame, pipeline: str,
                source_name: str | None = None) -> DataFrame:
    """RAW rows of the active versions; of one source only if it is named.

    The state is one row per file; Spark broadcasts it if it is small and then prunes the
    pipeline_run_id folders while reading, and shuffles the join if it is not. Take `state`
    once for all tables of a run, so that they show the same versions.
    """
    chosen = state.filter(F.col("pipeline_name") == pipeline)
    if source_name is not None:
        chosen = chosen.filter(F.col("source_name") == source_name)
    active = chosen.select(F.col("active_run_id").alias("pipeline_run_id"))
    return raw.join(active, "pipeline_run_id", "inner").select(*raw.columns)


def backfill(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Successful runs without a hash, with the fingerprint their file has now, by run id.

    `files` names the pipeline that takes each file. decision is UPDATE, or SKIP where the
    file is gone.
    """
    unhashed = runs.filter((F.col("status") == "SUCCESS") & F.col("source_hash").isNull())
    found = files.select(*SOURCE, "sha256", "size_bytes", "modified_at")
    return unhashed.select("run_id", *SOURCE).join(found, SOURCE, "left").select(
        "run_id", *SOURCE, "sha256", "size_bytes", "modified_at",
        F.when(F.col("sha256").isNull(), "SKIP").otherwise("UPDATE").alias("decision")
    ).orderBy("run_id")


def unknown_runs(df: DataFrame, runs: DataFrame, column: str = "pipeline_run_id") -> DataFrame:
    """Run ids of a table that the ledger does not know, with their row counts."""
    used = df.groupBy(F.col(column).alias("run_id")).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(runs.select("run_id"), "run_id", "left_anti")
