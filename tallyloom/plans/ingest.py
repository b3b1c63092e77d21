"""Versioned loads of sales files and master-data entities.

A load of many files is one Spark job, not one per file. The driver handles one small
record per file (its fingerprint and its decision), never data rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.versioning import decide
from ..schemas import (ENTITIES, FEEDS, MASTER_PIPELINE, SALES_FILE_PATTERN,
                       SALES_PIPELINE, Feed)
from ..sources.files import (check_columns, fingerprint, number_rows, scan_csv,
                             scan_parquet, with_scan_id)
from ..sources.layers import Lake
from ..sources.ledger import Ledger

ROW_BITS = 36  # of a record id; the run id has the rest
REPORT_SCHEMA = "source_name string, decision string, run_id bigint, rows bigint"


def _scan(lake: Lake, files: list, feed: Feed) -> DataFrame:
    typed = [f["path"] for f in files if f["path"].endswith(".parquet")]
    texts = [f for f in files if not f["path"].endswith(".parquet")]
    parts = ([scan_parquet(lake.spark, typed, feed)] if typed else []) + (
        [scan_csv(lake.spark, texts, feed)] if texts else [])
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _header_fault(file, feed: Feed) -> str | None:
    if file["path"].endswith(".parquet"):
        return None  # the schema is checked when the file is opened
    try:
        check_columns([c.strip() for c in file["header"]] if file["header"] else None,
                      feed.source_columns)
    except ValueError as error:
        return str(error)
    return None


def _write_raw(lake: Lake, files: list, feed: Feed, run_ids: dict[str, int]) -> dict[int, int]:
    """Scan, land, number and write the rows of the files, one partition per run.

    Returns the rows by run, counted from what was written.
    """
    spark = lake.spark
    landing = lake.path("landing", f"{feed.table}/run={min(run_ids.values())}")
    with_scan_id(_scan(lake, files, feed)).write.mode("overwrite").parquet(landing)
    by_file = spark.createDataFrame(
        [(f["path"].rsplit("/", 1)[-1], run_ids[f["source_name"]]) for f in files],
        "source_file string, run bigint")
    numbered = number_rows(spark.read.parquet(landing)).join(by_file, "source_file", "left")
    stray = F.raise_error(F.concat(F.lit("row of an unknown file: "), "source_file"))
    numbered = numbered.withColumn("pipeline_run_id", F.coalesce("run", stray.cast("bigint")))
    if max(run_ids.values()) >= 1 << (63 - ROW_BITS):
        raise OverflowError("run ids leave no room for row numbers in record ids")
    record = F.shiftleft(F.col("pipeline_run_id"), ROW_BITS) + F.col("source_row_number")
    sheet = [F.lit(feed.sheet).alias("source_sheet")] if feed.sheet else []
    rows = numbered.select(
        record.alias("raw_record_id"), *feed.raw_columns, "source_file", *sheet,
        "source_row_number", "pipeline_run_id",
        F.current_timestamp().alias("ingested_at"))
    lake.write_partitions(rows, "raw", feed.table, "pipeline_run_id")
    written = lake.read("raw", feed.table).filter(
        F.col("pipeline_run_id").isin(list(run_ids.values())))
    counted = written.groupBy("pipeline_run_id").count().collect()  # one row per file
    return {r["pipeline_run_id"]: r["count"] for r in counted}


def _clear_landing(lake: Lake, ledger: Ledger, table: str) -> None:
    """Remove what ended loads have landed. Loads that run at once land in folders of their own."""
    landed = [int(n[4:]) for n in lake.store.names(f"landing/{table}") if n.startswith("run=")]
    ended = ledger.runs().where(F.col("run_id").isin(landed) & (F.col("status") != "RUNNING"))
    for r in ended.select("run_id").collect() if landed else []:
        lake.store.delete(f"landing/{table}/run={r['run_id']}")


def recover_loads(lake: Lake, spare_seconds: float = 24 * 3600) -> list[int]:
    """Give up loads that began, never ended and are older than `spare_seconds`: their process
    is gone. What they wrote was never active; it is removed and the runs are FAILED."""
    ledger = Ledger(lake)
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("started_at")
    lost = [r["run_id"] for r in ledger.runs().where(
        (F.col("status") == "RUNNING") & (age >= spare_seconds)).select("run_id").collect()]
    for run in lost:
        for feed in FEEDS.values():
            lake.store.delete(f"raw/{feed.table}/pipeline_run_id={run}")
            lake.store.delete(f"landing/{feed.table}/run={run}")
    ledger.fail(lost, "abandoned: the load never ended")
    return lost


def _write_all(lake: Lake, ledger: Ledger, group: list, feed: Feed, run_ids: dict[str, int],
               ) -> Iterator[tuple[list, dict[int, int]]]:
    """(files, rows by run) of what is written: all files in one job, or, if that breaks,
    one by one up to the file that breaks it. That one and those behind it fail."""
    try:
        loaded = _write_raw(lake, group, feed, run_ids)
    except Exception as error:
        if len(group) == 1:
            ledger.fail(list(run_ids.values()), str(error))
            raise
    else:
        yield group, loaded
        return
    for i, f in enumerate(group):
        own = {f["source_name"]: run_ids[f["source_name"]]}
        try:
            loaded = _write_raw(lake, [f], feed, own)
        except Exception as error:
            ledger.fail(list(own.values()), str(error))
            ledger.fail([run_ids[x["source_name"]] for x in group[i + 1:]],
                        f"not loaded: {f['source_name']} failed before")
            raise
        yield [f], loaded


def load_files(lake: Lake, pipeline: str, files: DataFrame) -> list[tuple]:
    """Load the files whose content was not loaded before; (source, decision, run, rows).

    `files` are fingerprints with the RAW table they belong to; `place` orders them. They
    are taken in order up to the first one with wrong columns. That one is recorded as
    FAILED and raised after the others are in, as if they came one by one.
    """
    ledger = Ledger(lake)
    decided = decide(files, ledger.runs(), pipeline).orderBy("place").collect()
    faults = {f["source_name"]: fault for f in decided if f["decision"] == "LOAD"
              and (fault := _header_fault(f, FEEDS[f["table"]]))}
    stop = next((i for i, f in enumerate(decided) if f["source_name"] in faults), None)
    todo = decided if stop is None else decided[:stop]

    report, active, counts = [], [], {}
    for f in (f for f in todo if f["decision"] == "SKIP"):
        report.append((f["source_name"], "SKIPPED", f["known_run"], None))
        active.append((f["source_name"], f["known_run"], f["sha256"]))
    fresh = [f for f in todo if f["decision"] == "LOAD"]
    try:
        for table in dict.fromkeys(f["table"] for f in fresh):
            group = [f for f in fresh if f["table"] == table]
            _clear_landing(lake, ledger, table)
            run_ids = ledger.start(pipeline, group)
            for part, loaded in _write_all(lake, ledger, group, FEEDS[table], run_ids):
                for f in part:
                    run = run_ids[f["source_name"]]
                    counts[run] = loaded.get(run, 0)
                    report.append((f["source_name"], "LOADED", run, counts[run]))
                    active.append((f["source_name"], run, f["sha256"]))
    finally:
        ledger.complete(counts)
        ledger.set_active(pipeline, active)
    if stop is not None:
        bad = decided[stop]
        run = ledger.start(pipeline, [bad])[bad["source_name"]]
        ledger.fail([run], faults[bad["source_name"]])
        raise ValueError(f"{bad['source_name']}: {faults[bad['source_name']]}")
    return sorted(report)


def sales_files(spark, folder: str, pattern: str = SALES_FILE_PATTERN) -> DataFrame:
    """Fingerprints of the sales files of a folder, in name order."""
    return fingerprint(spark, folder, pattern).select(
        "*", F.lit("sales").alias("table"), F.col("source_name").alias("place"))


def master_files(spark, folder: str, book: str, entities: list[str]) -> DataFrame:
    """Fingerprints of the entity exports <Entity>.csv or <Entity>.parquet of a folder."""
    names = ",".join(entities)
    found = fingerprint(spark, folder, f"{{{names}}}.{{csv,parquet}}")
    entity = F.substring_index("source_name", ".", 1)
    tables = F.create_map(*[F.lit(x) for e in entities for x in (e, ENTITIES[e].table)])
    order = F.array_position(F.array(*[F.lit(e) for e in entities]), entity)
    return found.select("*", tables[entity].alias("table"), order.alias("place")).withColumn(
        "source_name", F.concat(F.lit(f"{book}:"), entity))


def ingest_sales(lake: Lake, folder: str) -> DataFrame:
    """Load all sales files of a folder; returns one decision per file."""
    report = load_files(lake, SALES_PIPELINE, sales_files(lake.spark, folder))
    if not report:
        raise FileNotFoundError(f"No sales files found in: {folder}")
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)


def master_source(book: str, entity: str) -> str:
    return f"{book}:{entity}"


def ingest_master(lake: Lake, folder: str, book: str = "MasterData",
                  entities: list[str] | None = None) -> DataFrame:
    """Load the entity exports of a folder; returns one decision per entity."""
    wanted = entities or list(ENTITIES)
    report = load_files(
        lake, MASTER_PIPELINE, master_files(lake.spark, folder, book, wanted))
    absent = {master_source(book, e) for e in wanted} - {r[0] for r in report}
    if absent:
        raise FileNotFoundError(f"No export of {sorted(absent)} found in: {folder}")
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)
