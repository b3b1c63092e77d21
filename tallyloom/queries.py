"""The registered queries: every operator of the mart over the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as b
from .operators import profiling, quality, reconcile, versioning
from .operators.staging import EVENT_PAYLOAD_SCHEMA, stage_events
from .plans.ingest import load_files, sales_files
from .plans.jobs import build
from .plans.models import MARTS, STAGING, Models
from .plans.sync import merge_new_events
from .schemas import ENTITIES, FEEDS, SALES_PIPELINE, TRANSACTION_FIELDS
from .session import configure, work_dir
from .sources.events import read_events, sales_to_events
from .sources.files import file_rows, fingerprint, read_entity
from .sources.layers import Lake
from .sources.ledger import Ledger
from .streaming.contract import split, to_dlq, validate, with_decoder_text
from .streaming.index import EventIndex
from .streaming.sink import compact_index, raw_events, run_available, run_within

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, folder: str) -> b.Tables:
    return b.Tables(configure(spark), folder)


def models(spark: SparkSession, folder: str, exact_margin: bool = False) -> Models:
    """The model graph over the bound tables. Margins divide as double, as the SQL does,
    unless the exact quotient is asked for."""
    return Models(b.sources(_tables(spark, folder)), exact_margin=exact_margin)


def _stored_models(spark: SparkSession, folder: str, exact_margin: bool = False) -> Models:
    """The same, but staged facts that other models read are written first, as a build does."""
    t = _tables(spark, folder)
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    return Models(b.sources(t), exact_margin=exact_margin,
                  keep=lambda df, name: lake.read_entry(lake.write_model(df, name)))


def _model(name: str) -> Query:
    return lambda spark, folder: _stored_models(spark, folder).ref(name)


def _gross_margin(spark: SparkSession, folder: str) -> DataFrame:
    """The production quotient of decimals, cut to whole millionths."""
    margin = F.col("gross_margin_pct").cast("decimal(30,19)")
    return _stored_models(spark, folder, exact_margin=True).ref("fact_sales").select(
        "sales_key", F.floor(margin * F.lit(1_000_000).cast("decimal(7,0)")).cast("bigint")
        .alias("margin_millionths"))


def _over_tables(fn: Callable[[b.Tables], DataFrame]) -> Query:
    return lambda spark, folder: fn(_tables(spark, folder))


def _over_models(fn: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, folder: fn(_stored_models(spark, folder))


def _runs(t: b.Tables) -> DataFrame:
    return versioning.current_runs(b.run_log(t))


def _event_contract(t: b.Tables) -> DataFrame:
    return validate(b.defective_messages(t)).select(
        "partition", "offset", "error_type", "error_message")


def _event_contract_mixed(t: b.Tables) -> DataFrame:
    return validate(b.envelope_messages(t)).select(
        "offset", "payload", "error_type", "error_message")


def _dlq_events(t: b.Tables) -> DataFrame:
    _, invalid = split(validate(b.envelope_messages(t)))
    return to_dlq(with_decoder_text(invalid), "sales-sink").drop("failed_at")


def _dedup_events(t: b.Tables) -> DataFrame:
    return b.sales_events(t).select(
        "event_id", "kafka_topic", "kafka_partition", "kafka_offset")


_STORED = ["event_id", "quantity", "kafka_partition", "kafka_offset"]


class _Inbox:
    """Message files that stand in for a topic, and a lake that a stream fills from them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.lake = spark, Lake(spark, work_dir(spark, "lake"))
        self.folder = self.lake.path("landing", "messages")

    def send(self, messages: DataFrame) -> _Inbox:
        messages.write.mode("append").parquet(self.folder)
        return self

    def run(self, checkpoint: str = "events", files_per_trigger: int | None = None,
            **options) -> DataFrame:
        stream = read_events(self.spark, folder=self.folder, limit_per_trigger=files_per_trigger)
        return run_available(stream, self.lake, self.lake.path("checkpoints", checkpoint),
                             "sales-sink", **options)

    def stored(self) -> DataFrame:
        return stage_events(raw_events(self.lake)).select(*_STORED)


def _sink_state(t: b.Tables) -> DataFrame:
    """All corrections in one run: of an event's copies the first one stays."""
    inbox = _Inbox(t.spark).send(b.correction_messages(t))
    inbox.run()
    return inbox.stored()


def _sink_index(t: b.Tables) -> DataFrame:
    """Open lines arrive first, all others in a second run: what is stored stays."""
    inbox = _Inbox(t.spark)
    for finished in (False, True):
        inbox.send(b.correction_messages(t, finished)).run()
    return inbox.stored()


def _sink_positions(t: b.Tables) -> DataFrame:
    """A second run brings other events at the positions of stored ones."""
    messages = b.correction_messages(t)
    first = F.col("offset") % 2 == 0
    inbox = _Inbox(t.spark).send(messages.filter(first))
    inbox.run()
    renamed = F.regexp_replace(F.col("value").cast("string"),
                               '"event_id":"([^"]*)"', '"event_id":"$1-b"')
    inbox.send(messages.filter(~first).withColumn("value", renamed.cast("binary")).withColumn(
        "offset", F.col("offset") - 1)).run()
    return inbox.stored()


def _sink_new_checkpoint(t: b.Tables) -> DataFrame:
    """The stream starts anew, without its checkpoint, after the open lines: they come again
    with all others, from the start of the topic. The index is compacted in between."""
    inbox = _Inbox(t.spark).send(b.correction_messages(t, False))
    inbox.run()
    compact_index(inbox.lake)
    inbox.send(b.correction_messages(t, True)).run("anew")
    return inbox.stored()


def _dedup_within(t: b.Tables) -> DataFrame:
    """Batch by batch with a horizon of a day: copies within it go, those beyond it stay."""
    inbox = _Inbox(t.spark)
    for batch in range(len(b.HORIZON_DAYS)):
        inbox.send(b.horizon_messages(t, batch))
        stored = run_within(read_events(t.spark, folder=inbox.folder), inbox.lake,
                            inbox.lake.path("checkpoints", "within"), b.HORIZON)
    return stored.select("event_id", "event_timestamp", "kafka_offset")


def _audit_failed(m: Models) -> DataFrame:
    """The audit record after months whose stock does not balance were lost, without the clock."""
    balanced = m.ref("fact_inventory").filter("closing_stock = calculated_closing_stock")
    rows = {name: n for name, n in m.rows.items() if name != "fact_inventory"}
    counts = reconcile.layer_counts(
        m.source, lambda name: balanced if name == "fact_inventory" else m.ref(name), rows)
    return reconcile.audit_rows(reconcile.reconcile(counts), "sales_batch", "lost").drop(
        "validated_at")


def _synced(t: b.Tables) -> Lake:
    """A full build over the first revision of every line, then a sync for each later one."""
    inbox = _Inbox(t.spark).send(b.revision_messages(t, 0))
    inbox.run()
    lake, streams = inbox.lake, EventIndex(inbox.lake).stored()
    build(lake, {**b.sources(t), "sales_events": raw_events(lake, streams)},
          [m for m in STAGING + MARTS if m not in ("fact_inventory", "fact_sales_target")],
          streams=streams)
    for revision in range(1, b.REVISIONS):
        inbox.send(b.revision_messages(t, revision)).run()
        merge_new_events(lake, lake.snapshot(), EventIndex(lake).stored(),
                         lambda m, only: quality.run_tests(m.ref, only))
    return lake


def _stream_sync(t: b.Tables) -> DataFrame:
    """The sales fact after incremental syncs, without the clock and the exact margin."""
    return _synced(t).mart("fact_sales").drop("ingested_at", "gross_margin_pct")


def _synced_counts(t: b.Tables) -> DataFrame:
    """What the syncs have counted, beside what the files hold."""
    lake = _synced(t)
    snapshot, rows = lake.snapshot(), lake.snapshot().rows()
    both = [(n, rows[n]) for n in ("sales_events", "stg_sales_streaming", "stg_sales_unified",
                                   "fact_sales")]
    counted = t.spark.createDataFrame(both, "name string, counted bigint")
    held = [raw_events(lake).select(F.lit("sales_events").alias("name"))] + [
        snapshot.table(n).select(F.lit(n).alias("name")) for n, _ in both[1:]]
    return reduce(DataFrame.unionByName, held).groupBy("name").agg(
        F.count(F.lit(1)).alias("held")).join(counted, "name")


FILE_MESSAGES = 1 << 18  # messages that one task writes into a file


def _stream_counters(t: b.Tables) -> DataFrame:
    """Four triggers, and a run that ends after the first of them. A trigger takes as many files
    as a quarter of the messages fill."""
    inbox = _Inbox(t.spark)
    files = max(1, t.lineitem.count() // (4 * FILE_MESSAGES))
    inbox.send(b.defective_messages(t, 4 * files))
    inbox.run(files_per_trigger=files, batches=1)
    batches = inbox.run(files_per_trigger=files)
    return batches.agg(*[F.sum(c).alias(c) for c in (
        "processed", "inserted", "duplicates", "dead_letters")])


def _sales_to_events(t: b.Tables) -> DataFrame:
    """Replayed events taken apart again, without their random id and clock time."""
    events = sales_to_events(b.sales(t))
    event = F.from_json(F.col("value").cast("string"),
                        f"event_type string, source_file string, {EVENT_PAYLOAD_SCHEMA}")
    return events.select(F.col("key").cast("string").alias("key"), event.alias("e")).select(
        "key", "e.event_type", "e.source_file", "e.transaction.*")


def _written_csv(t: b.Tables) -> str:
    folder = work_dir(t.spark, "sales-csv")
    names = [F.col(raw).alias(source) for source, raw, _ in FEEDS["sales"].columns]
    b.sales(t).select(*names).write.csv(folder, header=True, escape='"')
    return folder


def _ingest(t: b.Tables, times: int):
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    folder = _written_csv(t)
    reports = [load_files(lake, SALES_PIPELINE, sales_files(t.spark, folder, "*.csv"))
               for _ in range(times)]
    current = versioning.current_raw(
        lake.read("raw", "sales"), Ledger(lake).state(), SALES_PIPELINE)
    return reports, current


def _ingest_sales(t: b.Tables) -> DataFrame:
    return _ingest(t, 1)[1].select(*TRANSACTION_FIELDS)


def _ingest_twice(t: b.Tables) -> DataFrame:
    (first, second), current = _ingest(t, 2)
    loaded = sum(r[3] for r in first)
    skipped = all(r[1] == "SKIPPED" for r in second)
    return current.agg(
        F.lit(loaded).cast("bigint").alias("rows_loaded"),
        F.count(F.lit(1)).alias("rows_current"),
        F.countDistinct("raw_record_id").alias("distinct_records"),
        F.lit(skipped).alias("all_skipped"))


def _profile_files(t: b.Tables) -> DataFrame:
    folder = _written_csv(t)
    profile = profiling.profile_files(
        fingerprint(t.spark, folder, "*.csv"), file_rows(t.spark, folder))
    return profile.agg(F.sum("rows").alias("rows"),
                       F.max("column_count").alias("column_count"),
                       F.bool_and("same_schema").alias("same_schema"))


def _profile_entities(t: b.Tables) -> DataFrame:
    """All six entities, and a documentation sheet that is left out."""
    tables = {}
    for sheet, feed in ENTITIES.items():
        raw = b.sources(t)[feed.table]()
        tables[sheet] = raw.select(*[F.nullif(F.trim(c), F.lit("")).alias(c)
                                     for c in feed.raw_columns])
    return profiling.profile_entities({" Readme ": t.region, **tables})


def _entity_scan(t: b.Tables) -> DataFrame:
    """A typed export of an entity, a row for each line, with blanks around column names, floats
    of many sizes, and rows without any value."""
    folder = f"{work_dir(t.spark, 'export')}/FactInventory.parquet"
    names = [source for source, _, _ in ENTITIES["FactInventory"].columns]
    lines = t.lineitem.select(
        F.col("l_shipdate").cast("timestamp"), F.concat(F.lit("DST"), F.col("l_suppkey")),
        F.concat(F.lit("P"), F.col("l_partkey")), F.col("l_quantity").cast("double"),
        F.col("l_extendedprice").cast("double"), F.col("l_orderkey").cast("double") * 1e9,
        F.col("l_linenumber").cast("double") / 1024, F.col("l_quantity").cast("int"))
    empty = t.region.select(*[F.lit(None).cast(f.dataType) for f in lines.schema.fields])
    lines.toDF(*[f" {n} " for n in names]).union(empty).write.parquet(folder)
    rows = read_entity(t.spark, folder, "FactInventory")
    return rows.select(ENTITIES["FactInventory"].raw_columns)


def _orphans(m: Models) -> DataFrame:
    return quality.orphans(m.ref("stg_sales"), {
        "outlet_id": (m.ref("stg_outlet").filter("channel = 'BUILDING'"), "outlet_id"),
        "distributor_id": (m.ref("stg_distributor"), "distributor_id")})


def _over_build(fn: Callable[[Models], DataFrame], select: list[str] | None = None) -> Query:
    """Over models that a build has written, as the jobs do."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = _tables(spark, folder)
        return fn(build(Lake(spark, work_dir(spark, "lake")), b.sources(t), select))

    return query


def _counts(m: Models) -> DataFrame:
    return reconcile.layer_counts(m.source, m.ref, m.rows)


def all_queries() -> dict[str, Query]:
    return {
        **{name: _model(name) for name in STAGING + MARTS},
        "gross_margin": _gross_margin,
        "run_ledger": _over_tables(_runs),
        "latest_versions": _over_tables(lambda t: versioning.latest_versions(_runs(t))),
        "seed_active": _over_tables(lambda t: versioning.seed_state(_runs(t))),
        "active_state": _over_tables(lambda t: versioning.active_state(b.state_log(t))),
        "skip_decisions": _over_tables(
            lambda t: versioning.decide(b.observed_files(t), _runs(t), SALES_PIPELINE)),
        "backfill_runs": _over_tables(
            lambda t: versioning.backfill(_runs(t), b.observed_files(t))),
        "current_raw_sales": _over_tables(lambda t: versioning.current_raw(
            b.run_sales(t), versioning.active_state(b.state_log(t)), SALES_PIPELINE)),
        "ledger_integrity": _over_tables(lambda t: versioning.unknown_runs(
            t.lineitem, _runs(t).filter("status = 'SUCCESS'"), "l_orderkey")),
        "event_contract": _over_tables(_event_contract),
        "event_contract_mixed": _over_tables(_event_contract_mixed),
        "dlq_events": _over_tables(_dlq_events),
        "dedup_events": _over_tables(_dedup_events),
        "event_sink_state": _over_tables(_sink_state),
        "event_sink_index": _over_tables(_sink_index),
        "event_sink_positions": _over_tables(_sink_positions),
        "event_sink_new_checkpoint": _over_tables(_sink_new_checkpoint),
        "stream_counters": _over_tables(_stream_counters),
        "dedup_within_horizon": _over_tables(_dedup_within),
        "stream_sync_incremental": _over_tables(_stream_sync),
        "stream_sync_counts": _over_tables(_synced_counts),
        "sales_to_events": _over_tables(_sales_to_events),
        "ingest_sales": _over_tables(_ingest_sales),
        "ingest_twice": _over_tables(_ingest_twice),
        "grain_violations_sales": _over_models(
            lambda m: quality.grain_violations(m.ref("stg_sales"), quality.GRAINS["stg_sales"])),
        "grain_violations_unified": _over_models(lambda m: quality.grain_violations(
            m.ref("stg_sales_unified"), quality.GRAINS["stg_sales_unified"])),
        "grain_violations_inventory": _over_models(lambda m: quality.grain_violations(
            m.ref("stg_inventory"), quality.GRAINS["stg_inventory"])),
        "inventory_imbalance": _over_models(
            lambda m: quality.inventory_imbalance(m.ref("fact_inventory"))),
        "unique_violations": _over_models(lambda m: quality.unique_violations(
            m.ref("stg_sales"), ["raw_record_id", "invoice_id"])),
        "null_counts": _over_models(lambda m: quality.null_counts(
            m.ref("stg_product"), ["product_id", "variant"])),
        "orphans": _over_models(_orphans),
        "row_count_pairs": _over_build(
            lambda m: quality.count_mismatch(m.ref("stg_sales"), m.ref("fact_sales")),
            [x for x in STAGING + MARTS if x not in ("fact_inventory", "fact_sales_target")]),
        "run_tests": _over_build(lambda m: quality.run_tests(m.ref, rows=m.rows, apart=True)),
        "reconcile": _over_build(lambda m: reconcile.reconcile(_counts(m))),
        "audit_failed": _over_build(_audit_failed),
        "count_report": _over_build(lambda m: reconcile.count_report(_counts(m))),
        "entity_scan": _over_tables(_entity_scan),
        "profile_entities": _over_tables(_profile_entities),
        "profile_files": _over_tables(_profile_files),
        "fingerprint": lambda spark, folder: fingerprint(
            configure(spark), folder, "*.parquet").drop(
                "header", "quoted_newlines", "record_starts", "crlf"),
    }
