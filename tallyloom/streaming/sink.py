"""The event stream job: contract, duplicate removal, RAW events and dead letters.

An event is stored once for ever: no second event with its id, none with its position, and of
several copies the first arrival (the lowest position) stays. A batch is ranked first, then
anti-joined with the index of all ids and positions stored so far (see index.py). All streams
that write to the lake share the index, whichever checkpoint they have, and may run at once.

Outputs are Parquet partitions by stream and batch, written before the batch is committed to
the index: a repeated batch replaces what it has written, a committed one is not touched again,
and readers see committed batches only. Counters are written with each batch.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import EVENT_PAYLOAD_SCHEMA, with_transaction
from ..operators.unify import first_by
from ..sources.layers import Lake
from .contract import (POSITION, dlq_messages, split, to_dlq, to_raw_events, validate,
                       with_decoder_text, without_message)
from .index import FOLDER, EventIndex, entries, id_key, position_key

RAW_EVENTS_SCHEMA = (
    "streaming_record_id bigint, event_id string, event_type string, "
    "event_timestamp timestamp, source string, source_file string, payload string, "
    "kafka_topic string, kafka_partition int, kafka_offset bigint, "
    f"ingested_at timestamp, {EVENT_PAYLOAD_SCHEMA}, stream_id string, batch_id bigint"
)
DLQ_SCHEMA = (
    "dlq_event_id string, failed_at timestamp, consumer_group string, "
    "source_topic string, source_partition int, source_offset bigint, "
    "error_type string, error_message string, original_key string, "
    "original_payload string, stream_id string, batch_id bigint"
)
METRICS_SCHEMA = (
    "stream_id string, batch_id bigint, processed bigint, inserted bigint, "
    "duplicates bigint, dead_letters bigint, recorded_at timestamp"
)

EVENTS, DEAD, METRICS = "sales_events", "sales_dead_letters", "stream_batches"
BOUNDED = "sales_events_within"
CHECKED, ROW = "checked_events", "_row"  # batches that are being stored, and their rows
BATCH = ["stream_id", "batch_id"]


class EnoughBatches(Exception):
    """Ends a run that was asked for a number of batches; the next batch is not touched."""


def _between(upto: dict[str, int], after: dict[str, int]) -> Column:
    """Whether a batch is one of these, by stream."""
    wanted = [(F.col("stream_id") == s) & (F.col("batch_id") <= n)
              & (F.col("batch_id") > after.get(s, -1))
              for s, n in upto.items() if n > after.get(s, -1)]
    return reduce(Column.__or__, wanted, F.lit(False))


def raw_events(lake: Lake, upto: dict[str, int] | None = None,
               after: dict[str, int] | None = None) -> DataFrame:
    """The stored events of committed batches. The files are listed once, here: later batches
    don't show. `upto` and `after` bound the batches by stream."""
    upto = EventIndex(lake).stored() if upto is None else upto
    return lake.read("raw", EVENTS, RAW_EVENTS_SCHEMA).where(_between(upto, after or {}))


def stored_rows(lake: Lake, upto: dict[str, int], after: dict[str, int]) -> int:
    """How many events these batches have stored, by their own counters."""
    batches = stream_batches(lake).where(_between(upto, after))
    return batches.agg(F.coalesce(F.sum("inserted"), F.lit(0))).first()[0]


def dead_letters(lake: Lake) -> DataFrame:
    return lake.read("raw", DEAD, DLQ_SCHEMA)


def stream_batches(lake: Lake) -> DataFrame:
    """Counters per stream and batch: processed, inserted, duplicates, dead letters."""
    log = lake.log(METRICS, METRICS_SCHEMA)
    return first_by(log, BATCH, [F.col("recorded_at").desc()])


def first_arrivals(valid: DataFrame) -> DataFrame:
    """One row per message position, then one per event id: the lowest position."""
    position = [F.col("topic"), F.col("partition"), F.col("offset")]
    once = first_by(valid, ["topic", "partition", "offset"], [F.col("event_id")])
    return first_by(once, ["event_id"], position)


def compact_index(lake: Lake) -> None:
    """Merge the whole index into one run; streams may go on meanwhile."""
    EventIndex(lake).merge(everything=True)


def not_stored(events: DataFrame, known: DataFrame) -> DataFrame:
    """Events of which neither id nor position is known."""
    marked = events.withColumn("_id_key", id_key()).withColumn(
        "_position_key", position_key())
    ids, positions = (known.where(F.col("key").startswith(kind)) for kind in "ep")
    return (marked.join(ids.withColumnRenamed("key", "_id_key"), "_id_key", "left_anti")
            .join(positions.withColumnRenamed("key", "_position_key"), "_position_key",
                  "left_anti")
            .select(events.columns))


def sweep_events(lake: Lake, spare_seconds: float = 24 * 3600) -> list[str]:
    """Remove what batches have written that were never committed, if it is older than
    `spare_seconds`: their stream is gone for good. Returns the folders."""
    index = EventIndex(lake)
    _, document = index.log.latest()
    stored, over = document.get("stored", {}), []
    for stream in lake.store.names(f"raw/{EVENTS}"):
        for batch, at in lake.store.names(f"raw/{EVENTS}/{stream}").items():
            number = int(batch.partition("=")[2])
            if (number > stored.get(stream.partition("=")[2], -1)
                    and time.time() - at >= spare_seconds):
                over.append(f"raw/{EVENTS}/{stream}/{batch}")
    known = {r["id"] for r in index.runs(document)} | {i for i, _ in document.get("gone", [])}
    over += [f"{FOLDER}/{run}" for run, at in lake.store.names(FOLDER).items()
             if run.partition("=")[2] not in known and time.time() - at >= spare_seconds]
    for folder in over:
        lake.store.delete(folder)
    return over


def _stream_of(batch: DataFrame) -> str:
    """The id that the stream's checkpoint keeps for ever."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _replace_batch(lake: Lake, df: DataFrame, name: str, stream_id: str, batch_id: int) -> None:
    """Write the rows of one batch in place of what an earlier attempt has written."""
    df.write.mode("overwrite").parquet(
        lake.path("raw", f"{name}/stream_id={stream_id}/batch_id={batch_id}"))


def store_batch(lake: Lake, batch: DataFrame, stream_id: str, batch_id: int,
                consumer_group: str, dlq_kafka: dict[str, str] | None = None) -> None:
    """Store one checked batch: events, index, dead letters, counters."""
    index = EventIndex(lake)
    version, document = index.log.latest()
    if batch_id <= document.get("stored", {}).get(stream_id, -1):
        return  # it was committed before the stream broke off
    name = f"{CHECKED}/stream_id={stream_id}/batch_id={batch_id}"
    try:
        batch = _checked_once(lake, batch, name)
        processed, failed = batch.agg(F.count(F.lit(1)), F.count("error_type")).first()
        if not processed:
            return
        valid, invalid = split(batch)
        dead = to_dlq(with_decoder_text(invalid), consumer_group)
        _replace_batch(lake, dead, DEAD, stream_id, batch_id)
        if dlq_kafka:
            dlq_messages(dead).write.format("kafka").options(**dlq_kafka).save()
        seen: set[str] = set()
        run, inserted = None, -1
        while True:
            runs = index.runs(document)
            if inserted < 0 or any(r["id"] not in seen for r in runs):
                inserted = _replace_events(lake, index, valid, runs, stream_id, batch_id)
                run = index.write(_stored_entries(lake, stream_id, batch_id),
                                  2 * inserted) if inserted else None
                lake.append_log(METRICS, lake.spark.createDataFrame(
                    [(stream_id, batch_id, processed, inserted,
                      processed - failed - inserted, failed)],
                    METRICS_SCHEMA.rpartition(",")[0]).withColumn(
                    "recorded_at", F.current_timestamp()))
                seen |= {r["id"] for r in runs}
            if index.add(version, document, run, stream_id, batch_id):
                break
            version, document = index.log.latest()
        index.merge()
    finally:
        lake.store.delete(f"landing/{name}")


def _checked_once(lake: Lake, batch: DataFrame, name: str) -> DataFrame:
    """The checked batch with a number for each row, written to be read several times: an
    executor would hold it as a whole otherwise. The message itself stays only where the event
    is invalid."""
    kept = batch.select(*[
        F.when(F.col("error_type").isNotNull(), F.col(c)).alias(c) if c in ("key", "value")
        else F.col(c) for c in batch.columns], F.monotonically_increasing_id().alias(ROW))
    folder = lake.path("landing", name)
    kept.write.mode("overwrite").parquet(folder)
    return lake.spark.read.schema(kept.schema).parquet(folder)


def _replace_events(lake: Lake, index: EventIndex, valid: DataFrame, runs: list[dict],
                    stream_id: str, batch_id: int) -> int:
    """Write the first arrivals among the events that no run knows; returns how many. Only ids
    and positions are ranked and looked up, then whole events are moved once."""
    keys = valid.select(ROW, "event_id", *POSITION)
    # copies of stored events must not hide others at their place
    won = first_arrivals(not_stored(keys, index.known(runs, entries(keys))))
    fresh = valid.join(won.select(ROW), ROW, "left_semi")
    counted = Observation()
    rows = with_transaction(to_raw_events(fresh)).observe(
        counted, F.count(F.lit(1)).alias("rows"))
    _replace_batch(lake, rows, EVENTS, stream_id, batch_id)
    return counted.get["rows"]


def _stored_entries(lake: Lake, stream_id: str, batch_id: int) -> DataFrame:
    """The index entries of what a batch has written."""
    folder = lake.path("raw", f"{EVENTS}/stream_id={stream_id}/batch_id={batch_id}")
    position = [F.col(f"kafka_{c}").alias(c) for c in POSITION]
    return entries(lake.spark.read.parquet(folder).select("event_id", *position))


def first_within(messages: DataFrame, horizon: str, on_poison: str = "dlq") -> DataFrame:
    """The valid events of a stream of messages, without copies that come within `horizon` of
    event time after the first one.

    The bounded form of the sink's memory: ids lie in Spark's state store and leave it once the
    watermark has passed them by the horizon, so the state follows the rate of events and not
    all history. A copy that comes later is a new event.
    """
    valid, _ = split(validate(messages, on_poison))
    return without_message(valid).withWatermark(
        "event_timestamp", horizon).dropDuplicatesWithinWatermark(["event_id"])


def run_within(messages: DataFrame, lake: Lake, checkpoint: str, horizon: str) -> DataFrame:
    """Store what has arrived by the bounded memory, beside the events that are kept unique for
    ever; returns all that is stored so. A batch that is repeated replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _replace_batch(lake, to_raw_events(batch), BOUNDED, _stream_of(batch), batch_id)

    query = (first_within(messages, horizon).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return lake.read("raw", BOUNDED, RAW_EVENTS_SCHEMA)


def event_sink(messages: DataFrame, lake: Lake, checkpoint: str, consumer_group: str,
               on_poison: str = "dlq", dlq_kafka: dict[str, str] | None = None,
               trigger: dict | None = None, batches: int | None = None) -> StreamingQuery:
    """Start the job. `trigger` defaults to one bounded run over what is there now.

    With `batches` the run ends (with EnoughBatches) before one batch more is stored. How
    many messages a batch has is the source's limit per trigger.
    """
    done = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal done
        if batches is not None and done >= batches:
            raise EnoughBatches(f"stopped after {batches} batches")
        store_batch(lake, batch, _stream_of(batch), batch_id, consumer_group, dlq_kafka)
        done += 1

    return (validate(messages, on_poison).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_available(messages: DataFrame, lake: Lake, checkpoint: str, consumer_group: str,
                  **options) -> DataFrame:
    """Process everything that has arrived, or `batches` batches of it, then stop; returns
    the counters per stream and batch."""
    query = event_sink(messages, lake, checkpoint, consumer_group, **options)
    try:
        query.awaitTermination()
    except Exception as error:
        if "EnoughBatches" not in str(error):
            raise
    return stream_batches(lake)
