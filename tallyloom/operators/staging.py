"""RAW text to typed staging columns, one narrow projection per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean, to_type
from ..schemas import FEEDS, SALES, Feed

_FIELDS = ", ".join(f"`{raw}`: string" for _, raw, _ in SALES)
EVENT_PAYLOAD_SCHEMA = f"transaction struct<{_FIELDS}>"

_ENVELOPE = ["streaming_record_id", "event_id", "event_type", "event_timestamp",
             "source", "source_file"]
_POSITION = ["kafka_topic", "kafka_partition", "kafka_offset", "ingested_at"]


def _typed(feed: Feed, text, tolerant: bool):
    """Typed columns of a feed; `text(raw_name)` gives the input text column."""
    return [
        to_type(text(raw), kind, tolerant).alias(feed.renamed.get(raw, raw))
        for _, raw, kind in feed.columns
    ]


def stage(raw: DataFrame, table: str, tolerant: bool = False) -> DataFrame:
    """Clean and type one RAW batch table. A value that does not cast fails the query;
    with tolerant=True it becomes NULL (see `rejects`)."""
    feed = FEEDS[table]
    lineage = [c for c in feed.lineage if c in raw.columns]
    return raw.select(*_typed(feed, lambda c: clean(F.col(c)), tolerant), *lineage)


def _bad_columns(feed: Feed, text):
    """Names of the columns whose text is there but does not cast."""
    checks = [
        F.when(text(raw).isNotNull() & to_type(text(raw), kind, True).isNull(), F.lit(raw))
        for _, raw, kind in feed.columns if kind != "text"
    ]
    return F.array_compact(F.array(*checks))


def rejects(raw: DataFrame, table: str) -> DataFrame:
    """Rows strict staging would fail on, with the offending column names."""
    bad = _bad_columns(FEEDS[table], lambda c: clean(F.col(c)))
    return raw.withColumn("bad_columns", bad).filter(F.size("bad_columns") > 0)


def accepted(raw: DataFrame, table: str) -> DataFrame:
    """Rows without rejects, staged: the quarantine alternative to strict staging."""
    bad = _bad_columns(FEEDS[table], lambda c: clean(F.col(c)))
    return stage(raw.filter(F.size(bad) == 0), table, tolerant=True)


def with_transaction(raw_events: DataFrame) -> DataFrame:
    """Events with the fields of their transaction as text. The sink stores them so: a payload
    is parsed once, not in every build."""
    if "transaction" in raw_events.columns:
        return raw_events
    return raw_events.withColumn(
        "transaction", F.from_json("payload", EVENT_PAYLOAD_SCHEMA)["transaction"])


def stage_events(raw_events: DataFrame, tolerant: bool = False) -> DataFrame:
    """Typed sales columns of stored events. Blank ids stay '' here, unlike batch staging."""
    feed = FEEDS["sales"]
    parsed = with_transaction(raw_events)

    def text(raw: str):
        column = F.col("transaction").getField(raw)
        return F.trim(column) if raw.endswith("_id") else column

    return parsed.select(*_ENVELOPE, *_typed(feed, text, tolerant), *_POSITION)


def rejected_events(raw_events: DataFrame) -> DataFrame:
    """Stored events that passed the contract but do not cast."""
    bad = _bad_columns(FEEDS["sales"], lambda c: F.col("transaction").getField(c))
    return (with_transaction(raw_events).withColumn("bad_columns", bad)
            .filter(F.size("bad_columns") > 0).drop("transaction"))
