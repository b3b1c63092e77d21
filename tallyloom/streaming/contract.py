"""The event contract: ten ordered rules, the first one broken names the error.

Everything is a built-in expression over one parse of the message. An event that breaks
a rule is invalid and belongs in the dead-letter table. A poison event is one that the
rules cannot judge or the event table cannot hold; by default it is dead-lettered as
well (on_poison="dlq"), with on_poison="fail" it stops the job.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_uuid, computed_once, utf8_text
from ..functions.numbers import is_finite_text, is_special_text, number_value
from ..schemas import (EVENT_FIELDS, EVENT_LENGTHS, EVENT_TYPE, NON_NEGATIVE_FIELDS,
                       NUMERIC_FIELDS, TRANSACTION_FIELDS)

INVALID = "EventValidationError"
MALFORMED = "JSONDecodeError"
POISON = "UnprocessableEvent"

_DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"  # a bare year or month is no point in time

POSITION = ["topic", "partition", "offset"]


_TX = ", ".join(f"`{f}`: string" for f in TRANSACTION_FIELDS)
_EVENT = (
    "array<struct<event_id: string, event_type: string, event_timestamp: string, "
    f"source: string, source_file: string, transaction: struct<{_TX}>, seal: bigint>>"
)
_STRICT_JSON = {"allowSingleQuotes": "false"}
_TRUTH = ["true", "false"]  # texts that may also be JSON booleans


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add `payload` (text), `event` (declared fields as text) and `parsed` (the whole
    event as a variant).

    Nearly all events have the declared shape, and then `event` decides everything. Only
    for the others, where it matters whether a field is absent, null, a boolean or an
    object, the slower `parsed` is filled and `event` is NULL.

    JSON parsers stop after the first complete value, so the text goes in as
    [text, seal]: trailing junk breaks the wrapper or displaces the seal.
    """
    payload = F.col("value").cast("string")
    seal = F.xxhash64(payload)
    as_object = F.concat(F.lit("["), payload, F.lit(',{"seal":'), seal.cast("string"), F.lit("}]"))
    first = computed_once(messages, payload=payload,
                          pair=F.from_json(as_object, _EVENT, _STRICT_JSON))
    event = F.get("pair", 0)
    tx = event["transaction"]
    declared = (
        F.is_valid_utf8("payload") & (F.size("pair") == 2)
        & (F.get("pair", 1)["seal"] == F.xxhash64("payload"))
        & event["event_id"].isNotNull() & event["event_timestamp"].isNotNull()
        & ~event["event_type"].isin(_TRUTH) & tx.isNotNull()
        & ~_any([F.coalesce(tx[f].isin(_TRUTH), F.lit(False)) for f in NUMERIC_FIELDS])
    )
    as_list = F.concat(F.lit("["), "payload", F.lit(","),
                       F.xxhash64("payload").cast("string"), F.lit("]"))
    kept = first.withColumn("event", F.when(declared, event)).drop("pair")
    return computed_once(
        kept, event=F.col("event"),
        parsed=F.when(F.col("event").isNull(), F.try_parse_json(as_list)))


def _part(path: str = "", dtype: str = "string") -> Column:
    """A piece of the variant event; NULL where the path leads nowhere."""
    return F.try_variant_get("parsed", f"$[0]{path}", dtype)


def _field(path: str) -> Column:
    """A field of the event as text, whichever way it was parsed."""
    declared = reduce(lambda c, name: c[name], path.split("."), F.col("event"))
    return F.when(F.col("event").isNotNull(), declared).otherwise(_part(f".{path}"))


def _kind(path: str = "") -> Column:
    return F.schema_of_variant(_part(path, "variant"))


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def _name_list(names: list[str], absent: list[Column]) -> Column:
    """The absent names printed as ['a', 'b']."""
    missing = F.array_compact(F.array(*[F.when(a, F.lit(n)) for n, a in zip(names, absent)]))
    return F.concat(F.lit("['"), F.array_join(missing, "', '"), F.lit("']"))


def _printed_type() -> Column:
    """The event type as the contract prints it: null and booleans are spelled out."""
    text = F.col("event_type")
    is_boolean = text.isin(_TRUTH) & (_kind(".event_type") == "BOOLEAN")
    return (F.when(text.isNull(), F.lit("None"))
            .when(is_boolean, F.initcap(text)).otherwise(text))


def _extract(parsed: DataFrame) -> DataFrame:
    """The event's fields as text, and what kind of value it is if fields are absent."""
    fields = {f"tx_{f}": _field(f"transaction.{f}") for f in TRANSACTION_FIELDS}
    lacks = _any([_part(f".{f}", "variant").isNull() for f in EVENT_FIELDS])
    sealed = F.try_variant_get("parsed", "$[1]", "bigint") == F.xxhash64("payload")
    declared = F.col("event").isNotNull()
    time = _field("event_timestamp")
    return computed_once(
        parsed,
        well_formed=declared | F.coalesce(sealed, F.lit(False)),
        event_id=_field("event_id"),
        event_type=_field("event_type"),
        event_timestamp=F.when(time.rlike(_DATED), time.try_cast("timestamp")),
        source=_field("source"),
        source_file=_field("source_file"),
        odd_kind=F.when(~declared & lacks, _kind()),  # NULL for a complete object
        **fields,
    )


def _faults() -> list[tuple[str, Column, Column]]:
    """(error type, condition, message) in the order of the contract."""
    tx = {f: F.col(f"tx_{f}") for f in TRANSACTION_FIELDS}
    odd = F.col("odd_kind")
    is_object = odd.startswith("OBJECT")
    is_list = odd.startswith("ARRAY")

    # membership in a list or a text is asked in the same way as in an object
    listed = F.from_json(_part(), "array<string>")
    absent = [
        F.when(is_object, _part(f".{f}", "variant").isNull())
        .when(is_list, ~F.coalesce(F.array_contains(listed, f), F.lit(False)))
        .otherwise(~F.contains(_part(), F.lit(f)))
        for f in EVENT_FIELDS
    ]
    blank = [c.isNull() | (c == "") for c in tx.values()]
    no_fields = F.coalesce(*tx.values()).isNull()

    def is_boolean(f: str) -> Column:  # JSON true, not the text "true"
        as_number = _part(f".transaction.{f}", "double")
        return tx[f].isin(_TRUTH) & as_number.isNotNull()

    def value(f: str) -> Column:
        return F.when(is_boolean(f), (tx[f] == "true").cast("double")).otherwise(
            number_value(tx[f]))

    not_number = {
        f: ~(is_finite_text(tx[f]) | is_special_text(tx[f]) | is_boolean(f))
        for f in NUMERIC_FIELDS
    }
    bad_number = F.coalesce(*[
        F.when(bad, F.concat(F.lit(f"Invalid numeric value for {f}: "), tx[f]))
        for f, bad in not_number.items()
    ])

    def text(message: str) -> Column:
        return F.lit(message)

    return [
        (POISON, F.col("value").isNull(), text("message has no value")),
        (POISON, F.col("event").isNull() & ~F.is_valid_utf8("payload"),
         text("message is not UTF-8")),
        (MALFORMED, ~F.col("well_formed"), text("message is not JSON")),
        (POISON, odd.isNotNull() & ~(is_object | is_list | (odd == "STRING")),
         text("event is not an object")),
        (INVALID, odd.isNotNull() & _any(absent),
         F.concat(text("Missing event fields: "), _name_list(EVENT_FIELDS, absent))),
        (POISON, odd.isNotNull(), text("event is not an object")),
        (INVALID, ~F.col("event_type").eqNullSafe(EVENT_TYPE),
         F.concat(text("Unsupported event type: "), _printed_type())),
        (INVALID, no_fields & F.col("event").isNull() & ~F.coalesce(
            _kind(".transaction").startswith("OBJECT"), F.lit(False)),
         text("transaction must be an object")),
        (INVALID, _any(blank), F.concat(
            text("Missing transaction fields: "), _name_list(TRANSACTION_FIELDS, blank))),
        (INVALID, _any(list(not_number.values())), bad_number),
        (POISON, is_special_text(tx["quantity"]), text("quantity is not a finite number")),
        (INVALID, value("quantity") < 1, text("quantity must be greater than 0")),
        *[(INVALID, value(f) < 0, text(f"{f} cannot be negative"))
          for f in NON_NEGATIVE_FIELDS],
        (POISON, F.col("event_id").isNull(), text("event_id is null")),
        (POISON, F.col("event_timestamp").isNull(),
         text("event_timestamp is not a timestamp")),
        *[(POISON, F.length(c) > n, text(f"{c} is longer than {n}"))
          for c, n in EVENT_LENGTHS.items()],
    ]


def _plainly_valid() -> Column:
    """Of the declared shape and breaks no rule, told by one look at all numbers: a whole
    quantity above zero, and plain decimals without a sign. What is not is judged rule by rule."""
    tx = {f: F.col(f"tx_{f}") for f in TRANSACTION_FIELDS}
    others = [f for f in NUMERIC_FIELDS if f != "quantity"]
    numbers = [x for f in ["quantity", *others] for x in (tx[f], F.lit(" "))]
    plain = F.concat(*numbers).rlike(rf"^[1-9]\d*+ (?:\d++(?:\.\d++)?+ ){{{len(others)}}}\z")
    filled = [c != "" for f, c in tx.items() if f not in NUMERIC_FIELDS]
    short = [F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in EVENT_LENGTHS.items()]
    return F.coalesce(reduce(Column.__and__, [
        F.col("event").isNotNull(), F.col("event_type") == EVENT_TYPE,
        F.col("event_id").isNotNull(), F.col("event_timestamp").isNotNull(),
        plain, *filled, *short]), F.lit(False))


def validate(messages: DataFrame, on_poison: str = "dlq") -> DataFrame:
    """Add payload, the event columns, error_type and error_message (NULL = valid)."""
    if on_poison not in ("dlq", "fail"):
        raise ValueError(f"on_poison must be 'dlq' or 'fail', not {on_poison!r}")

    def found(error_type: str, message: Column) -> Column:
        if error_type == POISON and on_poison == "fail":
            stop = F.raise_error(F.concat(F.lit(f"{POISON}: "), message))
            return stop.cast("struct<type:string,message:string>")
        return F.struct(F.lit(error_type).alias("type"), message.alias("message"))

    fault = F.when(_plainly_valid(), F.lit(None))
    for error_type, broken, message in _faults():
        fault = fault.when(broken, found(error_type, message))
    checked = computed_once(_extract(parse_messages(messages)), fault=fault)
    return checked.select(
        *messages.columns, "payload", "event_id", "event_type", "event_timestamp",
        "source", "source_file",
        F.col("fault.type").alias("error_type"),
        F.col("fault.message").alias("error_message"),
    )


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): disjoint, together complete."""
    return (checked.filter(F.col("error_type").isNull()),
            checked.filter(F.col("error_type").isNotNull()))


def position_text() -> Column:
    return F.concat_ws("/", "topic", F.col("partition").cast("string"),
                       F.col("offset").cast("string"))


def with_decoder_text(invalid: DataFrame) -> DataFrame:
    """Replace the message of malformed JSON by the decoder's own text.

    Only dead-letter rows come here, and only malformed ones reach the decoder.
    """
    def explain(payload: pd.Series) -> pd.Series:
        def error_of(text):
            try:
                json.loads(text)
            except json.JSONDecodeError as error:
                return str(error)
            return None

        return payload.map(error_of, na_action="ignore")

    malformed = F.col("error_type") == MALFORMED
    decoder_text = F.pandas_udf(explain, T.StringType())
    text = decoder_text(F.when(malformed, F.col("payload")))
    return invalid.withColumn(
        "error_message", F.when(malformed, F.coalesce(text, F.col("error_message")))
        .otherwise(F.col("error_message")))


def to_dlq(invalid: DataFrame, consumer_group: str) -> DataFrame:
    """Dead-letter rows. The id derives from the position, so a replay gives it again."""
    return invalid.select(
        as_uuid(F.md5(position_text())).alias("dlq_event_id"),
        F.current_timestamp().alias("failed_at"),
        F.lit(consumer_group).alias("consumer_group"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        "error_type", "error_message",
        utf8_text(F.col("key")).alias("original_key"),
        utf8_text(F.col("value")).alias("original_payload"),
    )


def dlq_messages(dlq: DataFrame) -> DataFrame:
    """Dead-letter rows as (key, value) for a message sink; an empty key becomes NULL."""
    stamp = F.date_format("failed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    body = dlq.withColumn("failed_at", stamp)
    return body.select(
        F.nullif(F.col("original_key"), F.lit("")).alias("key"),
        F.to_json(F.struct(*body.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def without_message(valid: DataFrame) -> DataFrame:
    """Valid events without the message they came in: the payload has it all."""
    return valid.drop("key", "value", "timestamp", "error_type", "error_message")


def to_raw_events(valid: DataFrame) -> DataFrame:
    """Valid events in the layout of the RAW event table.

    The record id packs partition and offset, which are unique within a topic.
    """
    packed = F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")
    return valid.select(
        packed.alias("streaming_record_id"),
        "event_id", "event_type", "event_timestamp", "source", "source_file", "payload",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.current_timestamp().alias("ingested_at"),
    )
