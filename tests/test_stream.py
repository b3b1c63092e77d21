"""The event stream job: duplicates, restarts, dead letters, counters."""

import json

import pytest

from test_contract import EVENT, event
from tallyloom.operators.staging import rejected_events, stage_events
from tallyloom.operators.unify import unify_sales
from tallyloom.schemas import MESSAGE_SCHEMA
from tallyloom.sources.events import read_events, sales_to_events
from tallyloom.streaming.contract import validate
from tallyloom.streaming.index import EventIndex
from tallyloom.streaming.sink import (compact_index, dead_letters, raw_events, run_available,
                                      run_within, store_batch, stream_batches)


class Inbox:
    """A folder of message files that stands in for a topic."""

    def __init__(self, spark, lake, **options):
        self.spark, self.lake, self.options = spark, lake, options
        self.folder = lake.path("landing", "inbox")
        self.offset = 0

    def send(self, *values, at=None):
        rows = []
        for v in values:
            offset = self.offset if at is None else at
            text = v if isinstance(v, str) else json.dumps(v)
            rows.append((b"k", text.encode(), "t", 0, offset, None))
            self.offset += at is None
        self.spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode(
            "append").parquet(self.folder)
        return self

    def run(self, checkpoint="events", limit=None, **options):
        stream = read_events(self.spark, folder=self.folder, limit_per_trigger=limit)
        return run_available(stream, self.lake, self.lake.path("checkpoints", checkpoint),
                             "group-1", **{**self.options, **options})

    def ids(self):
        return sorted(r["event_id"] for r in raw_events(self.lake).collect())

    def counters(self):
        return [(r["processed"], r["inserted"], r["duplicates"], r["dead_letters"])
                for r in stream_batches(self.lake).orderBy("recorded_at").collect()]


def numbered(i, **tx):
    return event({"event_id": f"e{i}"}, **tx)


def test_first_arrival_wins_for_ever(spark, lake):
    inbox = Inbox(spark, lake)
    inbox.send(numbered(1, quantity="7"), numbered(2), numbered(1, quantity="8"), "{bad").run()
    assert inbox.ids() == ["e1", "e2"]
    inbox.send(numbered(1, quantity="9"), numbered(3), numbered(3),
               numbered(4, quantity="ABC")).run()
    assert inbox.ids() == ["e1", "e2", "e3"]
    quantity = {r["event_id"]: r["quantity"] for r in stage_events(raw_events(lake)).collect()}
    assert quantity["e1"] == 7
    assert inbox.counters() == [(4, 2, 1, 1), (4, 1, 2, 1)]
    assert sorted(r["error_type"] for r in dead_letters(lake).collect()) == [
        "EventValidationError", "JSONDecodeError"]
    inbox.run()  # nothing new
    assert len(inbox.ids()) == 3 and len(inbox.counters()) == 2


def test_a_hot_event_id_is_stored_once(spark, lake):
    values = [numbered(0)] * 300 + [numbered(i) for i in range(1, 200)]
    inbox = Inbox(spark, lake)
    inbox.send(*values).run()
    assert len(inbox.ids()) == 200
    assert inbox.counters() == [(499, 200, 299, 0)]


def test_the_lowest_of_many_copies_stays(spark, lake):
    inbox = Inbox(spark, lake)
    copies = [numbered(i, quantity=str(k + 1)) for k in range(8) for i in range(50)]
    inbox.send(*copies[:200])
    inbox.send(*copies[200:]).run()
    rows = stage_events(raw_events(lake)).collect()
    assert len(rows) == 50 and {r["quantity"] for r in rows} == {1}
    assert sorted(r["kafka_offset"] for r in rows) == list(range(50))


def test_same_position_is_stored_once(spark, lake):
    inbox = Inbox(spark, lake)
    inbox.send(numbered(1), numbered(3), at=5).run()
    inbox.send(numbered(2), at=5).run()
    assert inbox.ids() == ["e1"]
    # a position whose event was a copy of a stored one is free for another
    inbox.send(numbered(1), numbered(4), at=6).run()
    assert inbox.ids() == ["e1", "e4"]


def test_a_new_checkpoint_keeps_what_is_stored(spark, lake):
    inbox = Inbox(spark, lake)
    inbox.send(numbered(1), numbered(2), "{bad").run()
    inbox.send(numbered(1, quantity="9"), numbered(3)).run("other")
    assert inbox.ids() == ["e1", "e2", "e3"]
    assert inbox.counters() == [(3, 2, 0, 1), (5, 1, 3, 1)]
    inbox.send(numbered(4)).run("third")
    assert inbox.ids() == ["e1", "e2", "e3", "e4"]


def test_a_compacted_index_knows_the_same(spark, lake):
    inbox = Inbox(spark, lake)
    for i in range(3):
        inbox.send(numbered(i), numbered(i + 1)).run()
    compact_index(lake)
    inbox.send(*[numbered(i) for i in range(6)]).run()
    inbox.send(numbered(5)).run()
    compact_index(lake)
    inbox.send(numbered(0), numbered(5), numbered(6)).run("other")
    assert inbox.ids() == [f"e{i}" for i in range(7)]
    index = EventIndex(lake)
    runs = index.runs(index.log.latest()[1])
    assert [r["rows"] for r in runs] == [12, 2]
    base = index.read(runs[:1])
    assert base.select("key").distinct().count() == base.count() == 12


def test_poison_stops_and_a_restart_meets_it_again(spark, lake):
    inbox = Inbox(spark, lake, on_poison="fail")
    inbox.send(numbered(1)).run()
    inbox.send(numbered(2), event({"event_id": None}))
    for _ in range(2):
        with pytest.raises(Exception, match="event_id is null"):
            inbox.run()
    assert inbox.ids() == ["e1"]
    inbox.run(on_poison="dlq")
    assert inbox.ids() == ["e1", "e2"]
    assert [r["error_type"] for r in dead_letters(lake).collect()] == ["UnprocessableEvent"]


def test_a_repeated_batch_replaces_itself(spark, lake):
    inbox = Inbox(spark, lake)
    inbox.send(numbered(1), numbered(2), numbered(1), "{bad").run()
    # the same batch again, as after a crash between the write and the checkpoint
    stream = stream_batches(lake).first()["stream_id"]
    checked = validate(spark.read.schema(MESSAGE_SCHEMA).parquet(inbox.folder))
    store_batch(lake, checked, stream, 0, "group-1")
    assert inbox.ids() == ["e1", "e2"] and dead_letters(lake).count() == 1
    assert inbox.counters() == [(4, 2, 1, 1)]


def test_unify_prefers_the_newest_stream_event(spark):
    batch = spark.sql("""SELECT date'2026-09-01' sales_date, 'D' distributor_id,
        'S' salesperson_id, 'O' outlet_id, p product_id, i invoice_id, q quantity,
        1.00BD unit_price, 0BD discount_pct, 0BD discount_amount, 1BD gross_sales,
        1BD net_sales, 1BD unit_cogs, 1BD total_cogs, r raw_record_id, 'f' source_file,
        timestamp'2026-09-01' ingested_at
        FROM VALUES ('P', 'I', 1, 1L), ('P', 'I', 2, 2L), ('P', 'J', 3, 3L),
                    (NULL, NULL, 4, 4L), (NULL, NULL, 5, 5L) AS t(p, i, q, r)""")
    stream = batch.drop("raw_record_id").filter("quantity < 3").selectExpr(
        "*", "concat('e', quantity) event_id",
        "CASE quantity WHEN 1 THEN timestamp'2026-09-02' END event_timestamp")
    for b in (batch, batch.orderBy("quantity"), batch.orderBy("raw_record_id", ascending=False)):
        rows = {(r["invoice_id"], r["product_id"]): r for r in unify_sales(b, stream).collect()}
        assert len(rows) == 3
        assert rows["I", "P"]["source_record_id"] == "e1"  # a known time beats none
        assert (rows["J", "P"]["record_source"], rows["J", "P"]["quantity"]) == ("batch", 3)
        assert rows[None, None]["quantity"] == 5  # ties go to the higher record id
    assert unify_sales(batch).count() == 3


def test_blank_ids_and_bad_values_of_events(spark, lake):
    inbox = Inbox(spark, lake)
    inbox.send(numbered(1, outlet_id=" ", product_id=" P1 "),
               numbered(2, quantity="2.5"), numbered(3, date="soon")).run()
    stored = raw_events(lake)
    good = stage_events(stored.filter("event_id = 'e1'")).first()
    assert (good["outlet_id"], good["product_id"]) == ("", "P1")
    bad = {r["event_id"]: r["bad_columns"] for r in rejected_events(stored).collect()}
    assert bad == {"e2": ["quantity"], "e3": ["date"]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_events(stored).collect()


def test_stored_events_are_parsed_once(spark, lake):
    Inbox(spark, lake).send(numbered(1, outlet_id=" ", product_id=" P1 "), numbered(2)).run()
    stored = raw_events(lake)
    staged = stage_events(stored)
    assert "from_json" not in staged._jdf.queryExecution().optimizedPlan().toString()
    parsed = stage_events(stored.drop("transaction"))
    assert "from_json" in parsed._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, staged.collect())) == sorted(map(str, parsed.collect()))


def test_copies_beyond_the_horizon_are_new_events(spark, lake):
    def at(i, day):
        return event({"event_id": f"e{i}", "event_timestamp": f"2026-01-{day:02}T00:00:00+00:00"})

    inbox = Inbox(spark, lake)
    for batch in ([at(1, 1), at(1, 1), at(2, 1)], [at(1, 2), "{bad"], [at(3, 20)], [at(4, 25)],
                  [at(1, 26), at(3, 21)]):
        inbox.send(*batch)
        stored = run_within(read_events(spark, folder=inbox.folder), lake,
                            lake.path("checkpoints", "within"), "3 days")
    got = sorted((r["event_id"], r["event_timestamp"].day) for r in stored.collect())
    assert [e for e, _ in got] == ["e1", "e1", "e2", "e3", "e4"]
    assert ("e1", 26) in got and ("e1", 2) not in got and ("e3", 21) not in got


def test_sales_rows_replay_as_valid_events(spark):
    row = {k: (None if k == "unit_cogs" else v) for k, v in EVENT["transaction"].items()}
    sales = spark.createDataFrame([{**row, "source_file": "f.csv"}] * 3, schema=", ".join(
        f"`{c}` string" for c in [*row, "source_file"]))
    sent = [json.loads(r["value"]) for r in sales_to_events(sales, limit=2).collect()]
    assert len(sent) == 2 and sent[0]["event_id"] != sent[1]["event_id"]
    assert sent[0]["transaction"] == row  # an absent value is sent as null
    assert sent[0]["event_type"] == "sales_transaction" and sent[0]["source_file"] == "f.csv"


def test_limit_per_trigger_makes_several_batches(spark, lake):
    inbox = Inbox(spark, lake)
    for i in range(3):
        inbox.send(numbered(i))
    assert inbox.run(limit=1, batches=2).count() == 2  # stops there, and goes on later
    assert len(inbox.ids()) == 2
    assert inbox.run(limit=1).count() == 3
    assert len(inbox.ids()) == 3


def test_source_needs_one_kind(spark):
    with pytest.raises(ValueError):
        read_events(spark)
