"""What keeps queries within their limits as the tables grow."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from test_stream import Inbox, numbered
from tallyloom import bindings, queries
from tallyloom.functions.columns import surrogate_key
from tallyloom.operators import facts, quality
from tallyloom.operators.staging import stage_events
from tallyloom.schemas import MESSAGE_SCHEMA, NUMERIC_FIELDS, TRANSACTION_FIELDS
from tallyloom.sources import layers
from tallyloom.sources.files import _canonical, _plain_number
from tallyloom.streaming import contract
from tallyloom.streaming.sink import first_within, raw_events, stream_batches


def test_lines_travel_once_by_order_and_once_by_product(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    lines = bindings._sales_lines(bindings.Tables(spark, SF))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(moved) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey",
                             "p_partkey"]


def test_a_query_leaves_no_shuffle_behind(spark):
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    known = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = known.size()
    for _ in range(3):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    assert known.size() <= before


def test_a_batch_is_stored_without_a_copy_in_the_executors(spark, lake):
    inbox = Inbox(spark, lake)
    twice = numbered(1, quantity="7")
    inbox.send(twice, twice, at=3).send(numbered(1), numbered(2), at=None).run()
    assert inbox.ids() == ["e1", "e2"] and inbox.counters() == [(4, 2, 2, 0)]
    rows = stage_events(raw_events(lake)).collect()
    assert {r["event_id"]: r["kafka_offset"] for r in rows} == {"e1": 0, "e2": 1}
    assert spark._jsc.getPersistentRDDs().size() == 0
    assert not lake.store.names("landing/checked_events/stream_id=" + stream_batches(
        lake).first()["stream_id"])


def test_bounded_memory_holds_no_second_copy_of_a_message(spark):
    empty = spark.createDataFrame([], MESSAGE_SCHEMA)
    kept = first_within(empty, "1 day").columns
    assert "payload" in kept and not {"key", "value"} & set(kept)


def test_quarters_of_many_messages_are_several_files(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 500)
    sent = []
    run = queries._Inbox.run

    def watched(self, **options):
        out = run(self, **options)
        sent.append((options["files_per_trigger"], out.count()))
        return out

    monkeypatch.setattr(queries._Inbox, "run", watched)
    counters = queries._stream_counters(queries._tables(spark, SF)).first()
    lines = bindings.Tables(spark, SF).lineitem.count()
    assert sent == [(lines // 2000, 1), (lines // 2000, 4)] and sent[0][0] > 1
    assert counters["processed"] == lines


@pytest.mark.parametrize("kind", [T.DoubleType(), T.FloatType()])
def test_usual_floats_are_printed_as_the_others(spark, kind):
    values = [0.0, -0.0, 1.0, -17.0, 0.1, -12.5, 100.0, 1e-3, 9.99e-4, 9999999.0, 9999999.9, 1e7,
              -1.5e7, 123456789.0, 1.23456792e8, 1e15, 999999999999999.0, 1.2e18, 1e-9, 0.30000001,
              1234567.125, float("nan"), float("inf"), float("-inf"), None, 2.0 ** 53, 10.10]
    rows = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", kind)]))
    got = rows.select(_canonical(rows.schema["x"]).alias("a"),
                      _plain_number(F.col("x").cast("string")).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]


def test_messages_are_dealt_before_they_are_written_out(spark):
    t = bindings.Tables(spark, SF)
    dealt = bindings.defective_messages(t, 8)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" in plan[:plan.index("RepartitionByExpression")]
    parts = {r["offset"]: r["p"] for r in dealt.select(
        "offset", F.spark_partition_id().alias("p")).collect()}
    before = bindings.defective_messages(t).repartition(8, "offset").select(
        "offset", F.spark_partition_id().alias("p")).collect()
    assert parts == {r["offset"]: r["p"] for r in before}


def _facts(spark, *ids):
    return spark.createDataFrame([(i, p, "2024-01-01") for i, p in enumerate(ids)],
                                 "row int, outlet_id string, day string")


def _outlets(spark, *rows):
    own = surrogate_key("outlet", F.col("outlet_id"))
    return spark.createDataFrame(rows, "outlet_id string, other string").select(
        "outlet_id", F.coalesce("other", own).alias("outlet_key"))


def test_odd_ids_give_what_a_join_gives(spark):
    fact = _facts(spark, "a", "b", "b", "twice", "lost", None, "", "own", "twice")
    dim = _outlets(spark, ("a", None), ("b", None), ("twice", None), ("twice", "second"),
                   ("", None), (None, None), ("own", "key of its own"), ("unused", "x"))
    date = spark.createDataFrame([("2024-01-01", 1)], "date_day string, date_key int")
    want = facts.lookup(fact, dim, "outlet_id", "outlet_id", "outlet_key")
    got = facts._lookups(fact, date, "day", {"outlet": dim})
    columns = ["row", "outlet_id", "outlet_key"]
    assert sorted(got.select(columns).collect(), key=str) == sorted(
        want.select(columns).collect(), key=str)
    odd = facts.odd_ids(fact, {"outlet": dim}).collect()
    assert sorted((r["id"], r["key"]) for r in odd if r["id"] != "twice") == [
        ("lost", None), ("own", "key of its own")]


def test_facts_stay_where_they_are(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "20k")
    fact = spark.range(20_000).selectExpr("id as row", "cast(id as string) as outlet_id",
                                          "'2024-01-01' as day")
    dim = _outlets(spark, ("0", None)).union(spark.range(1, 20_000).select(
        F.col("id").cast("string").alias("outlet_id")).withColumn(
        "outlet_key", surrogate_key("outlet", F.col("outlet_id"))))
    date = spark.createDataFrame([("2024-01-01", 1)], "date_day string, date_key int")
    plan = facts._lookups(fact, date.limit(1), "day", {"outlet": dim})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"Exchange hashpartitioning\(\w*outlet_id", text)


def test_buckets_are_written_in_slices(spark, lake, monkeypatch):
    rows = spark.range(1000).selectExpr("cast(id as string) as id", "id * 2 as n")
    whole = lake.write_buckets(rows, "t", ["id"], 8, 1000)
    monkeypatch.setattr(layers, "SLICE_ROWS", 300)
    filters = []
    repartition = type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda df, *a: (
        filters.append(df.count()), repartition(df, *a))[1])
    sliced = lake.write_buckets(rows, "t", ["id"], 8, 1000)
    assert len(filters) == 4 and sum(filters) == 1000 and max(filters) < 500
    assert {b: n for b, (_, n) in sliced["lies"].items()} == {
        b: n for b, (_, n) in whole["lies"].items()}
    assert sorted(lake.read_entry(sliced).collect()) == sorted(rows.collect())
    dealt = lake.write_buckets(lake.read_entry(sliced), "t", ["id"], 8, 1000, dealt=True)
    assert len(filters) == 4 and dealt["rows"] == 1000 and sorted(dealt["lies"]) == sorted(
        sliced["lies"])


def test_groups_of_tests_run_one_after_the_other(spark):
    m = queries._stored_models(spark, SF)
    only = ["stg_product", "stg_sales_streaming", "fact_inventory"]
    together = quality.run_tests(m.ref, only).collect()
    apart = quality.run_tests(m.ref, only, apart=True)
    assert "LocalRelation" in apart._jdf.queryExecution().optimizedPlan().toString() or (
        "LogicalRDD" in apart._jdf.queryExecution().optimizedPlan().toString())
    assert sorted(map(str, apart.collect())) == sorted(map(str, together))


def test_facts_are_made_of_written_models(spark):
    for name in ("fact_sales", "stg_sales_unified"):
        files = queries.all_queries()[name](spark, SF).inputFiles()
        assert files and not any("lineitem" in f for f in files)


ODD_NUMBERS = ["7", "0", "07", "1.5", "-1", "+2", "1_0", " 3 ", "4\n", "1 2", "", None, "nan", "1e3",
               "x", ".5", "5.", "99999999999999999999", "٣"]


def test_a_plainly_valid_event_is_judged_as_by_all_rules(spark, monkeypatch):
    fields = {f: "1" for f in TRANSACTION_FIELDS} | {"invoice_id": "i", "product_id": "p"}
    sent = []
    for f in [*NUMERIC_FIELDS, "invoice_id"]:
        for x in ODD_NUMBERS:
            event = {"event_id": f"e{len(sent)}", "event_type": contract.EVENT_TYPE,
                     "event_timestamp": "2024-01-01T00:00:00+00:00", "source": "s",
                     "source_file": "f", "transaction": fields | {f: x}}
            sent.append((None, json.dumps(event).encode(), "t", 0, len(sent), None))
    events = [dict(json.loads(sent[0][1]), **c) for c in (
        {"event_id": "x" * 999}, {"event_type": "other"}, {"event_timestamp": "2024"},
        {"source": None}, {"source_file": "y" * 9999})]
    sent += [(None, json.dumps(e).encode(), "t", 1, i, None) for i, e in enumerate(events)]
    messages = spark.createDataFrame(sent, MESSAGE_SCHEMA)
    got = sorted(map(str, contract.validate(messages).collect()))
    assert contract._extract(contract.parse_messages(messages)).where(
        contract._plainly_valid()).count() >= len(NUMERIC_FIELDS)
    monkeypatch.setattr(contract, "_plainly_valid", lambda: F.lit(False))
    assert got == sorted(map(str, contract.validate(messages).collect()))
