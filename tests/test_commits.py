"""Versions, snapshots, expiry, ids and streams with several writers."""

import json
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from test_contract import event
from tallyloom.plans import ingest
from tallyloom.plans.ingest import recover_loads
from tallyloom.plans.jobs import build
from tallyloom.plans.models import MARTS, STAGING, ready
from tallyloom.schemas import MESSAGE_SCHEMA
from tallyloom.sources.commits import CommitLog, Conflict
from tallyloom.sources.ledger import Ledger
from tallyloom.streaming import index as index_module
from tallyloom.streaming.contract import validate
from tallyloom.streaming.index import EventIndex
from tallyloom.streaming.sink import raw_events, store_batch, stream_batches, sweep_events


def test_one_writer_makes_a_version(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {})
    assert log.try_commit(1, {"a": 1}) and not log.try_commit(1, {"a": 2})
    assert log.latest() == (1, {"a": 1})
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: log.update(lambda d: {"a": d["a"] + 1}), range(40)))
    assert log.latest() == (41, {"a": 41})


def test_old_versions_go_and_a_late_writer_does_not_bring_them_back(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    for i in range(1, 21):
        assert log.try_commit(i, {"i": i})
    log.drop_before(15)
    assert log.versions() == list(range(15, 21)) and log.latest() == (20, {"i": 20})
    assert not log.try_commit(6, {"i": -1})  # it has slept since version 5
    assert log.latest() == (20, {"i": 20}) and log.versions()[0] == 15
    (tmp_path / "log" / "_last").write_text("3")  # a hint that is out of date
    assert log.latest() == (20, {"i": 20})


def source_rows(spark, n=5):
    return spark.range(n).selectExpr("id", "id * 2 AS twice")


def test_a_broken_build_leaves_the_snapshot_whole(spark, lake, monkeypatch):
    from tallyloom import bindings as b
    from tallyloom.plans.models import Models
    from conftest import SF

    sources = b.sources(b.Tables(spark, SF))
    chosen = ["stg_product", "stg_distributor", "dim_product", "dim_distributor"]
    build(lake, sources, chosen)
    before = lake.snapshot()
    pinned = {m: before.table(m).count() for m in chosen}
    real = Models.ref

    def breaks(self, name):
        df = real(self, name)
        return df.select(F.raise_error(F.lit("lost"))) if name == "dim_distributor" else df

    monkeypatch.setattr(Models, "ref", breaks)
    half = {**sources, "product": lambda: sources["product"]().limit(3)}
    with pytest.raises(Exception, match="lost"):
        build(lake, half, chosen)  # staging and one dimension are written by then
    after = lake.snapshot()
    assert after.version == before.version and after.document == before.document
    assert {m: lake.mart(m).count() for m in chosen} == pinned
    monkeypatch.setattr(Models, "ref", real)
    build(lake, half, chosen)
    assert lake.mart("dim_product").count() == 3
    # who has taken the snapshot before still sees it as it was
    assert {m: before.table(m).count() for m in chosen} == pinned
    assert lake.snapshot().rows()["product"] == 3


def test_expiry_spares_pinned_and_young_builds(spark, lake):
    for n in (1, 2, 3, 4):
        lake.publish(source_rows(spark, n), "t")
        if n == 2:
            lake.pin(lake.snapshot(), "report")
    lake.write_model(source_rows(spark, 9), "t")  # nobody has committed it
    assert lake.expire(spare_seconds=3600) == []
    held = lake.snapshot(2)
    assert len(lake.expire(spare_seconds=0)) == 3  # of 1 and 3, and the stray one
    assert held.table("t").count() == 2 and lake.mart("t").count() == 4
    lake.unpin("report")
    assert len(lake.expire(spare_seconds=0)) == 1
    assert lake.mart("t").count() == 4 and lake.snapshot().version == 4
    with pytest.raises(Exception):
        held.table("t").count()


def test_a_commit_on_an_old_base_is_refused(spark, lake):
    base = lake.commit({"t": lake.write_model(source_rows(spark), "t"),
                        "u": lake.write_model(source_rows(spark), "u")})
    lake.publish(source_rows(spark, 2), "t")
    with pytest.raises(Conflict):
        lake.commit({"t": lake.write_model(source_rows(spark, 3), "t")}, base)
    lake.commit({"u": lake.write_model(source_rows(spark, 3), "u")}, base)
    assert (lake.mart("t").count(), lake.mart("u").count()) == (2, 3)


def test_buckets_hold_their_keys(spark, lake):
    entry = lake.write_buckets(source_rows(spark, 500), "t", ["id"], 8)
    assert entry["rows"] == 500 and len(entry["lies"]) == 8
    some = lake.read_entry(entry, [3])
    assert some.count() == entry["lies"]["3"][1] and len(some.inputFiles()) == 1
    assert lake.read_entry(entry).agg(F.sum("id")).first()[0] == 499 * 250


def test_models_wait_for_what_they_read():
    left, done, order = STAGING + MARTS, set(), []
    while left:
        able = ready(left, done)
        order.append(able)
        done |= set(able)
        left = [m for m in left if m not in able]
    place = {m: i for i, level in enumerate(order) for m in level}
    assert set(place) == set(STAGING + MARTS) and len(order) == 3
    assert place["stg_sales_unified"] == place["dim_date"] == 1 and place["fact_sales"] == 2
    assert order[0][0] == "stg_sales_streaming"
    assert ready(["dim_date"], set(STAGING) - {"stg_outlet"}, [("stg_outlet", "x")]) == []


def test_loads_at_once_take_different_ids(lake):
    files = [dict(source_name=f"f{i}", sha256="x", size_bytes=1, modified_at=None)
             for i in range(3)]
    with ThreadPoolExecutor(4) as pool:
        taken = list(pool.map(lambda _: Ledger(lake).start("p", files), range(4)))
    ids = sorted(i for t in taken for i in t.values())
    assert ids == list(range(1, 13))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: Ledger(lake).set_active("p", [(f"s{i}", i, "h")]), range(4)))
    assert sorted(r["seq"] for r in Ledger(lake).state_log().collect()) == [1, 2, 3, 4]


def test_loads_at_once_do_not_touch_each_other(lake, tmp_path):
    from seed import SALE, write_sales

    def load(i):
        folder = tmp_path / f"sales{i}"
        write_sales(folder, f"FactSales_{i}.csv",
                    rows=[{**SALE, "InvoiceID": f"I{i}-{k}"} for k in range(20)])
        return ingest.ingest_sales(lake, str(folder)).first()["rows"]

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(load, range(3))) == [20, 20, 20]
    raw = lake.read("raw", "sales")
    assert raw.select("invoice_id").distinct().count() == raw.count() == 60
    assert raw.select("raw_record_id").distinct().count() == 60


def test_a_load_that_vanished_is_given_up(lake, tmp_path, monkeypatch):
    from seed import write_sales

    class Gone(BaseException):
        pass

    def vanish(self, rows):
        raise Gone

    write_sales(tmp_path / "sales")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "complete", vanish)
        with pytest.raises(Gone):
            ingest.ingest_sales(lake, str(tmp_path / "sales"))
    assert lake.read("raw", "sales").count() == 1  # written, never active
    assert recover_loads(lake, 3600) == []
    time.sleep(1)
    assert recover_loads(lake, 0) == [1]
    run = Ledger(lake).runs().first()
    assert run["status"] == "FAILED" and "abandoned" in run["error_message"]
    assert not lake.store.names("raw/sales").keys() & {"pipeline_run_id=1"}
    assert ingest.ingest_sales(lake, str(tmp_path / "sales")).first()["run_id"] == 2


def checked(spark, ids, start=0):
    rows = [(b"k", json.dumps(event({"event_id": i})).encode(), "t", 0, start + k, None)
            for k, i in enumerate(ids)]
    return validate(spark.createDataFrame(rows, MESSAGE_SCHEMA))


def test_two_streams_at_once_store_each_event_once(spark, lake, monkeypatch):
    ids = [f"e{i}" for i in range(40)]
    real, raced = EventIndex.add, []

    def add(self, *args):
        """Before the first stream commits, the second one stores half of the events."""
        if not raced:
            raced.append(True)
            store_batch(lake, checked(spark, ids[::2], 1000), "second", 0, "g")
        return real(self, *args)

    monkeypatch.setattr(EventIndex, "add", add)
    store_batch(lake, checked(spark, ids), "first", 0, "g")
    rows = raw_events(lake).groupBy("stream_id").agg(F.collect_set("event_id").alias("ids")).collect()
    got = {r["stream_id"]: set(r["ids"]) for r in rows}
    assert got == {"second": set(ids[::2]), "first": set(ids[1::2])}
    assert raw_events(lake).count() == 40
    counts = {r["stream_id"]: (r["inserted"], r["duplicates"])
              for r in stream_batches(lake).collect()}
    assert counts == {"second": (20, 0), "first": (20, 20)}


def test_a_batch_that_broke_before_its_commit_is_not_seen(spark, lake, monkeypatch):
    def crash(self, *args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(EventIndex, "add", crash)
        with pytest.raises(KeyboardInterrupt):
            store_batch(lake, checked(spark, ["a", "b"]), "s", 0, "g")
    assert raw_events(lake).count() == 0
    store_batch(lake, checked(spark, ["b", "c"], 10), "other", 0, "g")
    store_batch(lake, checked(spark, ["a", "b"]), "s", 0, "g")  # the batch again
    assert sorted(r["event_id"] for r in raw_events(lake).collect()) == ["a", "b", "c"]


def test_what_was_never_committed_is_swept(spark, lake, monkeypatch):
    store_batch(lake, checked(spark, ["a"]), "s", 0, "g")
    with monkeypatch.context() as m:
        m.setattr(EventIndex, "add", lambda self, *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store_batch(lake, checked(spark, ["b"], 5), "s", 1, "g")
    assert sweep_events(lake, 3600) == []
    gone = sweep_events(lake, 0)
    assert len(gone) == 2 and any(f.endswith("stream_id=s/batch_id=1") for f in gone)
    assert [r["event_id"] for r in raw_events(lake).collect()] == ["a"]
    store_batch(lake, checked(spark, ["a", "b"], 5), "s", 1, "g")
    assert sorted(r["event_id"] for r in raw_events(lake).collect()) == ["a", "b"]


def test_lookups_open_few_files_however_many_batches_there_were(spark, lake, monkeypatch):
    """What a lookup opens depends on the levels only."""
    monkeypatch.setattr(index_module, "SLOT_ROWS", 64)
    monkeypatch.setattr(index_module, "FAN", 4)
    index = EventIndex(lake)
    opened, most = [], 0
    wanted = spark.range(3).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    wanted = wanted.select(F.xxhash64("key").alias("h"), "key")
    for i in range(100):
        keys = spark.range(i * 10, i * 10 + 10).select(
            F.concat(F.lit("k"), F.col("id")).alias("key"))
        version, document = index.log.latest()
        run = index.write(keys.select(F.xxhash64("key").alias("h"), "key"), 10)
        assert index.add(version, document, run, "s", i)
        runs = index.merge()
        most = max(most, runs)
        if i % 10 == 9:
            known = index.known(index.runs(index.log.latest()[1]), wanted)
            opened.append(len(known.inputFiles()))
            assert known.distinct().join(wanted, "key", "left_semi").count() == 3
    assert most <= 4 * 4 and max(opened) <= 3 * most
    assert max(opened[5:]) <= max(opened[:5]) + 6
    total = index.read(index.runs(index.log.latest()[1]))
    assert total.count() == total.distinct().count() == 1000
