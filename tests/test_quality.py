"""Data tests, reconciliation and profiles on small made cases."""

import pytest

from tallyloom.operators import profiling, quality, reconcile, versioning
from tallyloom.operators.quality import NOT_NULL, RELATIONSHIPS, UNIQUE


def test_declared_tests_are_complete():
    assert sum(map(len, UNIQUE.values())) == 17
    assert sum(map(len, NOT_NULL.values())) == 57
    assert sum(map(len, RELATIONSHIPS.values())) == 15


def failures(df):
    return {r["column"]: r["failures"] for r in df.collect()}


def test_counts_of_failures(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, 3), (None, None)],
                               "k string, v int")
    assert failures(quality.unique_violations(df, ["k", "v"])) == {"k": 1, "v": 1}
    assert failures(quality.null_counts(df, ["k", "v"])) == {"k": 2, "v": 1}
    parents = spark.createDataFrame([("a",)], "id string")
    assert failures(quality.orphans(df, {"k": (parents, "id")})) == {"k": 1}
    assert quality.grain_violations(df, ["k"]).collect()[0]["row_count"] == 2
    empty = df.limit(0)
    assert failures(quality.null_counts(empty, ["k"])) == {"k": 0}
    assert failures(quality.unique_violations(empty, ["k"])) == {"k": 0}


def test_unknown_balance_is_no_failure(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', 1, 2, 3, 0, 0), ('b', 1, 2, 3, 1, 0),
        ('c', 1, 2, 3, NULL, 0) AS t(inventory_key, opening_stock, stock_received,
        units_sold, closing_stock, calculated_closing_stock)""")
    assert [r["inventory_key"] for r in quality.inventory_imbalance(df).collect()] == ["b"]


def test_count_mismatch(spark):
    a, b = spark.range(3), spark.range(4)
    assert quality.count_mismatch(a, a).count() == 0
    assert tuple(quality.count_mismatch(a, b).first()) == (3, 4)


@pytest.mark.parametrize("changed, message", [
    ({}, reconcile.ALL_WELL),
    ({"raw_sales": 2}, "Batch sales RAW and staging row counts do not match."),
    ({"staging_streaming_sales": 2, "warehouse_target": 0},
     "Streaming sales RAW and staging row counts do not match. "
     "Target row counts do not match."),
    ({"unified_sales": 9, "staging_inventory": 9},
     "Unified sales and warehouse row counts do not match. "
     "Inventory row counts do not match."),
])
def test_reconcile(spark, changed, message):
    counts = {name: 1 for name in reconcile.COUNTED} | changed
    df = spark.createDataFrame([counts], ", ".join(f"{c} bigint" for c in counts))
    row = reconcile.reconcile(df).first()
    assert row["validation_message"] == message
    assert row["validation_status"] == ("FAILED" if changed else "SUCCESS")
    report = {r["line"]: r for r in reconcile.count_report(df).collect()}
    assert len(report) == 6 and report["Batch Sales"]["raw_rows"] == counts["raw_sales"]


def test_null_finish_times_rank_differently(spark):
    runs = spark.sql("""SELECT r run_id, 'p' pipeline_name, 's' source_name, 'SUCCESS' status,
        'h' source_hash, 1L source_size_bytes, NULL::timestamp source_modified_at,
        NULL::timestamp started_at, f finished_at
        FROM VALUES (1L, timestamp'2026-01-01'), (2L, NULL),
                    (3L, timestamp'2025-01-01') AS t(r, f)""")
    assert versioning.latest_versions(runs).first()["run_id"] == 2
    assert versioning.seed_state(runs).first()["active_run_id"] == 1


def test_profiles(spark, tmp_path):
    from tallyloom.sources.files import file_rows, fingerprint
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text('y,x\n"1\n1",2\n')
    (tmp_path / "c.csv").write_text("x,y\n")
    rows = {r["source_name"]: r for r in profiling.profile_files(
        fingerprint(spark, str(tmp_path), "*.csv"), file_rows(spark, str(tmp_path))).collect()}
    assert [rows[n]["rows"] for n in ("a.csv", "b.csv", "c.csv")] == [2, 1, 0]
    assert [rows[n]["same_schema"] for n in ("a.csv", "b.csv", "c.csv")] == [True, False, True]
    assert rows["a.csv"]["column_count"] == 2 and rows["a.csv"]["size_mb"] == 0.0
    df = spark.createDataFrame([("a", None, 1), (None, None, None)], "x string, y string, z int")
    entity = profiling.profile_entity(df, "E").first()
    assert (entity["rows"], entity["column_count"], entity["fields"]) == (1, 2, "x, z")
