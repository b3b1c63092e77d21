"""The batch pipeline from files to facts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seed import SALE, SALES_HEADER, write_csv, write_master, write_sales
from tallyloom.operators.staging import accepted, rejects, stage
from tallyloom.plans.ingest import ingest_master, ingest_sales
from tallyloom.plans.jobs import (DataTestError, ReconciliationError, backfill_sources,
                                  build, check, ledger_faults,
                                  raw_sources, run_batch, stream_sync, validate_layers)
from tallyloom.plans.models import MARTS, Models
from tallyloom.sources.files import fingerprint, read_entity, read_sales_csv
from tallyloom.sources.layers import Lake
from tallyloom.sources.ledger import Ledger


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A lake after one batch run, and that run's audit row."""
    tmp = tmp_path_factory.mktemp("built")
    write_sales(tmp / "sales")
    write_master(tmp / "master")
    lake = Lake(spark, str(tmp / "lake"))
    return lake, run_batch(lake, str(tmp / "sales"), str(tmp / "master"), "r1").first()


def test_golden_rows(built):
    lake, audit = built
    assert audit["validation_status"] == "SUCCESS"
    counts = [audit[c] for c in audit.asDict() if c.endswith("_rows")]
    assert sorted(counts) == [0, 0] + [1] * 10
    day = lake.mart("dim_date").collect()
    assert len(day) == 1
    assert day[0].asDict() == dict(
        date_key=20250301, date_day=dt.date(2025, 3, 1), day_of_month=1, month_number=3,
        month_name="March", quarter_number=1, year=2025,
        month_start=dt.date(2025, 3, 1), year_month="2025-03", day_of_week_number=6,
        day_name="Saturday", is_month_start=True)
    assert lake.mart("dim_product").first()["product_key"] == "6f67f127d968dfbf6d1853a843cc42b5"
    assert (lake.mart("dim_distributor").first()["distributor_key"]
            == "7011e78a2ef92ea4ca7e56e49a1e6c0f")
    assert (lake.mart("dim_salesperson").first()["salesperson_key"]
            == "681933e8f120c3d8e7843586c7ce86b2")
    assert lake.mart("dim_outlet").first()["outlet_key"] == "4a1c677ea829978a8727d10e1a03348f"
    sale = lake.mart("fact_sales").first()
    assert sale["sales_key"] == "8cd415f1a457ec215aa30598966e1db3"
    assert sale["gross_profit"] == Decimal("3.60")
    assert sale["gross_margin_pct"] == Decimal("0.3333333333333333333")
    assert (sale["record_source"], sale["date_key"], sale["quantity"]) == (
        "batch", 20250301, 3)
    stock = lake.mart("fact_inventory").first()
    assert stock["inventory_key"] == "c796a7ef38e07f6ff71c1fe0e1db0c01"
    assert stock["calculated_closing_stock"] == 63
    goal = lake.mart("fact_sales_target").first()
    assert goal["sales_target_key"] == "be71051dd5ed66cf8dcc7c70f31babe1"
    assert (goal["target_sales"], goal["target_active_outlets"]) == (Decimal("640.00"), 4)
    assert lake.spark.table("stg_sales").count() == 1  # staging is registered as a view


def test_failed_data_test_names_it(built):
    lake, _ = built
    models = Models(raw_sources(lake))
    row = models.ref("stg_sales")
    models._built["stg_sales"] = row.unionByName(row.withColumn("quantity", F.lit(None).cast("int")))
    with pytest.raises(DataTestError) as error:
        check(models, ["stg_sales"])
    assert "stg_sales.not_null(quantity): 1" in str(error.value)
    assert "stg_sales.grain(): 1" in str(error.value)
    assert "stg_sales.unique(raw_record_id): 1" in str(error.value)


def test_audit_is_written_before_a_failure(built):
    lake, _ = built
    marts = {m: lake.mart(m) for m in MARTS}
    models = Models(raw_sources(lake), {**marts, "fact_inventory": marts["fact_inventory"].limit(0)})
    with pytest.raises(ReconciliationError, match="^Inventory row counts do not match.$"):
        validate_layers(lake, models, "sales_batch", "r9")
    row = lake.read("metadata", "pipeline_audit").filter("run_label = 'r9'").first()
    assert (row["validation_status"], row["warehouse_inventory_rows"]) == ("FAILED", 0)


def test_unknown_model_is_refused(lake):
    with pytest.raises(KeyError):
        build(lake, {}, ["fact_nothing"])


def test_same_content_is_skipped_and_old_versions_return(lake, tmp_path):
    sales = tmp_path / "sales"

    def load(quantity):
        write_sales(sales, rows=[{**SALE, "Quantity": quantity}])
        return ingest_sales(lake, str(sales)).first()

    first = load("2")
    assert (first["decision"], first["rows"]) == ("LOADED", 1)
    again = load("2")
    assert (again["decision"], again["run_id"]) == ("SKIPPED", first["run_id"])
    second = load("3")
    assert second["decision"] == "LOADED" and second["run_id"] != first["run_id"]
    assert raw_sales_quantities(lake) == ["3"]
    back = load("2")
    assert (back["decision"], back["run_id"]) == ("SKIPPED", first["run_id"])
    assert raw_sales_quantities(lake) == ["2"]
    assert lake.read("raw", "sales").count() == 2
    runs = Ledger(lake).runs().collect()
    assert all(r["status"] == "SUCCESS" and r["records_inserted"] == 1 for r in runs)
    assert all(r["finished_at"] >= r["started_at"] for r in runs)


def raw_sales_quantities(lake):
    from tallyloom.operators.versioning import current_raw
    rows = current_raw(lake.read("raw", "sales"), Ledger(lake).state(), "fact_sales_ingestion")
    return [r["quantity"] for r in rows.collect()]


def test_wrong_columns_stop_the_load_there(lake, tmp_path):
    sales = tmp_path / "sales"
    write_sales(sales, "FactSales_1.csv")
    write_csv(sales_file := sales / "FactSales_2.csv", [{"Date": "x", "Other": "y"}])
    write_sales(sales, "FactSales_3.csv", rows=[{**SALE, "InvoiceID": "I3"}])
    with pytest.raises(ValueError, match="Unexpected columns"):
        ingest_sales(lake, str(sales))
    ledger = Ledger(lake)
    status = {r["source_name"]: (r["status"], r["error_message"])
              for r in ledger.runs().collect()}
    assert status["FactSales_1.csv"] == ("SUCCESS", None)
    assert status["FactSales_2.csv"][0] == "FAILED"
    assert "'Other'" in status["FactSales_2.csv"][1]
    assert "FactSales_3.csv" not in status
    assert [r["source_name"] for r in ledger.state().collect()] == ["FactSales_1.csv"]
    write_sales(sales, sales_file.name, rows=[{**SALE, "InvoiceID": "I2"}])
    decisions = {r["source_name"]: r["decision"] for r in ingest_sales(lake, str(sales)).collect()}
    assert decisions == {"FactSales_1.csv": "SKIPPED", "FactSales_2.csv": "LOADED",
                         "FactSales_3.csv": "LOADED"}


def test_a_load_that_breaks_leaves_no_rows(lake, tmp_path, monkeypatch):
    import tallyloom.plans.ingest as ingest
    write_sales(tmp_path / "sales")
    monkeypatch.setattr(ingest, "number_rows", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest_sales(lake, str(tmp_path / "sales"))
    ledger = Ledger(lake)
    assert [r["status"] for r in ledger.runs().collect()] == ["FAILED"]
    assert ledger.state().count() == 0


def test_each_file_fails_alone(lake, tmp_path, monkeypatch):
    import tallyloom.plans.ingest as ingest
    for i in (1, 2, 3):
        write_sales(tmp_path / "sales", f"FactSales_{i}.csv", rows=[{**SALE, "InvoiceID": f"I{i}"}])
    real = ingest._scan

    def breaks(lake, files, feed):
        if any(f["source_name"] == "FactSales_2.csv" for f in files):
            raise RuntimeError("disk trouble")
        return real(lake, files, feed)

    monkeypatch.setattr(ingest, "_scan", breaks)
    with pytest.raises(RuntimeError, match="disk trouble"):
        ingest_sales(lake, str(tmp_path / "sales"))
    runs = {r["source_name"]: (r["status"], r["error_message"]) for r in Ledger(lake).runs().collect()}
    assert runs["FactSales_1.csv"] == ("SUCCESS", None)
    assert runs["FactSales_2.csv"] == ("FAILED", "disk trouble")
    assert runs["FactSales_3.csv"][0] == "FAILED" and "FactSales_2.csv" in runs["FactSales_3.csv"][1]
    assert [r["source_name"] for r in Ledger(lake).state().collect()] == ["FactSales_1.csv"]
    monkeypatch.setattr(ingest, "_scan", real)
    again = {r["source_name"]: r["decision"] for r in ingest_sales(lake, str(tmp_path / "sales")).collect()}
    assert again == {"FactSales_1.csv": "SKIPPED", "FactSales_2.csv": "LOADED",
                     "FactSales_3.csv": "LOADED"}


def test_references_to_unknown_runs_are_found(lake, tmp_path):
    write_sales(tmp_path / "sales")
    run = ingest_sales(lake, str(tmp_path / "sales")).first()["run_id"]
    assert ledger_faults(lake).collect() == []
    stray = lake.read("raw", "sales").withColumn("pipeline_run_id", F.lit(run + 7))
    lake.write_partitions(stray, "raw", "sales", "pipeline_run_id")
    Ledger(lake).set_active("master_data_ingestion", [("MasterData:DimOutlet", run + 9, "x")])
    assert sorted(map(tuple, ledger_faults(lake).collect())) == [
        ("sales", run + 7, 1), ("source_state", run + 9, 1)]


def test_no_files_is_an_error(lake, spark, tmp_path):
    (tmp_path / "sales").mkdir()
    (tmp_path / "sales" / "other.csv").write_text("a\n1\n")
    with pytest.raises(FileNotFoundError):
        ingest_sales(lake, str(tmp_path / "sales"))
    with pytest.raises(FileNotFoundError):
        read_sales_csv(spark, str(tmp_path / "sales"))


def test_csv_layouts_and_oddities(lake, spark, tmp_path):
    sales = tmp_path / "sales"
    write_sales(sales, "FactSales_A.csv")
    turned = list(reversed(SALES_HEADER))
    write_sales(sales, "FactSales_B.csv", rows=[{**SALE, "InvoiceID": "B1"}], header=turned)
    head = ", ".join(SALES_HEADER)
    (sales / "FactSales_C x.csv").write_text(
        "﻿" + head + '\n2026-09-01,"C ""1""\nline",D,S,O,P,1,,0,0,1,1,1,1\n\n'
        "2026-09-02,C2\n", encoding="utf-8")
    rows = {r["invoice_id"]: r for r in read_sales_csv(spark, str(sales)).collect()}
    assert set(rows) == {"R-25-31", "B1", 'C "1"\nline', "C2"}
    assert rows["B1"]["date"] == "2025-03-01" and rows["B1"]["total_cogs"] == "7.20"
    assert rows['C "1"\nline']["unit_price"] == ""  # an empty cell is kept as text
    assert rows["C2"]["quantity"] is None  # a cell the row lacks is NULL
    ingest_sales(lake, str(sales))
    loaded = lake.read("raw", "sales").filter("source_file like '%C x.csv'")
    assert sorted(r["source_row_number"] for r in loaded.collect()) == [2, 3]


def test_row_numbers_over_many_splits(lake, tmp_path, conf):
    rows = [{**SALE, "InvoiceID": f"I{i}"} for i in range(3000)]
    write_sales(tmp_path / "sales", "FactSales_big.csv", rows=rows)
    write_sales(tmp_path / "sales", "FactSales_small.csv", rows=rows[:7])
    conf("spark.sql.files.maxPartitionBytes", "20000")
    report = {r["source_name"]: r["rows"] for r in
              ingest_sales(lake, str(tmp_path / "sales")).collect()}
    assert report == {"FactSales_big.csv": 3000, "FactSales_small.csv": 7}
    landed = lake.read("landing", "sales")
    assert landed.select("source_file", "split_start").distinct().count() > 5
    raw = lake.read("raw", "sales").collect()
    for name, n in report.items():
        got = {r["invoice_id"]: r["source_row_number"] for r in raw if r["source_file"] == name}
        assert got == {f"I{i}": i + 2 for i in range(n)}
    assert len({r["raw_record_id"] for r in raw}) == 3007


def test_entity_from_csv_and_parquet(spark, lake, tmp_path):
    write_master(tmp_path / "m")
    path = tmp_path / "m" / "DimProduct.csv"
    path.write_text(path.read_text() + ",,,,,,,\nP002,Food,,Name,,,1.5,\n")
    rows = read_entity(spark, str(path), "DimProduct").collect()
    assert [(r["product_id"], r["brand"]) for r in rows] == [("HONEY-9", "Meadow"), ("P002", None)]
    spark.sql("""SELECT timestamp_ntz'2026-09-01 00:00:00' ` MonthStart`, 'SP1' SalespersonID,
        12345678.5D TargetSales, 3.0D TargetActiveOutlets
        UNION ALL SELECT NULL, NULL, NULL, NULL""").coalesce(1).write.parquet(
        str(tmp_path / "FactTarget.parquet"))
    typed = read_entity(spark, str(tmp_path / "FactTarget.parquet"), "FactTarget")
    row = stage(typed, "target").collect()
    assert len(row) == 1
    assert row[0]["month_start"] == dt.date(2026, 9, 1)
    assert (row[0]["target_sales"], row[0]["target_active_outlets"]) == (
        Decimal("12345678.50"), 3)
    assert typed.first()["month_start"] == "2026-09-01T00:00:00"
    spark.sql("""SELECT 1001.0D ProductID, 'Tea' Category, 'B' Brand, 'N' ProductName,
        -0.5D Variant, 12.0D PackSize, 0.125D UnitPrice, 100.0D UnitCOGS""").coalesce(1).write.parquet(
        str(tmp_path / "DimProduct.parquet"))
    cells = read_entity(spark, str(tmp_path / "DimProduct.parquet"), "DimProduct").first()
    assert [cells[c] for c in ("product_id", "variant", "pack_size", "unit_price", "unit_cogs")
            ] == ["1001", "-0.5", "12", "0.125", "100"]
    ingest_master(lake, str(tmp_path / "m"), entities=["DimProduct"])
    numbers = lake.read("raw", "product").orderBy("product_id").collect()
    assert [r["source_row_number"] for r in numbers] == [2, 3]  # counted without empty rows
    assert numbers[0]["source_sheet"] == "DimProduct"


def test_floats_keep_every_digit(spark):
    from tallyloom.sources.files import _plain_number

    values = [0.0, -0.0, 1.0, 100.0, 0.1, 1e-7, 1.5e-10, 1e28, 1.2345e300, 123456789.125,
              -2.5e-5, 9007199254740993.0, 0.30000000000000004, 5e-324, 1e7, 12345678.9]
    text = F.col("x").cast("string")
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", _plain_number(text).alias("t")).collect():
        assert float(r["t"]) == r["x"] and "E" not in r["t"] and not r["t"].endswith(".0")
    odd = spark.sql("SELECT double('NaN') x UNION ALL SELECT double('-Infinity')")
    assert {r["t"] for r in odd.select(_plain_number(text).alias("t")).collect()} == {
        "NaN", "-Infinity"}


def test_fingerprint(spark, tmp_path):
    import hashlib
    write_sales(tmp_path / "f", "FactSales_1.csv")
    data = (tmp_path / "f" / "FactSales_1.csv").read_bytes()
    (tmp_path / "f" / "big.bin").write_bytes(b"\x00\x01" * 3_000_000)
    rows = {r["source_name"]: r for r in fingerprint(spark, str(tmp_path / "f")).collect()}
    one = rows["FactSales_1.csv"]
    assert one["sha256"] == hashlib.sha256(data).hexdigest()
    assert one["size_bytes"] == len(data) and one["header"] == SALES_HEADER
    assert rows["big.bin"]["sha256"] == hashlib.sha256(b"\x00\x01" * 3_000_000).hexdigest()
    assert rows["big.bin"]["header"] is None


def test_backfill(lake, spark):
    ledger = Ledger(lake)
    files = [dict(source_name=n, sha256=None, size_bytes=None, modified_at=None)
             for n in ("a.csv", "gone.csv")]
    ids = ledger.start("fact_sales_ingestion", files)
    ledger.complete({i: 5 for i in ids.values()})
    found = spark.sql("SELECT 'fact_sales_ingestion' pipeline_name, 'a.csv' source_name, "
                      "'abc' sha256, 12L size_bytes, timestamp'2026-01-01' modified_at "
                      "UNION ALL SELECT 'other', 'gone.csv', 'x', 1L, NULL")
    report = {r["source_name"]: r["decision"] for r in ledger.backfill(found).collect()}
    assert report == {"a.csv": "UPDATE", "gone.csv": "SKIP"}
    runs = {r["source_name"]: r for r in ledger.runs().collect()}
    assert (runs["a.csv"]["source_hash"], runs["a.csv"]["status"]) == ("abc", "SUCCESS")
    assert runs["gone.csv"]["source_hash"] is None
    assert {r["source_name"] for r in ledger.backfill(found).collect()} == {"gone.csv"}
    state = {r["source_name"]: r["active_run_id"] for r in ledger.seed().collect()}
    assert state == {"a.csv": ids["a.csv"]}
    ledger.set_active("fact_sales_ingestion", [("a.csv", 99, "old"), ("b.csv", 98, "b")])
    state = {r["source_name"]: r["active_run_id"] for r in ledger.seed().collect()}
    assert state == {"a.csv": ids["a.csv"], "b.csv": 98}  # b has no run to seed from


def test_backfill_job_finds_each_pipelines_files(lake, tmp_path):
    write_sales(tmp_path / "sales", "FactSales_1.csv")
    write_master(tmp_path / "master")
    ledger = Ledger(lake)
    blank = dict(sha256=None, size_bytes=None, modified_at=None)
    ids = ledger.start("fact_sales_ingestion", [
        {"source_name": n, **blank} for n in ("FactSales_1.csv", "FactSales_2.csv")])
    ids |= ledger.start("master_data_ingestion", [{"source_name": "MasterData:DimOutlet", **blank}])
    ledger.complete({i: 1 for i in ids.values()})
    report = backfill_sources(lake, str(tmp_path / "sales"), str(tmp_path / "master")).collect()
    assert [(r["source_name"], r["decision"]) for r in report] == [
        ("FactSales_1.csv", "UPDATE"), ("FactSales_2.csv", "SKIP"),
        ("MasterData:DimOutlet", "UPDATE")]
    hashes = {r["source_name"]: r["source_hash"] for r in ledger.runs().collect()}
    assert hashes["FactSales_1.csv"] and hashes["MasterData:DimOutlet"]
    assert hashes["FactSales_2.csv"] is None


def test_strict_and_tolerant_staging(spark):
    raw = spark.createDataFrame(
        [("2026-09-01", " D ", "\t", "2", "1.005"), ("2026-09-01", " ", "S", "2.7", "1"),
         ("junk", "D", "S", "1", "1")],
        "date string, distributor_id string, salesperson_id string, quantity string, "
        "unit_price string")
    for c in ("outlet_id", "product_id", "invoice_id", "discount_pct", "discount_amount",
              "gross_sales", "net_sales", "unit_cogs", "total_cogs"):
        raw = raw.withColumn(c, raw["unit_price"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw, "sales").collect()
    bad = sorted(tuple(r["bad_columns"]) for r in rejects(raw, "sales").collect())
    assert bad == [("date",), ("quantity",)]
    good = accepted(raw, "sales").collect()
    assert len(good) == 1
    assert good[0]["distributor_id"] == "D" and good[0]["salesperson_id"] == "\t"
    assert good[0]["unit_price"] == Decimal("1.01")  # half away from zero


def test_rounding_integers(spark):
    raw = spark.createDataFrame([("2026-09-01T10:00:00", "S", "1", v) for v in (
        "2.5", "-2.5", "2.4", "1e2")],
        "month_start string, salesperson_id string, target_sales string, "
        "target_active_outlets string")
    got = [r["target_active_outlets"] for r in stage(raw, "target").collect()]
    assert got == [3, -3, 2, 100]


def test_stream_sync_keeps_other_marts(built):
    lake, _ = built
    audit = stream_sync(lake, "s1").first()
    assert (audit["pipeline"], audit["validation_status"]) == ("stream_sync", "SUCCESS")
    before = lake.snapshot().models
    stream_sync(lake, "s2", full=True)
    after = lake.snapshot().models
    assert after["fact_sales"] != before["fact_sales"]
    assert after["dim_date"] == before["dim_date"]
