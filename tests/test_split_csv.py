"""CSV files with line breaks inside quotes, split over tasks."""

import random

import pytest

from seed import SALE, SALES_HEADER, write_sales
from tallyloom.plans.ingest import ingest_sales
from tallyloom.schemas import FEEDS
from tallyloom.sources import files as f

FEED = FEEDS["sales"]


def whole(spark, folder):
    """Rows by Spark's own reader, each file in one piece."""
    found = [{**r.asDict(), "quoted_newlines": True, "record_starts": None}
             for r in f.fingerprint(spark, folder, "*.csv").collect()]
    return sorted(map(str, f.scan_csv(spark, found, FEED).drop("split_start").collect()))


def split(spark, folder):
    found = f.fingerprint(spark, folder, "*.csv").collect()
    rows = f.scan_csv(spark, found, FEED)
    return found, sorted(map(str, rows.drop("split_start").collect())), rows


def odd_cell(rng):
    return rng.choice(['plain', '""', '"a\nb"', '"x ""y"" z"', '"\r\n"', '"é, ü"', '', '"""q"""',
                       '"many\n\n\nlines, and commas"', 'Größe', '"",""'.split(",")[0], ' s '])


def odd_text(rng, rows, ends="\n"):
    out = [",".join(SALES_HEADER)]
    for i in range(rows):
        cells = [odd_cell(rng) for _ in SALES_HEADER]
        if rng.random() < 0.1:
            cells = cells[:rng.randrange(2, 10)]
        if rng.random() < 0.05:
            cells += ["more"]
        out.append(",".join(cells) + ("" if rng.random() < 0.95 else ends))
    return ends.join(out) + (ends if rng.random() < 0.5 else "")


@pytest.mark.parametrize("seed", range(3))
def test_split_files_have_the_rows_of_whole_ones(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(f, "SPLIT_BYTES", 700)
    rng = random.Random(seed)
    for name, ends in (("a", "\n"), ("b c+d", "\r\n")):
        (tmp_path / f"{name}.csv").write_bytes(odd_text(rng, 150, ends).encode())
    (tmp_path / "mark.csv").write_bytes(b"\xef\xbb\xbf" + odd_text(rng, 40).encode())
    found, got, rows = split(spark, str(tmp_path))
    assert all(r["record_starts"] and f._way(r) == "records" for r in found)
    assert got == whole(spark, str(tmp_path))
    assert rows.select("source_file", "split_start").distinct().count() > 20


def test_row_numbers_of_split_files(lake, tmp_path, monkeypatch):
    monkeypatch.setattr(f, "SPLIT_BYTES", 2000)
    rows = [{**SALE, "InvoiceID": f"I{i}" if i % 3 else f"I{i}\nline"} for i in range(800)]
    write_sales(tmp_path / "sales", "FactSales_1.csv", rows=rows)
    assert ingest_sales(lake, str(tmp_path / "sales")).first()["rows"] == 800
    got = {r["invoice_id"]: r["source_row_number"] for r in lake.read("raw", "sales").collect()}
    assert got == {r["InvoiceID"]: i for i, r in enumerate(rows, start=2)}


@pytest.mark.parametrize("stray", ['5" pipe', 'a"b"c', '"a"b', '"a" ,b'])
def test_stray_quotes_are_left_to_the_reader(spark, tmp_path, monkeypatch, stray):
    monkeypatch.setattr(f, "SPLIT_BYTES", 300)
    line = ",".join(["x"] * (len(SALES_HEADER) - 1))
    body = [",".join(SALES_HEADER)] + [f'"q\n{i}",{line}' for i in range(20)]
    body.insert(9, f"{stray},{line}")
    (tmp_path / "s.csv").write_text("\n".join(body))
    found, got, _ = split(spark, str(tmp_path))
    assert f._way(found[0]) == "whole"
    assert got == whole(spark, str(tmp_path))


def test_mixed_line_ends_are_left_to_the_reader(spark, tmp_path):
    head, line = ",".join(SALES_HEADER), ",".join(["x"] * (len(SALES_HEADER) - 1))
    (tmp_path / "s.csv").write_bytes(f'{head}\n"q\n1",{line}\r\n"q",{line}\n'.encode())
    found, got, _ = split(spark, str(tmp_path))
    assert f._way(found[0]) == "whole" and got == whole(spark, str(tmp_path))


def test_rows_of_files_are_counted_alike(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('h,i\n"x\ny",1\n\n2,3\n')
    (tmp_path / "b.csv").write_text("h,i\n1,2\n3,4\n5,6\n")
    counted = {r["source_name"]: r["rows"] for r in f.file_rows(spark, str(tmp_path)).collect()}
    assert counted == {"a.csv": 2, "b.csv": 3}


def test_a_header_without_end_is_none(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes(b'"' + b"x,\n" * 1_500_000)
    (tmp_path / "b.csv").write_bytes(b"x" * 3_000_000)
    rows = f.fingerprint(spark, str(tmp_path), "*.csv").collect()
    assert [r["header"] for r in rows] == [None, None]
    assert all(r["record_starts"] is None or not r["quoted_newlines"] for r in rows)
