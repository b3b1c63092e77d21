import hashlib
import io
import zipfile

import pytest
from pyarrow import fs

from tallyloom.llm import archives as a


@pytest.mark.parametrize("wide", [False, True])
def test_packages_are_plain_zip_files(wide):
    out = io.BytesIO()
    w = a.PackageWriter(out, wide)
    blocks = [b"first", b"", b"third" * 1000]
    w.begin(a.DATA)
    places = [(w.add(b), len(b)) for b in blocks]
    w.finish()
    w.begin(a.INDEX)
    w.add(b"x y")
    w.finish()
    w.close()
    data = out.getvalue()
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.namelist() == [a.DATA, a.INDEX]
    assert z.read(a.DATA) == b"".join(blocks)
    r = a.PackageReader(io.BytesIO(data), len(data))
    begin = r.begin_of(a.DATA)
    assert [r._range(begin + at, n) for at, n in places] == blocks
    assert (a.END64 in data) == wide


def test_reads_packages_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        record = a.warc_record(3, "http://x/é", b"<html>", "d" * 64, None, False)
        z.writestr(a.DATA, record)
        z.writestr(a.INDEX, f"0 {len(record)}\n")
        z.writestr("packed", b"a" * 100, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"holds PK\x05\x06 itself, and more text than an end record has"
    data = out.getvalue()
    r = a.PackageReader(io.BytesIO(data), len(data))
    (found,) = r.records()
    assert (found["page_id"], found["payload"], found["url"]) == (3, b"<html>", "http://x/é")
    with pytest.raises(ValueError):
        r.begin_of("packed")
    with pytest.raises(ValueError):
        a.PackageReader(io.BytesIO(b"no zip"), 6)


def test_round_trip(spark, tmp_path):
    same, short = "é" * 60, "s" * 99
    rows = [(7, "u7", same, 1), (3, "u3", same, 1), (5, None, short, 1), (4, "u\n4", short, 1),
            (9, "u9", None, 1), (None, "n", same, 1), (3, "u3b", same, 1), (1, "big", "z" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    folder = f"file://{tmp_path}/p"
    manifest = a.write_packages(pages.repartition(3), folder, package_bytes=200)
    got = a.read_packages(manifest, folder).collect()
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        to = 3 if html == same and page != 3 else None
        want.append((str(page), len(data), hashlib.sha256(data).hexdigest(),
                     "response" if to is None else "revisit", to,
                     data if to is None else b""))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                   bytes(r.payload)) for r in got) == sorted(want)
    store, root = fs.FileSystem.from_uri(folder)
    assert len(store.get_file_info(fs.FileSelector(root))) > 3
    none = a.write_packages(pages.where("false"), folder)
    assert none.collect() == [] and a.read_packages(none, folder).collect() == []
