"""ZIP packages of WARC records against the standard library and a direct computation."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pytest

from cairn.llm.common import work_path
from cairn.llm.warc_zip import (ByteSource, FileSource, PackageReader, archived_pages, parse_record, read_archives,
                                warc_record, write_archives, write_package)


@pytest.mark.parametrize("zip64", [False, True])
def test_package_is_a_zip_file(zip64, tmp_path):
    members = [("a.txt", b"hello"), ("dir/b.bin", bytes(range(256)) * 50), ("empty", b"")]
    with zipfile.ZipFile(io.BytesIO(write_package(members, zip64))) as z:
        assert z.testzip() is None
        assert [(n, z.read(n)) for n in z.namelist()] == members
    data = write_package(members, zip64, comment=b"a PK\5\6 mark in the comment, then more text")
    (tmp_path / "x.zip").write_bytes(data)
    for source in (ByteSource(data), FileSource(str(tmp_path / "x.zip"))):
        reader = PackageReader(source)
        for name, body in members:
            at, size = reader.place(name)
            assert source.read(at, size) == body
        source.close()


def test_reads_packages_of_the_standard_library():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("m"), "w", force_zip64=True) as f:
            f.write(b"stored member")
        z.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
    reader = PackageReader(ByteSource(out.getvalue()))
    at, size = reader.place("m")
    assert reader.source.read(at, size) == b"stored member"
    with pytest.raises(ValueError):
        reader.place("packed")
    with pytest.raises(ValueError):
        PackageReader(ByteSource(b"no package" * 30))


def test_record_round_trip():
    fields, http, payload = parse_record(warc_record(7, "http://a/b", b"x\r\n\r\ny", 6, "d", None))
    assert (fields["WARC-Type"], fields["WARC-Page-Key"], http["Content-Length"], payload) == ("response", "7", "6", b"x\r\n\r\ny")
    fields, http, payload = parse_record(warc_record(8, "u", b"", 6, "d", 7))
    assert (fields["WARC-Type"], fields["WARC-Refers-To-Page-Key"], http["Content-Length"], payload) == ("revisit", "7", "6", b"")


ROWS = [(5, "http://x/1", "A" * 100), (3, "u\r\nInjected: 1", "A" * 100), (9, None, "A" * 100), (3, "again", "A" * 100),
        (1, "s", "A" * 99), (2, "s", "A" * 99), (4, "n", None), (6, "e", ""), (7, "é", "é" * 50), (8, "é", "é" * 50),
        (10, "long", "<p>" * 100_000), (None, "none", "A" * 100), (-2, "neg", "é" * 50)]


def brute(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = p is not None and len(raw) >= 100 and first[h or ""] < p
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                    first[h or ""] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_archived_pages(spark, rows):
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, size int, digest string")
    assert sorted(map(tuple, archived_pages(pages).collect()), key=str) == brute(rows)


def test_small_packages_and_bytes_in_memory(spark, monkeypatch):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = work_path(spark, "warc")
    write_archives(pages, path, package_bytes=300)
    want = brute(ROWS)
    assert sorted(map(tuple, read_archives(spark, path).collect()), key=str) == want
    import cairn.llm.warc_zip as wz

    held = wz.read_blobs
    monkeypatch.setattr(wz, "read_blobs", lambda s, p: held(s, p.removeprefix("store:")))
    assert sorted(map(tuple, read_archives(spark, "store:" + path).collect()), key=str) == want
