"""Packages: an exact round trip, and the directory reader against the standard library."""

from __future__ import annotations

import hashlib
import io
import time
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from stratalith.llm import warc_zip

LONG, OTHER = "<p>é long</p>" * 100, "x" * 1000
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (7, "http://a/7", LONG), (3, None, None), (4, "http://a/\r\n4", ""), (5, "u", "short"), (6, "u", "short"),
    (8, "u", OTHER), (9, "u", OTHER[:-1]), (10, "u", OTHER[:-1]), (None, "u", LONG), (None, "u", "nobody" * 200), (None, "v", "nobody" * 200), (7, "again", LONG), (-5, "u", "\0\r\n\r\nWARC/1.1" * 100),
]


def expected(rows):
    out = []
    for page, url, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        refers = max(same) if len(payload) >= 1000 and same and page != max(same) else None
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc_zip, "RUN_BYTES", 700)
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3).withColumns({"digest": F.lit("clash"), "chief": F.lit(1)})
    folder, names = warc_zip.write_packages(df)
    found = [tuple(r) for r in warc_zip.read_packages(spark, folder, names).drop("url").collect()]
    assert sorted(found, key=repr) == expected(ROWS)
    packages = [zipfile.ZipFile(f"{folder}/{n}".removeprefix("file://")) for n in names]
    assert all(p.testzip() is None and p.namelist() == [warc_zip.DATA, warc_zip.INDEX] for p in packages)
    assert sum(len(p.read(warc_zip.INDEX).splitlines()) for p in packages) == len(ROWS)


def test_a_payload_in_a_third_of_the_pages(spark, monkeypatch):
    """Its pages are spread over the tasks and packages; each but one is a revisit. A payload of more than a million bytes is kept whole."""
    rows = [(k, f"http://h/{k}", LONG if k % 3 == 0 else f"page {k} " * 120) for k in range(1200)] + [(5000, "http://h/long", "é" * 1_200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        folder, names = warc_zip.write_packages(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = warc_zip.read_packages(spark, folder, names).drop("url").collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected(rows)
    revisits = [r for r in found if r.record_type == "revisit"]
    assert len(revisits) == 399 and {r.refers_to for r in revisits} == {1197}
    each = [sum(b"revisit" in warc_zip.record_at(memoryview(data), x["offset"], x["length"]) for x in package.index())
            for package in (warc_zip.Package(f"{folder}/{n}") for n in names)
            for data in [package.read(package.members[warc_zip.DATA].size, warc_zip.place_of(package.read, package.members[warc_zip.DATA]))]]
    assert max(each) < 300


def test_records_are_cut_by_the_index_in_linear_time():
    """Each record is one slice of its length; what follows is not copied for it."""
    def seconds(n):
        pieces = [zlib.compress(b"record %d " % k * 20, 6, 31) for k in range(n)]
        data, at = memoryview(b"".join(pieces)), 0
        began = time.process_time()
        for piece in pieces:
            warc_zip.record_at(data, at, len(piece))
            at += len(piece)
        return time.process_time() - began

    assert seconds(40_000) < 12 * seconds(5_000) + 0.2
    with pytest.raises(ValueError, match="index"):
        whole = zlib.compress(b"x" * 100, 6, 31)
        warc_zip.record_at(memoryview(whole + whole), 0, 2 * len(whole))


def test_no_pages(spark):
    assert warc_zip.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("comment", [b"", b"a comment PK\5\6 with a signature" + b"." * 30])
def test_directory(monkeypatch, wide, comment):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    made = io.BytesIO(b"something before")
    made.seek(0, 2)
    with zipfile.ZipFile(made, "a") as out:
        out.comment = comment
        for k in range(5):
            with out.open(zipfile.ZipInfo(f"m{k}é.txt"), "w", force_zip64=wide) as member:
                member.write(b"%d" % k * 60)
    data = made.getvalue()
    read = lambda n, at: data[at : at + n]
    members = warc_zip.directory(read, len(data))
    assert [m.name for m in members] == [f"m{k}é.txt" for k in range(5)]
    for k, m in enumerate(members):
        at = warc_zip.place_of(read, m)
        assert data[at : at + m.size] == b"%d" % k * 60
    assert (b"PK\6\6" in data) == wide


def test_what_cannot_be_read():
    with pytest.raises(ValueError):
        warc_zip.directory(lambda n, at: (b"no zip" * 50)[at : at + n], 300)
    with pytest.raises(ValueError):
        warc_zip.place_of(None, warc_zip.Member("x", 8, 0, 1, 1))
