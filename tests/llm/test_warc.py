import gzip
import hashlib
from pathlib import Path

from tallyforge.llm import warc
from tallyforge.llm.storage import new_path


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    big, other = "é" * 60, "x" * 99
    rows = [(5, "http://a/", big), (3, "http://b/\r\nX: y", big), (4, None, big), (7, "http://c/", other), (8, "http://c/", other), (1, "u", None), (2, "u", ""), (None, "u", big), (9, "u", "y" * 100_000), (3, "http://b/", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnsRenamed({}).selectExpr("*", "url AS digest", "1 AS length")
    folder = new_path(spark, "archives")
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(df, folder=folder).collect()), key=str)
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None and len(data) >= 100]
        first = min(same, default=page)
        expected.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if page == first else "revisit", None if page == first else first))
    assert got == sorted(expected, key=str)
    files = list(Path(folder.removeprefix("file://")).glob("*.warc.gz"))
    assert files and all(gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: ") for f in files)


def test_index_and_coalescing(spark):
    df = spark.createDataFrame([(i, f"http://h/{i}", "p" * (200 + i)) for i in range(50)], "page_id long, url string, html string")
    folder = new_path(spark, "archives")
    index = warc.write_archives(df, folder)
    assert {r["url"] for r in index.collect()} == {f"http://h/{i}" for i in range(50)}
    some = warc.read_records(index.where("url like '%7'"), folder).collect()
    assert sorted(int(r["page"]) for r in some) == [7, 17, 27, 37, 47] and all(len(r["payload"]) == 200 + int(r["page"]) for r in some)
    assert warc.coalesced([(0, 10), (10, 5), (100_000, 1), (100_010, 5)]) == [(0, 15, [0, 1]), (100_000, 15, [2, 3])]
    assert [m for _, _, m in warc.coalesced([(0, 5 << 20), (5 << 20, 5 << 20)])] == [[0], [1]]


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
