"""WARC archives with an index first.

Each task writes its records to archives of its own (a gzip member a record, so any record can be read alone) and returns
an index row for each: archive, offset, length, URL and digest. The index is written as a table before anything is read. Reading starts from
a selection of index rows: those of an archive are sorted by offset, ranges that lie close are coalesced into one read, and the records
are cut out of it. Payloads of LEAST_REVISIT bytes or more that occur again are written once, as the response of the page with the smallest
id; the other pages get revisit records.

A task that is run again writes new files, and only the index that Spark commits names files, so lost executors leave no wrong records.

Edge cases: a null payload is empty and a null URL is an empty target; rows that repeat the smallest id of a payload are all responses; null ids are kept
(they revisit if another page has an id, else they are responses); control characters in a URL are percent-encoded in the record; any length of payload is
written whole; empty tables give an empty result. Other columns are never read.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import new_path, written

LEAST_REVISIT = 100
#: Bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Ranges with at most this gap are read together, up to the larger number of bytes.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Compressed bytes that a reading task is given, about; an archive is read by one task.
TASK_BYTES = 16 << 20
#: Most repeated digests (about 100 bytes each) that are broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def record(page: str | None, url: str, digest: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record; a revisit's block has the HTTP head only."""
    name = lambda p: f"<urn:page:{quote(p, safe='')}>" if p is not None else "<urn:page>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {name(page)}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {_CONTROL.sub(lambda m: quote(m.group()), url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload (empty for a revisit) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    _, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, payload


def _page(name: str | None) -> str | None:
    return unquote(name[10:-1]) if name and name.startswith("<urn:page:") else None


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page, url, digest, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "digest", "html", "refers")), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    data = gzip.compress(record(page, url, digest, html.encode(), refers), 4, mtime=0)
                    out.write(data)
                    rows.append((name, at, len(data), url, digest, page))
                    at += len(data)
                cols = list(zip(*rows, strict=True)) or [()] * 6
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["archive", "offset", "length", "url", "digest", "page"])
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows' records below ``folder`` and return the written index (archive, offset, length, url, digest, page); page is the id as text."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    base = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    first = base.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    first = written(first, "repeated")
    if first.count() <= BROADCAST_ROWS:
        first = F.broadcast(first)
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id")), F.col("first")).cast("string")
    rows = base.join(first, "digest", "left").select(F.col("id").cast("string").alias("page"), "url", "digest", "html", refers.alias("refers"))
    return written(rows.mapInArrow(_writer(folder), "archive string, offset long, length long, url string, digest string, page string"), "warc-index")


def coalesced(ranges: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) ranges to (offset, length, members) of the reads that cover them."""
    out: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(ranges):
        if out:
            start, size, members = out[-1]
            if offset - (start + size) <= GAP_BYTES and offset + length - start <= READ_BYTES:
                members.append(i)
                out[-1] = (start, max(size, offset + length - start), members)
                continue
        out.append((offset, length, [i]))
    return out


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            archive, offset, length = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            cut = [0, *(i for i in range(1, len(archive)) if archive[i] != archive[i - 1]), len(archive)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a == b:
                    continue
                if archive[a] != name:
                    if file is not None:
                        file.close()
                    name, file = archive[a], store.open_input_file(f"{root}/{archive[a]}")
                for start, size, members in coalesced(list(zip(offset[a:b], length[a:b], strict=True))):
                    data = file.read_at(size, start)
                    for m in members:
                        low = offset[a + m] - start
                        fields, payload = parsed(gzip.decompress(data[low : low + length[a + m]]))
                        response = fields["WARC-Type"] == "response"
                        rows.append((_page(fields["WARC-Record-ID"]), fields["WARC-Type"], _page(fields.get("WARC-Refers-To")), len(payload) if response else None, hashlib.sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"].partition(":")[2], payload if response else None))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page", "record_type", "refers", "payload_bytes", "payload_digest", "payload"])
        if file is not None:
            file.close()

    return run


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """The records of selected index rows: (page, record_type, refers, payload_bytes, payload_digest, payload); an archive's rows are read in order by one task."""
    # the index is small where the archives aren't, so its bytes can't tell how many tasks are needed
    sizes = selected.agg(F.count_distinct("archive").alias("archives"), F.sum("length").alias("bytes")).first()
    tasks = max(1, min(sizes["archives"], max(-(-(sizes["bytes"] or 0) // TASK_BYTES), selected.sparkSession.sparkContext.defaultParallelism)))
    rows = selected.select("archive", "offset", "length").repartition(tasks, "archive").sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_reader(folder), "page string, record_type string, refers string, payload_bytes long, payload_digest string, payload binary")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write all pages, read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to), sizes and digests of full payloads."""
    kind = pages.schema[id_col].dataType
    folder = folder or new_path(pages.sparkSession, "archives")
    read = written(read_records(write_archives(pages, folder, id_col, url_col, html_col), folder).drop("payload"), "warc-read")
    full = read.where("record_type = 'response'").groupBy(F.col("page").alias("of"), F.col("payload_digest").alias("sum")).agg(F.max("payload_bytes").alias("bytes"))
    seen = read.join(full, (F.col("refers") == F.col("of")) & (F.col("payload_digest") == F.col("sum")), "left")
    return seen.select(F.col("page").cast(kind).alias("page_id"), F.coalesce("payload_bytes", "bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("refers").cast(kind).alias("refers_to"))
