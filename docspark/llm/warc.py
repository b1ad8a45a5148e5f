"""WARC archives that are written index first and read by coalesced byte ranges.

Each task writes archives of its own into the shared folder, a record compressed by itself,
and returns one index row per record: file, offset, length, URL and digest.  The index is the
list of what was written: a file of a task that was lost is in no index and never read.
Reading sorts the chosen records by file and offset, joins neighbouring byte ranges into one
read, and cuts the records out of it.

Defined results: a null html is an empty payload; of rows with equal payloads all that have
the smallest page_id are responses; a null page_id counts as the largest; a null URL has no
target header; line breaks in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from docspark.llm import words as wd
from docspark.sources import staging

ARCHIVE_BYTES = 256_000_000
# Byte ranges no further apart than this are read together, up to this many bytes.
GAP_BYTES = 64_000
READ_BYTES = 8_000_000
# Records that a reading task is given, in bytes; a file belongs to one task.
TASK_BYTES = 32_000_000

INDEX = (
    "file string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system: a bare path lies where Spark's paths do, not on a machine's disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith(("/", "file:/")):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", folder)
    return fs.FileSystem.from_uri(folder)


def _record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers: int | None) -> bytes:
    """One record; ``refers`` is the page whose payload this one repeats."""
    kind = "response" if refers is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body = http + f"Content-Length: {size}\r\n\r\n".encode() + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: int(x) if (x := fields.get(name, "")[10:-1]) else None
    found = {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": page("WARC-Refers-To"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]),
        "payload": payload,
    }
    if found["record_type"] == "response" and digest_of(payload) != found["payload_digest"]:
        raise ValueError(f"payload of page {found['page_id']} differs from its digest")
    return found


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); return the index.

    Rows whose payload has at least ``min_bytes`` bytes and equals that of a smaller page_id
    become revisits of it.
    """
    folder = _qualified(pages.sparkSession, folder)
    html = F.coalesce("html", F.lit(""))
    page = F.col("page_id").cast("long").alias("page_id")
    narrow = pages.select(page, F.sha1(html).alias("sha"), F.octet_length(html).alias("size"))
    narrow = narrow.where(F.col("size") >= min_bytes)
    first = narrow.groupBy("sha", "size").agg(F.min("page_id").alias("first"))
    again = narrow.join(first, ["sha", "size"]).where(~F.col("page_id").eqNullSafe(F.col("first")))
    again = again.where("first IS NOT NULL").select(F.col("page_id").alias("_page"), F.col("sha").alias("_sha"), "first")
    again = again.distinct()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            texts = wd.texts_of(batch.column("html"))
            sizes, packed, shas = [], [], []
            for text in texts:
                payload = text.as_py()
                sizes.append(len(payload))
                packed.append(codec.compress(payload, asbytes=True))
                shas.append(hashlib.sha1(payload).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "size": pa.array(sizes, pa.int64()),
                    "sha": pa.array(shas, pa.string()),
                    "packed": pa.array(packed, pa.binary()),
                }
            )

    whole = pages.select(page, F.col("url").cast("string"), "html")
    whole = whole.mapInArrow(squeeze, "page_id long, url string, size long, sha string, packed binary")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha") == F.col("_sha"))
    rows = whole.join(again, same, "left").select("page_id", "url", "size", "sha", "packed", "first")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        index: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                payload = b""
                if row["first"] is None and row["size"]:
                    payload = pa.Codec("zstd").decompress(row["packed"], row["size"], asbytes=True)
                made = _record(row["page_id"], row["url"], payload, row["size"], digest, row["first"])
                made = gzip.compress(made, 1, mtime=0)
                out.write(made)
                kind = "response" if row["first"] is None else "revisit"
                index.append((name, at, len(made), row["page_id"], row["url"], digest, kind, row["first"]))
                at += len(made)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield _index_rows(index)
                    index = []
        if out is not None:
            out.close()
            yield _index_rows(index)

    index, _ = staging.stage(rows.mapInArrow(archive, INDEX), "index")
    return index


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [field.split() for field in INDEX.split(", ")]
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def read(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that the rows of ``index`` name, read from the archives.

    A revisit has no payload of its own: its size and digest are those of the full payload.
    """
    folder = _qualified(index.sparkSession, folder)
    fields = RECORD.split(", ") if payload else RECORD.split(", ")[:-1]
    names = [field.split()[0] for field in fields]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    # The index is small beside what it names, so its own size can't set the number of tasks.
    size, files = index.agg(F.coalesce(F.sum("length"), F.lit(0)), F.approx_count_distinct("file")).first()
    tasks = max(1, min(files, -(-size // TASK_BYTES)))
    chosen = index.select("file", "offset", "length").repartition(tasks, "file").sortWithinPartitions("file", "offset")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, source = None, None
        for batch in batches:
            for file, begin, parts in _ranges(batch):
                if file != name:
                    name, source = file, store.open_input_file(f"{base}/{file}")
                source.seek(begin)
                end = parts[-1][0] + parts[-1][1]
                data = source.read(end - begin)
                records = [parse(zlib.decompress(data[o - begin : o - begin + n], 31)) for o, n in parts]
                arrays = [pa.array([r[f] for r in records], kinds[k]) for f, k in (x.split() for x in fields)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return chosen.mapInArrow(fetch, ", ".join(fields))


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """Neighbouring records of a file together: (file, begin, [(offset, length)])."""
    now: list[tuple[int, int]] = []
    file = None
    for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
        if now and (
            name != file
            or offset - now[-1][0] - now[-1][1] > GAP_BYTES
            or offset + length - now[0][0] > READ_BYTES
        ):
            yield file, now[0][0], now
            now = []
        file = name
        now.append((offset, length))
    if now:
        yield file, now[0][0], now
