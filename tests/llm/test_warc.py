import base64
import gzip
import hashlib

import pytest

from docspark.llm import warc

ROWS = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>two \r\n\r\n \xe9 字</p>"),
    (3, None, "<p>one</p>"),
    (0, "http://b\r\n/0", "<p>one</p>"),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "WARC/1.1\r\n\r\n" + "long " * 200_000),
    (0, "http://b\r\n/0", "<p>one</p>"),
    (None, "http://a/n", "<p>one</p>"),
]


@pytest.fixture
def written(spark, tmp_path):
    pages = spark.createDataFrame([(*r, "x", "y") for r in ROWS], "page_id long, url string, html string, size string, first string")
    folder = str(tmp_path / "archives of pages")
    return warc.write(pages.repartition(3), folder), folder


def test_round_trip(written):
    index, folder = written
    found = {(r.page_id, r.url): r for r in warc.read(index, folder).collect()}
    assert index.count() == len(ROWS)
    for page_id, url, html in ROWS:
        r = found[page_id, url and url.replace("\r\n", "%0D%0A")]
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest)
        first = min(i for i, _, h in ROWS if (h or "") == (html or "") and i is not None)
        if page_id == first:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, payload)
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", first, b"")


def test_index_names_whole_records(written):
    index, folder = written
    for r in index.collect():
        with open(f"{folder}/{r.file}", "rb") as f:
            f.seek(r.offset)
            record = gzip.decompress(f.read(r.length))
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert warc.parse(record)["page_id"] == r.page_id


def test_chosen_records_only(written):
    index, folder = written
    assert [r.page_id for r in warc.read(index.where("page_id = 6"), folder).collect()] == [6]


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame(ROWS[:4], "page_id long, url string, html string")
    index = warc.write(pages, str(tmp_path / "a"), min_bytes=11)
    assert {r.record_type for r in index.collect()} == {"response"}


def test_a_changed_payload_is_an_error():
    record = warc._record(1, "u", b"abc", 3, warc.digest_of(b"abd"), None)
    with pytest.raises(ValueError):
        warc.parse(record)


def test_ranges_are_joined(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    rows = {"file": ["a", "a", "a", "b"], "offset": [0, 5, 40, 0], "length": [5, 5, 5, 5]}
    found = list(warc._ranges(pa.RecordBatch.from_pydict(rows)))
    assert found == [("a", 0, [(0, 5), (5, 5)]), ("a", 40, [(40, 5)]), ("b", 0, [(0, 5)])]


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = str(tmp_path / "none")
    assert warc.read(warc.write(pages, folder), folder).collect() == []


def test_a_bare_path_is_qualified(spark, tmp_path):
    assert warc._qualified(spark, f"{tmp_path}/a b") == f"file:{tmp_path}/a b"
    assert warc._qualified(spark, f"file://{tmp_path}/x").endswith(f"{tmp_path}/x")
