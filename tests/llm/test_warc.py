import base64
import glob
import hashlib

import pytest

from rateflow.llm import warc

SCHEMA = "page_id long, url string, html string, file string, value string"
MAGIC = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    bodies = ["<p>é</p>", None, "", "same", "same", "x" * 3000, "WARC/1.0\r\n", MAGIC, f"a{MAGIC}b{MAGIC}" * 40,
              "ends with blank lines\r\n\r\n", "\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n", "same", "y" * 200]
    out = [(i, f"http://a/{i}?q=a b\r\nX: y", b, "f", "v") for i, b in enumerate(bodies)]
    out += [(50 + i, "http://b/", f"page {i} " * 20, "f", "v") for i in range(60)]
    return out + [(None, None, "same", "f", "v"), (7, "http://c/", "another with id 7", "f", "v")]


@pytest.mark.parametrize("split", ["300", "2000", "128m"])
def test_round_trip(spark, rows, split):
    """Small splits put magics, headers and payloads across their borders."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        got = warc.archive(spark.createDataFrame(rows, SCHEMA).coalesce(2)).collect()
    finally:
        for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{k}")
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    expected = sorted(((i, len((h or "").encode()), _digest(h), "revisit" if i is not None and first[h or ""] < i else "response",
                        first[h or ""] if i is not None and first[h or ""] < i else None) for i, _, h, *_ in rows), key=repr)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, []).append(bytes(r.payload))
    for i, _, h, *_ in rows:
        if i is not None and i != 7 and first[h or ""] == i:
            assert by_id[i] == [(h or "").encode()]


def test_smaller_payloads_are_all_responses(spark, rows):
    got = warc.archive(spark.createDataFrame(rows, SCHEMA), min_bytes=5).collect()
    assert len(got) == len(rows) and {r.record_type for r in got} == {"response"}


def test_files_are_plain_records(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_warc(spark.createDataFrame([(1, "http://a/", "body", "", "")], SCHEMA).coalesce(1), path)
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_path}/w/part-*"))
    head, _, rest = data.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n") and b"Content-Length: 4" in head and rest == b"body\r\n\r\n"
    record = warc.read_warc(spark, path).collect()
    assert [(r.offset, r.headers["warc-target-uri"], bytes(r.payload)) for r in record] == [(0, "http://a/", b"body")]


def test_damaged_record_ends_the_chain(spark, tmp_path):
    good = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "a").write_bytes((good + good.replace("2", "9") + good).encode())
    got = warc.read_warc(spark, f"file://{tmp_path}/a").collect()
    assert [(r.offset, bytes(r.payload)) for r in got] == [(0, b"ok")]


def test_no_pages(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).collect() == []
