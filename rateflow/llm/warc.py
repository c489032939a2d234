"""WARC archives: written as text files, read back by boundary-chain verification.

Writing. Each page is a ``response`` record, or a ``revisit`` of the page with the smallest
id among those of equal payload (length and SHA-1). A record is one line of Spark's text
writer, whose line separator is the blank line pair that ends a WARC record; so archives
are written by the tasks straight to the shared folder, and no payload is shuffled.

Reading. Spark's text reader splits the archives at the magic ``WARC/1.0`` line into
chunks, in pieces of files of any size. A chunk is only a candidate: the magic may stand
inside a payload. Each task gives every candidate the offset of its successor, from its
header and Content-Length, and follows these pointers to where they leave its split. The
candidates' exits are then doubled by joins (pointer jumping) from the start of each
file; only splits' entries that the chain reaches count, and a second pass over the
archives walks each split from its entry. Chunks between two reached records are payload.
Absolute offsets are sums of the chunk lengths of the splits before, so nothing but
Spark's own reader touches the files.

Defined cases: a null html is an empty payload; pages that tie on the smallest id are
each a response; pages with a null page_id are responses that nothing refers to; control
characters and blanks in a url are written as %20; a chain that breaks off (a damaged record) ends that
file's records there. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rateflow.llm.common import drop_rows, fresh_path, written

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
_M, _E = len(MAGIC), len(END)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 4 times 40 bits as 8 digits."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Write a record for each row of pages (page_id, url, html) under ``path``. Equal
    payloads of at least ``min_bytes`` bytes are stored once."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    by = F.xxhash64("page_id", "html")
    pages = pages.select("page_id", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20").alias("url"), "html")
    facts = written(pages.select("page_id", "url", base32_sha1(payload.cast("binary")).alias("digest"),
                                 F.octet_length(payload).cast("bigint").alias("bytes"), by.alias("row_key")), "payloads")
    firsts = written(facts.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                     .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-pages")
    revisits = written(facts.join(firsts, ["digest", "bytes"]).where("page_id <> first"), "revisits")

    def record(kind: str, digest: Column, refers: Column | None, length: Column, size: Column, block: Column) -> Column:
        lines = [F.lit(f"{MAGIC}WARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
                 F.coalesce(F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"), F.lit(">\r\n")), F.lit("")),
                 F.coalesce(F.concat(F.lit("WARC-Target-URI: "), "url", F.lit("\r\n")), F.lit("")),
                 F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest, F.lit("\r\nX-Payload-Length: "), size.cast("string"), F.lit("\r\n"))]
        if refers is not None:
            lines.append(F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">\r\n")))
        lines.append(F.concat(F.lit("Content-Type: text/html\r\nContent-Length: "), length.cast("string"), F.lit(END), block))
        return F.concat(*lines).alias("value")

    size = F.octet_length(payload)
    responses = drop_rows(pages, revisits, by).select(
        record("response", base32_sha1(payload.cast("binary")), None, size, size, payload))
    others = revisits.select(record("revisit", F.col("digest"), F.col("first"), F.lit(0), F.col("bytes"), F.lit("")))
    responses.unionAll(others).write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics: file, block (the split's start) and value."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


_CONTENT_LENGTH = r"(?im)^Content-Length:[ \t]*(\d{1,18})[ \t\r]*$"


def _head() -> Column:
    return F.substring_index("value", END, 1)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each split together; a split's rows come one after another."""
    key, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            k = (r["file"], r["block"])
            if k != key:
                if rows:
                    yield key, rows
                key, rows = k, []
            rows.append(r)
    if rows:
        yield key, rows


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each candidate its place and its exit from the split, counted from the start of
    the split's first chunk; a row with a null place has the split's length."""
    for (file, block), rows in _splits(batches):
        at, places = 0, []
        for r in rows:
            places.append(at)
            at += r["length"] + _M
        total = at
        exits: dict[int, int | None] = {}  # None: the chain breaks off
        for i in range(len(rows) - 1, -1, -1):
            r, p = rows[i], places[i]
            if (block == 0 and i == 0) or r["content"] is None:
                continue  # what comes before the first magic, or no record header
            to = p + r["head"] + 2 * _E + r["content"] + _M
            exits[p] = to if to >= total else exits.get(to)
        n = len(exits) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array([None, *exits], pa.int64()),
             pa.array([total, *exits.values()], pa.int64())], names=["file", "block", "place", "to"])


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """For each split: base (the absolute place of its first chunk), entry (the place of its
    first true record, null if it has none) and next_entry (of the splits after, or the end)."""
    rows = (_chunks(spark, path)
            .select("file", "block", F.octet_length("value").cast("bigint").alias("length"), F.octet_length(_head()).cast("bigint").alias("head"),
                    F.nullif(F.regexp_extract(_head(), _CONTENT_LENGTH, 1), F.lit("")).cast("bigint").alias("content"))
            .mapInArrow(_candidates, "file string, block bigint, place bigint, to bigint"))
    rows = written(rows, "candidates")
    in_file = Window.partitionBy("file").orderBy("block")
    splits = written(rows.where("place is null").select("file", "block", F.col("to").alias("total"))
                     .withColumn("base", F.sum("total").over(in_file) - F.col("total")), "splits")
    nodes = written(rows.where("place is not null").join(splits, ["file", "block"])
                    .select("file", "block", (F.col("place") + F.col("base")).alias("place"), (F.col("to") + F.col("base")).alias("to")), "pointers")
    most = splits.groupBy("file").count().agg(F.max("count").alias("n")).first()["n"] or 0
    reached = nodes.where(F.col("place") == _M).select("file", "place")
    jumps = nodes.select("file", "place", "to")
    hops = 1  # the length of a jump; every split that is passed takes one
    while hops < 2 * most:
        reached = written(reached.unionByName(
            reached.join(jumps.hint("merge"), ["file", "place"]).select("file", F.col("to").alias("place"))).distinct(), "reached")
        jumps = written(jumps.hint("merge").join(jumps.select("file", F.col("place").alias("to"), F.col("to").alias("next")), ["file", "to"])
                        .select("file", "place", F.col("next").alias("to")), "jumps")
        hops *= 2
    entries = nodes.join(reached.hint("merge"), ["file", "place"], "left_semi").select("file", "block", F.col("place").alias("entry"))
    after = in_file.rowsBetween(1, Window.unboundedFollowing)
    end = F.sum("total").over(Window.partitionBy("file"))
    return written(splits.join(entries, ["file", "block"], "left")
                   .withColumn("next_entry", F.coalesce(F.min("entry").over(after), end)).drop("total"), "entries")


def _content_end(place: int, data: bytes) -> int | None:
    head = data.split(END.encode(), 1)[0]
    m = re.search(_CONTENT_LENGTH.encode(), head)
    return place + len(head) + 2 * _E + int(m[1]) + _M if m else None


class _Walk:
    """Collects records, or the parts of those that lie in several splits."""

    def __init__(self):
        self.out: list[tuple] = []
        self.held = 0
        self.file, self.parts = "", []

    def begin(self, file: str, place: int, ends: int | None, own: bool) -> None:
        self.file, self.place, self.ends, self.own, self.parts = file, place, ends, own, []

    def close(self, at: int) -> None:
        if self.parts:
            data = MAGIC.encode().join(self.parts)
            self.out.append((self.file, self.place, self.ends, self.own and at == self.ends, data))
            self.held += len(data)
            self.parts = []

    def given(self) -> pa.RecordBatch:
        c = list(zip(*self.out)) or [()] * 5
        self.out, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.bool_()),
             pa.array(c[4], pa.binary())], names=["file", "place", "ends", "whole", "data"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk each split from its entry. Whole records come out with their bytes; of those that
    lie in several splits, each part (whole = false), named by where the record ends."""
    walk, key, at = _Walk(), None, 0
    for batch in batches:
        for r in batch.to_pylist():
            if (r["file"], r["block"]) != key:
                walk.close(at)
                key, at = (r["file"], r["block"]), r["base"]
                # What comes before the entry belongs to a record that ends there.
                walk.begin(r["file"], at, r["next_entry"] if r["entry"] is None else r["entry"], False)
            if at == walk.ends and at == r["entry"] or walk.own and at == walk.ends:
                walk.close(at)
                walk.begin(r["file"], at, _content_end(at, r["value"]), True)
            if at >= _M:
                walk.parts.append(r["value"])
            at += len(r["value"]) + _M
            if walk.held > 8 << 20:
                yield walk.given()
    walk.close(at)
    yield walk.given()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: file, offset, headers (names in lower
    case), payload (the block's bytes)."""
    chunks = _chunks(spark, path).withColumn("value", F.col("value").cast("binary")).withColumn("row", F.monotonically_increasing_id())
    rows = (chunks.join(_entries(spark, path), ["file", "block"])
            .sortWithinPartitions("file", "block", "row")
            .select("file", "block", "base", "entry", "next_entry", "value")
            .mapInArrow(_records, "file string, place bigint, ends bigint, whole boolean, data binary"))
    parts = written(rows.where("not whole"), "record-parts")
    # A part's place is that of its first chunk; parts are put together in that order. The
    # sum of their lengths shows whether all are there.
    joined = (parts.groupBy("file", "ends")
              .agg(F.array_sort(F.collect_list(F.struct("place", "data"))).alias("p"))
              .withColumn("place", F.col("p")[0]["place"])
              .withColumn("data", F.aggregate("p", F.lit(None).cast("binary"), lambda a, x: F.when(a.isNull(), x["data"]).otherwise(
                  F.concat(a, F.lit(MAGIC.encode()), x["data"]))))
              .where(F.octet_length("data") + _M == F.col("ends") - F.col("place")))
    every = rows.where("whole").select("file", "place", "data").unionByName(joined.select("file", "place", "data"))
    # substring_index works on bytes; a header is ASCII or UTF-8, whatever the payload is.
    return (every.withColumn("head_bytes", F.expr("octet_length(substring_index(cast(data as string), '\\r\\n\\r\\n', 1))"))
            .select("file", (F.col("place") - _M).alias("offset"),
                    F.expr("""map_from_entries(transform(filter(split(substring_index(cast(data as string), '\\r\\n\\r\\n', 1), '\\r\\n'),
                                 x -> instr(x, ':') > 0),
                              x -> struct(lower(trim(substring_index(x, ':', 1))), trim(substring(x, instr(x, ':') + 1)))))""").alias("headers"),
                    F.expr(f"substring(data, head_bytes + {_E} + 1, octet_length(data) - head_bytes - {2 * _E})").alias("payload")))


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write pages as archives in the shared folder and read them back: a row for each
    record with page_id, record_type, refers_to, payload, payload_bytes, payload_digest."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_warc(pages, path, min_bytes)
    h = F.col("headers")
    response = h["warc-type"] == "response"
    def page(header: str) -> Column:
        return F.nullif(F.regexp_extract(h[header], r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("bigint")

    return (read_warc(spark, path)
            .select(page("warc-record-id").alias("page_id"),
                    h["warc-type"].alias("record_type"),
                    page("warc-refers-to").alias("refers_to"),
                    F.when(response, F.octet_length("payload")).otherwise(h["x-payload-length"].cast("bigint")).cast("bigint").alias("payload_bytes"),
                    F.when(response, base32_sha1(F.col("payload"))).otherwise(F.substring_index(h["warc-payload-digest"], ":", -1)).alias("payload_digest"),
                    "payload"))
