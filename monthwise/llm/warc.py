"""Operator 10: WARC archives with a two-level capture index.

Writing.  Payloads (the html in UTF-8) are grouped by length and SHA-1.  Of equal
payloads of at least MIN_REVISIT bytes the record with the largest page_id is a
response, the others are revisits that name it; all others are responses.  Records
are strings, and Spark's text writer with CRLF CRLF as line separator, which is
how a WARC record ends, writes them as plain .warc content into any file system
that Spark reaches.  Pages of one class of size share archives, so many that none
exceeds ARCHIVE_BYTES unless a single page does.

Index.  Archives are read back file by file; each record gives a capture line (key,
page, type, digest, file, offset, length).  The key is the URL with its host
reversed.  Lines are sorted by key over range partitions and cut into blocks of
LINES_PER_BLOCK, compressed, and written one after another; the sparse directory holds
one row for a block (its number, first and last key, file, offset, length).

Lookup.  ``resolve`` takes any number of URLs.  Their keys are sorted together with the directory's
first and last keys, and running counts say which blocks may hold a key: no join on ranges, and no
task or driver holds the directory.  Tasks then read the byte range of each such block, search
its lines by bisection, and pass the captures to tasks that read the byte range of each
record, an archive at a time in the order of offsets, and check its payload's digest.
The query looks all pages up in this way.

Equal payloads may be a third of all rows: the group's largest id is a partial
aggregate, and only the left join meets the group, where adaptive execution splits
a large partition.  A Bloom filter of repeated digests keeps all other pages out of
that join, so most html is never shuffled.  A URL's captures are found block by block.

Byte ranges are read in the tasks by pyarrow's file systems (local and shared folders, HDFS, S3,
GCS, Azure); archives and index must lie in one of these, as spark.checkpoint.dir does.

Defined results: null html: empty payload; null url: empty; null page_id: a record
without an id, the revisit of an equal payload that has one; rows repeated with
one page_id are all the response; an empty table gives empty archives, an empty
index and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import (bloom, bloom_bits, in_bloom, materialize, release, scratch, shared_path,
                                  small_batches, table)
from monthwise.operators.ranking import rank_labels

MIN_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
SIZES = (1 << 16, 1 << 20, 1 << 24)    # upper bounds of the classes of page sizes; beyond, a page is an archive
LINES_PER_BLOCK = 3000
BLOCKS_PER_FILE = 64
DATE = "2024-01-01T00:00:00Z"          # pages carry no time of their own
END = "\r\n\r\n"
CAPTURE = ("key string, page_id long, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, url string, file string, offset long, length long")
LINE_FIELDS = [f.split()[0] for f in CAPTURE.split(", ")]


def surt(url: str) -> str:
    """Reversed-host key: http://a.example.com:80/x?y#z -> com,example,a)/x?y"""
    url = (url or "").replace("\r", "").replace("\n", "")          # as in the record's head
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return (url or "").strip()
    if not host:
        return (url or "").strip()
    port = "" if port in (None, 80, 443) else f":{port}"
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + port + ")" + path


def _by_bloom(bits, inside):
    """The rows whose hash, the first column, may be in the filter, or the others."""
    def run(batches):
        for b in batches:
            ok = in_bloom(bits.value, b.column(0).to_numpy(zero_copy_only=False))
            yield b.filter(pa.array(ok if inside else ~ok))
    return run


def classify(pages: DataFrame, keep) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to.  Only
    rows whose digest may be a repeated one are shuffled with their html."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]+", "").alias("url"),
                        html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha1(html.cast("binary")).alias("payload_digest"))
    again = base.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest", "payload_bytes") \
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1 and owner is not null") \
        .select("payload_digest", "payload_bytes", "owner")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    again = keep(again, "repeated-payloads")
    bits = pages.sparkSession.sparkContext.broadcast(
        bloom(again.select(F.xxhash64("payload_digest").alias("h")), bloom_bits(again.count())))
    hashed = base.select(F.xxhash64("payload_digest").alias("h"), "page_id", "url", "html", "payload_bytes", "payload_digest")
    schema = "h long, page_id long, url string, html string, payload_bytes long, payload_digest string"
    single = hashed.mapInArrow(_by_bloom(bits, False), schema).withColumn("owner", F.lit(None).cast("long"))
    perhaps = hashed.mapInArrow(_by_bloom(bits, True), schema).join(again, ["payload_digest", "payload_bytes"], "left")
    return perhaps.unionByName(single) \
        .select("page_id", "url", F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("html"), "payload_bytes",
                "payload_digest", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
                F.when(revisit, F.col("owner")).alias("refers_to"))


def record() -> Column:
    """The text of one record without its end."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.col("html"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: <urn:page:"), page,
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(F.col("refers_to").isNotNull(), F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block)


def _size_class() -> Column:
    out = F.lit(0)
    for limit in SIZES:
        out = out + (F.octet_length("html") > limit).cast("int")
    return out


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives ``path/size-<class>/part-*``; only classes that have pages are written."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    largest = pages.select(html.alias("html")).agg(F.max(_size_class())).first()[0] or 0
    with small_batches(pages.sparkSession), scratch() as keep:
        records = classify(pages, keep).select(record().alias("value"), _size_class().alias("size"))
        for size in range(largest + 1):
            together = max(1, ARCHIVE_BYTES // SIZES[size]) if size < len(SIZES) else 1
            records.where(F.col("size") == size).select("value").write.mode("overwrite").option("lineSep", END) \
                .option("maxRecordsPerFile", together).text(f"{path}/size-{size}")


def parse_record(data, at: int):
    """(headers, block start, block length, record end) of the record at ``at``."""
    stop = data.find(b"\r\n\r\n", at)
    head = bytes(data[at:stop]).decode().split("\r\n")
    if not head[0].startswith("WARC/"):
        raise ValueError(f"no record at byte {at}")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head[1:])
    length = int(headers["Content-Length"])
    end = stop + 4 + length
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at byte {at} has no end")
    return headers, stop + 4, length, end + 4


def _page(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail and tail != "none" else None


def read_record(data, at: int, path: str):
    """(headers, payload digest, payload size, payload, end) of the record at ``at``; the
    digest of a response is that of its bytes, a revisit's payload is elsewhere and described by its head."""
    h, start, length, end = parse_record(data, at)
    http = data.find(b"\r\n\r\n", start) + 4
    if h["WARC-Type"] == "revisit":
        return (h, h["WARC-Payload-Digest"].removeprefix("sha1:"),
                int(bytes(data[start:http]).decode().rpartition("Content-Length: ")[2]), b"", end)
    payload = data[http:start + length]
    digest = hashlib.sha1(payload).hexdigest()
    if h["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"digest of the record at {path}:{at}")
    return h, digest, len(payload), payload, end


def _captures(batches):
    for b in batches:
        cols: list[list] = [[] for _ in LINE_FIELDS]
        for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            at = 0
            while at < len(data):
                h, digest, size, _, end = read_record(data, at, path)
                kind = h["WARC-Type"]
                row = (surt(h["WARC-Target-URI"]), _page(h["WARC-Record-ID"]), kind, digest, size,
                       _page(h.get("WARC-Refers-To")), h["WARC-Target-URI"], "/".join(path.split("/")[-2:]), at, end - at)
                for c, x in zip(cols, row):
                    c.append(x)
                at = end
        kinds = {"string": pa.string(), "long": pa.int64()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[f.split()[1]]) for c, f in zip(cols, CAPTURE.split(", "))], names=LINE_FIELDS)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path) \
        .where("length > 0").select("path", "content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A capture row for each record, read from the archives; an Arrow batch takes as many
    archives as its limit of bytes allows."""
    return _files(spark, path).mapInArrow(_captures, CAPTURE)


def _blocks(size):
    """Sorted capture rows to blocks, each a head line and compressed lines."""
    def run(batches):
        lines: list[str] = []
        keys: list[str] = []

        def block():
            body = zlib.compress("\n".join(lines).encode(), 6)
            head = json.dumps([len(body), len(lines), keys[0], keys[-1]]).encode() + b"\n"
            return head + body

        for b in batches:
            done = []
            for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                keys.append(row[0])
                lines.append(json.dumps(row, ensure_ascii=False))
                if len(lines) == size:
                    done.append(block())
                    lines, keys = [], []
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], names=["block"])
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array([block()], pa.binary())], names=["block"])
    return run


def _directory(batches):
    for b in batches:
        out: list[tuple] = []
        for path, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            at = 0
            while at < len(data):
                stop = data.index(b"\n", at) + 1
                size, n, first, last = json.loads(data[at:stop])
                out.append((first, last, n, "/".join(path.split("/")[-2:]), stop, size))
                at = stop + size + 1            # the writer's line separator
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("first_key", "last_key", "n", "file", "offset", "length"), x)) for x in out],
            schema=pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("n", pa.int64()),
                              ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))


def write_index(captures: DataFrame, path: str, lines_per_block: int = LINES_PER_BLOCK) -> None:
    """``path/blocks`` and ``path/directory``."""
    spark = captures.sparkSession
    n = captures.count()
    files = n // (lines_per_block * BLOCKS_PER_FILE) + 1
    captures.repartitionByRange(files, "key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset") \
        .mapInArrow(_blocks(lines_per_block), "block binary").select(F.col("block").cast("string").alias("value")) \
        .write.mode("overwrite").option("lineSep", "\n").text(f"{path}/blocks")
    found = _files(spark, f"{path}/blocks").mapInArrow(
        _directory, "first_key string, last_key string, n long, file string, offset long, length long")
    # blocks are in the order of both their first and their last keys; the number is a place in it
    numbered = rank_labels(found, ["first_key", "last_key", "file", "offset"], "rn", max(1, files // 1000))
    numbered.withColumn("block", F.col("rn") - 1).drop("rn").repartitionByRange(max(1, files // 1000), "block") \
        .sortWithinPartitions("block").write.mode("overwrite").parquet(f"{path}/directory")


def _lines(batches):
    for b in batches:
        rows = []
        for data in b.column(1).to_pylist():
            at = 0
            while at < len(data):
                stop = data.index(b"\n", at) + 1
                size = json.loads(data[at:stop])[0]
                rows += map(json.loads, zlib.decompress(data[stop:stop + size]).decode().split("\n"))
                at = stop + size + 1
        kinds = {"string": pa.string(), "long": pa.int64()}
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[f.split()[1]])
                                          for i, f in enumerate(CAPTURE.split(", "))], names=LINE_FIELDS)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All capture rows of the index, from its blocks."""
    return _files(spark, f"{path}/blocks").mapInArrow(_lines, CAPTURE)


def read_range(spark: SparkSession, path: str, offset: int, length: int) -> bytes:
    """Bytes of a file in any file system that Spark reaches."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(sc._jsc.hadoopConfiguration()).open(at)
    try:
        stream.seek(offset)
        return bytes(sc._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()


def lookup(spark: SparkSession, archives: str, index: str, url: str) -> list[tuple[dict, bytes]]:
    """(capture, payload) of every record of one URL; a revisit's payload is empty."""
    key = surt(url)
    blocks = spark.read.parquet(f"{index}/directory").where((F.col("first_key") <= key) & (F.col("last_key") >= key))
    out = []
    for b in blocks.orderBy("first_key").toLocalIterator():
        lines = zlib.decompress(read_range(spark, f"{index}/{b['file']}", b["offset"], b["length"])) \
            .decode().split("\n")
        i = bisect.bisect_left(lines, key, key=lambda x: json.loads(x)[0])
        while i < len(lines) and (row := json.loads(lines[i]))[0] == key:
            c = dict(zip(LINE_FIELDS, row))
            data = read_range(spark, f"{archives}/{c['file']}", c["offset"], c["length"])
            _, start, length, _ = parse_record(data, 0)
            http = data.index(b"\r\n\r\n", start) + 4
            out.append((c, data[http:start + length]))
            i += 1
    return out


# -- lookups as jobs -----------------------------------------------------------------

class Ranges:
    """Byte ranges of files below one folder, one file open at a time."""

    def __init__(self, base: str):
        from pyarrow import fs
        if base.startswith("file:/") and not base.startswith("file://"):
            base = "file://" + base[5:]
        self.fs, self.base = fs.FileSystem.from_uri(base) if "://" in base else (fs.LocalFileSystem(), base)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.base}/{name}")
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name = self.file = None


def _keys(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in b.column(0).to_pylist()], pa.string())], names=["k"])


def _counts(batches):
    """Sorted rows (k, kind) to the keys with the numbers of first keys up to them and last keys
    before them, counted in this task, and the task's totals in a row without a key."""
    pid, first, last = TaskContext.get().partitionId(), 0, 0
    schema = pa.schema([("k", pa.string()), ("pid", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])
    for b in batches:
        kind = b.column(1).to_numpy(zero_copy_only=False)
        firsts, lasts = first + np.cumsum(kind == 0), last + np.cumsum(kind == 2)
        at = np.flatnonzero(kind == 1)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(np.full(len(at), pid, np.int32)), pa.array(firsts[at]),
                                          pa.array(lasts[at])], schema=schema)
        if len(kind):
            first, last = int(firsts[-1]), int(lasts[-1])
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([pid], pa.int32()), pa.array([first]), pa.array([last])], schema=schema)


def blocks_of(keys: DataFrame, directory: DataFrame, keep) -> DataFrame:
    """(k, block) for distinct ``keys`` (k): the blocks whose first and last keys enclose the key."""
    rows = directory.select(F.col("first_key").alias("k"), F.lit(0).alias("kind")) \
        .unionAll(keys.select("k", F.lit(1))).unionAll(directory.select("last_key", F.lit(2)))
    counted = keep(rows.repartitionByRange("k", "kind").sortWithinPartitions("k", "kind")
                   .mapInArrow(_counts, "k string, pid int, first long, last long"), "index-keys")
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)            # a row for a task
    zero = F.lit(0).cast("long")
    offsets = keep(counted.where("k is null").select("pid", F.coalesce(F.sum("first").over(before), zero).alias("f"),
                                                     F.coalesce(F.sum("last").over(before), zero).alias("l")), "index-offsets")
    return counted.where("k is not null").join(offsets, "pid") \
        .select("k", (F.col("last") + F.col("l")).alias("low"), (F.col("first") + F.col("f") - 1).alias("high")) \
        .where("low <= high").select("k", F.explode(F.sequence("low", "high")).alias("block"))


def _searched(index: str):
    """Rows (block, file, offset, length, k) sorted by block to the captures of the keys."""
    def run(batches):
        kinds = {"string": pa.string(), "long": pa.int64()}
        ranges, now, lines = Ranges(index), None, []
        for b in batches:
            rows = []
            for block, file, offset, length, key in zip(*(b.column(i).to_pylist() for i in range(5))):
                if block != now:
                    now = block
                    lines = [json.loads(x) for x in zlib.decompress(ranges.read(file, offset, length)).decode().split("\n")]
                i = bisect.bisect_left(lines, key, key=lambda x: x[0])
                while i < len(lines) and lines[i][0] == key:
                    rows.append(lines[i])
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[f.split()[1]])
                                              for i, f in enumerate(CAPTURE.split(", "))], names=LINE_FIELDS)
        ranges.close()
    return run


def _fetched(archives: str, payloads: bool):
    """Captures sorted by file and offset to (key, page_id, ...): what their records say."""
    def run(batches):
        ranges, kinds = Ranges(archives), {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        for b in batches:
            out: list[list] = [[] for _ in RECORD.split(", ")]
            at = {name: b.column(i).to_pylist() for i, name in enumerate(LINE_FIELDS)}
            for key, file, offset, length in zip(at["key"], at["file"], at["offset"], at["length"]):
                h, digest, size, payload, _ = read_record(ranges.read(file, offset, length), 0, file)
                row = (key, _page(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], digest, size,
                       _page(h.get("WARC-Refers-To")), payload if payloads else None)
                for c, x in zip(out, row):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[f.split()[1]]) for c, f in zip(out, RECORD.split(", "))],
                                             names=[f.split()[0] for f in RECORD.split(", ")])
        ranges.close()
    return run


RECORD = ("key string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
          "refers_to long, payload binary")


def resolve(urls: DataFrame, archives: str, index: str, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """RECORD of every capture of every URL in ``urls``, each once, read from the archives by
    way of the index; a revisit's payload is empty, and without ``payloads`` all are null."""
    spark = urls.sparkSession
    directory = spark.read.parquet(f"{index}/directory")
    with small_batches(spark), scratch() as keep:
        keys = urls.select(F.col(url_col).cast("string").alias("url")).mapInArrow(_keys, "k string").distinct()
        wanted = blocks_of(keys, directory, keep).join(directory.select("block", "file", "offset", "length"), "block")
        captures = keep(wanted.select("block", "file", "offset", "length", "k").repartition("block").sortWithinPartitions("block", "k")
                        .mapInArrow(_searched(index), CAPTURE), "index-captures")
        return keep.last(captures.repartition("file").sortWithinPartitions("file", "offset")
                         .mapInArrow(_fetched(archives, payloads), RECORD), "records")


def build(pages: DataFrame, path: str, lines_per_block: int = LINES_PER_BLOCK) -> tuple[str, str]:
    """Write archives and index below ``path``; their folders."""
    archives, index = f"{path}/archives", f"{path}/index"
    write_archives(pages, archives)
    with small_batches(pages.sparkSession, 1):                  # an archive in a batch
        captures = materialize(read_archives(pages.sparkSession, archives), "captures")
    write_index(captures, index, lines_per_block)
    release(captures)
    return archives, index


def op10_warc(spark, sf_dir: str) -> DataFrame:
    """Every page looked up by its URL: through the directory, the blocks and the archives."""
    pages = table(spark, sf_dir, "pages")
    archives, index = build(pages, shared_path(spark, "warc"))
    return resolve(pages, archives, index, payloads=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
