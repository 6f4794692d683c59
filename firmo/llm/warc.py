"""WARC archives: writer with revisit records and a splittable reader.

Every record is a gzip member of its own; the first of an archive is its warcinfo.
Dates are a parameter of the run, so that equal runs write equal archives.  The reader cuts each file into byte
ranges; a task looks for the gzip magic in its range, takes a candidate as a
record only if it inflates to a WARC header, and owns the records that start
inside its range, reading past its end where the last one runs over.

A record's payload digest is that of the full payload; a revisit keeps the HTTP
header of the capture, with the payload's length, and names the record it
refers to.

Edge cases: a null html is an empty payload; rows with equal payloads, empty
ones included, form one group, whose smallest page_id is the response; of rows that
share that page_id one is the response; rows with a null page_id are revisits
of it, or responses where no row of the group has a page_id; extra columns are ignored; an empty
table writes nothing and gives no row."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmo.llm import files
from firmo.llm.common import blocks, column, pick, shared_dir, utf8
from firmo.params import DEFAULT

GZIP = b"\x1f\x8b\x08"
SPLIT = 16 << 20
WINDOW = 1 << 20
READERS = 100_000                   # tasks of a read at most; each takes several ranges beyond it
DATE = DEFAULT.run_ts.strftime("%Y-%m-%dT%H:%M:%SZ")
#: fixed values of the format
VERSION = b"WARC/1.1"
STANDARD = "http://iipc.github.io/warc-specifications/specifications/warc-format/warc-1.1/"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def info(name: str, date: str) -> bytes:
    """The warcinfo member that begins an archive."""
    body = f"software: firmo\r\nformat: WARC File Format 1.1\r\nconformsTo: {STANDARD}\r\n".encode()
    return _member(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:warcinfo:{name}>", f"WARC-Date: {date}",
                    f"WARC-Filename: {name}", "Content-Type: application/warc-fields"], body)


def _member(head: list[str], body: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    lines = [VERSION.decode(), *head, f"Content-Length: {len(body)}"]
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response, or a revisit if it refers to a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    body = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return _member(head, body)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of an inflated record."""
    end = raw.index(b"\r\n\r\n")
    head = {}
    for line in raw[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        head[k.strip().lower()] = v.strip()
    body = raw[end + 4:end + 4 + int(head["content-length"])]
    return head, body


def mark_revisits(pages: DataFrame, n: int) -> DataFrame:
    """page_id, url, html, _sha, _first (the smallest page_id of a group of several
    rows); rows of one page_id stand together.  Payloads are shuffled once, by
    page_id; groups are found on digests alone, where Spark splits hot ones."""
    sha = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pick(pages, "page_id", "url", "html").withColumn("_sha", sha)
    ids = rows.select("page_id", "_sha")
    groups = (ids.groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).select("_sha", "_first"))
    # a page_id is a key: it has one payload, or a few
    refs = (ids.where("page_id IS NOT NULL").join(groups, "_sha").distinct()
            .groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("_sha", "_first"))).alias("_refs")))
    known = (rows.where("page_id IS NOT NULL").repartition(n, "page_id").join(refs, "page_id", "left")
             .select("page_id", "url", "html", "_sha", F.try_element_at("_refs", "_sha").alias("_first"))
             .sortWithinPartitions("page_id", "_sha", "url"))
    alone = rows.where("page_id IS NULL").join(groups, "_sha", "left").select("page_id", "url", "html", "_sha", "_first")
    return known.unionByName(alone)


def write(pages: DataFrame, out: str, archives: int | None = None, date: str = DATE) -> DataFrame:
    """Write the archives and return one small row for each: uri, size, n_records."""
    spark = pages.sparkSession
    marked = mark_revisits(pages, archives or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        at = f"{out}/part-{TaskContext.get().partitionId():07d}.warc.gz"
        seen = 0

        def parts():
            nonlocal seen
            last = None
            for b in blocks(batches, "html"):
                rows = zip(column(b, "page_id").to_pylist(), column(b, "url").to_pylist(), utf8(column(b, "html")),
                           column(b, "_sha").to_pylist(), column(b, "_first").to_pylist(), strict=True)
                for page, url, payload, sha, first in rows:
                    again = first is not None and (page != first or last == (page, sha))
                    yield record(page, url, payload, digest(payload), first if again else None, date)
                    last = (page, sha)
                    seen += 1

        held = _ahead(parts())
        if held is not None:
            size = files.put(at, itertools.chain([info(at.rsplit("/", 1)[1], date)], held))
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([size], pa.int64()), pa.array([seen], pa.int64())],
                                             names=["uri", "size", "n_records"])

    return marked.mapInArrow(run, "uri string, size long, n_records long")


def _ahead(parts):
    """The same parts, or None if there are none."""
    first = next(parts, None)
    return None if first is None else itertools.chain([first], parts)


def _inflate(f, at: int, limit: int | None = None) -> tuple[bytes | None, int]:
    """The member at a position (its first ``limit`` bytes), and where it ends;
    None if the bytes there are no whole gzip member."""
    f.seek(at)
    z, got, size, read = zlib.decompressobj(31), [], 0, 0
    try:
        while not z.eof:
            raw = f.read(16 << 10 if limit is None else 4 << 10)
            if not raw:
                return None, at
            read += len(raw)
            x = z.decompress(raw)
            got.append(x)
            size += len(x)
            if limit is not None and size >= limit:
                return b"".join(got), at
    except zlib.error:
        return None, at
    return b"".join(got), at + read - len(z.unused_data)


def records(uri: str, start: int, end: int, size: int):
    """Records that start in a byte range: (position, headers, block)."""
    with files.reader(uri) as f:
        at = start
        while at < end:
            found = _next_magic(f, at, min(end + len(GZIP) - 1, size))
            if found is None or found >= end:
                return
            head, _ = _inflate(f, found, 16)
            raw, after = (None, found) if head is None or not head.startswith(b"WARC/") else _inflate(f, found)
            if raw is None:
                at = found + 1
                continue
            head, body = parse(raw)
            yield found, head, body
            at = after


def _next_magic(f, at: int, end: int) -> int | None:
    while at < end:
        f.seek(at)
        raw = f.read(min(WINDOW, end - at))
        i = raw.find(GZIP)
        if i >= 0:
            return at + i
        if at + len(raw) >= end or not raw:
            return None
        at += len(raw) - len(GZIP) + 1
    return None


def read(spark: SparkSession, archives: list[tuple[str, int]], split: int = SPLIT) -> DataFrame:
    """One row per record, read by byte ranges: record_id, record_type, uri,
    payload (null for revisits), payload_bytes, payload_digest, refers_to."""
    n = sum(-(-size // split) for _, size in archives)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long")))
    tasks = (spark.createDataFrame(archives, "uri string, size long").where("size > 0").select("uri", start.alias("start"), "size")
             .withColumn("stop", F.least("size", F.col("start") + split)).repartition(max(1, min(READERS, n))))

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                out = []
                held = 0
                for _, head, body in records(row["uri"], row["start"], row["stop"], row["size"]):
                    if head["warc-type"] not in ("response", "revisit"):
                        continue
                    cut_at = body.index(b"\r\n\r\n") + 4
                    http = body[:cut_at].decode("latin-1")
                    n = int(re.search(r"(?i)\r\ncontent-length: *(\d+)", http)[1])
                    page = re.fullmatch(r"<urn:page:(-?\d*)>", head["warc-record-id"])[1]
                    to = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("warc-refers-to", ""))
                    kind = head["warc-type"]
                    out.append((int(page) if page else None, kind, head["warc-target-uri"],
                                body[cut_at:] if kind == "response" else None, n,
                                head["warc-payload-digest"].removeprefix("sha1:"), int(to[1]) if to else None))
                    held += len(body)
                    if held > 4 << 20:
                        yield _rows(out)
                        out, held = [], 0
                if out:
                    yield _rows(out)

    return tasks.mapInArrow(run, "page_id long, record_type string, uri string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def _rows(out: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = ["page_id", "record_type", "uri", "payload", "payload_bytes", "payload_digest", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def query(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    spark = pages.sparkSession
    # one small row per archive comes to the driver
    made = [(r["uri"], r["size"]) for r in write(pages, shared_dir(spark, "warc")).collect()]
    return (read(spark, sorted(made), split)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
