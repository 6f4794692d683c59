"""Quoted CSV files read by byte ranges (O-IO-01, O-IO-02).

A line end may stand inside a quoted field, so a task that starts in the middle of a
file cannot know whether its first line starts a record.  It can know what the range
does in either case: lines map two states (a record starts here, or a quoted field
is open) to two states, and such maps compose.  The load therefore takes three steps:

  1. each range is read under both assumptions and leaves one small row: its state at
     the end under each, its bytes, and where the record open at its end started;
  2. the rows of each file are composed in order (a prefix scan over one row per
     range), which fixes the state each range starts in;
  3. each range is read again from its known state and owns the records that start in
     it; the few records that run into a further range are put together by their
     byte offset.

So one file is read by as many tasks as it has ranges, whatever its quotes.  A quote
opens a field only where the field starts: a stray quote inside an unquoted field is a
character like any other.  A quoted field that the file never closes is a reject of
its own, with the file, the byte offset and the cause; the lines it took are not
gathered.

Records and one row per range are written to the scratch folder, once.  Ranges are those
of Spark's text source (``spark.sql.files.maxPartitionBytes``); lines
end with a line feed, a carriage return before it outside quotes is dropped."""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: a table of this many ranges (some 200 bytes each) is broadcast; a larger one is joined
BROADCAST_RANGES = 500_000
#: bytes of a record whose quote stays open that a reject shows
SHOWN = 4096
OPEN_QUOTE, BAD_FIELD = "a quoted field is never closed", "a field does not convert"

#: the rest of a quoted field, up to and with its closing quote
_CLOSE = re.compile(rb'[^"]*+(?:""[^"]*+)*+"')
_BLANK = b" \t"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open after the line, given whether one is before it."""
    at = 0
    while True:
        if not inside:
            if line.find(b'"', at) < 0:
                return False
            while at < len(line) and line[at] in _BLANK:
                at += 1
            inside = line[at:at + 1] == b'"'
            at += inside
        if inside:
            m = _CLOSE.match(line, at)
            if m is None:
                return True
            at, inside = m.end(), False
        at = line.find(b",", at) + 1
        if at == 0:
            return False


def cells(record: bytes, unquoted_empty: str) -> list[str]:
    """The fields of a record, trimmed outside quotes; an unquoted empty field is ``unquoted_empty``."""
    if b'"' not in record:
        return [x.strip() or unquoted_empty for x in record.decode("utf-8", "replace").split(",")]
    out, at = [], 0
    while True:
        start = at
        while at < len(record) and record[at] in _BLANK:
            at += 1
        m = _CLOSE.match(record, at + 1) if record[at:at + 1] == b'"' else None
        end = record.find(b",", m.end() if m else at)
        stop = len(record) if end < 0 else end
        if m:
            text = record[at + 1:m.end() - 1].replace(b'""', b'"') + record[m.end():stop].rstrip()
            out.append(text.decode("utf-8", "replace"))
        else:
            out.append(record[start:stop].decode("utf-8", "replace").strip() or unquoted_empty)
        if end < 0:
            return out
        at = end + 1


def _lines(spark: SparkSession, root: str, pattern: str | None, paths: list[str] | None) -> DataFrame:
    """(file, start, line) of all CSV files; ``start`` names the range."""
    reader = spark.read.option("lineSep", "\n")
    rows = (reader.text(paths) if paths else reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    return rows.where(F.col("file").rlike(pattern)) if pattern else rows


def _runs(batches):
    """(file, start, lines) of rows that follow each other in one range."""
    for b in batches:
        file, start, lines = (b.column(i).to_pylist() for i in range(3))
        lo = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or start[i] != start[lo] or file[i] != file[lo]:
                yield file[lo], start[lo], lines[lo:i], lo, b
                lo = i


def _summaries(lines: DataFrame) -> DataFrame:
    """Step 1: one row per range."""
    def run(batches):
        at, row = None, None

        def batch():
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("file", pa.string()), ("start", pa.int64()), ("n_bytes", pa.int64()), ("out0", pa.bool_()), ("out1", pa.bool_()),
                ("open0", pa.int64()), ("open1", pa.int64()), ("header", pa.binary()), ("header_at", pa.int64()), ("print", pa.int64())]))

        for file, start, some, _, _ in _runs(batches):
            if (file, start) != at:
                if at:
                    yield batch()
                at = (file, start)
                # open0/open1: where in the range the open record started, under each assumption (-1: before it)
                row = {"file": file, "start": start, "n_bytes": 0, "out0": False, "out1": True, "open0": 0, "open1": -1,
                       "header": None if start else b"", "header_at": None, "print": 0}
                head = start == 0
            for line in some:
                row["print"] = zlib.crc32(line, row["print"])
                if not row["out0"]:
                    row["open0"] = row["n_bytes"]
                if not row["out1"]:
                    row["open1"] = row["n_bytes"]
                if head:
                    if row["header_at"] is None and (line.strip() and line.strip() != b"\xef\xbb\xbf"):
                        row["header_at"] = row["n_bytes"]
                    if row["header_at"] is not None:
                        row["header"] += line + b"\n"
                if b'"' in line:
                    row["out0"], row["out1"] = ends_inside(line, row["out0"]), ends_inside(line, row["out1"])
                if head and row["header_at"] is not None and not row["out0"]:
                    head = False
                row["n_bytes"] += len(line) + 1
        if at:
            yield batch()

    return lines.mapInArrow(run, "file string, start long, n_bytes long, out0 boolean, out1 boolean, open0 long, open1 long, "
                                 "header binary, header_at long, print long")


def _states(ranges: DataFrame) -> DataFrame:
    """Step 2: the state each range starts in, its byte offset in the file, the offset
    of the record open there, and whether that record is never closed.

    The maps of the ranges before it, composed: the last range with equal outcomes
    fixes the state, ranges after it keep or swap it.  Files are independent; one
    row per range is all that is sorted."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # a map is constant (fixes the state), the identity or a swap
    fixed = F.when(F.col("out0") == F.col("out1"), F.struct(F.col("start").alias("at"), F.col("out0").alias("state")))
    swaps = F.sum(((F.col("out0") != F.col("out1")) & F.col("out0")).cast("int"))
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    one = (ranges.withColumn("offset", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)))
           .withColumn("fix", F.last(fixed, ignorenulls=True).over(before)).withColumn("swapped", swaps.over(upto)))
    one = one.withColumn("after", F.last(F.when(F.col("out0") == F.col("out1"), F.col("swapped")), ignorenulls=True).over(before))
    turned = F.coalesce(F.lag("swapped").over(Window.partitionBy("file").orderBy("start")), F.lit(0)) - F.coalesce("after", F.lit(0))
    base = F.coalesce(F.col("fix.state"), F.lit(False))
    one = one.withColumn("inside", F.when(turned % 2 == 1, ~base).otherwise(base))
    out = F.when(F.col("inside"), F.col("out1")).otherwise(F.col("out0"))
    opened = F.when(F.col("inside"), F.col("open1")).otherwise(F.col("open0"))
    one = one.withColumn("out", out).withColumn("own", F.when(out & (opened >= 0), F.col("offset") + opened))
    whole = Window.partitionBy("file")
    in_order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = one.withColumn("open_at", F.last("own", ignorenulls=True).over(before))
    never = F.when(F.last("out").over(in_order), F.last("own", ignorenulls=True).over(in_order))
    head = F.max("header").over(whole)
    return one.select("file", "start", "offset", "inside", "open_at", never.alias("never"), head.alias("header"),
                      F.max("header_at").over(whole).alias("header_at"), "n_bytes", "print")


def _records(lines: DataFrame, states: DataFrame, few: bool, unquoted_empty: str) -> DataFrame:
    """Step 3: (file, at, part, cells, raw, open): whole records have cells; a part of
    a record that crosses ranges has its text, and the offset it starts at."""
    about = states.select("file", "start", "offset", "inside", "open_at", F.coalesce("never", F.lit(-1)).alias("never"), "header_at")
    if few:
        joined = lines.join(F.broadcast(about), ["file", "start"])
    else:           # a shuffled join loses the order of the lines
        joined = (lines.withColumn("line_no", F.monotonically_increasing_id()).join(about, ["file", "start"])
                  .repartition("file", "start").sortWithinPartitions("file", "start", "line_no"))
    schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("part", pa.int64()), ("cells", pa.list_(pa.string())),
                        ("raw", pa.binary()), ("open", pa.bool_())])

    def run(batches):
        here, info, pos, inside, tail = None, {}, 0, False, False
        held: list[bytes] = []      # lines of the record that is not complete
        held_at = size = 0
        rows: list[tuple] = []

        def end_of_range() -> None:
            if not held:
                return
            raw = b"\n".join(held) + b"\n"
            if tail:
                rows.append((here[0], info["open_at"], held_at, None, raw, False))
            else:
                rows.append((here[0], held_at, held_at, None, raw, held_at == info["never"]))

        def batch():
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for file, start, some, lo, b in _runs(batches):
            if (file, start) != here:
                end_of_range()
                here = (file, start)
                info = {c: b.column(b.schema.get_field_index(c))[lo].as_py() for c in ("offset", "inside", "open_at", "never", "header_at")}
                pos, inside, held = info["offset"], info["inside"], []
                tail = inside       # lines of a record that started before the range
            for line in some:
                if not held:
                    held_at, size = pos, 0
                lost = info["never"] == (info["open_at"] if tail else held_at) and info["never"] >= 0
                # of a record that is never closed only its beginning is kept
                if not lost or (not tail and size < SHOWN):
                    held.append(line)
                    size += len(line)
                pos += len(line) + 1
                if b'"' in line:
                    inside = ends_inside(line, inside)
                if inside:
                    continue
                record = held[0] if len(held) == 1 else b"\n".join(held)
                if tail:
                    rows.append((file, info["open_at"], held_at, None, record, False))
                elif held_at != info["header_at"]:
                    record = record.removesuffix(b"\r")
                    if record.strip():
                        rows.append((file, held_at, held_at, cells(record, unquoted_empty), None, False))
                tail, held = False, []
                if len(rows) >= 10_000:
                    yield batch()
        end_of_range()
        yield batch()

    kinds = "file string, at long, part long, cells array<string>, raw binary, open boolean"
    return joined.select("file", "start", "line", "offset", "inside", "open_at", "never", "header_at").mapInArrow(run, kinds)


def _parsed(rows: DataFrame, raw: str, unquoted_empty: str) -> DataFrame:
    """The rows with the fields of a text column instead of it."""
    kept = [(c, t) for c, t in rows.dtypes if c != raw]

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(raw)
            got = [None if x is None else cells(x.removeprefix(b"\xef\xbb\xbf").removesuffix(b"\n").removesuffix(b"\r"), unquoted_empty) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c, _ in kept], pa.array(got, pa.list_(pa.string()))],
                                             names=[*[c for c, _ in kept], "cells"])

    return rows.mapInArrow(run, ", ".join([*[f"`{c}` {t}" for c, t in kept], "cells array<string>"]))


def read_records(spark: SparkSession, root: str, scratch, unquoted_empty: str, pattern: str | None = None, paths: list[str] | None = None,
                 range_bytes: int | None = None, broadcast_ranges: int = BROADCAST_RANGES) -> tuple[DataFrame, DataFrame]:
    """(records, files): (file, at, cells, open) of every record but the headers, and
    (file, n_bytes, print, cells of the header) of every file with a line.  Both are
    written under ``scratch(name)`` here: the two passes must see the same ranges."""
    conf, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    if range_bytes:
        spark.conf.set(conf, str(range_bytes))
    try:
        lines = _lines(spark, root, pattern, paths)
        at = scratch("csv-ranges")
        _summaries(lines).write.parquet(at)
        ranges = spark.read.parquet(at)
        states = _states(ranges)
        at = scratch("csv-records")
        _records(lines, states, ranges.count() <= broadcast_ranges, unquoted_empty).write.parquet(at)
    finally:
        spark.conf.set(conf, before)
    rows = spark.read.parquet(at)
    whole = rows.where("raw IS NULL").select("file", "at", "cells", "open")
    # parts of one record come together by the offset of the record
    parts = (rows.where("raw IS NOT NULL").groupBy("file", "at")
             .agg(F.array_sort(F.collect_list(F.struct("part", "raw"))).alias("parts"), F.max("open").alias("open"))
             .select("file", "at", "open", F.array_join(F.transform("parts", lambda x: x["raw"].cast("string")), "").cast("binary").alias("raw")))
    about = states.groupBy("file").agg(F.max("header").alias("header"), F.sum("n_bytes").alias("n_bytes"),
                                       F.sum(F.col("print").cast("decimal(38,0)")).alias("print"))
    return whole.unionByName(_parsed(parts, "raw", unquoted_empty).select("file", "at", "cells", "open")), _parsed(about, "header", unquoted_empty)
