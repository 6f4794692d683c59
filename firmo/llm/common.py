"""Shared helpers of the text operators: bounded blocks of Arrow batches, word
spans over UTF-8 bytes, stable 64-bit hashes and files under the shared folder."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmo.llm import files
from firmo.session import scratch_path

BLOCK_BYTES = 1 << 20
LONG = 64
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A-Z to a-z; every byte that is no word byte to 0.  Bytes of non-ASCII
#: characters are all 0x80 or more and are word bytes, so UTF-8 bytes can be
#: classified without decoding.
WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else (0 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c)
                   for c in range(256))

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(col: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one
    row: what a task holds at once does not depend on the batch size."""
    for batch in batches:
        n = batch.num_rows
        size = np.asarray(pc.fill_null(pc.binary_length(column(batch, text)), 0)).astype(np.int64)
        at = 0
        while at < n:
            upto = int(np.searchsorted(np.cumsum(size[at:at + 4096]), limit, side="right"))
            upto = max(1, min(upto, n - at))
            yield batch.slice(at, upto)
            at += upto


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([column(batch, k) for k in keep] + list(new.values()), names=[*keep, *new])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator needs; further columns of any name are left out."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that every bit of the result depends on every bit of h."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        base = np.full(max(n, BLOCK_BYTES + 4096), _P if kind == "up" else _PINV, dtype=np.uint64)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if n <= 4 * BLOCK_BYTES:
            _powers[kind] = have
    return have[:n]


class Words:
    """Word spans of a list of texts: words are maximal runs of word bytes after
    lower-casing A-Z.  ``starts``/``ends`` are byte positions in ``raw``;
    ``first[i]:first[i + 1]`` are the words of text i."""

    def __init__(self, texts: list[bytes]) -> None:
        self.raw = b"\0".join(texts) + b"\0"
        self.low = np.frombuffer(self.raw.translate(WORD_TABLE), dtype=np.uint8)
        inside = np.zeros(len(self.low) + 1, dtype=np.int8)
        inside[1:] = self.low != 0
        step = np.diff(inside)
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.at = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.first = np.searchsorted(self.starts, self.at)
        self._sums: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the lower-cased bytes of each span, alike in every process.
        Sums of powers modulo 2^64 are equal by construction for some pairs of spans
        of 2^10 letters and more, so spans over ``LONG`` bytes take a digest; two
        different spans are equal with odds of about 2^-64."""
        if self._sums is None:
            sums = np.zeros(len(self.low) + 1, dtype=np.uint64)
            np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * _power("up", len(self.low)), out=sums[1:])
            self._sums = sums
        h = (self._sums[ends] - self._sums[starts]) * _power("down", len(self._sums))[starts]
        h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        long = np.flatnonzero(ends - starts > LONG)
        if len(long):
            raw = self.low.data
            h[long] = [int.from_bytes(hashlib.blake2b(raw[a:b], digest_size=8).digest(), "little")
                       for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        return h

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)


def find_sorted(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Position of each value in the sorted table, -1 where absent.  A bit table
    over the leading bits drops most absent values before the binary search."""
    out = np.full(len(values), -1, dtype=np.int64)
    if len(table) == 0 or len(values) == 0:
        return out
    seen = np.zeros(1 << 20, dtype=bool)
    seen[table >> np.uint64(44)] = True
    some = np.flatnonzero(seen[values >> np.uint64(44)])
    v = values[some]
    p = np.minimum(np.searchsorted(table, v), len(table) - 1)
    ok = table[p] == v
    out[some[ok]] = p[ok]
    return out


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder that all executors share."""
    return scratch_path(spark, f"llm-{name}")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, as a zip in the shared folder, once for
    each application: tasks must not rely on a path of the driver's machine.  Where
    the session has Spark's default of 10,000 rows for an Arrow batch, take 1,000:
    rows are whole texts here, and a batch exists several times on its way."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    if sc.applicationId not in _shipped:
        import firmo
        root = Path(firmo.__file__).parent
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, f"firmo/{p.relative_to(root)}")
        uri = f"{shared_dir(spark, 'code')}/firmo.zip"
        files.put(uri, [held.getvalue()])
        sc.addPyFile(uri)
        _shipped.add(sc.applicationId)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back.  A lost
    executor then costs the reread of a file, not the work before it."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(col: str, divisor: int):
    """crc32 of the id as text, modulo divisor: the split of labelled rows."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(divisor))


def fitting(sizes: list[tuple[int, int]], max_bytes: int) -> list[int]:
    """Ids of (id, size) rows that hold at most ``max_bytes`` together, in the
    order given; a row that does not fit is skipped.  Rows over a 64th of the bytes
    come after all others, so that few long rows do not take the place of many; if
    no row fits, the smallest is taken."""
    chosen, total = [], 0
    for i, size in sorted(sizes, key=lambda r: r[1] > max_bytes // 64):
        if total + size <= max_bytes:
            total += size
            chosen.append(i)
    return chosen or [i for i, _ in sorted(sizes, key=lambda r: r[1])[:1]]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int,
                    rows: int, max_bytes: int) -> DataFrame:
    """A bounded training sample: at most ``rows`` labelled documents outside the
    held-out remainder, at most ``max_bytes`` of text, chosen by the hash of the
    id.  Only (id, size, label) of at most ``rows`` rows reach the driver."""
    marks = (pick(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .where(remainder("doc_id", divisor) != held_out)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    by_hash = [F.xxhash64(F.col("doc_id"), F.lit(divisor)), F.col("doc_id")]
    ids = marks.orderBy(*by_hash).limit(rows)
    # one scan of the texts; what it finds, at most ``rows`` documents, is written
    found = written(pick(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id")
                    .groupBy("doc_id", "y").agg(F.max(F.coalesce("text", F.lit(""))).alias("text")), "sample")
    sizes = [(r["doc_id"], r["size"]) for r in found.select("doc_id", F.octet_length("text").alias("size")).orderBy(*by_hash).collect()]
    chosen = [(i,) for i in fitting(sizes, max_bytes)]
    few = docs.sparkSession.createDataFrame(chosen, "doc_id long")
    return found.join(F.broadcast(few), "doc_id")
