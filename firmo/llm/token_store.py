"""Token files: a wavelet matrix per shard.

Documents are dealt to shards by ranges of doc_id and each shard is written to
one file, in ascending doc_id order.  A file holds segments of whole documents
(about ``SEGMENT`` tokens, so that a task's memory does not grow with the
shard); a segment is a wavelet matrix: one bit-plane for each bit of the ids,
most significant first, each plane stably parted by the plane above.  With the
counts of ones before each block of a plane, rank and select answer ``access``,
``count`` and ``occurrences`` from the file alone; unwinding the planes from the
last to the first gives back all ids.

Layout of a file (integers little-endian):
  magic ``FWMX1``; segments, one after the other; directory (JSON); its length
  as 8 bytes; magic.  A segment: zstd frames of the planes' packed bits.

Edge cases: a null or empty text has the end id alone; rows with a null doc_id
come first; rows with equal doc_id are ordered by their text; an empty table
writes no shard and gives no row."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmo.llm import files
from firmo.llm.common import blocks, column, pick, shared_dir, utf8

MAGIC = b"FWMX1"
SEGMENT = 1 << 21
BLOCK = 512          # bits for each rank sample
PIECE = 1 << 16      # ids parted at a time
REMEMBER = 400_000


class Wavelet:
    """A wavelet matrix over ids of ``bits`` bits."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int) -> None:
        self.planes, self.zeros, self.n = planes, zeros, n
        self._samples: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> Wavelet:
        x = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (x & x.dtype.type(1 << level)) != 0
            planes.append(np.packbits(bit))
            off, y = ~bit, np.empty_like(x)
            a, b = 0, len(x) - int(np.count_nonzero(bit))
            zeros.append(b)
            # by pieces, so that their positions stay in the cache
            for at in range(0, len(x), PIECE):
                some = x[at:at + PIECE]
                down, up = np.flatnonzero(off[at:at + PIECE]), np.flatnonzero(bit[at:at + PIECE])
                np.take(some, down, out=y[a:a + len(down)], mode="clip")
                np.take(some, up, out=y[b:b + len(up)], mode="clip")
                a, b = a + len(down), b + len(up)
            x = y
        return cls(planes, zeros, len(ids))

    def tokens(self) -> np.ndarray:
        """All ids in order."""
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for level, (plane, z) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = np.unpackbits(plane, count=self.n).view(bool)
            off, y = ~bit, np.empty(self.n, kind)
            x[z:] |= kind(1 << level)
            a, b = 0, z
            for at in range(0, self.n, PIECE):
                down, up = np.flatnonzero(off[at:at + PIECE]), np.flatnonzero(bit[at:at + PIECE])
                some = y[at:at + PIECE]
                some[down], some[up] = x[a:a + len(down)], x[b:b + len(up)]
                a, b = a + len(down), b + len(up)
            x = y
        return x

    # -- rank and select --------------------------------------------------
    def samples(self) -> list[np.ndarray]:
        """Ones before each block of each plane."""
        if self._samples is None:
            out = []
            for p in self.planes:
                ones = np.unpackbits(p).reshape(-1, 8).sum(1)
                per = np.add.reduceat(ones, np.arange(0, len(ones), BLOCK // 8)) if len(ones) else np.zeros(0, int)
                out.append(np.concatenate([[0], np.cumsum(per)]).astype(np.int64))
            self._samples = out
        return self._samples

    def rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b = i // BLOCK
        part = self.planes[level][b * BLOCK // 8:(i + 7) // 8]
        return int(self.samples()[level][b]) + int(np.unpackbits(part)[:i - b * BLOCK].sum())

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        ones = self.samples()[level]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        b = min(int(np.searchsorted(before, k, side="right")) - 1, len(ones) - 2)
        part = np.unpackbits(self.planes[level][b * BLOCK // 8:(b + 1) * BLOCK // 8])
        return b * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[b])])

    def access(self, i: int) -> int:
        out = 0
        for level, z in enumerate(self.zeros):
            r = self.rank1(level, i)
            bit = self.rank1(level, i + 1) - r
            out = out << 1 | bit
            i = z + r if bit else i - r
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        bits = len(self.planes)
        if token >> bits:
            return 0, 0
        for level, z in enumerate(self.zeros):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (z + a, z + b) if token >> (bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in positions lo to hi."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def occurrences(self, token: int) -> list[int]:
        """Positions of an id, ascending."""
        a, b = self._range(token, 0, self.n)
        out = []
        for i in range(a, b):
            for level in range(len(self.planes) - 1, -1, -1):
                bit = token >> (len(self.planes) - 1 - level) & 1
                i = self.select(level, bit, i - self.zeros[level] if bit else i)
            out.append(i)
        return sorted(out)


# -- encoding by the library ----------------------------------------------

def byte_letters() -> dict[int, str]:
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(spare)) for b in range(256)}


class Chunks(dict):
    """Ids of chunks, made by ``make`` when first asked for.  Two generations, so
    that the table stays bounded and frequent chunks stay in it; chunks over
    ``LONGEST`` bytes are not kept."""

    LONGEST = 64

    def __init__(self, make: Callable[[bytes], bytes]) -> None:
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, c: bytes) -> bytes:
        got = self.older.get(c)
        if got is None:
            got = self.make(c)
        if len(c) <= self.LONGEST:
            if len(self) >= REMEMBER:
                self.older = dict(self)
                self.clear()
            self[c] = got
        return got


class Encoder:
    """ids of texts as the tokenizers library gives them.  The library cuts texts
    at white space and lower-cases them, then cuts them into runs of letters, single
    digits and runs of other signs; chunks between ASCII white space are encoded by
    it once and remembered in a bounded table.  Of a chunk of Latin letters, ASCII
    digits and signs the runs go to the library's model directly; chunks with an
    apostrophe (it has endings as 's of its own), with what may be a special token
    or with any other character go through its whole chain."""

    LATIN = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
    OWN = re.compile("[!-&(-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
    RUNS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")
    SIGNS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27)
    LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.bits = max(1, (size - 1).bit_length())
        self.four = [i.to_bytes(4, "little") for i in range(size)]
        letter = byte_letters()
        self.letters = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}
        self.chunks = Chunks(self._ids)

    def _model(self, letters: str) -> bytes:
        four = self.four
        return b"".join([four[t.id] for t in self.model.tokenize(letters)])

    def _ids(self, c: bytes) -> bytes:
        """Ids of a chunk."""
        if c.isalpha() and c.islower():
            return self._model(c.decode())
        if b"<|" not in c:
            head = c.rstrip(self.SIGNS)
            if not head:
                return self._model(c.decode())
            # after a letter or digit the closing signs are a run of their own; C3 leads
            # the letters from U+00C0 to U+00FF and two signs
            if len(head) < len(c) and (head[-1:].isalnum() or head[-2:-1] == b"\xc3" and head[-1] not in b"\x97\xb7"):
                return self.chunks[head] + self.chunks[c[len(head):]]
            s = c.decode()
            if self.LATIN.fullmatch(s):
                return self._model(s.lower().translate(self.letters))
            if self.OWN.fullmatch(s):
                return b"".join([self.chunks[r.encode()] for r in self.RUNS.findall(s.lower())]) if len(s) > 1 else self._model(s)
        return b"".join(map(self.four.__getitem__, self.whole.encode_batch_fast([c.decode()], add_special_tokens=False)[0].ids))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        get = self.chunks.__getitem__
        # capitals go first where no string of a special token can arise from it
        return [b"".join(map(get, (t if b"<|" in t else t.translate(self.LOWER)).split())) for t in texts]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


# -- shard files --------------------------------------------------------------

def pack_segment(ids: np.ndarray, bits: int) -> tuple[bytes, dict]:
    w = Wavelet.build(ids, bits)
    frames = [zstandard.ZstdCompressor(level=1).compress(p.tobytes()) for p in w.planes]
    return b"".join(frames), {"tokens": w.n, "zeros": w.zeros, "frames": [len(f) for f in frames]}


def unpack_segment(raw: bytes, about: dict) -> Wavelet:
    planes, at = [], 0
    for n in about["frames"]:
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[at:at + n], max_output_size=about["tokens"] // 8 + 1), dtype=np.uint8))
        at += n
    return Wavelet(planes, about["zeros"], about["tokens"])


class ShardWriter:
    """Parts of one shard file, made while documents arrive in order."""

    def __init__(self, bits: int, segment: int = SEGMENT) -> None:
        self.bits, self.segment = bits, segment
        self.segments: list[dict] = []
        self.ids: list[bytes] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held = self.tokens = self.n_docs = 0

    def add(self, doc_id: int | None, ids: bytes):
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids) // 4))
        self.held += len(ids) // 4
        if self.held >= self.segment:
            yield self.flush()

    def flush(self) -> bytes:
        raw, about = pack_segment(np.frombuffer(b"".join(self.ids), dtype="<u4"), self.bits)
        self.segments.append(about | {"size": len(raw), "doc_ids": [d for d, _ in self.docs], "lengths": [n for _, n in self.docs]})
        self.tokens += self.held
        self.n_docs += len(self.docs)
        self.ids, self.docs, self.held = [], [], 0
        return raw

    def close(self):
        if self.docs:
            yield self.flush()
        tail = zlib.compress(json.dumps(self.segments).encode(), 1)
        yield tail + len(tail).to_bytes(8, "little") + MAGIC


def segments(uri: str):
    """(directory entry, wavelet matrix) of each segment of a shard file, one at a time."""
    size = files.size(uri)
    with files.reader(uri) as f:
        f.seek(size - len(MAGIC) - 8)
        end = f.read(len(MAGIC) + 8)
        if end[8:] != MAGIC:
            raise ValueError(f"{uri}: not a token file")
        n = int.from_bytes(end[:8], "little")
        f.seek(size - len(MAGIC) - 8 - n)
        about = json.loads(zlib.decompress(f.read(n)))
        f.seek(len(MAGIC))
        for a in about:
            yield a, unpack_segment(f.read(a["size"]), a)


def write(docs: DataFrame, path: str, out: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Write shard files under ``out`` and return one small row for each:
    shard, uri, n_docs, n_tokens.  One shuffle, of the texts by doc_id range;
    ``shards`` defaults to the session's shuffle partitions."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    need = pick(docs, "doc_id", "text")
    dealt = (need.repartitionByRange(n, F.col("doc_id").asc_nulls_first())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))

    def run(batches):
        shard = TaskContext.get().partitionId()
        enc = encoder(path)
        writer, end = ShardWriter(enc.bits), np.array([end_id], dtype="<u4").tobytes()

        def parts():
            yield MAGIC
            for b in batches_:
                for d, x in zip(column(b, "doc_id").to_pylist(), enc.encode(utf8(column(b, "text"))), strict=True):
                    yield from writer.add(d, x + end)
            yield from writer.close()

        batches_ = blocks(batches, "text")
        first = next(batches_, None)
        if first is None:
            return
        batches_ = _chain(first, batches_)
        uri = f"{out}/shard-{shard:07d}.wm"
        files.put(uri, parts())
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([uri]), pa.array([writer.n_docs], pa.int64()), pa.array([writer.tokens], pa.int64())],
                                         names=["shard", "uri", "n_docs", "n_tokens"])

    return dealt.mapInArrow(run, "shard long, uri string, n_docs long, n_tokens long")


def _chain(first, rest):
    yield first
    yield from rest


def shard_table(spark: SparkSession, made: list) -> DataFrame:
    """One row per shard with the number of ids in all shards before it."""
    rows, start = [], 0
    for r in sorted(made, key=lambda r: r["shard"]):
        rows.append((r["shard"], r["uri"], start))
        start += r["n_tokens"]
    return spark.createDataFrame(rows, "shard long, uri string, start long").repartition(max(1, len(rows)))


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches):
        for b in batches:
            for uri, start in zip(column(b, "uri").to_pylist(), column(b, "start").to_pylist(), strict=True):
                for about, wavelet in segments(uri):
                    ids = wavelet.tokens().astype("<u4")
                    n = np.array(about["lengths"], dtype=np.int64)
                    at = np.concatenate([[0], np.cumsum(n)])
                    crc = [zlib.crc32(ids[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(about["doc_ids"], pa.int64()), pa.array(start + at[:-1]), pa.array(n), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    start += int(at[-1])

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def find(shards: DataFrame, token: int) -> DataFrame:
    """(position,) of every occurrence of an id over all shards, by select."""
    def run(batches):
        for b in batches:
            for uri, start in zip(column(b, "uri").to_pylist(), column(b, "start").to_pylist(), strict=True):
                for _, wavelet in segments(uri):
                    yield pa.RecordBatch.from_arrays([pa.array([start + i for i in wavelet.occurrences(token)], pa.int64())], names=["position"])
                    start += wavelet.n

    return shards.mapInArrow(run, "position long")


def query(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    spark = docs.sparkSession
    # one small row per shard comes to the driver; the ids stay in the files
    made = write(docs, path, shared_dir(spark, "tokens"), end_id).collect()
    return read_documents(shard_table(spark, made))
