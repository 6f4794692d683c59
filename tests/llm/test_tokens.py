"""BPE, token files and WARC archives: against the library and exact round trips."""
import base64
import hashlib
import gzip
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from firmo.llm import bpe, files, token_store, warc
from firmo.llm.common import shared_dir

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RND = random.Random(4)
ALPHABET = [*"ab cd  \n\t'stré ïß中文😀١Ⅷ  \x1c\x1f\x85　.!<|0 9ʼ́İςΣÀÖ×÷", "<|endoftext|>", "<|startoftext|>", "'s", " the", "Don't "]
ODD = ["".join(RND.choice(ALPHABET) for _ in range(RND.randint(0, 40))) for _ in range(3000)] + ["", "a" * 3000, "ab" * 777 + " " * 50 + "x", " ", "\n"]


def test_bpe_equals_the_library():
    lib, own = Tokenizer.from_file(BYTES), bpe.Bpe(BYTES)
    got = own.encode([t.encode() for t in ODD])
    want = [e.ids for e in lib.encode_batch(ODD, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert [own.decode(x) for x in got] == ODD


def test_segment_trees_agree():
    own = bpe.Bpe(BYTES)
    words = [bytes(RND.choice(b"thereionsg ") for _ in range(RND.randint(1, 64))) for _ in range(300)]
    assert own.merge_rows(words, 64) == [own.merge_long(w) for w in words]


def test_bpe_tables(edge_docs, no_docs):
    lib = Tokenizer.from_file(BYTES)
    texts = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect()]
    want = sorted((d or -1, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                  for d, t in texts for i in [lib.encode(t, add_special_tokens=False).ids])
    got = sorted((r[0] or -1, *r[1:]) for r in bpe.round_trip(edge_docs, BYTES).collect())
    assert got == want
    back = bpe.decode(bpe.encode(edge_docs, BYTES), BYTES)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back.collect()) == sorted((d or -1, t) for d, t in texts)
    assert bpe.round_trip(no_docs, BYTES).count() == 0


def test_library_chunks_equal_whole_texts():
    lib, own = Tokenizer.from_file(WORDS), token_store.Encoder(WORDS)
    want = [e.ids for e in lib.encode_batch(ODD, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in ODD])] == want


@pytest.mark.parametrize("n, top, bits", [(1, 2, 1), (5000, 300, 9), (20011, 49408, 16), (700, 100_000, 17)])
def test_wavelet_matrix(n, top, bits):
    ids = np.random.default_rng(n).integers(0, top, n)
    raw, about = token_store.pack_segment(ids, bits)
    w = token_store.unpack_segment(raw, about)
    assert (w.tokens() == ids).all()
    assert [w.access(i) for i in range(0, n, 97)] == ids[::97].tolist()
    for t in {int(ids[0]), int(ids[-1]), top - 1, 0}:
        assert w.occurrences(t) == np.flatnonzero(ids == t).tolist()
        assert w.count(t, n // 3, n - n // 5) == int((ids[n // 3:n - n // 5] == t).sum())
    assert w.count(1 << bits) == 0


@pytest.mark.parametrize("segment", [token_store.SEGMENT, 50])
def test_token_files(spark, edge_docs, no_docs, segment, monkeypatch):
    monkeypatch.setattr(token_store.ShardWriter.__init__, "__defaults__", (segment,))
    lib = Tokenizer.from_file(WORDS)
    rows = sorted(((r["doc_id"], r["text"]) for r in edge_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for d, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_store.query(edge_docs, WORDS).collect()), key=lambda r: r[1])
    assert got == want
    assert token_store.query(no_docs, WORDS).count() == 0


def test_tokens_are_found_in_the_files(spark, make_docs):
    docs = make_docs([(i, "the cat sat on the mat " * 3) for i in range(9)])
    made = token_store.write(docs, WORDS, shared_dir(spark, "t"), 1).collect()
    shards = token_store.shard_table(spark, made)
    ends = sorted(r[0] for r in token_store.find(shards, 1).collect())
    rows = token_store.read_documents(shards).collect()
    assert ends == sorted(r["start"] + r["n_tokens"] - 1 for r in rows)


PAGES = "page_id long, url string, html string, uri string, size long"


def expected(rows):
    first = {}
    for i, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out, seen = [], set()
    for i, h in rows:
        raw = (h or "").encode()
        to = first.get(h or "")
        again = to is not None and (i != to or (i, h or "") in seen) and [x or "" for _, x in rows].count(h or "") > 1
        seen.add((i, h or ""))
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [warc.SPLIT, 700, 64])
def test_warc_round_trip(spark, split):
    r = np.random.default_rng(1)
    noise = "".join(chr(c) for c in r.integers(32, 0x250, 4000))
    rows = [(i, RND.choice([noise[:n] for n in (0, 10, 900, 4000)]) + str(i % 7)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, ""), (60, "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 9), (61, "twice"), (61, "twice"), (None, "twice"), (None, "only without id")]
    pages = spark.createDataFrame([(i, "http://a b/\r\n" if i == 3 else f"http://x/{i}", h, "u", 1) for i, h in rows], PAGES)
    got = sorted((tuple(x) for x in warc.query(pages, split).collect()), key=str)
    assert got == expected(rows)


def test_warc_payloads_come_back(spark):
    rows = [(i, f"<p>{'é' * i}</p>") for i in range(30)]
    pages = spark.createDataFrame([(i, None, h, None, None) for i, h in rows], PAGES)
    made = [(r["uri"], r["size"]) for r in warc.write(pages, shared_dir(spark, "w")).collect()]
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read(spark, made, 500).collect()}
    assert got == dict(rows)
    assert warc.query(spark.createDataFrame([], PAGES)).count() == 0


def test_archives_are_read_by_a_plain_parser(spark):
    """Members one after the other, headers that the format demands, blocks of their length."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"body {i % 3}", None, None) for i in range(9)], PAGES)
    kinds = []
    for r in warc.write(pages, shared_dir(spark, "plain"), 2, date="2020-02-03T04:05:06Z").collect():
        raw = gzip.decompress(files.read(r["uri"]))
        first = True
        while raw:
            head, raw = raw.split(b"\r\n\r\n", 1)
            version, *lines = head.decode().split("\r\n")
            have = dict(x.split(": ", 1) for x in lines)
            assert version == "WARC/1.1"
            assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(have)
            assert have["WARC-Date"] == "2020-02-03T04:05:06Z" and first == (have["WARC-Type"] == "warcinfo")
            n = int(have["Content-Length"])
            assert raw[n:n + 4] == b"\r\n\r\n"
            raw, first = raw[n + 4:], False
            kinds.append(have["WARC-Type"])
    assert sorted(k for k in kinds if k != "warcinfo") == ["response"] * 3 + ["revisit"] * 6
