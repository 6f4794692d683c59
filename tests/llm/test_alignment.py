"""Cross-tokenizer alignment: against a plain version over whole texts."""
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from firmo.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RND = random.Random(9)
ALPHABET = [*"ab cde  \n\t'stré ïß中文😀١Ⅷ  \x1c\x1f\x85　.!<|0 9ʼ́İςΣ", "▁", "<|endoftext|>", "<s>", "'s", " the", "Don't ", "x1", "42", "\0"]
ODD = ["".join(RND.choice(ALPHABET) for _ in range(RND.randint(1, 60))) for _ in range(400)]


def plain_tokens():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    of = {chr(x if x in letters else next(spare)): x for x in range(256)}

    def both(text):
        e = a.encode(" " + text, add_special_tokens=False)
        x = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in e.ids]
        y = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        raw = (" " + text).encode()
        return (x, y) if text and b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])
    return both


def plain(rows):
    both, docs, holds = plain_tokens(), [], Counter()
    for doc_id, text in rows:
        x, y = both(text or "")
        spans = []
        for side in (x, y):
            at, out = 0, []
            for i, raw in side:
                out.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(out)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        cut, groups, links = set(ends), [], []
        parts = [[[]], [[]]]
        for out, side in zip(parts, spans):
            for s in side:
                out[-1].append(s)
                if s[2] in cut:
                    out.append([])
        for ga, gb in zip(parts[0][:-1], parts[1][:-1]):
            groups.append(",".join(str(s[0]) for s in ga) + "|" + ",".join(str(s[0]) for s in gb))
            links += [(p[0], q[0]) for p in ga for q in gb if p[1] < q[2] and q[1] < p[2]]
        holds.update(set(links))
        docs.append((doc_id, len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (p, _), n in holds.items():
        most[p] = max(most[p], n)
    return sorted(((d or -1, a, b, g, len(ls), sum(holds[x] == most[x[0]] for x in ls), sum(holds[x] for x in ls), sha)
                   for d, a, b, g, ls, sha in docs))


def got(df):
    return sorted((r[0] or -1, *r[1:]) for r in df.collect())


def test_units_and_ranges_cut_where_both_tokenizers_do():
    both, pair = plain_tokens(), al.load(A, B)
    for text in ODD[:200]:
        raw = (" " + text).encode()
        x, y = both(text)
        if not x:
            continue
        for chunk in (3, 7, 20):
            parts = list(al.ranges(raw, chunk))
            assert b"".join(p[2] for p in parts) == raw == b"".join(p[3] for p in parts)
            assert [i for p in parts if p[2] for i in pair.a_ids([p[2].decode()])[0]] == [i for i, _ in x]
            assert [i for p in parts if p[3] for i in pair.b_ids([p[3].decode()])[0]] == [i for i, _ in y]


def test_fragments_form_a_monoid():
    pair = al.load(A, B)
    for text in ODD[:150]:
        parts = list(al.ranges((" " + text).encode(), 5))
        frags, first = [], []
        for a_at, b_at, x, y in parts:
            f, closed = al.fragment(al.tokens(pair.a_ids([x.decode()])[0] if x else [], pair.a_size, a_at),
                                    al.tokens(pair.b_ids([y.decode()])[0] if y else [], pair.b_size, b_at))
            frags.append(f)
            first += closed
        results = set()
        for _ in range(6):
            have, closed = list(frags), list(first)
            while len(have) > 1:
                i = RND.randrange(len(have) - 1)
                f, more = al.join(have[i], have[i + 1])
                have[i:i + 2] = [f]
                closed += more
            groups = sorted((int(c[0][1][0]), al.groups_text(*c, al.common_ends(*c))) for c in [*closed, have[0].prefix])
            results.add((";".join(g for _, g in groups), have[0].suffix is None or len(have[0].suffix[0][0])))
        assert len(results) == 1


@pytest.mark.parametrize("chunk, table", [(1 << 16, 1 << 20), (40, 1 << 20), (40, 0)])
def test_equals_the_plain_version(spark, make_docs, chunk, table):
    rows = [(i, t) for i, t in enumerate(ODD[200:300], 1)] + [(500, None), (501, ""), (502, ODD[200]), (502, ODD[200]), (None, "no id 7a7"), (503, " ".join(ODD[:40])),
                                                              (504, "word " * 300 + "▁" + " word" * 50), (505, "no1space2at3all" * 40)]
    assert got(al.align(make_docs(rows).repartition(3), A, B, chunk, table)) == plain(rows)


def test_edge_tables(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(al.align(edge_docs, A, B)) == plain(rows)
    assert al.align(no_docs, A, B).count() == 0
