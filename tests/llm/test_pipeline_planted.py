"""Each stage, and ``run``, against plain Python on a table with planted cases: exact and
near copies, benchmark passages, toxic texts, personal data and clean texts beside them."""
import hashlib
import random
import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "er", "ion", "ou", "ist", "ade", "um")]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    r = random.Random(17)

    def sentence(n):
        return " ".join(r.choice(VOCABULARY) for _ in range(n)).capitalize() + "."

    def body(n):
        return [sentence(r.randint(6, 12)) for _ in range(n)]

    items = [" ".join(body(5)) for _ in range(6)]
    docs, labels, kind = {}, [], {}

    def add(text, name, toxic=0):
        i = len(docs)
        docs[i], kind[i] = text, name
        labels.append((i, 1, toxic))

    for _ in range(260):
        add(" ".join(body(r.randint(2, 12))), "clean")
    for _ in range(70):
        text = body(r.randint(2, 12))
        text[r.randrange(len(text))] = f"{sentence(3)} vermin {sentence(2)}"
        add(" ".join(text), "toxic", 1)
    for i in range(12):
        add(docs[i], "copy")
        add(docs[i].upper().replace(".", " !"), "copy")          # the same words
    for i in range(20, 32):
        w = " ".join(body(14)).split()
        add(" ".join(w), "clean")
        for at in (5, len(w) - 4):                                # one word of many differs
            add(" ".join([*w[:at], "changed", *w[at + 1:]]), "near")
    for item in items[:3]:
        add(" ".join(body(2)) + " " + item + " " + sentence(7), "contaminated")
        short = " ".join(item.split()[3:17])
        add(" ".join(body(40)) + " " + short + " " + " ".join(body(40)), "touched")
    for i in range(8):
        add(" ".join(body(3)) + f" Write to person{i}.{VOCABULARY[i]}@mail{i}.example.org soon. " + sentence(6), "personal")
    folder = str(tmp_path_factory.mktemp("planted"))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    tables, docs_df = {}, spark.read.parquet(f"{folder}/documents.parquet")
    tables["input"] = dict(docs)
    for name, stage in C.STAGES:
        docs_df = C.written(stage(spark, docs_df, folder), f"planted-{name}")
        tables[name] = sorted(map(tuple, docs_df.collect())) if name == "bpe" else {x["doc_id"]: x["text"] for x in docs_df.collect()}
        tables[f"{name} columns"] = docs_df.columns
    return folder, items, kind, tables


def test_toxic_rows_go_and_clean_ones_stay(planted):
    _, _, kind, t = planted
    assert set(t["toxicity"]) == {i for i, k in kind.items() if k != "toxic"}
    assert all(t["toxicity"][i] == t["input"][i] for i in t["toxicity"])


def test_one_of_each_group_stays(planted):
    _, _, _, t = planted
    before, root = t["toxicity"], {i: i for i in t["toxicity"]}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: runs(x) for i, x in before.items()}
    ids = sorted(sets)
    for p, a in enumerate(ids):
        for b in ids[p + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    keep = {i for i in ids if find(i) == i}
    assert len(keep) < len(ids) - 30
    assert t["near_duplicates"] == {i: before[i] for i in keep}


def test_benchmark_windows_are_cut_or_their_rows_go(planted):
    _, items, kind, t = planted
    windows = {tuple(w[i:i + 13]) for w in map(words, items) for i in range(len(w) - 12)}
    want, touched = {}, 0
    for i, text in t["near_duplicates"].items():
        w, hit = words(text), set()
        for a in range(len(w) - 12):
            if tuple(w[a:a + 13]) in windows:
                hit |= set(range(a, a + 13))
        if not hit or 20 * len(hit) < len(w):
            want[i] = [x for a, x in enumerate(w) if a not in hit]
            touched += bool(hit)
    got = t["decontamination"]
    assert {i: words(x) for i, x in got.items()} == want and touched == 3
    assert not any(kind[i] == "contaminated" for i in got)
    assert all(got[i] == t["near_duplicates"][i] for i in got if len(words(got[i])) == len(words(t["near_duplicates"][i])))


def test_addresses_are_replaced_and_nothing_else(planted):
    _, _, kind, t = planted
    before, after = t["decontamination"], t["pii"]
    assert set(before) == set(after)
    for i, text in before.items():
        plain = EMAIL.sub("[EMAIL]", text)
        assert after[i] == plain, kind[i]
    assert sum("[EMAIL]" in x for x in after.values()) == 8


def test_token_counts_and_digests_are_the_librarys(planted):
    _, _, _, t = planted
    coder = Tokenizer.from_file(str(C.VOCABULARY))
    coder.no_padding()
    coder.no_truncation()
    want = []
    for i, text in t["pii"].items():
        ids = coder.encode(text, add_special_tokens=False).ids
        back = coder.decode(ids, skip_special_tokens=False)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    at = [t["bpe columns"].index(c) for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")]
    assert sorted(tuple(row[c] for c in at) for row in t["bpe"]) == sorted(want)


def test_run_applies_the_stages_in_order(spark, planted):
    folder, _, _, t = planted
    assert sorted(map(tuple, C.run(spark, folder).collect())) == t["bpe"]
