"""Chunks of the token files: which go to the library's model, equal ids, a bounded table."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from firmo.llm import token_store

WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
LETTERS = [*"aAzZtsdmlvre", *(chr(c) for c in range(0xA1, 0x100)), "́", "中", "Ａ", "²", "\x1c", "\xa0", "<|endoftext|>", "<|"]


def ids(enc, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in enc.encode([t.encode() for t in texts])]


@pytest.mark.parametrize("remember", [3, 400_000])
def test_chunks_of_all_signs_and_latin_letters_equal_the_library(monkeypatch, remember):
    monkeypatch.setattr(token_store, "REMEMBER", remember)
    rnd = random.Random(remember)
    pool = [SIGNS, LETTERS, [*"0123456789"], ["'s", "'", "n't", " "]]
    texts = ["".join(rnd.choice(rnd.choice(pool)) for _ in range(rnd.randint(1, 9))) for _ in range(4000)]
    texts += ["".join(rnd.choice("abÉß") for _ in range(n)) + s for n in (0, 1, 2, 70) for s in SIGNS + ["×", "÷,", "'s,", "...'"]]
    want = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert ids(token_store.Encoder(WORDS), texts) == want


def test_runs_of_letters_digits_and_signs_go_to_the_model_directly():
    text = "heinst$$$ été,### 555-84 lgda.92@mail0.example.com Über ... Straße!"
    want = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    enc = token_store.Encoder(WORDS)
    enc.whole = None
    assert ids(enc, [text]) == [want]


def test_the_table_keeps_no_long_chunk():
    enc = token_store.Encoder(WORDS)
    ids(enc, ["中" * 500 + " abc " + "b" * 5000])
    assert {len(c) for c in enc.chunks} == {3}


@pytest.mark.parametrize("n", [0, 1, token_store.PIECE - 1, token_store.PIECE, 2 * token_store.PIECE + 5])
def test_planes_by_pieces(n):
    x = np.random.default_rng(n).integers(0, 1 << 16, n)
    raw, about = token_store.pack_segment(x, 16)
    assert (token_store.unpack_segment(raw, about).tokens() == x).all()
