from __future__ import annotations

import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from adlift.llm.token_counts import ByteMerges, token_counts  # noqa: E402
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def merges():
    with open(FILE, encoding="utf-8") as f:
        return ByteMerges(f.read())


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_random_texts(library, merges):
    rng = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'ll", "é", "1", "23", "!!", "<|endoftext|>", "\x1c"]
    parts += ["漢", "　", "\x85", "\xa0", "T", "😀", "ing", "'", "<|endo"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert merges.count(text) == count(library, text), repr(text)


def test_every_kind_of_character(library, merges):
    for code in [*range(0x3000), *range(0xD7A0, 0xD800), *range(0xE000, 0xE010), *range(0x1F600, 0x1F650)]:
        text = f"a{chr(code)}1 {chr(code)} b'{chr(code)}{chr(code)}  {chr(code)}"
        assert merges.count(text) == count(library, text), hex(code)


def test_long_runs(library, merges):
    for text in ("a" * 20_000, "ab" * 9_000, " " * 5_000, "é" * 7_000):
        assert merges.count(text) == count(library, text)


def test_table(spark, library, docs, texts, no_docs):
    rows = token_counts(docs, FILE).collect()
    want = []
    for i, text in texts:
        n = count(library, text)
        want.append((i, len((text or "").encode()), n, n > 1024))
    assert Counter(map(tuple, rows)) == Counter(want)
    assert token_counts(no_docs, FILE).collect() == []


def test_long_regular_words_are_told_apart():
    """Thue-Morse words and their complements, which agree in every sum of odd powers modulo 2**64."""
    import numpy as np

    from adlift.llm.textbytes import word_hashes

    for size in (64, 128, 256, 512, 1024, 2048, 4096):
        bits = np.array([bin(i).count("1") & 1 for i in range(size)], np.uint8)
        data = np.concatenate([bits + 97, 98 - bits])
        one, two = word_hashes(data, np.array([0, size]), np.array([size, 2 * size]))
        assert one != two
