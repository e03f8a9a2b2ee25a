from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import adlift.llm.substring_dedup as module
from adlift.llm.substring_dedup import remove_repeats
from adlift.llm.suffix_order import common_prefixes, smaller_than_next, suffix_order
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures


def test_suffix_order():
    rng = random.Random(2)
    for _ in range(800):
        letters = rng.choice([b"ab", b"\x00a\xff", bytes(range(256))])
        text = bytes(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        if rng.random() < 0.4:
            text = (text[: rng.randint(1, 8)] * 40)[: len(text)]
        data, length = np.frombuffer(text, np.uint8), rng.choice([8, 16, 100])
        order = suffix_order(data, length)
        keys = [text[i : i + length].ljust(length, b"\0") for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)
        shared = common_prefixes(data, order, length)
        for i in range(1, len(text)):
            same = next((k for k in range(length) if keys[i - 1][k] != keys[i][k]), length)
            assert shared[i] == same


def test_types():
    text = b"banana"
    want = [text[i:] < text[i + 1 :] for i in range(6)]
    assert smaller_than_next(np.frombuffer(text, np.uint8)).tolist() == want


def brute(rows):
    """Per (id, text): bytes, removed bytes, runs and what is left, with ties as the operator orders them."""
    seen, out = set(), {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - 99):
            window = raw[j : j + 100]
            if window in seen:
                gone[j : j + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out[i, text or ""] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def ordered(rows, ties):
    """Distinct (id, text), null ids last, ids with several texts in the order of the texts' hashes."""
    distinct = {(i, t or "") for i, t in rows}
    return sorted(distinct, key=lambda r: (r[0] is None, r[0] or 0, ties[r[1]]))


def ties_of(docs):
    hashed = docs.selectExpr("coalesce(text, '') as t", "xxhash64(coalesce(text, '')) & 2147483647 as h").collect()
    return {r.t: r.h for r in hashed}


def ordered_fully(rows, docs):
    """As ``ordered``, for hashes whose lowest 31 bits may be equal."""
    hashed = docs.selectExpr("text", "xxhash64(text) as h").distinct().collect()
    ties = {r.text: (r.h & 0x7FFFFFFF, (r.h >> 31) & 0x1FFFFFFFF) for r in hashed}
    return sorted(set(rows), key=lambda r: (r[0], ties[r[1]]))


@pytest.mark.parametrize("small", [False, True])
def test_against_every_window(spark, docs, texts, no_docs, monkeypatch, small):
    if small:  # pieces, minimizers that are too common for a task, and batches of a few texts
        monkeypatch.setattr(module, "MANY_BYTES", 2_000)
        monkeypatch.setattr(module, "PIECE", 700)
        monkeypatch.setattr(module, "TOGETHER", 3_000)
        monkeypatch.setattr(module, "_HELD", 50)
        monkeypatch.setattr(module, "MANY_DIGESTS", 2)
        monkeypatch.setattr(module, "SALTS", 3)
    got = [tuple(r) for r in remove_repeats(docs).collect()]
    want = brute(ordered(texts, ties_of(docs)))
    assert Counter(got) == Counter((i, *want[i, t or ""]) for i, t in texts)
    assert remove_repeats(no_docs).collect() == []


def test_windows_that_repeat_inside(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        part = "".join(rng.choice("abc ") for _ in range(rng.choice([3, 17, 40, 90, 130])))
        rows.append((i, (part * rng.randint(1, 9))[: rng.randint(50, 700)] + rng.choice(["", "zz", "é" * 60])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert Counter(map(tuple, remove_repeats(docs).collect())) == Counter((i, *want[i, t]) for i, t in rows)


@pytest.mark.parametrize("most, many", [(2, 1 << 21), (2, 0), (5, 3_000), (64, 0)])
def test_one_minimizer_in_ever_new_surroundings(spark, monkeypatch, most, many):
    monkeypatch.setattr(module, "MANY_DIGESTS", most)
    monkeypatch.setattr(module, "MANY_BYTES", many)
    monkeypatch.setattr(module, "_HELD", 60)
    monkeypatch.setattr(module, "SALTS", 4)
    rng = random.Random(most * 7 + many)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common, fixed = "=" * 40, [word(90) for _ in range(4)]
    rows = []
    for i in range(150):
        left, right = (rng.choice(fixed) if rng.random() < 0.3 else word(90) for _ in range(2))
        rows.append((rng.randint(1, 120), left + common + right))
    rows += [rows[3], rows[3], (7, common * 5), (8, common * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(ordered_fully(rows, docs))
    assert Counter(map(tuple, remove_repeats(docs).collect())) == Counter((i, *want[i, t]) for i, t in rows)


def test_what_is_left_is_text(docs):
    rows = remove_repeats(docs, carry=["doc_id", "lang"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert len(r.kept.encode()) <= r.n_bytes - r.n_removed and "�" not in r.kept


@pytest.mark.parametrize("one, other", [(130_858, 305_959), (52_407, 113_863)])
def test_texts_without_id_whose_hashes_end_alike(spark, one, other):
    def text(n):
        digests = [hashlib.sha512(str(k).encode()).hexdigest() for k in (n, -n)]
        return digests[0] if n % 2 == 0 else "".join(digests)

    # The lowest 31 bits of the hashes are equal; only the second text repeats what came before.
    rows = [(1, text(other)), (None, text(one)), (None, text(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(set(ties_of(docs).values())) == 1
    want = brute(rows)
    assert Counter(map(tuple, remove_repeats(docs).collect())) == Counter((i, *want[i, t]) for i, t in rows)
