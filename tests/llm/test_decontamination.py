from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import adlift.llm.decontamination as module
from adlift.llm.decontamination import contamination
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            own = words(passage)
            n = min(13, len(own))
            windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return Counter(out)


def items_and_texts():
    rng = random.Random(6)
    items = [(i, " ".join(f"b{rng.randrange(60)}" for _ in range(rng.choice([1, 2, 3, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(3, items[4][1]), (None, items[5][1]), (99, None), (98, "?!"), (97, ""), (96, "Ünï codé Wörds")]
    rows = []
    for i in range(60):
        own = [f"d{rng.randrange(500)}" for _ in range(rng.choice([0, 3, 40, 400]))]
        for _ in range(rng.randint(0, 3)):
            passage = (items[rng.randrange(25)][1] or "").split()
            cut = rng.randint(0, 2)
            at = rng.randint(0, len(own))
            own[at:at] = passage[cut:] if rng.random() < 0.5 else passage
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(own).upper() if i % 3 else " ".join(own)))
    return items, rows + [(7, "x " + items[7][1]), (None, items[14][1]), (None, None), (61, "ünï CODÉ wörds ünï codé wörds")]


@pytest.mark.parametrize("block", [200_000, 7])
def test_against_every_window(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK", block)
    items, rows = items_and_texts()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, row_no long")
    got = contamination(docs.repartition(3), benchmark).drop("text_key").collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == brute(rows, items)


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(not r.contaminated and r.n_hit == 0 for r in contamination(docs, none).collect())
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert contamination(no_docs, some).collect() == []


def test_a_mirror_of_a_long_item(spark):
    """Runs are cut into pieces: their size grows with the run, not with its square."""
    rng = random.Random(8)
    passage = [f"w{rng.randrange(5000)}" for _ in range(16_000)]
    rows = [(i, " ".join(passage[: 16_000 - i])) for i in range(4)] + [(9, "x " + " ".join(passage[500:513]))]
    benchmark = spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string")
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), benchmark)
    assert {(r.doc_id, r.n_words, r.n_hit) for r in got.collect()} == {
        (i, 16_000 - i, 16_000 - i) for i in range(4)
    } | {(9, 14, 13)}
