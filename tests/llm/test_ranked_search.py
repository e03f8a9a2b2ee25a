from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import adlift.llm.ranked_search as module
from adlift.llm.ranked_search import blocks, search
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    held = [(i, Counter(terms(t))) for i, t in rows]
    n_docs = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out.update((item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:10]))
    return out


def tables(seed=2):
    rng = random.Random(seed)
    words = [f"t{int(rng.expovariate(0.02))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 30, 30, 200])))) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)] + [(None, rows[8][1]), (9, rows[9][1]), (9, rows[9][1])]
    rng.shuffle(rows)
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 30])))) for i in range(25)]
    items += [(30, rows[7][1]), (31, rows[8][1]), (32, "T1 t1 T1"), (33, "nowhere t1"), (33, "nowhere t1"), (None, "t2"), (34, None), (35, " ?! "), (36, "unheard")]
    return rows, items


@pytest.mark.parametrize(("parts", "seed_share"), [(3, 16), (1, 1), (7, 1000)])
def test_against_every_document(spark, parts, seed_share):
    rows, items = tables()
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, row_no long").repartition(parts)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id long")
    got = search(table, asked, seed_share).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute(rows, items)


def test_passes(spark, monkeypatch):
    monkeypatch.setattr(module, "PASS_TERMS", 40)
    rows, items = tables(5)
    got = search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()) == brute(rows, items)


def test_odd_texts(spark, docs, texts, no_docs):  # noqa: F811
    items = [(n, t) for n, (_, t) in enumerate(texts[:30])]
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in search(docs, asked).collect())
    assert got == brute(texts, items)
    assert search(no_docs, asked).collect() == []
    assert search(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_small_blocks_and_groups(monkeypatch):
    """Shards, groups and blocks of any size give the same best documents, with and without a start."""
    rng = np.random.default_rng(3)
    impacts = rng.integers(1, 10**6, (300, 40)) * (rng.random((300, 40)) < 0.2)
    weights = rng.integers(1, 9000, (40, 12)) * (rng.random((40, 12)) < 0.3)
    ids, numbers = np.arange(300) % 150, np.arange(300)
    scores = impacts @ weights
    for size, start in ((4, 1), (32, 1), (10**6, 1), (8, 10**9)):
        monkeypatch.setattr(module, "BLOCK", size)
        group = module._Group(np.arange(12), np.arange(40), weights.astype(np.float64), np.full(12, start))
        for lo in range(0, 300, 70):
            part = slice(lo, lo + 70)
            module.search_shard(impacts[part].astype(np.float32), ids[part], numbers[part], group)
        for q in range(12):
            want = sorted((-int(s), int(i), int(n)) for s, i, n in zip(scores[:, q], ids, numbers) if s >= start)[:10]
            assert group.best.rows[q] == want


def test_blocks_hold_every_member_once_and_like_documents_together():
    rng = np.random.default_rng(1)
    kind = rng.integers(0, 2, 200)
    place = np.where(kind[:, None] == 1, [1.0, 0.0], [0.0, 1.0]) + rng.normal(0, 0.05, (200, 2))
    place /= np.linalg.norm(place, axis=1, keepdims=True)
    members = np.flatnonzero(rng.random(200) < 0.9)
    listed, starts = blocks(place, members)
    assert sorted(listed) == members.tolist() and len(starts) >= 2
    alike = [len(set(kind[b])) == 1 for b in np.split(listed, starts[1:])]
    assert sum(alike) >= len(alike) - 1
