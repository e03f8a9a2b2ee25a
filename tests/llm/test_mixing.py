from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from adlift.llm.mixing import _feistel, mix, shard_draws, targets
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

np = pytest.importorskip("numpy")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left, open_weight = total - sum(fixed.values()), sum(weight[s] for s in rest)
        over = {s: most * sizes[s] for s in rest if left * weight[s] / open_weight >= most * sizes[s]}
        if not over:
            return fixed | {s: left * weight[s] / open_weight for s in rest}
        fixed |= over


def test_targets(spark):
    rng = random.Random(2)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 20_000]) for i in range(rng.randint(2, 12))} | {None: 77}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        want = brute_targets(sizes)
        for r in targets(rows).collect():
            assert r.target == pytest.approx(want[r.source], abs=1e-6)


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(_feistel(np.arange(n), n, 99)) == list(range(n))
    assert list(_feistel(np.arange(1000), 1000, 99)) != list(_feistel(np.arange(1000), 1000, 98))


def words(text):
    return len((text or "").encode().split())


def check(rows, got, block):
    size = Counter()
    for _, text, source in rows:
        size[source] += words(text)
    want, taken = brute_targets(size), defaultdict(int)
    assert Counter((i, words(t), s) for i, t, s in rows) == Counter((r.doc_id, r["size"], r.source) for r in got)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source in want:
        assert abs(taken[source] - want[source]) <= 2 * block + 1


@pytest.mark.parametrize("block", [1, 7, 64])
def test_mix(docs, block):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mix(docs, block=block, shard_words=500)[0].collect()
    check(rows, got, block)
    again = mix(docs.repartition(3), block=block, shard_words=500)[0].collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_slots_follow_the_draws(docs, no_docs):
    slots = mix(docs, block=16, shard_words=200)[1].collect()
    by_source = defaultdict(list)
    for s in slots:
        by_source[s.source].append(s.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_source.values())
    assert len({s.shard for s in slots}) > 10
    assert max(Counter((s.source, s.block_no) for s in slots).values()) <= 2
    assert mix(no_docs)[0].collect() == [] and mix(no_docs)[1].collect() == []


def test_draws_over_many_shards_add_up(spark):
    plan = spark.createDataFrame([("a", 100_000), (None, 7)], "source string, slots long")
    got = shard_draws(plan, 5000, 1).collect()
    for source, slots in (("a", 100_000), (None, 7)):
        own = sorted((r["first"], r.slots) for r in got if r.source == source)
        assert sum(n for _, n in own) == slots
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
