from __future__ import annotations

import random
from collections import Counter

import pytest

import adlift.llm.components as stars
from adlift.llm.components import components
import adlift.llm.near_dup as near_dup
from adlift.llm.near_dup import least_shared, near_duplicates
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n=4, threshold=80):
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, s) in enumerate(named):
        for j, t in named[a + 1 :]:
            common = len(s & t)
            if 100 * common >= threshold * (len(s) + len(t) - common):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    out = []
    for i, s in sets:
        component = i if i is None or not s else root(i)
        out.append((i, len(s), component, i is None or component == i))
    return Counter(out)


@pytest.mark.parametrize("shingle", [4, 5])
def test_edge_cases(docs, texts, no_docs, shingle):
    assert Counter(map(tuple, near_duplicates(docs, shingle).collect())) == brute(texts, shingle)
    assert near_duplicates(no_docs, shingle).collect() == []


def test_chains_and_common_passages(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows, words = [], [f"c{rng.randrange(10**6)}" for _ in range(90)]
    for i in range(40):  # a chain whose ends are not alike
        words = list(words)
        words[rng.randrange(90)] = f"n{i}"
        rows.append((i, " ".join(words)))
    for i in range(40, 110):  # one passage in new surroundings, some of them short
        rows.append((i, " ".join([*passage, *(f"u{i}_{k}" for k in range(rng.choice([0, 2, 6, 10, 40, 200])))])))
    for i in range(110, 140):
        rows.append((i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, near_duplicates(frame).collect())) == brute(rows)


def test_bound_of_shared_values():
    assert least_shared(64) in range(25, 45)
    assert least_shared(0) == 0


def test_components(spark):
    links = [(5, 4), (4, 3), (9, 8), (8, 10), (10, 11), (11, 2), (20, 20)] + [(100 + i, 101 + i) for i in range(60)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {5: 3, 4: 3, 3: 3, 9: 2, 8: 2, 10: 2, 11: 2, 2: 2} | {100 + i: 100 for i in range(61)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_deal_out_few_times(spark, monkeypatch):
    """A round took seven exchanges, and links that are stars already two rounds."""
    rounds = []

    def counted(df, name, run=stars.written):
        rounds.append(name)
        return run(df, name)

    monkeypatch.setattr(stars, "written", counted)
    links = [(i, 7) for i in range(8, 60)] + [(i, 3) for i in range(100, 160)] + [(8, 7), (7, 9), (None, 7), (7, None)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(4)
    want = {3: 3, 7: 7} | {i: 7 for i in range(8, 60)} | {i: 3 for i in range(100, 160)}
    assert Counter(map(tuple, components(frame).collect())) == Counter(want.items())
    assert rounds == ["stars"]
    one_round = stars._small_star(stars._large_star(frame))
    plan = one_round._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    nodes = rng.sample(range(10**6), 300)
    links = [tuple(rng.sample(nodes, 2)) for _ in range(rng.choice([120, 160, 400]))]
    links += rng.choices(links, k=40) + [(b, a) for a, b in links[:20]]
    root = {n: n for link in links for n in link}

    def top(n):
        return n if root[n] == n else top(root[n])

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    got = components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert Counter(map(tuple, got)) == Counter((n, top(n)) for n in root)


def test_the_job_takes_few_stages(spark):
    """Stages, each with its tasks and its share of the driver: 327 before on this input, 151 since."""
    rng, base = random.Random(6), [f"c{i}" for i in range(80)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"e{i}" for w in base)) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sc = spark.sparkContext
    sc.setJobGroup("few-stages", "near duplicates")
    assert Counter(map(tuple, near_duplicates(frame).collect())) == brute(rows)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    infos = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("few-stages")]
    assert len({s for i in infos for s in i.stageIds}) <= 170


def test_a_family_of_loose_edits(spark):
    """Many edits of one text, most of them not linked: lists far longer than those whose pairs are all compared."""
    rng = random.Random(8)
    base, rows = [f"c{i}" for i in range(120)], []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14])):
            words[rng.randrange(len(words))] = f"e{i}_{rng.randrange(99)}"
        rows.append((i, " ".join(words[: rng.choice([120, 118, 105])])))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, near_duplicates(frame).collect())) == brute(rows)


def test_turns_change_no_class(spark, docs, monkeypatch):
    found = []
    for turns in (0, 3):
        monkeypatch.setattr(near_dup, "TURNS", turns)
        found.append(sorted(map(str, near_dup.near_duplicates(docs).collect())))
    assert found[0] == found[1]


def test_stars_by_full_sets_leave_fewer_pairs(spark, monkeypatch):
    """Edits of a text that is not there; stars around arbitrary members compared 19,113 pairs of them."""
    rng, seen = random.Random(5), []
    base, rows = [f"c{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for k in range(rng.choice([1, 2, 2, 3, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"e{i}_{k}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"s{i}_{k}" for k in range(30))) for i in range(300)]
    verified = near_dup._verified

    def counted(pairs, texts, *others):
        seen.append((pairs.count(), texts.count()))
        return verified(pairs, texts, *others)

    monkeypatch.setattr(near_dup, "_verified", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, near_duplicates(frame).collect())) == brute(rows)
    assert sum(pairs for pairs, _ in seen) <= 15_000
    assert max(texts for _, texts in seen) <= 400  # texts that share no list are not dealt out again
