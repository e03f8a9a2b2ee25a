from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import adlift.llm.token_alignment as module
from adlift.llm.token_alignment import Tokenizers, alignment, lockstep, pieces_of
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    return Tokenizers(open(FILES[0], encoding="utf-8").read(), open(FILES[1], "rb").read())


def brute(both, rows):
    """Whole texts, one pair of tokens after the other."""
    links, groups = [], []
    for _, text in rows:
        a = both.a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        sides = [b"".join(table[i] for i in ids) for table, ids in ((both.a_bytes, a), (both.b_bytes, b))]
        if text and any(s != (" " + text).encode() for s in sides):
            a = b = []
        ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]) for t, ids in ((both.a_bytes, a), (both.b_bytes, b)))
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        said, lo = [], 0
        for cut in cuts:
            places = [(ids, *np.searchsorted(ends, [lo, cut], "right")) for ids, ends in ((a, ends_a), (b, ends_b))]
            side = [[str(i) for i in ids[x:y]] for ids, x, y in places]
            said.append("|".join(",".join(s) for s in side))
            lo = cut
        groups.append((len(a), len(b), said))
        begin_b = np.append(0, ends_b[:-1]) if len(b) else ends_b
        own, lo = Counter(), 0
        for i, end in zip(a, ends_a):
            for k in range(int(np.searchsorted(ends_b, lo, "right")), int(np.searchsorted(begin_b, end, "left"))):
                own[i, b[k]] += 1
            lo = end
        links.append(own)
    total = sum(links, Counter())
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for (doc, _), own, (n_a, n_b, said) in zip(rows, links, groups):
        best = sum(t for (a, b), t in own.items() if total[a, b] == most[b])
        digest = hashlib.sha256(";".join(said).encode()).hexdigest() if said else ""
        out.append((doc, n_a, n_b, len(said), sum(own.values()), best, sum(t * total[p] for p, t in own.items()), digest))
    return Counter(out)


def odd_rows(rng):
    pool = ["the", "quick", "Straße", "naïve", "日本語", "🙂🙂", "<|endoftext|>", "<s>", "</s>", "<0x41>", "12345", "don't", "\t", "\n\n", "   ", "é", "ﬁ", " ", "\x00", "'s", "a.b", "AB", "x" * 50]
    rows = [(i, rng.choice(["", " ", "  "]).join(rng.choice(pool) for _ in range(rng.randint(1, 60)))) for i in range(60)]
    rows += [(60 + i, " ".join(rng.choice(pool) for _ in range(1500))) for i in range(4)]
    return rows + [(70, "has ▁ inside"), (71, "▁"), (72, " leading"), (73, "trailing "), (74, "x" * 9000), (75, "ab " * 4000)]


@pytest.mark.parametrize(("frequent", "lane", "chunk", "row_pairs"), [(1 << 18, 2048, 1 << 20, 1 << 16), (40, 20, 500, 7), (0, 64, 64, 100)])
def test_against_whole_texts(spark, both, docs, texts, monkeypatch, frequent, lane, chunk, row_pairs):  # noqa: F811
    for name, value in (("LANE", lane), ("CHUNK", chunk), ("ROW_PAIRS", row_pairs)):
        monkeypatch.setattr(module, name, value)
    rows = texts + odd_rows(random.Random(3))
    extra = spark.createDataFrame(odd_rows(random.Random(3)), "doc_id long, text string")
    table = docs.unionByName(extra, allowMissingColumns=True)
    local = module.aligned  # the workers import the module anew: the settings must reach them
    if lane != 2048:
        table = table.repartition(2)
        monkeypatch.setattr(module, "aligned", lambda d, a, b: _aligned_here(d, both))
    got = Counter(tuple(r[c] for c in COLUMNS) for r in alignment(table, *FILES, frequent=frequent).collect())
    monkeypatch.setattr(module, "aligned", local)
    assert got == brute(both, rows)


def _aligned_here(rows, both):
    """The aligned rows computed in this process, where the module's settings are changed."""
    aligner, out = module.Aligner(both), []
    had = rows.collect()
    for r, own in zip(had, aligner.align([r.text or "" for r in had])):
        out += [{k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in row.items()} for row in own.rows(r.row_no, r.doc_id, aligner.n_b)]
    return rows.sparkSession.createDataFrame(out, module._ALIGNED_SQL), aligner.n_b


def test_pieces_end_where_both_tokenizers_end(both):
    rng = random.Random(4)
    for _, text in odd_rows(rng):
        pieces = pieces_of(text)
        assert " ".join(pieces) == text
        for k, whole in enumerate((both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text))):
            assert both.encode(pieces)[k][0].tolist() == whole
            assert both.encode(pieces[:1])[k][1].sum() == both.encode(pieces)[k][1][0]


def test_memory_of_pieces_starts_anew(both, monkeypatch):
    texts = [t for _, t in odd_rows(random.Random(6))]
    keep = [list(x.rows(0, 0, 32_000)) for x in module.Aligner(both).align(texts)]
    monkeypatch.setattr(module, "KEPT_TOKENS", 50)
    monkeypatch.setattr(module, "CHUNK", 300)
    again = [list(x.rows(0, 0, 32_000)) for x in module.Aligner(both).align(texts)]
    assert [[r["groups_sha256"] for r in x] for x in keep] == [[r["groups_sha256"] for r in x] for x in again]
    assert all((x["times"] == y["times"]).all() for xs, ys in zip(keep, again) for x, y in zip(xs, ys))


def test_lockstep_by_hand():
    # One lane with A ends 2, 5, 6 and B ends 3, 5, 6; an empty lane; one lane with a single token on both sides.
    a, b = np.array([2, 5, 6, 4]), np.array([3, 5, 6, 4])
    links_a, links_b, cut_a, cut_b = lockstep(a, b, np.array([0, 3, 3]), np.array([0, 3, 3]), np.array([3, 3, 4]))
    assert sorted(zip(links_a.tolist(), links_b.tolist())) == [(0, 0), (1, 0), (1, 1), (2, 2), (3, 3)]
    assert cut_a.tolist() == [False, True, True, True] == cut_b.tolist()


def test_empty_table(spark, no_docs):  # noqa: F811
    assert alignment(no_docs, *FILES).collect() == []
