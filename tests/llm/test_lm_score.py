from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from adlift.llm.lm_score import ORDER, corpus_scores, score
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def words(text):
    return (text or "").encode().lower().split()


class Model:
    """The same model, symbol by symbol."""

    def __init__(self, texts):
        self.words, self.trie = Counter(), [defaultdict(Counter) for _ in range(ORDER + 1)]
        for text in texts:
            self.words.update([*words(text), None])
            codes = self.codes(text)
            for p in range(ORDER, len(codes)):
                for k in range(ORDER + 1):
                    self.trie[k][tuple(codes[p - k : p])][codes[p]] += 1

    def codes(self, text):
        return [257] * ORDER + list(b" ".join(words(text))) + [256]

    def symbol(self, context, s):
        value, excluded = 0.0, set()
        for k in range(ORDER, -1, -1):
            nexts = {x: n for x, n in self.trie[k].get(tuple(context[ORDER - k :]), {}).items() if x not in excluded}
            if not nexts:
                continue
            mass = 2 * sum(nexts.values())
            if s in nexts:
                return value + math.log10((2 * nexts[s] - 1) / mass)
            value += math.log10(len(nexts) / mass)
            excluded |= set(nexts)
        return value - math.log10(257 - len(excluded))

    def row(self, i, text):
        tokens, codes = [*words(text), None], self.codes(text)
        n, v = sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words[t] + 1) / (n + v + 1)) for t in tokens)
        total = sum(self.symbol(codes[p - ORDER : p], codes[p]) for p in range(ORDER, len(codes)))
        return i, len(tokens), sum(self.words[t] > 0 for t in tokens), n, base, total


def key(row):
    return (row[0] is None, row[0] or 0, row[1], row[4])


def same(got, want):
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9) and g[5] == pytest.approx(w[5], rel=1e-9)


@pytest.mark.parametrize("head", [1 << 20, 40])
def test_against_symbol_by_symbol(docs, texts, head):
    rows = [(i, t) for i, t in texts if not t or len(t) < 5_000]
    short = docs.where("text is null or length(text) < 5000")
    learned = Model([t for i, t in rows if not held(i)])
    train = short.where("pmod(crc32(cast(coalesce(cast(doc_id as string), '') as binary)), 7) <> 2")
    same(score(short, train, head).collect(), [learned.row(i, t) for i, t in rows])


def test_split_and_nothing_to_learn(spark, docs, no_docs):
    got = corpus_scores(docs).select("doc_id", "held_out").collect()
    assert len(got) == docs.count() and all(r.held_out == held(r.doc_id) for r in got)
    assert corpus_scores(no_docs).collect() == []
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    empty = Model([])
    same(score(frame, frame.limit(0)).collect(), [empty.row(1, "a b"), empty.row(2, None)])


def test_long_text_is_read_in_pieces(spark, monkeypatch):
    import adlift.llm.lm_score as module

    text = "abc def " * 300
    got = [list(g) for g in module._segments(module._canonical(text)[0])]
    monkeypatch.setattr(module, "PIECE", 100)
    pieces = list(module._segments(module._canonical(text)[0]))
    assert len(pieces) > 20
    joined = [int(x) for p in pieces for x in module._grams(p)]
    assert joined == [int(x) for x in module._grams(module.np.array(got[0]))]
