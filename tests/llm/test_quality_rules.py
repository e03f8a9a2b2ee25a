from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from adlift.llm.quality_rules import POLICIES, RULES, ablations, fails, ledger, mask
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 8)}
    m = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)),
    }
    failed = (
        m["n_words"] < 20,
        100 * m["n_repeat_words"] > 30 * m["n_words"],
        10 * m["n_symbols"] > m["n_words"],
        m["n_lines"] >= 4 and 2 * m["n_dup_lines"] > m["n_lines"],
        2 * m["n_upper"] > m["word_chars"],
        m["word_chars"] > 40 * m["n_words"],
    )
    return (*m.values(), sum(1 << i for i, f in enumerate(failed) if f))


EXTRA = ["a b c d e f g h a b c d e f g h", "LOUD " * 40, "l1 x\nl1 x\n\n \nl1 x\nl2\nl1 x", "a#b $c %d " * 9]


def test_ledger(spark, docs, texts, no_docs):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(EXTRA)], "doc_id long, text string")
    rows = texts + [(1000 + i, t) for i, t in enumerate(EXTRA)]
    found = ledger(docs.select("doc_id", "text").unionByName(more)).select("doc_id", "ledger.*").collect()
    assert Counter(map(tuple, found)) == Counter((i, *brute(t)) for i, t in rows)
    assert ledger(no_docs).collect() == []


def test_plan_is_native(spark):
    docs = spark.range(3).selectExpr("id as doc_id", "cast(id as string) as text")
    plan = ledger(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_policies_and_ablations(spark):
    bits = [0, 0, 1, 1, 2, 3, 4, 12, 16]
    table = spark.createDataFrame([(b,) for b in bits], "failures long")
    for policy, names in POLICIES.items():
        own = {r.name: 1 << i for i, r in enumerate(RULES) if r.name in names}
        assert mask(policy) == sum(own.values())
        kept = table.where(~fails(F.col("failures"), policy)).count()
        assert kept == sum(not b & mask(policy) for b in bits)
        got = {r.rule: r for r in ablations(table, policy).collect()}
        for name, bit in own.items():
            seen = [b & mask(policy) for b in bits]
            want = (sum(b & bit > 0 for b in seen), sum(b == bit for b in seen), sum(b in (0, bit) for b in seen))
            assert tuple(got[name])[1:] == want
