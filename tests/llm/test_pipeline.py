from __future__ import annotations

import os
import re
import subprocess
import sys
from collections import Counter

import pytest

import compare
import corpus_pipeline
from adlift.llm import queries, sql, stages
from odd_texts import docs, no_docs, texts  # noqa: F401  fixtures
from test_near_dup import brute as same_groups
from test_quality_rules import brute as measured
from test_substring_dedup import brute as without_repeats, ordered, ties_of

SMOKE = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
here = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="test tables not present")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, texts):
    path = str(tmp_path_factory.mktemp("tables"))
    passages = [(1, " ".join((t or "").split()[:20])) for i, t in texts[:6]] + [(2, None), (None, "one two three")]
    spark.createDataFrame(passages, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_quality_stage(spark, docs, texts):
    kept = stages.quality(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter(pairs(kept)) == Counter((i, t) for i, t in texts if measured(t)[-1] == 0)


def test_near_dup_stage(spark, docs, texts):
    kept = stages.near_dup(spark, docs, "")
    assert kept.columns == docs.columns
    component = {r[0]: r[2] for r in same_groups([(k, t) for k, (_, t) in enumerate(texts)], 5)}
    groups: dict[int, list] = {}
    for k, (i, _) in enumerate(texts):
        groups.setdefault(component[k], []).append(i)
    first = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert Counter(i for i, _ in pairs(kept)) == Counter(first)
    assert set(pairs(kept)) <= set(texts)


def test_near_dup_stage_with_repeated_and_missing_ids(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, one), (1, two), (None, one + " x"), (None, "c d e f g h"), (None, "c d e f g h"), (2, None), (2, None)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(3)
    kept = Counter(pairs(stages.near_dup(spark, docs, "")))
    assert kept == Counter([(1, one), (1, two), (None, "c d e f g h"), (2, None), (2, None)])


def test_passages_stage(spark, docs, texts):
    left = stages.passages(spark, docs, "")
    assert left.columns == docs.columns
    want = without_repeats(ordered(texts, ties_of(docs)))
    got = left.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in texts)
    untouched = Counter((i, t) for i, t in texts if want[i, t or ""][1] == 0)
    assert untouched <= Counter((r.doc_id, r.text) for r in got)
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)
    assert sum(len((r.text or "").encode()) for r in got) < sum(len((t or "").encode()) for _, t in texts)


def test_decontamination_stage(spark, docs, texts, folder):
    from adlift.llm.decontamination import contamination

    left = stages.decontaminate(spark, docs, folder)
    assert left.columns == docs.columns
    judged = contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()
    clean = [r.doc_id for r in judged if not r.contaminated]
    assert sorted(str(i) for i, _ in pairs(left)) == sorted(map(str, clean)) and len(clean) < len(texts)


def test_whole_pipeline_on_odd_rows(spark, docs, folder, no_docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, folder).collect() == []


@here
@pytest.mark.parametrize("name", sorted(sql.statements()))
def test_query_matches_sql(spark, name):
    assert compare.difference(queries.registered()[name](spark, SMOKE), compare.connect(SMOKE), sql.statements()[name]) == ""


@here
def test_one_query_per_operator(spark):
    from __spark_entry__ import oracle_sql, queries as entry

    numbers = [int(m[1]) for n in entry() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry()
    assert set(sql.statements()) <= set(oracle_sql())


def test_rest_stands_without_this_part(tmp_path):
    """The entry point still imports where the operators and the pipeline are taken out."""
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "adlift.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
assert e.queries() and not any(n.startswith("op1") or n == "pipeline" for n in e.queries())
"""
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0
