from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, key long, ledger string, kept boolean, component_id string, value int"
)


def _prose(rng: random.Random, words: int, base: int = 0) -> str:
    return " ".join(f"w{rng.randrange(base, base + 400)}" for _ in range(words))


@pytest.fixture(scope="session")
def texts() -> list[tuple]:
    """Ids with texts: copies, near copies, shared passages, repeated rows, nulls, empty and long ones."""
    rng = random.Random(5)
    out: list[tuple] = []
    bases = [_prose(rng, rng.randint(30, 120)) for _ in range(12)]
    passage = _prose(rng, 40, 1000)
    for base in bases:
        out.append(base)
        for _ in range(rng.randint(0, 4)):
            words = base.split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "changed"
            out.append(" ".join(words))
    out += [f"{_prose(rng, rng.randint(5, 60))} {passage}\n{_prose(rng, 20)}" for _ in range(10)]
    out += ["", None, " \t\n", "one", "one two", "One  TWO", "ab " * 300, "x" * 3000, "é" * 400, "naïve café " * 60]
    out += [bases[0], bases[0], _prose(rng, 20_000), "12 34 !!", "\x00a\x00 b", "日本語 テキスト " * 30]
    rng.shuffle(out)
    rows = list(enumerate(out))
    rows += [rows[3], rows[3], (rows[4][0], bases[1]), (None, bases[2]), (None, None), (None, "one two three")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a table with further columns, some of whose names the operators use inside."""
    langs, sources = ["en", "de", None], ["a", "b", None, "a", "a"]
    rows = [
        (i, t, langs[n % 3], sources[n % 5], None if t is None else len(t), "r", 1, "l", False, "c", 7)
        for n, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
