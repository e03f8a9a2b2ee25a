"""Rule bitmask ledger: every quality rule evaluated once, verdicts by policy afterwards.

``ledger`` adds the measurements of a text and one long whose bit i says that
rule i failed. A policy is a named, versioned set of rules; applying one, or
another, is a bitwise AND with the ledger and never touches the text again.
``ablations`` counts, for each rule of a policy, what it rejects, what only it
rejects, and what would stay without it, from the few distinct bit patterns.

Only DataFrame functions, no shuffle for the ledger. Null and empty texts have
no words: all measurements are 0 and the rule on few words fails. Repeated rows
each get their verdict; null ids pass through. Work per text is linear but for
the sort of the windows of texts that repeat themselves.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


@dataclass(frozen=True)
class Rule:
    """``fails`` gets a function from a measurement's name to its column."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


#: A rule's bit is its place here: append, never reorder.
RULES = (
    Rule("few_words", lambda m: m("n_words") < 20),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines"))),
    Rule("shouting", lambda m: 2 * m("n_upper") > m("word_chars")),
    Rule("long_words", lambda m: m("word_chars") > 40 * m("n_words")),
)
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "full-1": tuple(r.name for r in RULES),
}


def mask(policy: str) -> int:
    """The bits of a policy."""
    names = [r.name for r in RULES]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also inside the lambdas of ``use``."""
    return F.transform(F.array(value), use)[0]


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more."""

    def places(pairs: Column) -> Column:
        same = lambda j, k: F.get(pairs, j)["h"] == F.get(pairs, k)["h"]
        twice = F.filter(
            F.sequence(F.lit(0), F.size(pairs) - 1),
            lambda j: F.coalesce(same(j, j - 1), F.lit(False)) | F.coalesce(same(j, j + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(twice, lambda j: F.get(pairs, j)["i"]))

    def words(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(pairs, places), words)


def _repeat_words(words: Column) -> Column:
    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def repeated(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h))

    return _let(words, lambda w: F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(_let(hashes(w), repeated)))


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measurements(text: Column) -> Column:
    """A struct of the measurements of a text."""
    white = "\t\n\x0b\x0c\r"
    body = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(F.translate(body, white, " " * 5), " "), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda line: _without(line, white + " ") != "")

    def counted(line: Column) -> Column:
        total = F.size(line).cast("long")
        return F.struct(total.alias("n_lines"), (total - F.size(F.array_distinct(line))).alias("n_dup_lines"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"))

    both = F.struct(_let(words, of_words).alias("w"), _let(lines, counted).alias("l"))
    length = F.length(body).cast("long")
    return _let(
        both,
        lambda s: F.struct(
            s["w"]["n_words"].alias("n_words"),
            F.length(_without(body, white + " ")).cast("long").alias("word_chars"),
            (length - F.length(_without(body, "#*$%&|<>"))).alias("n_symbols"),
            s["l"]["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"),
            s["l"]["n_lines"].alias("n_lines"),
            (length - F.length(_without(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).alias("n_upper"),
        ),
    )


def ledger(docs: DataFrame, text: str = "text", out: str = "ledger") -> DataFrame:
    """The rows with one struct column more: the measurements and ``failures``, a bit for each failed rule."""

    def with_bits(m: Column) -> Column:
        bits = F.lit(0).cast("long")
        for i, rule in enumerate(RULES):
            failed = rule.fails(lambda name: m[name])
            bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.struct(*[m[name].alias(name) for name in MEASURES], bits.alias("failures"))

    return docs.withColumn(out, _let(measurements(docs[text]), with_bits))


def fails(failures: Column, policy: str) -> Column:
    """Whether the ledger's bits break any rule of the policy."""
    return failures.bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(failures: DataFrame, policy: str, column: str = "failures") -> DataFrame:
    """Per rule of a policy: rejected, rejected by it alone, and kept by the policy without it."""
    bound = mask(policy)
    patterns = failures.groupBy(F.coalesce(F.col(column), F.lit(0)).bitwiseAND(F.lit(bound)).alias("bits")).count()
    rows = [(r.name, 1 << i) for i, r in enumerate(RULES) if bound >> i & 1]
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).alias("bit")) for n, b in rows]))
    each = patterns.select("bits", "count", kinds.alias("r")).select("bits", "count", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    sums = lambda test: F.sum(F.when(test, F.col("count")).otherwise(0))
    return each.groupBy("rule").agg(
        sums(hit).alias("rejected"),
        sums(alone).alias("rejected_alone"),
        sums((F.col("bits") == 0) | alone).alias("kept_without"),
    )
