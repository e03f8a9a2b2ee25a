"""Mixing sources to target weights by blocks of tokens.

The words of a source, document after document in a fixed pseudorandom order,
form one stream that is cut into blocks of ``block`` words. A source's target
(its share by weight, at most ``most`` times its size) becomes a number of
slots. Every output shard draws how many slots it takes from each source: the
draws are multinomial over the shards, given the sources' totals, so that the
mix meets its targets instead of scattering around them. A source's slots are
numbered across shards; slot j takes block ``permutation(j mod n)`` of its
n blocks, under a new pseudorandom permutation each time the source starts
over. Slots and blocks meet in a join on (source, block).

Places of words come from two levels of running sums over hash buckets of the
ids, so that a source with a third of all rows is not one task's work. The
number of buckets follows the square root of the rows.

Null texts count no words; a null source is a source of its own, last in the
order that deals the weights; null ids and repeated rows are rows like others;
an empty table gives an empty mix. Reruns agree: everything is a function of
ids, texts and the seed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK = 256
#: Words of one output shard.
SHARD_WORDS = 1 << 22
_ROUNDS = 4


def word_count(text):
    """Words of a text between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source its target: ``share`` of all words by weight, never above ``most`` times its size.

    ``sizes`` has a row per source (source, source_size). With ratios r = most *
    size / weight in ascending order, the sources that stop at their limit are a
    prefix of that order; the rest share what is left by weight, which is what
    resharing round after round comes to. Running sums over the sources only.
    """
    order = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * most).alias("limit")
    rows = sizes.select("source", "source_size", weight.alias("weight"), limit)
    every = W.partitionBy()
    before = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        W.unboundedPreceding, -1
    )
    budget = F.sum("source_size").over(every) * share
    rows = rows.select(
        "*",
        budget.alias("budget"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open_weight"),
        (F.coalesce(F.sum("limit").over(before), F.lit(0.0))).alias("spent"),
    )
    level = (F.col("budget") - F.col("spent")) / F.col("open_weight")
    rows = rows.withColumn("stops", level * F.col("weight") >= F.col("limit"))
    free = F.max(F.when(~F.col("stops"), level)).over(every)
    target = F.when(F.col("stops"), F.col("limit")).otherwise(free * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(target, F.col("limit")).alias("target"))


def _feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at the given places: a Feistel network that walks past n."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for i in range(_ROUNDS):
            mixed = (right + np.uint64((key + i * 0x9E3779B97F4A7C15) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & low)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _seed(*parts) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """Few small rows that stand for much work, dealt over all tasks."""
    # With a count, adaptive execution does not merge the partitions again.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def shard_draws(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """Per source and output shard the slots drawn: (source, shard, first, slots); first numbers them across shards.

    A multinomial over the shards for each source, drawn by halving: the slots of
    a range of shards split binomially between its halves, so that the draw of
    any range is made where it is needed, down to ranges of ``leaf`` shards.
    """
    leaf = 1024

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for source, lo, hi, first, slots in zip(rows.source, rows.lo, rows.hi, rows["first"], rows.slots):
                rng = np.random.default_rng(_seed(seed, source, lo, hi))
                counts = rng.multinomial(slots, np.full(hi - lo, 1 / (hi - lo)))
                starts = first + np.concatenate([[0], np.cumsum(counts)[:-1]])
                out.append(
                    pd.DataFrame({"source": source, "shard": np.arange(lo, hi), "first": starts, "slots": counts})
                )
            yield pd.concat(out).query("slots > 0") if out else pd.DataFrame(
                {"source": [], "shard": [], "first": [], "slots": []}
            )

    def halve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for source, lo, hi, first, slots in zip(rows.source, rows.lo, rows.hi, rows["first"], rows.slots):
                if hi - lo <= leaf:
                    out.append((source, lo, hi, first, slots))
                    continue
                middle = (lo + hi) // 2
                rng = np.random.default_rng(_seed(seed, source, lo, hi, "half"))
                left = int(rng.binomial(slots, (middle - lo) / (hi - lo)))
                out += [(source, lo, middle, first, left), (source, middle, hi, first + left, slots - left)]
            yield pd.DataFrame(out, columns=["source", "lo", "hi", "first", "slots"])

    ranges = plan.select(
        "source", F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.lit(0).cast("long").alias("first"), "slots"
    )
    for _ in range(max(0, math.ceil(math.log2(max(1, shards / leaf))))):
        ranges = ranges.mapInPandas(halve, "source string, lo int, hi int, first long, slots long")
    return _spread(ranges, "source", "lo").mapInPandas(split, "source string, shard int, first long, slots long")


def _slot_blocks(draws: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Every slot with its block: (source, shard, slot, block_no)."""
    numbered = draws.join(plan.select("source", "n_blocks"), draws.source.eqNullSafe(plan.source)).select(
        draws.source, "shard", "first", "slots", "n_blocks"
    )
    step = 1 << 16
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(step).cast("long")))
    numbered = numbered.withColumn("at", cut).select(
        "source", "shard", "n_blocks",
        (F.col("first") + F.col("at")).alias("first"), F.least(F.lit(step), F.col("slots") - F.col("at")).alias("slots"),
    )

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for source, shard, n, first, slots in zip(
                rows.source, rows.shard, rows.n_blocks, rows["first"], rows.slots
            ):
                slot = np.arange(first, first + slots)
                block = np.empty(len(slot), np.int64)
                for epoch in range(first // n, (first + slots - 1) // n + 1):
                    own = slot // n == epoch
                    block[own] = _feistel(slot[own] % n, int(n), _seed(seed, source, int(epoch)))
                yield pd.DataFrame({"source": source, "shard": shard, "slot": slot, "block_no": block})

    return _spread(numbered, "source", "first").mapInPandas(placed, "source string, shard int, slot long, block_no long")


def _positions(sized: DataFrame) -> DataFrame:
    """Adds ``start``, the words of the same source before a document, by running sums on two levels."""
    rows = sized.count()
    buckets = 1 << max(0, math.isqrt(max(1, rows)).bit_length())
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "tie"), F.lit(buckets)))
    totals = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")).alias("offset")
    )
    inside = W.partitionBy("source", "bucket").orderBy("doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    local = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    same = local.source.eqNullSafe(offsets.source) & (local.bucket == offsets.bucket)
    return local.join(offsets, same).select(
        "doc_id", local.source, "size", local.bucket, (F.col("offset") + F.col("inside")).alias("start")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix as (documents, slots).

    documents: doc_id, source, size, source_size, target, taken for every row.
    slots: source, shard, slot, block_no, words: what each output shard reads.
    """
    ship_package(docs.sparkSession)
    sized = written(
        docs.select(
            docs[doc_id].cast("long").alias("doc_id"),
            docs[source].cast("string").alias("source"),
            word_count(docs[text].cast("string")).alias("size"),
            F.xxhash64(docs[text].cast("string")).alias("tie"),  # rows without an id, or with one id
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    n_blocks = F.ceil(F.col("source_size") / block).cast("long")
    # Slots in blocks of the source's mean length; the last one takes only the words that are still missing.
    exact = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") * n_blocks).otherwise(0.0)
    plan = written(
        targets(sources, weights, share, most).select(
            "source",
            "source_size",
            "target",
            n_blocks.alias("n_blocks"),
            F.ceil(F.round(exact, 9)).cast("long").alias("slots"),
            (F.round(exact, 9) - F.ceil(F.round(exact, 9)) + 1).alias("last_part"),
        ),
        "mix-plan",
    )
    total = plan.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, math.ceil(total / shard_words))
    slots = _slot_blocks(shard_draws(plan.where("slots > 0"), shards, seed), plan, seed)
    slots = slots.join(plan.alias("p"), slots.source.eqNullSafe(F.col("p.source"))).select(
        slots.source, "shard", "slot", "block_no",
        F.least(F.lit(block), F.col("source_size") - F.col("block_no") * block).alias("length"),
        (F.col("slot") == F.col("slots") - 1).alias("last"), "last_part",
    )
    part = F.when(F.col("last"), F.round(F.col("length") * F.col("last_part")).cast("long")).otherwise(F.col("length"))
    slots = slots.select("source", "shard", "slot", "block_no", part.alias("words"))

    # How often each block is taken in full, and how far it is taken in part.
    uses = slots.groupBy("source", "block_no").agg(F.collect_list("words").alias("uses"))
    placed = _positions(sized)
    last = F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")
    first = F.floor(F.col("start") / block).cast("long")
    pieces = placed.where("size > 0").withColumn("piece_no", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start") - F.col("piece_no") * block, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("piece_no") * block, F.lit(block))
    pieces = pieces.select("doc_id", "source", "size", "start", "piece_no", lo.alias("lo"), hi.alias("hi"))
    met = pieces.join(
        uses.withColumnRenamed("source", "used_source"),
        pieces.source.eqNullSafe(F.col("used_source")) & (pieces.piece_no == F.col("block_no")),
    )
    took = F.aggregate(
        "uses",
        F.lit(0).cast("long"),
        lambda total, n: total + F.greatest(F.lit(0), F.least(n, F.col("hi")) - F.col("lo")),
    )
    # The place of its words tells a row from others with the same id.
    taken = met.groupBy("doc_id", "source", "size", "start").agg(F.sum(took).alias("taken"))
    key = ["doc_id", "source", "size", "start"]
    joined = placed.alias("a").join(taken.alias("b"), _same(key), "left").join(
        plan.alias("p"), F.col("a.source").eqNullSafe(F.col("p.source"))
    )
    documents = joined.select(
        "a.doc_id", "a.source", "a.size", "p.source_size", "p.target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
    )
    return documents, slots


def _same(columns: list[str]):
    test = F.lit(True)
    for c in columns:
        test = test & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return test
