"""Near-duplicates by bottom-k sketches of one hash function.

A document is the set of its word shingles' hashes. Documents with equal sets
are one class; a class keeps the ``SKETCH`` smallest hashes of its set.

Candidates come from inverted lists of the retained values. If two sets reach
the threshold, then among the smallest values of their union so many are shared
that ``least_shared`` of them fail to be with probability ``MISS`` only (with
sets that fit into their sketch: never). So lists need hold a class only under
the ``kept - least_shared + 1`` rarest values of its sketch, and values that
very many classes share drop out by themselves, without a cap.

Within a list, pairs with one class are looked at first, the one whose values most
others hold: the text that a family of edits comes from. Verified links make
components. In lists of up to ``FEW`` classes that then still hold
different components all remaining pairs are compared. Longer ones are where a
sketch cannot tell a family of loosely related texts apart: thousands of edits
of one text share most values and few links. Their classes, and only those, have
their full sets written. By these each list's weightiest class is the centre of
further stars, which bring the edits that are linked at all into one component.
What stays apart gets lists over the full sets, in which the positions of a value in two
sets, ordered by rarity, bound the overlap exactly. A class with too many values
of its own then meets no partner of a size it cannot match, and what is compared
stays near what is linked. All pairs of a list are so either compared, connected
already, or ruled out.

A pair is compared in three steps: by set sizes, by the Jaccard estimate from
the sketch of its union, and by the exact Jaccard of the full sets, taken from
the texts again.

Texts without words, null or empty, link with nothing. Texts of fewer words
than a shingle are one shingle. Rows that share a doc_id are one document: a
link of any is a link of the document. Rows without a doc_id cannot be named in
a component; they link with nothing and are kept. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.components import forest
from adlift.llm.frames import ship_package, written
from adlift.llm.textbytes import NOT_WHITE, lowered, shingle_hashes, spans, word_hashes

SHINGLE = 4
SKETCH = 64
MISS = 1e-9
#: Classes of a list whose pairs are all compared; longer lists are taken apart by full sets.
FEW = 24
#: Rounds of further stars before the members that are still apart are compared pair by pair: the first
#: stars' other pairs, then stars by full sets around the weightiest component of a list, the next one, ...
TURNS = 3
#: Jaccard threshold in hundredths.
THRESHOLD = 80

_SETS = "doc_id long, n long, d1 long, d2 long, sketch array<long>"


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    data = lowered(text)
    return np.unique(shingle_hashes(word_hashes(data, *spans(NOT_WHITE[data])), shingle).view(np.int64))


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))


@lru_cache(maxsize=None)
def least_shared(values: int, threshold: int = THRESHOLD) -> int:
    """So many of the union sketch's values are shared at the threshold, but for a chance of MISS."""
    j, below = threshold / 100, 0.0
    for t in range(values + 1):
        below += math.comb(values, t) * j**t * (1 - j) ** (values - t)
        if below > MISS:
            return t
    return values


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, sketches = [], [], [], []
            for value in batch.column(1):
                hashes = shingle_set(value.as_py(), shingle)
                a, b = set_digest(hashes)
                sizes.append(len(hashes))
                first.append(a)
                second.append(b)
                sketches.append(hashes[:SKETCH])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip((sizes, first, second, sketches), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n", "d1", "d2", "sketch"])

    return docs.mapInArrow(sketched, _SETS)


def _postings(classes: DataFrame, threshold: int) -> DataFrame:
    """(value, cls, n, weight): every class under the rarest of its retained values, as far as others share them."""
    values = classes.select("cls", F.explode("sketch").alias("value")).repartition("value")
    shared = values.groupBy("value").agg(F.count("*").alias("times")).where("times > 1")
    common = values.join(shared, "value").groupBy("cls").agg(
        F.array_sort(F.collect_list(F.struct("times", "value"))).alias("own")
    ).join(classes.select("cls", "n", F.size("sketch").alias("k")), "cls")
    # A set whose union with any partner fits into a sketch is compared exactly.
    exact = F.ceil(F.col("k") * threshold / 100.0).cast("int")
    whole = F.col("n") * 100 <= SKETCH * threshold
    needed = F.when(whole, exact).otherwise(F.least(exact, F.lit(least_shared(SKETCH, threshold))))
    prefix = (F.col("k") - needed + 1) - (F.col("k") - F.size("own"))
    taken = F.slice("own", F.lit(1), F.greatest(F.lit(0), F.least(prefix, F.size("own"))))
    # How often others hold a class's values: most for the text that a family of edits comes from.
    weight = F.aggregate("own", F.lit(0).cast("long"), lambda total, x: total + x["times"])
    listed = common.select("cls", "n", weight.alias("weight"), F.explode(taken).alias("p"))
    return listed.select(F.col("p.value").alias("value"), "cls", "n", "weight")


def _estimated(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose union sketch allows for the threshold, with the estimate."""
    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    other = classes.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(one, "a").join(other, "b")
    fits = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    both = both.where(fits).withColumn("union", union)
    shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), "union"))
    bounds = F.array(*[F.lit(least_shared(k, threshold)) for k in range(SKETCH + 1)])
    exact = F.size(F.array_union("sketch_a", "sketch_b")) <= SKETCH
    exact = exact & (F.greatest("n_a", "n_b") <= SKETCH)
    enough = F.when(exact, 100 * F.col("shared") >= threshold * F.size("union")).otherwise(
        F.col("shared") >= F.get(bounds, F.size("union"))
    )
    counted = both.withColumn("shared", shared)
    return counted.where(enough).select("a", "b", (F.col("shared") / F.size("union")).alias("estimate"))


def _named(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The lists with the component of every class, itself where the forest (a, b) has none."""
    return lists.join(found, lists.cls == found.a, "left").select(
        "value", "cls", "n", F.coalesce("b", "cls").alias("component")
    )


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are of different components."""
    ends = [found.select(F.col("a").alias(c), F.col("b").alias(f"of_{c}")) for c in ("a", "b")]
    both = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _mixed(lists: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists that hold different components, with their number of members, and the classes of the long ones."""
    named = _named(lists, found)
    sizes = named.groupBy("value").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members")
    )
    mixed = written(named.join(sizes.where("lo < hi").select("value", "members"), "value"), "mixed-lists")
    return mixed, mixed.where(F.col("members") > FEW).select("cls", "component").distinct()


def _central_stars(mixed: DataFrame, weights: DataFrame, turn: int, threshold: int) -> DataFrame:
    """Pairs (a, b) of classes of long lists that are still apart, at most one for every class.

    A list's centre is its weightiest class by full sets; in later turns that of the
    components which no earlier turn's centre is of. A class meets the one that is
    the centre of most of its lists.
    """
    members = mixed.where(F.col("members") > FEW).join(weights, "cls")
    centre = F.max(F.struct("weight", "cls", "n", "component")).alias("centre")
    around = members.groupBy("value").agg(centre)
    left = members
    for _ in range(1, turn):
        left = left.join(around, "value").where(F.col("component") != F.col("centre.component")).drop("centre")
        around = left.groupBy("value").agg(centre)
    fits = 100 * F.least("n", "centre.n") >= threshold * F.greatest("n", "centre.n")
    met = members.join(around, "value").where(fits & (F.col("component") != F.col("centre.component")))
    shared = met.groupBy("cls", F.col("centre.cls").alias("other")).agg(F.count("*").alias("lists"))
    best = shared.groupBy("cls").agg(F.max(F.struct("lists", "other"))["other"].alias("other"))
    return best.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b"))


def _all_pairs(lists: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components and matching sizes within lists of few classes, once for every list."""
    own = lists.groupBy("value").agg(F.collect_list(F.struct("cls", "n", "component")).alias("own"))

    def partners(x):
        def fits(y):
            sizes = 100 * F.least(x["n"], y["n"]) >= threshold * F.greatest(x["n"], y["n"])
            return (x["cls"] < y["cls"]) & (x["component"] != y["component"]) & sizes

        return F.transform(F.filter("own", fits), lambda y: F.struct(x["cls"].alias("a"), y["cls"].alias("b")))

    return own.select(F.explode(F.flatten(F.transform("own", partners))).alias("p")).select("p.a", "p.b")


def _open_values(open_classes: DataFrame, full: DataFrame) -> DataFrame:
    """(cls, n, value, times): the full sets of the open classes, with how many of these hold each value."""
    sets = full.join(open_classes.select("cls"), "cls")
    values = sets.select("cls", F.size("hashes").alias("n"), F.explode("hashes").alias("value"))
    values = values.repartition("value").distinct()  # rows of one id may give a set twice
    times = values.groupBy("value").agg(F.count("*").alias("times"))
    return written(values.join(times, "value").select("cls", "n", "value", "times"), "open-times")


def _crossing(open_classes: DataFrame, values: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components among the open classes that their full sets do not rule out, maybe repeated.

    Every set is put in the order of (rarity, value). If x and y reach the
    threshold with c common values, the first common one has at least c - 1 after
    it in both; so its place in x bounds the size of y, and the other way round.
    The larger set asks the size bins it can match, the smaller stands in its own.
    """
    ordered = values.groupBy("cls", "n").agg(
        F.array_sort(F.collect_list(F.struct("times", "value"))).alias("own")
    ).join(open_classes, "cls")
    prefix = F.col("n") - F.ceil(F.col("n") * threshold / 100.0) + 1
    placed = ordered.select(
        "cls", "component", "n", F.posexplode(F.slice("own", F.lit(1), prefix.cast("int"))).alias("at", "p")
    ).where("p.times > 1")
    # The largest partner that the values from this place on allow for.
    reach = F.floor(((100 + threshold) * (F.col("n") - F.col("at")) - threshold * F.col("n")) / threshold)
    placed = placed.select("cls", "component", "n", F.col("p.value").alias("value"), reach.cast("long").alias("reach"))
    size_bin = lambda n: F.floor(F.log(n.cast("double")) / math.log(1.04)).cast("int")
    least = F.ceil(F.col("n") * threshold / 100.0)
    most = F.least("n", "reach")
    larger = placed.where(most >= least).select(
        "value", "cls", "component", "n", "reach", F.explode(F.sequence(size_bin(least), size_bin(most))).alias("bin")
    )
    smaller = placed.where(F.col("reach") >= F.col("n")).select(
        "value", size_bin(F.col("n")).alias("bin"), *[F.col(c).alias(f"{c}_b") for c in ("cls", "component", "n", "reach")]
    )
    fits = (100 * F.col("n_b") >= threshold * F.col("n")) & (F.col("n_b") <= F.col("reach"))
    fits = fits & (F.col("n") <= F.col("reach_b")) & (F.col("component") != F.col("component_b"))
    once = (F.col("n_b") < F.col("n")) | ((F.col("n_b") == F.col("n")) & (F.col("cls_b") < F.col("cls")))
    same = (larger.value == smaller.value) & (larger.bin == smaller.bin)
    met = larger.join(smaller, same & fits & once)
    return met.select(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b"))


def _full_sets(docs: DataFrame, known: DataFrame, shingle: int) -> DataFrame:
    """(cls, hashes): the sets of the classes (cls, d1, d2), from their texts; of rows with one id the one that fits."""
    texts = docs.join(known, docs.doc_id == known.cls).select("cls", "d1", "d2", "text")

    def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, seconds = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            kept, sets = [], []
            for i, value in enumerate(batch.column(3)):
                hashes = shingle_set(value.as_py(), shingle)
                if set_digest(hashes) == (firsts[i], seconds[i]):
                    kept.append(i)
                    sets.append(hashes)
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.list_(pa.int64()))], ["cls", "hashes"])

    return texts.mapInArrow(own_text, "cls long, hashes array<long>")


def _verified(pairs: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets (cls, hashes) reach the threshold."""
    one = full.select(F.col("cls").alias("a"), F.col("hashes").alias("hashes_a"))
    other = full.select(F.col("cls").alias("b"), F.col("hashes").alias("hashes_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (v.values.to_numpy() for v in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * common >= threshold * (len(a) + len(b) - common))
            mask = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], ["a", "b"])

    # Estimates leave the pairs dealt out by b.
    met = pairs.join(other, "b").join(one, "a").select("a", "b", "hashes_a", "hashes_b")
    return met.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    ship_package(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    sets = written(_sets(rows, shingle), "shingle-sets")
    usable = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = written(
        usable.groupBy("d1", "d2").agg(
            F.min("doc_id").alias("cls"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        "shingle-classes",
    )
    lists = written(_postings(classes, threshold), "inverted-lists")

    # Sketches and full sets are needed again only of classes that share a list with another: they are
    # taken out once, so that the many joins below do not deal out the whole corpus each.
    heads = lists.groupBy("value").agg(
        F.max(F.struct("weight", "cls"))["cls"].alias("head"), F.count("*").alias("members")
    ).where("members > 1")
    lists = written(lists.join(heads, "value").select("value", "cls", "n", "head"), "shared-lists")
    listed = written(classes.join(lists.select("cls").distinct(), "cls", "left_semi"), "listed-classes")
    full = written(_full_sets(rows, listed.select("cls", "d1", "d2"), shingle), "listed-sets")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        return written(_verified(pairs.select("a", "b"), full, threshold), name)

    # First every list's members with its weightiest; of those, first the likeliest partner of each class.
    stars = lists.where(F.col("cls") != F.col("head")).select(F.col("head").alias("a"), F.col("cls").alias("b"))
    candidates = written(_estimated(stars.distinct(), listed, threshold), "star-pairs")
    best = candidates.groupBy("b").agg(F.max(F.struct("estimate", "a"))["a"].alias("a"))
    found = forest(linked(best, "first-links").unionByName(_same_id(usable, classes)))

    # Then the other stars between what is still apart, and stars by full sets: components that
    # grow together here leave no pairs to the last step. What is linked already stays as its forest.
    if TURNS:
        found = forest(found.unionByName(linked(_apart(candidates, found), "turn-links")))
    mixed, open_classes = _mixed(lists, found)
    values = _open_values(open_classes, full)
    weights = written(values.groupBy("cls").agg(F.sum("times").alias("weight")), "open-weights")
    for turn in range(1, TURNS):
        stars = _central_stars(mixed, weights, turn, threshold)
        joined = linked(_estimated(stars, listed, threshold), "turn-links")
        if joined.isEmpty():
            break
        found = forest(found.unionByName(joined))
        mixed, open_classes = _mixed(lists, found)

    # Last whatever a list holds of different components.
    crossing = _all_pairs(mixed.where(F.col("members") <= FEW), threshold).unionByName(
        _crossing(open_classes, values, threshold)
    ).distinct()
    done = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _estimated(crossing.join(done, ["a", "b"], "left_anti"), listed, threshold)
    final = forest(found.unionByName(linked(rest, "more-links")))

    of_class = classes.join(final, classes.cls == final.a, "left").select(
        "d1", "d2", F.coalesce("b", "cls").alias("component")
    )
    own = F.col("s.doc_id").isNotNull() & (F.col("s.n") > 0)
    joined = sets.alias("s").join(
        of_class.alias("c"), own & (F.col("s.d1") == F.col("c.d1")) & (F.col("s.d2") == F.col("c.d2")), "left"
    )
    component = F.coalesce("c.component", "s.doc_id")
    return joined.select(
        "s.doc_id",
        F.col("s.n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("s.doc_id") == component, F.lit(True)).alias("kept"),
    )


def _same_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links of the classes of documents that have several texts."""
    twice = usable.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    rows = usable.join(twice, "doc_id").join(classes, ["d1", "d2"])
    return rows.select(F.col("cls").alias("a"), F.col("doc_id").alias("b")).where(F.col("a") != F.col("b"))
