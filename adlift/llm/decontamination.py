"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item, or a whole
shorter item; it is looked for word for word in the documents. Windows are
sets of shingles of three words. A document can hold a window only if it holds
every shingle of it, so the join needs one necessary token per window: its
rarest shingle.

1. One pass over the documents keeps, per text, the runs of consecutive
   shingles that occur in the benchmark at all, and drops runs shorter than the
   shortest window (length bound). A long run is kept as pieces of ``PIECE``
   shingles that overlap by a window, so that each place of a run travels with a
   bounded stretch around it. The benchmark's shingles travel to the tasks
   in blocks of at most ``BLOCK`` windows' shingles, one pass per block, so that
   what a task holds is bounded however many items there are.
2. Shingles are ordered by how often they occur in the runs of all documents;
   each window joins on its rarest one.
3. A match must leave room for the window before and after it inside its run
   (positional bound), and the window's whole sequence is then compared.

Null and empty texts, of items or documents, have no words: nothing occurs in
them and they are never contaminated. Repeated documents are judged row by row.
A null item id counts as an item and sorts as an empty string. Work per text is
linear; the temporary arrays stay near a megabyte times eight per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.textbytes import ALNUM, lowered, shingle_hashes, spans, word_hashes

WINDOW = 13
SHINGLE = 3
#: Windows whose shingles are in a task at once: at most 8 * 11 bytes each.
BLOCK = 200_000
#: Starts of windows in one piece of a run.
PIECE = 32
_HIT_BITS = 22

_RUN = pa.struct([("n", pa.int32()), ("start", pa.int32()), ("shingles", pa.list_(pa.int64()))])
_WINDOW_SCHEMA = "item_id string, n int, words int, shingles array<long>"


def _words(text: str | None) -> np.ndarray:
    data = lowered(text)
    return word_hashes(data, *spans(ALNUM[data]))


def _same_length_hashes(words: np.ndarray, n: int) -> np.ndarray:
    return shingle_hashes(words, n) if len(words) >= n else np.zeros(0, np.uint64)


def windows(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Every window of every item: (item_id, n, words, shingles)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = _words(value.as_py())
                if not len(words):
                    continue
                size = min(window, len(words))
                n = min(SHINGLE, size)
                hashes, each = _same_length_hashes(words, n).view(np.int64), size - n + 1
                for lo in range(0, len(hashes) - each + 1, 10_000):
                    rows = [hashes[i : i + each] for i in range(lo, min(lo + 10_000, len(hashes) - each + 1))]
                    columns = [
                        pa.array([key] * len(rows), pa.string()),
                        pa.array([n] * len(rows), pa.int32()),
                        pa.array([size] * len(rows), pa.int32()),
                        pa.array(rows, pa.list_(pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["item_id", "n", "words", "shingles"])

    key = F.coalesce(benchmark[item_id].cast("string"), F.lit("")).alias("item_id")
    items = benchmark.select(key, benchmark[text].cast("string").alias("text"))
    return items.mapInArrow(cut, _WINDOW_SCHEMA)


class _Vocabulary:
    """The benchmark's shingles of one size: a bitmap before a binary search."""

    def __init__(self, hashes: np.ndarray, shortest: int, longest: int):
        self.sorted, self.shortest, self.longest = np.unique(hashes.view(np.uint64)), shortest, longest
        self.bitmap = np.zeros(1 << _HIT_BITS, bool)
        self.bitmap[self.sorted >> np.uint64(64 - _HIT_BITS)] = True

    def runs(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        near = np.flatnonzero(self.bitmap[hashes >> np.uint64(64 - _HIT_BITS)])
        if len(near) < self.shortest:
            return []
        at = np.searchsorted(self.sorted, hashes[near])
        known = np.zeros(len(hashes), bool)
        known[near] = self.sorted[np.minimum(at, len(self.sorted) - 1)] == hashes[near]
        return [(int(s), int(e)) for s, e in zip(*spans(known)) if e - s >= self.shortest]

    def pieces(self, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """The runs in pieces; a window that starts among the first PIECE places of one lies wholly in it."""
        for start, end in self.runs(hashes):
            for lo in range(start, max(start + 1, end - self.shortest + 1), PIECE):
                yield lo, min(end, lo + PIECE + self.longest - 1)


def _runs(docs: DataFrame, block: DataFrame) -> DataFrame:
    """Per document its words and the runs of shingles that the block's windows hold, in pieces."""
    held: dict[int, _Vocabulary] = {}
    each = F.size("shingles")
    # A row per shingle size, of which there are at most SHINGLE.
    bounds = block.groupBy("n").agg(F.min(each).alias("least"), F.max(each).alias("most")).collect()
    for n, least, most in bounds:
        # At most BLOCK windows of WINDOW - SHINGLE + 1 shingles each.
        flat = block.where(F.col("n") == n).select(F.explode("shingles").alias("s")).distinct().toArrow()
        held[n] = _Vocabulary(flat.column("s").to_numpy().copy(), least, most)
    shipped = docs.sparkSession.sparkContext.broadcast(held)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = shipped.value
        for batch in batches:
            counts, rows = [], []
            for value in batch.column(2):
                words = _words(value.as_py())
                counts.append(len(words))
                runs = []
                for n, vocabulary in vocabularies.items():
                    hashes = _same_length_hashes(words, n)
                    signed = hashes.view(np.int64)
                    runs += [{"n": n, "start": s, "shingles": signed[s:e]} for s, e in vocabulary.pieces(hashes)]
                rows.append(runs)
            keys = [batch.column(i) for i in (0, 1, 3)]
            columns = [*keys, pa.array(counts, pa.int64()), pa.array(rows, pa.list_(_RUN))]
            yield pa.RecordBatch.from_arrays(columns, ["row_no", "doc_id", "text_key", "n_words", "runs"])

    runs = "array<struct<n int, start int, shingles array<long>>>"
    return docs.mapInArrow(found, f"row_no long, doc_id long, text_key long, n_words long, runs {runs}")


def _hits(found: DataFrame, block: DataFrame) -> DataFrame:
    """Every place where a window of the block stands, once or more: (row_no, start, words, window)."""
    runs = found.select("row_no", F.explode("runs").alias("run")).select("row_no", "run.*")
    each = runs.select("row_no", "n", "start", "shingles", F.posexplode("shingles").alias("at", "shingle"))
    rarity = each.groupBy("n", "shingle").agg(F.count("*").alias("times"))
    distinct = block.groupBy("n", "words", "shingles").agg(F.lit(1).alias("one")).drop("one")
    parts = distinct.select("n", "words", "shingles", F.posexplode("shingles").alias("offset", "shingle"))
    # A shingle that no run holds rules its window out.
    ranked = parts.join(rarity, ["n", "shingle"], "left")
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("rarest")
    prefix = ranked.groupBy("n", "words", "shingles").agg(rarest).where("rarest.times > 0")
    prefix = prefix.select(
        F.col("n").alias("w_n"), "words", F.col("shingles").alias("w_shingles"),
        F.col("rarest.shingle").alias("w_shingle"), F.col("rarest.offset").alias("offset"),
    )
    met = each.join(prefix, (each.n == prefix.w_n) & (each.shingle == prefix.w_shingle))
    begin = F.col("at") - F.col("offset")
    fits = (begin >= 0) & (begin + F.size("w_shingles") <= F.size("shingles"))
    same = F.slice("shingles", begin + 1, F.size("w_shingles")) == F.col("w_shingles")
    return met.where(fits).where(same).select(
        "row_no", (F.col("start") + begin).alias("start"), "words", F.col("w_n").alias("n"),
        F.col("w_shingles").alias("shingles"),
    )


def _covered(places):
    """Words inside any of the places (start, words), sorted by start."""
    grown = lambda acc, p: F.struct(
        (acc["n"] + F.greatest(F.lit(0), p["start"] + p["words"] - F.greatest(acc["end"], p["start"]))).alias("n"),
        F.greatest(acc["end"], p["start"] + p["words"]).alias("end"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.array_sort(places), zero, grown, lambda acc: acc["n"].cast("long"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: n_words, n_hit, the items found (strings) and whether a twentieth of its words or more are hit.

    ``text_key`` (xxhash64 of the text) tells rows without an id, or with the same one, apart.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        docs[doc_id].cast("long").alias("doc_id"),
        docs[text].cast("string").alias("text"),
        F.xxhash64(docs[text].cast("string")).alias("text_key"),
    )
    items = written(windows(benchmark, window), "benchmark-windows")
    distinct = written(items.select("n", "words", "shingles").distinct(), "distinct-windows")
    blocks = max(1, -(-distinct.count() // BLOCK))
    if blocks > 1:  # every pass must see the same numbers
        rows = written(rows, "numbered-documents")
    counted, hits = None, None
    for i in range(blocks):
        block = distinct.where(F.pmod(F.xxhash64("shingles"), F.lit(blocks)) == i)
        found = written(_runs(rows, block), "benchmark-runs")
        # Any pass counts the words.
        counted = counted if counted is not None else found.select("row_no", "doc_id", "text_key", "n_words")
        hits = _hits(found, block) if hits is None else hits.unionByName(_hits(found, block))
    hits = written(hits, "benchmark-hits")
    covered = hits.groupBy("row_no").agg(_covered(F.collect_set(F.struct("start", "words"))).alias("n_hit"))
    named = hits.select("row_no", "n", "words", "shingles").distinct().join(items, ["n", "words", "shingles"])
    per_row = named.groupBy("row_no").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        counted.join(covered, "row_no", "left")
        .join(per_row, "row_no", "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_key",
        )
    )
