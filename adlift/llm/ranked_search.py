"""Ranked lexical search: posting lists in blocks of similar documents, skipped by exact bounds.

Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased.
A document's impact for a term is (10^9 * tf) div (1000 * tf + 8 * m), with
m = 25 + (75 * n * N) div L; a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1)));
an item's score for a document is the sum of w * impact over the item's terms,
repeats included. N, L and df are counted over all documents.

1. The items' terms go to the tasks in passes of at most ``PASS_TERMS`` (item,
   term) rows, by item; one pass over the documents keeps their length and the
   postings of the pass's terms as a table.
2. A task takes the postings shard by shard (``SHARD`` documents, fewer where
   terms are many). Per term it clusters the posting list around spread-out
   documents by the cosine of their projected impacts, into blocks of about
   ``BLOCK`` documents, each with the coordinatewise maximum of its impacts.
   The product of a block's summary with an item's weights bounds every score
   inside it; only where the bound is under the score that the item's ten best
   already reach is the block skipped, all others are scored in full. Terms are
   taken rarest first, so a bound need not count terms taken before: their
   lists have shown those documents. A list that the maximum over the whole
   shard rules out for every item is not even blocked. Products are sums of
   integers below 2**53 in doubles, so bounds and scores are exact.
3. What an item must reach at first is the tenth best score among a hash-chosen
   sixteenth of the documents, searched in the same way. Every task returns its
   ten best per item; Spark ranks those.

Null and empty texts have no terms: such documents are in no count and no
result, such items have no result. Every row of the items is ranked by itself,
so repeated items repeat their result. Repeated documents take ranks of their
own. Equal scores go by ascending doc_id, rows without an id last. Texts are
read whole; a text's arrays stay near a megabyte times eight per step.
Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.textbytes import ALNUM, lowered, spans, word_hashes

BEST = 10
#: (item, term) rows whose weights are in a task at once.
PASS_TERMS = 1 << 20
#: Items searched side by side, fewer where they hold more than GROUP_TERMS terms (one item may hold more).
GROUP = 256
GROUP_TERMS = 8192
SHARD = 2048
#: Impacts of a shard as single-precision numbers: bounds its documents where terms are many.
CELLS = 1 << 23
BLOCK = 32
PROJECTED = 32
SEED_SHARE = 16
_FILTER_BITS = 22

_POSTINGS = "row_no long, doc_id long, n long, terms array<int>, tf array<int>"
_FOUND = "item_no long, row_no long, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).max


def term_hashes(text: str | None) -> np.ndarray:
    data = lowered(text)
    return word_hashes(data, *spans(ALNUM[data]))


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of each item (item_no, term, times)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms, times = np.unique(term_hashes(text.as_py()), return_counts=True)
                columns = [pa.array(np.full(len(terms), no, np.int64)), pa.array(terms.view(np.int64)), pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, ["item_no", "term", "times"])

    return items.select("item_no", "text").mapInArrow(cut, "item_no long, term long, times long")


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document its number of terms, and which terms of the sorted vocabulary it holds how often."""
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most PASS_TERMS hashes

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        near = np.zeros(1 << _FILTER_BITS, bool)
        shift = np.uint64(64 - _FILTER_BITS)
        near[known >> shift] = True
        for batch in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in batch.column(2):
                words = term_hashes(text.as_py())
                n.append(len(words))
                words = words[near[words >> shift]]
                at = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
                which, times = np.unique(at[known[at] == words] if len(known) else at, return_counts=True)
                terms.append(which)
                tfs.append(times)
                ends.append(ends[-1] + len(which))
            offsets = pa.array(ends, pa.int32())
            flat = [pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int32)) for x in (terms, tfs)]
            lists = [pa.ListArray.from_arrays(offsets, x) for x in flat]
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["row_no", "doc_id", "n", "terms", "tf"])

    return docs.mapInArrow(found, _POSTINGS)


class _Best:
    """The best documents so far of the items of one group."""

    def __init__(self, least: np.ndarray):
        self.least = least.astype(np.float64)  # what a document must reach
        self.rows: list[list[tuple[int, int, int]]] = [[] for _ in least]

    def offer(self, item: int, scores: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        have = self.rows[item]
        met = np.flatnonzero(scores >= self.least[item])
        if len(met) > BEST:
            met = met[np.lexsort((numbers[met], ids[met], -scores[met]))[:BEST]]
        new = {(-int(scores[i]), int(ids[i]), int(numbers[i])) for i in met}
        if new:
            have[:] = sorted(new.union(have))[:BEST]
            if len(have) == BEST:
                self.least[item] = max(self.least[item], -have[-1][0])


class _Group:
    """Some items, their terms in the order of the search (rarest first), and their weights."""

    def __init__(self, items: np.ndarray, order: np.ndarray, weights: np.ndarray, least: np.ndarray):
        self.items, self.order, self.weights, self.best = items, order, weights, _Best(least)
        sign = np.random.default_rng(7).integers(0, 2, (len(order), PROJECTED)) * 2 - 1
        self.project = sign.astype(np.float32)

    def columns(self, n_terms: int) -> np.ndarray:
        out = np.full(n_terms, -1, np.int32)
        out[self.order] = np.arange(len(self.order))
        return out


def blocks(place: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A posting list dealt to its nearest of some spread-out documents: the members block by block, and the starts."""
    n = -(-len(members) // BLOCK)
    if n == 1:
        return members, np.zeros(1, np.int64)
    centres = members[np.arange(n) * len(members) // n]
    nearest = (place[members] @ place[centres].T).argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    return members[order], np.flatnonzero(np.diff(nearest[order], prepend=-1))


def search_shard(impacts: np.ndarray, ids: np.ndarray, numbers: np.ndarray, group: _Group) -> None:
    """Offer the group every document of the shard that may be among the best of an item."""
    weights, best = group.weights, group.best
    # What the terms from t on can give at most, in any document of the shard.
    reach = np.cumsum((impacts.max(axis=0)[:, None] * weights)[::-1], axis=0)[::-1]
    asks = weights > 0
    live = np.flatnonzero((asks & (reach >= best.least)).any(axis=1))
    if not len(live):
        return
    place = impacts @ group.project
    place /= np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-30)
    for t in live:
        asking = np.flatnonzero(asks[t] & (reach[t] >= best.least))
        members = np.flatnonzero(impacts[:, t]) if len(asking) else asking
        if not len(members):
            continue
        listed, starts = blocks(place, members)
        rest = np.flatnonzero(weights[t:, asking].any(axis=1)) + t
        known = impacts[np.ix_(listed, rest)].astype(np.float64)
        wanted = weights[np.ix_(rest, asking)]
        bound = np.maximum.reduceat(known, starts, axis=0) @ wanted
        ends = np.append(starts[1:], len(listed))
        for b in range(len(starts)):
            open_to = asking[bound[b] >= best.least[asking]]
            if len(open_to):
                inside = listed[starts[b] : ends[b]]
                held = np.flatnonzero(weights[:, open_to].any(axis=1))
                scores = impacts[np.ix_(inside, held)].astype(np.float64) @ weights[np.ix_(held, open_to)]
                for k, item in enumerate(open_to):
                    best.offer(item, scores[:, k], ids[inside], numbers[inside])


def _groups(asked: pa.Table, weight: np.ndarray, vocabulary: np.ndarray, least: dict[int, int]) -> list[_Group]:
    """The items of a pass, cut into groups; asked has the columns item_no, term, times."""
    item, term, times = (asked.column(c).to_numpy() for c in ("item_no", "term", "times"))
    term = np.searchsorted(vocabulary, term.copy().view(np.uint64))
    by_item = np.argsort(item, kind="stable")
    item, term, times = item[by_item], term[by_item], times[by_item]
    starts = np.flatnonzero(np.diff(item, prepend=-1))
    ends = np.append(starts[1:], len(item))
    out, lo = [], 0
    while lo < len(starts):
        hi = lo + 1
        while hi < len(starts) and hi - lo < GROUP and ends[hi] - starts[lo] <= GROUP_TERMS:
            hi += 1
        own = slice(starts[lo], ends[hi - 1])
        used = np.unique(term[own])
        order = used[np.lexsort((used, -weight[used]))]
        column = np.empty(len(vocabulary), np.int64)
        column[order] = np.arange(len(order))
        numbers = item[starts[lo:hi]]
        weights = np.zeros((len(order), hi - lo))
        weights[column[term[own]], np.searchsorted(numbers, item[own])] = weight[term[own]] * times[own]
        out.append(_Group(numbers, order, weights, np.array([least.get(int(i), 1) for i in numbers])))
        lo = hi
    return out


def best_found(lists: DataFrame, asked: pa.Table, vocabulary: np.ndarray, weight: np.ndarray, total: tuple[int, int], least: dict) -> DataFrame:
    """The best documents of every task for every item, at least as good as ``least`` says: rows of _FOUND."""
    n_docs, n_terms = total
    shipped = lists.sparkSession.sparkContext.broadcast((asked, vocabulary, weight, least))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SHARD):
                part = batch.slice(lo, SHARD)
                ids = part.column(1).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                n = part.column(2).to_numpy().astype(np.int64)
                sizes = np.diff(part.column(3).offsets.to_numpy())
                terms, tf = (part.column(c).flatten().to_numpy() for c in (3, 4))
                row, tf = np.repeat(np.arange(len(n)), sizes), tf.astype(np.int64)
                m = 25 + (75 * n * n_docs) // n_terms
                yield part.column(0).to_numpy(), ids, row, terms, 10**9 * tf // (1000 * tf + 8 * m[row])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _groups(shipped.value[0], shipped.value[2], shipped.value[1], shipped.value[3])
        for numbers, ids, row, terms, impact in shards(batches):
            for group in groups:
                column = group.columns(len(shipped.value[1]))[terms]
                used = column >= 0
                r, c, v = row[used], column[used], impact[used]
                step = max(1, CELLS // len(group.order))
                for lo in range(0, len(ids), step):
                    own = (r >= lo) & (r < lo + step)
                    part = slice(lo, min(lo + step, len(ids)))
                    dense = np.zeros((part.stop - lo, len(group.order)), np.float32)
                    dense[r[own] - lo, c[own]] = v[own]
                    search_shard(dense, ids[part], numbers[part], group)
        for group in groups:
            rows = [(int(i), no, d, -s) for i, have in zip(group.items, group.best.rows) for s, d, no in have]
            item, no, doc, score = zip(*rows) if rows else ((), (), (), ())
            doc = pa.array([None if d == _NO_ID else d for d in doc], pa.int64())
            columns = [pa.array(item, pa.int64()), pa.array(no, pa.int64()), doc, pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["item_no", "row_no", "doc_id", "score"])

    return lists.mapInArrow(searched, _FOUND)


def _ranked(found: DataFrame) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row_no"]
    return found.withColumn("rank", F.row_number().over(W.partitionBy("item_no").orderBy(*order))).where(F.col("rank") <= BEST)


def search(docs: DataFrame, items: DataFrame, seed_share: int = SEED_SHARE) -> DataFrame:
    """The ten best documents of each item with a score above 0: (item_id, rank, doc_id, score, item_no)."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    asks = items.select(
        F.monotonically_increasing_id().alias("item_no"), items["item_id"], items["text"].cast("string").alias("text")
    )
    asks = written(asks, "search-items")
    terms = written(item_terms(asks), "search-terms")
    passes = max(1, -(-terms.count() // PASS_TERMS))
    if passes > 1:  # every pass must see the same numbers
        rows = written(rows, "numbered-documents")
    ranked = None
    for k in range(passes):
        asked = terms.where(F.pmod(F.xxhash64("item_no"), F.lit(passes)) == k).toArrow()
        vocabulary = np.unique(asked.column("term").to_numpy().copy().view(np.uint64))
        lists = written(postings(rows, vocabulary), "search-postings")
        n_docs, n_terms = lists.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = lists.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[held.column("t").to_numpy()] = held.column("df").to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        total = (n_docs, max(1, n_terms))
        seed = lists.where(F.pmod(F.xxhash64("row_no"), F.lit(seed_share)) == 0)
        tenth = _ranked(best_found(seed, asked, vocabulary, weight, total, {})).where(F.col("rank") == BEST)
        least = {r.item_no: r.score for r in tenth.select("item_no", "score").collect()}  # a number per item of the pass
        found = written(_ranked(best_found(lists, asked, vocabulary, weight, total, least)), "search-found")
        ranked = found if ranked is None else ranked.unionByName(found)
    named = ranked.join(asks.select("item_no", "item_id"), "item_no")
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "item_no")
