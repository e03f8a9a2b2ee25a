"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

Every text is tokenized by A (a byte-level file of ``tokenizers``, the text
after a blank) and by B (a ``sentencepiece`` model, which adds that blank by
itself). Both token lists tile the same bytes, so aligning them is a merge of
two ascending lists of end offsets. A batch of texts is merged at once: one
state vector holds each text's place in A and in B; a step links the two tokens
that every text stands on, cuts where both end at the same byte, moves the
side that ends first (or both), and texts that are through leave the vector.

Before a single blank between a visible character and a visible ASCII one no
token of either kind goes on, so texts are taken apart there. A piece is
tokenized where a worker meets it first and then remembered (``KEPT_TOKENS``
tokens, after which the memory starts anew), and texts longer than ``LANE``
characters go on in a new *lane* of the vector at such a blank: a lane ends with
a cut, and tokens, links and groups are those of the whole text. Lanes are
worked off in chunks of about ``CHUNK`` characters, however long a text is. A
run that offers no such blank stays whole and costs memory in proportion to its
length.

What a text's links count in the corpus needs a second pass: pair counts are
summed by Spark; at most ``FREQUENT`` pairs, the most frequent ones, then go to
every task, and links of all other pairs meet their count in a join.

Null and empty texts, and texts whose joined token bytes of either side are not
the blank and the text (as with U+2581, which B takes for a blank), have no
tokens: all zeros, and an empty ``groups_sha256``. Strings of special tokens are
ordinary text. Repeated rows are counted row by row, in the pair counts too.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.token_counts import _printable_bytes

LANE = 512
CHUNK = 1 << 18
#: Pairs whose counts are in every task: bounds what travels, never the result.
FREQUENT = 1 << 18
#: Pieces tokenized as one text.
JOINED = 256
#: Tokens of remembered pieces in a worker: bounds its space, never the result.
KEPT_TOKENS = 1 << 22
#: Distinct pairs in one row of the table of aligned texts.
ROW_PAIRS = 1 << 16
_SEAM = re.compile(r"(?<=\S) (?=[!-~])")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_ALIGNED = pa.schema(
    [("row_no", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("groups_sha256", pa.string())]
    + [(c, pa.list_(pa.int32())) for c in ("a", "b", "times")]
)
_ALIGNED_SQL = (
    "row_no long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, times array<int>"
)


class Tokenizers:
    """The two tokenizers of a worker and the bytes of their tokens."""

    def __init__(self, a_spec: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = _printable_bytes()
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))

    def encode(self, pieces: list[str]) -> tuple[tuple, tuple, np.ndarray]:
        """Identifiers and their number per piece for both sides, each piece after a blank, and which pieces both give back.

        Many pieces are tokenized as one text and taken apart again; where the
        bytes do not come back as they were, each piece by itself.
        """
        data = [b" " + piece.encode() for piece in pieces]
        lanes = [" ".join(pieces[lo : lo + JOINED]) for lo in range(0, len(pieces), JOINED)]
        a = self._apart(self._a(lanes), self.a_bytes, self.a_sizes, data)
        b = self._apart(self._b(lanes), self.b_bytes, self.b_sizes, data)
        if a and b:
            return a, b, np.ones(len(pieces), bool)
        sides = self._a(pieces), self._b(pieces)
        good = [
            all(b"".join(map(table.__getitem__, ids)) == said for table, ids in ((self.a_bytes, x), (self.b_bytes, y)))
            for said, x, y in zip(data, *sides)
        ]
        flat = [(list(chain.from_iterable(side)), np.array([len(x) for x in side], np.int64)) for side in sides]
        return (*[(np.array(ids, np.int64), sizes) for ids, sizes in flat], np.array(good, bool))

    def _a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)]

    def _b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)

    @staticmethod
    def _apart(lists: list[list[int]], table: list[bytes], sizes: np.ndarray, data: list[bytes]) -> tuple | None:
        """The tokens of joined pieces and their number per piece; None if the pieces do not come back."""
        ids = list(chain.from_iterable(lists))
        if b"".join(map(table.__getitem__, ids)) != b"".join(data):
            return None
        ids = np.array(ids, np.int64)
        ends, wanted = np.cumsum(sizes[ids]), np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        last = np.searchsorted(ends, wanted)
        return (ids, np.diff(last, prepend=-1)) if np.array_equal(ends[last], wanted) else None


def pieces_of(text: str) -> list[str]:
    """The text cut at blanks that start a token of both kinds; those blanks are left out, as the one before the text is."""
    return _SEAM.split(text)


def _grown(kept: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``kept`` with ``new`` behind its first ``used`` values; doubled where it is full."""
    if used + len(new) > len(kept):
        kept = np.concatenate([kept[:used], np.zeros(max(used, len(new)) + len(new), kept.dtype)])
    kept[used : used + len(new)] = new
    return kept


class _Side:
    """Tokens of remembered pieces, one after the other."""

    def __init__(self):
        self.ids, self.starts, self.sizes = (np.zeros(1024, np.int32) for _ in range(3))
        self.n_ids = self.n_pieces = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = _grown(self.starts, self.n_pieces, self.n_ids + np.cumsum(sizes) - sizes)
        self.sizes = _grown(self.sizes, self.n_pieces, sizes)
        self.ids = _grown(self.ids, self.n_ids, ids)
        self.n_ids, self.n_pieces = self.n_ids + len(ids), self.n_pieces + len(sizes)

    def tokens(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the pieces named, in their order, and how many each has."""
        sizes = self.sizes[which].astype(np.int64)
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[which] - first, sizes) + np.arange(int(sizes.sum()))
        return self.ids[at].astype(np.int64), sizes


class Pieces:
    """Pieces met before, with their tokens."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self._empty()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.a, self.b, self.good = _Side(), _Side(), np.zeros(0, bool)

    def find(self, pieces: list[str]) -> np.ndarray:
        if self.a.n_ids > KEPT_TOKENS:
            self._empty()
        new = [piece for piece in dict.fromkeys(pieces) if piece not in self.place]
        if new:
            a, b, good = self.both.encode(new)
            self.a.add(*a)
            self.b.add(*b)
            self.good = np.append(self.good, good)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))


def lockstep(ends_a, ends_b, at_a, at_b, stop_a) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as places in the two token lists, and the places after which both sides are cut.

    ``ends_*`` are the end offsets of all lanes' tokens one after another,
    ``at_*`` where each lane starts and ``stop_a`` where it is through.
    """
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links_a, links_b = [], []
    live = at_a < stop_a
    at_a, at_b, stop_a = at_a[live], at_b[live], stop_a[live]
    while len(at_a):
        links_a.append(at_a)
        links_b.append(at_b)
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        both = end_a == end_b
        cut_a[at_a[both]] = True
        cut_b[at_b[both]] = True
        at_a = at_a + (end_a <= end_b)
        at_b = at_b + (end_b <= end_a)
        live = at_a < stop_a
        if not live.all():
            at_a, at_b, stop_a = at_a[live], at_b[live], stop_a[live]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(links_a or none), np.concatenate(links_b or none), cut_a, cut_b


class _Digits:
    """Decimal numbers as rows of bytes, right-aligned, with room for a separator."""

    def __init__(self, n: int):
        self.width = len(str(n))
        self.rows = np.array([list(str(i).rjust(self.width).encode()) + [32] for i in range(n)], np.uint8)
        self.used = self.rows != 32
        self.used[:, -1] = True

    def text(self, ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All numbers, each before its separator, and the offset after each."""
        rows, used = self.rows[ids], self.used[ids]
        rows[:, -1] = separators
        return rows[used], np.cumsum(used.sum(axis=1))


class _Text:
    """What is known of one text while its lanes come in."""

    def __init__(self):
        self.counts, self.sha, self.begun, self.good = np.zeros(4, np.int64), hashlib.sha256(), False, True
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs with how often they are linked."""
        if not self.good or not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.keys) > 1:
            keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
            self.times = [np.bincount(place, np.concatenate(self.times)).astype(np.int64)]
            self.keys = [keys]
        return self.keys[0], self.times[0]

    def rows(self, row_no: int, doc_id: int | None, n_b: int) -> Iterator[dict]:
        """The text as rows of at most ROW_PAIRS pairs; the first says all else about it."""
        keys, times = self.fold()
        done = self.good and self.begun
        said = dict(zip(_COUNTS, self.counts.tolist() if done else [0] * 4))
        said["groups_sha256"] = self.sha.hexdigest() if done else ""
        for lo in range(0, max(1, len(keys)), ROW_PAIRS):
            own = keys[lo : lo + ROW_PAIRS]
            pairs = {"a": own // n_b, "b": own % n_b, "times": times[lo : lo + ROW_PAIRS]}
            yield {"row_no": row_no, "doc_id": doc_id, **(said if not lo else dict.fromkeys(said)), **pairs}


class Aligner:
    """Aligns texts chunk by chunk."""

    def __init__(self, both: Tokenizers):
        self.both, self.known = both, Pieces(both)
        self.n_b = len(both.b_bytes)
        self.digits = _Digits(max(len(both.a_bytes), self.n_b))

    def align(self, texts: list[str]) -> list[_Text]:
        found = [_Text() for _ in texts]
        chunk, owner, size = [], [], 0
        for i, text in enumerate(texts):
            pieces = pieces_of(text) if text else []
            for lo in range(0, len(pieces), 10_000):
                own = pieces[lo : lo + 10_000]
                chunk += own
                owner.append((i, len(own)))
                size += sum(map(len, own)) + len(own)
                if size >= CHUNK:
                    self._chunk(chunk, owner, found)
                    chunk, owner, size = [], [], 0
        if chunk:
            self._chunk(chunk, owner, found)
        return found

    def _chunk(self, pieces: list[str], owners: list[tuple[int, int]], found: list[_Text]) -> None:
        which = self.known.find(pieces)
        owner = np.repeat([i for i, _ in owners], [n for _, n in owners])
        for i in np.unique(owner[~self.known.good[which]]):
            found[i].good = False
        keep = np.array([found[i].good for i in owner])
        which, owner = which[keep], owner[keep]
        if not len(which):
            return
        (a, n_a), (b, n_b) = self.known.a.tokens(which), self.known.b.tokens(which)
        # Both sides of a piece hold the same bytes: offsets may as well run on through all texts.
        ends_a, ends_b = np.cumsum(self.both.a_sizes[a]), np.cumsum(self.both.b_sizes[b])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        begin = np.append(0, ends_a[stop_a - 1])[:-1]
        texts = np.flatnonzero(np.diff(owner, prepend=-1))  # the first piece of each text
        within = begin - np.repeat(begin[texts], np.diff(texts, append=len(owner)))
        lanes = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(within // LANE, prepend=0) != 0))
        last = np.append(lanes[1:], len(owner)) - 1
        links_a, links_b, cut_a, cut_b = lockstep(
            ends_a, ends_b, (stop_a - n_a)[lanes], (stop_b - n_b)[lanes], stop_a[last]
        )
        self._pairs(a, b, links_a, links_b, np.repeat(owner, n_a), found)
        last_a, last_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        # The groups in order, each with its tokens of A and then those of B.
        place_a = np.arange(len(a)) + np.append(0, last_b)[np.cumsum(cut_a) - cut_a]
        place_b = np.arange(len(b)) + last_a[np.cumsum(cut_b) - cut_b]
        line, separators = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        line[place_a], line[place_b] = a, b
        separators[place_a] = np.where(cut_a, ord("|"), ord(","))
        separators[place_b] = np.where(cut_b, ord(";"), ord(","))
        text, after = self.digits.text(line, separators)
        final = np.append(texts[1:], len(owner)) - 1
        upto_a, upto_b = stop_a[final], stop_b[final]
        ends = after[upto_a + upto_b - 1]
        groups = np.diff(np.searchsorted(last_a, upto_a, "right"), prepend=0)
        lo = 0
        for i, x, y, g, end in zip(owner[texts], np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0), groups, ends):
            own = found[i]
            own.counts += (x, y, g, x + y - g)
            if own.begun:
                own.sha.update(b";")
            own.sha.update(text[lo : end - 1])  # without the last separator
            own.begun, lo = True, end

    def _pairs(self, a, b, links_a, links_b, text_of, found) -> None:
        first = int(text_of[0])
        key = (text_of[links_a] - first) << 40 | (a[links_a] * self.n_b + b[links_b])
        key, times = np.unique(key, return_counts=True)
        text, key = key >> 40, key & ((1 << 40) - 1)
        starts = np.flatnonzero(np.diff(text, prepend=-1))
        for lo, hi in zip(starts, np.append(starts[1:], len(key))):
            own = found[first + int(text[lo])]
            own.keys.append(key[lo:hi])
            own.times.append(times[lo:hi])
            if len(own.keys) > 16:
                own.fold()


_READY: dict[tuple[int, int], Aligner] = {}


def aligned(docs: DataFrame, a_file: str, b_file: str) -> tuple[DataFrame, int]:
    """Every text (row_no, doc_id, text) aligned, in rows as ``_Text.rows`` gives them; and how many tokens B knows.

    Both files are read here, by the driver, and travel with the tasks.
    """
    ship_package(docs.sparkSession)
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        spec, model = a.read(), b.read()
    n_b = Tokenizers(spec, model).b.get_piece_size()
    shipped = docs.sparkSession.sparkContext.broadcast((spec, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, model = shipped.value
        key = hash(spec), hash(model)
        if key not in _READY:
            _READY[key] = Aligner(Tokenizers(spec, model))
        aligner = _READY[key]
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [value.as_py() or "" for value in part.column(2)]
                rows = []
                for no, doc, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), aligner.align(texts)):
                    rows += own.rows(no, doc, n_b)
                yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in _ALIGNED], schema=_ALIGNED)

    return docs.mapInArrow(run, _ALIGNED_SQL), n_b


def _flat(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and times of all pairs of a batch whose columns a, b, times start at ``first``, and their rows."""
    a, b, times = (batch.column(first + k).flatten().to_numpy().astype(np.int64) for k in range(3))
    row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(first).offsets.to_numpy()))
    return a << 32 | b, times, row


def pair_counts(rows: DataFrame) -> DataFrame:
    """(key, n, best): the links of each pair of identifiers, and whether no other pair of the same B has more."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                key, times, _ = _flat(batch.slice(lo, 2048), 0)
                key, place = np.unique(key, return_inverse=True)
                n = np.bincount(place, times, len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    part = rows.select("a", "b", "times").mapInArrow(summed, "key long, n long")
    counts = written(part.groupBy("key").agg(F.sum("n").alias("n")), "pair-counts")
    b = F.col("key").bitwiseAND((1 << 32) - 1)
    # A B has at most as many partners as A has tokens.
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", b).join(most, "b")
    return written(joined.select("key", "n", (F.col("n") == F.col("most")).alias("best")), "pair-table")


def _frequent_from(pairs: DataFrame, frequent: int) -> int:
    """The least count such that at most ``frequent`` pairs have it or more, on a grid of eighths of powers of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = pairs.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("n").alias("least")).collect()  # some hundred rows
    total, least = 0, None
    for row in sorted(sizes, key=lambda r: -r.step):
        total += row.n
        if total > frequent:
            break
        least = row.least
    return least if least is not None else 1 << 62


def alignment(docs: DataFrame, a_file: str, b_file: str, frequent: int = FREQUENT) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    rows = written(aligned(rows, a_file, b_file)[0], "aligned", compression="zstd")
    pairs = pair_counts(rows)
    table = pairs.where(F.col("n") >= _frequent_from(pairs, frequent)).toArrow().sort_by("key")  # at most FREQUENT rows
    shipped = docs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("key", "n", "best")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shipped.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                key, times, row = _flat(part, 1)
                at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
                seen = known[at] == key if len(known) else np.zeros(len(key), bool)
                sums, bests = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(sums, row[seen], times[seen] * n[at[seen]])
                np.add.at(bests, row[seen], times[seen] * best[at[seen]])
                ends = np.append(0, np.cumsum(np.bincount(row[~seen], minlength=part.num_rows))).astype(np.int32)
                rare = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~seen])) for x in (key, times)]
                columns = [part.column(0), pa.array(sums), pa.array(bests), *rare]
                yield pa.RecordBatch.from_arrays(columns, ["row_no", "count_sum", "n_best", "keys", "times"])

    schema = "row_no long, count_sum long, n_best long, keys array<long>, times array<long>"
    counts = written(rows.select("row_no", "a", "b", "times").mapInArrow(counted, schema), "link-counts", compression="zstd")
    rare = counts.select("row_no", F.explode(F.arrays_zip("keys", "times")).alias("p")).select("row_no", "p.keys", "p.times")
    met = rare.join(pairs, rare["keys"] == pairs["key"])
    met = met.select("row_no", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"))
    sums = counts.select("row_no", "count_sum", "n_best").unionByName(met)
    sums = sums.groupBy("row_no").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    whole = rows.where("n_a IS NOT NULL").select("row_no", "doc_id", *_COUNTS, "groups_sha256")
    return whole.join(sums, "row_no").select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")
