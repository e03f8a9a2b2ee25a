"""Removing repeated passages: suffix order within groups of windows that can be equal.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier,
in a smaller document or earlier in the same one. Equal windows of that length
hold the same smallest hash of ``GRAM`` bytes, their minimizer. Consecutive
windows with one minimizer form a stretch. So:

1. One pass cuts every text into stretches and sends (minimizer, digest, place)
   of each on; no text. Equal stretches of one task are reduced to their first
   beforehand, so that a passage that a third of all documents share is sent
   once per task.
2. Sorted by minimizer, all stretches but the first of each digest are repeated
   as a whole. Where a minimizer has several different stretches, or one that
   repeats itself inside, the first of each needs a closer look.
3. Only those are read from the texts again, grouped by minimizer, and put in
   suffix order by two-stage sorting. Neighbours with a common prefix of
   ``LENGTH`` bytes are equal windows; all but the earliest are repeated.
   Minimizers with more than ``MANY_BYTES`` of such stretches (very common
   passages in ever new surroundings) are not one task's work: their windows
   are dealt by window hash and ``SALTS``, and the earliest is found by minima
   of the salts and of these.

No minimizer fills a task in step 2 either: of the stretches that a task holds,
the first ``MANY_DIGESTS`` of a minimizer travel by it, any others by their own
digest, and these are looked at in step 3 in any case. The former are enough to
show the minimizer's task that there are several, so the firsts of both ways are
compared in step 3, whichever way the copies of a stretch went.

The earliest occurrence of a window always lies in the first of its stretch, so
steps 2 and 3 find every repeated window, and only those.

Null and empty texts stay empty. Rows that repeat id and text are one document
and get the same result; rows that share an id but not the text come in the
order of a 64-bit hash of the text, which also tells them apart. Null ids come
last. Texts are worked through in
pieces of ``PIECE`` windows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.suffix_order import common_prefixes, runs_of, suffix_order
from adlift.llm.textbytes import BASE, BYTE_VALUE, mixed

LENGTH = 100
GRAM = 20
PIECE = 1 << 18
#: Bytes of one minimizer's stretches that one task sorts, and of the stretches sorted together.
MANY_BYTES = 1 << 21
TOGETHER = 1 << 20
#: Stretches a task holds to find equal ones among them, and how many of these go by one minimizer (at least 2).
_HELD = 1 << 19
MANY_DIGESTS = 64
#: Parts into which the places of one window are dealt.
SALTS = 64
_COUNT_BITS = 20
_NO_ID = (1 << 63) - 1
REPEATED, LOOK = 0, 1

_PLACES = ["route", "mini", "digest", "doc", "tie", "place", "inside"]
_PLACE_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
_PLACE_SCHEMA = "route long, mini long, digest long, doc long, tie long, place long, inside boolean"


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def _window_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all windows of the sizes, put together from windows of powers of two."""
    parts = {1: BYTE_VALUE[data]}
    size = 1
    while size * 2 <= max(sizes):
        half = parts[size]
        parts[size * 2] = half[: len(half) - size] * _power(size) + half[size:]
        size *= 2
    out = {}
    for want in sizes:
        have, total = 0, None
        for bit in sorted(parts, reverse=True):
            if want & bit:
                n = len(data) - want + 1
                piece = parts[bit][have : have + n]
                total = piece if total is None else total * _power(bit) + piece
                have += bit
        out[want] = total
    return out


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Minimizer, digest, first window, windows, and whether windows repeat inside, of each stretch of a piece."""
    hashes = _window_hashes(data, (GRAM, LENGTH))
    window = mixed(hashes[LENGTH])
    least = _sliding_minimum(mixed(hashes[GRAM]), LENGTH - GRAM + 1)
    starts = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
    counts = np.diff(np.append(starts, len(least)))
    ends = starts + counts
    digest = mixed(window[starts] * np.uint64(BASE) + window[ends - 1] + counts.astype(np.uint64))
    for i in np.flatnonzero(counts > LENGTH):  # first and last window do not reach each other
        own = hashlib.blake2b(data[starts[i] : ends[i] + LENGTH - 1].tobytes(), digest_size=8).digest()
        digest[i] = int.from_bytes(own, "little")
    inside = np.zeros(len(starts), bool)
    ordered = np.sort(window)
    if (ordered[1:] == ordered[:-1]).any():
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        owners = np.searchsorted(starts, np.flatnonzero(np.isin(window, twice)), "right") - 1
        for i in np.unique(owners):
            own = window[starts[i] : ends[i]]
            inside[i] = len(np.unique(own)) < len(own)
    return least.view(np.int64), digest.view(np.int64), starts, counts, inside


def _batch(columns: list[np.ndarray], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _places(docs: DataFrame) -> DataFrame:
    """Every stretch once per task, with its minimizer; repetitions within the task with digest 0 under a route of their own."""

    def reduced(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        mini, digest, doc, tie, place, inside = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((place, tie, doc, digest, mini))
        mini, digest, doc, tie, place, inside = (c[order] for c in (mini, digest, doc, tie, place, inside))
        new = np.append(True, (mini[1:] != mini[:-1]) | (digest[1:] != digest[:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        copy = (doc == doc[first]) & (tie == tie[first]) & (place == place[first])
        kept = np.flatnonzero(new)
        gone = np.flatnonzero(~copy)
        route = mixed(doc[gone].view(np.uint64) + place[gone].view(np.uint64)).view(np.int64)
        zero = np.zeros(len(gone), np.int64)
        m, g = mini[kept], digest[kept]
        begins = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        nth = np.arange(len(m)) - np.repeat(begins, np.diff(np.append(begins, len(m))))
        alone = nth >= MANY_DIGESTS
        way = np.where(alone, mixed(m.view(np.uint64) + mixed(g.view(np.uint64))).view(np.int64), m)
        for rows in (
            [way, m, g, doc[kept], tie[kept], place[kept], inside[kept] | alone],
            [route, zero, zero, doc[gone], tie[gone], place[gone], np.zeros(len(gone), bool)],
        ):
            for lo in range(0, len(rows[0]), 50_000):
                yield _batch([c[lo : lo + 50_000] for c in rows], _PLACES, _PLACE_KINDS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, tie, value in zip(*(batch.column(i) for i in range(3))):
                data = np.frombuffer(value.as_py().encode(), np.uint8)
                for lo in range(0, len(data) - LENGTH + 1, PIECE):
                    least, digest, starts, counts, inside = stretches(data[lo : lo + PIECE + LENGTH - 1])
                    n = len(starts)
                    held.append((
                        least[starts], digest, np.full(n, doc.as_py()), np.full(n, tie.as_py()),
                        (starts + lo) << _COUNT_BITS | counts, inside,
                    ))
                    size += n
                    if size >= _HELD:
                        yield from reduced(held)
                        held, size = [], 0
        yield from reduced(held)

    return docs.mapInArrow(cut, _PLACE_SCHEMA)


_FOUND = "doc long, tie long, place long, kind int, mini long"


def _judged(places: DataFrame) -> DataFrame:
    """Stretches that are repeated as a whole, and those that need a look: (doc, tie, place, kind, mini)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the last batch leaves: the first row of the last digest, how many digests its
        # minimizer has so far, and whether that row still waits for a second one.
        carried, digests_before, waits = None, 0, False
        for batch in batches:
            mini, digest, doc, place = (batch.column(i).to_numpy() for i in (1, 2, 3, 5))
            tie, inside = batch.column(4).to_numpy(), batch.column(6).to_numpy(zero_copy_only=False)
            passed = (mini == 0) & (digest == 0)
            done = [doc[passed], tie[passed], place[passed], np.full(passed.sum(), REPEATED), mini[passed]]
            rows = [v[~passed] for v in (mini, digest, doc, tie, place, inside)]
            if len(rows[0]):
                if carried is not None:
                    rows = [np.append(one, v) for one, v in zip(carried, rows)]
                m, g, d, t, at, within = rows
                new_m = np.append(True, m[1:] != m[:-1])
                new_g = new_m | np.append(True, g[1:] != g[:-1])
                firsts = np.flatnonzero(new_g)
                own = firsts[np.cumsum(new_g) - 1]
                repeated = (d != d[own]) | (t != t[own]) | (at != at[own])
                group = np.cumsum(new_m) - 1
                digests = np.bincount(group[firsts])
                if carried is not None:
                    digests[0] += digests_before - 1
                look = new_g & ((digests[group] > 1) | within)
                if carried is not None:
                    look[0] = waits and digests[0] > 1
                kind = np.where(look, LOOK, REPEATED)
                out = look | repeated
                done = [np.append(x, y[out]) for x, y in zip(done, (d, t, at, kind, m))]
                last = own[-1]
                kept_waiting = waits if carried is not None and last == 0 else True
                carried, digests_before = [v[last] for v in rows], int(digests[-1])
                waits = digests_before == 1 and not look[last] and kept_waiting
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield _batch(done, ["doc", "tie", "place", "kind", "mini"], kinds)

    dealt = places.repartition("route").sortWithinPartitions("mini", "digest", "doc", "tie", "place")
    return dealt.mapInArrow(judge, _FOUND)


def repeated_windows(
    texts: list[bytes], windows: list[int], doc: np.ndarray, tie: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (doc, tie, first byte) of the windows that are equal to an earlier one among the texts.

    Text i holds ``windows[i]`` windows and begins at byte ``start[i]`` of its document.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    offsets = np.append(0, np.cumsum(lengths)[:-1])
    owner = np.repeat(np.arange(len(texts)), lengths)
    within = np.arange(len(data)) - offsets[owner]
    real = within < np.array(windows)[owner]
    order = suffix_order(data, LENGTH)
    group = np.cumsum(common_prefixes(data, order, LENGTH) < LENGTH)
    kept = real[order]
    order, group = order[kept], group[kept]
    alone = np.bincount(group)[group] == 1 if len(group) else np.zeros(0, bool)
    order, group = order[~alone], group[~alone]
    d, t, s = doc[owner[order]], tie[owner[order]], start[owner[order]] + within[order]
    by = np.lexsort((s, t, d, group))
    group, d, t, s = group[by], d[by], t[by], s[by]
    new = np.append(True, group[1:] != group[:-1])[: len(group)]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(group) else np.zeros(0, np.int64)
    later = (d != d[first]) | (t != t[first]) | (s != s[first])
    return d[later], t[later], s[later]


def _as_runs(doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Single windows as runs of neighbours: doc, tie, place."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start = doc[order], tie[order], start[order]
    if not len(doc):
        return [doc, tie, start]
    new = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + 1)
    new |= start[1:] >> (_COUNT_BITS - 1) != start[:-1] >> (_COUNT_BITS - 1)  # no run longer than a place can tell
    lo = np.append(0, np.flatnonzero(new) + 1)
    hi = np.append(lo[1:], len(doc))
    count = start[hi - 1] - start[lo] + 1
    return [doc[lo], tie[lo], start[lo] << _COUNT_BITS | count]


_RUN_NAMES, _RUN_KINDS = ["doc", "tie", "place"], [pa.int64(), pa.int64(), pa.int64()]


def _sorted_repeats(parts: DataFrame) -> DataFrame:
    """Repeated windows among the texts (mini, doc, tie, start, windows, bytes) with the same minimizer."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last = [], 0, None

        def done() -> pa.RecordBatch:
            texts, windows = [r[4] for r in rows], [r[3] for r in rows]
            places = [np.array([r[i] for r in rows], np.int64) for i in range(3)]
            return _batch(_as_runs(*repeated_windows(texts, windows, *places)), _RUN_NAMES, _RUN_KINDS)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for mini, *row in zip(*columns):
                if mini != last and held >= TOGETHER:
                    yield done()
                    rows, held = [], 0
                last = mini
                rows.append(row)
                held += len(row[4])
        if rows:
            yield done()

    return parts.repartition("mini").sortWithinPartitions("mini").mapInArrow(sort, "doc long, tie long, place long")


def _read_places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted stretches."""
    of_doc = wanted.groupBy("doc", "tie").agg(F.collect_list(F.struct("place", "mini", "common")).alias("places"))
    met = docs.join(of_doc, ["doc", "tie"]).select("doc", "tie", "text", "places")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        names = ["mini", "doc", "tie", "start", "windows", "bytes", "common"]
        for batch in batches:
            for doc, tie, text, places in zip(*(batch.column(i) for i in range(4))):
                data, rows = text.as_py().encode(), []
                for p in places.as_py():
                    start, count = p["place"] >> _COUNT_BITS, p["place"] & ((1 << _COUNT_BITS) - 1)
                    piece = data[start : start + count + LENGTH - 1]
                    rows.append((p["mini"], doc.as_py(), tie.as_py(), start, count, piece, p["common"]))
                for lo in range(0, len(rows), 5_000):
                    columns = zip(*rows[lo : lo + 5_000])
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "mini long, doc long, tie long, start long, windows long, bytes binary, common boolean"
    return met.mapInArrow(read, schema)


def _common_repeats(parts: DataFrame) -> DataFrame:
    """Repeated windows under very common minimizers, window by window."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for _, doc, tie, start, windows, data in zip(*(batch.column(i) for i in range(6))):
                raw, n = data.as_py(), windows.as_py()
                digests = [hashlib.blake2b(raw[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                at = np.arange(n) + start.as_py()
                columns = [both[:, 0], both[:, 1], np.full(n, doc.as_py()), np.full(n, tie.as_py()), at]
                yield _batch(columns, ["w1", "w2", "doc", "tie", "start"], kinds)

    place = F.struct("doc", "tie", "start")
    windows = parts.mapInArrow(split, "w1 long, w2 long, doc long, tie long, start long").withColumn(
        "salt", F.pmod(F.xxhash64("doc", "tie", "start"), F.lit(SALTS))
    )
    firsts = windows.groupBy("w1", "w2", "salt").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts, "window-firsts")
    # All but the first of a salt are repeated; the firsts of one window, at most SALTS, have the earliest among them.
    several = firsts.where("n > 1").select("w1", "w2", "salt", "first")
    later = windows.join(several, ["w1", "w2", "salt"]).where(place != F.col("first"))
    earliest = firsts.groupBy("w1", "w2").agg(F.min("first").alias("earliest"), F.count(F.lit(1)).alias("salts"))
    others = firsts.join(earliest.where("salts > 1"), ["w1", "w2"]).where(F.col("first") != F.col("earliest"))
    found = later.select("doc", "tie", "start").unionByName(others.select("first.*"))
    one = F.lit(1).cast("long")
    return found.select("doc", "tie", F.shiftleft("start", _COUNT_BITS).bitwiseOR(one).alias("place"))


def _whole_characters(raw: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The removed bytes, with all bytes of the characters they cut into."""
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    hit = np.zeros(int(character[-1]) + 1, bool)
    hit[character[gone]] = True
    return hit[character]


def _removed(docs: DataFrame, repeated: DataFrame, with_text: bool) -> DataFrame:
    spans = repeated.groupBy("doc", "tie").agg(F.collect_list("place").alias("places"))
    met = docs.join(spans, ["doc", "tie"], "left").select("row", "text", "places")
    names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, places in zip(batch.column(1), batch.column(2)):
                raw = text.as_py().encode()
                found = np.array(places.as_py() or [], np.int64)
                if not len(found):
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw if with_text else None))
                    continue
                start, count = found >> _COUNT_BITS, found & ((1 << _COUNT_BITS) - 1)
                turns = np.zeros(len(raw) + 1, np.int64)
                np.add.at(turns, start, 1)
                np.add.at(turns, start + count + LENGTH - 1, -1)
                gone = np.cumsum(turns[:-1]) > 0
                codes = np.frombuffer(raw, np.uint8)
                if with_text:  # what is kept as text must be text
                    gone = _whole_characters(codes, gone)
                kept = codes[~gone].tobytes()
                spans = len(runs_of(gone)[0])
                text_out = kept if with_text else None
                out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), text_out))
            columns = list(zip(*out)) if out else [[]] * 5
            arrays = [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds[1:])]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    row = docs.schema["row"].dataType.simpleString()
    schema = f"row {row}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return met.mapInArrow(remove, schema)


def _tie(body: Column) -> Column:
    """The whole 64-bit hash of a text, turned so that its lowest 31 bits come first in the order."""
    h = F.xxhash64(body)
    return F.shiftleft(h, 33).bitwiseOR(F.shiftrightunsigned(h, 31)).bitwiseXOR(F.lit(-(1 << 63)))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    With ``carry``, a struct ``row`` of those columns instead of the id, and ``kept``, the remaining text: characters
    that lost a byte are then gone as a whole.
    """
    ship_package(docs.sparkSession)
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    row = F.struct(*[docs[c] for c in carry]) if carry else F.struct(docs[doc_id].cast("long").alias("doc_id"))
    key = F.coalesce(docs[doc_id].cast("long"), F.lit(_NO_ID))
    tie = _tie(body)
    rows = docs.select(key.alias("doc"), tie.alias("tie"), body.alias("text"), row.alias("row"))
    once = rows.select("doc", "tie", "text")
    found = written(_judged(_places(once)), "stretches")
    look = found.where(F.col("kind") == LOOK).select("doc", "tie", "place", "mini").distinct()
    size = F.col("place").bitwiseAND(F.lit((1 << _COUNT_BITS) - 1)) + (LENGTH - 1)
    many = look.groupBy("mini").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > MANY_BYTES)
    wanted = look.join(many.select(F.col("mini").alias("m")), F.col("mini") == F.col("m"), "left").select(
        "doc", "tie", "place", "mini", F.col("m").isNotNull().alias("common")
    )
    texts = rows.select("doc", "tie", "text")
    parts = written(_read_places(texts, wanted), "stretch-texts")
    narrow = ["mini", "doc", "tie", "start", "windows", "bytes"]
    repeated = (
        found.where(F.col("kind") == REPEATED)
        .select("doc", "tie", "place")
        .unionByName(_sorted_repeats(parts.where(~F.col("common")).select(*narrow)))
        .unionByName(_common_repeats(parts.where("common").select(*narrow)))
    )
    out = _removed(rows, repeated, with_text=carry is not None)
    figures = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if carry:
        return out.select("row", *figures, F.col("kept").cast("string").alias("kept"))
    return out.select("row.doc_id", *figures)
