"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ``ORDER`` bytes, pretrained on
the training documents and kept as a table: one row per context with its total,
its number of distinct successors and their counts (257 at most). A symbol has
the probability (2n - 1) / 2 total in the longest known context; a symbol that
context has not seen costs an escape, distinct / 2 total, and is looked for in the context one byte shorter, where the symbols seen above
are excluded from total and distinct. As a context's successors also follow
every suffix of it, what a level excludes depends on the next longer context
only, so one number per context (``excluded``) holds it. After order 0 what is
left of the 257 symbols is equally likely.

Texts are coded as their words, A-Z lower-cased, joined by single blanks, then
an end symbol. The score is the sum of log10 probabilities. Beside it stands a
unigram word model with add-one smoothing (``base_score``).

A document's symbols need the probability of each 6-gram it holds. The most
frequent ones, at most ``HEAD`` of them, are in a table that every task has;
the others (rare or never seen) are counted per document, looked up once per
distinct gram by joins with the trie, and joined back. Word counts go the same
way. The bound limits memory only: every gram gets its exact value.

Null and empty texts have no words and one end. Repeated rows are scored, and
learned from, as often as they occur; a null id is an empty text for the split.
With nothing to learn from every symbol is equally likely. Texts are read
whole, a piece at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.language_id import held_out
from adlift.llm.textbytes import NOT_WHITE, PIECE, mixed, spans, word_hashes

ORDER = 5
BITS = 9
BYTES, END, START = 256, 256, 257
ALPHABET = 257
#: Grams and words that every task holds.
HEAD = 1 << 20
WORD, GRAM = 0, 1
#: The end of a text as a token of the word model.
END_WORD = -0x123456789ABCDEF
#: Distinct keys a training task holds before it passes them on.
_HELD = 1 << 21


def _canonical(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The words joined by single blanks, and the words' hashes."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    solid = NOT_WHITE[data]
    hashes = word_hashes(data, *spans(solid))
    kept = solid.copy()
    kept[1:] |= solid[:-1]
    out = np.where(solid, data, 32)[kept].astype(np.uint8)
    return (out[:-1] if len(out) and out[-1] == 32 else out), hashes


def _segments(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The symbols of a text in pieces, each after the ORDER symbols before it; the last ends the text."""
    before = np.full(ORDER, START, np.int64)
    for lo in range(0, len(codes) + 1, PIECE):
        own = codes[lo : lo + PIECE].astype(np.int64)
        if lo + PIECE > len(codes):
            own = np.append(own, END)
        piece = np.concatenate([before, own])
        before = piece[-ORDER:]
        yield piece


def _grams(piece: np.ndarray) -> np.ndarray:
    """For every symbol after the first ORDER: it and the ORDER symbols before, BITS each, the symbol lowest."""
    n = len(piece) - ORDER
    out = piece[:n].copy()
    for i in range(1, ORDER + 1):
        out <<= BITS
        out |= piece[i : i + n]
    return out


def _grouped(texts: Iterator[str | None]) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts together as far as they stay near PIECE: text numbers, grams of each, all grams, word hashes of each."""
    numbers, lengths, grams, words, held = [], [], [], [], 0
    for number, text in enumerate(texts):
        codes, hashes = _canonical(text)
        for i, piece in enumerate(_segments(codes)):
            numbers.append(number)
            grams.append(_grams(piece))
            lengths.append(len(grams[-1]))
            words.append(hashes if i == 0 else hashes[:0])
            held += lengths[-1]
            if held >= PIECE:
                yield numbers, lengths, np.concatenate(grams), words
                numbers, lengths, grams, words, held = [], [], [], [], 0
    if numbers:
        yield numbers, lengths, np.concatenate(grams), words


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.diff(np.append(first, len(keys)))


class _Counts:
    """Counts of one kind of key, summed as they come."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(_counted(keys))
        self.size += len(self.parts[-1][0])
        if self.size > _HELD:
            self._sum()
            if self.size > _HELD // 2:
                yield from self.rows()

    def _sum(self) -> None:
        if self.parts:
            self.parts = [_summed(*(np.concatenate(c) for c in zip(*self.parts)))]
            self.size = len(self.parts[0][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        self._sum()
        for keys, times in self.parts:
            for lo in range(0, len(keys), 50_000):
                k, n = keys[lo : lo + 50_000], times[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), self.kind), pa.int8()), pa.array(k, pa.int64()), pa.array(n, pa.int64())],
                    ["kind", "key", "n"],
                )
        self.parts, self.size = [], 0


def training_counts(docs: DataFrame) -> DataFrame:
    """How often each word (kind 0) and each gram (kind 1) occurs: (kind, key, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, grams = _Counts(WORD), _Counts(GRAM)
        for batch in batches:
            for numbers, _, all_grams, hashes in _grouped(v.as_py() for v in batch.column(0)):
                yield from grams.add(all_grams)
                yield from words.add(np.concatenate(hashes).view(np.int64))
            yield from words.add(np.full(batch.num_rows, END_WORD, np.int64))
        yield from words.rows()
        yield from grams.rows()

    rows = docs.select("text").mapInArrow(count, "kind byte, key long, n long")
    return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _low(column, symbols: int):
    """The lowest symbols of a gram."""
    return column.bitwiseAND(F.lit((1 << BITS * symbols) - 1).cast("long"))


def trie(grams: DataFrame) -> DataFrame:
    """The contexts of every order: (level, ctx, total, distinct, excluded, next) from the counts of the longest grams.

    ``excluded``: how often the successors of a context follow its suffix;
    ``next``: the counts by symbol.
    """
    levels = [grams.select(F.col("key").alias("gram"), "n")]
    for k in range(ORDER - 1, -1, -1):
        above = levels[-1]
        levels.append(above.groupBy(_low(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n")))
    tables = None
    for i, level in enumerate(levels):
        k = ORDER - i
        rows = level.withColumn("below", F.lit(0).cast("long"))
        if k:
            shorter = levels[i + 1].select(F.col("gram").alias("suffix"), F.col("n").alias("below"))
            rows = level.join(shorter, _low(F.col("gram"), k) == F.col("suffix"))
        entry = F.struct(_low(F.col("gram"), 1).cast("int").alias("symbol"), "n")
        nodes = rows.groupBy(F.shiftright("gram", BITS).alias("ctx")).agg(
            F.lit(k).alias("level"),
            F.sum("n").alias("total"),
            F.count("*").alias("distinct"),
            F.sum("below").alias("excluded"),
            F.map_from_entries(F.collect_list(entry)).alias("next"),
        )
        tables = nodes if tables is None else tables.unionByName(nodes)
    return tables


def _top(rows: DataFrame, most: int) -> DataFrame:
    """The rows with the largest n, whole classes of similar n, at most ``most`` of them."""
    size = F.floor(F.log2("n") * 16).cast("int")
    by_size = rows.groupBy(size.alias("size")).count().collect()  # a thousand classes at most
    held, least = 0, 1 << 30
    for r in sorted(by_size, key=lambda r: -r["size"]):
        if held + r["count"] > most:
            break
        held, least = held + r["count"], r["size"]
    return rows.where(size >= least)


class SlotTable:
    """Keys with values in two arrays by hash; a key whose places are taken is left out and not found."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys)).bit_length())
        self.shift, self.tables = np.uint64(64 - bits), []
        left = np.arange(len(keys))
        for salt in (1, 2):
            place = self._place(keys[left], salt)
            taken, first = np.unique(place, return_index=True)
            own_keys, own_values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.float64)
            own_keys[taken], own_values[taken] = keys[left[first]], values[left[first]]
            self.tables.append((salt, own_keys, own_values))
            left = np.delete(left, first)

    def _place(self, keys: np.ndarray, salt: int) -> np.ndarray:
        return (mixed(keys.view(np.uint64) + np.uint64(salt)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, 0 where not found, and whether found."""
        values, found = np.zeros(len(keys)), np.zeros(len(keys), bool)
        rest = np.arange(len(keys))
        for salt, own_keys, own_values in self.tables:
            place = self._place(keys[rest], salt)
            hit = own_keys[place] == keys[rest]
            at = rest[hit]
            values[at], found[at] = own_values[place[hit]], True
            rest = rest[~hit]
        return values, found


def _slots(rows: DataFrame) -> SlotTable:
    """(key, value, n) as a table, the frequent keys first; the caller bounds the rows."""
    got = rows.toArrow()
    order = np.argsort(-got.column("n").to_numpy(), kind="stable")
    return SlotTable(got.column("key").to_numpy()[order].astype(np.int64), got.column("value").to_numpy()[order])


_TAIL = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))
_PARTS = pa.schema(
    [("row_no", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()),
     ("base", pa.float64()), ("total", pa.float64()), ("rare_words", _TAIL), ("rare_grams", _TAIL)]
)


def _tails(tails: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Lists of (key, times), straight from the arrays."""
    ends = np.cumsum([0] + [len(keys) for keys, _ in tails]).astype(np.int32)
    keys, times = (np.concatenate([t[i] for t in tails]).astype(np.int64) for i in (0, 1))
    items = pa.StructArray.from_arrays([pa.array(keys), pa.array(times)], ["key", "times"])
    return pa.ListArray.from_arrays(pa.array(ends), items)


def _partial_scores(docs: DataFrame, words: SlotTable, grams: SlotTable) -> DataFrame:
    """Per row the sums over head keys; beside it, rows without sums that list its tail keys with their times.

    Tail keys leave with every group of texts or piece of a text that they were
    found in, so a worker holds those of one group, however long a text is.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((words, grams))  # at most HEAD keys each

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, of_gram = shipped.value
        for batch in batches:
            n = batch.num_rows
            row_no = batch.column(0).to_numpy()
            tokens, known = np.ones(n, np.int64), np.zeros(n, np.int64)
            base, total = np.zeros(n), np.zeros(n)
            for numbers, lengths, all_grams, hashes in _grouped(v.as_py() for v in batch.column(2)):
                values, found = of_gram.find(all_grams)
                w = np.concatenate(hashes).view(np.int64)
                w_values, w_found = of_word.find(w)
                rows, rare_words, rare_grams = [], [], []
                lo = w_lo = 0
                for number, length, own in zip(numbers, lengths, hashes):
                    hi, w_hi = lo + length, w_lo + len(own)
                    total[number] += values[lo:hi].sum()
                    tokens[number] += len(own)
                    known[number] += int(w_found[w_lo:w_hi].sum())
                    base[number] += w_values[w_lo:w_hi].sum()
                    if not (found[lo:hi].all() and w_found[w_lo:w_hi].all()):
                        rows.append(row_no[number])
                        rare_grams.append(_counted(all_grams[lo:hi][~found[lo:hi]]))
                        rare_words.append(_counted(w[w_lo:w_hi][~w_found[w_lo:w_hi]]))
                    lo, w_lo = hi, w_hi
                if rows:
                    sums = [pa.nulls(len(rows), _PARTS.field(i).type) for i in range(1, 6)]
                    columns = [pa.array(rows, pa.int64()), *sums, _tails(rare_words), _tails(rare_grams)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_PARTS)
            sums = [pa.array(tokens), pa.array(known), pa.array(base), pa.array(total)]
            columns = [batch.column(0), batch.column(1), *sums, pa.nulls(n, _TAIL), pa.nulls(n, _TAIL)]
            yield pa.RecordBatch.from_arrays(columns, schema=_PARTS)

    tail = "array<struct<key long, times long>>"
    schema = (
        f"row_no long, doc_id long, n_tokens long, known long, base double, total double, "
        f"rare_words {tail}, rare_grams {tail}"
    )
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text")
    return rows.mapInArrow(score, schema)


def log_probabilities(grams: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, value): the log10 probability of a gram's last symbol after the others, walking down the trie."""
    pending = grams.select(
        "key", F.lit(0.0).alias("value"), F.lit(0).cast("long").alias("gone"), F.lit(0).cast("long").alias("gone_n")
    ).withColumn("open", F.lit(True))
    symbol = _low(F.col("key"), 1).cast("int")
    for k in range(ORDER, -1, -1):
        level = nodes.where(F.col("level") == k).select(
            F.col("ctx").alias("node"), "total", "distinct", "excluded", "next"
        )
        ctx = F.shiftright(_low(F.col("key"), k + 1), BITS)
        met = pending.join(level, F.col("open") & (ctx == F.col("node")), "left")
        times = F.element_at("next", symbol)
        there = F.col("node").isNotNull()
        left = F.col("distinct") - F.col("gone")
        mass = 2 * (F.col("total") - F.col("gone_n"))
        step = (
            F.when(~there, 0.0)
            .when(times.isNotNull(), F.log10((2 * times - 1) / mass))
            .when(left > 0, F.log10(left / mass))
            .otherwise(0.0)
        )
        pending = met.select(
            "key",
            (F.col("value") + step).alias("value"),
            F.when(there, F.col("distinct")).otherwise(F.lit(0)).cast("long").alias("gone"),
            F.when(there, F.col("excluded")).otherwise(F.lit(0)).cast("long").alias("gone_n"),
            (F.col("open") & times.isNull()).alias("open"),
        )
    rest = F.when(F.col("open"), -F.log10(F.lit(ALPHABET) - F.col("gone"))).otherwise(0.0)
    return pending.select("key", (F.col("value") + rest).alias("value"))


def score(docs: DataFrame, train: DataFrame, head: int = HEAD) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) with a model of ``train`` (text).

    Returns doc_id, n_tokens, n_known, train_tokens, base_score, score.
    """
    ship_package(docs.sparkSession)
    counts = written(training_counts(train), "lm-counts")
    words, grams = counts.where(F.col("kind") == WORD), counts.where(F.col("kind") == GRAM)
    nodes = written(trie(grams), "lm-trie")
    longest = nodes.where(F.col("level") == ORDER).select(
        "ctx", "total", "distinct", F.explode("next").alias("symbol", "n")
    )
    seen = longest.select(
        F.shiftleft("ctx", BITS).bitwiseOR(F.col("symbol").cast("long")).alias("key"),
        F.log10((2 * F.col("n") - 1) / (2 * F.col("total"))).alias("value"),
        "n",
    )
    word_values = words.select("key", F.log10(F.col("n") + 1.0).alias("value"), "n")
    learned = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, vocabulary = learned["n"] or 0, learned["v"]
    ends = words.where(F.col("key") == END_WORD).select("n").first()
    parts = written(
        _partial_scores(
            docs, _slots(_top(word_values.where(F.col("key") != END_WORD), head)), _slots(_top(seen, head))
        ),
        "lm-partial",
    )

    def tail(column: str):
        return parts.select("row_no", F.explode(column).alias("t")).select("row_no", "t.key", "t.times")

    rare_grams, rare_words = tail("rare_grams"), tail("rare_words")
    values = log_probabilities(rare_grams.select("key").distinct(), nodes)
    gram_sums = rare_grams.join(values, "key").groupBy("row_no").agg(
        F.sum(F.col("times") * F.col("value")).alias("rare_total")
    )
    word_sums = rare_words.join(word_values, "key").groupBy("row_no").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.col("value")).alias("rare_base")
    )
    sums = parts.where(F.col("n_tokens").isNotNull()).drop("rare_grams", "rare_words")
    joined = sums.join(gram_sums, "row_no", "left").join(word_sums, "row_no", "left")
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    end_count = ends["n"] if ends else 0
    base = F.col("base") + or_zero("rare_base") + float(np.log10(end_count + 1))
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + or_zero("rare_known") + (1 if end_count else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (base - F.col("n_tokens") * float(np.log10(n_train + vocabulary + 1))).alias("base_score"),
        (F.col("total") + or_zero("rare_total")).alias("score"),
    )


def corpus_scores(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Learn from the documents that are not held out and score all."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    found = score(rows, rows.where(~held_out(F.col("doc_id"), folds, fold)))
    return found.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), *found.columns[1:])
