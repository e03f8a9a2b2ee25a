"""Language identification by the nearest of several centroids per language.

A text becomes a vector of the byte n-grams of its letters (A-Z lower-cased,
anything else a single blank; two to four bytes, hashed to ``DIMS`` places),
weighted by 1 + log(count) and by inverse document frequency,
and scaled to length one. Document frequencies come from all training
documents. Spherical k-means over at most ``SAMPLE`` distinct training documents
per language, the ones with the smallest hash of id and text, gives
``CENTROIDS`` centroids for each; a document weighs as often as it occurs. A text gets the language of the centroid with the largest
cosine; that cosine is its score. It is marked as rejected where it lies
farther from the centroid than ``REJECT`` times the farthest sample document of
that centroid.

Training sees only text and language of documents that are not held out; a
prediction sees only the text. Null texts and texts without a letter are
``und`` with score 0, so is everything if nothing could be learned. Rows
without a language are predicted but never learned from. More than ``LANGS``
languages are an error. Texts are read whole, a megabyte at a time; further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.textbytes import PIECE, lowered

DIMS = 1 << 14
GRAMS = (2, 3, 4)
SAMPLE = 400
CENTROIDS = 4
ROUNDS = 8
REJECT = 1.5
UNKNOWN = "und"
#: Languages of a model: bounds what is collected and broadcast.
LANGS = 1000
#: Bytes of a-z, and of anything beyond ASCII.
_KEPT = np.zeros(256, bool)
_KEPT[0x61:0x7B] = _KEPT[0x80:] = True
_LETTER = regex.compile(r"\p{L}")
_SHIFT = np.uint64(64 - DIMS.bit_length() + 1)


def counts(text: str) -> np.ndarray:
    """Occurrences of n-grams by place; a blank stands before and after the text."""
    data = np.concatenate([[32], lowered(text), [32]]).astype(np.uint8)
    kept = _KEPT[data]
    data = np.where(kept, data, 32)[kept | np.append(True, kept[:-1])]
    out = np.zeros(DIMS, np.int64)
    for lo in range(0, len(data), PIECE):
        piece = data[lo : lo + PIECE + max(GRAMS) - 1].astype(np.uint64)
        own = len(data[lo : lo + PIECE])
        gram = piece
        for n in range(2, max(GRAMS) + 1):
            gram = gram[: len(piece) - n + 1] * np.uint64(257) + piece[n - 1 :]
            if n in GRAMS:
                # The last piece has no bytes behind it; others leave those to the next piece.
                place = (gram[:own] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
                out += np.bincount((place >> _SHIFT).astype(np.int64), minlength=DIMS)
    return out


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * idf
    length = np.linalg.norm(weighted)
    return (weighted / length if length > 0 else weighted).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _document_frequencies(docs: DataFrame) -> np.ndarray:
    """The share of the documents that hold an n-gram of each place, smoothed, as inverse document frequency."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                total += counts(value.as_py()) > 0
                n += 1
        places = np.flatnonzero(total)
        columns = [pa.array(np.append(places, -1), pa.int32()), pa.array(np.append(total[places], n), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n"])

    rows = docs.select("text").mapInArrow(seen, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r.place: r.n for r in rows.collect()}  # at most DIMS + 1 numbers
    df = np.array([found.get(i, 0) for i in range(DIMS)], np.float64)
    return np.log((1 + found.get(-1, 0)) / (1 + df)) + 1


def _clusters(rows: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, float]]:
    """Spherical k-means from spread-out starts: centroids, each with its farthest document's distance."""
    picked = [0]
    for _ in range(min(CENTROIDS, len(rows)) - 1):
        picked.append(int(np.argmin((rows @ rows[picked].T).max(axis=1))))
    centres = rows[picked].copy()
    for _ in range(ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            mean = (rows[nearest == k] * weights[nearest == k, None]).sum(axis=0)
            if (length := np.linalg.norm(mean)) > 0:
                centres[k] = mean / length
    cosine = rows @ centres.T
    nearest = cosine.argmax(axis=1)
    far = [1 - float(cosine[nearest == k, k].min()) if (nearest == k).any() else 0.0 for k in range(len(centres))]
    return list(zip(centres, far))


def _sample(usable: DataFrame, sample: int) -> DataFrame:
    """Of each language the ``sample`` distinct rows with the smallest draws: (lang, draw, n, text), n rows alike.

    Rows are told apart by a hash of id and text, so nothing is lost or drawn
    twice however often a row repeats; texts are not dealt by language.
    """
    keyed = usable.withColumn("draw", F.xxhash64("doc_id", "text"))
    alike = written(keyed.groupBy("lang", "draw").agg(F.count("*").alias("n")), "language-rows")
    sizes = written(alike.groupBy("lang").agg(F.count("*").alias("rows")), "language-sizes")
    if (langs := sizes.count()) > LANGS:
        raise ValueError(f"{langs} languages; a model holds at most {LANGS}")
    # Twice the wanted share first, by the draw alone; the ranks are then over few rows.
    share = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    few = alike.join(sizes, "lang").where(share * F.col("rows") <= 2.0 * sample + 50)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(share, "draw"))
    chosen = few.withColumn("rank", rank).where(F.col("rank") <= sample).select("lang", "draw", "n")
    chosen = written(chosen, "language-chosen")  # at most LANGS * sample rows
    met = keyed.select("lang", "draw", "text").join(chosen, ["lang", "draw"])
    return met.groupBy("lang", "draw").agg(F.first("n").alias("n"), F.first("text").alias("text"))


def train(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from the rows (doc_id, text, lang) given: idf, centroids, their languages and reach."""
    ship_package(docs.sparkSession)
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    idf = _document_frequencies(usable)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(value.as_py()).astype(np.int32).tobytes() for value in batch.column(3)]
            columns = [*batch.columns[:3], pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "draw", "n", "counts"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("draw")
        vectors = np.stack([vector(np.frombuffer(c, np.int32), idf) for c in rows["counts"]])
        found = _clusters(vectors, rows["n"].to_numpy(np.float32))
        return pd.DataFrame(
            {"lang": rows.lang.iloc[0], "centre": [c.tobytes() for c, _ in found], "far": [f for _, f in found]}
        )

    # A group is at most ``sample`` vectors of fixed size, however long the texts are.
    chosen = _sample(usable, sample).mapInArrow(counted, "lang string, draw long, n long, counts binary")
    fitted = chosen.groupBy("lang").applyInPandas(fit, "lang string, centre binary, far double")
    # CENTROIDS rows for each of at most LANGS languages.
    rows = sorted(fitted.collect(), key=lambda r: (r.lang, bytes(r.centre)))
    return {
        "idf": idf,
        "langs": [r.lang for r in rows],
        "centres": np.stack([np.frombuffer(r.centre, np.float32) for r in rows]) if rows else None,
        "reach": np.array([r.far * REJECT for r in rows]),
    }


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) from the text alone; one pass, no shuffle."""
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a bounded number of centroids

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py()
                if m["centres"] is None or not has_letter(text):
                    rows.append((UNKNOWN, 0.0, True))
                    continue
                cosine = m["centres"] @ vector(counts(text), m["idf"])
                k = int(cosine.argmax())
                score = min(1.0, max(0.0, float(cosine[k])))
                rows.append((m["langs"][k], score, 1 - score > m["reach"][k]))
            columns = zip(*rows) if rows else ([], [], [])
            kinds = (pa.string(), pa.float64(), pa.bool_())
            arrays = [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(nearest, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the crc32 of the id's text leaves the remainder ``fold``; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from the documents that are not held out and predict all: (doc_id, held_out, lang_pred, score, rejected)."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
        docs["lang"].cast("string").alias("lang"),
    )
    model = train(rows.where(~held_out(F.col("doc_id"))), sample)
    found = predict(rows, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
