"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of the byte n-grams (four to six bytes) of its letters,
A-Z lower-cased and anything else a single blank, hashed to ``DIMS`` places.
Three steps learn from labelled text:

1. Over *all* labelled rows, how many toxic and how many other texts hold each
   place: one pass, summed per task and then by Spark. Ratio of a place:
   log((p + a) / sum(p + a)) - log((q + a) / sum(q + a)), p and q its toxic and
   other counts, a = ``SMOOTH``.
2. The ``FEATURES`` places whose shares differ most (two-proportion z, at least
   ``LEAST_Z``) become features; the value of a feature is its ratio.
3. A logistic regression with an L2 penalty on those values, fitted by Spark ML
   on at most about ``SAMPLE`` rows of each class (rows drawn by a hash of
   their number and weighted back to the size of their class).

A score is a function of the text alone. Null and empty texts have no n-gram
and get the score of the intercept. Rows without a label, an id or a text teach
nothing; several labels of one id count once, as toxic if any is; rows that
repeat weigh as often as they occur. Without a toxic row every score is 0,
without any other row 1; without labels 0. Texts are read whole, a megabyte at
a time. Further columns of the tables are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package, written
from adlift.llm.language_id import held_out
from adlift.llm.textbytes import PIECE, lowered

DIMS = 1 << 20
GRAMS = (4, 5, 6)
FEATURES = 8192
LEAST_Z = 4.0
#: Count added to every place: the ratio of a place that one class alone holds stays large.
SMOOTH = 0.1
SAMPLE = 20_000
PENALTY = 1e-4
_SHIFT = np.uint64(64 - DIMS.bit_length() + 1)
#: Bytes of a-z, and of anything beyond ASCII.
_KEPT = np.zeros(256, bool)
_KEPT[0x61:0x7B] = _KEPT[0x80:] = True


def grams(text: str | None) -> Iterator[np.ndarray]:
    """The places of a text's n-grams, with repeats, piece by piece; a blank stands before and after the text."""
    data = np.concatenate([[32], lowered(text), [32]]).astype(np.uint8)
    kept = _KEPT[data]
    data = np.where(kept, data, 32)[kept | np.append(True, kept[:-1])]
    for lo in range(0, len(data), PIECE):
        piece = data[lo : lo + PIECE + max(GRAMS) - 1].astype(np.uint64)
        own, gram = len(data[lo : lo + PIECE]), piece
        for n in range(2, max(GRAMS) + 1):
            if len(piece) < n:
                break
            gram = gram[: len(piece) - n + 1] * np.uint64(257) + piece[n - 1 :]
            if n in GRAMS:
                place = (gram[:own] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
                yield (place >> _SHIFT).astype(np.int32)


def places(text: str | None, wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct places of a text's n-grams, or those of them that are wanted."""
    if wanted is not None:
        out = [at[wanted[at]] for at in grams(text)]
    else:
        out = [np.unique(at) for at in grams(text)]
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.int32)


def place_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Per place the toxic and the other texts that hold it, and how many texts there are of both kinds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, DIMS + 1), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[int(toxic), places(text.as_py())] += 1
                total[int(toxic), DIMS] += 1
        used = np.flatnonzero(total.any(axis=0))
        columns = [pa.array(used, pa.int32()), *[pa.array(total[k, used], pa.int64()) for k in (1, 0)]]
        yield pa.RecordBatch.from_arrays(columns, ["place", "p", "q"])

    rows = labelled.select("toxic", "text").mapInArrow(counted, "place int, p long, q long")
    # At most DIMS + 1 rows.
    found = rows.groupBy("place").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow()
    p, q = np.zeros(DIMS + 1, np.int64), np.zeros(DIMS + 1, np.int64)
    at = found.column("place").to_numpy()
    p[at], q[at] = found.column("p").to_numpy(), found.column("q").to_numpy()
    return p[:DIMS], q[:DIMS], int(p[DIMS]), int(q[DIMS])


def ratios(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Log-count ratios of all places."""
    p, q = p + SMOOTH, q + SMOOTH
    return np.log(p / p.sum()) - np.log(q / q.sum())


def choose(p: np.ndarray, q: np.ndarray, n_p: int, n_q: int, features: int = FEATURES) -> np.ndarray:
    """The places whose shares among toxic and other texts differ most, in ascending order."""
    share = (p + q) / (n_p + n_q)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / n_p + 1 / n_q), 1e-300))
    z = np.where(p + q > 0, np.abs(p / n_p - q / n_q) / spread, 0)
    best = np.argsort(-z, kind="stable")[:features]
    return np.sort(best[z[best] >= LEAST_Z])


def _held(labelled: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(toxic, held): the chosen places of each text, as words."""
    mask = np.zeros(DIMS, bool)
    mask[chosen] = True
    shipped = labelled.sparkSession.sparkContext.broadcast(mask)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shipped.value
        for batch in batches:
            rows = []
            for text in batch.column(1):
                rows.append([str(i) for i in places(text.as_py(), wanted)])
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "held"])

    return labelled.select("toxic", "text").mapInArrow(kept, "toxic int, held array<string>")


def train(labelled: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> dict:
    """A model from the rows (toxic 0 or 1, text): places, their weights and the intercept."""
    ship_package(labelled.sparkSession)
    rows = labelled.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("toxic").cast("int"), F.col("text").cast("string")
    )
    # Read twice more; a table of its own, so that the row numbers stay what they are.
    rows = written(rows.where("toxic IS NOT NULL AND text IS NOT NULL"), "labelled-texts", compression="zstd")
    p, q, n_p, n_q = place_counts(rows)
    none = np.zeros(0, np.int64)
    if not n_p or not n_q:
        return {"places": none, "weights": none.astype(np.float64), "intercept": np.inf if n_p else -np.inf}
    chosen, ratio = choose(p, q, n_p, n_q, features), ratios(p, q)
    if not len(chosen):
        return {"places": none, "weights": none.astype(np.float64), "intercept": float(np.log(n_p / n_q))}
    draw = F.pmod(F.xxhash64("row_no"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, sample / n_p)).otherwise(min(1.0, sample / n_q))
    few = written(_held(rows.where(draw < share), chosen), "labelled-features")
    sizes = {r.toxic: r.n for r in few.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weigh = [F.lit(n / max(1, sizes.get(k, 0))) for k, n in ((1, n_p), (0, n_q))]
    words = CountVectorizerModel.from_vocabulary([str(i) for i in chosen], "held", "present", binary=True)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratio[chosen]), inputCol="present", outputCol="features")
    data = few.select(
        F.col("toxic").cast("double").alias("label"), "held", F.when(F.col("toxic") == 1, weigh[0]).otherwise(weigh[1]).alias("weight")
    )
    fit = LogisticRegression(regParam=PENALTY, standardization=False, maxIter=60, weightCol="weight")
    found = fit.fit(scaled.transform(words.transform(data)))
    return {
        "places": chosen,
        "weights": found.coefficients.toArray() * ratio[chosen],
        "intercept": float(found.intercept),
    }


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, predicted) from the text alone; one pass, no shuffle."""
    ship_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES places

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        weight, wanted = np.zeros(DIMS), np.zeros(DIMS, bool)
        weight[m["places"]], wanted[m["places"]] = m["weights"], True
        for batch in batches:
            margin = []
            for text in batch.column(1):
                margin.append(m["intercept"] + weight[places(text.as_py(), wanted)].sum())
            value = 1 / (1 + np.exp(-np.clip(np.array(margin, np.float64), -700, 700)))
            value = np.where(np.isinf(margin), np.sign(margin) > 0, value).astype(np.float64)
            columns = [batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(judged, "doc_id long, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from the labelled documents that are not held out and score all: (doc_id, held_out, score, predicted)."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), (labels["toxic"] > 0).cast("int").alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"), 5, 0))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels grow with the documents: the two meet by a shuffle at any size.
    taught = rows.where("text IS NOT NULL").where(~held_out(F.col("doc_id"), 5, 0)).join(marks.hint("merge"), "doc_id")
    found = score(rows, train(taught, sample))
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
