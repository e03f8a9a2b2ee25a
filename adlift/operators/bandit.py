"""Choosing a creative per ad request: greedy, epsilon-greedy, Thompson, A/B."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift.functions.scalars import hash32, ratio, rounded
from adlift.session import ship_package


def first_clicks(creative_id: str = "creative_id") -> Column:
    """Starting clicks of an arm, 1 to 4, fixed by its id."""
    return hash32(creative_id, "prior:") % 4 + 1


def arm_stats(
    catalog: DataFrame,
    served: DataFrame | None = None,
    prior_impressions: int = 10,
    prior_clicks: Column | None = None,
) -> DataFrame:
    """Impressions and clicks per creative: the starting counts plus what was served.

    ``served`` holds one row per shown ad: (creative_id, clicked 0/1).
    """
    start = catalog.select(
        "creative_id",
        "segment_id",
        "arm",
        F.lit(prior_impressions).cast("bigint").alias("_i0"),
        (prior_clicks if prior_clicks is not None else first_clicks()).cast("bigint").alias("_c0"),
    )
    if served is None:
        return start.withColumnsRenamed({"_i0": "impressions", "_c0": "clicks"})
    seen = served.groupBy("creative_id").agg(
        F.count(F.lit(1)).alias("_i1"), F.sum("clicked").alias("_c1")
    )
    return start.join(seen, "creative_id", "left").select(
        "creative_id",
        "segment_id",
        "arm",
        (F.col("_i0") + F.coalesce(F.col("_i1"), F.lit(0))).alias("impressions"),
        (F.col("_c0") + F.coalesce(F.col("_c1"), F.lit(0))).alias("clicks"),
    )


def weighted_arms(catalog: DataFrame, served: DataFrame, prior: int = 10) -> DataFrame:
    """The catalog with ``mab_arm_weight`` as its feedback (creative_id, shown, clicked) says.

    A weight is the arm's click rate over that of its segment. The arm's rate
    counts ``prior`` more ads with the segment's rate, the segment's one more
    click and two more ads, so an arm without feedback weighs 1.0.
    """
    arms = catalog.drop("mab_arm_weight").join(served, "creative_id", "left")
    arms = arms.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("shown", "clicked")})
    segments = arms.groupBy("segment_id").agg(
        ((F.sum("clicked") + 1) / (F.sum("shown") + 2)).alias("_rate")
    )
    rate = (F.col("clicked") + prior * F.col("_rate")) / (F.col("shown") + prior)
    weighted = arms.join(segments, "segment_id").withColumn("mab_arm_weight", rounded(rate / F.col("_rate"), 6))
    return weighted.select(*catalog.columns, "shown", "clicked")


def best_arm(stats: DataFrame) -> DataFrame:
    """Per segment the arm with the highest CTR; the first in catalog order on ties."""
    ctr = ratio(F.col("clicks"), F.col("impressions"))
    best = F.min(F.struct((-ctr).alias("neg_ctr"), "arm", "creative_id")).alias("b")
    return stats.groupBy("segment_id").agg(best, F.count(F.lit(1)).alias("arms")).select(
        "segment_id",
        F.col("b.creative_id").alias("creative_id"),
        rounded(-F.col("b.neg_ctr"), 6).alias("ctr"),
        "arms",
    )


def decide(
    requests: DataFrame,
    stats: DataFrame,
    epsilon: float = 0.15,
    seed: str = "42",
) -> DataFrame:
    """One creative per request (request_id, segment_id).

    A share ``epsilon`` of the requests, fixed by their ids, takes a uniform
    arm of its segment, the others the best one. A segment without arms falls
    back to the first creative of the catalog. Requests meet the arms on
    (segment, arm number); no candidate pairs are built.
    """
    best = best_arm(stats).select(
        "segment_id", F.col("creative_id").alias("best_id"), F.col("arms").alias("arms")
    )
    arms = stats.select("segment_id", F.col("arm").alias("pick"), F.col("creative_id").alias("picked_id"))
    first = stats.agg(F.min("creative_id").alias("first_id")).scalar()
    explores = hash32("request_id", f"explore:{seed}:") % 10_000 < F.lit(int(round(epsilon * 10_000)))
    known = requests.join(best, "segment_id", "left")
    if epsilon > 0:
        pick = (hash32("request_id", f"arm:{seed}:") % F.col("arms")).cast("int")
        known = known.withColumn("pick", F.when(explores, pick)).join(
            arms, ["segment_id", "pick"], "left"
        )
    else:
        known = known.withColumn("picked_id", F.lit(None).cast("string"))
    return known.select(
        *requests.columns,
        F.coalesce("picked_id", "best_id", first).alias("creative_id"),
        F.col("picked_id").isNotNull().alias("explored"),
    )


def _uniform(seed: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in (0, 1) fixed by (seed, step): a 64-bit mixing function."""
    with np.errstate(over="ignore"):
        z = seed + np.uint64(step) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _gamma(shape: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Gamma(shape >= 1) draws by squeeze-free Marsaglia-Tsang rejection, all rows at once."""
    d = shape - 1.0 / 3.0
    c = 1.0 / np.sqrt(9.0 * d)
    out = np.empty(len(shape))
    open_rows = np.arange(len(shape))
    step = 1
    while len(open_rows):
        s = seed[open_rows]
        u1, u2, u3 = (_uniform(s, step + i) for i in range(3))
        x = np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2)
        v = (1.0 + c[open_rows] * x) ** 3
        dd = d[open_rows]
        with np.errstate(invalid="ignore", divide="ignore"):
            ok = (v > 0) & (np.log(u3) < 0.5 * x * x + dd - dd * v + dd * np.log(v))
        out[open_rows[ok]] = dd[ok] * v[ok]
        open_rows = open_rows[~ok]
        step += 3
    return out


def _thompson_pick(seed: pd.Series, alphas: pd.Series, betas: pd.Series) -> pd.Series:
    """Position of the largest Beta draw per row; -1 where there are no arms."""
    sizes = np.array([0 if a is None else len(a) for a in alphas], dtype=np.int64)
    picks = np.full(len(sizes), -1, dtype=np.int32)
    if sizes.sum() == 0:
        return pd.Series(picks)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    arm = np.arange(len(row)) - np.repeat(starts, sizes)
    a = np.concatenate([x for x in alphas if x is not None]).astype(np.float64)
    b = np.concatenate([x for x in betas if x is not None]).astype(np.float64)
    base = seed.to_numpy(dtype=np.uint64)[row] * np.uint64(4096) + arm.astype(np.uint64)
    with np.errstate(over="ignore"):
        ga = _gamma(a, base * np.uint64(2))
        gb = _gamma(b, base * np.uint64(2) + np.uint64(1))
    draw = ga / (ga + gb)
    best = np.lexsort((arm, -draw, row))
    head = np.r_[True, row[best][1:] != row[best][:-1]]
    picks[row[best][head]] = arm[best][head]
    return pd.Series(picks)


def decide_thompson(requests: DataFrame, stats: DataFrame, seed: str = "42") -> DataFrame:
    """One creative per request by the largest Beta(clicks + 1, misses + 1) draw of its arms.

    Draws are fixed by (request, arm); requests without an id share one draw. The arms of a segment travel as one
    array, as long as its catalog page and no longer, so a request stays one
    row and nothing is shuffled by request.
    """
    arm = F.struct(
        "arm",
        "creative_id",
        (F.col("clicks") + 1).cast("double").alias("a"),
        (F.greatest(F.col("impressions") - F.col("clicks"), F.lit(0)) + 1).cast("double").alias("b"),
    )
    ship_package(requests.sparkSession)
    pages = stats.groupBy("segment_id").agg(F.sort_array(F.collect_list(arm)).alias("page"))
    first = stats.agg(F.min("creative_id").alias("first_id")).scalar()
    joined = requests.join(pages, "segment_id", "left")
    draw = F.pandas_udf(_thompson_pick, "int")
    request = F.coalesce(F.col("request_id").cast("string"), F.lit(""))
    pick = draw(hash32(request, f"ts:{seed}:"), F.col("page.a"), F.col("page.b"))
    chosen = joined.withColumn("pick", pick)
    creative = F.when(F.col("pick") >= 0, F.get(F.col("page"), F.col("pick"))["creative_id"])
    return chosen.select(*requests.columns, F.coalesce(creative, first).alias("creative_id"))


def pin_segments(requests: DataFrame, overrides: DataFrame) -> DataFrame:
    """Requests (request_id, segment_id) with the segments that ``overrides`` pins for some of them."""
    pinned = overrides.select("request_id", F.col("segment_id").alias("_pinned"))
    joined = requests.join(pinned, "request_id", "left")
    segment = F.coalesce("_pinned", "segment_id").alias("segment_id")
    return joined.select(*[segment if c == "segment_id" else F.col(c) for c in requests.columns])


def decision_rows(context: DataFrame, chosen: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per request: its context and propensity, the creative chosen and the text to show."""
    texts = catalog.select("creative_id", "copy_text")
    picked = chosen.join(texts, "creative_id", "left").select(
        "request_id", "segment_id", "creative_id", "copy_text", "explored"
    )
    return context.join(picked, "request_id", "left")


def ab_assignment(df: DataFrame, unit: str, shares: Mapping[str, float], salt: str = "ab") -> DataFrame:
    """``df`` with a variant per ``unit``, by hash bucket out of 10,000."""
    bucket = hash32(unit, f"{salt}:") % 10_000
    variant = None
    upto = 0.0
    for name, share in shares.items():
        upto += share
        cut = int(round(upto * 10_000))
        variant = F.when(F.col("bucket") < cut, name) if variant is None else variant.when(
            F.col("bucket") < cut, name
        )
    return df.withColumn("bucket", bucket.cast("int")).withColumn("variant", variant)


def rank_candidates(candidates: DataFrame, request: str, score: str, tie: list[str], top: int) -> DataFrame:
    """The ``top`` candidates of every request by score.

    The limit on the row number runs before the shuffle too, so a task sends
    at most ``top`` rows of a request.
    """
    order = Window.partitionBy(request).orderBy(F.desc(score), *tie)
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)
