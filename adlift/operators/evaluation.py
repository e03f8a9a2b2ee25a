"""Train/test split and ranking metrics, exact and without one-task windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.functions.scalars import hash32, ratio, rounded

_EPS = 2.220446049250313e-16


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.20, seed: int = 42
) -> DataFrame:
    """``df`` with ``is_test``: the first ``test_share`` of each label in hash order.

    Rows are spread over 65,536 hash cells per label, the cell that holds the
    cut over 65,536 finer ones. Cells wholly on one side of the cut are decided
    by their counts; only ids of the finest cell that holds the cut are ranked.
    Copies of an id fall on the same side. Null labels are a label of their
    own, null ids one id.
    """
    ids = (
        df.groupBy(F.col(label).alias("_label"), F.col(id_col).alias("_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_h", hash32(F.coalesce(F.col("_id").cast("string"), F.lit("")), f"{seed}:"))
        .withColumn("_ahead", F.lit(0).cast("bigint"))
    )
    quota = ids.groupBy(F.col("_label").alias("_of")).agg(
        F.floor(F.sum("_n") * F.lit(test_share) + F.lit(0.5)).alias("_quota")
    )
    open_ids = ids.join(quota, F.col("_label").eqNullSafe(F.col("_of"))).drop("_of")
    sides = None
    for cell in (F.shiftright("_h", 16), F.col("_h").bitwiseAND(F.lit(0xFFFF).cast("bigint"))):
        placed = _ahead_by_cell(open_ids.withColumn("_cell", cell))
        edge = (F.col("_ahead") < F.col("_quota")) & (F.col("_ahead") + F.col("_cell_n") > F.col("_quota"))
        decided = placed.where(~edge).drop("_cell_n")
        sides = decided if sides is None else sides.unionByName(decided)
        open_ids = placed.where(edge).drop("_cell_n")
    rank = Window.partitionBy("_label").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_n").over(rank), F.lit(0))
    sides = sides.unionByName(open_ids.withColumn("_ahead", F.col("_ahead") + earlier))
    sides = sides.select("_label", "_id", (F.col("_ahead") < F.col("_quota")).cast("int").alias("is_test"))
    same = F.col(label).eqNullSafe(F.col("_label")) & F.col(id_col).eqNullSafe(F.col("_id"))
    return df.join(sides, same).select(*[df[c] for c in df.columns], "is_test")


def _ahead_by_cell(ids: DataFrame) -> DataFrame:
    """``_ahead`` moved on by the rows in the cells before, and ``_cell_n``, the rows of the own cell."""
    cells = ids.groupBy(F.col("_label").alias("_of"), F.col("_cell").alias("_in")).agg(F.sum("_n").alias("_cell_n"))
    in_order = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_cell_n").over(in_order), F.lit(0)))
    same = F.col("_label").eqNullSafe(F.col("_of")) & (F.col("_cell") == F.col("_in"))
    placed = ids.join(cells, same).withColumn("_ahead", F.col("_ahead") + F.col("_before"))
    return placed.drop("_of", "_in", "_before", "_cell")


def binary_metrics(
    scored: DataFrame, score: str, label: str, threshold: float = S.DECISION_THRESHOLD
) -> DataFrame:
    """ROC AUC, average precision, log loss and F1 in one row.

    Rows collapse to one per distinct score. Running counts over the scores
    are built on two grids of the score range, 2^24 cells inside 2^12, so a
    window sees one fine cell, the cells of one coarse cell, or the coarse
    cells, never all scores. Scores are probabilities: one outside [0, 1] fails
    the query, as the grid would not be bounded.
    """
    outside = (F.col(score) < 0) | (F.col(score) > 1)
    checked = F.when(outside, F.raise_error(F.lit("scores have to lie in [0, 1]")).cast("double"))
    scored = scored.withColumn(score, F.coalesce(checked, F.col(score)))
    per_score = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(
            F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
            F.sum((F.col(label) != 1).cast("bigint")).alias("neg"),
        )
        .withColumn("fine", F.floor(F.col("s") * F.lit(float(2**24))))
        .withColumn("coarse", F.floor(F.col("fine") / F.lit(2**12)))
    )
    fine = per_score.groupBy("coarse", "fine").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    coarse = fine.groupBy("coarse").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def above(column: str, w) -> Column:
        return F.coalesce(F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    w = Window.orderBy(F.desc("coarse"))
    coarse = coarse.select("coarse", above("pos", w).alias("pos1"), above("neg", w).alias("neg1"))
    w = Window.partitionBy("coarse").orderBy(F.desc("fine"))
    fine = fine.select("coarse", "fine", above("pos", w).alias("pos2"), above("neg", w).alias("neg2"))
    offsets = fine.join(coarse, "coarse").select(
        "coarse",
        "fine",
        (F.col("pos1") + F.col("pos2")).alias("pos_off"),
        (F.col("neg1") + F.col("neg2")).alias("neg_off"),
    )
    w = Window.partitionBy("coarse", "fine").orderBy(F.desc("s"))
    ranked = (
        per_score.select("*", above("pos", w).alias("pos0"), above("neg", w).alias("neg0"))
        .join(offsets, ["coarse", "fine"])
        .select(
            "s",
            *[F.col(c).cast("double").alias(c) for c in ("pos", "neg")],
            (F.col("pos0") + F.col("pos_off")).cast("double").alias("pos_above"),
            (F.col("neg0") + F.col("neg_off")).cast("double").alias("neg_above"),
        )
    )
    pos, neg = F.col("pos"), F.col("neg")
    through_pos = F.col("pos_above") + pos
    through = through_pos + F.col("neg_above") + neg
    clipped = F.least(F.lit(1 - _EPS), F.greatest(F.lit(_EPS), F.col("s")))
    taken = F.col("s") >= F.lit(threshold)
    sums = ranked.agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.sum(neg * (F.col("pos_above") + pos / 2)).alias("wins"),
        F.sum(pos * through_pos / through).alias("precision"),
        F.sum(-pos * F.log(clipped) - neg * F.log(F.lit(1.0) - clipped)).alias("loss"),
        F.sum(F.when(taken, pos).otherwise(0.0)).alias("tp"),
        F.sum(F.when(taken, neg).otherwise(0.0)).alias("fp"),
    )
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "tp", "fp"))
    return sums.select(
        (p + n).cast("bigint").alias("observations"),
        p.cast("bigint").alias("positives"),
        rounded(ratio(F.col("wins"), p * n), 6).alias("auc_roc"),
        rounded(ratio(F.col("precision"), p), 6).alias("pr_auc"),
        rounded(ratio(F.col("loss"), p + n), 6).alias("log_loss"),
        rounded(F.coalesce(ratio(2 * tp, tp + fp + p), F.lit(0.0)), 6).alias("f1_score"),
    )
