"""Click-propensity model: boosted trees on the executors, scoring, run log."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.operators.features import FEATURE_COLUMNS, batch_lookup, one_hot
from adlift.session import fresh_dir

#: Each level of each tree is a round of tasks, so their number is bounded whatever the rows.
MOST_TASKS = 2_000
VECTORS_PER_TASK = 100_000


_SIDES = ((1.0, "positives"), (0.0, "negatives"))


@dataclass(frozen=True)
class BoostingParams:
    """Fixed values of the propensity model."""

    n_estimators: int = 120
    learning_rate: float = 0.05
    max_depth: int = 5
    subsample: float = 0.8
    colsample: float = 0.8
    random_state: int = 42


def weighted_vectors(
    matrix: DataFrame, label: str = "has_clicked", features: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """The distinct feature vectors with ``positives`` and ``negatives``, the rows of either label.

    Features come from gold tables and few categories, so vectors are at most as many
    as the (customer snapshot, merchant snapshot, placement, device) groups seen. Rows
    without a label count for neither; vectors of such rows alone stay, with zeros.
    """
    return matrix.groupBy(*features).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
        F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
    )


def train_propensity(
    matrix: DataFrame,
    label: str = "has_clicked",
    features: Sequence[str] = FEATURE_COLUMNS,
    params: BoostingParams = BoostingParams(),
) -> PipelineModel:
    """Fit on the rows of ``matrix``, as weighted distinct vectors. Runs jobs; rows stay on the executors.

    A vector weighs as many rows as it stands for, once per label. Subsampling
    draws vectors in place of rows.
    """
    folder = fresh_dir(matrix.sparkSession, "training-vectors")  # boosting cuts its lineage there, too
    trees = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        weightCol="weight",
        maxIter=params.n_estimators,
        stepSize=params.learning_rate,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.colsample),
        seed=params.random_state,
        checkpointInterval=10,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    weights = F.explode(
        F.array(*[F.struct(F.lit(y).alias("y"), F.col(c).cast("double").alias("w")) for y, c in _SIDES])
    )
    weighted_vectors(matrix, label, features).select(*features, weights.alias("side")).select(
        *features, F.col("side.y").alias(label), F.col("side.w").alias("weight")
    ).where("weight > 0").write.parquet(folder)
    vectors = matrix.sparkSession.read.parquet(folder)
    # Rows are dealt and ordered by their values: subsampling follows places in partitions, and
    # so a fit can be repeated on any cluster.
    tasks = min(MOST_TASKS, vectors.count() // VECTORS_PER_TASK + 1)
    columns = [*features, label]
    dealt = vectors.repartition(tasks, *columns).sortWithinPartitions(*columns)
    # Class count, split points and boosting each pass over the rows.
    rows = dealt.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[assembler, trees]).fit(rows)
    finally:
        rows.unpersist()


def score(model: PipelineModel, matrix: DataFrame, name: str = "propensity") -> DataFrame:
    """``matrix`` with the probability of the positive class."""
    scored = model.transform(matrix)
    return scored.select(*matrix.columns, vector_to_array("probability")[1].alias(name))


def score_requests(
    model: PipelineModel,
    requests: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    missing: str = "serving_defaults",
) -> DataFrame:
    """Propensity for (customer_id, merchant_id, ad_placement, device) rows from ids alone."""
    vectors = batch_lookup(requests, customers, merchants, missing)
    # A null stored under a known key has no serving default; the trees need a number.
    filled = vectors.select(
        *requests.columns,
        "customer_found",
        "merchant_found",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in S.NUMERIC_FEATURES],
        *one_hot("ad_placement", S.PLACEMENTS),
        *one_hot("device", S.DEVICES),
    )
    scored = score(model, filled)
    return scored.select(*requests.columns, "customer_found", "merchant_found", "propensity")


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    run_name: str,
    params: BoostingParams,
    metrics: Mapping[str, float],
    model: PipelineModel | None = None,
    lookups: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Append one run to the ``runs`` table below ``path``, and save the model beside it."""
    artifact = f"{path}/models/{run_name}" if model is not None else None
    if model is not None:
        model.write().overwrite().save(artifact)
    row = Row(
        experiment=experiment,
        run_name=run_name,
        params=json.dumps(asdict(params), sort_keys=True),
        metrics={k: float(v) for k, v in metrics.items()},
        lookups=json.dumps({k: list(v) for k, v in (lookups or {}).items()}, sort_keys=True),
        artifact=artifact,
    )
    schema = (
        "experiment string, run_name string, params string, metrics map<string,double>, "
        "lookups string, artifact string"
    )
    runs = spark.createDataFrame([row], schema).withColumn("logged_at", F.current_timestamp())
    runs.coalesce(1).write.mode("append").parquet(f"{path}/runs")


def load_model(spark: SparkSession, path: str, run_name: str) -> tuple[PipelineModel, dict]:
    """The saved model of a run and the feature lookups it was logged with."""
    run = (
        spark.read.parquet(f"{path}/runs")
        .where(F.col("run_name") == run_name)
        .orderBy(F.desc("logged_at"))
        .first()
    )
    return PipelineModel.load(run["artifact"]), json.loads(run["lookups"])
