from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from adlift.operators import model
from adlift.operators.evaluation import binary_metrics
from adlift.operators.features import FEATURE_COLUMNS
from adlift.session import fresh_dir

PARAMS = model.BoostingParams(n_estimators=8, max_depth=3)


@pytest.fixture(scope="module")
def matrix(spark):
    noise = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100)) / 100).alias(c) for i, c in enumerate(FEATURE_COLUMNS)]
    df = spark.range(600).select(F.format_string("i%d", "id").alias("impression_id"), *noise)
    return df.withColumn("has_clicked", (F.col("user_historical_ctr") > 0.6).cast("int")).cache()


@pytest.fixture(scope="module")
def fitted(matrix):
    return model.train_propensity(matrix, params=PARAMS)


def test_model_learns_a_threshold(matrix, fitted):
    got = binary_metrics(model.score(fitted, matrix), "propensity", "has_clicked").first()
    assert got["auc_roc"] > 0.99


def test_repeated_rows_are_weights(spark, matrix, fitted):
    """A vector of n rows counts n times; the fit sees it once per label."""
    thrice = matrix.unionByName(matrix).unionByName(matrix.withColumn("has_clicked", F.lit(None).cast("int")))
    thrice = thrice.unionByName(matrix.limit(5).withColumn("has_clicked", F.lit(1)))
    got = model.weighted_vectors(thrice)
    sums = got.agg(F.count(F.lit(1)), F.sum("positives"), F.sum("negatives")).first()
    ones = matrix.where("has_clicked = 1").count()
    assert tuple(sums) == (matrix.count(), 2 * ones + 5, 2 * (matrix.count() - ones))
    again = model.train_propensity(matrix.unionByName(matrix), params=PARAMS)
    once = {r["impression_id"]: r["propensity"] for r in model.score(fitted, matrix).collect()}
    twice = {r["impression_id"]: r["propensity"] for r in model.score(again, matrix).collect()}
    # Doubled weights leave every split and mean as it is.
    assert max(abs(once[i] - twice[i]) for i in once) < 1e-6


def test_run_log_and_reload(spark, matrix, fitted):
    path = fresh_dir(spark, "runs")
    model.log_run(spark, path, "propensity", "v1", PARAMS, {"auc_roc": 0.9}, fitted, {"customer_id": ["a"]})
    model.log_run(spark, path, "propensity", "v2", PARAMS, {"auc_roc": 0.8})
    runs = {r["run_name"]: r for r in spark.read.parquet(f"{path}/runs").collect()}
    assert runs["v1"]["metrics"] == {"auc_roc": 0.9} and runs["v2"]["artifact"] is None
    assert json.loads(runs["v1"]["params"])["max_depth"] == 3
    again, lookups = model.load_model(spark, path, "v1")
    assert lookups == {"customer_id": ["a"]}
    want = sorted(map(tuple, model.score(fitted, matrix).select("impression_id", "propensity").collect()))
    got = sorted(map(tuple, model.score(again, matrix).select("impression_id", "propensity").collect()))
    assert got == want


def test_requests_are_scored_from_ids(spark, fitted):
    from test_features import CUSTOMERS, MERCHANTS

    customers = spark.createDataFrame([("u", 3, 20.0, 0.5, 1.5, 0.9, "Pizza")], CUSTOMERS)
    merchants = spark.createDataFrame([("m", 9, 30.0, 0.25, "Pizza")], MERCHANTS)
    asked = [("1", "u", "m", "feed_banner_top", "ios"), ("2", "?", "?", "feed_banner_top", "ios")]
    requests = spark.createDataFrame(
        asked, "request_id string, customer_id string, merchant_id string, ad_placement string, device string"
    )
    got = {r["request_id"]: r for r in model.score_requests(fitted, requests, customers, merchants).collect()}
    assert got["1"]["propensity"] > 0.5 > got["2"]["propensity"]
    assert got["1"]["customer_found"] and not got["2"]["customer_found"]


def test_defaults_are_the_fixed_parameters():
    p = model.BoostingParams()
    assert (p.n_estimators, p.learning_rate, p.max_depth, p.subsample, p.colsample, p.random_state) == (
        120, 0.05, 5, 0.8, 0.8, 42,
    )
