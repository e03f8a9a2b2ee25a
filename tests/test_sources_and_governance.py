from __future__ import annotations

import glob

import pytest
from conftest import CLICK, ORDER, VIEW, at, click, order, view
from pyspark.sql import functions as F

from adlift import schemas as S
from adlift.operators import governance
from adlift.plans import medallion
from adlift.session import fresh_dir, shared_dir
from adlift.sources import bronze, sinks


def test_csv_round_trip_is_time_ordered(spark, tmp_path):
    df = spark.createDataFrame([order("b", 20), order("a", 10)], ORDER)
    sinks.export_csv(df, str(tmp_path / "orders"))
    lines = [line for f in sorted(glob.glob(str(tmp_path / "orders/*.csv"))) for line in open(f)]
    assert lines[0].startswith("order_id,timestamp,")
    assert [x.split(",")[0] for x in lines if not x.startswith("order_id")] == ["a", "b"]
    inferred = bronze.register_csv(spark, str(tmp_path / "orders"), "orders_csv")
    assert dict(inferred.dtypes)["timestamp"] == "timestamp"
    assert spark.sql("SELECT count(*) AS n FROM orders_csv WHERE order_amount = 10").first()["n"] == 2


def test_csv_with_schema(spark, tmp_path):
    df = spark.createDataFrame([view("i", 5)], VIEW)
    sinks.export_csv(df, str(tmp_path / "views"))
    back = bronze.read_csv(spark, str(tmp_path / "views"), S.IMPRESSIONS)
    assert back.first()["timestamp"] == at(5)


def test_bronze_schema_may_grow(spark, tmp_path):
    path = str(tmp_path / "clicks")
    old = spark.createDataFrame([click("a", 1)], CLICK)
    sinks.append_bronze(old, path)
    sinks.append_bronze(old.withColumn("app_version", F.lit("2.0")).withColumn("click_id", F.lit("b")), path)
    got = {r["click_id"]: r["app_version"] for r in bronze.read_log(spark, path, "clicks").collect()}
    assert got == {"a": None, "b": "2.0"}
    broken = str(tmp_path / "broken")
    old.drop("customer_id").write.parquet(broken)
    with pytest.raises(ValueError, match="customer_id"):
        bronze.read_log(spark, broken, "clicks")


def test_feature_table_needs_a_primary_key(spark):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, x int")
    sinks.register_feature_table(good, "customer_features_t", ["customer_id"], "customer's features")
    reader = spark.table("customer_features_t")
    assert reader.count() == 2
    more = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], good.schema)
    sinks.register_feature_table(more, "customer_features_t", ["customer_id"])
    assert spark.table("customer_features_t").agg({"x": "sum"}).first()[0] == 12
    wider = more.selectExpr("customer_id", "x", "x * 2 AS y")
    sinks.register_feature_table(wider, "customer_features_t", ["customer_id"])
    assert spark.table("customer_features_t").columns == ["customer_id", "x", "y"]
    with pytest.raises(ValueError, match="primary key"):
        sinks.register_feature_table(good.union(good), "customer_features_u", ["customer_id"])
    spark.sql("DROP TABLE customer_features_t")


def test_layers_from_files(spark, tmp_path):
    paths = medallion.Paths(str(tmp_path))
    views = [view(f"i{n}", n * 1000, customer=f"u{n % 3}") for n in range(12)]
    clicks = [click(f"c{n}", n * 1000 + 5, customer=f"u{n % 3}", impression=f"i{n}") for n in range(6)]
    orders = [order(f"o{n}", n * 2000 + 9, customer=f"u{n % 4}") for n in range(8)]
    for rows, schema, log in ((views, VIEW, "impressions"), (clicks, CLICK, "clicks"), (orders, ORDER, "orders")):
        # Every row arrives twice.
        sinks.append_bronze(spark.createDataFrame(rows + rows, schema), paths.bronze(log))
    silver = medallion.build_silver(spark, paths)
    assert silver.count() == 8
    assert "order_date" in silver.columns
    customers, merchants = medallion.build_gold(spark, paths)
    assert customers.count() == 3 and merchants.count() == 1
    assert merchants.first()["merchant_total_orders"] == 8
    assert medallion.build_creatives(spark, paths).count() > 0
    last = medallion.build_silver(spark, paths, mode="global_last")
    assert last.where("attributed_click_id IS NOT NULL").count() <= 8
    with pytest.raises(ValueError):
        medallion.build_silver(spark, paths, mode="first")


def test_shared_dir_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_pseudonyms_join_but_do_not_reveal(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2), ("v", 3), (None, 4)], "customer_id string, x int")
    out = {r["x"]: r["customer_id"] for r in governance.pseudonymize(df, "customer_id", "salt").collect()}
    assert out[1] == out[2] != out[3] and len(out[1]) == 64 and out[4] is None
    other = governance.pseudonymize(df, "customer_id", "pepper").first()["customer_id"]
    assert other != out[1]


def test_masks(spark):
    df = spark.createDataFrame([("usr_000123", 9.5, "Pizza", 1)], "a string, b double, c string, d int")
    out = governance.mask_columns(df, {"a": "prefix:4", "b": "null", "c": "constant:x"})
    assert tuple(out.first()) == ("usr_***", None, "x", 1)
    assert out.schema["b"].dataType == df.schema["b"].dataType
    with pytest.raises(ValueError):
        governance.mask_columns(df, {"a": "rot13"})


def test_row_filter(spark):
    df = spark.createDataFrame([("m1", 1), ("m2", 2), ("m1", 3)], "merchant_id string, x int")
    grants = spark.createDataFrame([("ana", "m1"), ("ana", "m1"), ("bo", "m2")], "principal string, merchant_id string")
    got = governance.filter_rows(df, grants, "ana", ["merchant_id"])
    assert sorted(r["x"] for r in got.collect()) == [1, 3]
    assert governance.filter_rows(df, grants, "eve", ["merchant_id"]).count() == 0
