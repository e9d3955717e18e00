"""Joins of heavy keys."""

import pytest
from pyspark.sql import functions as F

from tierwise.operators.skew import heavy_keys, left_join

N = 30_000


@pytest.fixture
def bare(spark):
    """As a session that sets nothing: no skew handling, no broadcast of the dimension."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def lines(spark):
    """A third of all lines on product 7, a tenth without a product, one orphan."""
    k = F.col("id")
    return spark.range(N).select(k, F.when(k % 3 == 0, 7).when(k % 10 == 1, None).when(k == 2, -5).otherwise(k % 5000).alias("product_id"))


def test_a_heavy_product_is_dealt_over_tasks(bare):
    dim = bare.range(5000).select(F.col("id").alias("product_id"), (F.col("id") * 2).alias("cost"))
    heavy = {r["_hot"]: r["_parts"] for r in heavy_keys(lines(bare), "product_id", 16).collect()}
    assert heavy[7] >= 8 and len(heavy) <= 1000
    got = left_join(lines(bare), dim, "product_id").withColumn("task", F.spark_partition_id())
    sizes = sorted(r["count"] for r in got.groupBy("task").count().collect())
    assert sum(sizes) == N and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    plain = lines(bare).join(dim, "product_id", "left")
    assert got.drop("task").exceptAll(plain.select(*got.drop("task").columns)).isEmpty()
    assert got.count() == plain.count()


def test_left_join_of_nothing(spark):
    dim = spark.range(3).select(F.col("id").alias("product_id"), F.lit(1).alias("cost"))
    assert left_join(lines(spark).limit(0), dim, "product_id").count() == 0
    got = left_join(lines(spark).limit(50), dim.limit(0), "product_id")
    assert got.count() == 50 and got.where("cost IS NOT NULL").isEmpty()
