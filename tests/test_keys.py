"""Dense surrogate keys equal row_number() OVER (ORDER BY key), without a one-task window."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierwise.functions.keys import dense_key_map, with_dense_key


def reference(df, key):
    return {r[key]: r["rn"] for r in df.select(
        key, F.row_number().over(Window.orderBy(F.col(key).asc_nulls_first())).alias("rn")).collect()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60, unique=True),
       st.integers(1, 7))
def test_dense_keys_match_row_number(spark, keys, parts):
    df = spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string")
    got = {r.k: r.sk for r in with_dense_key(df, ["k"], "sk", num_partitions=parts).collect()}
    assert got == reference(df, "k")
    assert sorted(got.values()) == list(range(1, len(keys) + 1))


def test_string_keys_and_offset(spark):
    df = spark.createDataFrame([(c,) for c in "qwertyuiopasdfgh"], "k string")
    m = {r.k: r.sk for r in dense_key_map(df, ["k"], "sk", offset=100, num_partitions=4).collect()}
    assert m == {k: 100 + v for k, v in reference(df, "k").items()}


def test_composite_keys(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (0, None)], "a int, b string")
    got = [tuple(r) for r in with_dense_key(df, ["a", "b"], "sk", 3).orderBy("sk").collect()]
    assert got == [(1, None, "z"), (2, 0, None), (3, 1, "a"), (4, 1, "b")]


def test_range_exchange_is_reused_not_single_partition(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    out = with_dense_key(df, ["k"], "sk", 4)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan
    assert "ReusedExchange" in plan or "Reused" in plan


def test_keys_stay_exact_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(0, 500).select(((F.col("id") * 7919) % 1000).alias("k"))
        got = {r.k: r.sk for r in dense_key_map(df, ["k"], "sk", num_partitions=5).collect()}
        assert got == reference(df.distinct(), "k")
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
