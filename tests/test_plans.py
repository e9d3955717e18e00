"""Plan shape tests and skew behaviour."""

from pyspark.sql import functions as F

from tierwise.operators import checks as ck
from tierwise.operators import kpis as kp
from tierwise.operators.clean import dedup


def plan_of(df):
    """The executed (final adaptive) plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_dedup_combines_map_side_before_the_shuffle(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = dedup(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_hot_key_holding_a_third_of_rows(spark):
    # one key holds a third of all rows; every row differs, the survivor is exact
    n = 30000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.lit(n) - F.col("id")).alias("v"))
    out = dedup(df.repartition(8), ["k"], ["v"])
    rows = {r.k: r.v for r in out.collect()}
    assert len(rows) == 1 + (n - n // 3)
    assert rows[-1] == n - (n - 3)  # smallest v among ids divisible by 3


def test_orphans_are_a_left_anti_join(spark):
    facts = spark.range(0, 100).select(F.col("id").alias("customer_id"))
    dim = spark.range(0, 90).select(F.col("id").alias("customer_id"), F.lit("x").alias("name"))
    out = ck.orphans(facts, dim, "customer_id")
    assert "LeftAnti" in plan_of(out)
    assert out.count() == 10


def test_checks_read_each_table_once(spark):
    df = spark.range(0, 500).select(F.col("id").alias("a"), (F.col("id") % 5).alias("b"))
    m = ck.MetricSet().add("t", df, rows=F.count(F.lit(1)), nulls=F.count_if(F.col("a").isNull()),
                           neg=F.count_if(F.col("b") < 0))
    res = ck.evaluate(m, [ck.Check("rows", "t.rows", 500), ck.Check("nulls", "t.nulls", 0),
                          ck.Check("neg", "t.neg", 0, details="found {actual}")])
    plan = plan_of(res)
    assert plan.count("Range (0, 500") == 1
    assert {r["check"]: r["status"] for r in res.collect()} == {
        "rows": "PASS", "nulls": "PASS", "neg": "PASS"}


def test_rollup_over_customer_joins_per_customer_rows(spark):
    fact = spark.range(0, 1000).select(
        (F.col("id") % 10).alias("customer_sk"), F.floor(F.col("id") / 4).alias("order_id"),
        F.lit(1.25).alias("amount"))
    dim = spark.range(0, 10).select(F.col("id").alias("customer_sk"),
                                    (F.col("id") % 2).cast("string").alias("region"),
                                    F.col("id").cast("string").alias("country_code"))
    out = kp.kpi_geo(fact, dim)
    rows = {(r.region, r.country_code): (r.line_count, str(r.revenue)) for r in out.collect()}
    assert rows[(None, None)] == (1000, "1250.0")
    # the aggregate on customer_sk sits below the join
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    assert "Aggregate [customer_sk" in plan[join_at:]


def joins_and_cuts(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Join "), plan.count("ExistingRDD") + plan.count("LogicalRDD")


def test_registry_plans_hold_only_what_the_key_asks_for(spark):
    """The bronze join, plus one join per dimension that is used; nothing is computed or
    cut beforehand. (A customer brings its nation and region, which its dedup compares.)"""
    import __spark_entry__ as entry
    from conftest import SMOKE_DIR

    expected = {"kpi_time": 1, "kpi_channel": 1, "kpi_daytype": 1, "kpi_category": 2, "check_profit": 2,
                "kpi_segment": 4, "kpi_geo": 4, "dim_product": 2, "dim_date_data": 1, "check_negative": 1,
                "check_nulls": 1, "check_schema": 0, "check_orphan_product": 2}
    got = {k: joins_and_cuts(entry.queries()[k](spark, SMOKE_DIR)) for k in expected}
    assert {k: j for k, (j, _) in got.items()} == expected
    assert all(c == 0 for _, c in got.values())


def test_hot_order_is_dealt_by_the_whole_key(spark):
    """Lines joined on the order, deduplicated on (order, line): a third of all lines are of
    one order. Their aggregate is combined, then dealt by both keys, whatever the session's
    skew settings are."""
    n = 30000
    lines = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("order_id"),
        (F.col("id") % 5000).alias("line_no"), F.col("id").alias("v"))
    orders = spark.range(-1, n).select(F.col("id").alias("order_id"), F.lit("web").alias("channel"))
    out = dedup(lines.join(orders.hint("merge"), "order_id"), ["order_id", "line_no"], ["v"])
    final, _, below = plan_of(out).partition("Exchange hashpartitioning(_groupingexpression")
    assert "functions=[min(" in final and "partial_min" in below and "SortMergeJoin" in below
    assert out.count() == n - n // 3 + 5000


def test_dedup_moves_no_column_twice(spark):
    """An ascending tie-break column is part of the packed row once."""
    df = spark.range(0, 30).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit("x").alias("w"))
    plan = dedup(df, ["k"], ["v", "k"])._jdf.queryExecution().analyzed().toString()
    assert plan.count("v, v#") == 1 and "k, k#" not in plan.split("min(", 1)[1].split(" AS _w", 1)[0]


def test_fact_reads_the_lines_once(spark):
    """Channels come off the silver lines' own exchange, not off a second join of the raw tables."""
    import __spark_entry__ as entry
    from conftest import SMOKE_DIR

    assert plan_of(entry.queries()["fact_sales"](spark, SMOKE_DIR)).count("lineitem.parquet") == 1


def test_view_moves_keys_not_names(spark):
    """The lines' exchanges and the groups' are by numbers; one row per group meets the names."""
    import __spark_entry__ as entry
    from conftest import SMOKE_DIR

    for key in ("kpi_star", "kpi_top"):
        plan = plan_of(entry.queries()[key](spark, SMOKE_DIR))
        assert plan.count("lineitem.parquet") == 1 and "hashpartitioning(date_sk_group" in plan
        assert "hashpartitioning(year" not in plan and "hashpartitioning(product_sk#" not in plan


def test_group_key_stands_for_equal_attributes(spark):
    from tierwise.operators import dims as dm

    dim = spark.createDataFrame([(5, "a", None), (2, "a", None), (3, "a", "x"), (4, None, None), (9, None, None)],
                                "product_sk bigint, category string, brand string")
    got = {r.product_sk: r.product_sk_group for r in dm.with_group(dim, "product_sk", ["category", "brand"]).collect()}
    assert got == {5: 2, 2: 2, 3: 3, 4: 4, 9: 4}


def test_checks_cut_nothing_and_health_cuts_what_it_reads(spark):
    import __spark_entry__ as entry
    from conftest import SMOKE_DIR

    checks = entry.queries()["checks_summary"](spark, SMOKE_DIR)
    assert joins_and_cuts(checks)[1] == 0
    health = entry.queries()["health_counts"](spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in health.splitlines() if "RDD" in line and ("unit_price" in line or "ship_date" in line)]
