"""Exact money arithmetic: cents, half-away-from-zero rounding, view == DataFrame."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMOKE_DIR
from tierwise.functions.money import avg_cents, cents, from_cents, pct_tenths, rounded_ratio
from tierwise.plans import pipeline as pl


def test_rounded_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (1, 3), (2, 3), (-1, 2), (7, 0), (0, 4)],
                               "n bigint, d bigint")
    got = [r.q for r in df.select(rounded_ratio("n", "d", 1).alias("q")).collect()]
    assert got == [3, -3, 0, 1, -1, None, 0]


def test_cents_and_back(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (1234.565,), (-19.99,), (None,)], "a double")
    rows = df.select(cents("a").alias("c"), from_cents(cents("a")).alias("x")).collect()
    assert [r.c for r in rows] == [30, 123457, -1999, None]
    assert [r.x for r in rows] == [0.3, 1234.57, -19.99, None]


def test_average_and_margin(spark):
    df = spark.createDataFrame([(15998, 1, 10998), (5997, 3, 1947), (100, 3, -1)],
                               "rev bigint, n bigint, gp bigint")
    rows = df.select(avg_cents("rev", "n").alias("avg"), pct_tenths("gp", "rev").alias("m")).collect()
    assert [(r.avg, r.m) for r in rows] == [(159.98, 68.7), (19.99, 32.5), (0.33, -1.0)]


def test_kpi_view_sql_equals_kpi_dataframe(spark):
    """The written-table view (Spark SQL) and the registry plan (DataFrame API)
    give the same rows on the driver's smoke data."""
    p = pl.Pipeline(spark, pl.testdata_sources(spark, SMOKE_DIR), database="kpi_parity")
    p.bronze(); p.silver(); p.gold()
    view = spark.table("kpi_parity.vw_sales_kpis")
    plan = entry.queries()["kpi_star"](spark, SMOKE_DIR)
    assert view.count() == plan.count() > 0
    assert view.exceptAll(plan.select(*view.columns)).count() == 0
    assert plan.select(*view.columns).exceptAll(view).count() == 0
    assert view.agg(F.sum("units_sold")).first()[0] == plan.agg(F.sum("units_sold")).first()[0]


def test_ratios_of_sums_beyond_a_bigint(spark):
    """1e18 cents in one group: twenty times that in the numerator must not overflow."""
    from tierwise.operators import kpis as kp

    one = 10 ** 18
    df = spark.createDataFrame([(one, one // 4, 3)], "r bigint, g bigint, n bigint").select(
        F.explode(F.sequence(F.lit(1), F.lit(20))), "r", "g", "n")
    total = df.agg(kp.total("r"), kp.total("g"), F.sum("n").alias("n"))
    row = total.select(pct_tenths("g", "r").alias("p"), avg_cents("r", "n").alias("a")).first()
    assert row.p == 25.0 and row.a == round(20 * one / 60) / 100
