"""Property tests: nothing is lost, dedup is idempotent, rollups add up."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwise.operators import kpis as kp
from tierwise.operators import silver as sv
from tierwise.operators.clean import dedup, split

ENT = sv.sample_sales_entity()
COLS = ("order_id string, customer_id string, product_id string, order_date string, "
        "quantity string, unit_price string, amount string, channel string, discount_pct string")

order_rows = st.lists(st.tuples(
    st.sampled_from(["O1", "O2", "O3", " O1", "O4 "]),
    st.one_of(st.none(), st.sampled_from(["C1", "C2", "  "])),
    st.sampled_from(["P1", "P2"]),
    st.sampled_from(["2024-01-15", "2024-02-30", "2024-03-01"]),
    st.sampled_from(["1", "2", "x"]),
    st.just("9.99"),
    st.sampled_from(["10.00", "-5.50", "0", None, "abc"]),
    st.sampled_from(["web", " app", None]),
    st.just("0")), min_size=1, max_size=25)


@settings(max_examples=10, deadline=None)
@given(order_rows)
def test_split_loses_nothing_and_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    lab = sv.labelled(ENT, df)
    good, bad = split(lab)
    assert good.count() + bad.count() == len(rows)
    once = dedup(good, ENT.keys, ENT.tie_break)
    twice = dedup(once, ENT.keys, ENT.tie_break)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == good.select("order_id").distinct().count()


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.sampled_from(["web", "app", "store"]),
                          st.integers(0, 400), st.integers(1, 5)), min_size=1, max_size=40))
def test_rollups_add_up_to_fact_totals(spark, rows):
    fact = spark.createDataFrame(
        [(i, o, ch, f"2024-0{1 + o % 3}-1{o % 9}", q, c / 100.0) for i, (o, ch, c, q) in enumerate(rows)],
        "line int, order_id int, channel string, order_date string, quantity int, amount double"
    ).withColumn("order_date", F.to_date("order_date"))
    total_cents = sum(c for _, _, c, _ in rows)
    by_channel = kp.kpi_channel(fact).collect()
    assert sum(round(r.revenue * 100) for r in by_channel) == total_cents
    assert sum(r.line_count for r in by_channel) == len(rows)
    t = {r.grouping_level: r for r in kp.kpi_time(fact).collect() if r.grouping_level == 7}
    assert round(t[7].revenue * 100) == total_cents
    assert t[7].revenue == total_cents / 100  # the double nearest the exact total
    assert t[7].order_count == len({o for o, *_ in rows})
    by_day = kp.kpi_daytype(fact).collect()
    assert sum(r.units_sold for r in by_day) == sum(q for *_, q in rows)
