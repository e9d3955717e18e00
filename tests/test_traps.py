"""One test per semantic trap of the reference."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.functions.rules import SALES_RULES, STRICT_AMOUNT_RULES
from tierwise.operators import checks as ck
from tierwise.operators import dims as dm
from tierwise.operators import silver as sv
from tierwise.operators.clean import dedup, label, split, standardise

COLS = "order_id string, customer_id string, product_id string, order_date string, " \
       "quantity string, unit_price string, amount string, channel string, discount_pct string"


def orders(spark, rows):
    return spark.createDataFrame(rows, COLS)


def row(oid="O1", cust="C1", amount="10.00", date="2024-01-15", qty="1", channel="web"):
    return (oid, cust, "P1", date, qty, "10.00", amount, channel, "0")


def labelled(spark, rows, extra_rules=()):
    ent = sv.sample_sales_entity()
    std = standardise(orders(spark, rows), ent.spec, flag_invalid=True)
    return label(std, list(ent.rules) + list(extra_rules))


def test_blank_customer_is_missing(spark):  # trap 3
    lab = labelled(spark, [row(cust="  ")])
    assert lab.first()["data_issue"] == "missing customer_id"


def test_trailing_space_key_is_one_key(spark):  # trap 3
    good, _ = split(labelled(spark, [row(oid="A1"), row(oid="A1 ")]))
    assert dedup(good, ["order_id"], ["amount"]).count() == 1


def test_null_and_zero_amounts_are_ok_by_default_and_nan_is_not(spark):  # trap 4
    rows = [row(oid="a", amount=None), row(oid="b", amount="NaN"), row(oid="c", amount="0")]
    default = {r.order_id: r.data_issue for r in labelled(spark, rows).collect()}
    assert default == {"a": "ok", "b": "amount out of range", "c": "ok"}
    strict = {r.order_id: r.data_issue for r in labelled(spark, rows, STRICT_AMOUNT_RULES).collect()}
    assert strict == {"a": "missing amount", "b": "amount out of range", "c": "ok"}


def test_values_beyond_cents_are_quarantined_and_end_no_job(spark):
    from tierwise.functions.money import cents
    rows = [row(oid="a", amount="1e17"), row(oid="b", amount="-1e17"), row(oid="c", qty="2000000000"), row(oid="d", amount="12.34")]
    lab = labelled(spark, rows)
    assert {r.order_id: r.data_issue for r in lab.collect()} == {
        "a": "amount out of range", "b": "negative amount", "c": "quantity out of range", "d": "ok"}
    assert lab.agg(F.sum(cents("amount"))).first()[0] == 1234 + 1000  # what cents can hold
    assert sv.label_counts(lab).count() == 4
    cost = standardise(spark.createDataFrame([("p", "n", "c", "b", "1e30"), ("q", "n", "c", "b", "3")],
                                             "product_id string, name string, category string, brand string, unit_cost string"),
                       sv.product_entity("string").spec, flag_invalid=True)
    assert {r.product_id: r.data_issue for r in label(cost, sv.product_entity("string").rules).collect()} == {
        "p": "unit_cost out of range", "q": "ok"}


def test_unparsable_values_are_quarantined_not_fatal(spark):  # trap 5
    lab = labelled(spark, [row(oid="x", amount="12,5"), row(oid="y", date="2024-13-45")])
    got = {r.order_id: r.data_issue for r in lab.collect()}
    assert got == {"x": "invalid amount", "y": "invalid order_date"}


def test_duplicate_survivor_is_deterministic(spark):  # trap 1
    rows = [row(oid="D", amount="30.00"), row(oid="D", amount="10.00"), row(oid="D", amount="20.00")]
    for _ in range(3):
        good, _ = split(labelled(spark, rows))
        out = dedup(good.repartition(3), ["order_id"], ["amount"]).collect()
        assert [r.amount for r in out] == [10.0]


def test_dedup_keeps_null_key_as_its_own_group(spark):  # trap 10
    df = spark.createDataFrame([(None, 1), (None, 2), ("k", 3)], "k string, v int")
    assert sorted(((r.k or ""), r.v) for r in dedup(df, ["k"], ["v"]).collect()) == [("", 1), ("k", 3)]
    assert ck.duplicate_keys(df, ["k"]).count() == 1


def test_latest_customer_record_wins(spark):  # trap 6
    ent = sv.customer_entity("string")
    df = spark.createDataFrame([
        ("C1", "Old Name", None, "West", "Premium", "de", "2024-01-01", "src"),
        ("C1", "New Name", None, "West", "Premium", "de", "2024-02-01", "src"),
        ("C1", "No Date", None, "West", "Premium", "de", None, "src")],
        "customer_id string, name string, email string, region string, segment string, "
        "country_code string, updated_at string, _source string")
    out = sv.silver(ent, df).collect()
    assert [(r.name, r.country_code) for r in out] == [("New Name", "DE")]


def test_orphan_with_null_name_is_not_an_orphan(spark):  # trap 9
    facts = spark.createDataFrame([("O1", "C1"), ("O2", "C9"), ("O3", None)], "o string, customer_id string")
    dim = spark.createDataFrame([("C1", None)], "customer_id string, name string")
    assert sorted(r.o for r in ck.orphans(facts, dim, "customer_id").collect()) == ["O2", "O3"]


def test_iso_week_vs_calendar_year(spark):  # trap 14
    d = dm.dim_date(dm.date_spine_between(spark, "2023-01-01", "2023-01-01")) \
        .unionByName(dm.dim_date(dm.date_spine_between(spark, "2024-12-30", "2024-12-30")))
    got = {r.full_date: (r.year, r.week_of_year, r.day_type, r.day_name) for r in d.collect()}
    assert got[dt.date(2023, 1, 1)] == (2023, 52, "Weekend", "Sunday")
    assert got[dt.date(2024, 12, 30)] == (2024, 1, "Weekday", "Monday")


def test_dim_date_reference_calendar(spark):  # D1, D2
    d = dm.dim_date(dm.date_spine_between(spark, *dm.REFERENCE_CALENDAR))
    assert d.count() == 1096
    r = d.where(F.col("full_date") == "2024-01-15").first()
    assert (r.date_sk, r.quarter, r.month_name, r.day) == (20240115, 1, "January", 15)


def test_null_channel_becomes_member_but_never_matches(spark):  # D5
    df = spark.createDataFrame([("web",), (None,), ("app",)], "channel string")
    dim = dm.dim_from_values(df, "channel", "channel_sk")
    assert sorted((r.channel_sk, r.channel) for r in dim.collect()) == [(1, None), (2, "app"), (3, "web")]



def test_rule_order_combined_first(spark):
    lab = labelled(spark, [row(cust=None, amount="-5")])
    assert lab.first()["data_issue"] == SALES_RULES[0].label


def test_date_outside_dim_date_is_reported_as_dropped(spark):  # trap 18, trap 8
    from tierwise.operators import kpis as kp
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, 20240115, 10.0), (2, 1, 1, 1, 20270101, 5.5), (3, None, 1, 1, 20240115, 2.25)],
        "order_id int, customer_sk bigint, product_sk bigint, channel_sk bigint, date_sk int, "
        "amount double")
    dim_date = dm.dim_date(dm.date_spine_between(spark, "2023-01-01", "2025-12-31"))
    r = kp.kpi_dropped(fact, dim_date).first()
    assert (r.dropped_rows, r.dropped_revenue, r.missing_date, r.missing_customer) == (2, 7.75, 1, 1)


def test_scd2_and_as_of_lookup(spark):  # E3
    from tierwise.operators import history as hs
    d = dt.date
    rows = [("c", "new", d(2024, 2, 1), 1), ("c", "old", d(2024, 1, 1), 1), ("c", "newer", d(2024, 3, 1), 2),
            ("x", "only", None, 1), ("c", "z came first", d(2024, 3, 1), 1)]
    history = spark.createDataFrame(rows, "k string, seg string, day date, seq int")
    dim = hs.scd2(history, "k", "day", ["seq"])
    with pytest.raises(ValueError, match="order"):
        hs.scd2(history, "k", "day", [])
    got = sorted((r.k, r.version_no, r.seg, r.valid_from, r.valid_to, r.is_current) for r in dim.collect())
    assert got == [("c", 1, "old", d(2024, 1, 1), d(2024, 2, 1), False),
                   ("c", 2, "new", d(2024, 2, 1), d(2024, 3, 1), False),
                   ("c", 3, "newer", d(2024, 3, 1), None, True), ("x", 1, "only", None, None, True)]
    facts = spark.createDataFrame([(1, "c", d(2023, 12, 31)), (2, "c", d(2024, 2, 1)), (3, "c", d(2024, 1, 31)),
                                   (4, "x", d(2000, 1, 1)), (5, "none", d(2024, 1, 1)), (6, None, d(2024, 1, 1))],
                                  "id int, k string, at date")
    assert {r.id: r.seg for r in hs.as_of(facts, dim, "k", "at").collect()} == {
        1: None, 2: "new", 3: "old", 4: "only", 5: None, 6: None}


def test_upsert_keeps_the_latest_row_of_a_key(spark):  # E2
    from tierwise.operators import history as hs
    d = dt.date
    ddl = "k string, v string, day date"
    now = spark.createDataFrame([("a", "1", d(2024, 1, 1)), ("b", "1", d(2024, 5, 1)), ("c", "1", None)], ddl)
    new = spark.createDataFrame([("a", "2", d(2024, 2, 1)), ("b", "late", d(2024, 4, 1)), ("n", "new", None)], ddl)
    got = {r.k: r.v for r in hs.upsert(now, new, ["k"], "day").collect()}
    assert got == {"a": "2", "b": "1", "c": "1", "n": "new"}
    again = hs.upsert(hs.upsert(now, new, ["k"], "day"), new, ["k"], "day")
    assert {r.k: r.v for r in again.collect()} == got
