"""Reload of single days, KPI sums per folder, customer versions in the fact."""

import json
import os
import uuid

import pytest
from conftest import CUSTOMERS, ORDERS_CSV, PRODUCTS_CSV

from tierwise.plans import pipeline as pl

HEADER, *LINES = ORDERS_CSV.strip().splitlines()
CALENDAR = ("2024-01-01", "2024-01-31")


class Landing:
    def __init__(self, folder):
        self.folder = folder
        self.put(LINES, CUSTOMERS, PRODUCTS_CSV)

    def put(self, lines=None, customers=None, products=None):
        if lines is not None:
            (self.folder / "orders.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        if customers is not None:
            (self.folder / "customers.json").write_text(json.dumps(customers))
        if products is not None:
            (self.folder / "products.csv").write_text(products)

    def pipeline(self, spark, db=None, **how):
        src = pl.landing_sources(spark, *[str(self.folder / f) for f in ("orders.csv", "customers.json", "products.csv")])
        return pl.Pipeline(spark, src, database=db or f"reload_{uuid.uuid4().hex[:8]}", calendar=CALENDAR, **how)


def build(p):
    p.bronze()
    p.silver()
    p.gold()
    return p


def folders(p):
    """Per folder of the fact its files, with size, time of change and content."""
    root = pl.sinks.location(p.spark, p.t("fact_orders")).removeprefix("file:")
    return {d: sorted((f, os.stat(f"{root}/{d}/{f}").st_mtime_ns, open(f"{root}/{d}/{f}", "rb").read())
                      for f in os.listdir(f"{root}/{d}")) for d in os.listdir(root) if "=" in d}


def same_as_full(spark, landing, p):
    full = build(landing.pipeline(spark, fact_grain=p.fact_grain))
    # Keys of members that came later differ from those of a fresh load; what they stand for does not.
    by = ["order_id", "customer_id", "product_id", "channel", "order_date", "quantity", "amount", "gross_profit"]
    key = lambda r: repr(r)
    for name, cols in (("fact_orders", by), ("vw_sales_kpis", full.table("vw_sales_kpis").columns)):
        got, want = (sorted(map(tuple, x.table(name).select(*cols).collect()), key=key) for x in (p, full))
        assert got == want, name
    return full


@pytest.mark.parametrize("grain", ["day", "month"])
def test_only_the_folders_that_differ_are_written(spark, tmp_path, grain):
    """One day changes, one vanishes, one is new; all others stay byte for byte."""
    landing = Landing(tmp_path)
    p = build(landing.pipeline(spark, reload="days", fact_grain=grain))
    assert p.reloaded is None
    same_as_full(spark, landing, p)
    build(p)
    assert p.reloaded == []  # nothing changed, nothing written
    before = folders(p)
    lines = [x for x in LINES if "2024-01-16" not in x] + ["ORD020,CUST03,PROD02,2024-01-15,1,9.99,9.99,app,0",
                                                           "ORD021,CUST01,PROD05,2024-02-01,1,19.99,19.99,web,0"]
    landing.put(lines=lines)
    build(p)
    after = folders(p)
    if grain == "day":
        assert {str(d) for d in p.reloaded} == {"2024-01-15", "2024-01-16", "2024-02-01"}
        assert set(before) - set(after) == {"order_date=2024-01-16"} and set(after) - set(before) == {"order_date=2024-02-01"}
        assert all(after[d] == before[d] for d in ("order_date=2024-01-17", "order_date=2024-01-18"))
        assert after["order_date=2024-01-15"] != before["order_date=2024-01-15"]
    else:
        assert {str(d) for d in p.reloaded} == {"2024-01-01", "2024-02-01"}
    full = same_as_full(spark, landing, p)
    assert "kpi_partials" in spark.sql(f"SHOW CREATE TABLE {p.t('vw_sales_kpis')}").first()[0]
    assert p.health().where("table_name = 'ALL'").first()["status"] == "PASS"
    assert full.reloaded is None


def test_changed_dimension_rows_reload_their_days(spark, tmp_path):
    landing = Landing(tmp_path)
    p = build(landing.pipeline(spark, reload="days"))
    landing.put(products=PRODUCTS_CSV.replace("60.00", "61.00"),  # PROD03: sold on the 15th
                customers=[c | ({"region": "Moved"} if c["customer_id"] == "CUST05" else {}) for c in CUSTOMERS])
    build(p)
    assert {str(d) for d in p.reloaded} == {"2024-01-15", "2024-01-18"}
    same_as_full(spark, landing, p)
    landing.put(products=PRODUCTS_CSV + "PROD09,New,Footwear,Alder,1.00\n")  # nobody bought it; PROD03 costs 60 again
    build(p)
    assert {str(d) for d in p.reloaded} == {"2024-01-15"}
    same_as_full(spark, landing, p)


def test_orders_of_several_days_are_counted_once(spark, tmp_path, monkeypatch):
    """The sums per day would count such an order twice; the view then reads the fact."""
    landing = Landing(tmp_path)
    p = landing.pipeline(spark, reload="days")
    build(p)
    fact = p.table("fact_orders").where("order_id = 'ORD001'")
    twin = fact.selectExpr(*[("DATE '2024-01-17' AS order_date" if c == "order_date" else "20240117 AS date_sk" if c == "date_sk" else c)
                             for c in fact.columns])
    rows = p.table("fact_orders").unionByName(twin).checkpoint()
    pl.sinks.write_partitioned(rows, p.t("fact_orders"), "order_date")
    assert not p._one_day_orders()
    spark.sql(pl.kpi_view_sql(p.db))
    r = p.table("vw_sales_kpis").where("category = 'Footwear' AND region = 'West'").first()
    assert (r.order_count, r.units_sold, r.revenue, r.avg_order_value) == (1, 4, 119.96, 119.96)


def test_customer_versions_reach_the_fact(spark, tmp_path):
    landing = Landing(tmp_path)
    p = build(landing.pipeline(spark, reload="days", history=True))
    held = {r.order_id: r.customer_version for r in p.table("fact_orders").collect()}
    names = {r.version_key: (r.customer_id, str(r.valid_from)) for r in p.versions().read().collect()}
    assert names[held["ORD001"]] == ("CUST01", "2024-01-10")
    # CUST01 changes on the 16th: the order of the 15th keeps its version, that of the 16th gets the new one.
    landing.put(customers=CUSTOMERS + [CUSTOMERS[0] | {"segment": "Budget", "updated_at": "2024-01-16"}])
    build(p)
    rows = {r.order_id: r for r in p.table("fact_orders").collect()}
    names = {r.version_key: r for r in p.versions().read().collect()}
    assert rows["ORD001"].customer_version == held["ORD001"]
    new = names[rows["ORD003"].customer_version]
    assert (new.segment, new.version_no, new.is_current, str(new.valid_from)) == ("Budget", 2, True, "2024-01-16")
    assert {str(d) for d in p.reloaded} == {"2024-01-15", "2024-01-16"}
    # The change now comes late: one of the 12th splits the first interval.
    landing.put(customers=CUSTOMERS + [CUSTOMERS[0] | {"segment": "Budget", "updated_at": "2024-01-16"},
                                       CUSTOMERS[0] | {"segment": "Standard", "updated_at": "2024-01-12"}])
    build(p)
    names = {r.version_key: r.segment for r in p.versions().read().collect()}
    assert {r.order_id: names[r.customer_version] for r in p.table("fact_orders").collect() if r.customer_id == "CUST01"} == {
        "ORD001": "Standard", "ORD003": "Budget"}
    assert p.versions().numbers()[-1] >= 3
