"""Golden tests: the reference's sample data through the written-table pipeline."""

import uuid
from decimal import Decimal

import pytest
from conftest import ORDERS_CSV
from pyspark.sql import functions as F

from tierwise.operators import dims as dm
from tierwise.operators import silver as sv
from tierwise.plans import pipeline as pl
from tierwise.plans import quality

DB = "sample_run"


@pytest.fixture(scope="module")
def run(spark, landing):
    src = pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"])
    p = pl.Pipeline(spark, src, database=DB, calendar=dm.REFERENCE_CALENDAR)
    results = p.run()
    return p, results


def count(spark, name):
    return spark.table(f"{DB}.{name}").count()


def test_layer_counts(spark, run):
    p, _ = run
    expected = {"bronze_orders": 9, "bronze_customers": 5, "bronze_products": 5,
                "silver_orders": 6, "silver_customers": 5, "silver_products": 5,
                "quarantine_orders": 2, "dim_date": 1096, "dim_customer": 5, "dim_product": 5,
                "dim_channel": 3, "fact_orders": 6}
    assert {k: count(spark, k) for k in expected} == expected
    assert p.metrics == {"bronze_rows": 9, "good_rows": 7, "quarantined_rows": 2,
                         "silver_rows": 6, "duplicates_removed": 1}


def test_fact_is_partitioned_by_order_date(spark, run):
    files = spark.table(f"{DB}.fact_orders").inputFiles()
    days = {f.split("order_date=")[1].split("/")[0] for f in files}
    assert days == {"2024-01-15", "2024-01-16", "2024-01-17", "2024-01-18"}
    pruned = spark.table(f"{DB}.fact_orders").where("order_date = '2024-01-15'")
    assert "PartitionFilters: [isnotnull(order_date" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 2
    view = spark.table(f"{DB}.vw_sales_kpis").where("day_type = 'Weekend'")
    view.collect()
    assert "dynamicpruning" in view._jdf.queryExecution().executedPlan().toString().lower()


def test_month_folders_on_request_replace_day_folders(spark, landing):
    src = pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"])
    day = pl.Pipeline(spark, src, database="sample_month", calendar=("2024-01-01", "2024-01-31"))
    day.bronze(); day.silver(); day.gold()
    p = pl.Pipeline(spark, src, database="sample_month", calendar=("2024-01-01", "2024-01-31"),
                    fact_grain="month")
    p.gold()
    with pytest.raises(ValueError):
        pl.Pipeline(spark, src, database="sample_month", fact_grain="auto")
    files = spark.table("sample_month.fact_orders").inputFiles()
    assert {f.split("order_month=")[1].split("/")[0] for f in files} == {"2024-01-01"}
    assert spark.table("sample_month.vw_sales_kpis").count() == 6
    view = spark.table("sample_month.vw_sales_kpis").where("month = 1")
    view.collect()
    assert "dynamicpruning" in view._jdf.queryExecution().executedPlan().toString().lower()


def test_quarantine_labels(spark, run):
    rows = spark.table(f"{DB}.quarantine_orders").select("order_id", "data_issue").collect()
    assert sorted(map(tuple, rows)) == [("ORD006", "missing customer_id"),
                                        ("ORD007", "negative amount")]


def test_silver_revenue_and_types(spark, run):
    silver = spark.table(f"{DB}.silver_orders")
    total = silver.agg(F.sum(F.col("amount").cast("decimal(18,2)"))).first()[0]
    assert total == Decimal("509.87")
    types = dict(silver.dtypes)
    assert types["order_date"] == "date" and types["quantity"] == "int"
    assert types["amount"] == "double" and types["discount_pct"] == "int"


def test_kpi_view_golden(spark, run):
    rows = spark.sql(f"SELECT category, brand, region, segment, country_code, channel, units_sold,"
                     f" revenue, avg_order_value, gross_profit, margin_pct, order_count, year,"
                     f" quarter, month, month_name, day_type FROM {DB}.vw_sales_kpis").collect()
    got = sorted((r.category, r.brand, r.region, r.segment, r.country_code, r.channel,
                  r.units_sold, str(r.revenue), str(r.avg_order_value), str(r.gross_profit),
                  str(r.margin_pct)) for r in rows)
    expected = sorted([
        ("Equipment", "Cedar", "East", "Standard", "KR", "web", 2, "159.98", "159.98", "109.98", "68.7"),
        ("Equipment", "Birch", "North", "Standard", "GB", "store", 1, "149.99", "149.99", "89.99", "60.0"),
        ("Apparel", "Dune", "North", "Budget", "SE", "app", 4, "79.96", "79.96", "47.96", "60.0"),
        ("Footwear", "Alder", "West", "Premium", "DE", "web", 2, "59.98", "59.98", "23.98", "40.0"),
        ("Footwear", "Alder", "South", "Premium", "IT", "app", 1, "29.99", "29.99", "11.99", "40.0"),
        ("Accessories", "Elm", "West", "Premium", "DE", "web", 3, "29.97", "29.97", "19.47", "65.0"),
    ])
    assert got == expected
    assert {(r.year, r.quarter, r.month, r.month_name, r.day_type, r.order_count)
            for r in rows} == {(2024, 1, 1, "January", "Weekday", 1)}


def test_checks_all_pass_on_sample(spark, run):
    _, results = run
    rows = {r["check"]: r for r in results.collect()}
    assert len(rows) == 15
    assert all(r["status"] == "PASS" for r in rows.values()), rows
    rec = rows["silver_sales revenue agrees with bronze"]
    assert rec["actual"] == "509.87" and "569.85" in rec["details"]
    assert rows["silver_sales is as recent as bronze"]["actual"] == "2024-01-18"


def test_rerun_is_idempotent(spark, run):
    p, _ = run
    before = {t: sorted(map(tuple, spark.table(f"{DB}.{t}").drop(
        *[c for c in spark.table(f"{DB}.{t}").columns if c.startswith("_")]).collect()))
        for t in ["silver_orders", "quarantine_orders", "dim_customer", "dim_product",
                  "dim_channel", "fact_orders"]}
    p.run()
    after = {t: sorted(map(tuple, spark.table(f"{DB}.{t}").drop(
        *[c for c in spark.table(f"{DB}.{t}").columns if c.startswith("_")]).collect()))
        for t in before}
    assert before == after


def test_health_reports_every_table(spark, run):
    p, _ = run
    expected = {"bronze_orders": 9, "bronze_customers": 5, "bronze_products": 5, "silver_orders": 6,
                "silver_customers": 5, "silver_products": 5, "quarantine_orders": 2, "dim_date": 1096,
                "dim_customer": 5, "dim_product": 5, "dim_channel": 3, "fact_orders": 6}
    assert p.expected == expected
    # Another process: the expectations are read back from the run's table.
    rows = {r.table_name: r for r in pl.Pipeline(spark, p.src, database=DB).health().collect()}
    assert {k: rows[k].expected_rows for k in expected} == expected
    assert all(r.status == "PASS" for r in rows.values())
    assert (rows["ALL"].actual_rows, rows["ALL"].expected_rows) == (13, 13)
    bad = {r.table_name: r.status for r in p.health({**expected, "dim_date": 7}).collect()}
    assert bad["dim_date"] == "FAIL" and bad["ALL"] == "FAIL"
    none = {r.table_name: r.status for r in p.health({}).collect()}
    assert none["fact_orders"] == "NO EXPECTATION" and none["ALL"] == "NO EXPECTATION"


def test_nothing_dropped_by_the_view_on_the_sample(spark, run):
    p, _ = run
    r = p.dropped().first()
    assert (r.dropped_rows, r.dropped_revenue) == (0, 0.0)


def test_reconcile_detail_on_tables(spark, run):
    p, _ = run
    rows = p.reconcile_detail().collect()
    assert [(r.order_id, r.bronze_rows, str(r.bronze_amount), str(r.silver_amount),
             str(r.difference)) for r in rows] == [("ORD001", 2, "119.96", "59.98", "59.98")]


def test_fail_on_error_raises_after_writing(spark, landing):
    src = pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"])
    p = pl.Pipeline(spark, src, database="sample_strict", calendar=("2024-01-01", "2024-01-31"))
    p.bronze(); p.silver(); p.gold()
    # Drop one product so that an order loses its product and the orphan check fails.
    spark.table("sample_strict.silver_products").where("product_id <> 'PROD05'") \
        .write.mode("overwrite").format("parquet").saveAsTable("sample_strict.silver_products_x")
    p.table = lambda n, _t=p.table: _t("silver_products_x" if n == "silver_products" else n)
    with pytest.raises(RuntimeError, match="product is known"):
        p.check(fail_on_error=True)
    assert spark.table("sample_strict.test_results").count() == 15


def test_rerun_with_a_fresh_catalog_keeps_keys_and_quarantine(spark, landing):
    """A later run in a new process (no metastore) finds the earlier tables
    by location: surrogate keys stay, quarantine does not grow."""
    src = pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"])
    db = "sample_fresh"
    p = pl.Pipeline(spark, src, database=db, calendar=("2024-01-01", "2024-01-31"))
    p.run()
    keys = sorted(map(tuple, spark.table(f"{db}.dim_customer").select("customer_id", "customer_sk")
                      .collect()))
    for t in spark.catalog.listTables(db):  # forget every table; the files stay
        spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} {db}.{t.name}")
    p2 = pl.Pipeline(spark, src, database=db, calendar=("2024-01-01", "2024-01-31"))
    results = p2.run()
    assert spark.table(f"{db}.quarantine_orders").count() == 2
    assert sorted(map(tuple, spark.table(f"{db}.dim_customer")
                      .select("customer_id", "customer_sk").collect())) == keys
    assert spark.table(f"{db}.keymap_customer_sk").count() == 5
    assert {r["status"] for r in results.collect()} == {"PASS"}


def write_orders(folder, name, lines, header=None):
    head = header or ORDERS_CSV.splitlines()[0]
    (folder / name).write_text("\n".join([head, *lines]) + "\n")


def own_sources(spark, landing, folder):
    return pl.landing_sources(spark, str(folder), landing["customers"], landing["products"])


def fresh(spark, src, **kw):
    return pl.Pipeline(spark, src, database=f"db_{uuid.uuid4().hex[:8]}",
                       calendar=("2024-01-01", "2024-01-31"), **kw)


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_a_day_that_leaves_the_source_leaves_the_fact(spark, landing, tmp_path, mode):
    folder = tmp_path / "orders"
    folder.mkdir()
    lines = ORDERS_CSV.strip().splitlines()[1:]
    write_orders(folder, "o.csv", lines)
    p = fresh(spark, own_sources(spark, landing, folder))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        p.run()
        write_orders(folder, "o.csv", [x for x in lines if "2024-01-17" not in x])
        results = {r["check"]: r["status"] for r in p.run().collect()}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert p.table("fact_orders").count() == p.table("silver_orders").count() == 5
    assert results["fact has silver's lines"] == results["fact has silver's revenue"] == "PASS"
    # A stale fact fails.
    p.table("silver_orders").where("order_id <> 'ORD008'").write.saveAsTable(p.t("short"))
    p.table = lambda n, _t=p.table: _t("short" if n == "silver_orders" else n)
    bad = {r["check"]: r["status"] for r in p.check().collect()}
    assert bad["fact has silver's lines"] == bad["fact has silver's revenue"] == "FAIL"


def test_csv_columns_are_taken_by_name(spark, landing, tmp_path):
    folder = tmp_path / "orders"
    folder.mkdir()
    write_orders(folder, "o.csv", ["CUST01,web,O1,PROD01,2024-01-15,2.0,5.00,10.00,0,extra"],
                 "customer_id,channel,order_id,product_id,order_date,quantity,unit_price,amount,discount_pct,note")
    p = fresh(spark, own_sources(spark, landing, folder))
    p.bronze(); p.silver()
    r = p.table("silver_orders").first()
    assert (r.order_id, r.customer_id, r.channel, r.quantity) == ("O1", "CUST01", "web", 2)
    write_orders(folder, "p.csv", ["O2,CUST01,PROD01,2024-01-15,2,5.00,10.00,web,0"])
    # A second file of another order, and a third that lacks columns: its lines go to quarantine whole.
    write_orders(folder, "q.csv", ["O3,web", "O4,app"], "order_id,channel")
    (folder / "empty.csv").write_text("")
    p = fresh(spark, own_sources(spark, landing, folder))
    p.bronze(); p.silver()
    assert sorted((r.order_id, r.channel, r.quantity) for r in p.table("silver_orders").collect()) == [("O1", "web", 2), ("O2", "web", 2)]
    held = p.table("quarantine_orders").collect()
    assert {r.data_issue for r in held} == {"malformed record"} and all(r["_file"].endswith("q.csv") for r in held)
    assert sorted(r["_corrupt_record"] for r in held) == ["O3,web", "O4,app", "order_id,channel"]
    for f in ("p.csv", "q.csv"):
        (folder / f).unlink()
    write_orders(folder, "o.csv", ["x"], "order_id")
    with pytest.raises(ValueError, match="customer_id"):
        fresh(spark, own_sources(spark, landing, folder)).bronze()


def test_bronze_is_labelled_once(spark, landing, tmp_path, monkeypatch):
    """What silver and quarantine read are the written labelled rows, not bronze."""
    folder = tmp_path / "orders"
    folder.mkdir()
    write_orders(folder, "o.csv", ORDERS_CSV.strip().splitlines()[1:])
    p = fresh(spark, own_sources(spark, landing, folder))
    p.bronze()
    read = []
    for module, name in ((pl, "dedup"), (pl.sinks, "append_new")):
        own = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a, _own=own, **k: (read.extend(df.inputFiles()), _own(df, *a, **k))[1])
    p.silver()
    assert read and all("/_labelled/" in f for f in read)
    assert p.table("silver_orders").count() == 6 and p.table("quarantine_orders").count() == 2


def test_quarantine_keeps_what_arrived(spark, landing, tmp_path):
    folder = tmp_path / "orders"
    folder.mkdir()
    good = "O1,CUST01,PROD01,2024-01-15,2,5.00,10.00,web,0"
    bad = ["O2,CUST01,PROD01,2024-01-15,2,5.00,x12.5,web,0", "O3,CUST01,PROD01,2024-01-15,2.5,5.00,10.00,web,0",
           "O4,CUST01,PROD01,2024-01-15,2,5.00,10.00,web,0,surplus", "O5,CUST01,PROD01"]
    write_orders(folder, "o.csv", [good, *bad])
    p = fresh(spark, own_sources(spark, landing, folder))
    p.bronze(); p.silver()
    got = {r.order_id: r for r in p.table("quarantine_orders").collect()}
    assert {k: r.data_issue for k, r in got.items()} == {
        "O2": "invalid amount", "O3": "invalid quantity", "O4": "malformed record", "O5": "malformed record"}
    assert got["O2"]["_raw_amount"] == "x12.5" and got["O3"]["_raw_quantity"] == "2.5"
    assert got["O4"]["_corrupt_record"] == bad[2] and got["O5"]["_corrupt_record"] == bad[3]
    assert p.table("silver_orders").columns.count("_corrupt_record") == 0
    p.silver()  # the same files: nothing new
    assert p.table("quarantine_orders").count() == 4
    write_orders(folder, "o.csv", [good, bad[0].replace("x12.5", "x99.9")])
    p.bronze(); p.silver()  # another bad value for the same order is another row
    assert p.table("quarantine_orders").count() == 5 == p.expected["quarantine_orders"]
    assert not spark.catalog.tableExists(p.t("quarantine_customers"))


def test_every_check_can_fail(spark, landing):
    p = fresh(spark, pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"]))
    p.bronze(); p.silver(); p.gold()
    silver, fact = p.table("silver_orders"), p.table("fact_orders")
    broken = (silver.where("order_id <> 'ORD008'")
              .unionByName(silver.where("order_id = 'ORD001'").withColumn("amount", F.lit(-3.0)))
              .unionByName(silver.where("order_id = 'ORD002'").withColumn("order_id", F.lit(None).cast("string"))
                           .withColumn("product_id", F.lit(None).cast("string"))
                           .withColumn("order_date", F.lit(None).cast("date")).withColumn("amount", F.lit(None).cast("double"))))
    frames = quality.Frames(
        labelled_sales=lambda: sv.labelled(p.src.sales_entity, p.table("bronze_orders")),
        silver_sales=lambda: broken.drop("channel").where("order_date < '2024-01-18' OR order_date IS NULL"),
        customers_ref=lambda: p.table("silver_customers").where("customer_id <> 'CUST01'"),
        products_ref=lambda: p.table("silver_products").where("product_id <> 'PROD01'"),
        fact=lambda: fact.withColumn("gross_profit", F.lit(-1.0)),
        keys=["order_id"], tie_break=p.src.sales_entity.tie_break)
    rows = {r["check"]: r for r in quality.run_suite(frames, [*quality.CHECKS, *quality.TABLE_CHECKS]).collect()}
    assert {r["status"] for r in rows.values()} == {"FAIL"} and len(rows) == 15
    assert rows["silver_sales has every expected column"]["details"] == "absent: channel"
    frames.silver_sales = lambda: silver.drop("amount")  # reported, not raised
    got = {r["check"]: r["status"] for r in quality.run_suite(frames, ["check_schema", "check_nulls", "check_negative"]).collect()}
    assert got["silver_sales.amount is filled"] == "FAIL" and got["silver_sales.order_id is filled"] == "PASS"


def test_freshness_by_day_and_by_age(spark, run):
    p, _ = run
    def status(**kw):
        return {r["check"]: r["status"] for r in p.check(**kw).collect()}
    assert status(fresh_since="2024-01-18")["silver_sales reaches the wanted day"] == "PASS"
    assert status(fresh_since="2024-01-19")["silver_sales reaches the wanted day"] == "FAIL"
    got = status(max_age_days=30)
    assert got["silver_sales is young enough"] == "FAIL" and "silver_sales is as recent as bronze" not in got
    assert status(max_age_days=100_000)["silver_sales is young enough"] == "PASS"
    p.check()


def test_a_lost_row_fails_the_health_check(spark, landing):
    p = fresh(spark, pl.landing_sources(spark, landing["orders"], landing["customers"], landing["products"]))
    p.run()
    kept = p.table("fact_orders").where("order_id <> 'ORD001'").collect()
    schema = p.table("fact_orders").schema
    from tierwise.sources import sinks
    sinks.write_partitioned(spark.createDataFrame(kept, schema), p.t("fact_orders"), "order_date")
    rows = {r.table_name: r.status for r in p.health().collect()}
    assert rows["fact_orders"] == "FAIL" and rows["ALL"] == "FAIL"
