"""Incremental bronze load: each run appends only new landing files."""

from conftest import ORDERS_CSV

from tierwise.sources.readers import ORDERS_COLUMNS, text_schema
from tierwise.streaming.bronze import ingest_files


def test_incremental_ingest_appends_only_new_files(spark, tmp_path):
    landing = tmp_path / "orders"
    landing.mkdir()
    (landing / "day1.csv").write_text(ORDERS_CSV)
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_run")
    table = "stream_run.bronze_orders_incr"
    schema = text_schema([*ORDERS_COLUMNS, "_corrupt_record"])

    ingest_files(spark, str(landing), schema, table, "orders_csv")
    assert spark.table(table).count() == 9

    ingest_files(spark, str(landing), schema, table, "orders_csv")  # nothing new
    assert spark.table(table).count() == 9

    header, *lines = ORDERS_CSV.strip().splitlines()
    (landing / "day2.csv").write_text("\n".join([header] + lines[:3]) + "\n")
    ingest_files(spark, str(landing), schema, table, "orders_csv")
    df = spark.table(table)
    assert df.count() == 12
    assert df.select("_file").distinct().count() == 2
    assert set(df.columns) >= {"_ingest_at", "_source", "_file", "order_id"}


def test_stream_bronze_events_reads_every_row(spark, tmp_path):
    """SURVEY E1 on the driver's events table: every row arrives once."""
    from conftest import SMOKE_DIR

    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet")
    landing = tmp_path / "events"
    events.write.parquet(str(landing))  # a landing folder the stream watches
    spark.sql("CREATE DATABASE IF NOT EXISTS stream_run")
    table = "stream_run.bronze_events"
    ingest_files(spark, str(landing), events.schema, table, "events", fmt="parquet",
                 max_files_per_trigger=1)
    ingest_files(spark, str(landing), events.schema, table, "events", fmt="parquet")
    got = spark.table(table)
    assert got.count() == events.count()
    assert got.select("event_id").distinct().count() == events.select("event_id").distinct().count()
    assert got.drop("_ingest_at", "_source", "_file").exceptAll(events).count() == 0


def test_incremental_pipeline_appends_bronze_and_keeps_later_repeats(spark, tmp_path):
    """Bronze grows by new landing files only; a rerun changes nothing; a bad
    row repeated in a later file is a new quarantine entry (distinct _file)."""
    import json
    import uuid

    from conftest import CUSTOMERS, PRODUCTS_CSV
    from tierwise.plans import pipeline as pl

    dirs = {k: tmp_path / k for k in ("orders", "customers", "products")}
    for d in dirs.values():
        d.mkdir()
    (dirs["orders"] / "day1.csv").write_text(ORDERS_CSV)
    (dirs["customers"] / "customers.json").write_text(json.dumps(CUSTOMERS, ensure_ascii=False))
    (dirs["products"] / "products.csv").write_text(PRODUCTS_CSV)
    src = pl.incremental_landing_sources(spark, str(dirs["orders"]), str(dirs["customers"]),
                                         str(dirs["products"]))
    db = f"incr_{uuid.uuid4().hex[:8]}"
    p = pl.Pipeline(spark, src, database=db, calendar=("2024-01-01", "2024-01-31"))

    def counts():
        return {t: spark.table(f"{db}.{t}").count()
                for t in ["bronze_orders", "quarantine_orders", "silver_orders", "fact_orders"]}

    p.run()
    assert counts() == {"bronze_orders": 9, "quarantine_orders": 2, "silver_orders": 6,
                        "fact_orders": 6}
    p.run()
    assert counts() == {"bronze_orders": 9, "quarantine_orders": 2, "silver_orders": 6,
                        "fact_orders": 6}
    header, *lines = ORDERS_CSV.strip().splitlines()
    repeat_bad = [ln for ln in lines if ln.startswith("ORD007")]
    (dirs["orders"] / "day2.csv").write_text(
        "\n".join([header, "ORD009,CUST03,PROD05,2024-01-19,1,19.99,19.99,web,0"] + repeat_bad)
        + "\n")
    results = p.run()
    assert counts() == {"bronze_orders": 11, "quarantine_orders": 3, "silver_orders": 7,
                        "fact_orders": 7}
    assert spark.table(f"{db}.bronze_orders").select("_file").distinct().count() == 2
    status = {r["check"]: r["status"] for r in results.collect()}
    assert status["silver_sales revenue agrees with bronze"] == "PASS"
    assert status["silver_sales is as recent as bronze"] == "PASS"


RUN = """
import sys
sys.path.insert(0, {repo!r})
from tierwise.session import get_session
from tierwise.plans import pipeline as pl
spark = get_session("local[2]", 2, extra_conf={{
    "spark.sql.warehouse.dir": {warehouse!r}, "spark.checkpoint.dir": {checkpoints!r}}})
src = pl.incremental_landing_sources(spark, *{landing!r})
p = pl.Pipeline(spark, src, database="retail", calendar=("2024-01-01", "2024-01-31"))
results = p.run()
print("ROWS", p.table("bronze_orders").count(), p.table("bronze_orders").select("_file").distinct().count(),
      sorted({{r["status"] for r in results.collect()}}),
      sorted({{r["status"] for r in p.health().collect()}}))
"""


def test_incremental_load_across_processes(tmp_path):
    """One warehouse, a process per run: a new file is loaded once, nothing is lost."""
    import json
    import os
    import subprocess
    import sys

    from conftest import CUSTOMERS, PRODUCTS_CSV

    dirs = [tmp_path / k for k in ("orders", "customers", "products")]
    for d in dirs:
        d.mkdir()
    (dirs[0] / "day1.csv").write_text(ORDERS_CSV)
    (dirs[1] / "customers.json").write_text(json.dumps(CUSTOMERS, ensure_ascii=False))
    (dirs[2] / "products.csv").write_text(PRODUCTS_CSV)
    code = RUN.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                      warehouse=str(tmp_path / "warehouse"), checkpoints=str(tmp_path / "ck"),
                      landing=[str(d) for d in dirs])

    def run():
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
        return next((x for x in out.stdout.splitlines() if x.startswith("ROWS")), out.stderr[-3000:])

    assert run() == "ROWS 9 1 ['PASS'] ['PASS']"
    header = ORDERS_CSV.splitlines()[0]
    (dirs[0] / "day2.csv").write_text(f"{header}\nORD009,CUST03,PROD05,2024-01-19,1,19.99,19.99,web,0\n")
    assert run() == "ROWS 10 2 ['PASS'] ['PASS']"
    assert run() == "ROWS 10 2 ['PASS'] ['PASS']"
