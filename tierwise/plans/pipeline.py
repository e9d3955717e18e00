"""The layered pipeline as written tables: bronze -> silver -> gold -> checks.

Each step reads the previous layer's *tables* and writes its own, as the
reference pipeline does; no plan spans two layers, so lineage is cut at
every layer boundary and a lost executor only re-runs the current step.

Fixes over the reference (SURVEY §1.5): standardise before labelling;
deterministic dedup; idempotent quarantine; stable, dense surrogate keys
kept in key-map tables; a date dimension that covers the data; a
range-partitioned fact write; checks compiled to one aggregate per table.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.keys import dense_key_map
from tierwise.functions.rules import OK
from tierwise.operators import checks as ck
from tierwise.operators import dims as dm
from tierwise.operators import facts as fc
from tierwise.operators import history as hs
from tierwise.operators import kpis as kp
from tierwise.operators import silver as sv
from tierwise.operators.clean import CORRUPT, ISSUE, dedup, split, stamp
from tierwise.plans import quality
from tierwise.session import checkpoint_dir
from tierwise.sources import readers, sinks
from tierwise.sources import testdata as td
from tierwise.sources.snapshots import Snapshots


@dataclass
class Sources:
    """Raw inputs (callables, so nothing is read before the bronze step)."""

    sales: Callable[[], DataFrame]
    customers: Callable[[], DataFrame]
    products: Callable[[], DataFrame]
    sales_entity: sv.Entity
    customer_entity: sv.Entity
    product_entity: sv.Entity
    labels: tuple[str, str, str] = ("orders", "customers", "products")
    # Incremental landing folders: (path, columns, format, options) per
    # source. When set, the bronze step appends only files not seen before.
    streams: tuple | None = None


def testdata_sources(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Sources:
    return Sources(
        sales=lambda: td.bronze_sales(spark, sf_dir).drop("_source"),
        customers=lambda: td.bronze_customers(
            spark, sf_dir, td.NULL_CUSTOMER_NAME_EVERY if dirty else None).drop("_source"),
        products=lambda: td.bronze_products(
            spark, sf_dir, td.NULL_UNIT_COST_EVERY if dirty else None).drop("_source"),
        sales_entity=sv.sales_entity(), customer_entity=sv.customer_entity(),
        product_entity=sv.product_entity(),
        labels=(td.SALES_SOURCE, td.CUSTOMER_SOURCE, td.PRODUCT_SOURCE))


def landing_sources(spark: SparkSession, orders_csv: str, customers_json: str,
                    products_csv: str) -> Sources:
    """The reference's landing files: orders and products CSV, customers JSON array."""
    return Sources(
        sales=lambda: readers.scan_csv(spark, orders_csv, readers.ORDERS_COLUMNS),
        customers=lambda: readers.scan_json(spark, customers_json, readers.CUSTOMERS_COLUMNS),
        products=lambda: readers.scan_csv(spark, products_csv, readers.PRODUCTS_COLUMNS),
        sales_entity=sv.sample_sales_entity(), customer_entity=sv.customer_entity("string"),
        product_entity=sv.product_entity("string"),
        labels=("orders_csv", "customers_json", "products_csv"))


def incremental_landing_sources(spark: SparkSession, orders_dir: str, customers_dir: str,
                                products_dir: str) -> Sources:
    """Landing *folders* that receive new files over time.

    Bronze becomes append-only: every run ingests the files that arrived
    since the last run (Structured Streaming, ``availableNow``); silver and
    gold are rebuilt from all of bronze, as in the full-refresh pipeline.
    """
    src = landing_sources(spark, orders_dir, customers_dir, products_dir)
    src.streams = (
        (orders_dir, readers.ORDERS_COLUMNS, "csv", {}),
        (customers_dir, readers.CUSTOMERS_COLUMNS, "json", {"multiLine": "true"}),
        (products_dir, readers.PRODUCTS_COLUMNS, "csv", {}),
    )
    return src


def _concurrently(*steps: Callable[[], None]) -> None:
    """Run independent steps (each one or more Spark jobs) from driver threads,
    so their jobs are scheduled side by side; the first error is raised."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for f in [pool.submit(step) for step in steps]:
            f.result()


class Pipeline:
    def __init__(self, spark: SparkSession, sources: Sources, database: str = "tierwise",
                 calendar: tuple[str, str] | None = None, fact_grain: str = "day",
                 reload: str = "full", history: bool = False, heavy_keys: bool = False):
        """``fact_grain``: folders of ``fact_orders`` -- ``day`` (``order_date``, as the
        reference) or, on request, ``month`` (``order_month``). It never depends on the
        data. ``reload``: ``full`` writes the whole fact, ``days`` only the folders whose
        lines, or the dimension rows these use, differ from the last run; the KPI view then
        reads sums per folder that are renewed with them. ``history``: keep every version of a
        customer, and the one that held on the order's day in the fact. ``heavy_keys``: deal the
        lines of heavy customers and products over tasks by a sketch of them, where the session's
        adaptive skew join is not to be relied on."""
        if fact_grain not in ("day", "month"):
            raise ValueError(f"fact_grain must be day or month: {fact_grain}")
        if reload not in ("full", "days"):
            raise ValueError(f"reload must be full or days: {reload}")
        self.fact_grain = fact_grain
        self.reload = reload
        self.history = history
        self.heavy_keys = heavy_keys
        self.reloaded: list | None = None  # folders that the last gold step wrote; None: all
        self.spark = spark
        self.src = sources
        self.db = database
        self.calendar = calendar
        self.metrics: dict[str, int] = {}
        self.expected: dict[str, int] = {}  # rows that each written table must have
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def t(self, name: str) -> str:
        return f"{self.db}.{name}"

    def table(self, name: str) -> DataFrame:
        sinks.attach(self.spark, self.t(name))
        return self.spark.table(self.t(name))

    # ------------------------------------------------------------------ bronze
    def bronze(self) -> None:
        s = self.src
        names = ["bronze_orders", "bronze_customers", "bronze_products"]
        if s.streams:
            from tierwise.streaming.bronze import ingest_files
            for (path, columns, fmt, opts), name, label in zip(s.streams, names, s.labels):
                schema = (readers.csv_schema(self.spark, path, columns) if fmt == "csv"
                          else readers.text_schema([*columns, CORRUPT]))
                before = self.table(name).count() if sinks.table_exists(self.spark, self.t(name)) else 0
                query = ingest_files(self.spark, path, schema, self.t(name), label, fmt=fmt,
                                     options=opts, columns=[*columns, CORRUPT])
                self.expected[name] = before + sum(p["numInputRows"] for p in query.recentProgress)
            return

        def load(reader, name: str, label: str) -> None:
            obs = Observation(f"{name}_rows")
            rows = readers.stamp_ingest(reader(), label).observe(obs, F.count(F.lit(1)).alias("n"))
            sinks.overwrite(rows, self.t(name))
            self.expected[name] = int(obs.get["n"])

        _concurrently(*[(lambda a=args: load(*a))
                        for args in zip([s.sales, s.customers, s.products], names, s.labels)])

    # ------------------------------------------------------------------ silver
    def _silver_one(self, entity: sv.Entity, bronze: str, silver: str, quarantine: str,
                    observe: bool = False) -> None:
        """Bronze is read and labelled once, into an ``ok`` and a ``rejected`` folder; what follows
        reads these."""
        lab = sv.labelled(entity, self.table(bronze), drop=[], keep_raw=True)
        obs = Observation(f"{silver}_counts")
        ok = F.col(ISSUE) == OK
        folder = sinks.location(self.spark, self.t(f"_labelled/{silver}"))
        (lab.observe(obs, F.count(F.lit(1)).alias("bronze_rows"), F.count_if(ok).alias("good_rows"))
         .withColumn("_split", F.when(ok, "ok").otherwise("rejected"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_split").parquet(folder))
        written = self.spark.read.schema(lab.schema).option("basePath", folder).parquet(folder)
        good, _ = split(written.where("_split = 'ok'").drop("_split"))
        _, bad = split(written.where("_split = 'rejected'").drop("_split"))
        self.expected[silver] = good.agg(F.count_distinct(F.struct(*entity.keys))).first()[0]
        # The raw values and the file are part of a rejected row's identity.
        hash_cols = [c for c in bad.columns if c != "_ingest_at"]
        orders = quarantine == "quarantine_orders"
        had = self.table(quarantine).count() if orders and sinks.table_exists(
            self.spark, self.t(quarantine)) else 0
        added = Observation(f"{quarantine}_rows") if orders else None
        # The orders' quarantine always exists; the others only once they hold a row.
        sinks.append_new(stamp(bad, "_quarantine_at"), self.t(quarantine), hash_cols,
                         only_if_rows=not orders, added=added)
        if orders:
            self.expected[quarantine] = had + int(added.get["n"])
        rows = dedup(good, entity.keys, entity.tie_break, entity.desc)
        cols = [c for c in entity.columns if c in rows.columns]
        rows = rows.select(*cols, *[c for c in rows.columns if c not in cols])
        sinks.overwrite(stamp(rows, "_silver_at"), self.t(silver))
        if observe:
            m = {k: int(v) for k, v in obs.get.items()}
            m["quarantined_rows"] = m["bronze_rows"] - m["good_rows"]
            m["silver_rows"] = self.table(silver).count()  # parquet footers, no data scan
            m["duplicates_removed"] = m["good_rows"] - m["silver_rows"]
            self.metrics.update(m)

    def silver(self) -> None:
        s = self.src
        _concurrently(
            lambda: self._silver_one(s.sales_entity, "bronze_orders", "silver_orders",
                                     "quarantine_orders", observe=True),
            lambda: self._silver_one(s.customer_entity, "bronze_customers", "silver_customers",
                                     "quarantine_customers"),
            lambda: self._silver_one(s.product_entity, "bronze_products", "silver_products",
                                     "quarantine_products"))

    # ------------------------------------------------------------------ gold
    def _extend_keymap(self, values: DataFrame, key: str, sk: str) -> DataFrame:
        """Stable keys: existing keys keep their number, new keys get
        max + 1, max + 2, ... in key order. The map only grows."""
        name = self.t(f"keymap_{sk}")
        keys = values.select(key).distinct()
        if sinks.table_exists(self.spark, name):
            known = self.table(f"keymap_{sk}")
            new = keys.join(known, keys[key].eqNullSafe(known[key]), "left_anti")
            top = known.agg(F.max(sk)).first()[0] or 0  # one scalar
            new_map = dense_key_map(new, [key], sk, offset=int(top))
            new_map = new_map.checkpoint(eager=True)  # fixed before it is appended
            sinks.append(new_map, name)
        else:
            sinks.overwrite(dense_key_map(keys, [key], sk).checkpoint(eager=True), name)
        return self.table(f"keymap_{sk}")

    def _keyed(self, silver: DataFrame, key: str, sk: str, cols: list[str]) -> DataFrame:
        keymap = self._extend_keymap(silver, key, sk).withColumnRenamed(key, "_k")
        joined = silver.join(keymap, silver[key].eqNullSafe(keymap["_k"]), "inner")
        return joined.select(sk, *cols)

    @property
    def folder(self) -> str:
        """Partition column of the fact."""
        return "order_month" if self.fact_grain == "month" else "order_date"

    def _with_folder(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("order_month", F.trunc("order_date", "MM")) if self.fact_grain == "month" else rows

    def versions(self) -> Snapshots:
        """The customers' version table."""
        return Snapshots(self.spark, sinks.location(self.spark, self.t("dim_customer_history")), ["customer_id"])

    def _merge_history(self) -> DataFrame:
        """Merges the valid customer rows that came since the last merge; gives the customers whose
        versions changed."""
        entity, table = self.src.customer_entity, self.versions()
        good, _ = split(sv.labelled(entity, self.table("bronze_customers"), drop=[]))
        order = [c for c in ("_ingest_at", "_file") if c in good.columns]
        rows = good.select(*entity.columns, *order)
        before = table.manifest()
        if before:
            upto = table.read().agg(F.max("_ingest_at")).first()[0]  # one scalar
            rows = rows.where(F.col("_ingest_at") > F.lit(upto)) if upto else rows
        table.merge(rows, lambda old, new: hs.merge_versions(old, new, "customer_id", "updated_at", order) if before
                    else hs.scd2(new, "customer_id", "updated_at", order, keep_order=True))
        now = table.read()
        if not before:
            return now.select("customer_id").distinct()
        return _changed(table.read(before["number"]), now, ["customer_id", "version_key"], ["valid_from", "valid_to"]).select(
            "customer_id").distinct()

    def _touched(self, silver: DataFrame, state: DataFrame, changed: dict[str, DataFrame]) -> list:
        """Folders to write anew: their lines differ from the last run's by count or digest, or a
        line's customer, product or day is among the changed ones. At most one value per folder."""
        known = self.table("fact_state")
        lines = state.join(known, state[self.folder].eqNullSafe(known[self.folder]), "full_outer").where(
            ~(state["lines"].eqNullSafe(known["lines"]) & state["digest"].eqNullSafe(known["digest"])))
        days = lines.select(F.coalesce(state[self.folder], known[self.folder]).alias(self.folder))
        for key, rows in changed.items():
            days = days.unionByName(silver.join(rows, key, "left_semi").select(self.folder))
        return [r[0] for r in days.distinct().collect()]

    def _facts(self, silver: DataFrame) -> DataFrame:
        fact = fc.fact_sales(silver, self.table("dim_customer"), self.table("dim_product"),
                             self.table("dim_channel"), extra_cols=["_silver_at"], heavy=self.heavy_keys)
        if self.history:
            held = self.versions().read().select("customer_id", F.col("version_key").alias("customer_version"), "valid_from", "valid_to")
            fact = hs.as_of(fact, held, "customer_id", "order_date").drop("valid_from", "valid_to")
        return self._with_folder(fact)

    def gold(self) -> None:
        silver = self.table("silver_orders")
        if self.calendar:
            spine = dm.date_spine_between(self.spark, *self.calendar)
        else:
            spine = dm.date_spine_of(silver, "order_date")

        def channel_dim() -> None:
            keymap = self._extend_keymap(silver.select("channel"), "channel", "channel_sk")
            channels = silver.select("channel").distinct()
            dim = channels.join(keymap, channels["channel"].eqNullSafe(keymap["channel"]),
                                "inner").select("channel_sk", channels["channel"])
            sinks.overwrite(dim, self.t("dim_channel"))

        changed: dict[str, DataFrame] = {}

        def keyed_dim(name: str, source: str, key: str, sk: str, cols: list[str]) -> None:
            dim = self._keyed(self.table(source), key, sk, cols)
            if partial:  # compared with the last run's before that is overwritten
                dim = _cut(dim)
                changed[key] = _cut(_changed(self.table(name), dim, [key], [c for c in dim.columns if c != key]))
            sinks.overwrite(dim, self.t(name))

        partial = self.reload == "days" and all(
            sinks.table_exists(self.spark, self.t(n)) for n in ("fact_orders", "fact_state", "kpi_partials", "dim_customer", "dim_product"))
        if partial and (self.folder not in self.table("fact_orders").columns
                        or self.history != ("customer_version" in self.table("fact_orders").columns)):
            partial = False  # another layout than the last run's
        def date_dim() -> None:
            dim = dm.dim_date(spine)
            if partial:
                dim = _cut(dim)
                changed["order_date"] = _cut(_changed(self.table("dim_date"), dim, ["full_date"], [
                    c for c in dim.columns if c != "full_date"]).withColumnRenamed("full_date", "order_date"))
            sinks.overwrite(dim, self.t("dim_date"))

        # The dimensions are independent: their jobs run side by side.
        steps = [
            date_dim,
            lambda: keyed_dim("dim_customer", "silver_customers", "customer_id", "customer_sk", dm.CUSTOMER_COLS),
            lambda: keyed_dim("dim_product", "silver_products", "product_id", "product_sk", dm.PRODUCT_COLS),
            channel_dim]
        if self.history:
            steps.append(lambda: changed.update(versions=_cut(self._merge_history())))
        _concurrently(*steps)
        lines = self._with_folder(silver)
        own = [c for c in silver.columns if not c.startswith("_")]
        state = None
        if self.reload == "days":
            state = _cut(lines.groupBy(self.folder).agg(
                F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64(*own).cast("decimal(38,0)")).alias("digest")))
        if partial:
            if self.history:
                changed["customer_id"] = changed["customer_id"].unionByName(changed.pop("versions")).distinct()
            self.reloaded = self._touched(lines, state, changed)
            if self.reloaded:
                values = self.spark.createDataFrame([(v,) for v in self.reloaded], f"{self.folder} date")
                here = lines.join(F.broadcast(values), lines[self.folder].eqNullSafe(values[self.folder]), "left_semi")
                sinks.replace_partitions(_cut(self._facts(here.drop("order_month"))), self.t("fact_orders"), self.folder, self.reloaded)
                fact = self.table("fact_orders")
                fact = fact.join(F.broadcast(values), fact[self.folder].eqNullSafe(values[self.folder]), "left_semi")
                sinks.replace_partitions(_cut(self._partials(fact)), self.t("kpi_partials"), self.folder, self.reloaded)
        else:
            self.reloaded = None
            sinks.write_partitioned(self._facts(silver), self.t("fact_orders"), self.folder)
            if self.reload == "days":
                sinks.write_partitioned(self._partials(self.table("fact_orders")), self.t("kpi_partials"), self.folder)
        month = self.fact_grain == "month"
        if self.reload == "days":
            # Last: after a loss the next run finds the folders differing still.
            sinks.overwrite(state, self.t("fact_state"))
            self.spark.sql(kpi_view_sql(self.db, month, "partials" if self._one_day_orders() else "fact"))
        else:
            for n in ("fact_state", "kpi_partials"):  # of an earlier run by days; they no longer hold
                sinks.drop(self.spark, self.t(n))
            self.spark.sql(kpi_view_sql(self.db, month))
        lines, days, channels, none = silver.agg(
            F.count(F.lit(1)), F.datediff(F.max("order_date"), F.min("order_date")) + 1,
            F.count_distinct("channel"), F.max(F.col("channel").isNull().cast("int"))).first()
        if self.calendar:
            days = spine.count()
        self.expected.update(
            dim_date=days or 0, dim_channel=channels + (none or 0), fact_orders=lines,
            dim_customer=self.table("silver_customers").count(),
            dim_product=self.table("silver_products").count())
        sinks.overwrite(self.spark.createDataFrame(
            sorted(self.expected.items()), "table_name string, expected_rows bigint"),
            self.t("run_expectations"))

    def _partials(self, fact: DataFrame) -> DataFrame:
        """Sums of the view's measures per folder and group; those of several folders add up."""
        return kp.star(fact, self.table("dim_date"), self.table("dim_product"), self.table("dim_customer"),
                       self.table("dim_channel"), extra=[self.folder])

    def _one_day_orders(self) -> bool:
        """Whether every order lies in one folder: then the orders of folders add up. If not, the
        view counts them in the fact."""
        several = self.table("fact_orders").groupBy("order_id").agg(
            F.min(self.folder).alias("a"), F.max(self.folder).alias("b"), F.count_if(F.col(self.folder).isNull()).alias("n"),
            F.count(F.lit(1)).alias("m")).where("a <> b OR (n > 0 AND n < m)")
        return several.isEmpty()

    # ------------------------------------------------------------------ checks
    def check(self, fail_on_error: bool = False, fresh_since: str | None = None,
              max_age_days: int | None = None) -> DataFrame:
        """``fresh_since``: the latest order date must not be before that day;
        ``max_age_days``: nor older than so many days today. Without either, silver must be
        as recent as bronze."""
        s = self.src
        frames = quality.Frames(
            labelled_sales=lambda: sv.labelled(s.sales_entity, self.table("bronze_orders")),
            silver_sales=lambda: self.table("silver_orders"),
            customers_ref=lambda: self.table("silver_customers"),
            products_ref=lambda: self.table("silver_products"),
            fact=lambda: self.table("fact_orders"),
            keys=s.sales_entity.keys, tie_break=s.sales_entity.tie_break,
            fresh_since=fresh_since, max_age_days=max_age_days)
        results = quality.run_suite(frames, [*quality.CHECKS, *quality.TABLE_CHECKS])
        sinks.overwrite(results, self.t("test_results"))
        out = self.table("test_results")
        if fail_on_error:
            failed = out.where(F.col("status") == ck.FAIL).select("check").collect()
            if failed:
                raise RuntimeError(f"data-quality checks failed: {[r[0] for r in failed]}")
        return out

    def run(self, fail_on_error: bool = False, fresh_since: str | None = None,
            max_age_days: int | None = None) -> DataFrame:
        self.bronze()
        self.silver()
        self.gold()
        return self.check(fail_on_error, fresh_since, max_age_days)

    # ------------------------------------------------------------------ health
    def health(self, expected: dict[str, int] | None = None) -> DataFrame:
        """Row count per table against expectations (default: those the last run wrote,
        for all twelve tables), plus whether the KPI view can be read. A table that does
        not exist fails; one that nothing is expected of is reported as such, never as
        passed; other errors raise."""
        names = ["bronze_orders", "bronze_customers", "bronze_products", "silver_orders",
                 "silver_customers", "silver_products", "quarantine_orders", "dim_date",
                 "dim_customer", "dim_product", "dim_channel", "fact_orders", "vw_sales_kpis"]
        self.ensure_view()
        if expected is None and sinks.table_exists(self.spark, self.t("run_expectations")):
            expected = {r[0]: r[1] for r in self.table("run_expectations").collect()}  # 12 rows
        exp = dict(expected or {})
        parts = []
        for n in names:
            if not sinks.table_exists(self.spark, self.t(n)):
                parts.append(self.spark.range(1).select(
                    F.lit(n).alias("table_name"), F.lit(None).cast("bigint").alias("actual_rows")))
                continue
            parts.append(self.table(n).agg(F.count(F.lit(1)).alias("actual_rows"))
                         .select(F.lit(n).alias("table_name"), "actual_rows"))
        counts = parts[0]
        for p in parts[1:]:
            counts = counts.unionByName(p)
        expect = F.create_map(*[x for k, v in exp.items() for x in (F.lit(k), F.lit(v))]) \
            if exp else F.create_map().cast("map<string,bigint>")
        res = counts.select("table_name", "actual_rows",
                            expect[F.col("table_name")].cast("bigint").alias("expected_rows"))
        readable = F.col("table_name") == "vw_sales_kpis"  # of the view only that
        res = res.withColumn(
            "status", F.when(F.col("actual_rows").isNull(), ck.FAIL)
            .when(F.col("actual_rows") == F.col("expected_rows"), ck.PASS)
            .when(F.col("expected_rows").isNotNull(), ck.FAIL)
            .when(readable, ck.PASS).otherwise(ck.NO_EXPECTATION))
        verdict = res.agg(
            F.lit("ALL").alias("table_name"),
            F.count_if(F.col("status") == ck.PASS).alias("actual_rows"),
            F.count(F.lit(1)).alias("expected_rows"),
            F.when(F.bool_or(F.col("status") == ck.FAIL), ck.FAIL)
             .when(F.bool_or(F.col("status") == ck.NO_EXPECTATION), ck.NO_EXPECTATION)
             .otherwise(ck.PASS).alias("status"))
        return res.unionByName(verdict)

    def ensure_view(self) -> None:
        """(Re)create the KPI view when the gold tables exist but the session
        catalog does not know the view (a new process, no metastore)."""
        if self.spark.catalog.tableExists(self.t("vw_sales_kpis")):
            return
        if all(sinks.attach(self.spark, self.t(n)) for n in
               ["fact_orders", "dim_date", "dim_customer", "dim_product", "dim_channel"]):
            month = "order_month" in self.table("fact_orders").columns
            self.fact_grain = "month" if month else "day"
            days = all(sinks.attach(self.spark, self.t(n)) for n in ("kpi_partials", "fact_state"))
            self.spark.sql(kpi_view_sql(self.db, month, "partials" if days and self._one_day_orders() else "fact"))

    def dropped(self) -> DataFrame:
        """Fact lines the KPI view's inner joins drop, and their revenue (trap 8)."""
        from tierwise.operators.kpis import kpi_dropped
        return kpi_dropped(self.table("fact_orders"), self.table("dim_date"))

    def reconcile_detail(self) -> DataFrame:
        """Keys whose valid bronze total (duplicates kept) differs from silver (C12)."""
        from tierwise.functions.money import cents, from_cents
        keys = self.src.sales_entity.keys
        lab = sv.labelled(self.src.sales_entity, self.table("bronze_orders"))
        bronze = (lab.where(F.col(ISSUE) == OK).groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("bronze_rows"), F.sum(cents("amount")).alias("_b")))
        silver = self.table("silver_orders").groupBy(*keys).agg(F.sum(cents("amount")).alias("_s"))
        diff = bronze.join(silver, keys, "full_outer").where(~F.col("_b").eqNullSafe(F.col("_s")))
        return diff.select(*keys, F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
                           from_cents("_b").alias("bronze_amount"),
                           from_cents("_s").alias("silver_amount"),
                           from_cents(F.coalesce("_b", F.lit(0)) - F.coalesce("_s", F.lit(0)))
                           .alias("difference"))


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _changed(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Keys that only one of both has, or whose ``cols`` differ."""
    a = old.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*cols).alias("_a"))
    b = new.select(*keys, F.struct(*cols).alias("_b"))
    same = reduce(and_, [b[k].eqNullSafe(a[f"_{k}"]) for k in keys])
    return (b.join(a, same, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
            .select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys]))


def kpi_view_sql(db: str, month_folders: bool = False, source: str = "fact") -> str:
    """The KPI view: the reference's grain and measures, money in exact cents.

    From the fact, lines are first reduced to one row per order and keys, and orders counted
    after the dimensions have come to these, so nothing is made distinct. The date dimension
    joins on the fact's partition column (``order_date``, or ``order_month`` for month
    folders) so a filter on the view's date attributes prunes fact folders at run time
    (dynamic partition pruning). ``partials``: the sums kept per folder are added up.
    """
    names = ", ".join(kp.STAR_GROUPS)
    if source == "partials":
        body = f"""
  SELECT {names}, CAST(SUM(order_count) AS BIGINT) AS order_count, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
         CAST(SUM(_rev) AS DECIMAL(30,0)) AS rev, CAST(SUM(_gp) AS DECIMAL(30,0)) AS gp
  FROM {db}.kpi_partials GROUP BY {names}"""
    else:
        folder = "order_month, " if month_folders else ""
        pruned = " AND order_month = trunc(full_date, 'MM')" if month_folders else ""
        cents = "SUM(CAST(TRY_CAST({} AS DECIMAL(18,2)) * 100 AS DECIMAL(18,0)))"
        body = f"""
  SELECT {names}, COUNT(order_id) AS order_count, CAST(SUM(units) AS BIGINT) AS units_sold,
         CAST(SUM(rev) AS DECIMAL(30,0)) AS rev, CAST(SUM(gp) AS DECIMAL(30,0)) AS gp
  FROM (
    SELECT {names}, order_id, SUM(units) AS units, SUM(rev) AS rev, SUM(gp) AS gp
    FROM (SELECT order_id, order_date, {folder}product_sk, customer_sk, channel_sk, SUM(quantity) AS units,
                 {cents.format('amount')} AS rev, {cents.format('gross_profit')} AS gp
          FROM {db}.fact_orders
          GROUP BY order_id, order_date, {folder}product_sk, customer_sk, channel_sk) AS reduced
    JOIN (SELECT channel_sk, channel FROM {db}.dim_channel) USING (channel_sk)
    JOIN (SELECT product_sk, category, brand FROM {db}.dim_product) USING (product_sk)
    JOIN (SELECT customer_sk, region, segment, country_code FROM {db}.dim_customer) USING (customer_sk)
    JOIN {db}.dim_date AS calendar ON order_date = full_date{pruned}
    GROUP BY {names}, order_id)
  GROUP BY {names}"""
    return f"""
CREATE OR REPLACE VIEW {db}.vw_sales_kpis AS
SELECT {names}, order_count, units_sold,
       CAST(rev AS DOUBLE) / 100 AS revenue,
       CAST(sign(rev) * ((abs(rev) * 2 + order_count) div (2 * order_count)) AS DOUBLE) / 100
         AS avg_order_value,
       CAST(gp AS DOUBLE) / 100 AS gross_profit,
       CASE WHEN rev = 0 THEN NULL ELSE
         CAST(sign(gp) * sign(rev) * ((abs(gp) * 2000 + abs(rev)) div (2 * abs(rev))) AS DOUBLE)
           / 10 END AS margin_pct
FROM ({body})"""
