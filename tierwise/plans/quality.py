"""The data-quality suite and the health check, over the registry's plans.

Expected values are derived from the same run (SURVEY E4) instead of the
reference's hard-coded counts: e.g. the silver row count must equal the
number of distinct business keys among the valid bronze rows
(bronze - quarantined - duplicates).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.money import cents, from_cents
from tierwise.operators import checks as ck
from tierwise.operators import dims as dm
from tierwise.operators import kpis as kp
from tierwise.operators import silver as sv
from tierwise.operators.clean import ISSUE
from tierwise.plans import registry as rg
from tierwise.session import checkpoint_dir
from tierwise.sources import testdata as td

# The columns the reference's schema check expects in silver orders.
EXPECTED_SILVER_COLUMNS = ["order_id", "customer_id", "product_id", "order_date", "quantity",
                           "unit_price", "amount", "channel", "discount_pct"]
CRITICAL_COLUMNS = ["order_id", "product_id", "amount", "order_date"]

def _ok() -> Column:
    return F.col(ISSUE) == "ok"


def _good_key() -> Column:
    return F.when(_ok(), F.struct(*[F.col(k) for k in rg.SALES.keys]))


class Frames:
    """The DataFrames a check suite reads (callables: lazy plans or written tables)."""

    def __init__(self, labelled_sales, silver_sales, customers_ref, products_ref, fact, keys,
                 tie_break, fresh_since: str | None = None, max_age_days: int | None = None):
        self.labelled_sales = labelled_sales
        self.silver_sales = silver_sales
        self.customers_ref = customers_ref
        self.products_ref = products_ref
        self.fact = fact
        self.keys = keys
        self.tie_break = tie_break
        self.fresh_since = fresh_since
        self.max_age_days = max_age_days


def registry_frames(spark: SparkSession, d: str) -> Frames:
    """Frames over the registry's plans. Orphan checks use the dirty-customer and
    dirty-product variants so that they bite. Several checks read silver: they read one
    exchange of its dedup, and nothing is computed before the checks run."""

    @functools.cache
    def silver() -> DataFrame:
        return rg.Gold(spark, d).silver_sales

    def lines_with_profit() -> DataFrame:
        cost = rg.silver_products(spark, d).select("product_id", "unit_cost")
        return silver().join(cost, "product_id", "left").withColumn(
            "gross_profit", F.col("amount") - F.col("quantity") * F.col("unit_cost"))

    return Frames(
        labelled_sales=lambda: rg.labelled_sales(spark, d),
        silver_sales=silver,
        customers_ref=lambda: rg.silver_customers(spark, d, dirty=True),
        products_ref=lambda: rg.silver_products(spark, d, dirty=True),
        fact=lines_with_profit,
        keys=rg.SALES.keys, tie_break=rg.SALES.tie_break)


def first_of_key(rows: DataFrame, keys: list[str], tie_break: list[str]) -> DataFrame:
    """Cents of the first valid bronze line per key: the reconciliation's own way to what
    silver must hold (an aggregate of one value, not silver's dedup)."""
    order = [c for c in tie_break if c in rows.columns]
    first = F.min(F.struct(*order, *[c for c in ["amount"] if c not in order])).alias("w")
    return rows.where(_ok()).groupBy(F.struct(*keys)).agg(first).select(cents("w.amount").alias("c"))


def _table_builders(fr: Frames) -> dict[str, Callable[[], tuple]]:
    """Per table its metrics; only those that a selected check names are built."""
    good_key = F.when(_ok(), F.struct(*[F.col(k) for k in fr.keys]))

    def of_silver(column: str, expr: Column) -> Column:
        """A metric of an absent column is NULL, which fails its check."""
        return expr if column in fr.silver_sales().columns else F.lit(None).cast("bigint")

    def one_row(**values: Column) -> tuple:
        return fr.silver_sales().sparkSession.range(1), {k: F.max(v) for k, v in values.items()}

    return {
        "bronze": lambda: (fr.labelled_sales(), dict(
            rows=F.count(F.lit(1)),
            quarantined=F.count_if(~_ok()),
            good_keys=F.count_distinct(good_key),
            duplicates=F.count_if(_ok()) - F.count_distinct(good_key),
            valid_revenue_all=F.sum(F.when(_ok(), cents("amount"))),
            latest=F.unix_date(F.max(F.when(_ok(), F.col("order_date")))),
        )),
        "bronze_first": lambda: (first_of_key(fr.labelled_sales(), fr.keys, fr.tie_break),
                                 dict(revenue=F.sum("c"))),
        "silver": lambda: (fr.silver_sales(), dict(
            rows=F.count(F.lit(1)),
            **{f"null_{c}": of_silver(c, F.count_if(F.col(c).isNull())) for c in CRITICAL_COLUMNS},
            negative=of_silver("amount", F.count_if(F.col("amount") < 0)),
            revenue=of_silver("amount", F.sum(cents("amount"))),
            latest=of_silver("order_date", F.unix_date(F.max("order_date"))),
        )),
        # Names only: no row is read.
        "silver_schema": lambda: one_row(missing=F.lit(len(missing_columns(fr)))),
        "wanted": lambda: one_row(
            since=F.unix_date(F.to_date(F.lit(fr.fresh_since))),
            day=F.unix_date(F.date_sub(F.current_date(), fr.max_age_days or 0))),
        "silver_dups": lambda: (ck.duplicate_keys(fr.silver_sales(), fr.keys), dict(
            n=F.count(F.lit(1)))),
        "orphan_customers": lambda: (ck.orphans(fr.silver_sales(), fr.customers_ref(),
                                                "customer_id"), dict(n=F.count(F.lit(1)))),
        "orphan_products": lambda: (ck.orphans(fr.silver_sales(), fr.products_ref(),
                                               "product_id"), dict(n=F.count(F.lit(1)))),
        "fact": lambda: (fr.fact(), dict(
            rows=F.count(F.lit(1)), revenue=F.sum(cents("amount")),
            negative_profit=F.count_if(F.col("gross_profit") < 0))),
    }


def missing_columns(fr: Frames) -> list[str]:
    have = fr.silver_sales().columns
    return [c for c in EXPECTED_SILVER_COLUMNS if c not in have]


def freshness(fr: Frames) -> list[ck.Check]:
    out = []
    text = "newest order is of {actual}, needed {expected}"
    if fr.fresh_since:
        out.append(ck.Check("silver_sales reaches the wanted day", "silver.latest", "wanted.since",
                            kind="date", op="ge", details=text))
    if fr.max_age_days is not None:
        out.append(ck.Check("silver_sales is young enough", "silver.latest", "wanted.day",
                            kind="date", op="ge", details=text))
    return out or [ck.Check("silver_sales is as recent as bronze", "silver.latest", "bronze.latest",
                            kind="date", details=text)]


def schema(fr: Frames) -> list[ck.Check]:
    gone = missing_columns(fr)
    return [ck.Check("silver_sales has every expected column", "silver_schema.missing", 0,
                     details=f"absent: {', '.join(gone)}" if gone
                     else f"{len(EXPECTED_SILVER_COLUMNS)} of {len(EXPECTED_SILVER_COLUMNS)} present")]


# A check group is a list of checks, or a function of the frames that gives one.
CHECKS: dict[str, list[ck.Check] | Callable[[Frames], list[ck.Check]]] = {
    "check_row_count": [ck.Check(
        "silver_sales holds every valid key once", "silver.rows", "bronze.good_keys",
        details="of {bronze.rows} bronze lines {bronze.quarantined} rejected,"
                " {bronze.duplicates} repeated")],
    "check_nulls": [ck.Check(f"silver_sales.{c} is filled", f"silver.null_{c}", 0,
                             details=f"{{actual}} lines without {c}")
                    for c in CRITICAL_COLUMNS],
    "check_unique": [ck.Check("silver_sales key occurs once", "silver_dups.n", 0,
                              details="{actual} repeated keys")],
    "check_negative": [ck.Check("silver_sales amounts are not below zero", "silver.negative", 0,
                                details="{actual} lines below zero")],
    "check_orphan_customer": [ck.Check("every line's customer is known", "orphan_customers.n", 0,
                                       details="{actual} lines with an unknown customer")],
    "check_orphan_product": [ck.Check("every line's product is known", "orphan_products.n", 0,
                                      details="{actual} lines with an unknown product")],
    "check_reconcile": [ck.Check(
        "silver_sales revenue agrees with bronze", "silver.revenue", "bronze_first.revenue",
        kind="money", details="repeated lines included: {bronze.valid_revenue_all}")],
    "check_freshness": freshness,
    "check_profit": [ck.Check("no line sells below cost", "fact.negative_profit", 0,
                              details="{actual} lines below cost")],
    "check_schema": schema,
}

# Of the written tables only: a fact left over from another run shows here.
TABLE_CHECKS: dict[str, list[ck.Check]] = {
    "check_fact_rows": [ck.Check("fact has silver's lines", "fact.rows", "silver.rows",
                                 details="{actual} lines in the fact, {expected} in silver")],
    "check_fact_revenue": [ck.Check("fact has silver's revenue", "fact.revenue", "silver.revenue",
                                    kind="money", details="{actual} in the fact, {expected} in silver")],
}

METRIC_KINDS = {"bronze.valid_revenue_all": "money", "bronze.latest": "date",
                "silver.latest": "date", "silver.revenue": "money", "fact.revenue": "money",
                "bronze_first.revenue": "money", "wanted.since": "date", "wanted.day": "date"}


def _refs_of(checks: list[ck.Check]) -> dict[str, set[str]]:
    """Metrics that checks name, by table."""
    refs: dict[str, set[str]] = {}
    for c in checks:
        for ref in [c.actual, c.expected] + re.findall(r"\{([^{}]+)\}", c.details):
            if isinstance(ref, str) and "." in ref:
                table, metric = ref.split(".", 1)
                refs.setdefault(table, set()).add(metric)
    return refs


def run_checks(spark: SparkSession, d: str, keys: list[str] | None = None) -> DataFrame:
    return run_suite(registry_frames(spark, d), keys)


def run_suite(frames: Frames, keys: list[str] | None = None) -> DataFrame:
    selected = []
    for k in keys or CHECKS:
        group = CHECKS[k] if k in CHECKS else TABLE_CHECKS[k]
        selected += group(frames) if callable(group) else group
    builders = _table_builders(frames)
    metrics = ck.MetricSet()
    for table, names in sorted(_refs_of(selected).items()):
        df, exprs = builders[table]()
        metrics.add(table, df, **{n: e for n, e in exprs.items() if n in names})
    return ck.evaluate(metrics, selected, METRIC_KINDS)


def reconcile_detail(spark: SparkSession, d: str) -> DataFrame:
    """Keys whose valid bronze total (duplicates kept) differs from silver (C12)."""
    keys = rg.SALES.keys
    bronze = (rg.labelled_sales(spark, d).where(_ok()).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("bronze_rows"), F.sum(cents("amount")).alias("_b")))
    silver = rg.silver_sales(spark, d).groupBy(*keys).agg(F.sum(cents("amount")).alias("_s"))
    joined = bronze.join(silver, keys, "full_outer")
    diff = joined.where(~F.col("_b").eqNullSafe(F.col("_s")))
    return diff.select(*keys, F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
                       from_cents("_b").alias("bronze_amount"),
                       from_cents("_s").alias("silver_amount"),
                       from_cents(F.coalesce("_b", F.lit(0)) - F.coalesce("_s", F.lit(0)))
                       .alias("difference"))


def health_counts(spark: SparkSession, d: str) -> DataFrame:
    """Actual vs expected rows per table, the KPI view, and an overall verdict (H1-H3)."""
    g = rg.Gold(spark, d, of_silver=True)
    # Layers are tables in production; here silver, the dimensions and the fact are cut once,
    # order lines to the columns that the counts read.
    checkpoint_dir(spark)
    read = {"silver_sales": ["order_id", "customer_id", "product_id", "order_date", "channel", "quantity", "amount"],
            "silver_customers": None, "silver_products": None, "dim_customer": None, "dim_product": None,
            "grouped_fact": ["order_id", "date_sk", "customer_sk", "product_sk", "channel_sk", "customer_sk_group",
                             "product_sk_group", "quantity", "amount", "gross_profit"]}
    for name, cols in read.items():
        rows = getattr(g, name)
        setattr(g, name, rows.select(*(cols or rows.columns)).checkpoint(eager=True))
    lab_c = sv.labelled(rg.CUSTOMERS, td.bronze_customers(spark, d))
    lab_p = sv.labelled(rg.PRODUCTS, td.bronze_products(spark, d))
    n = lambda: F.count(F.lit(1))
    # The view's groups counted another way: over the natural keys, without the fact.
    products = dm.with_group(g.silver_products, "product_id", dm.PRODUCT_GROUP).select("product_id", "product_id_group")
    customers = dm.with_group(g.silver_customers, "customer_id", dm.CUSTOMER_GROUP).select(
        "customer_id", "customer_id_group")
    groups = (g.silver_sales.where("channel IS NOT NULL")
              .select(F.trunc("order_date", "MM").alias("m"), F.dayofweek("order_date").isin(1, 7).alias("w"),
                      "customer_id", "product_id", "channel")
              .join(products, "product_id").join(customers, "customer_id").drop("product_id", "customer_id"))
    m = ck.MetricSet()
    m.add("src_lineitem", td.table(spark, d, "lineitem"), rows=n())
    m.add("src_customer", td.table(spark, d, "customer"), rows=n())
    m.add("src_part", td.table(spark, d, "part"), rows=n())
    m.add("bronze_sales", rg.labelled_sales(spark, d), rows=n(), bad=F.count_if(~_ok()),
          good_keys=F.count_distinct(_good_key()))
    m.add("bronze_customers", lab_c, rows=n(),
          good_keys=F.count_distinct(F.when(_ok(), F.struct("customer_id"))))
    m.add("bronze_products", lab_p, rows=n(),
          good_keys=F.count_distinct(F.when(_ok(), F.struct("product_id"))))
    m.add("quarantine_sales", sv.quarantined(rg.SALES, rg.bronze_sales(spark, d)), rows=n())
    m.add("silver_sales", g.silver_sales, rows=n(),
          days=F.datediff(F.max("order_date"), F.min("order_date")) + 1,
          channels=F.count_distinct("channel") + F.max(F.col("channel").isNull().cast("int")))
    m.add("silver_customers", g.silver_customers, rows=n())
    m.add("silver_products", g.silver_products, rows=n())
    m.add("dim_date", g.dim_date, rows=n())
    m.add("dim_customer", g.dim_customer, rows=n())
    m.add("dim_product", g.dim_product, rows=n())
    m.add("dim_channel", g.dim_channel, rows=n())
    m.add("fact_sales", g.grouped_fact, rows=n())
    m.add("kpi_star", kp.kpi_star(g.star()), rows=n())
    m.add("star_rows", groups, groups=F.count_distinct(F.struct("*")))
    expectations = [
        ("bronze_sales", "src_lineitem.rows"), ("bronze_customers", "src_customer.rows"),
        ("bronze_products", "src_part.rows"), ("quarantine_sales", "bronze_sales.bad"),
        ("silver_sales", "bronze_sales.good_keys"),
        ("silver_customers", "bronze_customers.good_keys"),
        ("silver_products", "bronze_products.good_keys"), ("dim_date", "silver_sales.days"),
        ("dim_customer", "silver_customers.rows"), ("dim_product", "silver_products.rows"),
        ("dim_channel", "silver_sales.channels"), ("fact_sales", "silver_sales.rows"),
        ("kpi_star", "star_rows.groups"),
    ]
    checks = [ck.Check(t, f"{t}.rows", e) for t, e in expectations]
    res = ck.evaluate(m, checks).select(
        F.col("check").alias("table_name"), F.col("expected").cast("bigint").alias("expected_rows"),
        F.col("actual").cast("bigint").alias("actual_rows"), "status")
    verdict = res.agg(
        F.lit("ALL").alias("table_name"), F.count(F.lit(1)).alias("expected_rows"),
        F.count_if(F.col("status") == ck.PASS).alias("actual_rows"),
        F.when(F.bool_and(F.col("status") == ck.PASS), F.lit(ck.PASS)).otherwise(F.lit(ck.FAIL))
        .alias("status"))
    return res.unionByName(verdict)
