"""KPI queries over the star schema.

``kpi_star`` is the reference's KPI view (inner joins, 11 group columns).
The README's rollups are computed from the fact, each at its own grain
(SURVEY trap 16), never re-aggregated from the view's rounded figures.

Money is summed in integer cents and rounded with integer division
(``tierwise.functions.money``). Rollups over a large dimension (customer,
product) aggregate the fact by the dimension key first, so the join sees one
row per key instead of one per order line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.money import avg_cents, cents, from_cents, pct_tenths
from tierwise.operators import dims as dm

STAR_GROUPS = [*dm.DATE_GROUP, *dm.PRODUCT_GROUP, *dm.CUSTOMER_GROUP, "channel"]


def star(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
         dim_customer: DataFrame, dim_channel: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The view's groups (and ``extra``) and what adds up of its measures: orders (each in one
    group), units, cents. Inner joins on surrogate keys: a line without one of the four is in
    no group.

    Lines are counted under the surrogate key that stands for all with the view's attributes
    (``dims.with_group``; taken from the fact if its lookup brought it). So no exchange of
    lines carries names, which are joined to the sums of the groups.
    """
    dims = [(dim_date, "date_sk", dm.DATE_GROUP), (dim_product, "product_sk", dm.PRODUCT_GROUP),
            (dim_customer, "customer_sk", dm.CUSTOMER_GROUP)]
    lines = fact
    for dim, sk, cols in dims:
        if sk + dm.GROUP not in fact.columns:
            lines = lines.join(dm.with_group(dim, sk, cols).select(sk, sk + dm.GROUP), sk)
    keys = [*[sk + dm.GROUP for _, sk, _ in dims], "channel_sk"]
    rows = lines.dropna(subset=keys).select(
        *(extra or []), *keys, "order_id", "quantity", cents("amount").alias("_rev"), cents("gross_profit").alias("_gp"))
    sums = _by_order_then_group(rows, [*(extra or []), *keys])
    for dim, sk, cols in dims:
        sums = sums.join(dm.groups(dim, sk, cols), sk + dm.GROUP)
    sums = sums.join(dim_channel.select("channel_sk", "channel"), "channel_sk")
    return sums.select(*(extra or []), *STAR_GROUPS, "order_count", "units_sold", "_rev", "_gp")


def _by_order_then_group(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Aggregate to one row per (groups, order_id), then per groups.

    Exact for ``COUNT(DISTINCT order_id)``: the per-order rows are unique, so counting
    them counts distinct orders, and both levels combine map-side before their shuffle.
    Totals of orders are bigint cents, totals of groups decimals (no overflow).
    Output columns: groups, order_count, units_sold, _rev, _gp, _lines.
    """
    per_order = rows.groupBy(*groups, "order_id").agg(
        F.sum("quantity").alias("_q"),
        F.sum(F.col("_rev") if "_rev" in rows.columns else cents("amount")).alias("_rev"),
        F.sum(F.col("_gp") if "_gp" in rows.columns else F.lit(None).cast("bigint")).alias("_gp"),
        F.count(F.lit(1)).alias("_lines"))
    return per_order.groupBy(*groups).agg(
        F.count("order_id").alias("order_count"),
        F.sum("_q").cast("bigint").alias("units_sold"),
        total("_rev"), total("_gp"), F.sum("_lines").alias("_lines"))


def total(col: str):
    """Sum of bigint cents as a decimal of its own range."""
    return F.sum(F.col(col).cast("decimal(28,0)")).alias(col)


def kpi_star(sums: DataFrame) -> DataFrame:
    """The view, of ``star``'s sums."""
    return sums.select(*STAR_GROUPS, "order_count", "units_sold",
                    from_cents("_rev").alias("revenue"),
                    avg_cents("_rev", "order_count").alias("avg_order_value"),
                    from_cents("_gp").alias("gross_profit"),
                    pct_tenths("_gp", "_rev").alias("margin_pct"))


def kpi_top(kpis: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` KPI rows by revenue; ties broken by the group columns so the
    cut is deterministic. Planned as TakeOrderedAndProject (per-task top k)."""
    order = [F.col("revenue").desc()] + [F.col(c).asc_nulls_first() for c in STAR_GROUPS]
    return kpis.orderBy(*order).limit(k)


def kpi_time(lines: DataFrame) -> DataFrame:
    """Revenue by year, quarter and month in one pass (ROLLUP), over one row per order and
    month instead of one per line. ``lines``: silver or the fact; no dimension is needed."""
    d = F.col("order_date")
    per_order = lines.groupBy(
        "order_id", F.year(d).cast("int").alias("year"), F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month")).agg(
        F.sum("quantity").alias("quantity"), F.sum(cents("amount")).alias("_rev"))
    g = per_order.rollup("year", "quarter", "month").agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("quantity").cast("bigint").alias("units_sold"), total("_rev"))
    return g.select("year", "quarter", "month", "grouping_level", "order_count", "units_sold",
                    from_cents("_rev").alias("revenue"))


def kpi_channel(fact: DataFrame) -> DataFrame:
    """Order count by channel (the fact carries the channel value)."""
    g = _by_order_then_group(fact, ["channel"])
    return g.select("channel", "order_count", g["_lines"].alias("line_count"),
                    from_cents("_rev").alias("revenue"))


def kpi_daytype(fact: DataFrame) -> DataFrame:
    """Weekday vs weekend sales (day type derived from the order date)."""
    day_type = F.when(F.dayofweek("order_date").isin(1, 7), "Weekend").otherwise("Weekday")
    g = _by_order_then_group(fact.withColumn("day_type", day_type), ["day_type"])
    return g.select("day_type", "order_count", "units_sold", from_cents("_rev").alias("revenue"))


def kpi_segment(lines: DataFrame, dim_customer: DataFrame, key: str = "customer_sk") -> DataFrame:
    """Average order value (revenue / distinct orders) by customer segment.

    The lines are first reduced to one row per (customer, order), so the join to the
    customer dimension, on its surrogate or natural key, carries orders, not lines.
    """
    per_order = lines.where(F.col(key).isNotNull()).groupBy(key, "order_id").agg(
        F.sum(cents("amount")).alias("_rev"))
    joined = per_order.join(dim_customer.select(key, "segment"), key)
    g = joined.groupBy("segment").agg(F.count_distinct("order_id").alias("order_count"), total("_rev"))
    return g.select("segment", "order_count", from_cents("_rev").alias("revenue"),
                    avg_cents("_rev", "order_count").alias("avg_order_value"))


def kpi_category(lines: DataFrame, dim_product: DataFrame, key: str = "product_sk") -> DataFrame:
    """Gross profit and margin % by product category. Lines that carry ``gross_profit`` are
    reduced to one row per product before the join; others meet their unit cost in it."""
    have = "gross_profit" in lines.columns
    rows = lines.where(F.col(key).isNotNull())
    if have:
        rows = rows.groupBy(key).agg(F.sum(cents("amount")).alias("_rev"),
                                     F.sum(cents("gross_profit")).alias("_gp"))
        joined = rows.join(dim_product.select(key, "category"), key)
    else:
        joined = rows.join(dim_product.select(key, "category", "unit_cost"), key).select(
            "category", cents("amount").alias("_rev"),
            cents(F.col("amount") - F.col("quantity") * F.col("unit_cost")).alias("_gp"))
    g = joined.groupBy("category").agg(total("_rev"), total("_gp"))
    return g.select("category", from_cents("_rev").alias("revenue"),
                    from_cents("_gp").alias("gross_profit"),
                    pct_tenths("_gp", "_rev").alias("margin_pct"))


def kpi_geo(lines: DataFrame, dim_customer: DataFrame, key: str = "customer_sk") -> DataFrame:
    """Revenue by region and country with subtotals (ROLLUP), pre-aggregated per customer."""
    per_customer = lines.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(cents("amount")).alias("_rev"), F.count(F.lit(1)).alias("_lines"))
    joined = per_customer.join(dim_customer.select(key, "region", "country_code"), key)
    g = joined.rollup("region", "country_code").agg(
        F.grouping_id().cast("int").alias("grouping_level"),
        F.sum("_lines").alias("line_count"), total("_rev"))
    return g.select("region", "country_code", "grouping_level", "line_count",
                    from_cents("_rev").alias("revenue"))


def kpi_dropped(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact lines the star's inner joins drop, and their revenue."""
    dated = fact.join(dim_date.select("date_sk", F.lit(True).alias("_has_date")), "date_sk", "left")
    reasons = {
        "missing_customer": F.col("customer_sk").isNull(),
        "missing_product": F.col("product_sk").isNull(),
        "missing_channel": F.col("channel_sk").isNull(),
        "missing_date": F.col("_has_date").isNull(),
    }
    dropped = reasons["missing_customer"] | reasons["missing_product"] \
        | reasons["missing_channel"] | reasons["missing_date"]
    g = dated.agg(F.count_if(dropped).alias("dropped_rows"),
                  F.sum(F.when(dropped, cents("amount"))).alias("_rev"),
                  *[F.count_if(c).alias(n) for n, c in reasons.items()])
    return g.select("dropped_rows", F.coalesce(from_cents("_rev"), F.lit(0.0))
                    .alias("dropped_revenue"), *reasons)
