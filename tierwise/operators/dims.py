"""Gold dimensions: generated date dimension and keyed entity dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions.dates import date_attributes
from tierwise.functions.keys import dense_key_map, with_dense_key

# The reference's generated calendar (1096 days).
REFERENCE_CALENDAR = ("2023-01-01", "2025-12-31")

CUSTOMER_COLS = ["customer_id", "name", "email", "region", "segment", "country_code", "updated_at"]
PRODUCT_COLS = ["product_id", "name", "category", "brand", "unit_cost"]

# The attributes by which the KPI view groups, and the column that stands for them.
DATE_GROUP = ["year", "quarter", "month", "month_name", "day_type"]
PRODUCT_GROUP = ["category", "brand"]
CUSTOMER_GROUP = ["region", "segment", "country_code"]
GROUP = "_group"


def date_spine_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, ``start`` .. ``end`` inclusive (a fixed calendar)."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def date_spine_of(df: DataFrame, col: str = "order_date") -> DataFrame:
    """One row per day from the earliest to the latest ``col`` in ``df``.

    The bounds are a single-row aggregate (partial per task, no data to the
    driver); the spine itself is bounded by the number of calendar days.
    """
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    days = F.sequence(F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))
    return bounds.where(F.col("lo").isNotNull()).select(F.explode(days).alias("full_date"))


def dim_date(spine: DataFrame) -> DataFrame:
    return spine.select(*date_attributes("full_date"))


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    return with_dense_key(silver_customers.select(*CUSTOMER_COLS), ["customer_id"], "customer_sk")


def dim_product(silver_products: DataFrame) -> DataFrame:
    return with_dense_key(silver_products.select(*PRODUCT_COLS), ["product_id"], "product_sk")


def groups(dim: DataFrame, sk: str, cols: list[str]) -> DataFrame:
    """The combinations of ``cols``, each with the smallest surrogate key that has it."""
    return dim.groupBy(*cols).agg(F.min(sk).alias(sk + GROUP))


def with_group(dim: DataFrame, sk: str, cols: list[str]) -> DataFrame:
    """``dim`` with ``<sk>_group``: rows that agree in ``cols`` get one surrogate key, so what
    is grouped by ``cols`` can be moved and grouped by one number instead."""
    g = groups(dim, sk, cols).select(*[F.col(c).alias(f"_g_{c}") for c in cols], sk + GROUP)
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in cols]
    return dim.join(g, same).select(*dim.columns, sk + GROUP)


def dim_from_values(df: DataFrame, col: str, sk: str) -> DataFrame:
    """Dimension of the distinct values of one fact column (``dim_channel``).

    A NULL value becomes a member too, but the fact's equi-join never
    matches it (as in the reference).
    """
    return dense_key_map(df, [col], sk).select(sk, col)
