"""Map the driver's TPC-H-like tables onto the three bronze sources.

The reference ingests orders, customers and products. Here they come from
``lineitem ⋈ orders``, ``customer ⋈ nation ⋈ region`` and ``part``. The
tables carry no NULLs, blanks or negative amounts, so the reference's seeded
dirt (a missing customer, a negative amount) is injected by a fixed rule on
the key; no row is ever dropped or filtered by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dirt-injection periods (every k-th key) used by the registry.
MISSING_CUSTOMER_EVERY = 97   # l_orderkey % 97 = 0 -> customer_id NULL
NEGATIVE_AMOUNT_EVERY = 89    # l_orderkey % 89 = 0 -> amount negated
NULL_CUSTOMER_NAME_EVERY = 83  # dirty-customer variant: c_custkey % 83 = 0 -> name NULL
NULL_UNIT_COST_EVERY = 71     # dirty-product variant: p_partkey % 71 = 0 -> unit_cost NULL

SALES_SOURCE = "lineitem_orders"
CUSTOMER_SOURCE = "customer_nation_region"
PRODUCT_SOURCE = "part"

# Dedup tie-break for the sales business key (order_id, line_no), ascending.
SALES_TIE_BREAK = ["ship_date", "product_id", "supplier_id", "amount", "quantity",
                   "discount_pct", "tax", "return_flag", "line_status"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(col: str, k: int | None):
    return F.lit(False) if not k else (F.col(col) % k == 0)


def bronze_sales(spark: SparkSession, sf_dir: str,
                 missing_customer_every: int | None = MISSING_CUSTOMER_EVERY,
                 negative_amount_every: int | None = NEGATIVE_AMOUNT_EVERY) -> DataFrame:
    """One row per lineitem row: the bronze order lines, duplicates included."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    joined = li.join(od, li["l_orderkey"] == od["o_orderkey"], "left")  # no line is dropped
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when(_every("l_orderkey", missing_customer_every), F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.when(_every("l_orderkey", negative_amount_every), -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("amount"),
        F.col("o_orderpriority").alias("channel"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.lit(SALES_SOURCE).alias("_source"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str,
                     null_name_every: int | None = None) -> DataFrame:
    """Customers with their nation (country) and region names.

    ``nation`` and ``region`` are fixed-size reference tables (25 and 5 rows
    in every scale factor); Spark's size-checked auto-broadcast picks them up.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
               .join(r, n["n_regionkey"] == r["r_regionkey"], "left"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(_every("c_custkey", null_name_every), F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("name"),
        F.lit(None).cast("string").alias("email"),  # no source column
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country_code"),
        F.lit(None).cast("date").alias("updated_at"),  # no source column
        F.lit(CUSTOMER_SOURCE).alias("_source"),
    )


def bronze_products(spark: SparkSession, sf_dir: str,
                    null_cost_every: int | None = None) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(_every("p_partkey", null_cost_every), F.lit(None).cast("double"))
         .otherwise(F.col("p_retailprice")).alias("unit_cost"),
        F.lit(PRODUCT_SOURCE).alias("_source"),
    )


# The customer history that the tables lack. Every customer is known from the
# first day; every k-th later changed to another segment, on a day that its key decides.
HISTORY_START = "1990-01-01"
CHANGES_START = "1996-01-01"
CHANGED_EVERY = 3
CHANGE_DAYS = 1500
CHANGED_SEGMENT = "MOVED"


def customer_first(customers: DataFrame) -> DataFrame:
    return customers.withColumn("updated_at", F.to_date(F.lit(HISTORY_START)))


def customer_changes(customers: DataFrame) -> DataFrame:
    day = F.date_add(F.to_date(F.lit(CHANGES_START)), F.pmod("customer_id", F.lit(CHANGE_DAYS)).cast("int"))
    return (customers.where(F.col("customer_id") % CHANGED_EVERY == 0)
            .withColumn("segment", F.lit(CHANGED_SEGMENT)).withColumn("updated_at", day))
