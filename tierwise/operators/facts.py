"""Gold fact: silver order lines keyed to the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.dates import date_sk
from tierwise.operators.dims import GROUP
from tierwise.operators.skew import left_join

FACT_COLS = ["order_id", "line_no", "customer_sk", "product_sk", "channel_sk", "date_sk",
             "customer_id", "product_id", "channel", "order_date", "quantity", "unit_price",
             "amount", "discount_pct", "gross_profit"]


def fact_sales(silver_sales: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               dim_channel: DataFrame, extra_cols: list[str] | None = None, heavy: bool = False) -> DataFrame:
    """LEFT joins on the natural keys keep every order line (orphans get NULL
    keys and a NULL ``gross_profit``). Join strategy is left to Spark: the
    channel dimension is tiny and is broadcast by size; customer and product
    dimensions grow with the data and are shuffle-joined when large. ``heavy``: lines of
    customers and products that hold many are dealt over many tasks (the lines are
    read twice more, one column each, so they should be a table). Group keys of the
    dimensions (``dims.with_group``) come with the lookup.

    The reference also left-joins the date dimension on ``date_sk``; that join
    adds no column and cannot change the row count (the date dimension is
    unique on ``date_sk``), so it is not issued.
    """
    wide, group_cols = silver_sales, []
    for key, cols, dim in (("customer_id", ["customer_sk"], dim_customer),
                           ("product_id", ["product_sk", "unit_cost"], dim_product)):
        of_group = [c for c in dim.columns if c.endswith(GROUP)]
        group_cols += of_group
        dim = dim.select(key, *cols, *of_group)
        wide = left_join(wide, dim, key, counted=silver_sales) if heavy else wide.join(dim, key, "left")
    wide = wide.join(dim_channel.select("channel", "channel_sk"), "channel", "left")
    gross_profit = (F.col("amount") - F.col("quantity") * F.col("unit_cost")).alias("gross_profit")
    made = {"gross_profit": gross_profit, "date_sk": date_sk("order_date").alias("date_sk")}
    cols = [made.get(c, F.col(c)) for c in FACT_COLS if c in made or c in wide.columns]
    cols += [F.col(c) for c in (*group_cols, *(extra_cols or []))]
    return wide.select(*cols)
