"""Left join that deals a heavy key's rows over many tasks, without session settings (J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(rows: DataFrame, key: str, partitions: int, most: int = 1000) -> DataFrame:
    """Keys with more rows than half a partition's share, and over how many ``parts`` to deal them. From
    a frequent-items sketch, merged over tasks, of at most ``most`` keys: that bounds the result. Its
    counts are estimates; a key listed in vain costs some copies of its dimension row."""
    found = rows.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("_all"), F.expr(f"approx_top_k(`{key}`, {most}, {8 * most})").alias("_top"))
    parts = F.ceil(F.col("_t.count") * (2 * partitions) / F.col("_all")).cast("int")
    return (found.select("_all", F.explode("_top").alias("_t")).withColumn("_parts", parts)
            .where("_parts > 1").select(F.col("_t.item").alias("_hot"), "_parts"))


def left_join(rows: DataFrame, dim: DataFrame, key: str, partitions: int | None = None,
              counted: DataFrame | None = None) -> DataFrame:
    """``rows`` LEFT JOIN ``dim`` (unique on ``key``). Rows of a heavy key get a part number by their content,
    its dimension row a copy per part, so the join's shuffle deals them apart; NULL keys, which
    match nothing, are dealt over all. Columns and rows are those of the plain join.
    ``counted``: rows to find the heavy keys in, if ``rows`` are costly to read twice."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(rows if counted is None else counted, key, n))
    parts = F.when(F.col(key).isNull(), n).otherwise(F.coalesce("_parts", F.lit(1)))
    left = (rows.join(heavy, F.col(key) == F.col("_hot"), "left")
            .withColumn("_part", F.pmod(F.xxhash64(*rows.columns), parts).cast("int")).drop("_hot", "_parts"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    right = dim.join(heavy, F.col(key) == F.col("_hot"), "left").select(*dim.columns, copies.alias("_part"))
    return left.join(right, [key, "_part"], "left").drop("_part")
