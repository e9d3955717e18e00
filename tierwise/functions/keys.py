"""Dense, deterministic surrogate keys without a single-task window.

``row_number() OVER (ORDER BY key)`` moves every row into one task. Here the
keys are range-partitioned and sorted inside each partition, so each row's
rank is (rows in earlier partitions) + (position inside its partition) + 1.
Only the per-partition row counts -- one row per partition, a bound fixed by
the partition count -- are combined in a running sum and broadcast back.

Both branches (the counts and the positions) read the same range exchange:
the map is built from the key columns only, so the two exchanges are
identical and Spark reuses one (``ReusedExchange``). When the map is written
as a table (``plans.pipeline``), it is checkpointed first so a recompute can
never re-sample the range bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.session import checkpoint_dir

_INDEX_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def _order(keys: list[str]) -> list[Column]:
    return [F.col(k).asc_nulls_first() for k in keys]


def dense_key_map(df: DataFrame, keys: list[str], sk: str, offset: int | Column = 0,
                  num_partitions: int | None = None) -> DataFrame:
    """(keys..., sk) with sk = offset + rank of the key, ascending, NULLS FIRST.

    ``df`` may hold a key many times; the map holds each distinct key once.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct_keys = df.select(*keys).distinct()
    ranged = (distinct_keys
              .repartitionByRange(n, *_order(keys))
              .sortWithinPartitions(*_order(keys))
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_mid", _INDEX_BITS))
              .withColumn("_ix", F.col("_mid").bitwiseAND((1 << _INDEX_BITS) - 1)))
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        # Without exchange reuse the two branches below would each sample
        # range bounds; cut the ranged keys once so both read the same rows.
        checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range partition: the running sum runs over at most n rows.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    base = offset if isinstance(offset, Column) else F.lit(offset)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(*keys, (base + F.col("_off") + F.col("_ix") + 1).cast("bigint").alias(sk)))


def with_dense_key(df: DataFrame, keys: list[str], sk: str,
                   num_partitions: int | None = None) -> DataFrame:
    """Prepend ``sk`` to ``df`` (unique on ``keys``); NULL keys get a key too.

    For a single-column key the join back is a plain equi-join on the key,
    so ``df`` keeps the hash partitioning it already has on that key (for a
    deduplicated dimension: no extra shuffle of the wide rows). A NULL key
    sorts first and therefore always holds rank 1.
    """
    renamed = {k: f"_key_{k}" for k in keys}
    key_map = dense_key_map(df, keys, sk, num_partitions=num_partitions)
    key_map = key_map.select(*[F.col(k).alias(renamed[k]) for k in keys], sk)
    if len(keys) == 1:
        (k,) = keys
        joined = df.join(key_map, F.col(k) == F.col(renamed[k]), "left")
        sk_col = F.when(F.col(k).isNull(), F.lit(1).cast("bigint")).otherwise(F.col(sk))
        return joined.select(sk_col.alias(sk), *df.columns)
    cond = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
    return df.join(key_map, cond, "inner").select(sk, *df.columns)
