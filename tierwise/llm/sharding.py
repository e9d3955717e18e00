"""Sharding by proportional stratified interleaving.

Rows of a source (the stratum) are put in a seeded-random order and ranked; the row of rank r of
n stands at the fraction (r + u) / n, where u, from 0 to 1, is the source's own phase: without
it all sources of a size would meet in the same places, and all sources of one row in the
middle. All rows sorted by that fraction are the sources laid into each other evenly, so
any stretch of them holds every source in proportion; they are cut into shards of equal
counts (the law ``rows``: at most one row apart).

Ranks come from range partitions, never from a window over a source: rows are dealt by ranges of
(source, shuffle hash), which also cuts a source that holds a third of all rows into many, and
a rank is the position in the partition plus what the source has in the partitions before.
Only counts per partition and source are put together, one row each. The second
order, by fraction, is positioned the same way. Both orders are written to the
checkpoint folder, so a lost executor cannot sample other ranges.

Only the columns of the assignment travel; ``write_shards`` joins the other columns to it by row
number once.

Defined results: a null source is a stratum of its own; null texts have no bytes (size 8, crc32 0);
rows with null or repeated doc_ids and repeated rows are rows like others, and rows equal in
doc_id, size and checksum may stand for each other; equal texts are not kept together, as a text
with a third of all copies would break the law; with fewer rows than shards the later shards may be empty;
an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import cut

SHARDS = 24
SEED = 42
OVERHEAD = 8        # bytes a row takes besides its text
INDEX_BITS = 33     # of monotonically_increasing_id: partition << 33 | row
FIRST = ["_source", "_h", "doc_id", "size", "text_crc32"]
SECOND = ["_at", "_source", "_rank"]


def ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows in global order, written: ``_pid`` the partition, ``_ix`` the row in it."""
    keys: list[Column] = [F.col(c).asc_nulls_first() for c in order]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    return cut(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
               .withColumns({"_pid": F.shiftright(at, INDEX_BITS), "_ix": at.bitwiseAND((1 << INDEX_BITS) - 1)}))


def ranked(rows: DataFrame) -> DataFrame:
    """Adds ``_rank`` within ``_source``, from 0, and the source's rows ``_n``."""
    rows = ranged(rows, FIRST)
    # One row per partition and source in it.
    parts = rows.groupBy("_source", "_pid").agg(F.count(F.lit(1)).alias("_own"), F.min("_ix").alias("_first"))
    of = Window.partitionBy("_source")
    before = of.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_source").alias("_s"), F.col("_pid").alias("_p"), F.sum("_own").over(of).alias("_n"),
                         (F.coalesce(F.sum("_own").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (rows.join(parts, (F.col("_pid") == F.col("_p")) & F.col("_source").eqNullSafe(F.col("_s")))
            .withColumn("_rank", F.col("_ix") + F.col("_shift")).drop("_s", "_p", "_shift", "_pid", "_ix"))


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row doc_id, size, text_crc32, law, shard and slot, and the columns ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    # The seeded shuffle: a digest of what the row is.
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), crc.cast("string")).cast("binary"))
    rows = docs.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], "doc_id",
                       (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
                       crc.alias("text_crc32"), F.col("source").alias("_source"), h.alias("_h"))
    phase = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("_source", F.lit("-"))).cast("binary"))
    u = (F.conv(F.substring(phase, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = ranked(rows).withColumn("_at", (F.col("_rank").cast("double") + u) / F.col("_n").cast("double"))
    rows = ranged(rows.drop("_h", "_n"), SECOND)
    counts = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_own"))
    # One row per range partition: the running sum runs over that many rows at most.
    offsets = counts.select(F.col("_pid").alias("_p"), F.sum("_own").over(Window.partitionBy()).alias("_all"),
                            (F.sum("_own").over(Window.orderBy("_pid")) - F.col("_own")).alias("_before"))
    return (rows.join(F.broadcast(offsets), F.col("_pid") == F.col("_p"))
            .withColumn("_pos", F.col("_before") + F.col("_ix"))
            .withColumn("_shard", F.expr(f"({shards} * _pos) div _all"))
            .select(*[F.col(f"_keep_{c}").alias(c) for c in keep], "doc_id", "size", "text_crc32",
                    F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                    # A shard begins at its share of all rows, rounded up.
                    F.expr(f"_pos - (_shard * _all + {shards - 1}) div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes every shard to its folder ``shard=<n>`` under ``path``, rows by slot, with all columns of
    ``docs`` (those named shard or slot, in any case, as doc_shard and doc_slot)."""
    taken = {c: f"doc_{c}" for c in docs.columns if c.lower() in ("shard", "slot")}
    base = cut(docs.withColumn("_row", F.monotonically_increasing_id()))
    placed = assign(base, shards, seed, keep=("_row",)).select("_row", "shard", "slot")
    rows = base.select(*[F.col(c).alias(taken.get(c, c)) for c in base.columns]).join(placed, "_row").drop("_row")
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("shard").parquet(path))
