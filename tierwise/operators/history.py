"""Customer history (E2, E3): keyed upsert, slowly changing dimension, as-of lookup."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.operators.clean import dedup
from tierwise.session import checkpoint_dir

INTERVAL = ["valid_from", "valid_to", "version_no", "is_current", "version_key"]
INDEX_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], version: str,
           tie_break: list[str] | None = None) -> DataFrame:
    """The next snapshot: per key the row of the latest ``version`` (NULL is the oldest);
    among equals the first by ``tie_break``, then by the other columns. Keys without a
    change keep their row, new keys come in. The old snapshot is read, never overwritten:
    ``sources.snapshots`` writes the result to new folders and swaps."""
    return dedup(current.unionByName(changes), keys, [version, *(tie_break or [])], [version])


def _last_of_day(history: DataFrame, key: str, version: str, order: list[str]) -> DataFrame:
    """Per key and day the last row by ``order``, then by the other columns."""
    if not order:
        raise ValueError("several rows of a key on one day need an order: arrival, file, sequence")
    rest = [c for c in history.columns if c not in (key, version, *order)]
    last = F.max(F.struct(*order, *rest)).alias("_w")
    rows = history.groupBy(F.struct(key, version).alias("_k")).agg(last)
    return rows.select(*[(F.col("_k") if c in (key, version) else F.col("_w"))[c].alias(c) for c in history.columns])


def scd2(history: DataFrame, key: str, version: str, order: list[str], keep_order: bool = False) -> DataFrame:
    """One row per key and version: ``valid_from`` is its day, ``valid_to`` the day of the
    next version (excluded; NULL for the current one), ``version_no`` counts from 1. Of
    several rows of a key on one day the last by ``order`` holds (the others would be
    valid for no day); a NULL day is valid from the start of time. ``version_key`` is made of
    the key and the day alone, so it stays when versions before or after it come in.
    A key has at most one version a day: that bounds its window."""
    days = _last_of_day(history, key, version, order)
    by_day = Window.partitionBy(key).orderBy(F.col(version).asc_nulls_first())
    name = F.concat_ws("|", F.col(key).isNull(), F.coalesce(F.col(key).cast("string"), F.lit("")),
                       F.coalesce(F.col(version).cast("string"), F.lit("-")))
    rows = (days.withColumn("valid_from", F.col(version))
            .withColumn("valid_to", F.lead(version).over(by_day))
            .withColumn("version_no", F.row_number().over(by_day))
            .withColumn("is_current", F.col("valid_to").isNull())
            .withColumn("version_key", F.md5(name.cast("binary"))))
    return rows.drop(version, *([] if keep_order else order))


def merge_versions(versions: DataFrame, batch: DataFrame, key: str, version: str, order: list[str]) -> DataFrame:
    """``versions`` (from ``scd2`` with ``keep_order``) with the rows of ``batch`` in it: the open
    version of a key is closed where a newer one begins, a late row splits the interval it falls
    into, a row of a day that is known takes its place if it comes later by ``order``.
    Batches in any order give what ``scd2`` gives of all rows. Keys that the batch does
    not name keep their rows as they are."""
    named = batch.select(F.col(key).alias("_k")).distinct()
    same = versions[key].eqNullSafe(named["_k"])
    events = (versions.join(named, same, "left_semi").withColumn(version, F.col("valid_from"))
              .select(*batch.columns).unionByName(batch))
    rest = versions.join(named, same, "left_anti")
    return scd2(events, key, version, order, keep_order=True).select(*versions.columns).unionByName(rest)


def sliced(facts: DataFrame, dim: DataFrame, key: str, day: str, slices: int | None = None) -> DataFrame:
    """Facts and versions in one order by key and time, versions first, dealt by ranges of it and
    written: a key with many facts is cut into time slices, a single day of it too."""
    spark = facts.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [c for c in dim.columns if c != key]
    f = facts.select(F.col(key).alias("_key"), F.col(day).alias("_day"), F.lit(1).alias("_kind"),
                     F.xxhash64(*facts.columns).alias("_salt"), F.struct(*facts.columns).alias("_fact"))
    v = dim.select(F.col(key).alias("_key"), F.col("valid_from").alias("_day"), F.lit(0).alias("_kind"),
                   F.lit(0).cast("bigint").alias("_salt"), F.struct(*cols).alias("_ver"))
    order = [F.col(c).asc_nulls_first() for c in ("_key", "_day", "_kind", "_salt")]
    rows = (f.unionByName(v, allowMissingColumns=True).repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_pid", F.shiftright(F.monotonically_increasing_id(), INDEX_BITS)))
    checkpoint_dir(spark)
    return rows.checkpoint(eager=True)  # what is read twice below must have one set of ranges


def _carried(rows: DataFrame) -> DataFrame:
    """Per slice that begins within a key, the key's last version in the slices before: at most one
    row each. (``_pid``, ``_key``, ``_carry``)"""
    heads = rows.groupBy("_pid").agg(F.min(F.struct("_key"))["_key"].alias("_key")).where("_key IS NOT NULL")
    keys = heads.select("_key").distinct()
    tails = (rows.where("_kind = 0").join(F.broadcast(keys), "_key").groupBy("_pid", "_key")
             .agg(F.max_by("_ver", F.struct("_day")).alias("_ver")))
    both = heads.withColumn("_ver", F.lit(None).cast(rows.schema["_ver"].dataType)).withColumn("_at", F.lit(0)).unionByName(
        tails.withColumn("_at", F.lit(1)))
    before = Window.partitionBy("_key").orderBy("_pid", "_at").rowsBetween(Window.unboundedPreceding, -1)
    return (both.withColumn("_carry", F.last("_ver", ignorenulls=True).over(before))
            .where("_at = 0 AND _carry IS NOT NULL").select("_pid", "_key", "_carry"))


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gives every fact of a sorted slice the last version of its key before it."""
    held = None  # the last version row
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        is_version = np.asarray(rows["_kind"].to_numpy()) == 0
        at = np.maximum.accumulate(np.where(is_version, np.arange(len(is_version)), -1))
        some = pa.array(np.where(at < 0, 0, at), mask=at < 0)
        found = pc.fill_null(pc.equal(rows["_key"].take(some), rows["_key"]), False)
        take = pc.if_else(found, some, pa.scalar(None, some.type))
        if at[-1] >= 0:
            held = rows.slice(int(at[-1]), 1).combine_chunks().to_batches()[0]
        out = rows.set_column(rows.schema.get_field_index("_ver"), rows.schema.field("_ver"), rows["_ver"].take(take))
        yield from out.filter(pa.array(~is_version)).to_batches()


def as_of(facts: DataFrame, dim: DataFrame, key: str, day: str, slices: int | None = None) -> DataFrame:
    """``facts`` with the columns of the dimension row valid on their day; facts without
    one are kept, with NULLs. One sorted pass over facts and versions together, which carries
    the last version along; what a slice needs of the slices before comes with at most
    one row per slice. The work is facts plus versions, also for a key that holds most of both."""
    rows = sliced(facts, dim, key, day, slices)
    carried = _carried(rows).select(F.col("_pid").alias("_p"), F.col("_key").alias("_k"), "_carry")
    filled = rows.mapInArrow(_fill, rows.schema)
    cols = [c for c in dim.columns if c != key]
    joined = filled.join(F.broadcast(carried), (F.col("_pid") == F.col("_p")) & (F.col("_key") == F.col("_k")), "left")
    joined = joined.withColumn("_v", F.coalesce("_ver", "_carry"))
    valid = F.col("_key").isNotNull() & (F.col("_v.valid_to").isNull() | (F.col("_day") < F.col("_v.valid_to")))
    return joined.select("_fact.*", *[F.when(valid, F.col("_v")[c]).alias(c) for c in cols])
