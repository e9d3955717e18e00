"""Table sinks (S4-S6): full refresh, idempotent append, partitioned write.

Tables are parquet tables registered in the session catalog, stored at a
fixed location inside their database's folder (under
``spark.sql.warehouse.dir``, a shared folder on a cluster). Because the
location is fixed, a later run -- in a new process, even without a
persistent metastore -- finds the previous run's data: ``attach`` registers
a table folder the catalog does not know yet, so key maps stay stable and
quarantine appends stay idempotent across runs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROW_HASH = "_row_hash"


def location(spark: SparkSession, name: str) -> str:
    db, table = name.split(".", 1)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}"


def attach(spark: SparkSession, name: str) -> bool:
    """Register ``name`` over its folder if the catalog lacks it and data
    exists there; returns whether the table exists afterwards."""
    if spark.catalog.tableExists(name):
        return True
    try:
        spark.catalog.createTable(name, path=location(spark, name), source="parquet")
    except AnalysisException:  # no folder, or no data files in it
        return False
    try:
        spark.catalog.recoverPartitions(name)
    except AnalysisException:  # not partitioned
        pass
    return True


def table_exists(spark: SparkSession, name: str) -> bool:
    return attach(spark, name)


def _writer(df: DataFrame, name: str, mode: str):
    return (df.write.mode(mode).format("parquet")
            .option("path", location(df.sparkSession, name)))


def overwrite(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Full refresh. A plan must not read the table it overwrites."""
    w = _writer(df, name, "overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def drop(spark: SparkSession, name: str) -> None:
    """Table and folder, if there are any."""
    from tierwise.sources.snapshots import Store

    spark.sql(f"DROP TABLE IF EXISTS {name}")
    Store(spark).delete(location(spark, name))


def append(df: DataFrame, name: str) -> None:
    _writer(df, name, "append").saveAsTable(name)


def row_hash(cols: list[str]):
    """Content hash of the listed columns (SHA-256 of their JSON form)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def append_new(df: DataFrame, name: str, hash_cols: list[str], only_if_rows: bool = False,
               added: Observation | None = None) -> None:
    """Idempotent append: rows whose content hash is already
    in the table are skipped, so a rerun of the same batch adds nothing.

    ``hash_cols`` must exclude processing-time columns (``_ingest_at``,
    ``_quarantine_at``); add a batch or file id to it when a genuine repeat
    in a later batch must be kept. ``only_if_rows``: an empty batch does not
    create the table. ``added`` observes the number of rows written (``n``). The anti join shuffles on the hash (or is
    broadcast by Spark when the table is small).
    """
    spark = df.sparkSession
    rows = df.withColumn(ROW_HASH, row_hash(hash_cols))
    known = table_exists(spark, name)
    if known:
        rows = rows.join(spark.table(name).select(ROW_HASH), ROW_HASH, "left_anti")
    elif only_if_rows and rows.isEmpty():
        return
    if added is not None:
        rows = rows.observe(added, F.count(F.lit(1)).alias("n"))
    if known:
        append(rows, name)
    else:
        overwrite(rows, name)


def write_partitioned(df: DataFrame, name: str, partition_col: str,
                      max_records_per_file: int = 5_000_000) -> None:
    """Partitioned full refresh (S6): every folder of the table is replaced, also those
    whose partition no longer exists, whatever the session's overwrite mode is.

    ``repartition(partition_col)`` would send a whole day to one task; a rebalance by
    that column deals the rows by day and lets the adaptive plan split a large day over
    tasks and put small ones together. ``maxRecordsPerFile`` bounds file size.
    """
    (_writer(df.hint("rebalance", partition_col), name, "overwrite")
       .option("partitionOverwriteMode", "static")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(partition_col)
       .saveAsTable(name))


def replace_partitions(df: DataFrame, name: str, partition_col: str, values: list,
                       max_records_per_file: int = 5_000_000) -> None:
    """Puts ``df`` in the place of the folders of ``values`` (all its rows are of these); a
    value without rows loses its folder. Folders of other values are not touched.
    Run again after a loss, it ends in the same state."""
    from tierwise.sources.snapshots import Store

    spark, loc = df.sparkSession, location(df.sparkSession, name)
    present = {r[0] for r in df.select(partition_col).distinct().collect()}  # one per folder
    if stray := present - set(values):
        raise ValueError(f"{name}: rows of other folders: {sorted(map(str, stray))[:5]}")
    if present:
        (df.hint("rebalance", partition_col).write.mode("overwrite").format("parquet")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(partition_col).save(loc))
    store = Store(spark)
    for v in set(values) - present:
        folder = f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}"
        if store.exists(f"{loc}/{folder}"):
            store.delete(f"{loc}/{folder}")
        value = "NULL" if v is None else f"'{v}'"
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_col} = {value})")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
