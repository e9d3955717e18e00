"""Event stream into a table that holds every event once (E1).

Files of events arrive, some again (a replay, a producer that sends twice), some late. Each
micro-batch is compared with what the table has of the same time and no more:

- The watermark of a batch is the newest event time of all batches before it, less ``delay``. It
  is kept with the table, so a restarted stream, or a second one over replayed files, goes on from it.
- Rows behind the watermark are not dropped: they go to the late table, as do rows without a key or
  a time. Whether a late row is a repetition is left to whoever reads that table.
- Other rows are reduced to one per key and anti-joined with the table's rows from the watermark
  on. These folders (by day of the event) are the state; ``delay`` bounds them, not the
  length of the stream. Copies of an event carry its time.

A batch writes folders named after stream and batch and overwrites them, the watermark last.
Run again after a loss it gives the same rows, so each event is in the table once, whatever
was lost in between. One writer at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierwise.operators.clean import dedup
from tierwise.sources.snapshots import Store

REASON = "_reason"
DAY = "_event_day"
BATCH = "_batch"


class EventTable:
    """Folders of events, late events and batches under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, at: str, delay: str = "3 days"):
        self.spark, self.path, self.key, self.at, self.delay = spark, path.rstrip("/"), key, at, delay
        self.store = Store(spark)

    def _read(self, part: str) -> DataFrame | None:
        folder = f"{self.path}/{part}"
        if not any(n.startswith(f"{BATCH}=") for n in self.store.names(folder)):
            return None
        schema = T.StructType.fromJson(self._schema(part))
        return self.spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(folder)

    def _schema(self, part: str) -> dict:
        import json
        return json.loads(self.store.read(f"{self.path}/{part}.schema"))

    def _note_schema(self, part: str, rows: DataFrame, by: list[str]) -> None:
        # An empty batch has no file a schema could be read from.
        if not self.store.exists(f"{self.path}/{part}.schema"):
            fields = [f for f in rows.schema if f.name not in by] + [T.StructField(BATCH, T.StringType())] + [
                f for f in rows.schema if f.name in by]
            self.store.write(f"{self.path}/{part}.schema", T.StructType(fields).json())

    def events(self) -> DataFrame:
        """Every event once."""
        rows = self._read("events")
        if rows is None:
            raise ValueError(f"{self.path}: no batch yet")
        return rows.drop(DAY, BATCH)

    def late(self) -> DataFrame:
        """What came behind the watermark, or without key or time, with the reason."""
        rows = self._read("late")
        if rows is None:
            raise ValueError(f"{self.path}: no batch yet")
        return rows.drop(BATCH)

    def watermark(self, but: str | None = None):
        """Newest event time less ``delay``, of all batches but the named one; None before the first."""
        seen = self._read("batches")
        if seen is None:
            return None
        top = seen.where(F.col(BATCH) != F.lit(but or "")).agg(F.max("newest") - F.expr(f"INTERVAL {self.delay}"))
        return top.first()[0]  # one scalar

    def state(self, watermark) -> DataFrame | None:
        """Keys that a batch with this watermark may meet again."""
        rows = self._read("events")
        if rows is None or watermark is None:
            return None if rows is None else rows.select(self.key, BATCH)
        mark = F.lit(watermark)
        return rows.where((F.col(DAY) >= F.to_date(mark)) & (F.col(self.at) >= mark)).select(self.key, BATCH)

    def add(self, batch: DataFrame, name: str) -> None:
        """One batch; adding it again changes nothing."""
        watermark = self.watermark(but=name)
        batch = batch.persist()
        try:
            reason = F.when(F.col(self.key).isNull(), "missing key").when(F.col(self.at).isNull(), "missing time")
            if watermark is not None:
                reason = reason.when(F.col(self.at) < F.lit(watermark), "late")
            rows = batch.withColumn(REASON, reason)
            fresh = dedup(rows.where(F.col(REASON).isNull()).drop(REASON), [self.key], [self.at])
            known = self.state(watermark)
            if known is not None:
                fresh = fresh.join(known.where(F.col(BATCH) != F.lit(name)).select(self.key), self.key, "left_anti")
            fresh = fresh.select(*batch.columns).withColumn(DAY, F.to_date(self.at))
            late = rows.where(F.col(REASON).isNotNull())
            newest = batch.agg(F.max(self.at).alias("newest"))
            for part, out, by in (("events", fresh, [DAY]), ("late", late, []), ("batches", newest, [])):  # the watermark last
                self._note_schema(part, out, by)
                out.write.mode("overwrite").partitionBy(*by).parquet(f"{self.path}/{part}/{BATCH}={name}")
        finally:
            batch.unpersist()


def ingest_events(spark: SparkSession, source: str, schema: T.StructType, table: EventTable, fmt: str = "parquet",
                  stream: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Adds every file under ``source`` that this stream has not seen. The stream's log lies beside
    the table, named after ``stream`` (default: the source); another name reads all files again."""
    tag = stream or hashlib.sha1(source.encode()).hexdigest()[:12]
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(source).writeStream
             .foreachBatch(lambda batch, n: table.add(batch, f"{tag}-{n:08d}"))
             .option("checkpointLocation", f"{table.path}/streams/{tag}")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
