"""Event stream: each event once, late rows kept, state bounded."""

import datetime as dt
import os
import subprocess
import sys

from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from tierwise.streaming.events import EventTable, ingest_events

DDL = "event_id bigint, ts timestamp, value string"
T0 = dt.datetime(2024, 1, 1)


def put(spark, folder, name, rows):
    """A landing file; ``rows``: (id, hours after T0, value)."""
    df = spark.createDataFrame([(i, None if h is None else T0 + dt.timedelta(hours=h), v) for i, h, v in rows], DDL)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_each_event_once_and_late_rows_kept(spark, tmp_path):
    t = EventTable(spark, f"{tmp_path}/t", "event_id", "ts", delay="24 hours")
    src = f"{tmp_path}/landing/*"
    schema = spark.createDataFrame([], DDL).schema
    put(spark, f"{tmp_path}/landing", "a", [(1, 0, "a"), (2, 1, "b"), (1, 0, "a"), (None, 3, "no key"), (3, None, "no time")])
    ingest_events(spark, src, schema, t)
    assert sorted(r.event_id for r in t.events().collect()) == [1, 2]
    assert sorted((r["_reason"], r.value) for r in t.late().collect()) == [("missing key", "no key"), ("missing time", "no time")]
    put(spark, f"{tmp_path}/landing", "b", [(2, 1, "b"), (4, 100, "d"), (5, -21, "in time")])
    ingest_events(spark, src, schema, t)
    assert sorted(r.event_id for r in t.events().collect()) == [1, 2, 4, 5]
    # The watermark is at hour 76 now: a replay of old events is late, one of new events is known.
    put(spark, f"{tmp_path}/landing", "c", [(1, 0, "a"), (4, 100, "d"), (6, 76, "just in time"), (7, 75, "too late")])
    ingest_events(spark, src, schema, t)
    assert sorted(r.event_id for r in t.events().collect()) == [1, 2, 4, 5, 6]
    assert sorted(r.value for r in t.late().where("_reason = 'late'").collect()) == ["a", "too late"]
    assert {r.event_id for r in t.state(t.watermark()).collect()} == {4, 6}  # bounded by the delay
    ingest_events(spark, src, schema, t)  # nothing new
    assert t.events().count() == 5


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path, monkeypatch):
    t = EventTable(spark, f"{tmp_path}/t", "event_id", "ts", delay="24 hours")
    rows = spark.createDataFrame([(1, T0, "a"), (2, T0 + dt.timedelta(days=9), "b")], DDL)
    t.add(rows, "s-0")
    mark = t.watermark()
    again = spark.createDataFrame([(1, T0 + dt.timedelta(days=9), "x"), (9, T0 + dt.timedelta(days=10), "y")], DDL)
    note = EventTable._note_schema

    def dies(self, part, *a):
        note(self, part, *a)
        if part == "batches":
            raise SystemError("lost before the watermark was written")

    with monkeypatch.context() as m:
        m.setattr(EventTable, "_note_schema", dies)
        try:
            t.add(again, "s-1")
        except SystemError:
            pass
    assert t.watermark() == mark
    for _ in range(2):
        t.add(again, "s-1")
        assert sorted((r.event_id, r.value) for r in t.events().collect()) == [(1, "a"), (1, "x"), (2, "b"), (9, "y")]
    t.add(again.limit(0), "s-2")  # an empty batch
    assert t.events().count() == 4 and t.watermark() == T0 + dt.timedelta(days=9)


RUN = """
import sys
sys.path.insert(0, {repo!r})
from tierwise.session import get_session
from tierwise.streaming.events import EventTable, ingest_events
spark = get_session("local[2]", 2)
events = spark.read.parquet({events!r})
t = EventTable(spark, {table!r}, "event_id", "ts", delay="2 days")
ingest_events(spark, {landing!r}, events.schema, t, max_files_per_trigger=2)
print("ROWS", t.events().count(), t.events().select("event_id").distinct().count(), t.late().count())
"""


def test_events_replayed_over_two_processes(spark, tmp_path):
    """The driver's events, then all of them again in another process: each is there once."""
    events = spark.read.parquet(f"{SMOKE_DIR}/events.parquet")
    n = events.select("event_id").distinct().count()
    landing = f"{tmp_path}/landing"
    events.repartitionByRange(3, "ts").write.parquet(f"{landing}/first")
    t = EventTable(spark, f"{tmp_path}/t", "event_id", "ts", delay="2 days")
    ingest_events(spark, f"{landing}/*", events.schema, t, max_files_per_trigger=10)
    assert t.events().count() == n and t.late().count() == 0
    events.write.parquet(f"{landing}/again")
    code = RUN.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), events=f"{SMOKE_DIR}/events.parquet",
                      table=f"{tmp_path}/t", landing=f"{landing}/*")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    late = events.where(F.col("ts") < F.lit(t.watermark())).count()
    assert f"ROWS {n} {n} {late}" in out.stdout.splitlines(), out.stderr[-2000:]
    assert t.events().exceptAll(events).count() == 0
