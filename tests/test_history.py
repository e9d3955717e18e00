"""Snapshot tables, version tables merged by batches, as-of lookup on hot keys."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tierwise.operators import history as hs
from tierwise.sources.snapshots import Snapshots

DDL = "k string, v string, day date, seq int"
DAY = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, None if d is None else DAY + dt.timedelta(d), s) for k, v, d, s in rows], DDL)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def upserted(old, new):
    return hs.upsert(old, new, ["k"], "day")


# ------------------------------------------------------------------ snapshots

def test_a_snapshot_rewrites_touched_buckets_only(spark, tmp_path):
    t = Snapshots(spark, f"{tmp_path}/t", ["k"], buckets=16)
    with pytest.raises(ValueError, match="no snapshot"):
        t.read()
    first = [(f"k{i}", "a", 0, 0) for i in range(200)] + [(None, "null key", 0, 0)]
    assert t.merge(frame(spark, first), upserted) == 1
    changes = [("k7", "b", 3, 0), ("new", "b", 3, 0), ("k8", "too old", None, 0)]
    assert t.merge(frame(spark, changes), upserted) == 2
    want = {r[0]: r[1] for r in first} | {"k7": "b", "new": "b"}
    assert {r.k: r.v for r in t.read().collect()} == want and t.read().count() == 202
    assert {r.k: r.v for r in t.read(1).collect()} == {r[0]: r[1] for r in first}
    one, two = (t.manifest(n)["folders"] for n in (1, 2))
    changed = {b for b in two if two[b] != one.get(b)}
    touched = {str(r[0]) for r in frame(spark, changes).select(t.bucket()).collect()}
    assert changed == touched and len(two) == 16
    assert t.merge(frame(spark, []), upserted) == 2  # nothing to do, no snapshot


def test_a_run_that_dies_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    t = Snapshots(spark, f"{tmp_path}/t", ["k"], buckets=4)
    t.replace(frame(spark, [("a", "1", 0, 0), ("b", "1", 0, 0)]))

    def dies(*a):
        raise SystemError("lost")

    with monkeypatch.context() as m:
        m.setattr(Snapshots, "_swap", dies)
        with pytest.raises(SystemError):
            t.merge(frame(spark, [("a", "2", 1, 0)]), upserted)
    again = Snapshots(spark, f"{tmp_path}/t", ["k"])  # as another process would
    assert {r.k: r.v for r in again.read().collect()} == {"a": "1", "b": "1"} and again.numbers() == [1]
    assert again.merge(frame(spark, [("a", "2", 1, 0)]), upserted) == 2
    again.vacuum(keep=1)
    assert {r.k: r.v for r in again.read().collect()} == {"a": "2", "b": "1"} and again.numbers() == [2]
    alive = {f.split("/")[1] for f in again.manifest()["folders"].values()}
    assert set(again.store.names(f"{tmp_path}/t/data")) == alive  # the lost run's folders are gone


def test_a_second_writer_fails(spark, tmp_path):
    t = Snapshots(spark, f"{tmp_path}/t", ["k"], buckets=4)
    t.replace(frame(spark, [("a", "1", 0, 0)]))

    def races(old, new):
        Snapshots(spark, f"{tmp_path}/t", ["k"]).merge(frame(spark, [("a", "first", 1, 0)]), upserted)
        return upserted(old, new)

    with pytest.raises(RuntimeError, match="another writer"):
        t.merge(frame(spark, [("a", "second", 2, 0)]), races)
    assert [r.v for r in t.read().collect()] == ["first"]
    with pytest.raises(ValueError, match="bucketed by"):
        Snapshots(spark, f"{tmp_path}/t", ["v"]).read()


# ------------------------------------------------------------------ versions

def test_batches_in_any_order_equal_the_rebuild(spark, tmp_path):
    """Late rows, a second row of a day, a key without a day, keys that one batch names."""
    batches = [[("a", "a0", 0, 1), ("b", "b5", 5, 1), ("c", "always", None, 1), (None, "n", 1, 1)],
               [("a", "a9", 9, 2), ("a", "a4", 4, 2), ("b", "b5 again", 5, 2)],
               [("a", "late", 2, 3), ("b", "before all", -3, 3), ("c", "c1", 1, 3), ("d", "d", 0, 3), ("a", "a0 again", 0, 3)]]
    want = rows_of(hs.scd2(frame(spark, sum(batches, [])), "k", "day", ["seq"], keep_order=True))
    for n, order in enumerate(itertools.permutations(range(3))):
        t = Snapshots(spark, f"{tmp_path}/t{n}", ["k"], buckets=4)
        for i in order:
            batch = frame(spark, batches[i])
            t.merge(batch, lambda old, new: hs.merge_versions(old, new, "k", "day", ["seq"]) if t.numbers()
                    else hs.scd2(new, "k", "day", ["seq"], keep_order=True))
        assert rows_of(t.read()) == want
        t.merge(frame(spark, batches[0]), lambda old, new: hs.merge_versions(old, new, "k", "day", ["seq"]))
        assert rows_of(t.read()) == want  # a batch that comes twice changes nothing


def test_version_keys_stay(spark):
    one = hs.scd2(frame(spark, [("a", "x", 0, 1), ("a", "y", 9, 1)]), "k", "day", ["seq"], keep_order=True)
    two = hs.merge_versions(one, frame(spark, [("a", "late", 4, 2)]), "k", "day", ["seq"])
    before, after = ({r.valid_from: r.version_key for r in df.collect()} for df in (one, two))
    assert before.items() <= after.items() and len(set(after.values())) == 3
    assert [r.version_no for r in two.orderBy("valid_from").collect()] == [1, 2, 3]


# ------------------------------------------------------------------ as of

def test_as_of_equals_brute_force_in_any_slicing(spark):
    r = random.Random(2)
    keys = ["a", "b", "c", "d", None]
    versions = [(r.choice(keys), f"v{i}", r.choice([None, *range(0, 60, 3)]), i) for i in range(60)]
    dim = hs.scd2(frame(spark, versions), "k", "day", ["seq"]).select("k", "v", "valid_from", "valid_to")
    gap = dim.where("v <> 'v7'")  # a hole in the intervals
    facts = [(i, r.choice([*keys, "a", "a", "none"]), None if r.random() < .05 else DAY + dt.timedelta(r.randint(-3, 63))) for i in range(600)]
    df = spark.createDataFrame(facts, "id int, k string, at date")
    held = gap.collect()
    want = []
    for i, k, at in facts:
        hit = [x for x in held if k is not None and x.k == k and (x.valid_from is None or (at is not None and at >= x.valid_from))
               and (x.valid_to is None or (at is not None and at < x.valid_to))]
        assert len(hit) <= 1
        want.append((i, hit[0].v if hit else None))
    for n in (1, 3, 40):
        got = sorted((x.id, x.v) for x in hs.as_of(df, gap, "k", "at", slices=n).collect())
        assert got == want
    assert hs.as_of(df.limit(0), gap, "k", "at").count() == 0
    assert hs.as_of(df, gap.limit(0), "k", "at").where("v IS NOT NULL").count() == 0


def test_a_hot_customer_is_cut_into_time_slices(spark):
    """One customer has a third of all lines, all on few days, and 1,000 versions: no slice holds
    twice the median, and no row of the work is a pair."""
    n = 30_000
    facts = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"),
                                  F.date_add(F.lit(DAY), (F.col("id") % 4 * 250).cast("int")).alias("at"))
    versions = spark.range(1000).select(F.lit(-1).cast("bigint").alias("k"), F.col("id").cast("string").alias("v"),
                                        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("day"), F.lit(0).alias("seq"))
    dim = hs.scd2(versions, "k", "day", ["seq"]).select("k", "v", "valid_from", "valid_to")
    sizes = sorted(r["count"] for r in hs.sliced(facts, dim, "k", "at", slices=20).groupBy("_pid").count().collect())
    assert len(sizes) == 20 and sizes[-1] <= 2 * sizes[10]
    got = hs.as_of(facts, dim, "k", "at", slices=20)
    assert got.count() == n
    assert got.where("k = -1").select("v").distinct().count() == 4
    assert got.where("k = -1 AND v <> cast(datediff(at, DATE '2024-01-01') AS string)").count() == 0
    assert got.where("k <> -1 AND v IS NOT NULL").count() == 0
