"""Versioned snapshot tables: rows in key buckets, a manifest swapped last (E2, E3).

A table is a folder with ``data/<load>/_bucket=<n>/`` parquet folders and one small JSON
manifest per snapshot, ``manifests/<number>.json``, which names the folder of every bucket.
A change batch rewrites the buckets that its keys fall into and no other; all other
buckets of the new manifest point at the folders they had. The manifest is written under
another name and renamed at the end: a run that dies before leaves folders that no manifest
names, and the last snapshot stays what readers see. A second writer finds the
number taken and fails instead of losing a change. Old snapshots stay readable until ``vacuum``.

Files are listed, renamed and deleted through Hadoop's file system, so any store that
Spark writes to will do. What reaches the driver are folder names, at most one per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


class Store:
    """The few file operations a manifest needs."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.sc = spark._jvm, spark.sparkContext
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def names(self, path: str) -> list[str]:
        p, fs = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """Of a text file, by Hadoop's codec for its name if it is a compressed one."""
        p, fs = self._at(path)
        codec = self.jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self.conf).getCodec(p)
        stream = fs.open(p)
        reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
        try:
            return (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            reader.close()

    def write(self, path: str, text: str) -> None:
        p, fs = self._at(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, path: str, to: str) -> None:
        """Fails if ``to`` exists."""
        jvm = self.jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI.create(self._uri(path)), self.conf)
        none = self.sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to), none)

    def _uri(self, path: str) -> str:
        p, fs = self._at(path)
        return fs.makeQualified(p).toUri().toString()


class Snapshots:
    """A snapshot table at ``path``, bucketed by ``keys``. ``buckets`` is fixed by the first load;
    it bounds what a change of a single key rewrites."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.store = Store(spark)

    # ------------------------------------------------------------------ manifests
    def numbers(self) -> list[int]:
        """Of the snapshots that can be read, ascending."""
        return sorted(int(n[:-5]) for n in self.store.names(f"{self.path}/manifests")
                      if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> dict | None:
        numbers = self.numbers()
        if not numbers:
            return None
        number = numbers[-1] if number is None else number
        if number not in numbers:
            raise ValueError(f"{self.path}: no snapshot {number}, there are {numbers}")
        m = json.loads(self.store.read(f"{self.path}/manifests/{number:010d}.json"))
        if m["keys"] != self.keys:
            raise ValueError(f"{self.path}: bucketed by {m['keys']}, not by {self.keys}")
        self.buckets = m["buckets"]
        return m

    def _swap(self, number: int, schema: T.StructType, folders: dict[str, str]) -> int:
        text = json.dumps({"number": number, "keys": self.keys, "buckets": self.buckets,
                           "schema": schema.jsonValue(), "folders": folders}, sort_keys=True)
        draft = f"{self.path}/manifests/_draft-{uuid.uuid4().hex}"
        self.store.write(draft, text)
        try:
            self.store.rename_new(draft, f"{self.path}/manifests/{number:010d}.json")
        except Exception as e:
            self.store.delete(draft)
            raise RuntimeError(f"{self.path}: snapshot {number} was taken by another writer") from e
        return number

    # ------------------------------------------------------------------ rows
    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _load(self, rows: DataFrame) -> dict[str, str]:
        """Writes rows by bucket; the folder of each bucket that has any."""
        load = f"data/{uuid.uuid4().hex}"
        (rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write
         .partitionBy(BUCKET).parquet(f"{self.path}/{load}"))
        return {n.split("=")[1]: f"{load}/{n}" for n in self.store.names(f"{self.path}/{load}") if n.startswith(f"{BUCKET}=")}

    def _rows(self, m: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, number: int | None = None) -> DataFrame:
        """The last snapshot, or an earlier one."""
        m = self.manifest(number)
        if m is None:
            raise ValueError(f"{self.path}: no snapshot yet")
        return self._rows(m, list(m["folders"].values()))

    def replace(self, rows: DataFrame) -> int:
        """A snapshot of these rows alone. Gives its number."""
        m = self.manifest()
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        return self._swap(m["number"] + 1 if m else 1, schema, self._load(rows))

    def merge(self, changes: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """The next snapshot: ``combine(rows of the touched buckets, changes)`` takes their place.
        It must keep every row's key. Without changes no snapshot is made."""
        m = self.manifest()
        if m is None:
            return self.replace(combine(changes.limit(0), changes))
        touched = sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())  # at most one per bucket
        if not touched:
            return m["number"]
        kept = {b: f for b, f in m["folders"].items() if int(b) not in set(touched)}
        old = self._rows(m, [f for b, f in m["folders"].items() if b not in kept])
        rows = combine(old, changes)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
        if schema != T.StructType.fromJson(m["schema"]) and kept:
            raise ValueError(f"{self.path}: columns changed; load the table anew")
        return self._swap(m["number"] + 1, schema, {**kept, **self._load(rows)})

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the last ``keep`` snapshots and every data folder that none of these
        names. Not to be run beside a writer."""
        numbers = self.numbers()
        alive = {f for n in numbers[-keep:] for f in self.manifest(n)["folders"].values()}
        for n in numbers[:-keep]:
            self.store.delete(f"{self.path}/manifests/{n:010d}.json")
        for load in self.store.names(f"{self.path}/data"):
            folders = [f"data/{load}/{n}" for n in self.store.names(f"{self.path}/data/{load}") if n.startswith(f"{BUCKET}=")]
            dead = [f for f in folders if f not in alive]
            for f in [f"data/{load}"] if len(dead) == len(folders) else dead:
                self.store.delete(f"{self.path}/{f}")
