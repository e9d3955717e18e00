"""Helpers shared by the operators: table access, checkpoints, Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# ASCII white space of the word pattern [^\x20\x09-\x0D]+; bytes.split() with no
# argument splits on exactly these six bytes, so words of UTF-8 text are text.encode().split().
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` writes to the folder the cluster names in
    ``spark.checkpoint.dir``; a scratch folder is set only when that is unset (tests)."""
    from tierwise.session import checkpoint_dir

    return checkpoint_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared checkpoint folder, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_by(df: DataFrame, *keys: str) -> DataFrame:
    """``cut`` with the rows dealt and sorted by ``keys``: joins and groupings on them read the checkpoint
    without another exchange. (An adaptive plan does not tell its partitioning to the
    checkpoint, so this one job is planned without it.)"""
    conf = df.sparkSession.conf
    n, adaptive = int(conf.get("spark.sql.shuffle.partitions")), conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df.repartition(n, *keys).sortWithinPartitions(*keys))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def schema_of(ddl: str) -> StructType:
    return _parse_datatype_string(ddl)


def map_batches(df: DataFrame, init: Callable[[], Callable], ddl: str, rows: int = 512) -> DataFrame:
    """``init()`` runs once per task and returns ``step(columns) -> columns``: dicts of
    equally long lists (or numpy arrays). Batches are cut to ``rows`` rows, so a task holds
    that many texts at a time. ``step.end()``, if set, gives the task's last rows."""
    arrow = to_arrow_schema(schema_of(ddl))
    names = df.columns

    def rows_of(out: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = init()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(names)})
                if out is not None and len(next(iter(out.values()))):
                    yield rows_of(out)
        if (out := getattr(step, "end", dict)()) and len(next(iter(out.values()))):
            yield rows_of(out)

    return df.mapInArrow(run, ddl)


def text_of(df: DataFrame, *keep: str) -> DataFrame:
    """The columns an operator reads, with a null text as the empty one."""
    return df.select(*[F.col(c) for c in keep], F.coalesce(F.col("text"), F.lit("")).alias("text"))
