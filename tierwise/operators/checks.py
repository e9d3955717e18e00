"""Data-quality checks compiled to one aggregate per table.

A check compares an *actual* metric with an *expected* metric (or a
literal). Metrics are aggregate expressions grouped by the table they scan;
each table is read once, by one ``agg`` holding all of its metrics. The
one-row results are unpivoted to ``(metric, value)`` with ``stack``,
unioned, pivoted back into one row, and expanded into one result row per
check. Results never leave Spark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions.money import cents_text

PASS, FAIL, NO_EXPECTATION = "PASS", "FAIL", "NO EXPECTATION"


@dataclass(frozen=True)
class Check:
    name: str
    actual: str                 # metric key "<table>.<metric>"
    expected: str | int         # metric key or a literal
    kind: str = "count"         # count | money | date (epoch days)
    op: str = "eq"              # eq | le | ge
    details: str = ""           # template: {actual}, {expected}, {<metric key>}


class MetricSet:
    """Aggregate expressions per table; one ``agg`` per table."""

    def __init__(self):
        self._tables: dict[str, tuple[DataFrame, dict[str, Column]]] = {}

    def add(self, table: str, df: DataFrame, **metrics: Column) -> MetricSet:
        frame, exprs = self._tables.get(table, (df, {}))
        exprs = {**exprs, **metrics}
        self._tables[table] = (frame, exprs)
        return self

    def long(self) -> DataFrame:
        parts = []
        for table, (df, exprs) in self._tables.items():
            row = df.agg(*[e.cast("bigint").alias(n) for n, e in exprs.items()])
            pairs = ", ".join(f"'{table}.{n}', `{n}`" for n in exprs)
            parts.append(row.selectExpr(f"stack({len(exprs)}, {pairs}) AS (metric, value)"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def keys(self) -> list[str]:
        return [f"{t}.{n}" for t, (_, exprs) in self._tables.items() for n in exprs]


def _fmt(v: Column, kind: str) -> Column:
    if kind == "money":
        return cents_text(v)
    if kind == "date":
        return F.date_from_unix_date(v.cast("int")).cast("string")
    return v.cast("string")


def _template(text: str, values: dict[str, Column]) -> Column:
    pieces, pos = [], 0
    for m in re.finditer(r"\{([^{}]+)\}", text):
        if m.start() > pos:
            pieces.append(F.lit(text[pos:m.start()]))
        pieces.append(F.coalesce(values[m.group(1)], F.lit("NULL")))
        pos = m.end()
    if pos < len(text):
        pieces.append(F.lit(text[pos:]))
    return F.concat(*pieces) if pieces else F.lit("")


def evaluate(metrics: MetricSet, checks: list[Check], kinds: dict[str, str] | None = None
             ) -> DataFrame:
    """(check, status, expected, actual, details), one row per check."""
    keys = metrics.keys()
    wide = metrics.long().groupBy().pivot("metric", keys).agg(F.first("value"))
    kinds = kinds or {}

    def col(k: str) -> Column:
        return F.col(f"`{k}`")

    rows = []
    for c in checks:
        actual = col(c.actual)
        expected = col(c.expected) if isinstance(c.expected, str) else F.lit(c.expected)
        ok = {"eq": actual.eqNullSafe(expected), "le": actual <= expected, "ge": actual >= expected}[c.op]
        status = F.when(F.coalesce(ok, F.lit(False)), F.lit(PASS)).otherwise(F.lit(FAIL))
        values = {k: _fmt(col(k), kinds.get(k, c.kind)) for k in keys}
        values["actual"] = _fmt(actual, c.kind)
        values["expected"] = _fmt(expected, c.kind)
        rows.append(F.struct(F.lit(c.name).alias("check"), status.alias("status"),
                             values["expected"].alias("expected"),
                             values["actual"].alias("actual"),
                             _template(c.details, values).alias("details")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def summary(results: DataFrame) -> DataFrame:
    """Pass / fail totals (C11)."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no row in ``dim`` (``left_anti``, SURVEY trap 9).

    A NULL key is an orphan as well.
    """
    return facts.join(dim.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present more than once; a NULL key is a value of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
