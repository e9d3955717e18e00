"""Date attributes for the date dimension and the fact's date key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_sk(col: str | Column) -> Column:
    """yyyyMMdd as an integer, computed arithmetically (no string formatting)."""
    d = F.col(col) if isinstance(col, str) else col
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_attributes(col: str = "full_date") -> list[Column]:
    """Columns of one dim_date row, derived from a DATE column.

    ``week_of_year`` is the ISO week while ``year`` is the calendar year, as
    in the reference; never group by (year, week_of_year).
    """
    d = F.col(col)
    day_name = F.date_format(d, "EEEE")
    return [
        date_sk(d).alias("date_sk"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        day_name.alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        # dayofweek: 1 = Sunday, 7 = Saturday (locale-independent).
        F.when(F.dayofweek(d).isin(1, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))
        .alias("day_type"),
    ]
