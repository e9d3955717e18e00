"""Exact money arithmetic.

Amounts arrive as doubles. Summing doubles depends on the order of the rows,
so every aggregate works on integer cents. Results are converted once, at
the end, to a DOUBLE (``cents / 100``): an exact integer divided by 100 is
the double nearest the exact decimal value, identical on every engine, and
the reference's measures are doubles too. Rounded ratios are computed with
integer division (round half away from zero) before that conversion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TEXT = "decimal(38,2)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: str | Column) -> Column:
    """Double amount -> bigint cents (rounded to the cent). What no cents can hold (NaN, 1e16 and
    more) is NULL instead of the end of the job; the range rules keep it out of silver."""
    return (_c(col).try_cast("decimal(18,2)") * 100).cast("bigint")


def from_cents(col: str | Column) -> Column:
    """Bigint cents -> DOUBLE currency units (the double nearest the exact value)."""
    return _c(col).cast("double") / F.lit(100.0)


def sum_cents(col: str | Column) -> Column:
    """Sum of a double amount in whole cents, as DECIMAL(30,0): beyond a bigint's range."""
    return F.sum((_c(col).try_cast("decimal(18,2)") * 100).cast("decimal(18,0)")).cast("decimal(30,0)")


def cents_text(col: str | Column) -> Column:
    """Bigint cents -> exact text with two decimals, e.g. ``2381643682.99``."""
    return (_c(col).cast("decimal(38,0)") / F.lit(100)).cast(MONEY_TEXT).cast("string")


def rounded_ratio(num: str, den: str, scale: int) -> Column:
    """round(num / den * scale) as bigint, half away from zero; NULL if den is 0.

    ``num`` and ``den`` are integer SQL expressions (column names). The products are
    decimals of up to 38 digits, so sums of cents may use the whole of a bigint (and
    decimal sums up to 30 digits), and integer division keeps the result exact:
    ``(2*|n|*scale + |d|) div (2*|d|)``, then the sign of n / d is restored.
    """
    n, d = f"CAST({num} AS DECIMAL(30,0))", f"CAST({den} AS DECIMAL(30,0))"
    return F.expr(
        f"CASE WHEN {d} = 0 THEN CAST(NULL AS BIGINT) ELSE "
        f"CAST(sign({n}) * sign({d}) AS BIGINT) * "
        f"((abs({n}) * {2 * scale} + abs({d})) div (abs({d}) * 2)) END")


def avg_cents(sum_cents: str, n: str) -> Column:
    """Average rounded to the cent, as DOUBLE currency units."""
    return from_cents(rounded_ratio(sum_cents, n, 1))


def pct_tenths(part_cents: str, whole_cents: str) -> Column:
    """part / whole * 100 rounded to one decimal, as DOUBLE; NULL if whole is 0."""
    return rounded_ratio(part_cents, whole_cents, 1000).cast("double") / F.lit(10.0)
