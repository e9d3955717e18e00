"""Ordered first-match rules compiled to one CASE expression.

A rule is a label and a SQL boolean predicate. The predicate text is handed to
Spark's own expression parser (``F.expr``), so rule lists can live in config.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

OK = "ok"


@dataclass(frozen=True)
class Rule:
    label: str
    predicate: str

    def column(self) -> Column:
        return F.expr(self.predicate)


def first_match(rules: list[Rule], default: str = OK) -> Column:
    """CASE WHEN r1 THEN l1 WHEN r2 THEN l2 ... ELSE default END.

    Order matters: the first matching rule wins, so put combined conditions
    before their parts.
    """
    if not rules:
        return F.lit(default)
    head, *tail = rules
    chain = F.when(head.column(), F.lit(head.label))
    chain = reduce(lambda acc, r: acc.when(r.column(), F.lit(r.label)), tail, chain)
    return chain.otherwise(F.lit(default))


# The labels and their order, as the reference pipeline uses them.
SALES_RULES = [
    Rule("missing customer and negative amount", "customer_id IS NULL AND amount < 0"),
    Rule("missing customer_id", "customer_id IS NULL"),
    Rule("negative amount", "amount < 0"),
]

CUSTOMER_RULES = [
    Rule("missing customer_id", "customer_id IS NULL"),
    Rule("missing name", "name IS NULL"),
    Rule("missing country_code", "country_code IS NULL"),
]

PRODUCT_RULES = [
    Rule("missing product_id", "product_id IS NULL"),
    Rule("missing name", "name IS NULL"),
    Rule("missing category", "category IS NULL"),
    Rule("missing unit_cost", "unit_cost IS NULL"),
]

# Values that money arithmetic cannot hold; NaN is above every limit. A line's amount, and its
# quantity times its unit cost, fit into cents of 18 digits with room for an order's sum.
AMOUNT_LIMIT = 1e13
FACTOR_LIMIT = 1e7
SALES_RANGE_RULES = [
    Rule("amount out of range", f"abs(amount) >= {AMOUNT_LIMIT}"),
    Rule("quantity out of range", f"abs(cast(quantity AS DOUBLE)) >= {FACTOR_LIMIT}"),
]
PRODUCT_RANGE_RULES = [Rule("unit_cost out of range", f"abs(unit_cost) >= {FACTOR_LIMIT}")]

# Opt-in rule the reference lacks: NULL amounts.
STRICT_AMOUNT_RULES = [
    Rule("missing amount", "amount IS NULL"),
]
