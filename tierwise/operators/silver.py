"""Bronze -> silver for one entity, driven by an ``Entity`` config."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions.rules import (
    CUSTOMER_RULES, PRODUCT_RANGE_RULES, PRODUCT_RULES, SALES_RANGE_RULES, SALES_RULES, Rule)
from tierwise.operators.clean import ISSUE, Col, dedup, label, split, standardise
from tierwise.sources.testdata import SALES_TIE_BREAK


@dataclass(frozen=True)
class Entity:
    name: str
    keys: list[str]
    spec: list[Col]
    rules: list[Rule]
    tie_break: list[str] = field(default_factory=list)
    desc: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [c.name for c in self.spec]


def sales_entity(id_type: str = "bigint") -> Entity:
    spec = [Col("order_id", id_type), Col("line_no", "int"), Col("customer_id", id_type),
            Col("product_id", id_type), Col("supplier_id", id_type), Col("order_date", "date"),
            Col("ship_date", "date"), Col("quantity", "int"), Col("unit_price", "double"),
            Col("amount", "double"), Col("channel", "string"), Col("discount_pct", "int"),
            Col("tax", "double"), Col("return_flag", "string"), Col("line_status", "string")]
    return Entity("sales", ["order_id", "line_no"], spec, SALES_RULES + SALES_RANGE_RULES, SALES_TIE_BREAK)


def sample_sales_entity() -> Entity:
    """The reference's landing CSV: one line per order, key ``order_id``."""
    spec = [Col("order_id", "string"), Col("customer_id", "string"), Col("product_id", "string"),
            Col("order_date", "date"), Col("quantity", "int"), Col("unit_price", "double"),
            Col("amount", "double"), Col("channel", "string"), Col("discount_pct", "int")]
    return Entity("sales", ["order_id"], spec, SALES_RULES + SALES_RANGE_RULES,
                  ["order_date", "customer_id", "product_id", "amount", "quantity",
                   "unit_price", "discount_pct", "channel"])


def customer_entity(id_type: str = "bigint") -> Entity:
    spec = [Col("customer_id", id_type), Col("name", "string"), Col("email", "string"),
            Col("region", "string"), Col("segment", "string"),
            Col("country_code", "string", upper=True), Col("updated_at", "date")]
    # Latest record per customer wins.
    return Entity("customers", ["customer_id"], spec, CUSTOMER_RULES,
                  ["updated_at", "name", "email", "region", "segment", "country_code"],
                  ["updated_at"])


def product_entity(id_type: str = "bigint") -> Entity:
    spec = [Col("product_id", id_type), Col("name", "string"), Col("category", "string"),
            Col("brand", "string"), Col("unit_cost", "double")]
    return Entity("products", ["product_id"], spec, PRODUCT_RULES + PRODUCT_RANGE_RULES,
                  ["name", "category", "brand", "unit_cost"])


def labelled(entity: Entity, bronze: DataFrame, drop: list[str] | None = None,
             keep_raw: bool = False) -> DataFrame:
    """Standardised bronze rows with ``data_issue``; nothing is dropped."""
    std = standardise(bronze.drop(*(["_ingest_at"] if drop is None else drop)), entity.spec,
                      flag_invalid=True)
    return label(std, entity.rules, keep_raw=keep_raw)


def label_counts(lab: DataFrame) -> DataFrame:
    """Rows and exact amount total per label (P1/P4 summary)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if "amount" in lab.columns:
        from tierwise.functions.money import cents, from_cents
        aggs.append(from_cents(F.sum(cents("amount"))).alias("amount_total"))
    return lab.groupBy(ISSUE).agg(*aggs)


def deduplicated(entity: Entity, bronze: DataFrame, copies_col: str | None = None) -> DataFrame:
    good, _ = split(labelled(entity, bronze))
    return dedup(good, entity.keys, entity.tie_break, entity.desc, copies_col)


def silver(entity: Entity, bronze: DataFrame) -> DataFrame:
    """Standardised, validated, deduplicated rows in the entity's column order."""
    rows = deduplicated(entity, bronze)
    extra = [c for c in rows.columns if c not in entity.columns]
    return rows.select(*entity.columns, *extra)


def quarantined(entity: Entity, bronze: DataFrame) -> DataFrame:
    _, bad = split(labelled(entity, bronze))
    return bad
