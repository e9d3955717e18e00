"""Silver-layer cleaning: standardise, label, split, deduplicate.

Order of work (SURVEY trap 3): standardise first, then label, then dedup, so
``"  "`` is a missing value and ``"A1 "`` and ``"A1"`` are one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions.rules import OK, Rule, first_match

ISSUE = "data_issue"
RAW_PREFIX = "_raw_"
CORRUPT = "_corrupt_record"  # the whole line of a malformed landing record
INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Col:
    """Target of one column: SQL type (None keeps the type) and text handling."""

    name: str
    type: str | None = None
    upper: bool = False


def _clean_text(c: Column, upper: bool) -> Column:
    t = F.trim(c)
    if upper:
        t = F.upper(t)
    return F.nullif(t, F.lit(""))


def standardise(df: DataFrame, spec: list[Col], flag_invalid: bool = False) -> DataFrame:
    """One projection: trim text (blank -> NULL), upper-case where asked,
    ``try_cast`` to the target type. Columns not in ``spec`` pass through.

    With ``flag_invalid`` each text column cast to a non-text type keeps its
    raw value in ``_raw_<name>`` so ``invalid_rules`` can label values that
    were present before the cast and NULL after it (instead of failing the
    job as ``cast`` does under ANSI mode).
    """
    by_name = {c.name: c for c in spec}
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out, raws = [], []
    for name in df.columns:
        c = by_name.get(name)
        if c is None:
            out.append(F.col(name))
            continue
        src_is_text = isinstance(types[name], T.StringType)
        target = c.type
        col = F.col(name)
        if src_is_text:
            col = _clean_text(col, c.upper)
        if target and target != "string" and (src_is_text
                                               or types[name].simpleString() != target):
            if src_is_text and flag_invalid:
                raws.append(F.col(name).alias(RAW_PREFIX + name))
            if src_is_text and target in INTEGER_TYPES:
                # "2.0" is a whole number; only a fractional rest is invalid.
                number = col.try_cast("decimal(38,10)")
                col = F.when(number == F.floor(number), number.try_cast(target))
            else:
                col = col.try_cast(target)
        elif target == "string" and not src_is_text:
            col = _clean_text(col.cast("string"), c.upper)
        out.append(col.alias(name))
    return df.select(*out, *raws)


def invalid_rules(df: DataFrame) -> list[Rule]:
    """Rules for malformed records and values that did not survive ``standardise``'s cast."""
    corrupt = [Rule("malformed record", f"`{CORRUPT}` IS NOT NULL")] if CORRUPT in df.columns else []
    return corrupt + [Rule(f"invalid {c[len(RAW_PREFIX):]}",
                 f"`{c}` IS NOT NULL AND trim(`{c}`) <> '' AND `{c[len(RAW_PREFIX):]}` IS NULL")
            for c in df.columns if c.startswith(RAW_PREFIX)]


def arrival_columns(df: DataFrame) -> list[str]:
    """Columns that hold what arrived: raw values and the malformed record."""
    return [c for c in df.columns if c.startswith(RAW_PREFIX) or c == CORRUPT]


def label(df: DataFrame, rules: list[Rule], issue_col: str = ISSUE,
          with_invalid: bool = True, keep_raw: bool = False) -> DataFrame:
    """Add the first-match issue label. A record that could not be read at all is that and
    nothing else; then the entity's rules come, in the reference's order, then values that
    could not be cast. ``keep_raw`` keeps the values as they arrived (for quarantine)."""
    unread = invalid_rules(df) if with_invalid else []
    n = int(bool(unread) and CORRUPT in df.columns)
    all_rules = unread[:n] + list(rules) + unread[n:]
    labelled = df.withColumn(issue_col, first_match(all_rules))
    return labelled if keep_raw else labelled.drop(*arrival_columns(df))


def split(labelled: DataFrame, issue_col: str = ISSUE) -> tuple[DataFrame, DataFrame]:
    """(good, bad) as two filters over one labelled plan; good drops the label and
    the values as they arrived, bad keeps both."""
    good = labelled.filter(F.col(issue_col) == OK).drop(issue_col, *arrival_columns(labelled))
    bad = labelled.filter(F.col(issue_col) != OK)
    return good, bad


def _sort_fields(df: DataFrame, tie_break: list[str], desc: set[str]) -> list[Column]:
    """Ascending columns stand for themselves, so the row need not hold them again."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fields = []
    for i, c in enumerate(tie_break):
        if c not in desc:
            fields.append(F.col(c))
            continue
        t = types[c]
        if isinstance(t, T.DateType):
            neg = -F.unix_date(F.col(c))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            neg = -F.unix_micros(F.col(c).cast("timestamp"))
        elif isinstance(t, T.NumericType):
            neg = -F.col(c)
        else:
            raise ValueError(f"descending tie-break needs a numeric or date column: {c}")
        # DESC NULLS LAST == (is null) ASC, (negated value) ASC
        fields += [F.col(c).isNull().alias(f"_o{i}n"), neg.alias(f"_o{i}")]
    return fields


def dedup(df: DataFrame, keys: list[str], tie_break: list[str] | None = None,
          desc: list[str] | None = None, copies_col: str | None = None) -> DataFrame:
    """Keep one row per key: the first by ``tie_break`` (ASC NULLS FIRST,
    or DESC NULLS LAST for columns in ``desc``), then by every other column.

    Written as ``groupBy(struct(keys)).agg(min(struct(order..., row...)))``. Rows
    that arrive hash-partitioned on part of the key (bronze, joined on ``order_id``)
    would otherwise be aggregated where they are, a hot order in one task; the struct
    is a key of its own, so the aggregate is combined in place, then dealt by the whole
    key, and the adaptive plan is free to split the join in front of it. No session
    setting is needed for that. The survivor is fully determined (SURVEY trap 1);
    ``NULL`` keys form their own group.
    """
    tie_break = [c for c in dict.fromkeys(tie_break or []) if c not in keys]  # a key is one value in its group
    desc = set(desc or [])
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(*_sort_fields(df, tie_break, desc),
                      *[F.col(c) for c in payload if c in desc or c not in tie_break])
    aggs = [F.min(packed).alias("_w")]
    if copies_col:
        aggs.append(F.count(F.lit(1)).alias(copies_col))
    grouped = df.groupBy(F.struct(*keys).alias("_k")).agg(*aggs)
    cols = [F.col("_k")[k].alias(k) for k in keys] + [F.col("_w")[c].alias(c) for c in payload]
    if copies_col:
        cols.append(F.col(copies_col))
    return grouped.select(*cols)


def stamp(df: DataFrame, col: str) -> DataFrame:
    """Processing-time stamp (``_silver_at``, ``_quarantine_at``)."""
    return df.withColumn(col, F.current_timestamp())
