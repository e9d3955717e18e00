r"""Personal data by weak supervision, in DataFrame functions only.

Candidates come from regular expressions. Five labelers vote on each (+1, -1, 0 for no
opinion): the kind's own check (Luhn, number ranges), a gazetteer (top-level domains,
card issuers, country codes), the words before it, its borders, and its shape. How often
each pattern of votes occurs is counted over all documents; expectation-maximisation on
those counts (at most kinds x 3^5 x 4 rows) estimates the labelers' reliabilities, and a
logistic span classifier is trained on the resulting probabilities. Its weights go back
into the plan as literals. Base matches always stay; further candidates are added when
the classifier says so and they touch no base match.

Positions: ``split`` gives the stretches between the matches of a pattern and
``regexp_extract_all`` the matches, so running sums of lengths are code point offsets.
The quantifiers are possessive where that cannot change a match, which keeps Java's
matcher from recursing on very long runs; e-mail candidates start only at the start of a
run or where the last match ended, which keeps it linear.

Defined results: null text = empty text = no spans; repeated rows repeat; with no
candidate at all the classifier adds nothing; an empty table gives an empty one. Output
columns replace input columns of the same name. Whole texts, no shuffle of texts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import cut, text_of

# Fixed values of the contract: kinds in order, their patterns and checks.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
# Candidates beside the base: long hexadecimal secrets, social security numbers, phone
# numbers without a country code.
ALL_KINDS = (*KINDS, "secret", "ssn", "local_phone")
EXTRA = (r"(?<![0-9A-Za-z+.-])(?:[0-9a-fA-F]{32,64}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
         r"|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![0-9A-Za-z]|[.-][0-9])")

# Gazetteers and cue words of the labelers.
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|io|info|de|fr|es|uk|it|nl|eu|us|ca|ch|at)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|35)"
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
PRIVATE = r"^(?:0|127|255|224)\."
CUES = (r"(?i)(?:e-?mail|mail|contact|write|ip|host|server|address|card|visa|credit|phone|tel|call|fax|mobile"
        r"|token|key|secret|password|ssn|social)\W{0,6}(?:no|number|is|to|at)?\W{0,6}$")
COUNTER_CUES = r"(?i)(?:version|release|isbn|invoice|order|section|chapter|page|article)\W{0,6}(?:no|number)?\W{0,6}$"
LABELERS = 5

SPAN = "struct<start: bigint, kind: int, end: bigint, base: boolean, votes: array<int>, size: int>"


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(~yes if no is None else no, -1).otherwise(0)


def checked(kind: Column, m: Column) -> Column:
    """Whether a match passes its kind's check."""
    d = digits(m)
    return (F.when(kind == 0, F.lit(True))
            .when(kind == 1, m.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"))
            .when(kind == 2, F.length(d).between(14, 19) & F.call_function("luhn_check", d))
            .when(kind == 3, F.length(d).between(10, 15))
            .when(kind == 4, m.rlike("[0-9]") & m.rlike("[a-fA-F]"))
            .when(kind == 5, ~m.rlike("^(?:000|666|9)|-00-|-0000$"))
            .otherwise(d.rlike("^[2-9][0-9]{2}[2-9]")))


def votes(kind: Column, m: Column, before: Column, after: Column) -> Column:
    d = digits(m)
    gazetteer = (F.when(kind == 0, vote(m.rlike(DOMAINS))).when(kind == 1, vote(~m.rlike(PRIVATE)))
                 .when(kind == 2, vote(d.rlike(ISSUERS))).when(kind == 3, vote(m.rlike(COUNTRY)))
                 .otherwise(0))
    shape = (F.when(kind == 0, vote(F.length(m) <= 64)).when(kind == 1, vote(F.length(m) <= 15))
             .when(kind == 2, vote(F.length(d).isin(15, 16))).when(kind == 3, vote(F.length(d).between(11, 13)))
             .when(kind == 4, vote(F.length(m).isin(32, 40, 64))).otherwise(0))
    return F.array(
        vote(checked(kind, m)), gazetteer,
        vote(before.rlike(CUES), before.rlike(COUNTER_CUES)),
        vote(~before.rlike("[0-9A-Za-z]$") & ~after.rlike("^[0-9A-Za-z]")), shape)


def spans_of(matches: Column, between: Column, kind) -> Column:
    """Spans of one pattern's matches; ``between``: the text between them, one more than those.
    ``kind``: a number, or a function of the match."""
    kind_of = kind if callable(kind) else lambda m: F.lit(kind)
    ends = F.aggregate(
        F.zip_with(matches, F.slice(between, 1, F.size(matches)), lambda m, p: F.length(m) + F.length(p)),
        F.array(F.lit(0).cast("long")),
        lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    tagged = F.transform(
        F.arrays_zip(matches.alias("m"), F.slice(ends, 2, F.size(matches)).alias("e"),
                     F.transform(F.slice(between, 1, F.size(matches)), lambda p: F.right(p, F.lit(40))).alias("b"),
                     F.transform(F.slice(between, 2, F.size(matches)), lambda p: F.left(p, F.lit(1))).alias("a")),
        lambda z: F.struct(
            (z["e"] - F.length(z["m"])).alias("start"), kind_of(z["m"]).cast("int").alias("kind"), z["e"].alias("end"),
            (checked(kind_of(z["m"]), z["m"]) if not callable(kind) else F.lit(False)).alias("base"),
            votes(kind_of(z["m"]), z["m"], z["b"], z["a"]).alias("votes"),
            F.least(F.floor(F.length(z["m"]) / 12), F.lit(3)).cast("int").alias("size")))
    return F.when(F.size(matches) > 0, tagged).otherwise(F.expr(f"CAST(array() AS array<{SPAN}>)"))


def extra_kind(m: Column) -> Column:
    return F.when(m.rlike("^[0-9a-fA-F]{32}"), 4).when(m.rlike("^[0-9]{3}-[0-9]{2}-"), 5).otherwise(6)


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_spans``: every candidate with its votes, by start and kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    number = text.rlike("[0-9]")
    plans = [("email", EMAIL, text.contains("@"), 0), ("ip", IP, number & text.contains("."), 1),
             ("card", CARD, number, 2), ("phone", PHONE, text.contains("+"), 3), ("extra", EXTRA, number, extra_kind)]
    out, keep = docs, docs.columns
    none = F.expr("CAST(array() AS array<string>)")
    for name, pattern, gate, _ in plans:
        out = out.withColumn(f"_m_{name}", F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    for name, pattern, _, _ in plans:
        out = out.withColumn(f"_p_{name}", F.when(F.size(f"_m_{name}") > 0, F.split(text, pattern, -1)).otherwise(none))
    for name, _, _, kind in plans:
        out = out.withColumn(f"_s_{name}", spans_of(F.col(f"_m_{name}"), F.col(f"_p_{name}"), kind))
    base = F.concat(*[F.filter(f"_s_{n}", lambda s: s["base"]) for n in KINDS])
    rest = F.concat(*[F.filter(f"_s_{n}", lambda s: ~s["base"]) for n in (*KINDS, "extra")])
    out = out.withColumn("_base", base).withColumn("_rest", rest)
    free = F.filter("_rest", lambda s: ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.select(*keep, F.sort_array(F.concat("_base", free)).alias("_spans"))


def pattern_counts(found: DataFrame) -> list:
    """How often each (kind, votes, size) occurs: a bounded table, counted over all spans."""
    # The outer form, as a filter inferred below a plain explode would compute the spans twice.
    spans = found.select(F.explode_outer("_spans").alias("s")).where("s IS NOT NULL")
    return (spans.groupBy("s.kind", "s.votes", "s.size", "s.base").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("kind", "votes", "size", "base").collect())


def reliabilities(v: np.ndarray, kind: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: per labeler and truth the chance of each vote, and each
    pattern's probability of being personal data."""
    p = np.clip(0.5 + 0.2 * v.sum(1), 0.05, 0.95)  # start: the balance of the votes
    table = np.zeros((2, LABELERS, 3))
    for _ in range(rounds):
        prior = np.ones(len(ALL_KINDS)) * 0.5
        for k in range(len(ALL_KINDS)):
            own = kind == k
            prior[k] = (1 + (n * p)[own].sum()) / (2 + n[own].sum())
        for truth, q in ((1, p), (0, 1 - p)):
            for j in range(LABELERS):
                for x in (-1, 0, 1):
                    table[truth, j, x + 1] = 0.5 + (n * q)[v[:, j] == x].sum()
            table[truth] /= table[truth].sum(1, keepdims=True)
        odds = np.log(prior[kind] / (1 - prior[kind]))
        for j in range(LABELERS):
            odds = odds + np.log(table[1, j, v[:, j] + 1] / table[0, j, v[:, j] + 1])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return table, p


def features(v: np.ndarray, kind: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per row: kind, positive and negative votes, size class."""
    return np.concatenate([np.eye(len(ALL_KINDS))[kind], v > 0, v < 0, np.eye(4)[np.clip(size, 0, 3)]], 1).astype(float)


def train(rows: list) -> np.ndarray | None:
    """Logistic weights by Newton steps on the counted patterns."""
    if not rows:
        return None
    v = np.array([r["votes"] for r in rows])
    kind, size, n = (np.array([r[c] for r in rows]) for c in ("kind", "size", "n"))
    _, p = reliabilities(v, kind, n.astype(float))
    x, w = features(v, kind, size), np.zeros(len(ALL_KINDS) + 2 * LABELERS + 4)
    share = n / n.sum()
    for _ in range(25):
        y = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) + 1e-4 * w
        bend = (x * (share * y * (1 - y))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def accepted(s: Column, w: np.ndarray | None) -> Column:
    """Base spans stay; the classifier, as an expression of literals, decides the rest."""
    if w is None:
        return s["base"]
    k, n = len(ALL_KINDS), LABELERS
    total = F.element_at(F.array(*[F.lit(float(x)) for x in w[:k]]), s["kind"] + 1)
    for j in range(n):
        x = F.get(s["votes"], F.lit(j))
        total = total + F.when(x > 0, float(w[k + j])).when(x < 0, float(w[k + n + j])).otherwise(0.0)
    total = total + F.element_at(F.array(*[F.lit(float(x)) for x in w[k + 2 * n:]]), s["size"] + 1)
    # A failed check of one of the base kinds is final.
    return s["base"] | ((total >= math.log(9)) & ((s["kind"] > 3) & (F.get(s["votes"], F.lit(0)) > 0)))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per row: base counts, digest of the base spans and all accepted spans."""
    found = cut(with_candidates(text_of(docs, "doc_id")).select("doc_id", "_spans"))
    w = train(pattern_counts(found))
    base = F.filter("_spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("_spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.filter("_spans", lambda s: accepted(s, w))).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets (overlapping
    spans as one); a null text stays null, ``n_chars`` follows the text if there is one."""
    w = train(pattern_counts(with_candidates(text_of(docs))))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    found = with_candidates(whole).withColumn("_spans", F.filter("_spans", lambda s: accepted(s, w)))
    merged = F.aggregate(
        F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
        F.expr("CAST(array() AS array<struct<start: bigint, end: bigint, kind: int>>)"),
        lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]), F.concat(
            F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                F.element_at(acc, -1)["kind"].alias("kind"))))).otherwise(F.concat(acc, F.array(s))))
    found = found.withColumn("_merged", F.when(F.size("_spans") > 0, merged))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in ALL_KINDS])
    pieces = F.transform("_merged", lambda s, i: F.concat(
        F.substring(F.col("text"), F.coalesce(F.get("_merged", i - 1)["end"], F.lit(0)).cast("int") + 1,
                    (s["start"] - F.coalesce(F.get("_merged", i - 1)["end"], F.lit(0))).cast("int")),
        F.element_at(names, s["kind"] + 1)))
    text = F.when(F.size("_spans") > 0, F.concat(
        F.array_join(pieces, ""),
        F.substring(F.col("text"), F.element_at("_merged", -1)["end"].cast("int") + 1, F.length("text"))),
    ).otherwise(F.col("text"))
    out = found.withColumn("_clean", text)
    return out.select(*[F.col("_clean").alias("text") if c == "text" else
                        (F.when(F.size("_spans") > 0, F.length("_clean")).otherwise(F.col("row")[c])
                         .cast(docs.schema[c].dataType).alias(c)
                         if c == "n_chars" else F.col("row")[c].alias(c)) for c in docs.columns])
