"""SimHash near-duplicates by the generalised pigeonhole principle.

A 64-bit fingerprint has a bit set where it is set in over half of the XXH64 hashes of
the text's word shingles. Documents link when their fingerprints differ in at most
``max_bits`` bits. The 64 bits are dealt into partitions, correlated bits together;
partition i gets a threshold t_i (-1: not used) with sum(t_i + 1) = max_bits + 1, so any
linked pair is within t_i bits in some partition. Number of partitions and thresholds
come from dynamic programming on estimated candidate counts, from bit statistics over
all fingerprints. A fingerprint probes every partition with all keys within t_i of its
own, and a candidate pair is verified in the join itself, in the first partition that
finds it: the join gives each link once and nothing else.

Links join distinct fingerprints only, so a group of exact copies is one node, and no
group's pairs are written out unless they are links between different fingerprints.

Defined results: a null text counts as empty, fingerprint zero, linked like any other;
fewer words than a shingle: the whole sequence is the one shingle; repeated rows get one
row each; a null doc_id is never a component_id unless its component has no other;
an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import cut, map_batches, text_of
from tierwise.llm.components import components

BITS = 64
SEED = 42  # fixed value of the contract
PROBE_COST = 6.0  # what writing a probe costs against comparing a candidate


def fingerprint(text: str, size: int) -> int:
    """Signed 64-bit fingerprint."""
    import xxhash

    words = text.encode().lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= size:
        hashes = [digest(line, SEED)]
    else:
        at = [0]
        for w in words:
            at.append(at[-1] + len(w) + 1)
        hashes = [digest(line[a:b - 1], SEED) for a, b in zip(at, at[size:])]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[i:i + (1 << 15)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16 if len(part) < 65536 else np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and fp of every row; ``keep``: text columns that come along."""

    def init():
        return lambda cols: {**{c: cols[c] for c in ("doc_id", *keep)}, "fp": [fingerprint(t, size) for t in cols["text"]]}

    return map_batches(text_of(docs, "doc_id", *keep), init, "doc_id bigint, " + "".join(f"{c} string, " for c in keep) + "fp bigint")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each pair of bits how many have both."""

    def init():
        both = np.zeros((BITS, BITS), np.float64)

        def step(cols):
            x = np.unpackbits(np.array(cols["fp"], "<i8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").astype(np.float32)
            both[:] += x.T @ x
            step.n += len(x)

        def end():
            i, j = np.divmod(np.arange(BITS * BITS), BITS)
            return {"i": [*i, -1], "j": [*j, -1], "n": [*both.ravel().astype(np.int64), step.n]}

        step.n, step.end = 0, end
        return step

    rows = (map_batches(fps.select("fp"), init, "i int, j int, n bigint", rows=8192)
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # at most 4,097 rows
    both, total = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] < 0:
            total = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return total, both


def group_bits(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of even size; a group grows by the bit most correlated with it."""
    p = np.diag(both) / max(1, total)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(1, total) - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    for g in range(parts):
        size = (BITS * (g + 1)) // parts - (BITS * g) // parts
        free = sorted(left)
        own = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        left.discard(own[0])
        while len(own) < size:
            bit = max(sorted(left), key=lambda b: (corr[b, own].sum(), -b))
            own.append(bit)
            left.discard(bit)
        groups.append(sorted(own))
    return groups


def choose(n: int, k: int) -> int:
    return int(np.prod([(n - i) / (i + 1) for i in range(k)]).round()) if k else 1


def plan(total: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions used, of least estimated cost. Candidates of a
    partition and threshold: pairs times the chance that two fingerprints differ in so
    few of its bits, each bit differing with the frequency counted over all."""
    p = np.diag(both) / max(1, total)
    differ = 2 * p * (1 - p)
    best, chosen = np.inf, []
    for parts in range(2, max_bits + 2):
        groups = group_bits(total, both, parts)
        cost = np.full((parts, max_bits + 2), np.inf)  # by partition and t + 1
        for g, bits in enumerate(groups):
            chance = np.zeros(max_bits + 2)
            chance[0] = 1.0
            for b in bits:
                chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
                chance[0] *= 1 - differ[b]
            cost[g, 0] = 0.0
            for t in range(0, min(3, max_bits) + 1):
                probes = sum(choose(len(bits), i) for i in range(t + 1))
                cost[g, t + 1] = PROBE_COST * total * (1 + probes) + total * total / 2 * chance[:t + 1].sum()
        need = max_bits + 1
        table = np.full((parts + 1, need + 1), np.inf)
        table[0, 0] = 0.0
        pick = {}
        for g in range(parts):
            for have in range(need + 1):
                for step in range(need - have + 1):
                    c = table[g, have] + cost[g, step]
                    if c < table[g + 1, have + step]:
                        table[g + 1, have + step], pick[g + 1, have + step] = c, step
        if table[parts, need] < best:
            best, have, chosen = table[parts, need], need, []
            for g in range(parts, 0, -1):
                step = pick[g, have]
                if step:
                    chosen.append((groups[g - 1], step - 1))
                have -= step
    return chosen[::-1]


def mask_of(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def flips(bits: list[int], t: int) -> list[int]:
    from itertools import combinations

    return [mask_of(c) for k in range(t + 1) for c in combinations(bits, k)]


def links(fps: DataFrame, chosen: list[tuple[list[int], int]], max_bits: int) -> DataFrame:
    """(u, v), u < v: every pair of distinct fingerprints within ``max_bits`` bits, once."""
    masks = [mask_of(bits) for bits, _ in chosen]

    def keyed(name: str, moves: list[tuple[int, int, int]]) -> DataFrame:
        every = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(m).cast("long").alias("mask"), F.lit(x).cast("long").alias("flip"))
                          for i, m, x in moves])
        return fps.select(F.col("fp").alias(name), F.explode(every).alias("k")).select(
            name, "k.part", F.col(name).bitwiseAND(F.col("k.mask")).bitwiseXOR(F.col("k.flip")).alias("key"))

    index = keyed("v", [(i, m, 0) for i, m in enumerate(masks)])
    probes = keyed("u", [(i, m, x) for i, (m, (bits, t)) in enumerate(zip(masks, chosen)) for x in flips(bits, t)])
    differ = F.col("u").bitwiseXOR(F.col("v"))
    first = F.lit(True)
    for i in range(1, len(chosen)):
        earlier = F.lit(True)
        for m, (_, t) in list(zip(masks, chosen))[:i]:
            earlier = earlier & (F.bit_count(differ.bitwiseAND(F.lit(m).cast("long"))) > t)
        first = first & ((probes["part"] != i) | earlier)
    on = ((probes["part"] == index["part"]) & (probes["key"] == index["key"]) & (F.col("u") < F.col("v"))
          & (F.bit_count(differ) <= max_bits) & first)
    return probes.join(index, on).select("u", "v")


def roots_of(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct`` rows, one per fp, with the root of the component that the fp is in."""
    chosen = plan(*bit_statistics(distinct), max_bits)
    roots = components(links(distinct.select("fp"), chosen, max_bits)).select(F.col("u").alias("fp"), "root")
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, size: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fp (signed 64 bits) and component_id: the least doc_id reachable over links."""
    prints = cut(fingerprints(docs, size))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    grouped = roots_of(distinct, max_bits)
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, size: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component: the first by doc_id (null last), then by a digest of the whole row,
    so several texts under one doc_id, or none, are told apart. Equal rows are one."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text").isNull(),
                            F.md5(F.coalesce("text", F.lit("")).cast("binary")),
                            F.to_json(F.struct(*rest)) if rest else F.lit("")).cast("binary"))
    named = docs.withColumn("_simhash_row", row)
    prints = cut(fingerprints(named, size, ("_simhash_row",)))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_simhash_row")
    grouped = roots_of(cut(prints.groupBy("fp").agg(F.min(order).alias("first"))), max_bits)
    kept = grouped.groupBy("root").agg(F.min("first").alias("first")).select("first._simhash_row")
    return named.dropDuplicates(["_simhash_row"]).join(kept, "_simhash_row", "left_semi").select(*docs.columns)
