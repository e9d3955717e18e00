"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised alike (lower case, ASCII punctuation and white space to
single spaces). An item of n characters may occur with up to k = floor(max_error * n)
edits; cut into k + 1 pieces, at least one piece must then occur unchanged. One
Aho-Corasick automaton over all pieces finds those hits in a text, and Myers'
bit-parallel distance verifies the stretch around them, first of the hit's pair of pieces
and then of the whole item: k edits cannot put two into every pair of the k + 1 pieces, so
some pair holds one at most and, by the same argument, an unchanged piece. The search is
exact: every occurrence within k edits is found.

The benchmark is a stated query set: it is split by item into blocks of at most
``block_chars`` characters (measured first), one broadcast automaton per block, and the
documents pass every block in one scan without a shuffle.

Defined results: null or empty texts and items without a letter or digit match nothing;
repeated items count once per item_id (the smallest distance), the items without an id
together as the null one; repeated documents each get a row; an empty table of either kind gives no hits; an input column called
``benchmark_hits`` is replaced, all others pass through. A text is searched whole.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HITS = "benchmark_hits"
HITS_DDL = "array<struct<item_id: bigint, distance: bigint>>"
#: Every ASCII byte that is no letter or digit becomes a space.
SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normalise(text: str | None) -> str:
    return b" ".join((text or "").lower().encode().translate(SPACED).split()).decode()


def cut_pieces(n: int, parts: int) -> list[tuple[int, int]]:
    """``parts`` consecutive spans of 0..n, as even as can be."""
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


class Myers:
    """Least edit distance between a pattern and any substring of a text."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.full, self.top = (1 << self.m) - 1, 1 << (self.m - 1)
        self.at: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.at[c] = self.at.get(c, 0) | 1 << i

    def least(self, text: str) -> int:
        plus, minus, full, top = self.full, 0, self.full, self.top
        score = best = self.m
        get = self.at.get
        for c in text:
            eq = get(c, 0)
            down = eq | minus
            across = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (full & ~(across | plus))
            lower = plus & across
            if up & top:
                score += 1
            elif lower & top:
                score -= 1
                if score < best:
                    best = score
            up <<= 1
            lower <<= 1
            plus = (lower | ~(down | up)) & full
            minus = up & down & full
        return best


class Matcher:
    def __init__(self, items: list[tuple[int, str]], max_error: float):
        import ahocorasick

        self.items = []
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list] = {}
        for item_id, text in items:
            n = len(text)
            k = math.floor(max_error * n)
            self.items.append((item_id, text, k))
            spans = cut_pieces(n, k + 1)
            for i, (a, b) in enumerate(spans):
                pair = spans[i - i % 2:i - i % 2 + 2]
                pieces.setdefault(text[a:b], []).append(
                    (len(self.items) - 1, a, b - a, pair[0][0], pair[-1][1], len(pair) - 1))
        for piece, where in pieces.items():
            self.automaton.add_word(piece, where)
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces
        self.made: dict[tuple, Myers] = {}  # patterns that a hit has asked for

    def least(self, item: int, a: int, b: int, text: str) -> int:
        """Least distance of the item's characters a..b within ``text``."""
        myers = self.made.get((item, a, b))
        if myers is None:
            if len(self.made) >= 4_000:
                self.made.clear()
            myers = self.made[item, a, b] = Myers(self.items[item][1][a:b])
        return myers.least(text)

    def hits(self, text: str) -> dict[int | None, int]:
        """item_id -> least distance, for the items that occur within their budget."""
        if self.empty or not text:
            return {}
        spans: dict[int, list] = {}
        for end, where in self.automaton.iter(text):
            for item, offset, size, a, b, edits in where:
                start = end + 1 - size - offset  # of the item, if nothing before is changed
                if not edits or self.least(item, a, b, text[max(0, start + a - edits):start + b + edits]) <= edits:
                    spans.setdefault(item, []).append(start)
        found: dict[int | None, int] = {}
        for item, starts in spans.items():
            item_id, pattern, k = self.items[item]
            n = len(pattern)
            starts.sort()
            lo, hi, best = max(0, starts[0] - k), starts[0] + n + k, k + 1
            for s in starts[1:] + [None]:
                if s is not None and s - k <= hi:
                    hi = max(hi, s + n + k)
                    continue
                best = min(best, self.least(item, 0, n, text[lo:hi]))
                if s is not None:
                    lo, hi = max(0, s - k), s + n + k
            if best <= k:
                found[item_id] = min(best, found.get(item_id, best))
        return found


def blocks_of(items: DataFrame, block_chars: int) -> list[list[tuple[int, str]]]:
    """Normalised items in blocks; each is fetched by itself, so the driver holds one."""
    rows = items.where("text IS NOT NULL").select("item_id", "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(1.2 * chars / block_chars))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct()
        yield sorted({(r[0], t) for r in part.collect() if (t := normalise(r[1]))}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def flag(docs: DataFrame, items: DataFrame, max_error: float = 0.1, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with a column ``benchmark_hits``: items found and their least distances,
    by item_id."""
    out = docs.drop(HITS)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in out.schema)}, {HITS} {HITS_DDL}"
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64())]))
    out = out.withColumn(HITS, F.expr(f"CAST(array() AS {HITS_DDL})"))
    at = out.columns.index("text")
    for block in blocks_of(items, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, max_error)
            for batch in batches:
                for a in range(0, batch.num_rows, 256):
                    part = batch.slice(a, 256)
                    got = []
                    for text, old in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist()):
                        new = {h["item_id"]: h["distance"] for h in old or ()}
                        for item, d in matcher.hits(normalise(text)).items():
                            new[item] = min(d, new.get(item, d))
                        got.append([{"item_id": i, "distance": new[i]}
                                    for i in sorted(new, key=lambda i: (i is None, i or 0))])
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, kind)],
                                                     names=part.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def report(docs: DataFrame, items: DataFrame, max_error: float = 0.1) -> DataFrame:
    """One row per document: whether it holds benchmark items, which, and how closely."""
    hits = flag(docs.select("doc_id", "text"), items, max_error)
    return hits.select(
        "doc_id", (F.size(HITS) > 0).alias("contaminated"), F.size(HITS).cast("long").alias("n_items"),
        F.col(f"{HITS}.item_id").alias("item_ids"), F.array_min(f"{HITS}.distance").alias("least_distance"))


def drop_contaminated(docs: DataFrame, items: DataFrame, max_error: float = 0.1, block_chars: int = 4_000_000) -> DataFrame:
    """The documents without a hit, as they were."""
    return flag(docs, items, max_error, block_chars).where(F.size(HITS) == 0).select(*docs.columns)
