"""Language-model scoring by prediction by partial matching, pretrained on the corpus.

A trie of byte contexts (up to ``ORDER`` bytes) with the counts of the byte that follows
is learned from the training texts. A text's code length adds up, byte by byte and for
one end mark: in the longest context seen in training, a byte seen there gets its share
n / (N + D), N being the context's count and D its distinct followers (the escape count);
otherwise the escape's share is paid and the next shorter context asked, where everything
the longer context has seen is excluded from the counts. Below the empty context all
bytes left are equally likely. As all counts come from (order + 1)-grams, followers of a
context are followers of its suffixes too, so the exclusions of a context are three sums
per context and the whole model is joins and windows over the distinct grams.

No model is sent whole to anyone: texts are dealt into blocks of ``block_bytes``, each
block's distinct grams and words are looked up in the corpus-wide counts by joins, and the
block is scored with its own part of the model. What is shuffled grows with the corpus.

Defined results: null text = empty text = the end mark alone; a null doc_id is held out
(crc32 of the empty string); repeated rows count and are scored as often as they occur;
without training rows every token is unknown and every byte equally likely; an empty
table gives an empty one; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tierwise.llm.common import cut, cut_by, map_batches, schema_of, text_of

ORDER = 4                 # bytes of context; a gram is one more and fits 8 bytes up to 7
END = 0xFF                # ends a text and stands before it: no UTF-8 text has this byte
BLOCK_BYTES = 24_000_000
SCORED_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, raw double, score double, "
              "part_tokens bigint, part_types bigint, part_docs bigint")


def grams_of(text: bytes, order: int) -> np.ndarray:
    """Every byte of the text and its end mark as the last byte of a gram with its context."""
    size = order + 1
    raw = np.frombuffer(bytes([END]) * order + text + bytes([END]), np.uint8)
    out = np.zeros(len(raw) - order, np.int64)
    for j in range(size):
        out = (out << 8) | raw[j:len(raw) - order + j]
    return out


def counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their summed counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[at], np.add.reduceat(n, at)


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Texts in lower case, compressed, dealt into blocks."""
    rows = text_of(docs, "doc_id")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    rows = rows.withColumn("held", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(10)) == 0)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(n)).cast("int"))

    def init():
        return lambda cols: {"block": cols["block"], "doc_id": cols["doc_id"], "held": cols["held"],
                             "blob": [zlib.compress(t.encode().lower(), 1) for t in cols["text"]]}

    return cut_by(map_batches(rows, init, "block int, doc_id bigint, held boolean, blob binary"), "block")


def block_words(base: DataFrame) -> DataFrame:
    """Per block its distinct words and how often they occur in its training texts."""

    def init():
        state = {"block": None, "words": Counter()}

        def close():
            words = state["words"]
            return {"block": [state["block"]] * len(words), "word": list(words), "n": list(words.values())}

        def step(cols):
            out = {"block": [], "word": [], "n": []}
            for block, held, blob in zip(cols["block"], cols["held"], cols["blob"]):
                if block != state["block"]:
                    for k, v in close().items():
                        out[k] += v
                    state.update(block=block, words=Counter())
                words = zlib.decompress(blob).split()
                if held:
                    for w in set(words):
                        state["words"].setdefault(w, 0)
                else:
                    state["words"].update(words)
            return out

        step.end = close
        return step

    return map_batches(base.select("block", "held", "blob"), init, "block int, word binary, n bigint", rows=64)


def block_grams(base: DataFrame, order: int) -> DataFrame:
    """Per block its distinct grams, sorted, and their training counts, packed in one row."""

    def init():
        state = {"block": None, "keys": [], "n": [], "size": 0}

        def fold():
            if state["keys"]:
                keys, n = counted(np.concatenate(state["keys"]), np.concatenate(state["n"]))
                state.update(keys=[keys], n=[n], size=0)

        def close():
            fold()
            if state["block"] is None:
                return {"block": [], "grams": [], "counts": []}
            return {"block": [state["block"]], "grams": [state["keys"][0].astype("<i8").tobytes()],
                    "counts": [state["n"][0].astype("<i8").tobytes()]}

        def step(cols):
            out = {"block": [], "grams": [], "counts": []}
            for block, held, blob in zip(cols["block"], cols["held"], cols["blob"]):
                if block != state["block"]:
                    for k, v in close().items():
                        out[k] += v
                    state.update(block=block, keys=[], n=[], size=0)
                keys = np.sort(grams_of(zlib.decompress(blob), order))
                at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                state["keys"].append(keys[at])
                state["n"].append(np.zeros(len(at), np.int64) if held else np.diff(np.r_[at, len(keys)]))
                state["size"] += len(at)
                if state["size"] > 1_000_000:
                    fold()
            return out

        step.end = close
        return step

    return map_batches(base.select("block", "held", "blob"), init, "block int, grams binary, counts binary", rows=64)


def unpacked(packed: DataFrame) -> DataFrame:
    def init():
        def step(cols):
            keys = [np.frombuffer(g, "<i8") for g in cols["grams"]]
            return {"block": np.repeat(np.array(cols["block"], np.int32), [len(k) for k in keys]),
                    "gram": np.concatenate(keys), "n": np.concatenate([np.frombuffer(c, "<i8") for c in cols["counts"]])}
        return step

    return map_batches(packed, init, "block int, gram bigint, n bigint", rows=1)


def code_lengths(grams: DataFrame, order: int) -> DataFrame:
    """(gram, lp): the log10 probability of a gram's last byte after its context, from
    (gram, n) over the whole corpus. Level k has the grams' suffixes of k + 1 bytes with
    count n_k and, of their context of k bytes: its count all_k, followers kinds_k, and both_k, the count that the
    context one byte shorter gives to this one's followers."""

    def level(k: int) -> DataFrame:
        mask = F.lit((1 << 8 * (k + 1)) - 1)
        return grams.groupBy(F.col("gram").bitwiseAND(mask).alias(f"g{k}")).agg(F.sum("n").alias(f"n{k}"))

    rows = level(0)
    rows = rows.crossJoin(F.broadcast(rows.agg(  # one row beside at most 256
        F.sum("n0").alias("all0"), F.count_if(F.col("n0") > 0).alias("kinds0"), F.lit(0).cast("long").alias("both0"))))
    for k in range(1, order + 1):
        low = rows
        context = Window.partitionBy(F.shiftright(F.col(f"g{k}"), 8))
        rows = (level(k).withColumn(f"g{k - 1}", F.col(f"g{k}").bitwiseAND(F.lit((1 << 8 * k) - 1)))
                .join(low, f"g{k - 1}").drop(f"g{k - 1}")
                .withColumn(f"all{k}", F.sum(f"n{k}").over(context))
                .withColumn(f"kinds{k}", F.count_if(F.col(f"n{k}") > 0).over(context))
                .withColumn(f"both{k}", F.sum(F.when(F.col(f"n{k}") > 0, F.col(f"n{k - 1}")).otherwise(0)).over(context)))
    lp = -F.log10(F.lit(256) - F.col("kinds0"))
    for k in range(order + 1):  # from the empty context up
        above = (F.col(f"both{k + 1}"), F.col(f"kinds{k + 1}")) if k < order else (F.lit(0), F.lit(0))
        count, escape = F.col(f"all{k}") - above[0], F.col(f"kinds{k}") - above[1]
        lp = (F.when(count == 0, lp).when(F.col(f"n{k}") > 0, F.log10(F.col(f"n{k}") / (count + escape)))
              .otherwise(F.log10(escape / (count + escape)) + lp))
    return rows.select(F.col(f"g{order}").alias("gram"), lp.alias("lp"))


def scored(base: DataFrame, words: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """Each block's texts against its own words and grams."""
    none = lambda kind: F.lit(None).cast(kind)
    part = words.select("block", "word", "n", "total", "first", none("bigint").alias("gram"), none("double").alias("lp")).unionByName(
        model.select("block", none("binary").alias("word"), none("bigint").alias("n"), none("bigint").alias("total"),
                     none("boolean").alias("first"), "gram", "lp"))
    arrow = to_arrow_schema(schema_of(SCORED_DDL))

    def score(texts: pa.Table, part: pa.Table) -> pa.Table:
        is_word = part.column("word").is_valid()
        own = part.filter(is_word)
        total = own.column("total").to_numpy()
        first = own.column("first").to_numpy(zero_copy_only=False).astype(bool)
        value = dict(zip(own.column("word").to_pylist(), total.tolist()))
        logs = {c: math.log10(c + 0.1) for c in np.unique(total).tolist()}
        own_grams = part.filter(part.column("gram").is_valid())
        grams, lp = own_grams.column("gram").to_numpy(), own_grams.column("lp").to_numpy()
        order_ = np.argsort(grams)
        grams, lp = grams[order_], lp[order_]
        out = {f.name: [] for f in arrow}
        sums = [int(own.column("n").to_numpy().sum()), int((first & (total > 0)).sum())]
        for doc_id, held, blob in zip(*(texts.column(c).to_pylist() for c in ("doc_id", "held", "blob"))):
            text = zlib.decompress(blob)
            counts = list(map(value.__getitem__, text.split()))
            keys = np.sort(grams_of(text, order))
            row = (doc_id, held, len(counts) + 1, len(counts) - counts.count(0),
                   math.fsum(map(logs.__getitem__, counts)), float(lp[np.searchsorted(grams, keys)].sum()),
                   sums[0], sums[1], int(not held))
            for k, v in zip(out, row):
                out[k].append(v)
            sums = [0, 0]
        return pa.table(out, schema=arrow)

    return (base.select("block", "doc_id", "held", "blob").groupBy("block")
            .cogroup(part.groupBy("block")).applyInArrow(score, SCORED_DDL))


def score_documents(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: held_out, tokens, known tokens, training tokens, the word model's score and
    the byte model's log10 probability of the text."""
    base = blocks(docs, block_bytes)
    everywhere = Window.partitionBy("word")
    words = (block_words(base).withColumn("total", F.sum("n").over(everywhere))
             .withColumn("first", F.row_number().over(everywhere.orderBy("block")) == 1))
    packed = cut(block_grams(base, order))
    rows = unpacked(packed)
    model = cut(code_lengths(cut(rows.groupBy("gram").agg(F.sum("n").alias("n"))), order))
    found = rows.select("block", "gram").join(model, "gram")
    result = cut(scored(base, words, found, order))
    t = result.agg(F.sum("part_tokens"), F.sum("part_types"), F.sum("part_docs")).first()
    ends = t[2] or 0
    tokens, types = (t[0] or 0) + ends, (t[1] or 0) + (ends > 0)
    share = math.log10(tokens + 0.1 * (types + 1))
    return result.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("raw") + math.log10(ends + 0.1) - F.col("n_tokens") * share).alias("base_score"), "score")
