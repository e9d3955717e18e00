"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded (a small
tanh layer over its measures), gated attention weighs the passages, and the weighted
mean representation gives the document's score: only document labels are needed, and
one bad stretch can decide. Encoder, attention and output are trained together.

Training uses a bounded sample: at most ``per_class`` labelled documents of either label
(those of least hash), weighted back to the label counts of all training rows. It is
fitted on the driver from passage measures alone; scoring is one pass over all documents
without a shuffle, a few kilobytes of weights going along.

Defined results: a null text counts as empty, which is one passage of its own kind;
documents with no label, a null or contradictory ones are not trained on; without any
training row every score is 0.5; with one label only, scores lie on its side; repeated
rows score alike; an empty table gives an empty one. Only ``doc_id`` (to tell held-out
rows) and ``text`` are read. Every passage of a text of any length is encoded.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_batches, text_of

PASSAGE = 50
FEATURES = 14
HIDDEN, ATTENTION = 16, 8
ROUNDS, BATCH, RATE, DECAY = 20, 64, 0.01, 1e-4
PER_CLASS = 2000
DDL = "doc_id bigint, score double, predicted int, n_passages bigint, top_passage bigint"

LOWER = bytes(range(97, 123))
UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
STOP = b".,;:?"
SHOUT = b"!"
SYMBOL = b"#*$%&|<>=@~^_\\{}[]/+"
HIGH = bytes(range(128, 256))
CLASSES = (LOWER, UPPER, DIGIT, STOP, SHOUT, SYMBOL, HIGH)


def passages(text: str) -> list[list[float]]:
    """Measures of each passage."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return [[0.0] * (FEATURES - 1) + [1.0]]
    triples = list(zip(words, words[1:], words[2:])) if n > 2 else [tuple(words)]
    seen: set = set()
    out = []
    for a in range(0, n, PASSAGE):
        part = words[a:a + PASSAGE]
        m, line = len(part), b" ".join(part)
        size = len(line)
        row = [(size - len(line.translate(None, c))) / size for c in CLASSES]
        own = triples[a:a + PASSAGE]
        fresh = set(own) - seen
        row += [
            min(2.0, (size - m + 1) / m / 6), len(set(part)) / m, 1 - len(fresh) / len(own) if own else 0.0,
            sum(1 for w in part if w[0] in UPPER) / m, line.count(b"!!") / m, m / PASSAGE, 0.0]
        seen |= fresh
        out.append(row)
    return out


def start_weights(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    g = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
    return {"W": g(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": g(HIDDEN, ATTENTION), "U": g(HIDDEN, ATTENTION),
            "w": g(ATTENTION, 1)[:, 0], "c": g(HIDDEN, 1)[:, 0], "d": np.zeros(1)}


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def forward(p: dict, x: np.ndarray, starts: np.ndarray) -> dict:
    """x: passages of all bags one after another; starts: where each bag begins."""
    bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    e = (t * s) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "y": sigmoid(z @ p["c"] + p["d"])}


def gradients(p: dict, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    f = forward(p, x, starts)
    bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
    out = weight * (f["y"] - y) / weight.sum()
    dz = out[:, None] * p["c"]
    da = (dz[bag] * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt, ds = de[:, None] * p["w"] * s, de[:, None] * p["w"] * t
    dt, ds = dt * (1 - t * t), ds * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de,
            "c": f["z"].T @ out, "d": np.array([out.sum()])}


def train(bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict:
    """Adam over ``ROUNDS`` shuffled passes in batches of ``BATCH`` bags; the measures are
    standardised inside the first layer."""
    p = start_weights()
    x = np.concatenate(bags)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    bags = [(b - mean) / spread for b in bags]
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    order, i = np.random.default_rng(11), 0
    for _ in range(ROUNDS):
        deal = order.permutation(len(bags))
        for at in range(0, len(bags), BATCH):
            own = deal[at:at + BATCH]
            part = [bags[j] for j in own]
            starts = np.cumsum([0, *map(len, part)])[:-1]
            i += 1
            for k, g in gradients(p, np.concatenate(part), starts, y[own], weight[own]).items():
                g = g + DECAY * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8)
    p["b"] = p["b"] - (mean / spread) @ p["W"]
    p["W"] = p["W"] / spread[:, None]
    return p


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id and label of the rows to train on: not held out, one label only."""
    return (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
            .where("label = most").select("doc_id", "label"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict | None:
    rows = labelled(labels).join(docs.select("doc_id"), "doc_id", "left_semi")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    picked = {}
    for label in sorted(counts):  # at most per_class rows each
        for r in rows.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect():
            picked[r["doc_id"]] = label
    if not picked:
        return None
    spark = docs.sparkSession
    chosen = spark.createDataFrame(sorted(picked.items()), "doc_id bigint, label int")

    def init():
        return lambda cols: {"doc_id": cols["doc_id"], "x": [sum(passages(t), []) for t in cols["text"]]}

    texts = text_of(docs, "doc_id").join(F.broadcast(chosen.select("doc_id")), "doc_id")
    got = map_batches(texts, init, "doc_id bigint, x array<float>").collect()
    bags = {r["doc_id"]: np.array(r["x"]).reshape(-1, FEATURES) for r in sorted(got, key=lambda r: (r["doc_id"], r["x"]))}
    ids = sorted(bags)
    y = np.array([picked[i] for i in ids], float)
    size = {c: sum(1 for i in ids if picked[i] == c) for c in counts}
    return train([bags[i] for i in ids], y, np.array([counts[picked[i]] / size[picked[i]] for i in ids]))


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """Per row: score, predicted label, passages, and the passage with most attention."""

    def init():
        def step(cols):
            bags = [passages(t) for t in cols["text"]]
            starts = np.cumsum([0, *map(len, bags)])[:-1]
            if model is None:
                y, top = np.full(len(bags), 0.5), np.zeros(len(bags), np.int64)
            else:
                f = forward(model, np.array(sum(bags, [])), starts)
                y = f["y"]
                top = [int(f["a"][s:s + len(b)].argmax()) for s, b in zip(starts, bags)]
            return {"doc_id": cols["doc_id"], "score": y, "predicted": (y >= 0.5).astype(np.int32),
                    "n_passages": [len(b) for b in bags], "top_passage": top}
        return step

    return map_batches(text_of(docs, "doc_id"), init, DDL, rows=128)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    rows = score(docs, fit(docs, labels, per_class))
    return rows.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))


def keep_good(docs: DataFrame, model: dict | None) -> DataFrame:
    """The documents that score 0.5 or more, as they were."""
    import pyarrow as pa

    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                bags = [passages(t or "") for t in part.column(at).to_pylist()]
                if model is not None:
                    y = forward(model, np.array(sum(bags, [])), np.cumsum([0, *map(len, bags)])[:-1])["y"]
                    part = part.filter(pa.array(y >= 0.5))
                yield part

    return docs.mapInArrow(run, docs.schema)
