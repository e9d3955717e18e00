"""Periodic runs, pair counts and sharding: brute force, the tokenizer libraries, and the odd
rows that every operator must take."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import pair_counts, periodic_runs, sharding

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
R = random.Random(8)
WORDS = ["".join(R.choice(["ka", "lo", "mi", "né", "Tu", "日"]) for _ in range(R.randint(1, 3))) for _ in range(40)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


BLOCK = prose(37, 1)
ROWS = [
    (1, prose(30, 2) + " " + " ".join([BLOCK] * 4) + " end"), (2, "x " * 3000), (3, "a b " * 40 + "a " + "a b " * 40),
    (4, prose(900, 3)), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (None, "a b c " * 9), (9, "a b c " * 9),
    (9, "a b c " * 9), (10, "日本語 ▁ 😀 <|endoftext|> </s> é\r\n end"), (11, "tail space  "), (12, "\nline\nline  two"),
    (13, prose(20_000, 4)), *[(i, prose(40, i) + " " + " ".join([prose(9, i)] * 3)) for i in range(20, 60)]]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(i, t, ["s0", "s1", None][k % 3] if k % 4 else "s0") for k, (i, t) in enumerate(ROWS)],
                               "doc_id bigint, text string, source string")
    for c in ("node", "bucket", "pairs", "size", "shard", "slot", "_pid", "_rank", "_row", "law", "runs", "start", "n_best", "count_sum"):
        df = df.withColumn(c, F.lit(1).cast("bigint"))
    return df


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ periodic runs

def brute_runs(words, least=12):
    runs, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(q, least - q):
                runs.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in runs.items())


def brute_row(doc_id, text, plant):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and w and h % 10 == 0:
        a, g = h // 10 % len(w), h // 10
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("plant", [False, True])
def test_periodic_runs(docs, empty, plant):
    rows = [r for r in ROWS if len(words_of(r[1])) <= 3000]
    want = sorted((brute_row(*r, plant) for r in rows), key=repr)
    got = periodic_runs.detect(docs.where("doc_id IS NULL OR doc_id <> 13"), plant=plant, with_text=False)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert periodic_runs.detect(empty).count() == 0


def test_periodic_runs_whole_text(docs):
    row = periodic_runs.detect(docs.where("doc_id = 1")).first()
    assert [tuple(r) for r in row["runs"]] == [(30, 4 * 37, 37)]
    assert row["collapsed_text"] == " ".join(words_of(ROWS[0][1])[:30 + 37] + ["end"])


def odd_text(r):
    kind = r.randrange(5)
    if kind == 0:  # repeated blocks, with insertions
        x = [r.randint(0, r.choice([1, 2, 30])) for _ in range(r.randint(1, 60))] * r.randint(1, 9)
        for _ in range(r.randint(0, 3)):
            x.insert(r.randint(0, len(x)), r.randint(0, 3))
        return x
    if kind == 1:
        return [r.randint(0, 1) for _ in range(r.randint(0, 200))]
    if kind == 2:  # a seam of two runs of one period: a run for every odd lag
        return [0, 1] * r.randint(5, 60) + [0] * r.randint(0, 2) + [0, 1] * r.randint(5, 60)
    if kind == 3:  # Fibonacci word
        a, b = [0], [0, 1]
        for _ in range(r.randint(3, 9)):
            a, b = b, b + a
        return b
    x = [0]
    for _ in range(8):  # Thue-Morse word
        x += [1 - c for c in x]
    return x


def test_find_runs_equals_brute_force():
    r = random.Random(3)
    for _ in range(120):
        texts = [odd_text(r) for _ in range(r.randint(1, 5))]
        bounds = np.cumsum([0, *map(len, texts)])
        found = periodic_runs.find_runs(np.array([w for t in texts for w in t], np.int64), bounds)
        for text, lo, runs in zip(texts, bounds.tolist(), found):
            assert sorted((a - lo, b - a, q) for (a, b), q in runs.items()) == brute_runs(text)


# ------------------------------------------------------------------ pair counts

def library_rows(rows):
    """The contract's columns by the tokenizer libraries and plain loops."""
    import sentencepiece
    import tokenizers

    tk = tokenizers.Tokenizer.from_file(A)
    tk.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    from tierwise.llm.prefix_tokens import byte_alphabet
    byte = {c: i for i, c in enumerate(byte_alphabet())}

    def b_bytes(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()

    aligned, held = [], collections.Counter()
    for _, text in rows:
        a, b = tk.encode(" " + (text or ""), add_special_tokens=False).ids, sp.encode(text or "")
        a_b, b_b = [bytes(byte[c] for c in tk.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if not text or b"".join(a_b) != (" " + text).encode() or b"".join(b_b) != (" " + text).encode():
            aligned.append(([], [], [], []))
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_b]).tolist(), np.cumsum([len(x) for x in b_b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            k, m = a_end.index(end) + 1, b_end.index(end) + 1
            groups.append((a[i:k], b[j:m]))
            links += [(a[x], b[y]) for x in range(i, k) for y in range(j, m)
                      if a_end[x] - len(a_b[x]) < b_end[y] and b_end[y] - len(b_b[y]) < a_end[x]]
            i, j = k, m
        aligned.append((a, b, groups, links))
        held.update(set(links))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), (a, b, groups, links) in zip(rows, aligned):
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(line.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [64 << 20, 20_000])
def test_pair_counts_equal_the_libraries(docs, empty, block_bytes):
    """With one block and with many, over several tasks."""
    rows = [r for r in ROWS if r[0] != 13]
    few = docs.where("doc_id IS NULL OR doc_id <> 13").repartition(5)
    got = pair_counts.align(few, A, B, block_bytes=block_bytes, with_text=False)
    assert sorted(map(tuple, got.collect()), key=repr) == library_rows(rows)
    assert pair_counts.align(empty, A, B).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 50, 20_000))
    bucket = pair_counts.bucket_of(keys)
    built = [pair_counts.PerfectHash.build(keys[bucket == b]) for b in range(pair_counts.BUCKETS)]
    hashed = pair_counts.PerfectHash([s for s, _ in built], np.concatenate([b for _, b in built]))
    slots = hashed.slots(keys, bucket)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    by_slot = np.empty_like(keys)
    by_slot[slots] = keys
    other = np.setdiff1d(keys + 1, keys)
    at = hashed.slots(other, pair_counts.bucket_of(other))
    assert not (by_slot[at[at >= 0]] == other[at >= 0]).any()


def test_stretches_encode_like_whole_texts():
    """Texts are cut at white space; the tokens must be those of the whole text."""
    r = random.Random(4)
    signs = "ab eé1'  \n\t\r 　▁日😀<|>/s.,\x1c\x85̈ſ"
    rows = [(i, "".join(r.choice(signs) for _ in range(r.randint(0, 40)))) for i in range(800)]
    aligner = pair_counts.Aligner(A, B)
    want = {i: w for i, *w in library_rows(rows)}
    for (i, _), found in zip(rows, aligner.batch([t for _, t in rows])):
        line = ";".join(e[3] for e in found)
        assert [sum(e[k] for e in found) for k in range(3)] == want[i][:3]
        assert (hashlib.sha256(line.encode()).hexdigest() if found else "") == want[i][-1]


# ------------------------------------------------------------------ sharding

def test_sharding_law_and_mixture(spark):
    """One source holds a third of all rows, one is null, many are small."""
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") % 50 == 7, None).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 900).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("s"), F.col("id") % 40)).alias("source"))
    rows = sharding.assign(df, keep=("source", "text")).collect()
    assert len(rows) == n and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    by_shard, by_source = collections.defaultdict(list), collections.Counter(r["source"] for r in rows)
    for r in rows:
        by_shard[r["shard"]].append(r)
        data = r["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    assert sorted(by_shard) == list(range(24)) and {len(x) for x in by_shard.values()} == {n // 24}
    for got in by_shard.values():
        assert sorted(r["slot"] for r in got) == list(range(len(got)))
        mix = collections.Counter(r["source"] for r in got)
        # a stretch of the interleaving holds each source in proportion, give or take the ends
        assert all(abs(mix[s] - m / 24) <= (8 if s == "hot" else 2) for s, m in by_source.items())
    again = sharding.assign(df.repartition(7), keep=("source", "text")).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    other = sharding.assign(df, seed=7, keep=("source", "text")).collect()
    assert sorted(map(repr, other)) != sorted(map(repr, rows))


def test_sources_of_one_row_are_spread(spark):
    df = spark.range(2400).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("source"))
    rows = sharding.assign(df.unionByName(df.withColumn("source", F.lit("hot"))), keep=("source",)).collect()
    hot = collections.Counter(r["shard"] for r in rows if r["source"] == "hot")
    assert all(70 <= hot[i] <= 130 for i in range(24))


def test_sharding_odd_rows(docs, empty, tmp_path):
    rows = sharding.assign(docs).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in rows), key=repr) == sorted(
        ((i, len((t or "").encode()) + 8) for i, t in ROWS), key=repr)
    counts = collections.Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts[i] for i in range(24)) <= 1
    assert sharding.assign(empty).count() == 0
    sharding.write_shards(docs, f"{tmp_path}/shards", shards=5)
    back = docs.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert {"doc_shard", "doc_slot", "shard", "slot", "text", "source"} <= set(back.columns)
    assert sorted(back.select("doc_id", "text").collect(), key=repr) == sorted(docs.select("doc_id", "text").collect(), key=repr)
    assert {r[0] for r in back.groupBy("shard").count().select("count").collect()} <= {len(ROWS) // 5, len(ROWS) // 5 + 1}
