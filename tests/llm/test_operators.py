"""The ten operators on small tables: brute force, round trips, and the odd rows that
every one must take (nulls, empty and long texts, ties, repeated rows, empty tables, extra
columns whose names clash with their own)."""

import collections
import hashlib
import itertools
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import (chat_format, components, decontaminate, pieces, pii, ppm, prefix_tokens, quality_mil,
                          quality_rules, simhash, substring_dedup)

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

R = random.Random(5)
VOCAB = ["".join(R.choice(["ka", "lo", "mi", "né", "Tu", "ra"]) for _ in range(R.randint(1, 3))) for _ in range(60)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) + r.choice(["", "", ",", "."]) for _ in range(n))


SHARED = prose(70, 1)
ROWS = [
    (1, prose(90, 2) + " " + SHARED), (2, SHARED + "\n" + prose(40, 3)), (3, prose(30, 4) + " " + SHARED + " tail"),
    (4, prose(60, 5)), (5, prose(60, 5)), (5, prose(60, 5)), (6, prose(60, 5) + " end"), (7, None), (8, ""),
    (9, " \n\t "), (10, "one"), (None, prose(60, 5)), (11, "x " * 3000), (12, prose(4000, 6)),
    (13, "Mail a.b@c.org or +49 30 1234567, card 4111 1111 1111 1111, host 10.0.0.300 and 10.0.0.3."),
    (14, "日本語 ▁ 😀 <|endoftext|> \u0085 é\r\n end"), (15, "Home | About | Login\nA proper line ends here.\n" * 3)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    for c in ("fp", "block", "anchors", "row", "_spans", "benchmark_hits", "score", "hits", "tk", "n_chars"):
        df = df.withColumn(c, F.lit(1).cast("bigint"))
    return df


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ 1 quality rules

def test_quality_rules(docs, empty):
    got = [r.asDict() for r in quality_rules.apply_rules(docs).collect()]
    assert len(got) == len(ROWS) and quality_rules.apply_rules(empty).count() == 0
    for r, (_, text) in zip(got, ROWS):
        w = words_of(text)
        grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {p for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
    menu = next(r for r in got if r["doc_id"] == 15)
    assert menu["n_lines_removed"] == 3 and "Home" not in menu["clean_text"]


def test_line_rules():
    bad = ["no stop at the end", "Home | News | Login.", "All rights reserved.", "A!! B!! C!!", "## ** && a."]
    assert all(quality_rules.line_fails(x.encode(), len(x.split())) for x in bad)
    assert not quality_rules.line_fails("A proper line ends here.".encode(), 5)


# ------------------------------------------------------------------ 2 substring dedup

def brute_dedup(rows, window):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = {p for k in range(len(w) - window + 1)
                if i is not None and first[tuple(w[k:k + window])] < i for p in range(k, k + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot,shard", [(256, 200_000), (0, 60)])
def test_substring_dedup(docs, empty, hot, shard):
    got = substring_dedup.dedup(docs, hot=hot, shard_words=shard).collect()
    assert sorted(map(tuple, got), key=repr) == brute_dedup(ROWS, 50)
    assert substring_dedup.dedup(empty).count() == 0


@pytest.mark.parametrize("shard", [5_000, 1_000, 50])
def test_hot_anchors_are_split(spark, monkeypatch, shard):
    """A frequent line with the least run hash in many groups of near copies: no key holds more
    windows than a shard has room for, and the result stays that of brute force."""
    r = random.Random(11)
    lines = [" ".join(r.choice(VOCAB) for _ in range(8)) for _ in range(20_000)]
    line = min(lines, key=lambda t: substring_dedup.rolled(substring_dedup.word_hashes(t.encode().split()), 8)[0])
    rows = []
    for g in range(12):
        before, after = prose(60, 100 + g), prose(60, 200 + g)
        rows += [(3 * g + i, f"{before} {line} {after} copy{i}") for i in range(3)]
    sizes, decide = [], substring_dedup.decide

    def watched(contents, window, shard_words):
        seen = {}
        for x in contents.collect():
            words = x["content"].split()
            seen.setdefault(x["anchor"], set()).update(tuple(words[i:i + window]) for i in range(len(words) - window + 1))
        sizes.extend(map(len, seen.values()))
        return decide(contents, window, shard_words)

    monkeypatch.setattr(substring_dedup, "decide", watched)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = substring_dedup.dedup(df, hot=4, shard_words=shard).collect()
    assert sorted(map(tuple, got), key=repr) == brute_dedup(rows, 50)
    assert max(sizes) <= max(43, shard // 50)  # 43: under an anchor that only one group has


def test_suffix_automaton():
    r = random.Random(3)
    for _ in range(150):
        seqs = [[r.choice("ab c".split()) for _ in range(r.randint(1, 30))] for _ in range(4)]
        a = substring_dedup.SuffixAutomaton()
        for s in seqs[:3]:
            a.add(s)
        w = r.randint(1, 6)
        want = [any(seqs[3][i:i + w] == s[j:j + w] for s in seqs[:3] for j in range(len(s)))
                for i in range(len(seqs[3]) - w + 1)]
        assert a.windows(seqs[3], w).tolist() == want


def test_anchor_depends_on_the_window_alone():
    w = [x.encode() for x in prose(300, 9).split()]
    whole = substring_dedup.anchors_of(substring_dedup.word_hashes(w), 50)
    assert all(whole[i] == substring_dedup.anchors_of(substring_dedup.word_hashes(w[i:i + 50]), 50)[0] for i in range(0, 250, 7))


# ------------------------------------------------------------------ 3 personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_spans(text):
    return sorted((m.start(), i, m.end(), k) for i, k in enumerate(PATTERNS)
                  for m in re.finditer(PATTERNS[k], text or "") if passes(k, m[0]))


PII_ROWS = [(1, None), (2, ""), (3, "a@b.c_d@e.f x@y..z ü@é.com é1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4"),
            (4, "😀 4111 1111 1111 1111, 4111-1111-1111-1112 +1 (523) 555-1055 +49 30 1234567 +1 2"),
            (5, "9" * 20000 + " " + "1.2." * 3000 + "a" * 20000 + "@b" + ".c" * 5000), (5, "x@y.de"), (5, "x@y.de"),
            (6, 'phone 523-555-1055 ssn 123-45-6789 token = "1eb9c654e721b4f812088970e66a6345cee33dd6" a@b.com')]


def test_pii_base_spans(spark, empty):
    got = pii.find(spark.createDataFrame(PII_ROWS, "doc_id bigint, text string")).collect()
    want = sorted((i, ",".join(f"{k}:{a}:{e}" for a, _, e, k in base_spans(t))) for i, t in PII_ROWS)
    assert sorted((r["doc_id"], r["base_sha256"]) for r in got) == sorted(
        (i, hashlib.sha256(s.encode()).hexdigest()) for i, s in want)
    for r in got:
        base = {s for i, x in want if i == r["doc_id"] for s in x.split(",") if s}
        if r["doc_id"] != 5:
            assert base <= set(r["spans"].split(","))
        assert r["doc_id"] == 5 or sum(r[f"n_{k}"] for k in PATTERNS) == len(base)
    assert pii.find(empty).count() == 0


def test_pii_redaction(spark):
    rows = [(i, t, len(t or ""), "kept") for i, t in PII_ROWS if i != 5]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, _m_email string")
    got = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert got[1]["text"] is None and got[2]["text"] == "" and got[3]["_m_email"] == "kept"
    assert "[PHONE] [PHONE]" in got[4]["text"] and got[4]["n_chars"] == len(got[4]["text"])
    assert got[6]["text"].endswith("[EMAIL]") and "@" not in got[6]["text"]


def test_label_model_recovers_reliabilities():
    r = np.random.default_rng(1)
    truth = r.random(6000) < 0.4
    right = [0.95, 0.9, 0.8, 0.7, 0.6]
    v = np.stack([np.where(r.random(6000) < q, np.where(truth, 1, -1), np.where(truth, -1, 1)) for q in right], 1)
    table, p = pii.reliabilities(v, np.zeros(6000, int), np.ones(6000))
    assert ((p > 0.5) == truth).mean() > 0.95
    assert all(abs(table[1, j, 2] - q) < 0.05 for j, q in enumerate(right))


# ------------------------------------------------------------------ 4 language model

def brute_ppm(rows, order):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    trie, uni = collections.defaultdict(collections.Counter), collections.Counter()
    pad = b"\xff" * order
    raws = [(t or "").encode().lower() for _, t in rows]
    for h, raw in zip(held, raws):
        if not h:
            uni.update(raw.split())
            uni[None] += 1
            b = pad + raw + b"\xff"
            for k, j in itertools.product(range(order, len(b)), range(order + 1)):
                trie[b[k - j:k]][b[k]] += 1
    n, kinds = sum(uni.values()), len(uni)
    out = []
    for (i, _), h, raw in zip(rows, held, raws):
        tokens = raw.split() + [None]
        b, score = pad + raw + b"\xff", 0.0
        for k in range(order, len(b)):
            gone, found = set(), False
            for j in range(order, -1, -1):
                c = {a: x for a, x in trie.get(b[k - j:k], {}).items() if a not in gone}
                if c:
                    total = sum(c.values()) + len(c)
                    found = b[k] in c
                    score += math.log10((c[b[k]] if found else len(c)) / total)
                    if found:
                        break
                    gone |= set(c)
            if not found:
                score -= math.log10(256 - len(gone))
        out.append((i, h, len(tokens), sum(uni[w] > 0 for w in tokens), n,
                    sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in tokens), score))
    return out


def test_ppm(docs, spark, empty):
    got = ppm.score_documents(docs, order=3, block_bytes=9000).collect()
    rounded = lambda rows: sorted([tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in rows], key=repr)
    assert rounded(map(tuple, got)) == rounded(brute_ppm(ROWS, 3))
    assert ppm.score_documents(empty).count() == 0
    untrained = spark.createDataFrame([(None, "ab")], "doc_id bigint, text string")
    row = ppm.score_documents(untrained).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == pytest.approx(-3 * math.log10(256))


# ------------------------------------------------------------------ 5 token counts

def test_prefix_counts_equal_the_library(docs, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    got = prefix_tokens.count_tokens(docs, WORD_BPE, limit=100).collect()
    assert [r["n_tokens"] for r in got] == [count(t or "") for _, t in ROWS]
    for r, (_, t) in zip(got, ROWS):
        cut = (t or "").encode()[:r["cut_bytes"]].decode()
        assert count(cut) <= 100 and r["over_limit"] == (r["n_tokens"] > 100)
    counter = prefix_tokens.PrefixCounter(WORD_BPE)
    text = "It's We'LL naïve <|endoftext|>x 123 ΣΑΣ don't!!! " + prose(20, 8)
    assert [counter.at(text, k) for k in range(len(text) + 1)] == [count(text[:k]) for k in range(len(text) + 1)]
    table = counter.prefix_counts("tokenization")
    assert table[1:] == [count("tokenization"[:k]) for k in range(1, 13)]
    assert prefix_tokens.count_tokens(empty, WORD_BPE).count() == 0


def test_every_prefix_is_counted_and_the_cut_is_the_longest(spark):
    """Also inside words, contractions, special strings and where characters compose."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    r = random.Random(4)
    texts = ["日本語の文章には空白がない。" * 6, "".join(r.choice("abcXYZ019+/") for _ in range(150)), "internationalization" * 5,
             "they're'll ''s we'REACH <|endoftext|><|startoftext|>a<|endoftext <|x", "  a \u00a0b\n\n", "İstanbul ΣΑΣ İİ",
             unicodedata.normalize("NFD", "Việt Nam ếở 한국어문장은길다 ガギグ Ångström don't") + " q\u0307\u0323x \u0301a\u0301"]
    texts += ["".join(r.choice("ae'stL! 1é日\u0301\u0323\u1161\u1100\u11a8가İ\u0307") for _ in range(40)) for _ in range(40)]
    counter = prefix_tokens.PrefixCounter(WORD_BPE)
    for t in texts:
        every = [count(t[:k]) for k in range(len(t) + 1)]
        assert counter.running(t).tolist() == every[1:], t
        assert [counter.at(t, k) for k in range(len(t) + 1)] == every and counter.total(t) == every[-1]
        for budget in (0, 1, 7, 10 ** 6):
            assert counter.fit(t, budget) == len(t[:max(k for k in range(len(t) + 1) if every[k] <= budget)].encode())
    counter.memo_size = 3  # words come and go
    for t in texts:
        assert counter.total(t) == count(t)
    rows = prefix_tokens.count_tokens(spark.createDataFrame(enumerate(texts), "doc_id bigint, text string"), WORD_BPE, limit=10).collect()
    for x in rows:
        t = texts[x["doc_id"]]
        assert x["cut_bytes"] == len(t[:max(k for k in range(len(t) + 1) if count(t[:k]) <= 10)].encode())


def test_totals_count_no_prefixes_but_those_at_the_cut():
    counter = prefix_tokens.PrefixCounter(WORD_BPE)
    text = "It's ʼn \x1c na\u00efve tokenization'll <|endoftext|>x 123 " + prose(30, 8)
    n = counter.total(text)
    assert not counter.packed and n == counter.running(text)[-1]
    counter.packed.clear()
    counter.fit(text, n // 2)
    assert len(counter.packed) <= 1


def test_stored_counts_answer_budgets_without_the_text(docs, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(WORD_BPE)
    count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    stored = prefix_tokens.prefix_counts(docs, WORD_BPE)
    for r, (_, t) in zip(stored.collect(), ROWS):
        t = t or ""
        assert r["n_tokens"] == count(t)
        for budget in (5, 100):
            k = prefix_tokens.stored_fit(r["counts"], budget)
            assert count(t[:k]) <= budget and (k == len(t) or count(t[:k + 1]) > budget)
            assert prefix_tokens.stored_at(r["counts"], k) == count(t[:k])
    assert prefix_tokens.prefix_counts(empty, WORD_BPE).count() == 0


# ------------------------------------------------------------------ 6 SentencePiece

def test_pieces_round_trip(docs, empty):
    enc = pieces.encode_documents(docs, PIECES)
    rows = enc.collect()
    assert all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in rows)
    back = pieces.decode_documents(enc, PIECES).collect()
    assert [r["text"] for r in back] == [t or "" for _, t in ROWS]
    assert pieces.encode_documents(empty, PIECES).count() == 0


def test_pieces_viterbi_is_optimal():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = pieces.PieceCodec(PIECES)
    score = {model.id_to_piece(i): model.get_score(i) for i in range(3, model.get_piece_size()) if not model.is_byte(i)}

    def best(word):
        top = [0.0] + [-math.inf] * len(word)
        for i in range(1, len(word) + 1):
            top[i] = max((top[j] + score[word[j:i]] for j in range(i) if word[j:i] in score), default=-math.inf)
        return top[-1]

    for word in sorted(set(prose(300, 12).split())):
        got = codec.encode(word)
        if all(c in score for c in "▁" + word):
            assert sum(model.get_score(i) for i in got) == best("▁" + word)
    assert codec.encode("é\n")[-1] == model.piece_to_id("<0x0A>")


# ------------------------------------------------------------------ 7 quality classifier

def test_quality_mil(spark, empty):
    r = random.Random(2)
    rows = [(i, prose(r.randint(5, 300), i) if i % 3 else " ".join(x + "###" for x in prose(80, i).split()), i % 3 and 1)
            for i in range(300)] + [(1000, None, None), (1001, "", 1), (1002, prose(30, 1), 0), (1002, prose(30, 1), 1)]
    df = spark.createDataFrame([x[:2] for x in rows], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows] + [(None, 1)], "doc_id bigint, quality int")
    got = quality_mil.classify(df, labels, per_class=150).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, _, q in rows[:300]}
    held = [x for x in got if x["held_out"] and x["doc_id"] in truth]
    assert len(held) > 60 and all(x["predicted"] == truth[x["doc_id"]] for x in held)
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in got)
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in got)
    kept = quality_mil.keep_good(df, quality_mil.fit(df, labels, 150)).where("doc_id < 300")
    assert {x["doc_id"] % 3 for x in kept.collect()} == {1, 2} and kept.columns == df.columns
    assert quality_mil.classify(empty, labels).count() == 0
    assert {x["score"] for x in quality_mil.classify(df, labels.limit(0)).collect()} == {0.5}


def test_quality_mil_gradients():
    r = np.random.default_rng(0)
    x, starts, y, w = r.normal(size=(9, quality_mil.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0, 1]), np.ones(3)
    p = quality_mil.start_weights()
    g = quality_mil.gradients(p, x, starts, y, w)

    def loss(q):
        f = quality_mil.forward(q, x, starts)["y"]
        return -(y * np.log(f) + (1 - y) * np.log(1 - f)).mean()

    for k in p:
        q = {a: b.copy() for a, b in p.items()}
        q[k].flat[-1] += 1e-6
        assert (loss(q) - loss(p)) / 1e-6 == pytest.approx(g[k].flat[-1], abs=1e-5)


# ------------------------------------------------------------------ 8 SimHash

def brute_fingerprint(text, size=4):
    import xxhash

    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of(F.col("fp")), "component_id").collect()
    prints = [(i, brute_fingerprint(t)) for i, t in ROWS]
    parent = list(range(len(prints)))
    for _ in prints:
        for a, b in itertools.combinations(range(len(prints)), 2):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                parent[a] = parent[b] = min(parent[a], parent[b])
    least = {c: min(i for (i, _), p in zip(prints, parent) if p == c and i is not None) for c in parent}
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(i, f"{f:016x}", least[c]) for (i, f), c in zip(prints, parent)], key=repr)
    kept = sorted((r["doc_id"] for r in simhash.keep_first(docs).collect()), key=repr)
    assert kept == sorted(set(least.values()), key=repr)  # the row without an id is a copy
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0 and simhash.keep_first(docs).columns == docs.columns


def test_keep_first_tells_rows_of_one_id_apart(spark):
    a, b, c = prose(50, 70), prose(50, 71), prose(50, 72)
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (1, b, "y"), (2, a, "x"), (None, c, "x"), (None, c, "x"), (None, a, "x"), (3, c, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for _ in range(2):
        got = sorted(map(tuple, simhash.keep_first(df.repartition(3)).select("doc_id", "text").collect()))
        assert got == sorted([(1, a), (1, b), (3, c)])
    only = simhash.keep_first(df.where("doc_id IS NULL")).collect()
    assert sorted(r["text"] for r in only) == sorted([a, c])


@pytest.mark.parametrize("total", [300, 10**7])
def test_simhash_links_are_complete(spark, total):
    r = random.Random(4)
    fps = set()
    for _ in range(60):
        f = r.getrandbits(64)
        for _ in range(5):
            fps.add(f)
            f ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 4)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    n, both = simhash.bit_statistics(df)
    assert n == len(fps)
    chosen = simhash.plan(total, both * (total / n), 4)
    assert sum(t + 1 for _, t in chosen) == 5
    got = simhash.links(df, chosen, 4).collect()
    mask = (1 << 64) - 1
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= 4}
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 103), (103, 100)]
    got = {r["u"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 103: 100, 105: 100}


# ------------------------------------------------------------------ 9 chat formatting

TURNS = [(1, 0, "system", "Be <<SYS>> brief \\"), (1, 1, "user", "hi [INST]"), (1, 2, "assistant", "yo </s><s>"),
         (1, 3, "user", None), (1, 4, "assistant", "bye\n[/INST]"), (1, 5, "user", "unanswered"), (2, 0, "tool]x", "[ROLE a] b"),
         (2, None, None, "no turn"), (None, 1, "assistant", "nobody"), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a"),
         (3, 1, "assistant", "tie a")]


def test_chat_format(spark):
    df = spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string").withColumn("seq", F.lit(9))
    formatted = chat_format.format_turns(df)
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    for conv in {t[0] for t in TURNS}:
        turns = sorted([t[1:] for t in TURNS if t[0] == conv],
                       key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        said = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in turns)
        loss = "".join(x or "" for _, r, x in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    full = {(r["conv_id"], r["example"]): r for r in chat_format.expand(formatted).collect()}
    assert sum(len(r["text"]) for (c, _), r in full.items() if c == 1) == got[1]["formatted_chars"]
    second = full[1, 1]
    assert chat_format.unescape(second["text"][second["loss_start"]:second["loss_end"]]) == "bye\n[/INST]"
    assert second["text"].startswith(full[1, 0]["text"]) and chat_format.examples(formatted).count() == 6
    assert second["text"].count("</s>") == 2 and "</s><s>" not in second["text"]
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


def test_chat_turns_are_written_into_every_example(spark):
    """Each reply has an example with all turns before it, itself last and alone trainable."""
    df = spark.createDataFrame(TURNS + [(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(40)],
                               "conv_id bigint, turn bigint, role string, text string")
    rows = chat_format.format_turns(df).collect()
    held = sorted((r["example"], r["seq"]) for r in rows if r["conv_id"] == 4)
    assert held == [(k, i) for k in range(20) for i in range(2 * k + 2)]
    assert all(r["trainable"] == (r["seq"] == 2 * r["example"] + 1) for r in rows if r["conv_id"] == 4)
    assert sorted((r["example"], r["seq"]) for r in rows if r["conv_id"] == 1 and r["example"] is None) == [(None, 5)]
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    for conv in {r["conv_id"] for r in rows}:
        here = [r for r in rows if r["conv_id"] == conv]
        assert got[conv]["formatted_chars"] == sum(len(r["segment"]) for r in here if r["example"] is not None)
        assert got[conv]["n_examples"] == len({r["example"] for r in here} - {None})


@pytest.mark.parametrize("role", ["user", "assistant", "system", "", "tool", "a]b\\", "[ROLE x]"])
def test_chat_segments_parse(role):
    r = random.Random(6)
    for _ in range(200):
        text = "".join(r.choice(["</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "[ROLE", "[/ROLE]", "<", "[", "]", " ", "\n", "ok"])
                       for _ in range(r.randint(0, 8)))
        segment, a, b = chat_format.render(role, text)
        assert chat_format.parse(segment) == (role, text) and chat_format.unescape(segment[a:b]) == text
        assert not re.search(r"</?s>|\[/?INST|<</?SYS>>|\[/?ROLE", segment[a:b])


# ------------------------------------------------------------------ 10 decontamination

def brute_least(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_myers_distance():
    r = random.Random(8)
    for _ in range(200):
        p = "".join(r.choice("abc ") for _ in range(r.randint(1, 90)))
        t = "".join(r.choice("abc ") for _ in range(r.randint(0, 120)))
        assert decontaminate.Myers(p).least(t) == brute_least(p, t)


@pytest.mark.parametrize("block,rate", [(4_000_000, 0.1), (150, 0.05)])
def test_decontamination(spark, docs, empty, block, rate):
    r = random.Random(9)
    items = [(i, prose(25, 100 + i)) for i in range(8)]

    def edited(t, n):
        t = list(t)
        for _ in range(n):
            t[r.randrange(len(t))] = r.choice("qxz")
        return "".join(t)

    rows = [(100 * n + i, f"{prose(20, i)} {edited(t, n)} {prose(20, i + 50)}") for i, t in items for n in (0, 3, 6, 12, 20)]
    rows += [(9000, items[0][1].upper() + " " + items[1][1]), (9001, None), (9001, None)]
    bench = items + [items[0], (50, None), (51, ""), (None, "nothing"), (52, "!!")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(bench, "item_id bigint, text string")
    got = {x["doc_id"]: {h["item_id"]: h["distance"] for h in x["benchmark_hits"]}
           for x in decontaminate.flag(df, bench, rate, block).collect()}
    norm = decontaminate.normalise
    for i, t in rows:
        want = {}
        for item, p in items:
            d = brute_least(norm(p), norm(t))
            if d <= math.floor(rate * len(norm(p))):
                want[item] = d
        assert got[i] == want
    kept = decontaminate.drop_contaminated(docs, bench, rate, block) if block > 1000 else None
    if kept is not None:
        assert kept.count() == len(ROWS) and kept.columns == docs.columns
        assert decontaminate.report(empty, bench).count() == 0
        assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("block", [4_000_000, 200])
def test_items_without_an_id_are_searched(spark, block):
    items = [(1, prose(25, 301)), (None, prose(25, 302)), (None, prose(25, 303))]
    rows = [(i, f"{prose(20, 400 + i)} {t} {prose(20, 500 + i)}") for i, (_, t) in enumerate(items)]
    rows += [(3, rows[0][1] + " " + rows[1][1]), (4, prose(60, 304))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {x["doc_id"]: [tuple(h) for h in x["benchmark_hits"]] for x in decontaminate.flag(df, bench, 0.1, block).collect()}
    assert got == {0: [(1, 0)], 1: [(None, 0)], 2: [(None, 0)], 3: [(1, 0), (None, 0)], 4: []}
    assert [x["doc_id"] for x in decontaminate.drop_contaminated(df, bench, 0.1, block).collect()] == [4]
    if block > 1000:
        assert sorted(x["doc_id"] for x in decontaminate.report(df, bench).where("contaminated").collect()) == [0, 1, 2, 3]
