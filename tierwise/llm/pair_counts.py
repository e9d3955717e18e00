"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs.

A byte-level BPE (A) and a SentencePiece model (B) encode the same text; offsets where tokens
of both end cut them into groups, and two tokens are linked if their bytes overlap. How
many documents link a pair of ids is counted by minimal perfect hashing:

1. First pass: every task aligns its documents and keeps, per pair, in how many of its
   documents it is linked. These lists, sorted and cut into ``BUCKETS`` buckets by a hash
   of the pair, are written once; all that follows works on them.
2. The distinct pairs of a bucket are united by a tree over the tasks (``FAN`` lists at a
   time), then get a minimal perfect hash: levels of bits, in each of which the pairs that
   no other collides with find their place; the rank of its bit is a pair's slot.
3. Counts are dense vectors indexed by slot, one per bucket, summed by the same tree. A
   table of the pair of each slot verifies what is looked up later: a pair that is no key
   has count 0.
4. Second pass: documents are aligned again and look their links up. The function, keys and
   counts reach the tasks in blocks of at most ``block_bytes`` (or one bucket); the
   partial sums of a block are written before the next one starts, so a task never holds two.

The number of pairs is bounded by the two vocabularies, not by the corpus, and a bucket by
its share of that. The highest count of each A id is one vector as long as A's vocabulary.

Text is encoded by stretches that start at white space after other text. No token of either
vocabulary crosses such a border (checked for B's pieces when the model is read; A's
pre-tokenizer cuts there), so tokens, groups and links of a text are those of its stretches.
A worker process keeps the tokenizers and between ``memo`` and twice as many distinct
stretches from one task of a query to the next.

Defined results: texts that are null or empty, or that either tokenizer doesn't give
back byte for byte after a leading space, have no tokens: zeros and an empty string.
Every row is a document, repeated rows and null doc_ids too; an empty table gives
an empty one; only ``doc_id`` and ``text`` are read. Whole texts of any length.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import cut, map_batches, text_of
from tierwise.llm.prefix_tokens import byte_alphabet

BUCKETS = 64
FAN = 32
BLOCK_BYTES = 64 << 20
RESULT_DDL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
              "count_sum bigint, groups_sha256 string")
LIST_DDL = "bucket int, node bigint, pairs binary, counts binary"
# White space as both tokenizers' patterns know it (Unicode's White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BORDER = " \n\t"
# A's pre-tokenizer as its file states it, and the pattern that this kind stands for.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STRETCH = re.compile(rf"[{WHITE}]*(?:[^{WHITE}]+(?:(?![{BORDER}])[{WHITE}]+)?)*")
# Characters that need the pattern; isspace() knows these and four separators more.
OTHER = re.compile(f"[\x1c-\x1f\t\x0b-\r{WHITE[4:]}]".replace(" ", ""))
SHIFT = 32  # a pair is (A id << 32) | B id


def keys_of(text: str) -> list[str]:
    """The stretches of a space and the text; without the space that most begin with, unless white
    space follows it. (No text: none.)"""
    if not text:
        return []
    if (OTHER.search(text) or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
            or text[0] in " \n" or text[-1] in " \n"):
        return [s if s[0] != " " or len(s) == 1 or s[1].isspace() else s[1:]
                for s in STRETCH.findall(" " + text)[:-1]]  # the last match is empty
    return text.replace("\n", " \n").split(" ")  # every space and line end is a border


class Aligner:
    """Aligns texts; remembers distinct stretches. ``look`` maps pairs to their counts and whether
    these are the highest of their A ids (second pass)."""

    def __init__(self, a_path: str, b_path: str, memo: int = 250_000, look: Callable | None = None, listed: bool = True):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, cut_by = spec["model"]["vocab"], spec["pre_tokenizer"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        special = {t["content"] for t in spec["added_tokens"]}
        if (spec["normalizer"] is not None or cut_by != BYTE_LEVEL or len(vocab.keys() - special) != 256 + len(merges)
                or any(vocab[x + y] != 256 + i for i, (x, y) in enumerate(merges))):
            raise ValueError(f"{a_path}: not a byte-level BPE whose ids are in merge order")
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = piece.encode() if piece in special else bytes(map(byte_of.get, piece))
        self.a = tiktoken.Encoding("a", pat_str=PIECE, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for piece, i in vocab.items() if piece not in special})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                        for i, p in enumerate(pieces)]
        crossing = re.compile(f"[^{WHITE}\u2581][\u2581\n\t]")
        if any(map(crossing.search, pieces)) or len(self.b.encode("a")) != 1:
            raise ValueError(f"{b_path}: pieces go on after white space; texts can't be cut there")
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # Text of an id with what may follow it: a comma, A's bar; B's semicolon, the stretch's end.
        self.shown = [f"{i}{mark}" for n, marks in ((len(self.a_bytes), ",|"), (len(pieces), ",;\n"))
                      for i in range(n) for mark in marks]
        self.memo, self.look, self.listed, self.lost, self.young, self.old = memo, look, listed, False, {}, {}

    def entries(self, stretches: list[str]) -> list[tuple | None]:
        """Per stretch n_a, n_b, groups, their text, linked pairs (int64, packed, with repetitions),
        links of the highest count, sum of counts; None if one of both doesn't give it back."""
        # For A they are laid end to end: each begins at a border. Those that end in white space,
        # which would go on, come last, each by itself. After a letter B puts no space before.
        loose = [i for i, s in enumerate(stretches) if s[-1].isspace() or len(s) > 10_000]
        order = list(range(len(stretches)))
        if loose:
            last = set(loose)
            order = [i for i in order if i not in last] + loose
            stretches = [stretches[i] for i in order]
        n = len(stretches) - len(loose)
        a = self.a.encode_ordinary("".join(stretches[:n])) if n else []
        for s in stretches[n:]:
            a += self.a.encode_ordinary(s)
        lines = list(map(str.encode, stretches))
        line, sizes = b"".join(lines), np.fromiter(map(len, lines), np.int64, len(lines))
        if b"".join(map(self.a_bytes.__getitem__, a)) != line:
            raise ValueError("the tokenizer of A lost text")
        b = self.b.encode(["a" + s for s in stretches], num_threads=1)
        a, counts = np.array(a, np.int64), np.fromiter(map(len, b), np.int64, len(b))
        ids = np.fromiter(itertools.chain.from_iterable(b), np.int64, int(counts.sum()))
        ids = np.delete(ids, counts.cumsum() - counts)  # the letter
        if b"".join(map(self.b_bytes.__getitem__, ids.tolist())) == line:
            whole = [True] * len(lines)
        else:
            whole = [b"".join([self.b_bytes[x] for x in own[1:]]) == s for own, s in zip(b, lines)]
            keep = np.array(whole)
            ids = ids[np.repeat(keep, counts - 1)]
            a = a[keep[np.searchsorted(sizes.cumsum(), self.a_size[a].cumsum())]]
            sizes = sizes[keep]
        out: list[tuple | None] = [None] * len(stretches)
        for i, e in zip(itertools.compress(order, whole), self.aligned(sizes, a, ids)):
            out[i] = e
        return out

    def aligned(self, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple]:
        """The entries of stretches of ``sizes`` bytes laid end to end; ``a`` and ``b`` encode them."""
        if not len(sizes):
            return []
        stops = sizes.cumsum()
        a_end, b_end = self.a_size[a].cumsum(), self.b_size[b].cumsum()
        at = np.searchsorted(b_end, a_end)
        closes = b_end[at] == a_end
        border = a_end[closes]
        a_group, b_group = np.searchsorted(border, a_end), np.searchsorted(border, b_end)
        a_stop, b_stop = np.searchsorted(a_end, stops) + 1, np.searchsorted(b_end, stops) + 1
        n_a, n_b = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        n_groups = np.diff(closes.cumsum()[a_stop - 1], prepend=0)
        shown = [""] * len(sizes)
        if self.listed:  # the text of a group is its A ids, then its B ids
            order = np.empty(len(a) + len(b), np.int64)
            order[np.arange(len(a)) + np.r_[0, np.bincount(b_group).cumsum()][a_group]] = 2 * a + closes
            mark = np.r_[np.diff(b_group) != 0, True].astype(np.int64)
            mark[b_stop - 1] = 2
            order[np.arange(len(b)) + np.bincount(a_group).cumsum()[b_group]] = 2 * len(self.a_bytes) + 3 * b + mark
            shown = "".join(map(self.shown.__getitem__, order.tolist())).split("\n")
        # The B tokens that overlap an A token: from the first that ends after its start to
        # the first that ends at or after its end.
        first = np.searchsorted(b_end, np.r_[0, a_end[:-1]], "right")
        links = at - first + 1
        upto = links.cumsum()
        pairs = np.repeat(a, links) << SHIFT | b[np.arange(upto[-1]) - np.repeat(upto - links - first, links)]
        ends = upto[a_stop - 1]
        best = total = np.zeros(len(sizes), np.int64)
        if self.look:
            counts, highest = self.look(pairs)
            best, total = (np.diff(x.cumsum()[ends - 1], prepend=0) for x in (highest.astype(np.int64), counts))
        packed, ends = pairs.astype("<i8").tobytes(), (8 * ends).tolist()
        links = [packed[x:y] for x, y in zip([0, *ends], ends)]
        return list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), shown, links, best.tolist(), total.tolist()))

    def batch(self, texts: list[str]) -> list[list[tuple]]:
        """Per text the entries of its stretches; none if it has no tokens."""
        cut_up = list(map(keys_of, texts))
        if len(self.young) > self.memo:  # what was not met since the last time goes
            self.young, self.old = {}, self.young
        fresh = set().union(*cut_up) - self.young.keys()
        known = [s for s in fresh if s in self.old]
        self.young.update(zip(known, map(self.old.__getitem__, known)))
        if fresh := list(fresh.difference(known)):
            new = self.entries([s if s[0].isspace() else f" {s}" for s in fresh])
            self.lost = self.lost or None in new
            self.young.update(zip(fresh, new))
        out = [list(map(self.young.__getitem__, stretches)) for stretches in cut_up]
        for s in fresh:
            if len(s) > 64:
                del self.young[s]
        return [[] if None in found else found for found in out] if self.lost else out


KEPT: dict[str, Aligner] = {}


def kept(run: str, make: Callable[[], Aligner]) -> Aligner:
    """The worker's aligner for this pass of a query; that of another one goes."""
    if run not in KEPT:
        KEPT.clear()
        KEPT[run] = make()
    return KEPT[run]


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64((salt * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs, 1000) >> np.uint64(40)).astype(np.int64) % BUCKETS


def united(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    out, at = np.unique(np.concatenate(keys), return_inverse=True)
    return out, np.bincount(at, np.concatenate(counts), len(out)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of buckets of distinct keys: ``slots`` gives numbers from 0 on,
    bucket by bucket. Level i of a bucket has ``sizes[bucket, i]`` bits."""

    def __init__(self, sizes: list[list[int]], bits: np.ndarray):
        self.depth = max(map(len, sizes), default=0)
        self.sizes = np.zeros((len(sizes), max(self.depth, 1)), np.int64)
        for row, own in zip(self.sizes, sizes):
            row[:len(own)] = own
        self.base = np.cumsum(self.sizes.ravel()).reshape(self.sizes.shape) - self.sizes
        self.words = np.frombuffer(np.packbits(bits, bitorder="little").tobytes().ljust(-(-len(bits) // 64) * 8, b"\0"), "<u8")
        self.before = np.cumsum(np.bitwise_count(self.words), dtype=np.int64) - np.bitwise_count(self.words)

    @staticmethod
    def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Sizes of the levels and their bits: a key stays at the first level where no other one
        still unplaced falls on its bit."""
        sizes, bits = [], [np.empty(0, bool)]
        while len(keys):
            size = 64 * (1 + len(keys) // 32)
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            keys = keys[~alone[at]]
        return sizes, np.concatenate(bits)

    def slots(self, keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The slot of every key; any slot or -1 for what is no key."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.depth):
            size = self.sizes[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = self.base[bucket[left], level] + (mixed(keys[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return out


def linked_pairs(docs: DataFrame, a_path: str, b_path: str, most: int = 2_000_000) -> DataFrame:
    """First pass: per task and bucket the pairs and in how many of the task's documents each is
    linked. A task that has ``most`` pairs writes them and starts anew."""

    run = uuid.uuid4().hex

    def init():
        aligner = kept(run, lambda: Aligner(a_path, b_path, listed=False))
        node = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [0]

        def listed() -> dict:
            pairs, counts = united(*zip(*held)) if held else united([], [])
            bucket = bucket_of(pairs)
            out = {c.split()[0]: [] for c in LIST_DDL.split(", ")}
            for b in np.unique(bucket).tolist():
                own = bucket == b
                for c, v in zip(out, (b, node, pairs[own].astype("<i8").tobytes(), counts[own].astype("<i8").tobytes())):
                    out[c].append(v)
            held.clear()
            waiting[0] = 0
            return out

        def step(cols):
            for found in aligner.batch(cols["text"]):
                if found:
                    pairs = np.unique(np.frombuffer(b"".join({e[4] for e in found}), "<i8"))
                    held.append((pairs, np.ones(len(pairs), np.int64)))
                    waiting[0] += len(pairs)
            if waiting[0] > 2 * most:
                held[:] = [united(*zip(*held))]
                waiting[0] = len(held[0][0])
            return listed() if waiting[0] > most else None

        step.end = listed
        return step

    return map_batches(docs.select("text"), init, LIST_DDL, rows=256)


def tree(rows: DataFrame, join: Callable, cols: list[str], nodes: int, fan: int = FAN) -> DataFrame:
    """One row per bucket out of one per bucket and node: ``join`` takes the binary columns of
    two rows as arrays and gives those of their union; ``fan`` nodes meet at a time,
    streamed, until one is left."""
    ddl = "bucket int, node bigint, " + ", ".join(f"{c} binary" for c in cols)

    def init():
        held: dict = {"key": None, "part": None}

        def out() -> dict:
            if held["key"] is None:
                return {}
            return {"bucket": [held["key"][0]], "node": [held["key"][1]],
                    **{c: [v.astype("<i8").tobytes()] for c, v in zip(cols, held["part"])}}

        def step(batch):
            done: list[dict] = []
            for key, part in zip(zip(batch["bucket"], batch["node"]), zip(*(batch[c] for c in cols))):
                part = tuple(np.frombuffer(x, "<i8") for x in part)
                if key == held["key"]:
                    held["part"] = join(held["part"], part)
                else:
                    done.append(out())
                    held.update(key=key, part=join(None, part))
            done = [x for x in done if x]
            return {c: [v for x in done for v in x[c]] for c in ["bucket", "node", *cols]} if done else None

        step.end = out
        return step

    while True:
        nodes = -(-nodes // fan)
        rows = rows.select("bucket", F.floor(F.col("node") / fan).cast("bigint").alias("node"), *cols)
        rows = map_batches(rows.repartition("bucket", "node").sortWithinPartitions("bucket", "node"), init, ddl, rows=16)
        if nodes <= 1:
            return rows


def perfect_hashes(keys: DataFrame) -> DataFrame:
    """Per bucket the sizes and bits of the levels, and the key of each slot."""

    def init():
        def step(batch):
            out = {"bucket": batch["bucket"], "sizes": [], "bits": [], "keys": []}
            for blob in batch["pairs"]:
                keys = np.frombuffer(blob, "<i8")
                sizes, bits = PerfectHash.build(keys)
                by_slot = np.empty_like(keys)
                by_slot[PerfectHash([sizes], bits).slots(keys, np.zeros(len(keys), np.int64))] = keys
                out["sizes"].append(sizes)
                out["bits"].append(np.packbits(bits, bitorder="little").tobytes())
                out["keys"].append(by_slot.astype("<i8").tobytes())
            return out
        return step

    return map_batches(keys.select("bucket", "pairs"), init,
                       "bucket int, sizes array<bigint>, bits binary, keys binary", rows=1)


def dense_counts(lists: DataFrame, hashes: DataFrame) -> DataFrame:
    """Per list its counts as a vector indexed by slot."""

    def init():
        def step(batch):
            out = {"bucket": batch["bucket"], "node": batch["node"], "counts": []}
            for pairs, counts, sizes, bits, n in zip(*(batch[c] for c in ("pairs", "counts", "sizes", "bits", "n"))):
                keys = np.frombuffer(pairs, "<i8")
                hashed = PerfectHash([sizes], unpacked(bits, sizes))
                vector = np.zeros(n, np.int64)
                vector[hashed.slots(keys, np.zeros(len(keys), np.int64))] = np.frombuffer(counts, "<i8")
                out["counts"].append(vector.astype("<i8").tobytes())
            return out
        return step

    small = hashes.select("bucket", "sizes", "bits", (F.octet_length("keys") / 8).cast("bigint").alias("n"))
    return map_batches(lists.join(small, "bucket").select("bucket", "node", "pairs", "counts", "sizes", "bits", "n"),
                       init, "bucket int, node bigint, counts binary", rows=16)


def highest(model: DataFrame, n_a: int) -> DataFrame:
    """One row: the highest count of every A id, ``n_a`` of them."""

    def init():
        def step(batch):
            out = {"bucket": [0] * len(batch["keys"]), "node": batch["bucket"], "counts": []}
            for keys, counts in zip(batch["keys"], batch["counts"]):
                most = np.zeros(n_a, np.int64)
                np.maximum.at(most, np.frombuffer(keys, "<i8") >> SHIFT, np.frombuffer(counts, "<i8"))
                out["counts"].append(most.astype("<i8").tobytes())
            return out
        return step

    rows = map_batches(model.select("bucket", "keys", "counts"), init, "bucket int, node bigint, counts binary", rows=4)
    return tree(rows, lambda x, y: (y[0] if x is None else np.maximum(x[0], y[0]),), ["counts"], BUCKETS)


def unpacked(bits: bytes, sizes: list[int]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes), bitorder="little").astype(bool)


def count_pairs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per bucket a minimal perfect hash of its distinct pairs, the pair of each slot and the
    number of documents that hold it linked: bucket, sizes, bits, keys, counts."""
    lists = cut(linked_pairs(docs, a_path, b_path))
    nodes = 1 + (lists.agg(F.max("node")).first()[0] or 0)
    none = np.empty(0, np.int64)
    keys = tree(lists, lambda x, y: (np.union1d(none if x is None else x[0], y[0]),), ["pairs"], nodes)
    hashes = cut(perfect_hashes(keys))
    sums = tree(dense_counts(lists, hashes), lambda x, y: (y[0] if x is None else x[0] + y[0],), ["counts"], nodes)
    return cut(hashes.join(sums.select("bucket", "counts"), "bucket"))


def blocks_of(model: DataFrame, most: int) -> list[list[int]]:
    """Buckets put together to blocks of at most ``most`` bytes; a larger bucket is its own block."""
    out, held = [], 0
    for bucket, size in sorted(model.select("bucket", 2 * F.octet_length("keys") + F.octet_length("bits")).collect()):
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(bucket)
        held += size
    return out or [[]]


def align(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, with_text: bool = True) -> DataFrame:
    """Per row the numbers of tokens, groups and links, how many links have the highest count
    of their A id, the sum of their counts, and the digest of the groups (``with_text``: the
    groups themselves)."""
    rows = text_of(docs, "doc_id")
    sc = docs.sparkSession.sparkContext
    model = count_pairs(rows, a_path, b_path)
    n_a = Aligner(a_path, b_path).a_size.size
    top = highest(model, n_a).first()
    top = sc.broadcast(top["counts"] if top else b"\0" * 8 * n_a)
    blocks = blocks_of(model, block_bytes)
    rows = rows.select("*", F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"))
    for i, block in enumerate(blocks):
        part = sorted(map(tuple, model.where(F.col("bucket").isin(block)).select(
            "bucket", "sizes", "bits", "keys", "counts").collect())) if block else []
        last = i == len(blocks) - 1
        rows = looked_up(rows, a_path, b_path, sc.broadcast(part), top, last, with_text)
        if not last:
            rows = cut(rows)
    return rows


def looked_up(rows: DataFrame, a_path: str, b_path: str, part, top, last: bool, with_text: bool) -> DataFrame:
    """Adds one block's counts to the sums; the last block gives the result."""
    partial = "doc_id bigint, text string, n_best bigint, count_sum bigint"
    ddl = RESULT_DDL + (", groups string" if with_text else "") if last else partial

    run = uuid.uuid4().hex

    def fresh() -> Aligner:
        own = part.value
        place = np.full(BUCKETS, -1, np.int64)
        place[[p[0] for p in own]] = range(len(own))
        hashed = PerfectHash([p[1] for p in own], np.concatenate([unpacked(p[2], p[1]) for p in own] or [np.empty(0, bool)]))
        keys = np.frombuffer(b"".join(p[3] for p in own), "<i8")
        counts = np.frombuffer(b"".join(p[4] for p in own), "<i8")
        most = np.frombuffer(top.value, "<i8")

        def look(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found = np.zeros(len(pairs), np.int64)
            bucket = place[bucket_of(pairs)]
            own = np.flatnonzero(bucket >= 0)
            slot = hashed.slots(pairs[own], bucket[own])
            own, slot = own[slot >= 0], slot[slot >= 0]
            key = keys[slot] == pairs[own]  # verified
            found[own[key]] = counts[slot[key]]
            return found, (found > 0) & (found == most[pairs >> SHIFT])

        return Aligner(a_path, b_path, look=look, listed=last)

    def init():
        aligner = kept(run, fresh)

        def step(cols):
            out = {c.split()[0]: [] for c in ddl.split(", ")}
            for doc_id, text, best, total, found in zip(*(cols[c] for c in ("doc_id", "text", "n_best", "count_sum")),
                                                        aligner.batch(cols["text"])):
                n_a, n_b, groups, listed, pairs, hits, sums = zip(*found) if found else [()] * 7
                best, total = best + sum(hits), total + sum(sums)
                if last:
                    line = ";".join(listed)
                    row = (doc_id, sum(n_a), sum(n_b), sum(groups), sum(map(len, pairs)) // 8, best, total,
                           hashlib.sha256(line.encode()).hexdigest() if found else "", line)
                else:
                    row = (doc_id, text, best, total)
                for c, v in zip(out, row):
                    out[c].append(v)
            return out
        return step

    return map_batches(rows, init, ddl, rows=256)
