"""Substring dedup with suffix automata of reference shards.

A word goes when some ``window`` consecutive words that cover it also start in a document
with a smaller doc_id. Comparing every passage with every other is avoided by routing:

1. Equal texts become one, that of the least doc_id; every other loses all words that a
   window covers. What follows is about the rest.
2. Every window has an anchor, the least hash of its 8-word runs, which depends on the
   window's words alone. Anchors that occur in one document only are dropped.
3. Runs of windows under one shared anchor are passages; equal ones become one. An anchor is
   crowded if its distinct passages have more windows than a shard has room for. Windows under a
   crowded one are cut again, by the anchor and the window's next least run hash, then by the
   third too, at last by the window's own hash; each depends on the window's words alone,
   so equal windows meet. Again keys of one document are dropped and equal passages
   become one. What is counted are passages, by combinable aggregates over all documents.
4. Per key, passages stream in ascending doc_id through suffix automata of the reference
   shards (what came before, at most ``shard_words`` words each): the matching statistics
   give every window that an earlier document has. What no shard has yet is added to
   the last shard. Hashes only route; this comparison of words decides.
5. Decisions return to the documents by passage, and maximal spans of words are removed.

The shards of a key live in the task that its passages reach; they are not sent to
every executor, since the reference grows with the corpus. A passage held by a third of all
documents is one row after the map side. Texts travel once, compressed, to a checkpoint
partitioned by document.

Defined results: null text = empty text (no words, digest of the empty string); a null
doc_id is smaller than none and larger than none, so its text stays whole and counts for
nobody; repeated rows of a doc_id are one document; an empty table gives an empty one;
only ``doc_id`` and ``text`` are read. Whole texts of any length.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import cut, cut_by, map_batches, text_of

WINDOW = 50
RUN = 8
LEVELS = 3  # keys of a window before its own hash
SHARD_WORDS = 200_000
BASE_DDL = "doc_id bigint, tk binary, n int, blob binary, anchors array<bigint>"
PASSAGE_DDL = "doc_id bigint, tk binary, anchor bigint, digest binary, start int, n int"
CONTENT_DDL = "anchor bigint, digest binary, first_doc bigint, content binary"
RESULT_DDL = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def rolled(h: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive items."""
    out, have, base, skip = None, 0, 0x9E3779B97F4A7C15, 1
    part, n = h, len(h) - size + 1
    while skip <= size:
        if size & skip:  # append a stretch of ``skip`` items
            out = part[:n] if out is None else out * np.uint64(base) + part[have:have + n]
            have += skip
        part = part[:-skip] * np.uint64(base) + part[skip:] if 2 * skip <= size else part
        base, skip = base * base % 2**64 | 1, skip * 2
    out = out ^ (out >> np.uint64(31))
    return out * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: list[bytes]) -> np.ndarray:
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def least_in(x: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` consecutive items."""
    out, have = x, 1
    while 2 * have <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(x) - size + 1], out[size - have:]) if have < size else out


def anchors_of(h: np.ndarray, window: int) -> np.ndarray:
    """The anchor of every window."""
    return least_in(rolled(h, RUN), window - RUN + 1).view(np.int64)


def keys_of(h: np.ndarray, at: np.ndarray, window: int) -> list[np.ndarray]:
    """Of the windows that start at ``at`` the anchor, and the keys that add the second and third
    least distinct run hash (the largest again where there are no more)."""
    view, out, key = np.lib.stride_tricks.sliding_window_view(rolled(h, RUN), window - RUN + 1), [], None
    for a in range(0, max(1, len(at)), 4096):
        r = np.sort(view[at[a:a + 4096]], axis=1)
        new = np.cumsum(np.diff(r, axis=1, prepend=r[:, :1]) != 0, axis=1)
        for level in range(LEVELS):
            pick = r[np.arange(len(r)), np.minimum((new < level).sum(axis=1), r.shape[1] - 1)]
            key = pick if not level else mixed(key, pick)
            if a:
                out[level] = np.r_[out[level], key.view(np.int64)]
            else:
                out.append(key.view(np.int64))
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def runs(flags: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
    """Maximal [from, to) with the flag set and one value."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    new = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(values[at]) != 0)])
    return list(zip(at[new].tolist(), (at[np.r_[new[1:], len(at)] - 1] + 1).tolist()))


class SuffixAutomaton:
    """Of word sequences. ``windows`` tells which windows of a sequence it has."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.words = 0

    def add(self, words: list[bytes]) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for w in words:
            old = nxt[last].get(w)
            if old is not None:  # another sequence has this prefix
                if size[old] == size[last] + 1:
                    last = old
                else:
                    last = self.clone(last, old, w)
                continue
            cur = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                link[cur] = q if size[q] == size[p] + 1 else self.clone(p, q, w)
            last = cur
        self.words += len(words)

    def clone(self, p: int, q: int, w: bytes) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def windows(self, words: list[bytes], window: int) -> np.ndarray:
        """Matching statistics: item i says whether words[i:i+window] is in the automaton."""
        nxt, link, size = self.next, self.link, self.size
        out = np.zeros(max(0, len(words) - window + 1), bool)
        state = have = 0
        for i, w in enumerate(words, 1 - window):
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                have = size[state]
                to = nxt[state].get(w)
            if to is None:
                have = 0
            else:
                state, have = to, have + 1
                if have >= window:
                    out[i] = True
        return out


class Reference:
    """Shards of what smaller documents have under one anchor."""

    def __init__(self, window: int, shard_words: int):
        self.window, self.shard_words, self.shards = window, shard_words, []

    def seen(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words) - self.window + 1, bool)
        for shard in self.shards:
            out |= shard.windows(words, self.window)
        return out

    def add(self, words: list[bytes], seen: np.ndarray) -> None:
        for a, b in runs(~seen, np.zeros(len(seen), np.int8)):
            if not self.shards or self.shards[-1].words >= self.shard_words:
                self.shards.append(SuffixAutomaton())
            self.shards[-1].add(words[a:b + self.window - 1])


def unpack(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split()


def prepared(docs: DataFrame, window: int) -> DataFrame:
    """Per row: the digest of its words, their number, they themselves, compressed, and the
    distinct anchors of their windows."""

    def init():
        def step(cols):
            out = {c.split()[0]: [] for c in BASE_DDL.split(", ")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                words = text.encode().split()
                line = b" ".join(words)
                found = (np.unique(anchors_of(word_hashes(words), window)).tolist()
                         if len(words) >= window and doc_id is not None else [])
                for k, v in zip(out, (doc_id, hashlib.blake2b(line, digest_size=16).digest(), len(words),
                                      zlib.compress(line, 1), found)):
                    out[k].append(v)
            return out
        return step

    return map_batches(text_of(docs, "doc_id"), init, BASE_DDL, rows=256)


def level_keys(h: np.ndarray, window: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of every window at the level before and at this one."""
    if not level:
        anchors = anchors_of(h, window)
        return anchors, anchors
    keys = [*keys_of(h, np.arange(max(0, len(h) - window + 1)), window), rolled(h, window).view(np.int64)]
    return keys[level - 1], keys[level]


def passages(rows: DataFrame, window: int, level: int) -> DataFrame:
    """Of rows with the ``keys`` that their windows had at the level before (at the first: the
    shared anchors) the runs of such windows under one key of this level."""

    def init():
        def step(cols):
            out = {c.split()[0]: [] for c in PASSAGE_DDL.split(", ")}
            for doc_id, tk, blob, keys in zip(*(cols[c] for c in ("doc_id", "tk", "blob", "keys"))):
                words = unpack(blob)
                before, own = level_keys(word_hashes(words), window, level)
                for a, b in runs(np.isin(before, keys), own):
                    digest = hashlib.blake2b(b" ".join(words[a:b + window - 1]), digest_size=16).digest()
                    for k, v in zip(out, (doc_id, tk, int(own[a]), digest, a, b - a)):
                        out[k].append(v)
            return out
        return step

    return map_batches(rows.select("doc_id", "tk", "blob", "keys"), init, PASSAGE_DDL, rows=128)


def weighed(found: DataFrame, most: int, hot: int) -> DataFrame:
    """Keys that two documents have, and whether they are crowded: more than ``hot`` passages, with more
    than ``most`` windows in the distinct ones."""
    distinct = found.groupBy("anchor", "digest").agg(
        F.max("n").alias("windows"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("times"))
    return (distinct.groupBy("anchor").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("windows").alias("windows"),
                                           F.sum("times").alias("times"))
            .where("lo < hi").select("anchor", ((F.col("windows") > most) & (F.col("times") > hot)).alias("crowded")))


def contents_of(whole: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """The words of every distinct passage, from the first document that has it."""
    first = (found.groupBy("anchor", "digest").agg(F.min(F.struct("doc_id", "tk", "start", "n")).alias("w"))
             .groupBy("w.doc_id", "w.tk").agg(F.collect_list(F.struct("anchor", "digest", "w.start", "w.n")).alias("wanted")))
    rows = whole.select("doc_id", "tk", "blob").join(first, ["doc_id", "tk"])

    def init():
        def step(cols):
            out = {c.split()[0]: [] for c in CONTENT_DDL.split(", ")}
            for doc_id, blob, wanted in zip(cols["doc_id"], cols["blob"], cols["wanted"]):
                words = unpack(blob)
                for w in wanted:
                    content = b" ".join(words[w["start"]:w["start"] + w["n"] + window - 1])
                    for k, v in zip(out, (w["anchor"], w["digest"], doc_id, content)):
                        out[k].append(v)
            return out
        return step

    return map_batches(rows.select("doc_id", "blob", "wanted"), init, CONTENT_DDL, rows=128)


def decide(contents: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Per passage and its first document: the windows that smaller documents have."""
    ordered = contents.repartition("anchor").sortWithinPartitions("anchor", "first_doc", "digest")

    def init():
        state = {"anchor": None, "doc": None, "reference": None, "waiting": []}

        def step(cols):
            out = {"anchor": [], "digest": [], "first_doc": [], "hits": []}
            for anchor, digest, doc, content in zip(*(cols[c] for c in ("anchor", "digest", "first_doc", "content"))):
                if anchor != state["anchor"]:
                    state.update(anchor=anchor, doc=doc, reference=Reference(window, shard_words), waiting=[])
                if doc != state["doc"]:  # only smaller documents are reference
                    for words, seen in state["waiting"]:
                        state["reference"].add(words, state["reference"].seen(words) | seen)
                    state.update(doc=doc, waiting=[])
                words = content.split()
                seen = state["reference"].seen(words)
                if not seen.all():
                    state["waiting"].append((words, seen))
                out["anchor"].append(anchor)
                out["digest"].append(digest)
                out["first_doc"].append(doc)
                out["hits"].append([x for r in runs(seen, np.zeros(len(seen), np.int8)) for x in r])
            return out
        return step

    return map_batches(ordered, init, "anchor bigint, digest binary, first_doc bigint, hits array<int>", rows=512)


def removed(rows: DataFrame, window: int, with_text: bool) -> DataFrame:
    def init():
        def step(cols):
            out = {"doc_id": cols["doc_id"], "n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for blob, spans in zip(cols["blob"], cols["spans"]):
                words = unpack(blob)
                n = len(words)
                if spans:
                    edge = np.zeros(n + 1, np.int64)
                    for s in spans:
                        np.add.at(edge, np.array(s[::2]), 1)
                        np.add.at(edge, np.array(s[1::2]) + window - 1, -1)
                    gone = np.cumsum(edge)[:n] > 0
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                line = b" ".join(words)
                out["n_words"].append(n)
                out["n_removed"].append(n - len(words))
                out["kept_sha256"].append(hashlib.sha256(line).hexdigest())
                out["kept_text"].append(line.decode() if with_text else None)
            return out
        return step

    return map_batches(rows.select("doc_id", "blob", "spans"), init,
                       RESULT_DDL + (", kept_text string" if with_text else ""), rows=256)


def dedup(docs: DataFrame, window: int = WINDOW, hot: int = 0, shard_words: int = SHARD_WORDS,
          with_text: bool = True) -> DataFrame:
    """Per row: words, words removed, digest of what is kept and (``with_text``) the kept words.
    ``hot``: a key with no more passages than that is never cut again."""
    key = ["doc_id", "tk"]
    base = cut_by(prepared(docs, window), *key)
    first = cut(base.where("doc_id IS NOT NULL").groupBy("tk").agg(F.min("doc_id").alias("doc_id")))
    whole = base.join(first, key, "left_semi")  # of equal texts the first; the others lose all
    met = whole.select(*key, F.explode("anchors").alias("anchor")).distinct()  # in place: no exchange
    shared = met.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    by_doc = cut(met.join(shared, "anchor").groupBy(*key).agg(F.collect_list("anchor").alias("keys")))
    occurrences, contents = [], []
    for level in range(LEVELS + 1):
        found = cut(passages(whole.select(*key, "blob").join(by_doc, key), window, level))
        keys = cut(weighed(found, max(1, shard_words // window), hot))
        if level == LEVELS:  # a window's own hash: nothing is left to cut
            keys = keys.withColumn("crowded", F.lit(False))
        fine = found.join(keys.where(~F.col("crowded")), "anchor", "left_semi")
        occurrences.append(fine)
        contents.append(contents_of(whole, fine, window))
        if keys.where("crowded").isEmpty():
            break
        by_doc = cut(found.join(keys.where("crowded"), "anchor", "left_semi").groupBy(*key).agg(F.collect_set("anchor").alias("keys")))
    decisions = cut(decide(reduce(DataFrame.unionByName, contents), window, shard_words))
    spans = (reduce(DataFrame.unionByName, occurrences).join(decisions, ["anchor", "digest"])
             .select(*key, F.when(F.col("doc_id") > F.col("first_doc"), F.array("start", F.col("start") + F.col("n")))
                     .otherwise(F.transform("hits", lambda x: x + F.col("start"))).alias("span"))
             .where(F.size("span") > 0).groupBy(*key).agg(F.collect_set("span").alias("spans")))
    last = F.col("n") - window + 1
    spans = first.join(spans, key, "left").withColumn("spans", F.coalesce("spans", F.expr("array()")))
    rows = base.join(spans, key, "left").withColumn("spans", F.when(
        F.col("spans").isNotNull() | F.col("doc_id").isNull(), F.col("spans")).when(
        last > 0, F.array(F.array(F.lit(0), last))))
    return removed(rows, window, with_text)
