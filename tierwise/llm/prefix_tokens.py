r"""Token counts at every prefix of a text, for a byte-level BPE with word ends.

For a piece of text that the tokenizer never splits further, dynamic programming over
its bytes finds the last token of the encoding of every prefix: token t may follow the
encoding of the prefix before it exactly if that encoding's last token and t would not
be merged across their border ("compatible"). One pass gives the exact token count of
every prefix. A text adds the sums over its words, of which every distinct one keeps its count: the
words up to a place or a budget are found by their sums, then the place within one word by the
counts of that word's prefixes. ``prefix_counts`` writes the counts of all
prefixes of every text, packed; ``stored_at`` and ``stored_fit`` answer truncation and budget
questions from these without text or tokenizer.

Defined results: a null or empty text has 0 tokens; a special string in a text is one
token (the library's default); repeated rows give repeated results; an empty table gives
an empty one; only ``doc_id`` and ``text`` are read. Long texts are walked word by
word. A worker keeps the tokenizer and between ``memo`` and twice as many words from one task
to the next; those not met for longest go.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
import zlib
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame

from tierwise.llm.common import map_batches, text_of

END = "</w>"
DDL = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_bytes bigint"

COUNT = np.dtype("<u4")
WORDS = re.compile(r"[^ \t-\r]+")
# A character and what may compose with it.
CLUSTER = regex.compile(r"(?s).[\p{M}\u1160-\u11FF]*")
CONTRACTION = regex.compile(r"'\p{L}")


def at_chars(piece: str, ends: list[int]) -> list[int]:
    """Of the counts at every byte those after each character."""
    if len(ends) == len(piece) + 1:
        return ends[1:]
    return [ends[i] for i in itertools.accumulate(len(c.encode()) for c in piece)]


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level BPE vocabularies: printable bytes
    stand for themselves, the others for code points from 256 on, in byte order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PrefixCounter:
    def __init__(self, path: str, memo: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if (model["type"], model.get("end_of_word_suffix"), spec["normalizer"]["normalizers"][0]["type"]) != \
                ("BPE", END, "NFC"):
            raise ValueError(f"{path}: not a BPE with word ends over NFC text")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.table = {i: c for i, c in enumerate(byte_alphabet())}
        # Ranks by merge order: symbols that no merge makes come first.
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {a + b for a, b in merges}
        base = [t for t in sorted(model["vocab"], key=model["vocab"].get) if t not in made]
        self.rank = {t: i for i, t in enumerate(base)}
        self.halves = [(i, i) for i in range(len(base))]
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a + b not in self.rank:
                self.rank[a + b] = len(self.halves)
                self.halves.append((self.rank[a], self.rank[b]))
            self.joined.setdefault((self.rank[a], self.rank[b]), self.rank[a + b])
        # Automaton of the vocabulary: per state its next ones and the tokens that end in it,
        # longest first, as (size, rank): those inside a word and those at a word's end.
        self.next: list[dict[str, int]] = [{}]
        self.inside: list[tuple] = [()]
        self.final: list[tuple] = [()]
        for token, rank in self.rank.items():
            state, text = 0, token.removesuffix(END)
            for c in text:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.inside.append(())
                    self.final.append(())
                state = self.next[state][c]
            (self.final if token.endswith(END) else self.inside)[state] = ((len(text), rank),)
        self.fail = [0] * len(self.next)
        queue = list(self.next[0].values())
        for state in queue:
            back = self.fail[state]
            self.inside[state] += self.inside[back]
            self.final[state] += self.final[back]
            for c, child in self.next[state].items():
                f = back
                while f and c not in self.next[f]:
                    f = self.fail[f]
                self.fail[child] = self.next[f].get(c, 0)
                queue.append(child)
        self.memo_size = memo
        self.fits: list[dict[int, bool]] = [{} for _ in self.halves]  # by the second token, then the first
        self.n_fits = 0
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.parts: dict[str, list[int]] = {}
        self.packed: dict[str, bytes] = {}
        self.longest = max(map(len, self.rank))

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between adjacent tokens a and b alone: at no
        moment of building both, from the last merge back, may the two symbols at the
        border merge earlier than the merges that were made."""
        first, second = a, b
        known = self.fits[b].get(a)
        if known is not None:
            return known
        limit, ok = 1 << 62, True
        while True:
            made = self.joined.get((a, b))
            if made is not None and made < limit:
                ok = False
                break
            left, right = self.halves[a], self.halves[b]
            whole_a, whole_b = left[0] == a and left[1] == a, right[0] == b and right[1] == b
            if whole_a and whole_b:
                break
            if whole_b or (not whole_a and a > b):
                limit, a = a, left[1]        # a was made last: undo it
            else:
                limit, b = b + 1, right[0]   # equal ranks: the left pair merges first
        self.n_fits += 1
        if self.n_fits > 4 * self.memo_size:
            self.n_fits = 1
            for row in self.fits:
                row.clear()
        self.fits[second][first] = ok
        return ok

    def walk(self, piece: str, tail: list[int], count: list[int], first: int = 0) -> list[int]:
        """Continues the DP over ``piece`` (in the byte alphabet): fills ``tail`` and ``count``
        where ``tail`` is negative and returns the token counts of the prefixes as words of
        their own. ``first`` is where ``piece`` begins within its word."""
        fits, compatible, goto, inside, final = self.fits, self.compatible, self.next, self.inside, self.final
        ends = [0]
        state, begin = 0, -first  # a token that begins the word has nothing before it
        for i, c in enumerate(piece, 1):
            to = goto[state].get(c, -1)
            if to < 0:  # the way over shorter suffixes is kept
                back = state
                while to < 0 and back:
                    back = self.fail[back]
                    to = goto[back].get(c, -1)
                goto[state][c] = to = max(to, 0)
            state = to
            if tail[i] < 0:
                for size, t in inside[state]:
                    j = i - size
                    if j == begin or (ok if (ok := fits[t].get(tail[j])) is not None else compatible(tail[j], t)):
                        tail[i], count[i] = t, count[j] + 1
                        break
            n = 0
            for size, t in final[state]:
                j = i - size
                if j == begin or (ok if (ok := fits[t].get(tail[j])) is not None else compatible(tail[j], t)):
                    n = count[j] + 1
                    break
            ends.append(n)
        return ends

    def piece_total(self, piece: str) -> int:
        """Tokens of ``piece`` (normal text): the DP over its bytes, asked for a word's end after the
        last one only."""
        piece = piece if piece.isascii() and piece.isprintable() else self.raw(piece)
        if piece + END in self.rank:  # the longest token that ends there, with nothing before it
            return 1
        fits, compatible, goto, inside = self.fits, self.compatible, self.next, self.inside
        size_of = len(piece)
        tail, count = [-1] * (size_of + 1), [0] * (size_of + 1)
        state = 0
        for i, c in enumerate(piece, 1):
            to = goto[state].get(c, -1)
            if to < 0:
                back = state
                while to < 0 and back:
                    back = self.fail[back]
                    to = goto[back].get(c, -1)
                goto[state][c] = to = max(to, 0)
            state = to
            for size, t in inside[state]:
                j = i - size
                if j == 0 or (ok if (ok := fits[t].get(tail[j])) is not None else compatible(tail[j], t)):
                    tail[i], count[i] = t, count[j] + 1
                    break
        for size, t in self.final[state]:
            j = size_of - size
            if j == 0 or (ok if (ok := fits[t].get(tail[j])) is not None else compatible(tail[j], t)):
                return count[j] + 1
        return 0

    def prefix_counts(self, piece: str) -> list[int]:
        """Tokens of every prefix of ``piece`` (in the byte alphabet), each as a word of
        its own: item i is the count of piece[:i]."""
        return self.walk(piece, [-1] * (len(piece) + 1), [0] * (len(piece) + 1))

    def raw(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.table)

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of the piece's prefixes of 1, 2, ... characters."""
        known = self.parts.get(piece)
        if known is None:
            if len(self.parts) >= self.memo_size:
                self.parts.clear()
            known = at_chars(piece, self.prefix_counts(self.raw(piece)))
            if len(piece) > 1 and piece[0] == "'" and piece[1].isalpha():  # what is shorter is no contraction
                mark = self.piece_counts("'")[0]
                known = [mark, *(mark + n for n in self.piece_counts(piece[1:])[:-1]), known[-1]]
            if len(piece) <= 64:
                self.parts[piece] = known
        return known

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def normal_counts(self, text: str) -> list[int]:
        """Tokens of the prefixes of a normal text."""
        if (m := self.pieces.match(text)) and m.end() == len(text):  # one piece, as most words are
            return self.piece_counts(text)
        out, n = [], 0
        for m in self.pieces.finditer(text):
            out += [n] * (m.start() - len(out))
            out += [n + c for c in self.piece_counts(m[0])] if n else self.piece_counts(m[0])
            n = out[-1]
        return out + [n] * (len(text) - len(out))

    def plain_counts(self, text: str) -> list[int]:
        """Tokens of the prefixes of a text without special strings."""
        if text.isascii():
            return self.normal_counts(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            return self.composed_counts(text)
        counts = self.normal_counts(normal := self.normal(text))
        if len(normal) == len(text):
            return counts
        return [counts[i - 1] for i in itertools.accumulate(len(self.normal(c)) for c in text)]

    def composed_counts(self, text: str) -> list[int]:
        """The same where characters compose: a prefix that ends between a character and its
        marks may have another normal form than the text has there. Its last piece is
        counted on from the DP before the character."""
        normal = self.normal(text)
        counts, pieces, out, at = self.normal_counts(normal), self.pieces.finditer(normal), [], 0
        begin = end = 0
        tail = count = None
        for m in CLUSTER.finditer(text):
            whole = self.normal(m[0])
            while end < at and (p := next(pieces, None)) is not None:  # the last piece that begins before ``at``
                if p.start() >= at:
                    pieces = itertools.chain([p], pieces)
                    break
                begin, end, tail = *p.span(), None
            for k in range(1, len(m[0]) + 1):
                part = self.normal(m[0][:k])
                if whole.startswith(part):
                    out.append(counts[at + len(part) - 1])
                    continue
                start = begin if end >= at else at
                n = counts[start - 1] if start else 0
                for i, p in enumerate(self.pieces.finditer(normal[start:at] + part)):
                    if i or start == at or p.end() <= at - start or CONTRACTION.match(p[0]):
                        n += self.piece_counts(p[0])[-1]
                        continue
                    if tail is None:
                        raw = self.raw(normal[begin:end])
                        tail, count = [-1] * (len(raw) + 1), [0] * (len(raw) + 1)
                        self.walk(raw, tail, count)
                        sizes = [0, *itertools.accumulate(len(c.encode()) for c in normal[begin:end])]
                    have = sizes[at - begin]
                    low = max(0, have - self.longest)
                    more = self.raw(p[0][at - start:])
                    n += self.walk(raw[low:have] + more, tail[low:have + 1] + [-1] * len(more),
                                   count[low:have + 1] + [0] * len(more), low)[-1]
                out.append(n)
            at += len(whole)
        return out

    def special_counts(self, word: str) -> list[int]:
        """The same where special strings, of one token each, may stand in the word."""
        out, at = [], 0
        for m in self.special.finditer(word):
            n = out[-1] if out else 0
            part = [n + c for c in self.plain_counts(word[at:m.end()])]
            out += part[:-1]  # unfinished, it is plain text
            out.append((part[m.start() - at - 1] if m.start() > at else n) + 1)
            at = m.end()
        n = out[-1] if out else 0
        return out + [n + c for c in self.plain_counts(word[at:])]

    def word_counts(self, word: str) -> bytes:
        """Tokens of each prefix of a word, packed."""
        known = self.packed.get(word)
        if known is None:
            out = self.special_counts(word) if self.special and "<|" in word else self.plain_counts(word)
            known = array("I", out).tobytes()
            if len(word) <= 64:
                if len(self.packed) >= self.memo_size:
                    self.packed.clear()
                self.packed[word] = known
        return known

    def word_total(self, word: str) -> int:
        """Tokens of a word."""
        known = self.words.get(word)
        if known is not None:
            return known
        known = self.older.get(word)
        if known is None:
            if self.special and "<|" in word:
                known = self.special_counts(word)[-1]
            else:
                text = word.lower() if word.isascii() else self.normal(word)
                if text.isalpha() and text.isascii():  # one piece, as most words are
                    known = self.piece_total(text)
                else:
                    known = sum([self.piece_total(m) for m in self.pieces.findall(text)])
        if len(word) <= 64:
            if len(self.words) >= self.memo_size:
                self.words, self.older = {}, self.words
            self.words[word] = known
        return known

    def total(self, text: str) -> int:
        """Tokens of a text: those of its words (no token crosses white space)."""
        known, slow = self.words.get, self.word_total
        return sum([n if (n := known(w)) is not None else slow(w) for w in WORDS.findall(text)])

    def sums(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of the words, tokens up to the end of each."""
        begin, end, counts = [], [], []
        for m in WORDS.finditer(text):
            begin.append(m.start())
            end.append(m.end())
            counts.append(self.word_total(m[0]))
        return np.array(begin, np.int64), np.array(end, np.int64), np.cumsum(counts, dtype=np.int64)

    def running(self, text: str) -> np.ndarray:
        """The token count of every prefix of 1, 2, ... code points."""
        begin, end, sums = self.sums(text)
        packed = [self.word_counts(text[a:b]) for a, b in zip(begin, end)]
        before = np.r_[0, sums]
        out = np.repeat(before, np.diff(np.r_[0, begin, len(text)]))
        inside = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)] or [np.empty(0, np.int64)])
        out[inside] = np.frombuffer(b"".join(packed), COUNT) + np.repeat(before[:-1], end - begin)
        return out

    def at(self, text: str, chars: int) -> int:
        """Exact token count of the first ``chars`` code points."""
        begin, end, sums = self.sums(text)
        i = int(np.searchsorted(begin, chars))  # words that begin before
        if not i:
            return 0
        whole = int(sums[i - 2]) if i > 1 else 0
        own = np.frombuffer(self.word_counts(text[begin[i - 1]:end[i - 1]]), COUNT)
        return whole + int(own[min(chars - begin[i - 1], len(own)) - 1])

    def fit(self, text: str, budget: int) -> int:
        """UTF-8 bytes of the longest prefix (of whole code points) of at most ``budget`` tokens: the
        words whose sums are within it, then as much of the next word as is. One more
        character may need fewer tokens, so all counts of that word are looked at."""
        begin, end, sums = self.sums(text)
        i = int(np.searchsorted(sums, budget, "right"))  # words that end within it
        if i == len(sums):
            return len(text.encode())
        left = budget - (int(sums[i - 1]) if i else 0)
        within = np.flatnonzero(np.frombuffer(self.word_counts(text[begin[i]:end[i]]), COUNT) <= left)
        upto = int(begin[i]) + (int(within[-1]) + 1 if len(within) else 0)
        return len(text[:upto].encode())


KEPT: dict[str, PrefixCounter] = {}


def kept(path: str) -> PrefixCounter:
    """The worker's counter of a vocabulary."""
    if path not in KEPT:
        KEPT.clear()
        KEPT[path] = PrefixCounter(path)
    return KEPT[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per row ``doc_id``, ``n_tokens`` and ``counts``: the token count of every prefix of the text,
    as differences from one code point to the next, compressed."""

    def init():
        counter = kept(path)

        def step(cols):
            runs = [counter.running(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_tokens": [int(r[-1]) if len(r) else 0 for r in runs],
                    "counts": [zlib.compress(np.diff(r, prepend=0).astype("<i4").tobytes(), 1) for r in runs]}
        return step

    return map_batches(text_of(docs, "doc_id"), init, "doc_id bigint, n_tokens bigint, counts binary", rows=128)


def stored_counts(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), "<i4").cumsum(dtype=np.int64)


def stored_at(counts: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` code points."""
    known = stored_counts(counts)[:chars]
    return int(known[-1]) if len(known) else 0


def stored_fit(counts: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    within = np.flatnonzero(stored_counts(counts) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per row of ``docs``: bytes, tokens, whether they exceed ``limit``, and the bytes
    of the longest prefix within the limit, which may end inside a word."""

    def init():
        counter = kept(path)

        def step(cols):
            out = {"doc_id": cols["doc_id"], "n_bytes": [], "n_tokens": [], "over_limit": [], "cut_bytes": []}
            for text in cols["text"]:
                n = counter.total(text)
                size = len(text.encode())
                out["n_bytes"].append(size)
                out["n_tokens"].append(n)
                out["over_limit"].append(n > limit)
                out["cut_bytes"].append(size if n <= limit else counter.fit(text, limit))
            return out
        return step

    return map_batches(text_of(docs, "doc_id"), init, DDL)
