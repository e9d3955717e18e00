"""Quality rules, line first.

Every line that holds a word is judged by three rules: punctuation (a short line must end
in terminal punctuation, and any must hold few symbols and not be strewn with ``!!``), navigation
(menus: separators between short items, or a couple of menu words) and boilerplate
(stock phrases). Lines that fail are removed; a document that loses more than
``max_lost`` per cent of its words that way is rejected, and so is one that fails
the document-level base (too few words, too many repeated 8-word windows).

Defined results: a null text counts as empty (no words: base fails, rejected, cleaned
text empty); lines without a word are dropped from the cleaned text; repeated rows give
repeated results; an empty table gives an empty table; columns other than ``doc_id`` and
``text`` are not read, so extra ones cannot clash. One pass, no shuffle, one text in
memory at a time beside its batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tierwise.llm.common import SPACE, map_batches, text_of

# Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Rules (parameters of this operator).
TERMINAL = (".", "!", "?", ":", ";", "\"", "'", ")", "]", "…", "”", "»")
SEPARATORS = ("|", "»", "›", ">")
MENU_WORDS = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search",
              "next", "previous", "back", "share", "print", "contact", "about", "sitemap")
BOILERPLATE = ("all rights reserved", "licensed under", "under the mit license", "copyright",
               "privacy policy", "terms of use", "terms of service", "cookie", "javascript",
               "click here", "read more", "subscribe", "powered by")
FRAGMENT_WORDS = 8        # a line of fewer words needs an end; a longer one may be wrapped prose
MAX_SYMBOL_PERCENT = 10   # of a line's bytes
MAX_SHOUT_PERCENT = 30    # "!!" per 100 words of a line
MAX_LOST_PERCENT = 50     # of a document's words

DDL = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
       "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, "
       "n_lines_removed bigint, n_words_left bigint")


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more. Equal windows have
    equal hashes, so only texts with a repeated hash take the exact path."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, n)
    if len(ids) == n:
        return 0
    a *= np.uint64(0x9E3779B97F4A7C15)
    h, size, base = a, 1, 0x100000001B3
    while size < window:
        h = h[:-size] * np.uint64(base) + h[size:]
        base, size = base * base % 2**64, 2 * size
    s = np.sort(h)
    hot = s[1:][s[1:] == s[:-1]]
    if not len(hot):
        return 0
    at = np.flatnonzero(np.isin(h, hot))
    seen: dict[tuple, int] = {}
    twice = np.zeros(n + 1, np.int64)
    for i in at.tolist():
        key = tuple(words[i:i + window])
        first = seen.setdefault(key, i)
        if first != i:
            for j in (first, i):
                twice[j] = 1
    starts = np.flatnonzero(twice)
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge)[:n] > 0).sum())


def line_fails(line: bytes, n_words: int) -> bool:
    """``line``: stripped, with at least one word."""
    text = line.decode()
    if n_words < FRAGMENT_WORDS and not text.endswith(TERMINAL):
        return True
    if 100 * (len(line) - len(line.translate(None, SYMBOLS))) > MAX_SYMBOL_PERCENT * len(line):
        return True
    if 100 * line.count(b"!!") >= MAX_SHOUT_PERCENT * n_words:
        return True
    low = line.lower().decode()
    if sum(low.count(s) for s in SEPARATORS) * 4 >= n_words:
        return True
    if n_words <= 4 and any(m in low for m in MENU_WORDS):
        return True
    return any(b in low for b in BOILERPLATE)


def judge(text: str, max_lost: int = MAX_LOST_PERCENT) -> tuple:
    """The document's measures and verdict, and its cleaned text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    left, kept_lines = 0, []
    for line in lines:
        m = len(line.split())
        if not line_fails(line.strip(SPACE), m):
            left += m
            kept_lines.append(line)
    repeat = repeat_words(words)
    base = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    return ((n, len(text) - (len(raw) - len(raw.translate(None, SPACE))),
             len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat,
             base, not base and 100 * (n - left) <= max_lost * n, len(lines),
             len(lines) - len(kept_lines), left), b"\n".join(kept_lines).decode())


def apply_rules(docs: DataFrame, max_lost: int = MAX_LOST_PERCENT, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: measures, verdict and (``with_text``) ``clean_text``."""
    ddl = DDL + (", clean_text string" if with_text else "")
    names = [c.split()[0] for c in DDL.split(", ")][1:]

    def init():
        def step(cols):
            got = [judge(t, max_lost) for t in cols["text"]]
            out = {"doc_id": cols["doc_id"]} | {n: [g[0][i] for g in got] for i, n in enumerate(names)}
            return out | {"clean_text": [g[1] for g in got]}
        return step

    return map_batches(text_of(docs, "doc_id"), init, ddl)

