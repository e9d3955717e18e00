r"""Periodic runs of words, by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``max(min_length, 2 * q)`` long,
that no neighbouring word extends. Comparing a text with itself at every lag is quadratic;
lags are found by scale instead:

1. Periods under 16 are scanned directly: one comparison of the text with itself a lag.
2. Scale k = 8, 16, 32, ... covers periods from 2k to 4k. Every window of k + 1 consecutive
   k-grams gives its least hash (the leftmost of equal ones). In a run of period p the windows
   of one period and of the next are equal, so their minima lie p apart: pairs of equal
   minima with a distance in the scale's range are the seeds.
3. Copies of a k-gram at most k / 2 apart belong to one run of a shorter period, found at a smaller
   scale; they form a cluster, and pairs within it seed nothing new. Two clusters
   give one seed for every lag that they allow, not every pair, and a cluster has at most 8
   others in reach. The number of seeds is therefore linear in the text.
4. A seed is extended by comparing words, in doubling steps, to the maximal stretch with that lag;
   a stretch counts if it holds two whole periods. Hashes only propose; words decide.
   Of equal stretches the smallest period stays.

No equal minima in a text at one scale means no runs of larger periods either: most texts
end at the first scale. Texts are worked on in batches of ``batch_words`` words laid end
to end (a longer text alone); what is compared never leaves its text.

Defined results: a null or empty text has no words, no run, four nulls and the digests of the empty
string; a null doc_id takes part with its words as they are (its number would decide on the
repetition of the contract's ``planted``); repeated rows give repeated results; an empty table gives
an empty one; only ``doc_id`` and ``text`` are read. Whole texts of any length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tierwise.llm.common import map_batches, text_of

SHORT = 16          # periods below are scanned directly
FIRST_SCALE = SHORT // 2
MIN_LENGTH = 12
BATCH_WORDS = 200_000
DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
       "runs_sha256 string, collapsed_sha256 string")
GOLD = np.uint64(0x9E3779B97F4A7C15)
MULT = np.uint64(0xD6E8FEB86659FD93)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repetition: for each word the number of the original word that takes its
    place, or None where the words stay."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MULT
    x = (x ^ (x >> np.uint64(29))) * GOLD
    return x ^ (x >> np.uint64(32))


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words; ``size`` is a power of two."""
    h, have = mixed(ids.astype(np.uint64) + GOLD), 1
    while have < size:
        h = mixed(h[:-have] * GOLD + h[have:])
        have *= 2
    return h


def window_minima(h: np.ndarray, size: int) -> np.ndarray:
    """Positions of the least (leftmost) of every ``size`` consecutive items, each once."""
    if len(h) < size:
        return np.empty(0, np.int64)
    # Sparse table of positions: the winner of 2^j items, then of the whole window.
    at, have = np.arange(len(h)), 1
    while 2 * have <= size:
        left, right = at[:-have], at[have:]
        at = np.where(h[right] < h[left], right, left)
        have *= 2
    n = len(h) - size + 1
    left, right = at[:n], at[size - have:size - have + n]
    # Both halves may overlap: the leftmost of equal minima is the left half's.
    best = np.where(h[right] < h[left], right, left)
    return best[np.r_[True, best[1:] != best[:-1]]] if len(best) else best


def common_prefix(ids: np.ndarray, i: int, lag: int, end: int) -> int:
    """How many words from ``i`` on equal those ``lag`` later, before ``end``."""
    n, step = 0, 64
    while i + n + lag < end:
        m = min(step, end - lag - i - n)
        same = ids[i + n:i + n + m] == ids[i + n + lag:i + n + lag + m]
        if not same.all():
            return n + int(same.argmin())
        n, step = n + m, 2 * step
    return n


def common_suffix(ids: np.ndarray, i: int, lag: int, begin: int) -> int:
    """How many words before ``i`` equal those ``lag`` later, from ``begin`` on."""
    n, step = 0, 64
    while i - n > begin:
        m = min(step, i - n - begin)
        same = (ids[i - n - m:i - n] == ids[i - n - m + lag:i - n + lag])[::-1]
        if not same.all():
            return n + int(same.argmin())
        n, step = n + m, 2 * step
    return n


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """[from, to) of the stretches of at least ``least`` true items."""
    edge = np.flatnonzero(np.diff(np.r_[False, same, False].view(np.int8)))
    a, b = edge[::2], edge[1::2]
    keep = b - a >= least
    return a[keep], b[keep]


def cluster_seeds(at: np.ndarray, h: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, lag) of the seeds with a lag in [2k, 4k), and the texts that have any two equal
    minima. ``at``, ``h``, ``text``: the minima, their hashes and texts."""
    order = np.lexsort((at, h, text))
    at, h, text = at[order], h[order], text[order]
    twin = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    again = np.unique(text[1:][twin])
    if not len(again):
        return np.empty(0, np.int64), np.empty(0, np.int64), again
    near = twin & (np.diff(at) <= k // 2)
    first = np.flatnonzero(np.r_[True, ~near])
    last = np.r_[first[1:], len(at)] - 1
    group = np.cumsum(np.r_[0, ~twin])[first]
    begin, end = at[first], at[last]
    # The step of a cluster is a multiple of its k-gram's own period, of which every multiple
    # in the cluster is an occurrence as well.
    step = np.gcd.reduceat(np.r_[0, np.where(near, np.diff(at), 0)], first)
    seeds, lags = [], []
    for reach in range(1, 9):
        if reach >= len(first):
            break
        i = np.flatnonzero((group[reach:] == group[:-reach]) & (begin[reach:] - end[:-reach] < 4 * k)
                           & (end[reach:] - begin[:-reach] >= 2 * k))
        j = i + reach
        if not len(i):
            continue
        unit = np.maximum(np.gcd(step[i], step[j]), 1)
        # Lags begin[j] - begin[i] + t * unit, from (end of i, begin of j) to (begin of i, end of j).
        lo = -((end[i] - begin[i]) // unit)
        hi = (end[j] - begin[j]) // unit
        base = begin[j] - begin[i]
        lo = np.maximum(lo, -((base - 2 * k) // unit))
        hi = np.minimum(hi, (4 * k - 1 - base) // unit)
        some = hi >= lo
        i, lo, hi, unit, base = i[some], lo[some], hi[some], unit[some], base[some]
        n = hi - lo + 1
        t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
        unit = np.repeat(unit, n)
        seeds.append(np.repeat(begin[i], n) + np.where(t < 0, -t * unit, 0))
        lags.append(np.repeat(base, n) + t * unit)
    if not seeds:
        return np.empty(0, np.int64), np.empty(0, np.int64), again
    return np.concatenate(seeds), np.concatenate(lags), again


def find_runs(ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> list[dict[tuple[int, int], int]]:
    """Runs of texts laid end to end: text t is ``ids[bounds[t]:bounds[t + 1]]``. Per text
    {(start, end): smallest period}, in positions of ``ids``."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in range(len(bounds) - 1)]
    sizes = np.diff(bounds)
    of = np.repeat(np.arange(len(sizes)), sizes)

    def add(a: int, b: int, lag: int) -> None:
        runs = found[of[a]]
        if lag < runs.get((a, b + lag), lag + 1):
            runs[a, b + lag] = lag

    for lag in range(1, min(SHORT, int(sizes.max(initial=0)) // 2 + 1)):
        same = (ids[:-lag] == ids[lag:]) & (of[:-lag] == of[lag:])
        for a, b in zip(*(x.tolist() for x in stretches(same, max(min_length - lag, lag)))):
            add(a, b, lag)
    k, active = FIRST_SCALE, np.flatnonzero(sizes >= 4 * FIRST_SCALE)
    while len(active):
        take = np.isin(of, active)
        where = np.flatnonzero(take)
        part = ids[where]
        h = gram_hashes(part, k) if len(part) >= k else np.empty(0, np.uint64)
        minima = window_minima(h, k + 1)
        at = where[minima]
        inside = of[where[np.minimum(minima + k - 1, len(where) - 1)]] == of[at]  # no k-gram of two texts
        if not inside.all():
            # A window across two texts may take such a k-gram; windows within a text do not.
            minima, at = minima[inside], at[inside]
        seeds, lags, again = cluster_seeds(at, h[minima], of[at], k)
        order = np.lexsort((seeds, lags))
        known, upto = 0, -1
        for i, lag in zip(seeds[order].tolist(), lags[order].tolist()):
            if lag == known and i < upto:
                continue
            text = of[i]
            b = i + common_prefix(ids, i, lag, int(bounds[text + 1]))
            a = i - common_suffix(ids, i, lag, int(bounds[text]))
            known, upto = lag, b
            if b - a >= max(min_length - lag, lag):
                add(a, b, lag)
        k *= 2
        active = again[sizes[again] >= 4 * k]
    return found


def word_batches(texts: list[str], most: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(number of the first text, words of consecutive texts) with about ``most`` words together."""
    begin, held, n = 0, [], 0
    for i, text in enumerate(texts):
        words = text.encode().split()
        if held and n + len(words) > most:
            yield begin, held
            begin, held, n = i, [], 0
        held.append(words)
        n += len(words)
    if held:
        yield begin, held


def detect(docs: DataFrame, plant: bool = False, min_length: int = MIN_LENGTH, with_text: bool = True,
           batch_words: int = BATCH_WORDS) -> DataFrame:
    """Per row the number of runs, the longest one, the digest of all, and the text without the
    repetitions: ``collapsed_sha256`` and (``with_text``) ``runs`` and ``collapsed_text``.
    ``plant`` repeats words first, as the contract of the query says."""

    def init():
        def step(cols):
            out = {c.split()[0]: [] for c in DDL.split(", ")} | ({"runs": [], "collapsed_text": []} if with_text else {})
            for begin, held in word_batches(cols["text"], batch_words):
                doc_ids = cols["doc_id"][begin:begin + len(held)]
                if plant:
                    held = [w if (at := planted(i, len(w))) is None else [w[x] for x in at.tolist()]
                            for i, w in zip(doc_ids, held)]
                number: dict[bytes, int] = {}
                bounds = np.cumsum([0, *map(len, held)])
                ids = np.fromiter((number.setdefault(w, len(number)) for words in held for w in words),
                                  np.int64, int(bounds[-1]))
                for doc_id, words, lo, runs in zip(doc_ids, held, bounds.tolist(), find_runs(ids, bounds, min_length)):
                    for c, v in zip(out, (doc_id, *described(words, sorted((a - lo, b - a, q) for (a, b), q in runs.items())))):
                        out[c].append(v)
            return out
        return step

    ddl = DDL + (", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_text string" if with_text else "")
    return map_batches(text_of(docs, "doc_id"), init, ddl, rows=256)


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The columns after doc_id, for runs (start, length, period) by start, then period."""
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for a, n, q in runs:
            gone[a + q] += 1
            gone[a + n] -= 1
        words = [words[i] for i in np.flatnonzero(gone.cumsum()[:-1] == 0).tolist()]
    kept = b" ".join(words)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (len(runs), *(longest or (None, None, None)), 1000 * longest[1] // longest[2] if longest else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
            [{"start": a, "length": n, "period": q} for a, n, q in runs], kept.decode())
