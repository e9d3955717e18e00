"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a space in front, every space the mark of the word behind it) and cut
into marked words; no piece of the vocabulary crosses those borders, so the best
segmentation of a text is that of its words. The distinct new words of a batch are sorted,
which lays them out as a depth-first walk of their trie: forward scores, back pointers and
the vocabulary-trie nodes still alive are kept per depth, and the next word goes on from
the longest prefix it shares with the one before. Characters outside the vocabulary fall
back to their UTF-8 bytes. A segmentation maximises the sum of the model's piece scores;
among equals the longest last piece wins, as in the library's unigram encoder.

Decoding joins piece bytes and drops the leading mark. Every text comes back exactly: line
breaks, runs of spaces, and U+2581 itself (written as bytes, never as a mark).

Defined results: null text = empty text = no pieces; repeated rows repeat; an empty
table gives an empty one; only ``doc_id`` and ``text`` are read. The memo of words is
bounded by ``memo`` words; one batch's words come on top of it.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierwise.llm.common import map_batches, text_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
DDL = "doc_id bigint, n_bytes bigint, n_tokens bigint, ids array<int>, ids_sha256 string, round_trip boolean"


class PieceCodec:
    def __init__(self, path: str, memo: int = 60_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id, self.bytes_of = {}, [b""] * n
        self.root: list = [{}, -1, 0.0]  # children, piece, score
        least, breaks = 0.0, {"\n", "\t", "\r"}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                own = piece.replace(MARK, " ")
                if " " in own.lstrip(" "):
                    raise ValueError(f"{path}: piece {i} crosses a word border")
                breaks -= set(own)
                node = self.root
                for c in own:
                    node = node[0].setdefault(c, [{}, -1, 0.0])
                node[1], node[2] = i, model.get_score(i)
                least = min(least, node[2])
                self.bytes_of[i] = own.encode()
        self.unknown = least - UNKNOWN_PENALTY
        stop = "".join(sorted(breaks))  # characters of no piece stand alone
        self.units = re.compile(f"[{stop}]| *[^ {stop}]+| +" if stop else " *[^ ]+| +")
        self.memo, self.memo_size, self.memo_chars = {}, memo, 0

    def learn(self, words) -> None:
        """Segment the words that the memo lacks: one depth-first walk over their trie."""
        if len(self.memo) > self.memo_size or self.memo_chars > 32 * self.memo_size:
            self.memo.clear()
            self.memo_chars = 0
        root, unknown, memo = self.root, self.unknown, self.memo
        best, back, alive, last = [0.0], [(0, -1)], [[(0, root)]], ""
        for word in sorted(w for w in words if w not in memo):
            at, most = 0, min(len(word), len(last))
            while at < most and word[at] == last[at]:
                at += 1
            del best[at + 1:], back[at + 1:], alive[at + 1:]
            for i in range(at, len(word)):
                c = word[i]
                score, link, here = None, None, []
                for j, node in alive[i]:
                    node = node[0].get(c)
                    if node is not None:
                        here.append((j, node))
                        if node[1] >= 0:
                            s = best[j] + node[2]
                            if score is None or s > score:
                                score, link = s, (j, node[1])
                if not here or here[-1][0] != i or here[-1][1][1] < 0:  # no piece of this character alone
                    s = best[i] + unknown
                    if score is None or s > score:
                        score, link = s, (i, -1)
                here.append((i + 1, root))
                best.append(score)
                back.append(link)
                alive.append(here)
            ids, i = [], len(word)
            while i:
                j, piece = back[i]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids.extend(self.byte_id[b] for b in reversed(word[j:i].encode()))
                i = j
            ids.reverse()
            memo[word] = np.array(ids, "<i4").tobytes()
            self.memo_chars += len(word)
            last = word

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        units = [self.units.findall(" " + t) if t else [] for t in texts]
        self.learn(set().union(*units))
        get = self.memo.__getitem__
        return [b"".join(map(get, u)) for u in units]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed([text or ""])[0], "<i4").tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ids of the whole text, their count and digest, and whether decoding them
    gives the text back."""

    def init():
        codec = PieceCodec(path)

        def step(cols):
            texts = cols["text"]
            packed = codec.encode_packed(texts)
            offsets = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int64)
            flat = np.frombuffer(b"".join(packed), "<i4")
            back = [codec.decode(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            return {
                "doc_id": cols["doc_id"], "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": np.diff(offsets),
                "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "round_trip": [a == b for a, b in zip(texts, back)],
            }
        return step

    return map_batches(text_of(docs, "doc_id"), init, DDL, rows=256)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of ids."""

    def init():
        codec = PieceCodec(path)
        return lambda cols: {"doc_id": cols["doc_id"], "text": [codec.decode(i or ()) for i in cols["ids"]]}

    return map_batches(encoded.select("doc_id", "ids"), init, "doc_id bigint, text string")
