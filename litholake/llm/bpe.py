"""Byte-level BPE encoding in two tiers (problem 6).

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is itself a vocabulary entry. The
lookup is vectorised: pre-tokens are hashed eight bytes at a time straight from the text buffer, and the slot's entry is
compared byte for byte, so a foreign pre-token is never taken for an entry.

Tier two: the misses are merged with a heap of candidate pairs over a linked list of bytes, O(n log n) in the length of
the pre-token.

Splitting into pre-tokens is vectorised too: the published pattern of byte-level BPE depends only on the class of each
character (letter, number, white space, other), so the boundaries follow from the runs of classes.
"""

from __future__ import annotations

import base64
import heapq
import os
import unicodedata
from dataclasses import dataclass

import numpy as np

#: The contractions of the published pattern 's|'t|'re|'ve|'m|'ll|'d, without their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Code points with Unicode's White_Space property.
WHITE_SPACE = (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
DEFAULT_DIR = "/opt/tokenizers"
OTHER, LETTER, NUMBER, SPACE = range(4)
_MUL1, _MUL2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CACHE_ENTRIES, _CACHE_BYTES = 200_000, 64


def read_ranks(name: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> dict[bytes, int]:
    """Token bytes -> id (which is the merge rank too) of a public vocabulary file."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def class_table() -> np.ndarray:
    """The class of every code point."""
    t = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            t[cp] = LETTER
        elif kind == "N":
            t[cp] = NUMBER
    t[list(WHITE_SPACE)] = SPACE
    return t


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MUL1
    h = (h ^ (h >> np.uint64(29))) * _MUL2
    return h ^ (h >> np.uint64(32))


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


class Words:
    """Eight-byte reads at any place of a buffer."""

    def __init__(self, buf: np.ndarray):
        padded = np.concatenate([buf, np.zeros(8, np.uint8)])
        self.view = np.ndarray((len(buf) + 1,), "<u8", padded.data, 0, (1,))

    def at(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return self.view[start] & _MASKS[np.minimum(length, 8)]


def hash_spans(words: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    h = _mix(words.at(start, length) + length.astype(np.uint64) * _MUL2)
    rest, at = np.flatnonzero(length > 8), 8
    while len(rest):
        h[rest] = _mix(h[rest] ^ (words.at(start[rest] + at, length[rest] - at) + _MUL1))
        at += 8
        rest = rest[length[rest] > at]
    return h


def spans_equal(a: Words, astart: np.ndarray, b: Words, bstart: np.ndarray, length: np.ndarray) -> np.ndarray:
    same = a.at(astart, length) == b.at(bstart, length)
    rest, at = np.flatnonzero(same & (length > 8)), 8
    while len(rest):
        ok = a.at(astart[rest] + at, length[rest] - at) == b.at(bstart[rest] + at, length[rest] - at)
        same[rest[~ok]] = False
        at += 8
        rest = rest[ok & (length[rest] > at)]
    return same


@dataclass
class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys, n slots, one small number for each bucket."""

    displace: np.ndarray
    n: int

    @staticmethod
    def build(hashes: np.ndarray, per_bucket: int = 4) -> PerfectHash:
        n = len(hashes)
        m = max(1, n // per_bucket)
        bucket = (hashes % np.uint64(m)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=m)
        ends = np.cumsum(counts)
        displace, free = np.zeros(m, np.int64), np.ones(n, bool)
        tries = np.arange(1, 513, dtype=np.uint64)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            h, d = hashes[order[ends[b] - counts[b] : ends[b]]], 0
            while True:
                slots = PerfectHash._slot(h[None, :], tries[:, None] + np.uint64(d), n)
                good = free[slots].all(1)
                if len(h) > 1:
                    s = np.sort(slots, 1)
                    good &= (s[:, 1:] != s[:, :-1]).all(1)
                if good.any():
                    k = int(good.argmax())
                    displace[b], free[slots[k]] = d + k + 1, False
                    break
                d += len(tries)
                if d > 1 << 24:
                    raise ValueError("two keys have the same hash")
        left = np.flatnonzero(free)
        single = np.flatnonzero(counts == 1)
        displace[single] = -left[: len(single)] - 1  # a lone key gets a free slot outright
        return PerfectHash(displace, n)

    @staticmethod
    def _slot(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
        return (_mix(h + d * _MUL1) % np.uint64(n)).astype(np.int64)

    def slot(self, h: np.ndarray) -> np.ndarray:
        d = self.displace[(h % np.uint64(len(self.displace))).astype(np.int64)]
        return np.where(d < 0, -d - 1, self._slot(h, np.maximum(d, 0).astype(np.uint64), self.n))


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one pre-token: a heap of (rank, place) over a doubly linked list of parts; the lowest rank, then the
    leftmost pair, is merged first."""
    n = len(piece)
    end = list(range(1, n + 1))  # part i is piece[i:end[i]]
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of its two parts has been merged meanwhile
        end[i], alive[j] = stop, False
        if stop < n:
            prev[stop] = i
            r = ranks.get(piece[i : end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = prev[i]
        if p >= 0:
            r = ranks.get(piece[p:stop])
            if r is not None:
                heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Tables of one vocabulary; small enough to broadcast (about 3 MB for 50,000 entries), used by batch."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        tokens = list(ranks)
        lengths = np.array([len(t) for t in tokens], np.int64)
        starts = np.cumsum(lengths) - lengths
        buf = np.frombuffer(b"".join(tokens), np.uint8)
        hashes = hash_spans(Words(buf), starts, lengths)
        self.mph = PerfectHash.build(hashes)
        slot = self.mph.slot(hashes)
        self.start, self.length, self.id = (np.empty(len(tokens), np.int64) for _ in range(3))
        self.start[slot], self.length[slot], self.id[slot] = starts, lengths, np.array([ranks[t] for t in tokens])
        self.buf, self.longest = buf, int(lengths.max(initial=0))
        self.classes = class_table()
        self.cache: dict[bytes, list[int]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    # --- pre-tokens -------------------------------------------------------------------------------------------------

    def split(self, buf: np.ndarray, doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in bytes of every pre-token of a UTF-8 buffer; ``doc_start``: byte offsets where texts begin."""
        lead = np.flatnonzero((buf & 0xC0) != 0x80)
        n = len(lead)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ext = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.uint32)
        b0, cp = ext[lead], ext[lead].copy()
        for low, keep, extra in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
            k = np.flatnonzero(b0 >= low)
            v = b0[k] & keep
            for e in range(1, extra + 1):
                v = (v << 6) | (ext[lead[k] + e] & 0x3F)
            cp[k] = v
        cls = self.classes[np.minimum(cp, 0x10FFFF)]
        new_doc = np.zeros(n + 1, bool)
        at = np.searchsorted(lead, doc_start)
        new_doc[at] = True
        new_doc[n] = True
        run = new_doc.copy()
        run[1:n] |= cls[1:] != cls[:-1]
        space = cls == SPACE
        blank = cp == 32
        token = run[:n].copy()
        # the run after a U+0020 begins with it
        token[1:] &= ~(run[1:n] & ~new_doc[1:n] & blank[:-1] & ~space[1:])
        # the last white space character before other text stands alone or joins that text
        last = space & run[1:] & ~new_doc[1:]
        token |= last
        # contractions
        q = np.flatnonzero((cp == 39) & token & run[:n])
        if len(q):
            ahead = np.concatenate([cp, np.zeros(3, cp.dtype)])
            for c in CONTRACTIONS:
                fits = q
                for e, ch in enumerate(c, 1):
                    fits = fits[ahead[fits + e] == ord(ch)]
                    fits = fits[~new_doc[np.minimum(fits + e, n)]]
                token[fits + 1] = False
                nxt = fits + 1 + len(c)
                token[nxt[nxt < n]] = True
        starts = lead[token]
        return starts, np.diff(np.append(starts, len(buf)))

    # --- ids --------------------------------------------------------------------------------------------------------

    def _miss(self, piece: bytes) -> list[int]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = merge_bytes(piece, self.ranks)
            if len(piece) <= _CACHE_BYTES:
                if len(self.cache) >= _CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin; text i is ``buf[offsets[i]:offsets[i + 1]]``."""
        start, length = self.split(buf, offsets[:-1][offsets[:-1] < offsets[1:]])
        ids = np.zeros(len(start), np.int64)
        hit = np.zeros(len(start), bool)
        short = np.flatnonzero(length <= self.longest)
        if len(short):
            words = Words(buf)
            s, ln = start[short], length[short]
            slot = self.mph.slot(hash_spans(words, s, ln))
            same = self.length[slot] == ln
            k = np.flatnonzero(same)
            same[k] = spans_equal(words, s[k], Words(self.buf), self.start[slot[k]], ln[k])
            hit[short], ids[short] = same, self.id[slot]
        misses = np.flatnonzero(~hit)
        counts = np.ones(len(start), np.int64)
        if len(misses):
            raw = buf.tobytes()
            found = [self._miss(raw[a:b]) for a, b in zip(start[misses].tolist(), (start[misses] + length[misses]).tolist(), strict=True)]
            counts[misses] = [len(f) for f in found]
            first = np.cumsum(counts) - counts
            out = np.empty(int(counts.sum()), np.int64)
            out[first[hit]] = ids[hit]
            flat = np.array([i for f in found for i in f], np.int64)
            m = counts[misses]
            out[np.repeat(first[misses] - (np.cumsum(m) - m), m) + np.arange(len(flat))] = flat
        else:
            out = ids
        ends = np.concatenate([[0], np.cumsum(counts)])
        return out, ends[np.searchsorted(start, offsets)]
