"""A structural index of many JSON texts at once: tokens, parents and places as arrays over one byte buffer.

No text is parsed by itself. Strings are told by the parity of unescaped quotes, nesting by running sums of brackets, the
parent of a token by the last open bracket of its level, and the grammar by a table of neighbouring tokens. What the index
accepts is JSON with NaN and Infinity and with a leading byte order mark.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OBJECT, OBJECT_END, LIST, LIST_END, COLON, COMMA, STRING, SCALAR = range(1, 9)
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in "{}[]:,"]] = range(1, 7)
_SPACE = np.isin(np.arange(256), [9, 10, 13, 32])
_HEX = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdefABCDEF"])
_PLAIN = {ord(a): b for a, b in zip('"\\/bfnrt', b'"\\/\b\f\n\r\t', strict=True)}
_UNESCAPE = np.array([_PLAIN.get(i, i) for i in range(256)], np.uint8)
_ESCAPES = np.isin(np.arange(256), [*_PLAIN, ord("u")])
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_EMPTY, _BREAK = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
_WORDS = {"NaN": np.nan, "Infinity": np.inf, "-Infinity": -np.inf}


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all bytes of the ranges, one after the other, and the offsets of the ranges among them."""
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)])
    return np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], length), offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes()))


class JsonIndex:
    """``kind``, ``parent`` (token) and ``key`` (is the name of a member) of all tokens; ``live``: rows that are JSON."""

    def __init__(self, texts: pa.Array):
        rows = len(texts)
        joined = pc.binary_join_element_wise(texts.fill_null("").cast(pa.large_string()), _EMPTY, _BREAK)
        offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + rows + 1] if rows else np.zeros(1, np.int64)
        d = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy() if rows else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        start, end = offsets[:-1], offsets[1:] - 1
        bom = start[end - start >= 3]
        bom = bom[(d[bom] == 0xEF) & (d[bom + 1] == 0xBB) & (d[bom + 2] == 0xBF)] if len(bom) else bom
        for k in range(3):
            d[bom + k] = 32
        broken = pc.is_null(texts).to_numpy(zero_copy_only=False).copy()
        row_of = lambda at: np.searchsorted(end, at)
        # strings
        escaped, intro = np.zeros(len(d) + 1, bool), np.flatnonzero(d == 92)
        if len(intro):
            fresh = np.diff(intro, prepend=-2) != 1
            first = intro[fresh][np.cumsum(fresh) - 1]
            intro = intro[(intro - first) % 2 == 0]
            escaped[intro + 1] = True
        quote = (d == 34) & ~escaped[:-1]
        odd = np.bincount(row_of(np.flatnonzero(quote)), minlength=rows)[:rows] % 2 == 1
        broken |= odd
        quote[end[odd]] = True  # closes what is open, so that the next row begins outside
        inside = (np.cumsum(quote, dtype=np.uint32) & 1).astype(bool)
        broken[row_of(np.flatnonzero(inside & (d < 32)))] = True
        if len(intro):
            padded = np.concatenate([d, np.zeros(6, np.uint8)])
            wrong = ~_ESCAPES[padded[intro + 1]]
            for k in range(2, 6):
                wrong |= (padded[intro + 1] == ord("u")) & ~_HEX[padded[intro + k]]
            broken[row_of(intro[wrong])] = True
        # tokens
        other = ~inside & ~_SPACE[d] & (_KIND[d] == 0) & (d != 34)
        begins = other & ~np.concatenate([[False], other[:-1]])
        ends = np.flatnonzero(other & ~np.concatenate([other[1:], [False]])) + 1
        opens = quote & inside
        pos = np.flatnonzero(((_KIND[d] > 0) & ~inside) | opens | begins)
        kind = _KIND[d[pos]]
        kind[opens[pos]], kind[begins[pos]] = STRING, SCALAR
        stop = pos + 1
        stop[kind == STRING], stop[kind == SCALAR] = np.flatnonzero(quote & ~inside)[: int(opens.sum())], ends
        row = row_of(pos)
        # nesting
        up, down = (kind == OBJECT) | (kind == LIST), (kind == OBJECT_END) | (kind == LIST_END)
        total = np.concatenate([[0], np.cumsum(up.astype(np.int64) - down)])
        first = np.searchsorted(row, np.arange(rows + 1))
        depth = total[1:] - total[first[:-1]][row]
        broken |= (first[1:] == first[:-1]) | (total[first[1:]] != total[first[:-1]])
        broken[row[depth < 0]] = True
        keep = ~broken[row]
        pos, kind, stop, row, depth, up, down = (a[keep] for a in (pos, kind, stop, row, depth, up, down))
        m = len(pos)
        level = depth - up + down  # of the container that a token lies in, or closes
        at = np.arange(m)
        order = np.lexsort((np.concatenate([at[up] * 2 + 1, at * 2]), np.concatenate([depth[up], level])))
        tokens, is_open = np.concatenate([at[up], at])[order], order < up.sum()
        last = np.maximum.accumulate(np.where(is_open, np.arange(len(order)), 0)) if len(order) else order
        parent = np.full(m, -1)
        parent[tokens[~is_open]] = tokens[last[~is_open]]
        parent[level == 0] = -1
        # grammar
        within = np.where(parent >= 0, kind[parent], 0) if m else np.zeros(0, np.uint8)
        before = np.concatenate([[0], kind[:-1]]) if m else kind
        before[np.diff(row, prepend=-1) != 0] = 0
        key = (kind == STRING) & (within == OBJECT) & ((before == OBJECT) | (before == COMMA))
        after_key = np.concatenate([[False], key[:-1]]) if m else key
        done = np.isin(before, (STRING, SCALAR, OBJECT_END, LIST_END)) & ~after_key
        value = np.isin(kind, (OBJECT, LIST, STRING, SCALAR))
        fits = value & (((before == 0) & (level == 0)) | (before == LIST) | (before == COLON) | ((before == COMMA) & ((within == LIST) | key)) | ((before == OBJECT) & key))
        fits |= (kind == COLON) & after_key
        fits |= (kind == COMMA) & done & (within > 0)
        fits |= (kind == OBJECT_END) & (within == OBJECT) & (done | (before == OBJECT))
        fits |= (kind == LIST_END) & (within == LIST) & (done | (before == LIST))
        broken[row[~fits]] = True
        scalars = np.flatnonzero(kind == SCALAR)
        place, offs = _ranges(pos[scalars], stop[scalars])
        words = _strings(d[place], offs)
        number = pc.match_substring_regex(words, _NUMBER).to_numpy(zero_copy_only=False) if len(scalars) else np.zeros(0, bool)
        odd_number = pc.is_in(words, pa.array(list(_WORDS), pa.large_string())).to_numpy(zero_copy_only=False) if len(scalars) else number
        literal = pc.is_in(words, pa.array(["true", "false", "null"], pa.large_string())).to_numpy(zero_copy_only=False) if len(scalars) else number
        broken[row[scalars[~(number | odd_number | literal)]]] = True
        self.data, self.kind, self.pos, self.stop, self.parent, self.key = d, kind, pos, stop, parent, key
        self.number = np.zeros(m, bool)
        self.number[scalars] = number | odd_number
        self.value = value & ~key
        self.live = ~broken
        self.root = np.full(rows, -1)
        self.root[row[before == 0]] = at[before == 0]
        self.root[broken] = -1
        self.keys = np.flatnonzero(key)
        self._odd_keys = None

    def children(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The elements of the lists (or values of the objects), in order: token, index of the list, place in it."""
        inv = np.full(len(self.kind) + 1, -1)
        inv[lists] = np.arange(len(lists))
        found = np.flatnonzero(self.value & (inv[self.parent] >= 0))
        owner = inv[self.parent[found]]
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
        return found, owner, np.arange(len(owner)) - np.searchsorted(owner, owner)

    def member(self, objects: np.ndarray, name: str) -> np.ndarray:
        """The value of the member of each object (-1 for none); of repeated names the last counts."""
        want = np.frombuffer(name.encode(), np.uint8)
        k = self.keys[self.stop[self.keys] - self.pos[self.keys] - 1 == len(want)]
        for i, c in enumerate(want):
            k = k[self.data[self.pos[k] + 1 + i] == c]
        if self._odd_keys is None:
            place, offs = _ranges(self.pos[self.keys], self.stop[self.keys])
            held = np.concatenate([[0], np.cumsum(self.data[place] == 92)])
            odd = self.keys[held[offs[1:]] > held[offs[:-1]]]
            self._odd_keys = list(zip(odd.tolist(), self.strings(odd).to_pylist(), strict=True))
        more = [t for t, s in self._odd_keys if s == name]
        k = np.sort(np.concatenate([k, more]).astype(np.int64)) if more else k
        inv = np.full(len(self.kind) + 1, -1)
        inv[objects] = np.arange(len(objects))
        owner = inv[self.parent[k]]
        out = np.full(len(objects), -1)
        out[owner[owner >= 0]] = k[owner >= 0] + 2
        return out

    def strings(self, tokens: np.ndarray) -> pa.Array:
        """The strings that the tokens stand for."""
        place, offs = _ranges(self.pos[tokens] + 1, self.stop[tokens])
        raw = self.data[place]
        intro = np.flatnonzero(raw == 92)
        if not len(intro):
            return _strings(raw, offs)
        fresh = np.diff(intro, prepend=-2) != 1
        first = intro[fresh][np.cumsum(fresh) - 1]
        intro = intro[(intro - first) % 2 == 0]
        coded = np.unique(np.searchsorted(offs, intro[raw[intro + 1] == ord("u")], "right") - 1)
        kept = np.ones(len(raw), bool)
        kept[intro] = False
        plain = raw.copy()
        plain[intro + 1] = _UNESCAPE[raw[intro + 1]]
        if not len(coded):
            return _strings(plain[kept], np.concatenate([[0], np.cumsum(kept)])[offs])
        out = [json.loads(b'"' + raw[a:b].tobytes() + b'"') if i in set(coded.tolist()) else plain[a:b][kept[a:b]].tobytes().decode() for i, (a, b) in enumerate(zip(offs[:-1], offs[1:], strict=True))]
        return pa.array([s.encode("utf-8", "replace").decode() for s in out], pa.large_string())

    def text(self, tokens: np.ndarray) -> pa.Array:
        """The JSON text of objects and lists, as stored."""
        ends = np.flatnonzero((self.kind == OBJECT_END) | (self.kind == LIST_END))
        close = np.zeros(len(self.kind), np.int64)
        close[self.parent[ends]] = ends
        place, offs = _ranges(self.pos[tokens], self.stop[close[tokens]])
        return _strings(self.data[place], offs)

    def numbers(self, tokens: np.ndarray) -> np.ndarray:
        """The numbers that the tokens stand for, as doubles."""
        place, offs = _ranges(self.pos[tokens], self.stop[tokens])
        words = _strings(self.data[place], offs)
        try:
            return pc.cast(words, pa.float64()).to_numpy(zero_copy_only=False)
        except pa.ArrowInvalid:
            return np.array([_WORDS[w] if w in _WORDS else float(w) for w in words.to_pylist()], float)


def objects_of(texts: pa.Array) -> list[tuple[JsonIndex, np.ndarray, np.ndarray]]:
    """The object of each text, as (index, row of the text, token): text in a string counts as that text, a list of one
    object as that object. Rows without one are left out."""
    out, rows = [], np.arange(len(texts))
    while len(texts):
        ix = JsonIndex(texts)
        live = np.flatnonzero(ix.root >= 0)
        root, kind = ix.root[live], ix.kind[ix.root[live]]
        lists = root[kind == LIST]
        found, owner, _ = ix.children(lists)
        lone = np.bincount(owner, minlength=len(lists))[owner] == 1
        lone &= ix.kind[found] == OBJECT
        out.append((ix, np.concatenate([rows[live[kind == OBJECT]], rows[live[kind == LIST][owner[lone]]]]), np.concatenate([root[kind == OBJECT], found[lone]])))
        texts, rows = ix.strings(root[kind == STRING]), rows[live[kind == STRING]]
    return out


def points_of(ix: JsonIndex, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries of lists of points (lists of two or more numbers, or objects with numbers x and y), as (index of the
    list, place, usable, x, y). Text in a string counts as its list; anything else (-1 too) has no entry."""
    kind = np.where(tokens >= 0, ix.kind[tokens], 0) if len(ix.kind) else np.zeros(len(tokens), int)
    mine = np.flatnonzero(kind == LIST)
    entry, owner, place = ix.children(tokens[mine])
    first, second = np.full(len(entry), -1), np.full(len(entry), -1)
    pairs = np.flatnonzero(ix.kind[entry] == LIST)
    part, of, at = ix.children(entry[pairs])
    first[pairs[of[at == 0]]], second[pairs[of[at == 1]]] = part[at == 0], part[at == 1]
    named = np.flatnonzero(ix.kind[entry] == OBJECT)
    first[named], second[named] = ix.member(entry[named], "x"), ix.member(entry[named], "y")
    ok = (first >= 0) & (second >= 0)
    ok[ok] = ix.number[first[ok]] & ix.number[second[ok]]
    x, y = np.full(len(entry), np.nan), np.full(len(entry), np.nan)
    x[ok], y[ok] = ix.numbers(first[ok]), ix.numbers(second[ok])
    out = [mine[owner], place, ok, x, y]
    texts = np.flatnonzero(kind == STRING)
    if len(texts):
        inner = JsonIndex(ix.strings(tokens[texts]))
        more = points_of(inner, inner.root)
        out = [np.concatenate([a, b]) for a, b in zip(out, [texts[more[0]], *more[1:]], strict=True)]
        order = np.argsort(out[0], kind="stable")
        out = [a[order] for a in out]
    return tuple(out)
