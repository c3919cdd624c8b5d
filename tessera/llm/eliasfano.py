"""Elias-Fano sequences and an n-gram trie over them, in flat arrays that are memory-mapped from one file."""

from __future__ import annotations

import json

import numpy as np

_64 = np.uint64(64)
_ONE = np.uint64(1)


def _low_mask(bits: np.ndarray) -> np.ndarray:
    """Words with the given number (0..63) of low bits set."""
    return (_ONE << bits.astype(np.uint64)) - _ONE


def select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the ``k``-th one (from 0) of each word."""
    at = np.zeros(len(words), np.uint64)
    k = k.astype(np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        part = (words >> at) & _low_mask(np.uint64(half))
        ones = np.bitwise_count(part).astype(np.int64)
        right = k >= ones
        k = k - np.where(right, ones, 0)
        at = at + np.where(right, np.uint64(half), np.uint64(0))
    return at.astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of n numbers below u, in about n * (2 + log2(u / n)) bits and a count a word.

    The low bits of each number are packed; of the high parts, a bit vector has a one for each number and a zero for each
    step of the high part.
    """

    def __init__(self, arrays: dict[str, np.ndarray], n: int, bits: int):
        self.n, self.bits = n, bits
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]
        self.zeros = np.arange(0, 64 * len(self.high) + 1, 64, dtype=np.int64) - self.ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        b = np.uint64(bits)
        place = (values >> b).astype(np.int64) + np.arange(n)
        flags = np.zeros(-(-(n + (top >> bits) + 2) // 64) * 64, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            v = values & _low_mask(b)
            start = np.arange(n, dtype=np.uint64) * b
            word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
            np.bitwise_or.at(low, word, v << shift)
            over = shift + b > _64
            np.bitwise_or.at(low, word[over] + 1, v[over] >> (_64 - shift[over]))
        ones = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls({"low": low, "high": high, "ones": ones}, n, bits)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ones": self.ones}

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        start = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
        left = (self.low[word + 1] << _ONE) << (np.uint64(63) - shift)
        return ((self.low[word] >> shift) | left) & _low_mask(np.uint64(self.bits))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places ``i``."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = 64 * word + select_in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.bits)) | self._lows(i)

    def successor(self, x: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place in ``first``..``end`` whose number is at least ``x``; ``end`` if there is none."""
        x = x.astype(np.uint64)
        b = np.uint64(self.bits)
        want = (x >> b).astype(np.int64)
        # the numbers with the high part of x lie between two zeros of the bit vector
        at = np.minimum(np.maximum(self._after_zero(want - 1), first), end)
        stop = np.minimum(np.maximum(self._after_zero(want), at), end)
        lowest = x & _low_mask(b)
        live = np.flatnonzero(at < stop)
        while len(live):  # they ascend in their low bits
            middle = (at[live] + stop[live]) >> 1
            less = self._lows(middle) < lowest[live]
            at[live] = np.where(less, middle + 1, at[live])
            stop[live] = np.where(less, stop[live], middle)
            live = live[at[live] < stop[live]]
        return at

    def _after_zero(self, k: np.ndarray) -> np.ndarray:
        """How many numbers stand before the ``k``-th zero (from 0): 0 for -1, all beyond the last zero."""
        out = np.zeros(len(k), np.int64)
        inside = (k >= 0) & (k < self.zeros[-1])
        out[k >= self.zeros[-1]] = self.n
        j = k[inside]
        word = np.searchsorted(self.zeros, j, "right") - 1
        out[inside] = 64 * word + select_in_word(~self.high[word], j - self.zeros[word]) - j
        return out


class NgramTrie:
    """Levels of Elias-Fano successors and pointers, with a quantised log10 probability for each n-gram, and for those of
    all levels but the last the quantised log10 weight of backing off from it.

    Level 0 holds the sorted first words. The children of node i of a level are the places pointer[i]..pointer[i+1] of
    the next; a child is stored relative to its context: word + base, the base being one more than the last number
    stored for the context before, so that the whole level is one ascending sequence.
    """

    STEP, BACK_STEP = 4096.0, 16384.0

    def __init__(self, words: list[EliasFano], pointers: list[EliasFano], codes: list[np.ndarray], backs: list[np.ndarray]):
        self.words, self.pointers, self.codes, self.backs = words, pointers, codes, backs

    @classmethod
    def build(cls, ngrams: list[np.ndarray], logp: list[np.ndarray], back: list[np.ndarray] = ()) -> NgramTrie:
        """``ngrams[k]``: distinct rows of k + 1 word ids in lexicographic order, each with its prefix in ``ngrams[k-1]``;
        ``logp`` and ``back``: their probabilities and back-off weights, in logarithms, by level."""
        words, pointers = [EliasFano.build(ngrams[0][:, 0])], []
        for k in range(1, len(ngrams)):
            rows, above = ngrams[k], ngrams[k - 1]
            if len(rows):
                new = np.r_[True, (rows[1:, :-1] != rows[:-1, :-1]).any(1)]
                starts = np.flatnonzero(new)
                parent = _rank_rows(above, rows[starts, :-1])
                size = np.diff(np.r_[starts, len(rows)])
                counts = np.zeros(len(above), np.int64)
                counts[parent] = size
                last = rows[np.r_[starts[1:], len(rows)] - 1, -1].astype(np.uint64)
                base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(last + _ONE, dtype=np.uint64)[:-1]])
                stored = rows[:, -1].astype(np.uint64) + np.repeat(base, size)
            else:
                counts, stored = np.zeros(len(above), np.int64), np.zeros(0, np.uint64)
            pointers.append(EliasFano.build(np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])))
            words.append(EliasFano.build(stored))
        quantised = lambda x, step: np.clip(np.rint(-x * step), 0, 65535).astype(np.uint16)
        return cls(words, pointers, [quantised(x, cls.STEP) for x in logp], [quantised(x, cls.BACK_STEP) for x in back])

    def find(self, ids: np.ndarray) -> np.ndarray:
        """Places of ``ids`` (rows of n word ids) in level n - 1; -1 for those that are not there."""
        n = len(ids)
        level = self.words[0]
        first, end = np.zeros(n, np.int64), np.full(n, level.n)
        base = np.zeros(n, np.uint64)
        out = np.zeros(n, np.int64)
        for k in range(ids.shape[1]):
            level = self.words[k]
            x = ids[:, k].astype(np.uint64) + base
            at = level.successor(x, first, end)
            ok = (out >= 0) & (at < end)
            ok[ok] = level.get(at[ok]) == x[ok]
            out = np.where(ok, at, -1)
            if k + 1 < ids.shape[1]:
                node = np.where(ok, at, 0)
                below = self.pointers[k]
                first, end = below.get(node), below.get(node + 1)
                first, end = first.astype(np.int64), end.astype(np.int64)
                end = np.where(ok, end, first)
                base = np.zeros(n, np.uint64)
                inner = ok & (first > 0)
                base[inner] = self.words[k + 1].get(first[inner] - 1) + _ONE
        return out

    def logp(self, level: int, places: np.ndarray) -> np.ndarray:
        return self.codes[level][places] / -self.STEP

    def back(self, level: int, places: np.ndarray) -> np.ndarray:
        return self.backs[level][places] / -self.BACK_STEP

    def save(self, path: str) -> None:
        """One file: a line of JSON that says where each array lies, then the arrays."""
        parts, head, at = [], {"levels": len(self.words), "ef": {}, "arrays": {}}, 0
        for kind, seqs in (("w", self.words), ("p", self.pointers)):
            for k, ef in enumerate(seqs):
                head["ef"][f"{kind}{k}"] = [ef.n, ef.bits]
                parts += [(f"{kind}{k}.{name}", a) for name, a in ef.arrays().items()]
        parts += [(f"c{k}", a) for k, a in enumerate(self.codes)] + [(f"b{k}", a) for k, a in enumerate(self.backs)]
        for name, a in parts:
            head["arrays"][name] = [at, len(a), a.dtype.str]
            at += -(-a.nbytes // 8) * 8
        line = json.dumps(head).encode()
        line += b" " * (-(len(line) + 1) % 8) + b"\n"
        with open(path, "wb") as f:
            f.write(line)
            for _, a in parts:
                f.write(a.tobytes())
                f.write(b"\0" * (-a.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> NgramTrie:
        with open(path, "rb") as f:
            line = f.readline()
        head = json.loads(line)
        data = np.memmap(path, np.uint8, "r", offset=0)

        def array(name):
            at, n, kind = head["arrays"][name]
            kind = np.dtype(kind)
            return data[len(line) + at : len(line) + at + n * kind.itemsize].view(kind)

        def ef(name):
            return EliasFano({x: array(f"{name}.{x}") for x in ("low", "high", "ones")}, *head["ef"][name])

        levels = head["levels"]
        codes, backs = ([array(f"{kind}{k}") for k in range(levels) if f"{kind}{k}" in head["arrays"]] for kind in "cb")
        return cls([ef(f"w{k}") for k in range(levels)], [ef(f"p{k}") for k in range(levels - 1)], codes, backs)


def _rank_rows(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of ``rows`` in the sorted distinct rows of ``table``, where each of them is."""
    if table.shape[1] == 1:
        return np.searchsorted(table[:, 0], rows[:, 0])
    both = np.concatenate([table, rows])
    _, inverse = np.unique(both, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    return inverse[len(table) :]
