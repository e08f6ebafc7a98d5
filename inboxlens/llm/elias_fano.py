"""Elias-Fano sequences over numpy buffers.

A non-decreasing sequence of ``n`` values below ``u`` takes about
``2 + log2(u / n)`` bits a value: the low ``l`` bits packed side by side, the high parts
in unary in a bit vector.  A directory with one 32-bit count for every 512 bits serves
``select`` on ones and zeros; no 64-bit offset table is kept.  All queries take arrays.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

_HEAD = 4      # 64-bit words: n, universe, low bits, high words
_BLOCK = 8     # high words for each count of the directory
_WINDOW = 57   # so many bits are within the 64 that begin at their first byte
_LOW8, _ONES16, _TOP16 = (np.uint64(x) for x in (0x00FF00FF00FF00FF, 0x0001000100010001, 0x8000800080008000))
_ONES8, _TOP8 = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: place of the i-th one of a byte, at 8 * byte + i
_PLACES = np.array([([k for k in range(8) if b >> k & 1] + [0] * 8)[i] for b in range(256) for i in range(8)])


def _popcount(words):
    return np.bitwise_count(words).astype(np.int64)


def encode(values, universe: int | None = None) -> bytes:
    """The sequence as bytes (a multiple of 8); ``values`` ascend and are below ``universe``."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    u = int(universe if universe is not None else (int(v[-1]) + 1 if n else 1))
    if n and int(v[-1]) >= u:
        raise ValueError("a value reaches the universe")
    if n > 1 and not bool((v[1:] >= v[:-1]).all()):
        raise ValueError("the values must ascend")
    low_bits = max(0, (u // max(n, 1)).bit_length() - 1)
    low = np.zeros((n * low_bits + 63) // 64 + 1, dtype=np.uint64)
    if low_bits:
        at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        part = v & np.uint64((1 << low_bits) - 1)
        np.bitwise_or.at(low, word, part << shift)
        over = shift + np.uint64(low_bits) > 64
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
    ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    words = (n + ((u - 1) >> low_bits) + 1) // 64 + 1
    words += -words % _BLOCK
    high = np.zeros(words * 64, dtype=np.uint8)
    high[ones] = 1
    high = np.packbits(high, bitorder="little").view(np.uint64)
    counts = np.add.reduceat(_popcount(high), np.arange(0, words, _BLOCK))
    directory = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32)
    if len(directory) % 2:
        directory = np.append(directory, directory[-1:])
    head = np.array([n, u, low_bits, words], dtype=np.uint64)
    return b"".join(x.tobytes() for x in (head, low, high, directory))


class EliasFano:
    """Read access to an encoded sequence in a buffer (bytes or a memory map of uint8)."""

    def __init__(self, buffer, at: int = 0):
        buf = np.frombuffer(buffer, dtype=np.uint8) if not isinstance(buffer, np.ndarray) else buffer
        head = buf[at:at + 8 * _HEAD].view(np.uint64)
        self.n, self.universe, self.low_bits, words = (int(x) for x in head)
        a = at + 8 * _HEAD
        b = a + 8 * ((self.n * self.low_bits + 63) // 64 + 1)
        c = b + 8 * words
        blocks = words // _BLOCK + 1
        self.low, self.high = buf[a:b].view(np.uint64), buf[b:c].view(np.uint64)
        self.ones = buf[c:c + 4 * blocks].view(np.uint32)
        self.end = c + 4 * (blocks + blocks % 2)

    @cached_property
    def windows(self):
        """The 64 bits from each byte of the low bits on."""
        return np.ndarray(8 * len(self.low) - 7, dtype="<i8", buffer=self.low, strides=(1,))

    @cached_property
    def before(self):
        """The ones and the zeros before each block of the high bits."""
        ones = self.ones.astype(np.int64)
        return ones, np.arange(len(ones)) * (64 * _BLOCK) - ones

    def _low(self, i):
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.int64)
        if self.low_bits <= _WINDOW:
            at = i * self.low_bits
            return self.windows[at >> 3] >> (at & 7) & ((1 << self.low_bits) - 1)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        first = self.low[word] >> shift
        over = shift + np.uint64(self.low_bits) > 64
        if over.any():
            first[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return (first & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, i, zeros: bool):
        """Position in the high bits of the i-th (from 0) one or zero."""
        before = self.before[zeros]
        block = np.searchsorted(before, i, side="right") - 1
        block = np.minimum(block, len(self.high) // _BLOCK - 1)
        left = (i - before[block]).astype(np.uint64)
        words = self.high.reshape(-1, _BLOCK)[block]
        if zeros:
            words = ~words
        # running counts of the pairs of words, in four lanes of 16 bits; then of the bytes of
        # the word, in eight of 8 bits; the lanes that are not above ``left`` are passed
        counts = np.bitwise_count(words)
        packed = counts.view(np.uint64).ravel()
        sums = ((packed & _LOW8) + ((packed >> np.uint64(8)) & _LOW8)) * _ONES16
        pair = np.bitwise_count(((left * _ONES16 | _TOP16) - sums) & _TOP16).astype(np.uint64)
        left -= (sums << np.uint64(16)) >> (pair << np.uint64(4)) & np.uint64(0xFFFF)
        word = pair.astype(np.int64) * 2
        row = np.arange(len(word)) * _BLOCK
        count = counts.ravel()[row + word].astype(np.uint64)
        on = left >= count
        left -= count * on
        word += on
        value = words.ravel()[row + word]
        sums = np.bitwise_count(value.view(np.uint8)).view(np.uint64) * _ONES8
        byte = np.bitwise_count(((left * _ONES8 | _TOP8) - sums) & _TOP8).astype(np.uint64) << np.uint64(3)
        left -= (sums << np.uint64(8)) >> byte & np.uint64(0xFF)
        bit = _PLACES[((value >> byte) & np.uint64(0xFF)) << np.uint64(3) | left]
        return (block * _BLOCK + word) * 64 + byte.astype(np.int64) + bit

    def get(self, i):
        """The values at positions ``i``."""
        i = np.asarray(i, dtype=np.int64)
        if not len(i):
            return np.zeros(0, dtype=np.int64)
        return ((self._select(i, False) - i) << self.low_bits) | self._low(i)

    def all(self):
        """Every value, in order."""
        return self.between(0, self.n)

    def between(self, a: int, b: int):
        """The values at positions from a to b - 1; only their part of the bits is read."""
        if a >= b:
            return np.zeros(0, dtype=np.int64)
        first, last = self._select(np.array([a, b - 1]), False).tolist()
        words = self.high[first >> 6:(last >> 6) + 1]
        bits = np.unpackbits(words.view(np.uint8), bitorder="little")[first & 63:]
        i = np.arange(a, b, dtype=np.int64)
        return ((np.flatnonzero(bits)[:b - a] + (first - i)) << self.low_bits) | self._low(i)

    def _search(self, x):
        """Of values below the universe: the first position and the end of the run of positions
        that share each one's high part, and its low bits."""
        h = x >> self.low_bits
        low = self._select(np.maximum(h - 1, 0), True) + 1 - h
        low[h == 0] = 0
        at = low + h  # the run's ones go on to the next zero, mostly in the same word
        rest = ~self.high[at >> 6] >> (at & 63).astype(np.uint64)
        end = low + np.bitwise_count((rest & -rest) - np.uint64(1))
        far = np.flatnonzero(rest == 0)
        end[far] = self._select(h[far], True) - h[far]
        return low, end, x & ((1 << self.low_bits) - 1)

    def _bisect(self, low, high, want):
        """The first positions from ``low`` whose low bits are not below ``want``, or ``high``."""
        todo = np.flatnonzero(low < high)
        a, b, w = low[todo], high[todo], want[todo]
        while len(todo):
            mid = (a + b) >> 1
            below = self._low(mid) < w
            a, b = np.where(below, mid + 1, a), np.where(below, b, mid)
            open_ = a < b
            low[todo] = a
            todo, a, b, w = todo[open_], a[open_], b[open_], w[open_]
        return low

    def successor(self, x):
        """For each x the first position whose value is not below it (n if there is none)."""
        x = np.asarray(x, dtype=np.int64)
        out = np.full(len(x), self.n, dtype=np.int64)
        inside = np.flatnonzero(x < self.universe)
        if len(inside) and self.n:
            out[inside] = self._bisect(*self._search(np.maximum(x[inside], 0)))
        return out

    def find(self, x):
        """For each x the first position that holds it, or -1."""
        x = np.asarray(x, dtype=np.int64)
        out = np.full(len(x), -1, dtype=np.int64)
        if not len(x) or not self.n:
            return out
        if x.min() < 0 or x.max() >= self.universe:
            inside = np.flatnonzero((x >= 0) & (x < self.universe))
            out[inside] = self.find(x[inside])
            return out
        low, end, want = self._search(x)
        run = np.flatnonzero(low < end)
        want = want[run]
        at = self._bisect(low[run], end[run] - 1, want)  # no further: the last one is compared here
        hit = self._low(at) == want
        out[run[hit]] = at[hit]
        return out
