"""Hashed words and character n-grams, vectorised over many words at once."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15  # 2^64 / golden ratio, an odd number
_BASE = 1_000_003


def _mix(h):
    h = h * np.uint64(_MULTIPLIER)
    return (h ^ (h >> np.uint64(29))) * np.uint64(_MULTIPLIER)


def _spans(words: list[bytes]):
    """The words between marks as one byte array, with their first and end places."""
    data = np.frombuffer(b"".join([b"<%b>" % w for w in words]), dtype=np.uint8)
    ends = np.cumsum(np.array([len(w) + 2 for w in words], dtype=np.int64))
    return data.astype(np.uint64) + np.uint64(1), np.append(0, ends[:-1]), ends


def word_hashes(words: list[bytes]):
    """A 64-bit hash of each whole word."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    data, first, ends = _spans(words)
    powers = np.cumprod(np.full(int((ends - first).max()), _BASE, dtype=np.uint64))
    place = np.arange(len(data)) - np.repeat(first, ends - first)
    return _mix(np.add.reduceat(data * powers[place], first))


def subwords(words: list[bytes], least: int, most: int):
    """Hashes of each word and of its character n-grams (bytes, with marks at the word's
    ends), and the position of the word that each belongs to."""
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    data, first, ends = _spans(words)
    owner = np.repeat(np.arange(len(words)), ends - first)
    hashes, owners = [word_hashes(words)], [np.arange(len(words))]
    for n in range(least, most + 1):
        if len(data) < n:
            break
        at = len(data) - n + 1
        h = np.zeros(at, dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(_BASE) + data[j:j + at]
        whole = np.arange(at) + n <= ends[owner[:at]]
        hashes.append(_mix(h[whole] + np.uint64(n)))
        owners.append(owner[:at][whole])
    return np.concatenate(hashes), np.concatenate(owners)


_WIDE = 0xD6E8FEB86659FD93  # an odd number
_SLICE = 1 << 15       # bytes hashed at once: their running sums stay in the cache


def _blank(data):
    """Which bytes are ASCII white space: 9 to 13 and 32."""
    return (data - np.uint8(9) < 5) | (data == 32)


def _powers(base: int, n: int):
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class TokenHashes:
    """62-bit hashes of the words (A-Z lower-cased, cut at ASCII white space) of many texts
    at once: a word's hash is a difference of two running sums, without a loop over words."""

    def __init__(self):
        # a slice and the rest of its last word
        self.up, self.down = _powers(_WIDE, 2 * _SLICE), _powers(pow(_WIDE, -1, 2 ** 64), 2 * _SLICE)

    def _slice(self, data):
        """Hashes and first places of the words of an array of bytes."""
        if len(data) >= len(self.up):  # one word longer than a slice
            self.up, self.down = _powers(_WIDE, len(data) + 1), _powers(pow(_WIDE, -1, 2 ** 64), len(data) + 1)
        word = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(_blank(data), out=word[1:-1])
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, end = edge[::2], edge[1::2]
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.up[:len(data)]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(terms, out=sums[1:])
        h = (sums[end] - sums[first]) * self.down[first] + (end - first).astype(np.uint64)
        return (_mix(h) >> np.uint64(2)).view(np.int64), first

    def __call__(self, texts: list[bytes]):
        """All words' hashes, text by text, and the number of words of each text."""
        raw = b"\n".join(texts).lower()
        data = np.frombuffer(raw, dtype=np.uint8)
        hashes, places, at = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], 0
        while at < len(data):
            end, look = at + _SLICE, 256
            while end < len(data):  # up to white space
                blank = _blank(data[end:end + look])
                if blank.any():
                    end += int(blank.argmax()) + 1
                    break
                end, look = end + look, 2 * look
            h, first = self._slice(data[at:end])
            hashes.append(h)
            places.append(first + at)
            at = end
        starts = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
        cuts = np.searchsorted(np.concatenate(places), starts)
        return np.concatenate(hashes), np.diff(np.append(0, cuts))
