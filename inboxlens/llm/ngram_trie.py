"""Language-model scores from an Elias-Fano n-gram trie (words, word pairs, triples).

The trie has two levels or three (``order``), each cut into shards by ranges and kept in files of the shared
folder, which tasks map into memory:

* words: their hashes in order (Elias-Fano; a word's id is its rank) and their counts;
* pairs: for each context, a word id, its successors' ids in order.  A successor is kept
  relative to its context, as ``context * V + word`` less the shard's first value, so the
  whole level is one monotone Elias-Fano sequence, and a lookup is a successor search from
  the context's place.  Monotone pointers (Elias-Fano too) give each context's range; the
  pairs' smoothed log-probabilities and the contexts' backoff weights are quantised to 16
  bits, downwards, so that no context's probabilities add up to more than one;
* triples: the same, a context being a pair, known by its place in the second level.

The texts are read twice: to count the words, and to write every text's word ids, from which
pairs and triples are counted and all scores are taken.

Counting is distributed: a task reduces its documents to sorted distinct keys with counts,
cuts them at the shards' bounds and sends each part as one row; a shard merges its parts.
Triples are sent with their contexts' pairs, of which a shard knows the places: those between
its bounds, read in order, so that a task need not search the second level for each token.
All of a context's successors meet in one shard, at most V short numbers however often the
context occurs.  Probabilities interpolate by absolute discounting: the discount of
contexts seen about equally often comes from their counts of pairs seen once and twice.
A pair that was not seen has its context's backoff weight times the word's probability,
(c + 0.1) / (N + 0.1 (V + 1)), which also serves words never seen.  With three levels a
triple's probability interpolates with its last pair's in the same way; a text's first word
has one END before it and is scored as a pair.

Rows: a null text is an empty one (its end alone); a null doc_id is a training row; repeated
rows count as often as they stand; an empty training set scores with N = V = 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, give_back, held_out, map_file, materialise, put_file, shared_path, slices, text_of
from .elias_fano import EliasFano, encode
from .wordhash import TokenHashes

END = b"\n"          # the end of a text, before its first word as well; no word holds it
_SPAN = 2 ** 62      # word hashes are below
_END = _SPAN - 1     # the hash of END
_STEPS = 2 ** 16 - 1  # quantisation
_CLASSES = 24        # contexts are classed by the logarithm of their count
_ALPHA = 0.1
_CHARS = 6_000_000   # bytes of the texts that are hashed at once
_ROWS = 4096         # most texts among them
_PART = "shard int, n int, keys binary, counts binary"
_BLOCK = ("held_out boolean, doc_id array<long>, n_tokens array<long>, n_known array<long>, "
          "base_score array<double>, ids binary")


def hash_words(words: list[bytes]):
    """The hashes by which the trie knows words; END has a number of its own."""
    import numpy as np

    out = np.full(len(words), _END, dtype=np.int64)
    plain = [i for i, w in enumerate(words) if w != END]
    out[plain] = TokenHashes()([words[i] for i in plain])[0]
    return out


def with_ends(texts: list[bytes], hasher):
    """Token hashes of the texts one after the other, each closed by END, and each text's
    number of tokens."""
    import numpy as np

    hashes, lengths = hasher(texts)
    return np.insert(hashes, np.cumsum(lengths), _END), lengths + 1


def stretches(x) -> list[tuple[int, int]]:
    """The bounds of the stretches of equal values in an array."""
    import numpy as np

    cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    return list(zip(cuts, cuts[1:], strict=False)) if len(x) else []


def ranked(x):
    """The distinct values of an array of numbers from 0, in order, and each one's place among
    them.  Sorts the values' upper bits with their places side by side in one number, which
    costs less than an argsort; values that differ in the bits left out are sorted again."""
    import numpy as np

    if not len(x):
        return x, x
    bits = len(x).bit_length()
    left = max(0, int(x.max()).bit_length() + bits - 63)
    both = x >> left << bits | np.arange(len(x))
    both.sort()
    order = both & ((1 << bits) - 1)
    sorted_ = x[order]
    new = sorted_[1:] != sorted_[:-1]
    if left:
        upper = both >> bits
        mixed = np.flatnonzero(new & (upper[1:] == upper[:-1]))
        if len(mixed):
            begins = np.flatnonzero(np.append(True, upper[1:] != upper[:-1]))
            group = np.unique(np.searchsorted(begins, mixed, side="right") - 1)
            size = np.diff(np.append(begins, len(x)))[group]
            at = np.repeat(begins[group] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            order[at] = order[at][np.argsort(sorted_[at])]
            sorted_ = x[order]
            new = sorted_[1:] != sorted_[:-1]
    first = np.append(True, new)
    back = np.empty(len(x), dtype=np.int64)
    back[order] = np.cumsum(first) - 1
    return sorted_[first], back


def merged(keys, counts):
    """Sorted distinct keys with their counts added."""
    import numpy as np

    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], first)


def _packed(x) -> bytes:
    """64-bit numbers as their number of byte planes that are not zero, and those compressed."""
    import numpy as np
    import pyarrow as pa

    planes = max(1, -(-int(np.bitwise_or.reduce(x.view(np.uint64))).bit_length() // 8))
    raw = x.view("u1").reshape(-1, 8)[:, :planes].T.tobytes()
    return bytes([planes]) + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int):
    import numpy as np
    import pyarrow as pa

    planes = pa.decompress(raw[1:], decompressed_size=raw[0] * n, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :raw[0]] = np.frombuffer(planes, dtype=np.uint8).reshape(raw[0], n).T
    return out.view(np.int64).ravel()


def parts(keys, counts, step: int) -> Iterator[tuple]:
    """The sorted keys, cut into shards of ``step`` keys' room, as rows: shard, number, and
    the differences of the keys and their counts packed."""
    import numpy as np

    shard = keys // step
    for a, b in stretches(shard):
        own = keys[a:b] - int(shard[a]) * step
        yield int(shard[a]), b - a, _packed(np.append(own[:1], np.diff(own))), _packed(counts[a:b].astype(np.int64))


def unpacked(n: int, keys: bytes, counts: bytes):
    import numpy as np

    return np.cumsum(_unpacked(keys, n)), _unpacked(counts, n)


def _batch(rows: Iterator[tuple]):
    """Parts as a record batch."""
    import pyarrow as pa

    names = (("shard", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()))
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, names, strict=True)],
                                      schema=pa.schema(names))


def _gathered(pdf, unpack=unpacked):
    """The merged keys and counts of a shard's rows."""
    import numpy as np

    both = [unpack(*r) for r in zip(pdf["n"], pdf["keys"], pdf["counts"], strict=True)]
    return merged(np.concatenate([k for k, _ in both]), np.concatenate([c for _, c in both]))


class Counter:
    """Distinct keys and counts of a task.  Whenever many have come together they are
    merged, and sent on if they are still many: what a task holds is bounded."""

    def __init__(self, step: int, most: int = 1_000_000):
        self.step, self.most, self.lists, self.size = step, most, [], 0

    def add(self, keys, counts) -> Iterator:
        self.lists.append((keys, counts))
        self.size += len(keys)
        if self.size > self.most:
            self._merge()
            if self.size > self.most // 2:
                yield from self.rows()

    def _merge(self) -> None:
        import numpy as np

        if len(self.lists) == 1:  # sorted and distinct as it came
            return
        keys, counts = (np.concatenate(x) for x in zip(*self.lists, strict=True))
        self.lists = [merged(keys, counts)]
        self.size = len(self.lists[0][0])

    def rows(self) -> Iterator:
        """What has come together, as a record batch with a row for each shard."""
        if not self.size:
            return
        self._merge()
        batch = _batch(parts(*self.lists[0], self.step))
        self.lists, self.size = [], 0
        yield batch


def triple_parts(pair, word, distinct: int, bounds) -> Iterator[tuple]:
    """The triples of the pairs' keys with the words after them, each once with its count, cut
    where a pair reaches one of ``bounds``, as rows: shard, number, and keys and counts packed."""
    import numpy as np

    own, back = ranked(pair)
    key, counts = np.unique(back * distinct + word, return_counts=True)
    at, word = key // distinct, key % distinct
    first = np.append(True, at[1:] != at[:-1])
    marked = word << 1 | first  # each pair's words, the first one marked
    begins = np.append(np.flatnonzero(first), len(key))
    shard = np.searchsorted(bounds, own, side="right")
    for a, b in stretches(shard):
        i, j = int(begins[a]), int(begins[b])
        keys = _packed(np.append(own[a], np.diff(own[a:b]))), _packed(marked[i:j])
        yield int(shard[a]), j - i, b"".join([np.array([b - a, len(keys[0])]).tobytes(), *keys]), \
            _packed(counts[i:j].astype(np.int64))


def unpacked_triples(n: int, keys: bytes, counts: bytes, distinct: int, pairs):
    """The keys, a pair's place among ``pairs`` times ``distinct`` plus the word, and counts."""
    import numpy as np

    size, cut = np.frombuffer(keys, dtype=np.int64, count=2).tolist()
    place = np.searchsorted(pairs, np.cumsum(_unpacked(keys[16:16 + cut], size)))
    marked = _unpacked(keys[16 + cut:], n)
    return place[np.cumsum(marked & 1) - 1] * distinct + (marked >> 1), _unpacked(counts, n)


class TripleCounter:
    """The triples of a task, sent on whenever many tokens have come together."""

    def __init__(self, distinct: int, bounds, most: int = 1_000_000):
        self.distinct, self.bounds, self.most, self.lists, self.size = distinct, bounds, most, [], 0

    def add(self, pair, word) -> Iterator:
        self.lists.append((pair, word))
        self.size += len(pair)
        if self.size > self.most:
            yield from self.rows()

    def rows(self) -> Iterator:
        import numpy as np

        if self.size:
            pair, word = (np.concatenate(x) for x in zip(*self.lists, strict=True))
            self.lists, self.size = [], 0
            yield _batch(triple_parts(pair, word, self.distinct, self.bounds))


@dataclass(frozen=True)
class Words:
    """The trie's first level."""

    step: int              # room of a shard, in hashes
    files: dict[int, str]  # shard to file
    base: dict[int, int]   # shard to the id of its first word
    distinct: int
    tokens: int
    end: int               # id of END, -1 without training documents

    @staticmethod
    def file(hashes, counts) -> list[bytes]:
        import numpy as np

        return [encode(hashes, int(hashes[-1]) + 1), np.asarray(counts, dtype="<i8").tobytes()]

    def _open(self, shard: int, opened: dict):
        import numpy as np

        if ("w", shard) not in opened:
            raw = map_file(self.files[shard])
            level = EliasFano(raw)
            opened["w", shard] = level, raw[level.end:].view(np.int64)
        return opened["w", shard]

    def counts_at(self, ids, opened: dict):
        """The counts of the words with these ids."""
        import numpy as np

        shards = sorted(self.files)
        first = np.array([self.base[s] for s in shards])
        ids, back = ranked(ids)
        out, at = np.zeros(len(ids), dtype=np.int64), np.searchsorted(first, ids, side="right") - 1
        for a, b in stretches(at):
            i = int(at[a])
            out[a:b] = self._open(shards[i], opened)[1][ids[a:b] - first[i]]
        return out[back]

    def lookup(self, hashes, opened: dict):
        """Ids (-1: not in the trie) and counts of the hashes."""
        import numpy as np

        ids = np.full(len(hashes), -1, dtype=np.int64)
        counts = np.zeros(len(hashes), dtype=np.int64)
        shard = hashes // self.step
        for s in np.unique(shard).tolist():
            if s not in self.files:
                continue
            level, own = self._open(s, opened)
            on = np.flatnonzero(shard == s)
            at = level.find(hashes[on] - s * self.step)
            hit = at >= 0
            ids[on[hit]] = at[hit] + self.base[s]
            counts[on[hit]] = own[at[hit]]
        return ids, counts

    def log10(self, counts):
        """The word probability by count; see the module's text."""
        import numpy as np

        return np.log10((counts + _ALPHA) / (self.tokens + _ALPHA * (self.distinct + 1)))


class Reader:
    """Token ids of texts, with the words met so far."""

    def __init__(self, words: Words, most_words: int = 600_000):
        self.words, self.most_words, self.opened, self.hasher = words, most_words, {}, TokenHashes()
        self._clear()

    def _clear(self) -> None:
        import numpy as np

        self.hashes = np.array([_END], dtype=np.int64)
        self.ids, self.counts = self.words.lookup(self.hashes, self.opened)

    def tokens(self, texts: list[bytes]):
        """For the texts one after the other: each token's id and count, the id before it,
        and each text's number of tokens.  Every text closes with END, which also stands
        before its first word."""
        import numpy as np

        if len(self.hashes) > self.most_words:
            self._clear()
        flat, lengths = with_ends(texts, self.hasher)
        own, back = ranked(flat)
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        new = own[self.hashes[at] != own]
        if len(new):
            ids, counts = self.words.lookup(new, self.opened)
            place = np.searchsorted(self.hashes, new)
            self.hashes = np.insert(self.hashes, place, new)
            self.ids, self.counts = np.insert(self.ids, place, ids), np.insert(self.counts, place, counts)
            at = np.searchsorted(self.hashes, own)
        ids, counts = self.ids[at][back], self.counts[at][back]
        return ids, counts, np.append(self.words.end, ids[:-1]), lengths


def _files(manifest: DataFrame) -> list:
    return manifest.orderBy("shard").collect()  # one small row for each shard


def count_words(docs: DataFrame, shards: int) -> Words:
    """The first level from the texts of ``docs (text binary)``."""
    spark = docs.sparkSession
    root = shared_path(spark, "words")
    step = -(-_SPAN // shards)

    def count(batches: Iterator) -> Iterator:
        import numpy as np

        hasher, found = TokenHashes(), Counter(step)
        for batch in slices(batches, _ROWS):
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts, _CHARS):
                yield from found.add(*np.unique(with_ends(texts[a:b], hasher)[0], return_counts=True))
        yield from found.rows()
        batch = texts = found = None
        give_back()

    def write(pdf):
        import pandas as pd

        shard = int(pdf["shard"].iloc[0])
        keys, counts = _gathered(pdf)
        file = f"{root}/words-{shard:06d}.bin"
        put_file(file, Words.file(keys, counts))
        return pd.DataFrame({"shard": [shard], "file": [file], "n": [len(keys)], "tokens": [int(counts.sum())]})

    found = docs.mapInArrow(count, _PART).groupBy("shard").applyInPandas(
        write, "shard int, file string, n long, tokens long")
    rows = _files(materialise(found, "words"))
    base, at = {}, 0
    for r in rows:
        base[r["shard"]] = at
        at += r["n"]
    # END has the largest hash: the last id
    return Words(step, {r["shard"]: r["file"] for r in rows}, base, at, sum(r["tokens"] for r in rows), at - 1)


@dataclass(frozen=True)
class Pairs:
    """The trie's second level, or the third: then a context is the place of a pair."""

    distinct: int          # words
    step: int              # room of a shard, in keys: whole contexts
    files: dict[int, str]
    low: float             # least log-probability that the quantisation can write
    base: dict[int, int] = field(default_factory=dict)  # shard to the place of its first key
    total: int = 0         # keys

    def quantised(self, x):
        import numpy as np

        return np.clip(np.floor((x - self.low) / -self.low * _STEPS), 0, _STEPS).astype("<u2")

    def _open(self, shard: int, opened: dict):
        import numpy as np

        if ("p", shard) not in opened:
            raw = map_file(self.files[shard])
            keys = EliasFano(raw)
            pointers = EliasFano(raw, keys.end)
            rest = raw[pointers.end:].view("<u2")
            opened["p", shard] = keys, pointers, rest[:keys.n], rest[keys.n:]
        return opened["p", shard]

    def successors(self, context: int, opened: dict):
        """Word ids and log10 probabilities of the pairs seen after a context."""
        import numpy as np

        shard, at = divmod(context * self.distinct, self.step)
        if shard not in self.files:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        keys, pointers, prob, _ = self._open(shard, opened)
        a, b = pointers.get(np.array([at // self.distinct, at // self.distinct + 1])).tolist()
        return keys.get(np.arange(a, b)) - at, self.low - prob[a:b] / _STEPS * self.low

    def lookup(self, context, word, opened: dict):
        """For known words: log10 of the pair's probability (nan: not seen) and of the
        context's backoff weight (0: nothing seen after it)."""
        return self.search(context, word, opened)[:2]

    def search(self, context, word, opened: dict):
        """As ``lookup``, and the pair's place in this level (-1: not seen)."""
        import numpy as np

        key = context * self.distinct + word
        key, back = ranked(key)  # one search for equal pairs
        got, left, place = np.full(len(key), np.nan), np.zeros(len(key)), np.full(len(key), -1, dtype=np.int64)
        shard = key // self.step
        for a, b in stretches(shard):
            s = int(shard[a])
            if s not in self.files:
                continue
            keys, _, own, weights = self._open(s, opened)
            x = key[a:b] - s * self.step
            at = keys.find(x)
            hit = at >= 0
            got[a:b][hit] = self.low - own[at[hit]] / _STEPS * self.low
            left[a:b] = self.low - weights[x // self.distinct] / _STEPS * self.low
            place[a:b][hit] = at[hit] + self.base.get(s, 0)
        return got[back], left[back], place[back]

    def backoff(self, context, opened: dict):
        """log10 of the contexts' backoff weights (0: nothing seen after it)."""
        import numpy as np

        context, back = ranked(context)
        left, width = np.zeros(len(context)), self.step // self.distinct
        shard = context // width
        for a, b in stretches(shard):
            s = int(shard[a])
            if s in self.files:
                weights = self._open(s, opened)[3]
                left[a:b] = self.low - weights[context[a:b] - s * width] / _STEPS * self.low
        return left[back]

    def keys_at(self, place, opened: dict):
        """The keys at these places."""
        import numpy as np

        shards = sorted(self.files)
        first = np.array([self.base[s] for s in shards])
        out, at = np.zeros(len(place), dtype=np.int64), np.searchsorted(first, place, side="right") - 1
        for a, b in stretches(at):
            i = int(at[a])
            out[a:b] = self._open(shards[i], opened)[0].get(place[a:b] - first[i]) + shards[i] * self.step
        return out

    def between(self, low: int, high: int, opened: dict):
        """The keys at the places from ``low`` to before ``high``, as far as there are any."""
        import numpy as np

        shards = sorted(self.files)
        first = [*(self.base[s] for s in shards), self.total]
        out, i = [np.zeros(0, dtype=np.int64)], max(0, bisect_right(first, low) - 1)
        while i < len(shards) and first[i] < high:
            a, b = max(low, first[i]) - first[i], min(high, first[i + 1]) - first[i]
            out.append(self._open(shards[i], opened)[0].between(a, b) + shards[i] * self.step)
            i += 1
        return np.concatenate(out)


@dataclass(frozen=True)
class Triples(Pairs):
    """The trie's third level."""

    def _open(self, shard: int, opened: dict):
        own = opened.setdefault("triples", {})  # the levels' shards have the same numbers
        return super()._open(shard, own)


def chained(place, lengths):
    """For each token the place of the pair before it (-1: none), from the place of the
    pair that it closes itself."""
    import numpy as np

    out = np.append(np.int64(-1), place[:-1])
    out[np.cumsum(lengths) - lengths] = -1
    return out


def _classes(total):
    import numpy as np

    return np.minimum(np.log2(total).astype(np.int64), _CLASSES - 1)


def token_blocks(docs: DataFrame, words: Words) -> DataFrame:
    """The word ids (-1: not in the trie) of ``docs (doc_id, held_out, text)``: a row for each
    block of texts that are all held out or all not, one more than the ids packed."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        reader = Reader(words)
        waiting: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}

        def block(held: bool, texts: list, docs: list):
            ids, counts, _, lengths = reader.tokens(texts)
            first = np.cumsum(lengths) - lengths
            columns = (pa.array(docs, pa.int64()), pa.array(lengths),
                       pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)),
                       pa.array(np.add.reduceat(words.log10(counts), first)))
            ends = pa.array([0, len(texts)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([held]), *(pa.ListArray.from_arrays(ends, c) for c in columns), pa.array([_packed(ids + 1)])],
                names=["held_out", "doc_id", "n_tokens", "n_known", "base_score", "ids"])

        for batch in slices(batches, _ROWS):
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            for kind, (texts, docs) in waiting.items():
                rows = pa.array(np.flatnonzero(held == kind))
                texts += batch.column("text").take(rows).to_pylist()
                docs += batch.column("doc_id").take(rows).to_pylist()
                cuts = list(blocks(texts, _CHARS))
                if len(texts) < _ROWS:  # the last ones wait for more
                    cuts = cuts[:-1]
                for a, b in cuts:
                    yield block(kind, texts[a:b], docs[a:b])
                done = cuts[-1][1] if cuts else 0
                del texts[:done], docs[:done]
        for kind, (texts, docs) in waiting.items():
            for a, b in blocks(texts, _CHARS):
                yield block(kind, texts[a:b], docs[a:b])
        batch = texts = docs = rows = waiting = reader = None
        give_back()

    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("held_out", F.lit(False)).alias("held_out"),
                       text_of(docs).cast("binary").alias("text"))
    return cols.mapInArrow(run, _BLOCK)


def _ids(batches: Iterator) -> Iterator[tuple]:
    """The rows of ``token_blocks``: word ids, the texts' numbers of tokens, batch and row."""
    import numpy as np

    for batch in batches:
        for row in range(batch.num_rows):
            lengths = np.asarray(batch.column("n_tokens")[row].values)
            yield _unpacked(batch.column("ids")[row].as_py(), int(lengths.sum())) - 1, lengths, batch, row


def count_pairs(tokens: DataFrame, words: Words, shards: int, pairs: Pairs | None = None) -> Pairs:
    """The second level from the texts of ``tokens`` (see ``token_blocks``) that are not held
    out; the third above ``pairs``."""
    spark = tokens.sparkSession
    name = "triples" if pairs else "pairs"
    root = shared_path(spark, name)
    v = max(1, words.distinct)
    contexts = max(1, pairs.total) if pairs else v
    if contexts * v >= 2 ** 63:
        raise ValueError(f"{contexts} contexts of {v} words do not fit 64 bits")
    width = -(-contexts // shards)  # contexts in a shard
    step = width * v

    def count(batches: Iterator) -> Iterator:
        import numpy as np

        if pairs:
            # the shards' first pairs, without the first shard's
            found = TripleCounter(v, pairs.keys_at(np.arange(width, pairs.total, width), {}))
        else:
            found = Counter(step)
        for ids, lengths, *_ in _ids(batches):
            key = np.append(words.end, ids[:-1]) * v + ids
            if pairs:
                pair = chained(key, lengths)
                yield from found.add(pair[pair >= 0], ids[pair >= 0])
            else:
                yield from found.add(*np.unique(key, return_counts=True))
        yield from found.rows()
        ids = lengths = key = pair = found = _ = None
        give_back()

    def merge(pdf):
        import numpy as np
        import pandas as pd

        shard = int(pdf["shard"].iloc[0])
        if pairs:
            own = pairs.between(shard * width, (shard + 1) * width, {})
            keys, counts = _gathered(pdf, lambda *r: unpacked_triples(*r, v, own))
        else:
            keys, counts = _gathered(pdf)
        context = keys // v
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        kind = np.repeat(_classes(np.add.reduceat(counts, first)), np.diff(np.append(first, len(keys))))
        (_, n, raw_keys, raw_counts), = parts(keys, counts, step)
        return pd.DataFrame({"shard": [shard], "n": [n], "keys": [raw_keys], "counts": [raw_counts],
                             "ones": [np.bincount(kind[counts == 1], minlength=_CLASSES).tolist()],
                             "twos": [np.bincount(kind[counts == 2], minlength=_CLASSES).tolist()]})

    learnt = tokens.where(~F.col("held_out")).select("n_tokens", "ids")
    found = materialise(learnt.mapInArrow(count, _PART).groupBy("shard").applyInPandas(
        merge, _PART + ", ones array<long>, twos array<long>"), name)
    # counts of counts by class: a few numbers
    sums = found.agg(*[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("ones", "twos") for i in range(_CLASSES)]).first()
    ones, twos = ([sums[f"{c}{i}"] or 0 for i in range(_CLASSES)] for c in ("ones", "twos"))
    discount = [min(0.95, max(0.1, a / (a + 2 * b))) if a else 0.5 for a, b in zip(ones, twos, strict=True)]
    low = (pairs.low if pairs else float(words.log10(0))) - 3
    kind = Triples if pairs else Pairs
    empty = kind(v, step, {}, low)

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rate, opened = np.array(discount), {}

        def shorter(shard, context, word):
            """log10 of the words' probabilities after their contexts, which are numbered from
            the shard's first, without the contexts' first words."""
            if not pairs:
                return words.log10(words.counts_at(word, opened))
            last = pairs.between(shard * width, (shard + 1) * width, opened) % v
            return pairs.lookup(last[context], word, opened)[0]

        for batch in batches:
            for row in range(batch.num_rows):
                shard, *raw = (batch.column(i)[row].as_py() for i in range(4))
                keys, counts = unpacked(*raw)
                context, word = keys // v, keys % v
                first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
                size = np.diff(np.append(first, len(keys)))
                total = np.add.reduceat(counts, first)
                d = rate[_classes(total)]
                weight = d * size / total
                here = np.repeat(np.arange(len(first)), size)
                prob = ((counts - d[here]) / total[here] + weight[here] * 10 ** shorter(shard, context, word))
                weights = np.full(width, _STEPS, dtype="<u2")  # one: nothing seen after it
                weights[context[first]] = empty.quantised(np.log10(weight))
                pointers = np.searchsorted(context, np.arange(width + 1))
                file = f"{root}/pairs-{shard:06d}.bin"
                put_file(file, [encode(keys, step), encode(pointers, len(keys) + 1),
                                empty.quantised(np.log10(prob)).tobytes(), weights.tobytes()])
                yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [file], "n": [len(keys)]}, schema=pa.schema(
                    [("shard", pa.int32()), ("file", pa.string()), ("n", pa.int64())]))
        batch = raw = keys = counts = context = word = here = prob = weights = pointers = None
        give_back()

    written = materialise(found.select("shard", "n", "keys", "counts")
                          .mapInArrow(build, "shard int, file string, n long"), name)
    rows, base, at = _files(written), {}, 0
    for r in rows:
        base[r["shard"]] = at
        at += r["n"]
    return kind(v, step, {r["shard"]: r["file"] for r in rows}, low, base, at)


def _trained(marked: DataFrame, shards: int | None, order: int) -> tuple:
    """The word ids of all texts and the levels of the trie from those not held out."""
    if order not in (2, 3):
        raise ValueError(f"order must be 2 or 3, not {order}")
    spark: SparkSession = marked.sparkSession
    # two shards for each partition of a shuffle: what a task holds at once is one of them
    shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    learnt = marked.where(~F.col("held_out"))
    words = count_words(learnt.select(text_of(learnt).cast("binary").alias("text")), shards)
    tokens = materialise(token_blocks(marked, words), "tokens")
    pairs = count_pairs(tokens, words, shards)
    return tokens, (words, pairs) if order == 2 else (words, pairs, count_pairs(tokens, words, shards, pairs))


def train(docs: DataFrame, shards: int | None = None, order: int = 2) -> tuple:
    """The ``order`` (2 or 3) levels of the trie from every row of ``docs``."""
    marked = docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text")
    return _trained(marked, shards, order)[1]


def score(docs: DataFrame, words: Words, pairs: Pairs, triples: Triples | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` of every row of ``docs``,
    which has a column ``held_out``."""
    return score_tokens(token_blocks(docs, words), words, pairs, triples)


def score_tokens(tokens: DataFrame, words: Words, pairs: Pairs, triples: Triples | None = None) -> DataFrame:
    """The scores of the texts of ``tokens`` (see ``token_blocks``)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        opened: dict = {}
        for ids, lengths, batch, row in _ids(batches):
            before = np.append(words.end, ids[:-1])
            own = words.log10(np.zeros(len(ids), dtype=np.int64))  # of a word never seen
            known = np.flatnonzero((ids >= 0) & (before >= 0))
            prob, weight, at = pairs.search(before[known], ids[known], opened)
            own[known] = prob
            rare = np.flatnonzero(np.isnan(prob))
            own[known[rare]] = weight[rare] + words.log10(words.counts_at(ids[known[rare]], opened))
            # a known word after one never seen
            new = np.flatnonzero((ids >= 0) & (before < 0))
            own[new] = words.log10(words.counts_at(ids[new], opened))
            # a word never seen, after a context that was
            new = np.flatnonzero((ids < 0) & (before >= 0))
            own[new] += pairs.backoff(before[new], opened)
            if triples:
                place = np.full(len(ids), -1, dtype=np.int64)
                place[known] = at
                context = chained(place, lengths)
                known = np.flatnonzero((context >= 0) & (ids >= 0))
                prob, weight = triples.lookup(context[known], ids[known], opened)
                own[known] = np.where(np.isnan(prob), weight + own[known], prob)
                new = np.flatnonzero((context >= 0) & (ids < 0))
                own[new] += triples.backoff(context[new], opened)
            first = np.cumsum(lengths) - lengths
            doc_id, n_tokens, n_known, base = (batch.column(c)[row].values
                                               for c in ("doc_id", "n_tokens", "n_known", "base_score"))
            held = pa.array(np.full(len(lengths), batch.column("held_out")[row].as_py()))
            yield pa.RecordBatch.from_arrays(
                [doc_id, held, n_tokens, n_known, base, pa.array(np.add.reduceat(own, first))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
        ids = lengths = batch = before = own = known = prob = weight = at = place = context = None
        give_back()

    return tokens.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                  "base_score double, score double")


def score_documents(docs: DataFrame, folds: int = 10, order: int = 2) -> DataFrame:
    """Train on the rows outside the held-out fold and score every row."""
    marked = docs.select("doc_id", "text", held_out("doc_id", folds).alias("held_out"))
    tokens, (words, *levels) = _trained(marked, None, order)
    return score_tokens(tokens, words, *levels).withColumn("train_tokens", F.lit(words.tokens).cast("long"))
