"""Hierarchical Pitman-Yor language model, trained by Gibbs sampling of seating arrangements, and perplexity scores.

Restaurants: a word follows the restaurant of the word before it, if that one makes up a SHARE of the training tokens, and
else that of its class, its last two bytes. The restaurants of words of one class share the class's as parent, classes
with the same last byte share a parent, and those the unigram restaurant, whose base is uniform over the training words
and one unknown word. At most 1 / SHARE words make up a share, whatever the corpus, so the restaurants' totals are a
bounded table.

Tokens are dealt out by word, so that everything a word has (its customers in each restaurant, its tables on each level)
lies in one row; words of a SHARE are dealt by the last byte of the word before as well, and their places in the unigram
restaurant are kept with the totals. A sweep seats every word's customers anew given the totals of the sweep before: the
number of tables is drawn from its conditional (generalised Stirling numbers for up to EXACT customers, their limit, a
negative binomial, for more). After each sweep discount and strength of every level are drawn from their conditional on
a grid. A job per sweep sums what that needs; the scores average the predictive probabilities of SAMPLES later seatings.
Draws are seeded by sweep and row, so a lost executor's work repeats exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, remove, written

#: Least share of the training tokens for a restaurant of its own.
SHARE = 2e-6
#: Values that discounts and strengths are drawn from; those of the first sweep, by level: unigram, bytes, classes, words.
DISCOUNTS, STRENGTHS = (0.2, 0.35, 0.5, 0.6, 0.7, 0.8, 0.88, 0.94), (0.05, 0.2, 0.5, 1.0, 2.0, 5.0, 12.0, 30.0, 80.0, 200.0)
DISCOUNT, STRENGTH = (0.5, 0.6, 0.7, 0.8), (1.0, 1.0, 1.0, 1.0)
SWEEPS, ROUNDS, SAMPLES = 3, 2, 3
EXACT = 48
#: Tokens a task gathers before it passes them on.
TOKENS = 700_000
#: Parts that words are dealt to at least; a part is a row that one task holds in memory.
LEAST_PARTS = 256
#: The end of a text as a token: no word is a single space.
END = xxhash.xxh64_intdigest(b" ", 0)
LEVELS, CLASSES = 4, 65536
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, classes) of a text's words; a class is 256 * last byte + last but one (0 if there is none)."""
    words = text.translate(_LOWER).split()
    n = len(words)
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    joined = np.frombuffer(b"\0" + b"\0".join(words), np.uint8).astype(np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1  # of each word's last byte
    return ids, 256 * joined[ends] + joined[ends - 1]


class Contexts:
    """Numbers of the restaurants that tokens sit in, ordered by class: one for each class, and one for each frequent word."""

    def __init__(self, words: np.ndarray, classes: np.ndarray, counts: np.ndarray):
        """The frequent words' hashes, rising, classes and training counts."""
        self.frequent, self.counts = words, counts
        real = words != np.uint64(END)
        self.words = words[real]
        code = np.concatenate([np.arange(CLASSES, dtype=np.int64) << 32, (classes[real].astype(np.int64) << 32) + 1 + np.arange(real.sum())])
        order = np.argsort(code)
        number = np.empty(len(code), np.int64)
        number[order] = np.arange(len(code))
        self.size = len(code)
        self.of_class, self.of_word = number[:CLASSES], number[CLASSES:]
        self.klass, self.is_word = code[order] >> 32, (code[order] & 0xFFFFFFFF) > 0

    def place(self, ids: np.ndarray) -> np.ndarray:
        """Each word's number among the frequent ones, -1 for others."""
        at = np.minimum(np.searchsorted(self.frequent, ids), max(0, len(self.frequent) - 1))
        return np.where(self.frequent[at] == ids, at, -1) if len(self.frequent) else np.full(len(ids), -1)

    def tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes, contexts) of a text: its words and the end; class 0 precedes the first word."""
        ids, classes = words_of(text)
        context = self.of_class[classes]
        if len(self.words) and len(ids):
            at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
            context = np.where(self.words[at] == ids, self.of_word[at], context)
        return np.append(ids, np.uint64(END)), np.concatenate([self.of_class[:1], context])


def frequent_words(rows: DataFrame, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(hashes, classes, counts, tokens) of the training rows (row, text, out): words, and the end, of that share that
    stand twice; all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            ids, first, n = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_counts=True)
            classes = np.concatenate([h[1] for h in held])[first]
            return pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(classes), pa.array(n)], ["w", "class", "n"])

        for batch in batches:
            for text, out in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                if not out:
                    ids, classes = words_of(text.as_buffer().to_pybytes() if text.is_valid else b"")
                    held.append((np.append(ids, np.uint64(END)), np.append(classes, 0)))
                    size += len(ids) + 1
                    if size >= 2 * TOKENS:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    counts = rows.mapInArrow(run, "w bigint, class bigint, n bigint").groupBy("w").agg(F.min("class").alias("class"), F.sum("n").alias("n"))
    counts = written(counts, "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most 1 / share rows, whatever the corpus.
    found = counts.where((F.col("n") > 1) & (F.col("n") >= share * total)).toPandas()
    remove(rows.sparkSession, counts)
    ids = found["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(ids)
    return ids[order], found["class"].to_numpy(np.int64)[order], found["n"].to_numpy(np.int64)[order], int(total)


def log_stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """log S(c, t), c and t up to size: seatings of c customers at t tables."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[0, 0] = 0
    for c in range(size):
        t = np.arange(1, c + 2)
        with np.errstate(divide="ignore"):
            more = np.where(t <= c, np.log(np.maximum(c - t * discount, 1e-300)) + out[c, 1 : c + 2], -np.inf)
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], more)
    return out


_STIRLING = {d: log_stirling(d) for d in {*DISCOUNTS, *DISCOUNT}}


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, for x > 0."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    for _ in range(7):
        small = x < 7
        shift = np.where(small, shift + np.log(np.where(small, x, 1)), shift)
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def seating_logs(c: np.ndarray, t: np.ndarray) -> np.ndarray:
    """For each of DISCOUNTS, the summed log number of seatings of c customers at t tables; beyond EXACT its limit."""
    some = c > 1
    c, t = c[some], t[some]
    few, out = c <= EXACT, np.zeros(len(DISCOUNTS))
    for i, d in enumerate(DISCOUNTS):
        x, y = c[~few], t[~few]
        limit = log_gamma(x) - log_gamma(np.array(1 - d)) - log_gamma(y) - (y - 1) * np.log(d) - d * np.log(x)
        out[i] = _STIRLING[d][c[few], t[few]].sum() + limit.sum()
    return out


def draw_tables(c: np.ndarray, others: np.ndarray, base: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that c customers of one dish take, given the restaurant's other tables and the parent's probability of it."""
    t = np.minimum(c, 1)
    for low, high in ((2, 4), (5, 12), (13, EXACT)):
        at = np.flatnonzero((c >= low) & (c <= high))
        for i in range(0, len(at), 1 << 13):
            some = at[i : i + (1 << 13)]
            k = np.arange(1, high + 1)
            opened = np.cumsum(np.log(theta + d * (others[some, None] + k[None, :] - 1)), axis=1)
            logp = _STIRLING[d][c[some], 1 : high + 1] + opened + k[None, :] * np.log(base[some, None])
            noise = -np.log(-np.log(rng.random(logp.shape) + 1e-300) + 1e-300)
            t[some] = 1 + np.argmax(logp + noise, axis=1)
    at = np.flatnonzero(c > EXACT)
    if len(at):
        q = np.clip(base[at] * (1 - c[at] ** -d), 0, 0.999)
        t[at] = np.minimum(c[at], 1 + rng.negative_binomial((theta + d * others[at]) / d + 1, 1 - q))
    return t


class Totals:
    """Customers and tables of every restaurant, by level; customers and tables of the frequent words in the unigram
    restaurant; seating logs by level and discount; discounts and strengths."""

    def __init__(self, contexts: int, frequent: int) -> None:
        sizes = (1, 256, CLASSES, contexts)
        self.customers, self.tables = [np.zeros(n, np.int64) for n in sizes], [np.zeros(n, np.int64) for n in sizes]
        self.c0, self.t0 = np.zeros(frequent, np.int64), np.zeros(frequent, np.int64)
        self.logs = np.zeros((LEVELS, len(DISCOUNTS)))
        self.d, self.s = list(DISCOUNT), list(STRENGTH)

    def seat_frequent(self, size: int, rng: np.random.Generator) -> None:
        """The frequent words' tables in the unigram restaurant, and what they add to its totals."""
        others = np.maximum(self.tables[0][0] - self.t0, 0)
        self.t0 = draw_tables(self.c0, others, np.full(len(self.c0), 1 / size), self.d[0], self.s[0], rng)
        self.customers[0][0] += self.c0.sum()
        self.tables[0][0] += self.t0.sum()
        self.logs[0] += seating_logs(self.c0, self.t0)

    def draw_parameters(self, rng: np.random.Generator) -> None:
        """Discount and strength of each level, from their conditional given all seatings, on the grid."""
        for level in range(LEVELS):
            held = self.customers[level] > 0
            c, t = self.customers[level][held].astype(np.float64), self.tables[level][held].astype(np.float64)
            if not len(c):
                continue
            logp = np.zeros((len(DISCOUNTS), len(STRENGTHS)))
            for j, s in enumerate(STRENGTHS):
                full = (log_gamma(s + c) - log_gamma(np.array(s + 1))).sum()
                for i, d in enumerate(DISCOUNTS):
                    opened = (t - 1) * np.log(d) + log_gamma(s / d + t) - log_gamma(np.array(s / d + 1))
                    logp[i, j] = opened.sum() - full + self.logs[level, i]
            noise = -np.log(-np.log(rng.random(logp.shape) + 1e-300) + 1e-300)
            i, j = divmod(int(np.argmax(logp + noise)), len(STRENGTHS))
            self.d[level], self.s[level] = DISCOUNTS[i], STRENGTHS[j]


class Words:
    """Training counts of a row's words: word w has count n in context k, pairs sorted by word, then by context.

    places: each word's number among the frequent words, or -1."""

    def __init__(self, word: np.ndarray, context: np.ndarray, n: np.ndarray, places: np.ndarray, contexts: Contexts):
        self.words, self.word, self.context, self.n, self.places = len(places), word, context, n, places
        self.kind = contexts
        klass = contexts.klass[context]
        key = word * CLASSES + klass
        new = np.diff(key, prepend=-1) != 0
        self.first, self.class_of = np.flatnonzero(new), np.cumsum(new) - 1  # pairs of a word and a class
        self.k_word, self.klass = word[self.first], klass[self.first]
        key = self.k_word * 256 + (self.klass >> 8)
        new = np.diff(key, prepend=-1) != 0
        self.p_first, self.parent_of = np.flatnonzero(new), np.cumsum(new) - 1
        self.p_word, self.parent = self.k_word[self.p_first], self.klass[self.p_first] >> 8
        # Customers of words' restaurants sit there; those of a class sit in it directly.
        self.sits = contexts.is_word[context]
        self.t3 = np.where(self.sits, np.minimum(n, 1), 0)
        self._upwards()
        self.t2, self.t1 = np.minimum(self.c2, 1), None
        self.c1 = self._sum(self.t2, self.p_first)
        self.t1 = np.minimum(self.c1, 1)
        self.c0 = np.bincount(self.p_word, self.t1, self.words).astype(np.int64)
        self.t0 = np.where(places < 0, np.minimum(self.c0, 1), 0)

    @staticmethod
    def _sum(x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, first) if len(x) else x

    def _upwards(self) -> None:
        self.c2 = self._sum(np.where(self.sits, self.t3, self.n), self.first)

    def unigram(self, totals: Totals, size: int) -> np.ndarray:
        common = self.places >= 0
        c0, t0 = self.c0, self.t0
        if common.any():
            c0, t0 = np.where(common, totals.c0[self.places], c0), np.where(common, totals.t0[self.places], t0)
        d, s = totals.d[0], totals.s[0]
        return (np.maximum(c0 - d * t0, 0) + (s + d * totals.tables[0][0]) / size) / (s + max(1, totals.customers[0][0]))

    @staticmethod
    def _mixed(c, t, base, totals: Totals, level: int, at: np.ndarray) -> np.ndarray:
        d, s = totals.d[level], totals.s[level]
        return (np.maximum(c - d * t, 0) + (s + d * totals.tables[level][at]) * base) / (s + totals.customers[level][at])

    @staticmethod
    def _found(own: np.ndarray, key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        """The values at own == key, else 0."""
        if not len(own):
            return [np.zeros(len(key)) for _ in values]
        at = np.minimum(np.searchsorted(own, key), len(own) - 1)
        return [np.where(own[at] == key, v[at], 0) for v in values]

    def bases(self, totals: Totals, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of the own words: unigram, by (word, parent), by (word, class)."""
        uni = self.unigram(totals, size)
        mid = self._mixed(self.c1, self.t1, uni[self.p_word], totals, 1, self.parent)
        low = self._mixed(self.c2, self.t2, mid[self.parent_of], totals, 2, self.klass)
        return uni, mid, low

    def predictive(self, totals: Totals, size: int, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Probability of each word in its context."""
        klass = self.kind.klass[context]
        p = self.unigram(totals, size)[word]
        c, t = self._found(self.p_word * 256 + self.parent, word * 256 + (klass >> 8), self.c1, self.t1)
        p = self._mixed(c, t, p, totals, 1, klass >> 8)
        c, t = self._found(self.k_word * CLASSES + self.klass, word * CLASSES + klass, self.c2, self.t2)
        p = self._mixed(c, t, p, totals, 2, klass)
        c, t = self._found(self.word * self.kind.size + self.context, word * self.kind.size + context, self.n, self.t3)
        return np.where(self.kind.is_word[context], self._mixed(c, t, p, totals, 3, context), p)

    def seat(self, totals: Totals, size: int, rng: np.random.Generator) -> None:
        """One Gibbs round over all levels; totals are those of the sweep before, less the word's own tables."""
        uni, mid, low = self.bases(totals, size)
        less = lambda have, own: np.maximum(have - own, 0)
        draw = lambda level, c, others, base: draw_tables(c, others, base, totals.d[level], totals.s[level], rng)
        at = np.flatnonzero(self.sits)
        self.t3[at] = draw(3, self.n[at], less(totals.tables[3][self.context[at]], self.t3[at]), low[self.class_of[at]])
        self._upwards()
        self.t2 = draw(2, self.c2, less(totals.tables[2][self.klass], self.t2), mid[self.parent_of])
        self.c1 = self._sum(self.t2, self.p_first)
        self.t1 = draw(1, self.c1, less(totals.tables[1][self.parent], self.t1), uni[self.p_word])
        self.c0 = np.bincount(self.p_word, self.t1, self.words).astype(np.int64)
        rare = np.flatnonzero(self.places < 0)
        self.t0[rare] = draw(0, self.c0[rare], less(totals.tables[0][0], self.t0[rare]), np.full(len(rare), 1 / size))

    def seen(self) -> np.ndarray:
        """Each word's training tokens, in all rows."""
        own = np.bincount(self.word, self.n, self.words).astype(np.int64)
        return np.where(self.places >= 0, self.kind.counts[self.places], own) if len(self.kind.counts) else own

    def add_to(self, totals: Totals) -> None:
        """The row's share of what the sweep sums."""
        rare, sits = self.places < 0, self.sits
        zero = np.zeros(int(rare.sum()), np.int64)
        for level, at, c, t in ((0, zero, self.c0[rare], self.t0[rare]), (1, self.parent, self.c1, self.t1), (2, self.klass, self.c2, self.t2), (3, self.context[sits], self.n[sits], self.t3[sits])):
            totals.customers[level] += np.bincount(at, c, len(totals.customers[level])).astype(np.int64)
            totals.tables[level] += np.bincount(at, t, len(totals.tables[level])).astype(np.int64)
            totals.logs[level] += seating_logs(c, t)
        np.add.at(totals.c0, self.places[~rare], self.c0[~rare])


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, of each the first bytes of all numbers, then the second ones, and so on: most numbers
    are small, and their high bytes take no room."""
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays)
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


class _Unpacked:
    """Reads what _pack() made, array by array."""

    def __init__(self, body: bytes, raw: int):
        self.data, self.at = pa.decompress(body, decompressed_size=raw, codec="zstd", asbytes=True), 0

    def take(self, kind: type, n: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(self.data, np.uint8, n * size, self.at).reshape(size, n)
        self.at += n * size
        return np.ascontiguousarray(planes.T).view(kind).ravel()


def _dealt(batches: Iterator[pa.RecordBatch], parts: int, contexts: Contexts) -> Iterator[pa.RecordBatch]:
    """Tokens of whole documents, dealt out by word, of frequent words by the last byte before as well: rows (part, raw,
    body) with counts by (document, word, context)."""
    hold: list[tuple] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(x[1]) for x in hold])
        words, word = np.unique(np.concatenate([x[1] for x in hold]), return_inverse=True)
        context = np.concatenate([x[2] for x in hold])
        # One number sorts by word, context and document; a batch of very many of all three is sorted by each.
        bits = [max(1, int(n - 1).bit_length()) for n in (contexts.size, len(hold))]
        doc = np.repeat(np.arange(len(hold)), sizes)
        if sum(bits) + int(len(words)).bit_length() <= 63:
            key = (word.astype(np.int64) << sum(bits)) | (context << bits[1]) | doc
            key.sort()
            new = np.flatnonzero(np.diff(key, prepend=-1))
            n = np.diff(np.append(new, len(key)))
            key = key[new]
            doc, context, word = key & ((1 << bits[1]) - 1), (key >> bits[1]) & ((1 << bits[0]) - 1), key >> sum(bits)
        else:
            order = np.lexsort((doc, context, word))
            word, context, doc = word[order], context[order], doc[order]
            new = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(context, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
            n = np.diff(np.append(new, len(word)))
            word, context, doc = word[new], context[new], doc[new]
        place = contexts.place(words)
        mixed = words >> np.uint64(20)
        byte = (contexts.klass[context] >> 8).astype(np.uint64)
        part = ((mixed[word] + np.where(place[word] >= 0, (byte + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33), np.uint64(0))) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        word, context, doc, n, part = word[order], context[order], doc[order], n[order], part[order]
        bounds = np.searchsorted(part, np.arange(parts + 1))
        rows = []
        for p in range(parts):
            a, b = bounds[p], bounds[p + 1]
            if a == b:
                continue
            w = word[a:b]
            first = np.flatnonzero(np.diff(w, prepend=-1))
            here = np.unique(doc[a:b])
            body = _pack(
                np.array([b - a, len(first), len(here)], np.int64), words[w[first]], np.array([hold[i][0] for i in here], np.int64),
                np.array([hold[i][3] for i in here], np.uint8), np.diff(np.append(first, b - a)).astype(np.uint32),
                context[a:b].astype(np.uint32), np.searchsorted(here, doc[a:b]).astype(np.uint32), n[a:b].astype(np.uint32),
            )
            raw = 24 + 8 * len(first) + 9 * len(here) + 4 * len(first) + 12 * (b - a)
            rows.append((p, raw, body))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["part", "raw", "body"])

    for batch in batches:
        for row, text, out in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            ids, context = contexts.tokens(text.as_buffer().to_pybytes() if text.is_valid else b"")
            hold.append((row, ids, context, out))
            held += len(ids)
            if held >= TOKENS:
                yield from flush()
                hold, held = [], 0
    if hold:
        yield from flush()


def _unpack(body: bytes, raw: int) -> tuple[np.ndarray, ...]:
    data = _Unpacked(body, raw)
    n, k, m = data.take(np.int64, 3).tolist()
    kinds = (np.uint64, k), (np.int64, m), (np.uint8, m), (np.uint32, k), (np.uint32, n), (np.uint32, n), (np.uint32, n)
    return tuple(data.take(kind, size) for kind, size in kinds)


def _merged(frame: pd.DataFrame, contexts: Contexts) -> pd.DataFrame:
    """A part's rows as one: training counts by (word, context), and all rows' tokens by word number."""
    parts = [_unpack(b, r) for b, r in zip(frame["body"], frame["raw"], strict=True)]
    words = np.unique(np.concatenate([p[0] for p in parts]))
    every = [np.repeat(np.searchsorted(words, p[0]), p[3]) for p in parts]
    train = [p[2][p[5]] == 0 for p in parts]
    key = np.concatenate([(w * contexts.size + p[4])[t] for w, p, t in zip(every, parts, train, strict=True)])
    n = np.concatenate([p[6][t] for p, t in zip(parts, train, strict=True)]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    counts = np.add.reduceat(n, first) if len(n) else n
    key = key[first]
    place = contexts.place(words)
    model = _pack(np.array([len(words), len(key)], np.int64), place.astype(np.int64), key, counts.astype(np.int64))
    docs = np.unique(np.concatenate([p[1] for p in parts]))
    flat = [np.concatenate(x) for x in (every, [p[4] for p in parts], [np.searchsorted(docs, p[1])[p[5]] for p in parts], [p[6] for p in parts])]
    said = _pack(np.array([len(docs), len(flat[0])], np.int64), docs, *(a.astype(np.uint32) for a in flat))
    seen = np.unique(key // contexts.size)
    return pd.DataFrame({
        "part": frame["part"].iloc[:1], "vocabulary": [int((place[seen] < 0).sum())], "model": [model], "model_raw": [16 + 8 * len(words) + 16 * len(key)],
        "said": [said], "said_raw": [16 + 8 * len(docs) + 16 * len(flat[0])],
    })


def _words(model: bytes, raw: int, contexts: Contexts) -> Words:
    data = _Unpacked(model, raw)
    words, n = data.take(np.int64, 2).tolist()
    places, key, counts = data.take(np.int64, words), data.take(np.int64, n), data.take(np.int64, n)
    return Words(key // contexts.size, key % contexts.size, counts, places, contexts)


def _summed(table: DataFrame, totals: Totals | None, size: int, sweep: int, contexts: Contexts) -> Totals:
    """The totals after one sweep over all parts (totals is None: one table for each customer group), with the frequent
    words seated in the unigram restaurant and the parameters drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Totals(contexts.size, len(contexts.frequent))
        for batch in batches:
            for part, model, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                w = _words(model, raw, contexts)
                if totals is not None:
                    rng = np.random.default_rng([sweep, part])
                    for _ in range(ROUNDS):
                        w.seat(totals, size, rng)
                w.add_to(mine)
        for level, (c, t) in enumerate(zip([*mine.customers, mine.c0], [*mine.tables, mine.t0], strict=True)):
            k = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), level), pa.int32()), pa.array(k, pa.int32()), pa.array(c[k]), pa.array(t[k]), pa.array(np.zeros(len(k)))], ["level", "k", "c", "t", "x"])
        level, k = np.divmod(np.arange(mine.logs.size), len(DISCOUNTS))
        none = pa.array(np.zeros(len(k), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(-1 - level, pa.int32()), pa.array(k, pa.int32()), none, none, pa.array(mine.logs.ravel())], ["level", "k", "c", "t", "x"])

    out = Totals(contexts.size, len(contexts.frequent))
    if totals is not None:
        out.d, out.s, out.t0 = list(totals.d), list(totals.s), totals.t0
    rows = table.select("part", "model", "model_raw").mapInArrow(run, "level int, k int, c bigint, t bigint, x double")
    # As many rows as there are restaurants and frequent words: bounded, whatever the corpus.
    got = rows.groupBy("level", "k").agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.sum("x").alias("x")).toPandas()
    for level in range(LEVELS):
        own = got[got["level"] == level]
        out.customers[level][own["k"]], out.tables[level][own["k"]] = own["c"], own["t"]
        logs = got[got["level"] == -1 - level]
        out.logs[level, logs["k"]] = logs["x"]
    own = got[got["level"] == LEVELS]
    out.c0[own["k"]] = own["c"]
    rng = np.random.default_rng([sweep])
    out.seat_frequent(size, rng)
    out.draw_parameters(rng)
    return out


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """One row per row of docs: (doc_id, n_tokens, n_known, train_tokens, base_score, score), logs to base 10.

    Learns from the rows where held_out is false. A null text counts as empty: one token, the end. Rows that repeat are
    learned from and scored as often as they occur; ids may be of any type, null too. Other columns are ignored; without
    training rows all words are unknown; an empty table gives no rows. Words are told apart by 64-bit hashes, and rows by
    their ids if these are unique whole numbers, else by hashes of id, text and held_out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.cast("int").alias("out"))
    # Whole numbers that are unique name their rows as they are, and take little room in sorted lists.
    whole = docs.schema[id_col].dataType.simpleString() in ("int", "bigint")
    whole = whole and rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL").isEmpty()
    keyed = rows.select("id", F.col("id").cast("bigint").alias("row") if whole else F.xxhash64("id", "text", "out").alias("row"), "text", "out")
    given = keyed.select("row", "text", "out")
    *found, n = frequent_words(given, share)
    contexts = Contexts(*found)
    parts = max(LEAST_PARTS, 2 * partitions(spark))
    dealt = given.mapInArrow(lambda b: _dealt(b, parts, contexts), "part int, raw bigint, body binary")
    merged = dealt.groupBy("part").applyInPandas(lambda f: _merged(f, contexts), "part int, vocabulary bigint, model binary, model_raw bigint, said binary, said_raw bigint")
    table = written(merged, "tokens")
    v = (table.agg(F.sum("vocabulary")).first()[0] or 0) + len(contexts.frequent)
    size = v + 1
    totals = _summed(table, None, size, 0, contexts)
    for sweep in range(1, SWEEPS + 1):
        totals = _summed(table, totals, size, sweep, contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                part, model, raw, said, said_raw = (batch.column(i)[row].as_py() for i in range(5))
                w = _words(model, raw, contexts)
                data = _Unpacked(said, said_raw)
                m, k = data.take(np.int64, 2).tolist()
                ids = data.take(np.int64, m)
                word, context, doc, times = (data.take(np.uint32, k).astype(np.int64) for _ in range(4))
                del data
                key, back = np.unique(word * contexts.size + context, return_inverse=True)
                rng, p = np.random.default_rng([SWEEPS + 1, part]), np.zeros(len(key))
                for _ in range(ROUNDS):
                    w.seat(totals, size, rng)
                for _ in range(SAMPLES):
                    w.seat(totals, size, rng)
                    p += w.predictive(totals, size, key // contexts.size, key % contexts.size)
                seen = w.seen()
                logs, base = np.log10(p / SAMPLES), np.log10(seen + 1)
                sums = [np.bincount(doc, x, m) for x in (times, (seen > 0)[word] * times, base[word] * times, logs[back] * times)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), *(pa.array(x.astype(np.int64)) for x in sums[:2]), *(pa.array(x) for x in sums[2:])], ["row", "n_tokens", "n_known", "base", "score"]
                )

    # A document has words in most parts: fewer tasks, with several parts each, add up more before the shuffle.
    tasks = 4 * spark.sparkContext.defaultParallelism
    scored = table.select("part", "model", "model_raw", "said", "said_raw").coalesce(tasks).mapInArrow(run, "row bigint, n_tokens bigint, n_known bigint, base double, score double")
    added = scored.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")))
    # Rows that repeat were added up; each gets its share.
    named = written(keyed.select("id", "row"), "rows")
    copies = named.groupBy("row").agg(F.count("*").alias("copies"))
    norm = float(np.log10(n + v + 1))
    shared = added.join(copies, "row").select("row", *((F.col(c) / F.col("copies")).alias(c) for c in ("n_tokens", "n_known", "base", "score")))
    return named.join(shared, "row").select(
        F.col("id").alias(id_col), F.round("n_tokens").cast("bigint").alias("n_tokens"), F.round("n_known").cast("bigint").alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * norm).alias("base_score"), "score",
    )


def perplexity(score, n_tokens):
    """Of a text whose tokens have that summed log10 probability."""
    return F.pow(F.lit(10.0), -score / n_tokens)
