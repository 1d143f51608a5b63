"""Language identification with a linear-chain conditional random field over words.

A line of text is a chain of words; a word's label is its language. Emissions add up learned weights of hashed features
of the word: affixes of 1 to 4 bytes, byte n-grams of 1 to 3, the whole word (lexicon) and its shape. Transitions
between neighbouring labels are learned too. Forward-backward gives each word's label probabilities, so that text
switching between languages is labelled word by word; a document's language is the label of the largest expected
number of letters.

The classifier is fitted on the driver on whole texts of a bounded sample of labelled rows (SAMPLE documents, the
smallest hashes of their ids); scoring reads every word of every document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import lean

#: Labelled documents fitted on at most, and their bytes at most (one document of each label may come on top); labels
#: learned at most, the most frequent ones. They bound the driver's memory and what goes to the tasks.
SAMPLE, SAMPLE_BYTES, LABELS = 1_500, 48 << 20, 100
BUCKETS, EPOCHS, RATE, DECAY = 1 << 16, 6, 0.3, 1e-6
#: Words in a chain at most (a longer line goes on in a next chain); padded words in a batch of chains.
CHAIN, PADDED = 4096, 100_000
#: Words whose features are looked up at once.
WORDS = 1 << 12
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
    """Multiplicative hash of integer codes of one kind of feature."""
    x = (codes.astype(np.uint64) + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - 16)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) pairs of the features of lower-cased words, ordered by neither."""
    data = [w.encode() for w in words]
    n = np.fromiter(map(len, data), np.int64, len(data))
    text = np.frombuffer(b"\x01" + b"\x02\x01".join(data) + b"\x02\0\0\0", np.uint8).astype(np.int64)
    start = np.cumsum(n + 2) - n - 1  # of each word's first byte
    owner = np.repeat(np.arange(len(words)), n + 2)
    who, what = [], []
    for size in (1, 2, 3):  # n-grams, with the marks before and behind the word
        code = sum(text[i : len(owner) + i] << (8 * i) for i in range(size))
        at = np.arange(len(owner))
        ok = at + size <= (start + n + 1)[owner]
        who.append(owner[ok])
        what.append(_bucket(code[ok], size))
    for size in (1, 2, 3, 4):  # affixes
        ok = np.flatnonzero(n >= size)
        for kind, first in ((10, start[ok]), (20, (start + n)[ok] - size)):
            who.append(ok)
            what.append(_bucket(sum(text[first + i] << (8 * i) for i in range(size)), kind + size))
    power = np.cumprod(np.full(int(n.max(initial=0)) + 2, 0x100000001B3, np.uint64))
    inner = np.arange(len(owner)) - (start - 1)[owner]
    whole = np.add.reduceat(text[: len(owner)].astype(np.uint64) * power[inner], start - 1) if len(words) else np.array([], np.uint64)
    every = np.arange(len(words))
    who += [every, every]
    what += [_bucket(whole >> np.uint64(24), 30), _bucket(np.minimum(n, 12), 31)]
    return np.concatenate(who), np.concatenate(what)


def chains(text: str) -> list[list[str]]:
    """The words of each line, in chains of at most CHAIN words."""
    out = []
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if len(words) > CHAIN:
            out += [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]
        elif words:
            out.append(words)
    return out


def forward_backward(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, with_pairs: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For padded chains (word, chain, label), the longest first: label marginals, summed pair marginals, log Z.

    Scaled, in probability space: each word's emissions are shifted by their maximum first. At each step the chains
    still running are the first ones.
    """
    t, b, k = scores.shape
    top = scores.max(axis=2)
    e, m = np.exp(scores - top[:, :, None]), np.exp(trans)
    running = np.searchsorted(-lengths, -np.arange(t), side="left")  # chains longer than i
    alpha, scale = np.zeros((t, b, k)), np.ones((t, b))
    log_z = np.zeros(b)
    a = e[0] * np.exp(start)
    for i in range(t):
        r = running[i]
        if i:
            a = (a[:r] @ m) * e[i, :r]
        s = a.sum(axis=1)
        a = a / s[:, None]
        alpha[i, :r], scale[i, :r] = a, s
        log_z[:r] += np.log(s) + top[i, :r]
    pairs = np.zeros((k, k))
    x = np.ones((b, k))
    for i in range(t - 1, 0, -1):
        r = running[i]
        inner = e[i, :r] * x[:r] / scale[i, :r, None]
        alpha[i, :r] *= x[:r]
        if with_pairs:
            pairs += (alpha[i - 1, :r].T @ inner) * m
        x[:r] = inner @ m.T
    alpha[0] *= x
    return alpha, pairs, log_z


class Crf:
    """Weights of a fitted field."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.labels, self.weights, self.trans, self.start = labels, weights, trans, start

    def emissions(self, words: list[str]) -> np.ndarray:
        """(word, label)."""
        out = np.zeros((len(words), len(self.labels)))
        for i in range(0, len(words), WORDS):
            part = words[i : i + WORDS]
            who, what = features(part)
            for j in range(len(self.labels)):
                out[i : i + len(part), j] = np.bincount(who, self.weights[what, j], len(part))
        return out

    def label_mass(self, texts: list[str]) -> np.ndarray:
        """(text, label): expected number of letters of each label. Chains are batched by length."""
        out = np.zeros((len(texts), len(self.labels)))
        ids: dict[str, int] = defaultdict(count().__next__)
        number, owner, every = ids.__getitem__, [], []
        for i, text in enumerate(texts):
            for words in chains(text.lower()):
                owner.append(i)
                every.append(np.fromiter(map(number, words), np.int64, len(words)))
        if not every:
            return out
        known = list(ids)
        emitted, letters = self.emissions(known), np.fromiter(map(len, known), np.float64, len(known))
        size = np.fromiter(map(len, every), np.int64, len(every))
        order = np.argsort(-size, kind="stable")
        owner = np.array(owner)
        at = 0
        while at < len(order):
            pick = order[at : at + max(1, PADDED // int(size[order[at]]))]
            at += len(pick)
            lengths = size[pick]
            flat = np.concatenate([every[i] for i in pick])
            chain = np.repeat(np.arange(len(pick)), lengths)
            word = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            scores, weight = np.zeros((lengths[0], len(pick), len(self.labels))), np.zeros((lengths[0], len(pick)))
            scores[word, chain] = emitted[flat]
            weight[word, chain] = letters[flat]
            marginal, _, _ = forward_backward(scores, lengths, self.trans, self.start, with_pairs=False)
            np.add.at(out, owner[pick], np.einsum("tbk,tb->bk", marginal, weight))
        return out


def fit(rows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 1) -> Crf:
    """Maximum conditional likelihood by AdaGrad over chains of (text, label) rows.

    Rows have one label each; so that switches can be learned, a fifth of the chains continue with words of another.
    """
    labels = sorted({lang for _, lang in rows})
    k = len(labels)
    ids: dict[str, int] = {}
    data: list[tuple[np.ndarray, np.ndarray]] = []
    for text, lang in rows:
        y = labels.index(lang)
        for words in chains(text.lower()):
            for i in range(0, len(words), 128):
                x = np.array([ids.setdefault(w, len(ids)) for w in words[i : i + 128]])
                data.append((x, np.full(len(x), y)))
    weights, trans, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    if k < 2 or not data:
        return Crf(labels, weights, trans, start)
    rng = np.random.default_rng(seed)
    for i in rng.choice(len(data), len(data) // 5, replace=False):
        (x, y), (u, v) = data[i], data[int(rng.integers(len(data)))]
        data[i] = np.concatenate([x[:64], u[:64]]), np.concatenate([y[:64], v[:64]])
    who, what = features(list(ids))
    order = np.argsort(who, kind="stable")
    flat = what[order]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(ids)))])
    g_w, g_t, g_s = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    by_size = np.argsort([-len(x) for x, _ in data], kind="stable")
    groups = [by_size[i : i + 256] for i in range(0, len(by_size), 256)]
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            pick = [data[i] for i in groups[g]]
            lengths = np.array([len(x) for x, _ in pick])
            words, inverse = np.unique(np.concatenate([x for x, _ in pick]), return_inverse=True)
            used = np.concatenate([flat[bounds[i] : bounds[i + 1]] for i in words])
            of = np.repeat(np.arange(len(words)), (bounds[1:] - bounds[:-1])[words])
            emitted = np.stack([np.bincount(of, weights[used, j], len(words)) for j in range(k)], axis=1)
            chain = np.repeat(np.arange(len(pick)), lengths)
            word = np.arange(len(inverse)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            scores = np.zeros((lengths[0], len(pick), k))
            scores[word, chain] = emitted[inverse]
            marginal, pairs, _ = forward_backward(scores, lengths, trans, start)
            gold = np.concatenate([y for _, y in pick])
            error = -marginal[word, chain]
            error[np.arange(len(gold)), gold] += 1
            by_word = np.stack([np.bincount(inverse, error[:, j], len(words)) for j in range(k)], axis=1)
            step = np.stack([np.bincount(used, by_word[of, j], BUCKETS) for j in range(k)], axis=1) / len(pick) - DECAY * weights
            g_w += step**2
            weights += RATE * step / np.sqrt(g_w)
            seen = np.zeros((k, k))
            inside = word > 0
            np.add.at(seen, (gold[np.flatnonzero(inside) - 1], gold[inside]), 1)
            step = (seen - pairs) / len(pick) - 1e-3 * trans
            g_t += step**2
            trans += 0.1 * step / np.sqrt(g_t)
            step = (np.bincount(gold[word == 0], minlength=k) - marginal[0].sum(axis=0)) / len(pick) - 1e-3 * start
            g_s += step**2
            start += 0.1 * step / np.sqrt(g_s)
    return Crf(labels, weights, trans, start)


def learning_rows(docs: DataFrame, id_col: str, text_col: str, label_col: str, rule, limit: int = SAMPLE) -> list[tuple[str, str]]:
    """At most `limit` labelled rows of rule, one of each label at least: those of the smallest id hashes of a label,
    with their whole texts. A quarter of the limit is dealt out evenly by label, the rest in proportion.

    Rows are counted without their texts first, so that only texts below their label's hash threshold, about 5/4 of its
    share, are looked at, however large the table is; of these, SAMPLE_BYTES at most leave the executors. Rows that
    repeat both id and text count once.
    """
    kept = docs.where(rule & F.col(label_col).isNotNull())
    counts = kept.groupBy(F.col(label_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(LABELS).collect()
    count = {r["lang"]: r["count"] for r in counts}
    if not count:
        return []
    least, total = max(1, limit // (4 * len(count))), sum(count.values())
    quota = {x: least + int(max(0, limit - least * len(count)) * n / total) for x, n in count.items()}
    # Some rows more than the share, so that a small one isn't missed by chance.
    below = [(x, int(min(1.0, (1.25 * quota[x] + 20) / n) * (1 << 40))) for x, n in count.items()]
    spark = docs.sparkSession
    thresholds = F.broadcast(spark.createDataFrame(below, "of_lang string, below bigint"))
    rows = kept.where(F.col(text_col).isNotNull()).select(F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)).alias("h"), F.octet_length(text_col).alias("size"), F.col(text_col).alias("text"), F.col(label_col).alias("lang"))
    rows = rows.join(thresholds, rows["lang"] == F.col("of_lang")).where("h < below")
    # First which ones, by the sizes alone; rows that repeat both id and text count once.
    found = rows.groupBy("lang", "h").agg(F.min("size").alias("size")).orderBy("h", "lang").limit(4 * limit + 80 * len(count)).collect()
    held, room, chosen = dict.fromkeys(count, 0), SAMPLE_BYTES, []
    for r in found:
        if held[r["lang"]] < quota[r["lang"]] and (not held[r["lang"]] or r["size"] <= room):
            held[r["lang"]] += 1
            room -= r["size"]
            chosen.append((r["lang"], r["h"]))
    wanted = F.broadcast(spark.createDataFrame(chosen, "c_lang string, c_h bigint"))
    texts = rows.join(wanted, (F.col("lang") == F.col("c_lang")) & (F.col("h") == F.col("c_h"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(texts.collect(), key=lambda r: (r["h"], r["lang"]))]


def identify(docs: DataFrame, model: Crf, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score: the label of most expected letters and its share of them.

    A text that is null or has no letter is UNKNOWN with score 0; ties go to the first label by name. All rows and
    columns stay; columns already of those names are replaced. A model without labels finds everything UNKNOWN.
    """
    rest = docs.drop("lang_pred", "score")
    at = rest.columns.index(text_col)
    schema = StructType([*rest.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for i in range(0, len(batch), 500):
                mass = model.label_mass([t or "" for t in batch.column(at).slice(i, 500).to_pylist()]) if model.labels else np.zeros((len(batch), 1))
                for row in mass:
                    total = row.sum()
                    names.append(model.labels[int(row.argmax())] if total else UNKNOWN)
                    scores.append(min(1.0, float(row.max() / total)) if total else 0.0)
            cols = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "lang_pred", "score"])

    return rest.mapInArrow(lean(run), schema)


def held_out(id_col: str, folds: int = 3, fold: int = 1):
    """The contract's rule: crc32 of the id as text, modulo folds, is fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def language_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Fit on the rows that aren't held out and label every row: docs with held_out, lang_pred and score.

    Null ids aren't held out; the label, the id and other columns are no input of a prediction.
    """
    model = fit(learning_rows(docs, id_col, text_col, label_col, ~held_out(id_col)))
    return identify(docs.withColumn("held_out", held_out(id_col)), model, text_col)
