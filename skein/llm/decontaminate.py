"""Benchmark decontamination by latent semantic retrieval.

Documents become sequences of the benchmark's word numbers (other words are 0). A randomised SVD of the TF-IDF matrix
of all passages of all documents gives a latent space: each task adds up its part of the sketch A'(A Omega), whose size
depends on the benchmark only, and the singular vectors follow from the sum (single-pass Nystroem form). Windows of
every document and the benchmark items are compared by cosine there; candidates are confirmed by the longest common
subsequence of words, paraphrases in addition by the item's answer, its last sentence, standing in one piece.

Weights fall with the copies of an item, and a cosine is an estimate; so stretches that hold enough of an item's rarest
words are candidates too, whatever their weights. That filter is exact: a stretch of up to STRETCH times an item's length
that the common subsequence would confirm always passes it.

The benchmark is the bounded side: it is taken in blocks of at most BLOCK items, each of which goes to all tasks.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, partitions, remove, written

BLOCK = 5_000
#: Words of a passage in the matrix; dimensions of the sketch, and of the latent space.
PASSAGE, SKETCH, RANK = 64, 96, 64
#: Words in more than one of COMMON passages weigh nothing; PRIOR passages without any of the words are added, so that
#: small tables have weights too.
COMMON, PRIOR = 200, 2_000
#: Window lengths tried; an item is sought at the shortest of 3/4 its length or more, long items in parts.
SCALES = (16, 32, 64, 128)
#: Least cosine of a candidate; share of the item's words in a common subsequence that confirms it, or does so together
#: with the answer.
COSINE, SAME, PARAPHRASE = 0.6, 0.8, 0.6
#: Longest stretch, by an item's length, in which its words are sought without weights; items of fewer than FEW words may
#: miss none, and are sought in one piece if they have no direction.
STRETCH, FEW = 1.5, 5
#: Words searched at once.
WORDS = 300_000
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, whatever their case."""
    return text.casefold().encode().translate(_TABLE).split()


class Item:
    """A benchmark item: word numbers, and those of its answer."""

    def __init__(self, item_id, text: str, number: dict[bytes, int]):
        self.id = item_id
        self.words = [number[w] for w in words_of(text)]
        last = [s for s in re.split(r"[.!?\n]+", text) if words_of(s)][-1:]
        self.answer = [number[w] for w in words_of(last[0])] if last else []
        self.at: dict[int, int] = defaultdict(int)
        for i, w in enumerate(self.words):
            self.at[w] |= 1 << i

    def common(self, region: list[int]) -> int:
        """Length of the longest common subsequence with a region, bit-parallel."""
        full = (1 << len(self.words)) - 1
        state, at = full, self.at
        for w in region:
            if w in at:
                hit = state & at[w]
                state = ((state + hit) | (state - hit)) & full
        return len(self.words) - state.bit_count()

    def answered(self, region: list[int]) -> bool:
        n = len(self.answer)
        return any(region[i : i + n] == self.answer for i in range(len(region) - n + 1)) if n else False


def _numbered(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, words, df): word numbers as int32 bytes; df, in one row of each batch, counts passages by word, and all of
    them under number 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    size = len(number) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import repeat

        for batch in batches:
            out, df = [], np.zeros(size, np.int64)
            for text in batch.column(1):
                words = words_of(text.as_py() or "")
                ids = np.fromiter(map(number.get, words, repeat(0)), np.int32, len(words))
                out.append(ids.tobytes())
                if len(ids):
                    pairs = np.unique((np.arange(len(ids)) // PASSAGE) * size + ids)
                    pairs %= size
                    df += np.bincount(pairs[pairs > 0], minlength=size)
                    df[0] += -(-len(ids) // PASSAGE)
            counts = [{"w": int(w), "n": int(df[w])} for w in np.flatnonzero(df)]
            rows = [counts, *[None] * (len(batch) - 1)] if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(rows, pa.list_(pa.struct([("w", pa.int32()), ("n", pa.int64())])))], ["id", "words", "df"]
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {kind}, words binary, df array<struct<w:int,n:bigint>>")


def latent_space(numbered: DataFrame, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(df, idf, vectors): passages and weights of the words, and each word's place in the latent space (number, RANK).

    What reaches the driver has the size of the benchmark's vocabulary, whatever the corpus.
    """
    df = np.zeros(size)
    for r in numbered.select(F.explode("df").alias("x")).groupBy("x.w").agg(F.sum("x.n").alias("n")).collect():
        df[r["w"]] = r["n"]
    passages, df[0] = df[0], 0
    idf = np.maximum(0, np.log((passages + PRIOR) / (1 + df) / COMMON))
    idf[0] = 0
    sketch = min(SKETCH, size)
    omega = np.random.default_rng(seed).standard_normal((size, sketch))
    weighted, weighs = (idf[:, None] * omega).astype(np.float32), idf > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros((size, sketch))

        def add(parts: list[np.ndarray]) -> None:
            ids = np.concatenate(parts)
            passage = np.concatenate([np.arange(len(p)) // PASSAGE for p in parts])
            passage += np.repeat(np.cumsum([0] + [-(-len(p) // PASSAGE) for p in parts])[:-1], [len(p) for p in parts])
            inside = np.flatnonzero(weighs[ids])
            ids, passage = ids[inside], passage[inside]
            if not len(ids):
                return
            first = np.flatnonzero(np.diff(passage, prepend=-1))
            y = np.add.reduceat(weighted[ids], first, axis=0)  # A Omega, a row per passage that has words
            row = np.cumsum(np.diff(passage, prepend=passage[0]) != 0)
            order = np.argsort(ids, kind="stable")
            starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
            z[ids[order][starts]] += np.add.reduceat(y[row[order]], starts, axis=0)  # A' of that, without idf

        for batch in batches:
            parts, held = [], 0
            for data in batch.column(0):
                ids = np.frombuffer(data.as_buffer(), np.int32)
                for i in range(0, len(ids), 1024 * PASSAGE):
                    parts.append(ids[i : i + 1024 * PASSAGE])
                    held += len(parts[-1])
                    if held > WORDS:
                        add(parts)
                        parts, held = [], 0
            if held:
                add(parts)
        touched = np.flatnonzero(z.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(touched, pa.int32()), pa.array(list(z[touched]), pa.list_(pa.float64()))], ["w", "v"])

    rows = numbered.select("words").coalesce(partitions(numbered.sparkSession)).mapInArrow(lean(run), "w int, v array<double>")
    summed = rows.groupBy("w").agg(F.array(*(F.sum(F.col("v")[i]) for i in range(sketch))).alias("v"))
    z = np.zeros((size, sketch))
    for r in summed.collect():
        z[r["w"]] = np.array(r["v"]) * idf[r["w"]]
    shift = np.sqrt(size) * 1e-7 * (np.linalg.norm(z) + 1e-9)
    core = omega.T @ (z + shift * omega)
    chol = np.linalg.cholesky((core + core.T) / 2 + 1e-9 * np.trace(core) / sketch * np.eye(sketch))
    u, _, _ = np.linalg.svd(np.linalg.solve(chol, (z + shift * omega).T).T, full_matrices=False)
    return df, idf, (idf[:, None] * u[:, : min(RANK, sketch)]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


class Index:
    """Latent vectors of the items (long ones in parts) by window length.

    Items of fewer than two words with a weight have no direction of their own; the short ones of them are sought as
    whole sequences. All others are sought by their rarest words too.
    """

    def __init__(self, items: list[Item], df: np.ndarray, idf: np.ndarray, vectors: np.ndarray):
        self.items, self.vectors, self.weighs = items, vectors, idf > 0
        without = [k for k, x in enumerate(items) if len({w for w in x.words if self.weighs[w]}) < 2]
        self.plain = [k for k in without if len(items[k].words) < FEW]
        self._rarest(df)
        by: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for k in set(range(len(items))) - set(without):
            words, longest = items[k].words, SCALES[-1]
            n = len(words)
            scale = next((s for s in SCALES if s >= 0.75 * n), longest)
            for i in range(0, n, longest) if n > 1.33 * longest else (0,):
                by[scale].append((k, vectors[words[i : i + longest] if n > 1.33 * longest else words].sum(axis=0)))
        self.by = {s: (np.array([k for k, _ in x]), _unit(np.array([v for _, v in x])).T.astype(np.float32)) for s, x in sorted(by.items())}

    def _rarest(self, df: np.ndarray) -> None:
        """Postings of each item's rarest words. Of n words, t in common leave n - t out; so of any n - t + m words of
        the item at least m are in common, and a stretch with fewer places of those words holds no copy."""
        n = np.array([len(x.words) for x in self.items])
        self.least, self.stretch = np.maximum(1, n // 8), np.floor(STRETCH * n).astype(np.int64)
        pairs = set()
        for k, x in enumerate(self.items):
            if n[k] >= FEW:
                rare = sorted(x.words, key=lambda w: (df[w], w))[: n[k] - int(np.ceil(PARAPHRASE * n[k] - 1e-9)) + self.least[k]]
                pairs |= {(w, k) for w in rare}
        words, items = np.array(sorted(pairs), np.int64).reshape(-1, 2).T
        self.posted, self.first = items, np.searchsorted(words, np.arange(len(df) + 1))

    def shared(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, start, end) of stretches with enough of an item's rarest words; every stretch of up to STRETCH
        times its length that holds the item lies within one of them."""
        ids = np.concatenate(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        offset = np.cumsum(size) - size
        count = np.diff(self.first)[ids]
        at = np.repeat(np.arange(len(ids)), count)
        if not len(at):
            return
        item = self.posted[np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[ids], count)]
        order = np.argsort(item, kind="stable")
        at, item = at[order], item[order]
        text = np.searchsorted(offset, at, "right") - 1
        # The first place of a stretch, and the last of the least number that it has to hold.
        last = np.arange(len(at)) + self.least[item] - 1
        i = np.flatnonzero(last < len(at))
        i = i[(item[last[i]] == item[i]) & (text[last[i]] == text[i]) & (at[last[i]] - at[i] < self.stretch[item[i]])]
        same = (i > 0) & (item[i - 1] == item[i]) & (text[i - 1] == text[i])
        start = np.maximum(np.where(same, at[i - 1] + 1, offset[text[i]]), at[last[i]] - self.stretch[item[i]] + 1)
        start = np.maximum(start, offset[text[i]]) - offset[text[i]]
        end = at[i] - offset[text[i]] + self.stretch[item[i]]
        yield from zip(text[i].tolist(), item[i].tolist(), start.tolist(), end.tolist(), strict=True)

    def candidates(self, texts: list[np.ndarray], cosine: float = COSINE) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, start, end) of windows that come close to an item; windows half overlap."""
        ids = np.concatenate(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        offset = np.cumsum(size) - size
        at = np.flatnonzero(self.weighs[ids])
        if not len(at):
            return
        sums = np.concatenate([np.zeros((1, self.vectors.shape[1])), np.cumsum(self.vectors[ids[at]], axis=0, dtype=np.float64)])
        for scale, (items, places) in self.by.items():
            step = scale // 2
            count = np.maximum(1, -(-(size - step) // step))
            text = np.repeat(np.arange(len(texts)), count)
            start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step
            end = np.minimum(start + scale, size[text])
            lo, hi = np.searchsorted(at, offset[text] + start), np.searchsorted(at, offset[text] + end)
            some = np.flatnonzero(hi > lo)
            for i in range(0, len(some), 1 << 13):
                w = some[i : i + (1 << 13)]
                near = _unit((sums[hi[w]] - sums[lo[w]]).astype(np.float32)) @ places >= cosine
                for x, k in zip(*np.nonzero(near), strict=True):
                    yield int(text[w[x]]), int(items[k]), int(start[w[x]]), int(end[w[x]])

    def hits(self, texts: list[np.ndarray]) -> list[tuple[int, int, float, bool, int]]:
        """(text, item, share in common, answered, start) of the items that the texts hold."""
        found: dict[tuple[int, int], tuple[float, bool, int]] = {}

        def confirm(t: int, k: int, lo: int, hi: int) -> None:
            item, region = self.items[k], texts[t][lo:hi].tolist()
            share = item.common(region) / len(item.words)
            if share >= PARAPHRASE and share > found.get((t, k), (0,))[0]:
                answered = item.answered(region)
                if share >= SAME or answered:
                    found[t, k] = (share, answered, lo)

        for t, k, start, end in self.candidates(texts):
            if found.get((t, k), (0,))[0] < SAME:
                n = len(self.items[k].words)
                margin = max(n - (end - start), 0) + n // 2 + 8
                confirm(t, k, max(0, start - margin), end + margin)
        for t, k, start, end in self.shared(texts):
            if (t, k) not in found:
                confirm(t, k, start, end)
        for k in self.plain:
            sought = np.array(self.items[k].words, np.int32).tobytes()
            for t, ids in enumerate(texts):
                data, i = ids.tobytes(), -1
                while (i := data.find(sought, i + 1)) >= 0:
                    if i % 4 == 0:
                        found.setdefault((t, k), (1.0, True, i // 4))
                        break
        return [(t, k, *x) for (t, k), x in sorted(found.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, share, answered, at): one row for each document and benchmark item it holds; clean documents
    have none. share: the item's words in a longest common subsequence; at: word from which the stretch was compared.

    Null or empty texts hold nothing, and items without words are in no document. Rows that repeat give rows each; null
    ids stay null. Other columns are ignored; an empty table of either kind gives no rows. Whole texts are searched.
    """
    spark = docs.sparkSession
    n = benchmark.count()
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t"))
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, share double, answered boolean, at bigint"
    out = spark.createDataFrame([], schema)
    blocks = -(-n // BLOCK)
    for b in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        out = out.unionAll(_block(docs, [(r["i"], r["t"]) for r in part.collect() if r["t"]], id_col, text_col, item_col, schema))
    return out


def _block(docs: DataFrame, texts: list[tuple[object, str]], id_col: str, text_col: str, item_col: str, schema: str) -> DataFrame:
    number: dict[bytes, int] = {}
    for _, text in texts:
        for w in words_of(text):
            number.setdefault(w, len(number) + 1)
    items = [x for x in (Item(i, t, number) for i, t in texts) if x.words]
    spark = docs.sparkSession
    if not items:
        return spark.createDataFrame([], schema)
    numbered = written(_numbered(docs, number, id_col, text_col), "numbered")
    index = Index(items, *latent_space(numbered, len(number) + 1))
    item_kind = pa.array([x.id for x in items]).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], [np.frombuffer(data.as_buffer(), np.int32) for data in batch.column(1)]
            upto = np.cumsum([len(t) for t in texts]) // WORDS  # so many words at once, give or take a document
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(upto)) + 1):
                if len(part):
                    rows += [(part[t], *hit) for t, *hit in index.hits([texts[i] for i in part])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([index.items[r[1]].id for r in rows], item_kind),
                    pa.array([r[2] for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.bool_()),
                    pa.array([r[4] for r in rows], pa.int64()),
                ],
                [id_col, item_col, "share", "answered", "at"],
            )

    found = written(numbered.select("id", "words").mapInArrow(lean(run), schema), "hits")
    remove(spark, numbered)
    return found
