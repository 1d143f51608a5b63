"""Substring deduplication by paragraph: MinHash banding, verified Jaccard, connected components; and repeated runs of words.

A document's lines of at least MIN_WORDS words are paragraphs. Equal ones (lower-cased words) share a fingerprint and are
one node. Each node has MinHash values over its five-word shingles, cut into bands tuned for recall: at a similarity of
0.8, 9 bands of 3 rows miss (1 - 0.8**3)**9 of the pairs, 0.16 %. Nodes that share a band's key meet in a bucket; equal
buckets of several bands are compared once. In a bucket a pair is verified by the exact Jaccard similarity of the shingle
sets unless it is connected already, so no link between components is lost and no square of pairs is made for a group of
near copies. Buckets of over TILE nodes are compared tile against tile.

Runs of MIN_WORDS words that stand word by word in another document are found wherever they lie, over several lines or
inside a longer one. Each run has a mark: of the hashes of GRAM words in a row that lie in it, the least. Runs that
follow each other mostly have the same mark, so a text is cut into pieces: runs of one mark in a row. Equal runs have the
same mark at the same place, so only pieces whose mark stands in another text matter. Of these, pieces that are equal as
a whole are settled at once, as inside of a repeated passage; a mark with pieces that differ, as at a passage's ends, has
its runs compared one by one, one copy of each piece. The result is that of comparing all runs. Texts that are equal as
a whole enter once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import only_keys, remove, salted_join, written
from .graph import components

MIN_WORDS, SHINGLE, SIMILARITY = 50, 5, 0.8
BANDS, ROWS = 9, 3
TILE = 2_048
#: Words of a mark.
GRAM = 25
#: Words hashed at once, give or take a text; run starts looked at once, which fit into PLACE bits.
SLAB, CHUNK, PLACE = 1 << 20, 1 << 23, 24
#: Bytes of a line split at once, give or take a word.
BYTES = 1 << 24
_MIX = np.random.default_rng(20).integers(1, 1 << 63, (BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))


def _words(line: bytes) -> Iterator[list[bytes]]:
    """A line's lower-cased words, in parts."""
    at = 0
    while len(line) - at > BYTES:
        end = at + BYTES
        while end < len(line) and not _BLANK[line[end]]:
            end += 1
        yield line[at:end].lower().split()
        at = end
    yield (line[at:] if at else line).lower().split()


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes of a text's words; words and characters of each line."""
    parts, held, counts, chars = [], [], [], []
    digest = lambda: np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held))
    for line in text.split("\n"):
        n = 0
        for words in _words(line.encode()):
            n += len(words)
            held += words
            if len(held) > SLAB:
                parts.append(digest())
                held.clear()
        counts.append(n)
        chars.append(len(line))
    parts.append(digest())
    return np.concatenate(parts) if len(parts) > 1 else parts[0], np.array(counts, np.int64), chars


def _shingles(words: np.ndarray) -> np.ndarray:
    """A hash for each run of SHINGLE word hashes."""
    n = len(words) - SHINGLE + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            h = (h ^ words[i : i + n]) * _BASE
            h ^= h >> np.uint64(29)
    return h


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct 64-bit hashes of runs of SHINGLE word hashes; of the whole sequence if it is shorter."""
    return np.unique(_shingles(np.pad(words, (0, max(0, SHINGLE - len(words))))))


def band_keys(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(paragraph, band): 64-bit keys; those of different bands differ. Paragraphs begin at `first` among the shingles."""
    with np.errstate(over="ignore"):
        keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(first), axis=0)
        for i, (a, b) in enumerate(_MIX):
            mins = np.minimum.reduceat(((shingles * a) ^ b) * _BASE, first)
            band = i // ROWS
            keys[:, band] = (keys[:, band] ^ mins) * _BASE
            keys[:, band] ^= keys[:, band] >> np.uint64(31)
    return keys


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a * _BASE + b) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return x * np.uint64(0x94D049BB133111EB) ^ (x >> np.uint64(29))


def _rows_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words in a row, one for each place, from those of 1, 2, 4 ... words."""
    out, have, size, piece = None, 0, 1, words
    while True:
        if n & size:
            out = piece if out is None else _mixed(out[: len(words) - have - size + 1], piece[have:])
            have += size
        if have == n:
            return out
        piece, size = _mixed(piece[:-size], piece[size:]), 2 * size


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of x[i : i + n] at each place."""
    size = 1
    while 2 * size <= n:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def pieces(words: np.ndarray, sizes: np.ndarray, min_words: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first run, last run, mark, its place) of the pieces of texts of `sizes` words that follow each other in `words`."""
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(words))
    low_bits = np.uint64((1 << PLACE) - 1)
    for at in range(0, len(words), CHUNK):
        part = words[at : at + CHUNK + min_words - 1]
        if len(part) < min_words:
            return
        h = _rows_of(part, gram)
        # A hash with its place: ties go to the first place, wherever the text stands.
        low = _sliding_min((h & ~low_bits) | np.arange(len(h), dtype=np.uint64), min_words - gram + 1)
        runs = np.flatnonzero(left[at : at + len(low)] >= min_words)
        if not len(runs):
            continue
        place = (low[runs] & low_bits).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (runs[1:] != runs[:-1] + 1)]))
        last = runs[np.append(first[1:], len(runs)) - 1]
        yield runs[first] + at, last + at, h[place[first]], place[first] + at


def _scan(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(id, t, words, marks, lines) for each text of min_words words: its marks and its paragraphs."""
    for batch in batches:
        rows, known, hold, held = [], set(), [], 0

        def flush() -> None:
            if not hold:
                return
            words = np.concatenate([h[1] for h in hold])
            sizes = np.array([len(h[1]) for h in hold])
            start = np.cumsum(sizes) - sizes
            found = [(np.searchsorted(start, lo, "right") - 1, mark) for lo, _, mark, _ in pieces(words, sizes, min_words, gram)]
            owner, mark = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.array([], np.int64), np.array([], np.uint64))
            bounds = np.searchsorted(owner, np.arange(len(hold) + 1))
            # Paragraphs: lines of enough words.
            counts = np.concatenate([h[2] for h in hold])
            line_start = np.cumsum(counts) - counts
            long = np.flatnonzero(counts >= min_words)
            size = counts[long] - SHINGLE + 1
            if len(long):
                at = np.repeat(line_start[long] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                keys = band_keys(_shingles(words)[at], np.cumsum(size) - size).view(np.int64)
            of_line = np.cumsum([len(h[2]) for h in hold]) - np.array([len(h[2]) for h in hold])
            of = np.searchsorted(of_line, long, "right") - 1
            lines: list[list] = [[] for _ in hold]
            chars = [np.cumsum([0, *(c + 1 for c in h[3])]) for h in hold]
            for k, (i, line) in enumerate(zip(of.tolist(), long.tolist(), strict=True)):
                no, a = line - int(of_line[i]), int(line_start[line])
                fp = xxhash.xxh3_128_digest(words[a : a + int(counts[line])].tobytes())
                # Of copies in a batch, one carries the keys.
                own = None if fp in known else keys[k]
                known.add(fp)
                lines[i].append({"no": no, "start": int(chars[i][no]), "chars": hold[i][3][no], "fp": fp, "keys": own})
            for i, h in enumerate(hold):
                rows.append((h[0], len(h[1]), np.unique(mark[bounds[i] : bounds[i + 1]]).view(np.int64), lines[i]))
            hold.clear()

        for i, text in enumerate(batch.column(2)):
            if text.is_valid and len(text.as_buffer()) >= 2 * min_words - 1:
                words, counts, chars = word_hashes(text.as_py())
                if len(words) >= min_words:
                    hold.append((i, words, counts, chars))
                    held += len(words)
                    if held >= SLAB:
                        flush()
                        held = 0
        flush()
        at = pa.array([r[0] for r in rows], pa.int64())
        line = pa.struct([("no", pa.int32()), ("start", pa.int64()), ("chars", pa.int64()), ("fp", pa.binary()), ("keys", pa.list_(pa.int64()))])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(line))],
            ["id", "t", "words", "marks", "lines"],
        )


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()).cast(kind))


def _details(batches: Iterator[pa.RecordBatch], min_words: int, gram: int) -> Iterator[pa.RecordBatch]:
    """For each text, once in a task: the pieces of the marks asked for, with their runs and places in characters; and
    the shingles of the lines asked for."""
    seen = set()
    for batch in batches:
        at, cols = [], [[] for _ in range(8)]
        at2, fps, sets = [], [], []
        for i, (t, text, marks, numbers) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), batch.column(4), strict=True)):
            if t in seen:
                continue
            seen.add(t)
            text = text.as_py()
            words, counts, _ = word_hashes(text)
            if numbers.is_valid:
                start = np.cumsum(counts) - counts
                for no in numbers.as_py():
                    own = words[start[no] : start[no] + counts[no]]
                    at2.append(i)
                    fps.append(xxhash.xxh3_128_digest(own.tobytes()))
                    sets.append(shingle_set(own).tobytes())
            if not marks.is_valid:
                continue
            raw = np.frombuffer(text.encode(), np.uint8)
            blank = _BLANK[raw]
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            begin = char[np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))]
            end = char[np.flatnonzero(~blank & np.concatenate([blank[1:], [True]]))] + 1
            line = np.repeat(np.arange(len(counts)), counts)
            run = _rows_of(words, min_words)
            sought = marks.values.to_numpy().view(np.uint64)
            for lo, hi, mark, place in pieces(words, np.array([len(words)]), min_words, gram):
                some = np.isin(mark, sought)
                lo, hi, mark, place = lo[some], hi[some], mark[some], place[some]
                key = _mixed(_mixed(run[lo], run[hi]), ((hi - lo) * 4096 + place - lo).astype(np.uint64))
                for a, b, m, k in zip(lo.tolist(), hi.tolist(), mark.view(np.int64).tolist(), key.view(np.int64).tolist(), strict=True):
                    at.append(i)
                    for c, v in zip(cols, (m, k, a, run[a : b + 1].view(np.int64), begin[a : b + 1], end[a + min_words - 1 : b + min_words], line[a : b + 1]), strict=False):
                        c.append(v)
        m, k = len(at), len(at2)
        rows = pa.array(at + at2, pa.int64())
        none = lambda kind, n: pa.nulls(n, kind)
        both = lambda a, b: pa.concat_arrays([a, b])
        long, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(rows), batch.column(1).take(rows), batch.column(5).take(rows),
                both(pa.array(cols[0], pa.int64()), none(pa.int64(), k)), both(pa.array(cols[1], pa.int64()), none(pa.int64(), k)), both(pa.array(cols[2], pa.int64()), none(pa.int64(), k)),
                both(_lists(cols[3], pa.int64()), none(long, k)), *(both(_lists(c, pa.int32()), none(ints, k)) for c in cols[4:7]),
                both(none(pa.binary(), m), pa.array(fps, pa.binary())), both(none(pa.binary(), m), pa.array(sets, pa.binary())),
            ],
            ["id", "t", "copies", "mark", "key", "run", "runs", "begins", "ends", "lines", "fp", "shingles"],
        )


def links_in(fps: list[bytes], sets: list[np.ndarray], other: list[bytes] = (), other_sets: list[np.ndarray] = (), least: float = SIMILARITY) -> list[tuple[bytes, bytes]]:
    """Links that connect whatever links of at least that similarity connect: within fps, or between fps and other.

    Pairs whose ends are connected already aren't verified.
    """
    names, every = [*fps, *other], [*sets, *other_sets]
    n, size = len(fps), np.array([len(s) for s in every])
    label = np.arange(len(names))
    owner = np.repeat(np.arange(len(names)), size)
    flat, inverse = np.unique(np.concatenate(every), return_inverse=True)
    out = []
    for i in range(n):
        there = np.arange(i + 1, len(names)) if not len(other) else np.arange(n, len(names))
        there = there[label[there] != label[i]]
        there = there[np.minimum(size[there], size[i]) >= least * np.maximum(size[there], size[i]) - 1e-9]
        if not len(there):
            continue
        mine = np.zeros(len(flat), np.int64)
        mine[np.searchsorted(flat, every[i])] = 1
        # Count shared shingles of all open nodes at once.
        shared = np.bincount(owner, mine[inverse], len(names))[there]
        near = there[shared >= least * (size[there] + size[i] - shared) - 1e-9]
        for j in near:
            if label[j] != label[i]:
                out.append((names[i], names[j]))
                label[label == label[j]] = label[i]
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each bucket's pair of tiles (key, t1, t2); rows come sorted by these."""

    def links(parts: list[pa.RecordBatch]) -> list[tuple[bytes, bytes]]:
        rows = pa.Table.from_batches(parts)
        fps, tile = rows.column("fp").to_pylist(), rows.column("tile").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles")]
        a, b = rows.column("t1")[0].as_py(), rows.column("t2")[0].as_py()
        if a == b:
            return links_in(fps, sets)
        x, y = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
        return links_in([fps[i] for i in x], [sets[i] for i in x], [fps[i] for i in y], [sets[i] for i in y])

    held, of = [], None
    for batch in batches:
        out = []
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(batch) else []
        for a, b in zip(first, [*first[1:], len(batch)], strict=True):
            if held and tuple(keys[:, a]) != of:
                out += links(held)
                held = []
            held.append(batch.slice(a, b - a))
            of = tuple(keys[:, a])
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])
    if held:
        out = links(held)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], pa.binary())], ["a", "b"])


def band_members(lines: DataFrame) -> DataFrame:
    """(key, t1, t2, tile, node): the nodes of every bucket of two and more, by pair of tiles; lines has fp and keys."""
    nodes = lines.where(F.col("keys").isNotNull()).groupBy("fp").agg(F.first("keys").alias("keys"))
    keyed = nodes.select(F.xxhash64("fp").alias("node"), F.explode("keys").alias("key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = written(keyed.join(several, "key"), "buckets")
    mix = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mix{i}") for i in range(2)]
    buckets = shared.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least"), *mix)
    # The same members under several bands are compared once.
    chosen = buckets.groupBy("n", "least", "mix0", "mix1").agg(F.min("key").alias("key"))
    chosen = chosen.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    members = salted_join(shared, chosen, ["key"], F.col("node")).withColumn("tile", F.pmod("node", F.col("tiles")).cast("int"))
    # A tile meets itself and every other one: (smaller, larger).
    members = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return members.select("key", F.least("tile", "with").alias("t1"), F.greatest("tile", "with").alias("t2"), "tile", "node")


def near_links(members: DataFrame, shingles: DataFrame) -> DataFrame:
    """(a, b) between the fingerprints of similar nodes in a bucket."""
    sets = shingles.dropDuplicates(["fp"]).withColumn("node", F.xxhash64("fp"))
    rows = members.join(sets, "node").select("key", "t1", "t2", "tile", "fp", "shingles")
    return rows.repartition("key", "t1", "t2").sortWithinPartitions("key", "t1", "t2").mapInArrow(_compared, "a binary, b binary")


def _segments(shared):
    """Neighbouring runs (off, first, at), sorted by off, of which the first copies are neighbours too, as (a, b, first,
    at): from off a to off b."""
    breaks = lambda x, y: (x["off"] + 1 != y["off"]) | (x["at"] + 1 != y["at"]) | ~x["first"].eqNullSafe(y["first"])
    heads = F.filter(
        F.transform(shared, lambda x, i: F.when((i == 0) | breaks(F.get(shared, i - 1), x), i).otherwise(-1)), lambda i: i >= 0
    )
    stop = lambda k: F.coalesce(F.get(heads, k + 1), F.size(shared)) - 1
    return F.transform(
        heads, lambda i, k: F.struct(F.get(shared, i)["off"].alias("a"), F.get(shared, stop(k))["off"].alias("b"), F.get(shared, i)["first"].alias("first"), F.get(shared, i)["at"].alias("at"))
    )


def repeated_stretches(found: DataFrame) -> DataFrame:
    """(id, line, begin, end, first_id, members, removed) from the pieces of distinct texts: the longest stretches whose
    runs all stand in another text, and whose first copies, by id and place, adjoin too."""
    own = found.withColumn("first", F.struct("id", "t"))
    last = F.struct("first", F.col("run").alias("at"), "runs")
    keys = own.groupBy("mark", "key").agg(F.min(last).alias("x"), F.min("t").alias("low"), F.max("t").alias("high"), F.sum("copies").alias("members"))
    keys = written(keys, "pieces")
    many = keys.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark", F.lit(True).alias("mixed"))
    keys = salted_join(keys, many, ["mark"], F.col("key"), "left")
    whole = keys.where("mixed is null and low != high")
    whole = whole.select("mark", "key", "members", F.array(F.struct(F.lit(0).alias("a"), (F.size("x.runs") - 1).alias("b"), F.col("x.first"), F.col("x.at"))).alias("parts"))
    # The runs of a mark's pieces that differ, of each piece once.
    pool = keys.where("mixed").select("mark", "key", "low", "high", "members", "x.first", "x.at", F.posexplode("x.runs").alias("off", "one"))
    pool = pool.withColumn("at", F.col("at") + F.col("off"))
    shared = pool.groupBy("one").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("members").alias("members"), F.min(F.struct("first", "at")).alias("x")).where("low != high")
    hits = pool.select("mark", "key", "off", "one").join(shared.select("one", "members", "x"), "one")
    mixed = hits.groupBy("mark", "key").agg(F.max("members").alias("members"), F.array_sort(F.collect_list(F.struct("off", "x.first", "x.at"))).alias("shared"))
    mixed = mixed.select("mark", "key", "members", _segments(F.col("shared")).alias("parts"))
    # The piece of a passage that many texts share is a skewed key, which adaptive execution deals to several tasks.
    parts = own.select("mark", "key", "id", "t", "run", "begins", "ends", "lines", "first").join(whole.unionByName(mixed), ["mark", "key"])
    parts = parts.select("id", "t", "run", "begins", "ends", "lines", "members", "first", F.explode("parts").alias("p"))
    parts = parts.select(
        "id", "t", (F.col("run") + F.col("p.a")).alias("lo"), (F.col("run") + F.col("p.b")).alias("hi"), F.get("begins", F.col("p.a")).alias("begin"), F.get("ends", F.col("p.b")).alias("end"),
        F.get("lines", F.col("p.a")).alias("line"), "members", F.col("p.first").alias("of"), (F.col("run") + F.col("p.a") - F.col("p.at")).alias("shift"), F.col("first").alias("own"),
    ).distinct()
    of_text = Window.partitionBy("t").orderBy("lo")
    follows = F.lag(F.struct("hi", "shift", "of")).over(of_text).eqNullSafe(F.struct((F.col("lo") - 1).alias("hi"), "shift", "of"))
    parts = parts.withColumn("no", F.sum(F.when(follows, 0).otherwise(1)).over(of_text))
    removed = ~(F.col("own").eqNullSafe(F.col("of")) & (F.col("shift") == 0))
    return parts.groupBy("t", "no").agg(
        F.first("id").alias("id"), F.min("line").alias("line"), F.min("begin").cast("bigint").alias("begin"), F.max("end").cast("bigint").alias("end"), F.first("of.id").alias("first_id"),
        F.max("members").alias("members"), F.first(removed).alias("removed"),
    ).select("id", "line", "begin", "end", "first_id", "members", "removed")


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, gram: int | None = None) -> DataFrame:
    """(doc_id, kind, paragraph, start, n_chars, component_id, members, removed): what repeats in another document.

    kind says what: "paragraph", a line of min_words words or more that repeats nearly or exactly; "stretch", words in a
    row, min_words or more, all runs of which stand in another text, unless they lie within such a paragraph; "text", the
    whole text of documents that are equal. start and n_chars give the place in the text in characters, paragraph the
    number of its line (of a stretch: where it begins). The component is named after the least id; its first copy, by id
    and place, is the one that isn't removed. members counts a paragraph's or run's places, a text's documents.

    Stretches are given for the first document of equal texts; the others have the row of their whole text. Null, empty
    and shorter texts have nothing; repeated rows of one id count as one document; a null id is a document of its own,
    first in order. Other columns are ignored; an empty table gives no rows. Whole texts are read.
    """
    gram = gram or (min_words + 1) // 2
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    line = "struct<no:int,start:bigint,chars:bigint,fp:binary,keys:array<bigint>>"
    table = written(texts.mapInArrow(lambda b: _scan(b, min_words, gram), f"id {kind}, t bigint, words bigint, marks array<bigint>, lines array<{line}>"), "scan")
    lines = table.select("id", "t", F.explode("lines").alias("line")).select("id", "t", "line.*")
    members = written(band_members(lines), "members")
    # What to look at again: marks that stand in two texts, and one place of each node that is in a bucket.
    each = table.select("t", F.explode("marks").alias("mark"))
    # First those that occur twice, equal texts included, as that needs no text to go along.
    twice = each.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    each = written(each.join(twice, "mark"), "marks")
    shared = each.groupBy("mark").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low != high").select("mark")
    marks = each.join(shared, "mark").groupBy("t").agg(F.collect_set("mark").alias("marks"))
    nodes = lines.select(F.xxhash64("fp").alias("node"), "fp", "t", "no").join(members.select("node").distinct(), "node")
    places = nodes.groupBy("fp").agg(F.min(F.struct("t", "no")).alias("x")).groupBy("x.t").agg(F.collect_set("x.no").alias("numbers"))
    copies = table.select("id", "t", "words").distinct().groupBy("t").agg(F.min(F.struct("id")).alias("first"), F.count("*").alias("copies"))
    copies = written(copies, "copies")
    need = marks.join(places, "t", "full").join(copies, "t").select(F.col("t").alias("nt"), F.col("first.id").alias("nid"), "marks", "numbers", "copies")
    need = written(need, "need")
    again = only_keys(texts.where(F.octet_length("text") >= 2 * min_words - 1), need.select(F.col("nt").alias("t")), "t")
    again = again.join(need, (F.col("t") == F.col("nt")) & F.col("id").eqNullSafe(F.col("nid")))
    schema = f"id {kind}, t bigint, copies bigint, mark bigint, key bigint, run bigint, runs array<bigint>, begins array<int>, ends array<int>, lines array<int>, fp binary, shingles binary"
    found = again.select("id", "t", "text", "marks", "numbers", "copies").mapInArrow(lambda b: _details(b, min_words, gram), schema)
    found = written(found, "details")
    joined = components(near_links(members, found.where(F.col("fp").isNotNull()).select("fp", "shingles")))
    spots = lines.select("id", "no", "start", "chars", "fp").distinct()
    # A node of no component is one by itself.
    named = salted_join(spots, joined.withColumnRenamed("node", "fp"), ["fp"], F.xxhash64("id", "no"), "left").withColumn("c", F.coalesce("component", "fp"))
    of_doc = F.struct("id")
    sizes = named.groupBy("c").agg(F.count("*").alias("members"), F.min(of_doc).alias("low"), F.max(of_doc).alias("high"), F.min(F.struct("id", "no")).alias("first"))
    whole = salted_join(named, sizes.where("low != high").drop("low", "high"), ["c"], F.xxhash64("id", "no"))
    whole = written(
        whole.select(
            "id", F.col("no").alias("line"), F.col("start").alias("begin"), (F.col("start") + F.col("chars")).alias("end"), F.col("first.id").alias("first_id"), "members",
            (~F.struct("id", "no").eqNullSafe(F.col("first"))).alias("removed"),
        ), "repeated",
    )
    runs = repeated_stretches(found.where(F.col("mark").isNotNull()))
    held = whole.select(F.col("id").alias("wid"), F.col("line").alias("wline"), F.col("begin").alias("wbegin"), F.col("end").alias("wend"))
    within = runs["id"].eqNullSafe(held["wid"]) & (runs["line"] == held["wline"]) & (runs["begin"] >= held["wbegin"]) & (runs["end"] <= held["wend"])
    runs = runs.join(held, within, "left_anti")
    equal = salted_join(texts.select("id", "t", F.char_length("text").cast("bigint").alias("end")).distinct(), copies.where("copies > 1"), ["t"], F.xxhash64("id"))
    equal = equal.select(
        "id", F.lit(0).alias("line"), F.lit(0).cast("bigint").alias("begin"), "end", F.col("first.id").alias("first_id"), F.col("copies").alias("members"), (~F.col("id").eqNullSafe(F.col("first.id"))).alias("removed")
    )
    out = whole.withColumn("kind", F.lit("paragraph")).unionByName(runs.withColumn("kind", F.lit("stretch"))).unionByName(equal.withColumn("kind", F.lit("text")))
    out = written(
        out.select(
            F.col("id").alias(id_col), "kind", F.col("line").alias("paragraph"), F.col("begin").alias("start"), (F.col("end") - F.col("begin")).alias("n_chars"),
            F.col("first_id").alias("component_id"), "members", "removed",
        ), "spans",
    )
    for x in (table, members, each, copies, need, found, whole):
        remove(docs.sparkSession, x)
    return out


def _without(batches: Iterator[pa.RecordBatch], at: int, gone: int) -> Iterator[pa.RecordBatch]:
    """Texts without the ranges (start, n_chars); a line of which nothing is left goes with its end."""
    for batch in batches:
        out = []
        for text, ranges in zip(batch.column(at).to_pylist(), batch.column(gone).to_pylist(), strict=True):
            if text is not None and ranges:
                keep, start, lines = np.ones(len(text), bool), 0, []
                for r in ranges:
                    keep[r["start"] : r["start"] + r["n_chars"]] = False
                for line in text.split("\n"):
                    left = keep[start : start + len(line)]
                    if left.all():
                        lines.append(line)
                    elif left.any():
                        lines.append("".join(c for c, k in zip(line, left, strict=True) if k))
                    start += len(line) + 1
                text = "\n".join(lines)
            out.append(text)
        cols = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns) if i != gone]
        yield pa.RecordBatch.from_arrays(cols, [n for i, n in enumerate(batch.schema.names) if i != gone])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated paragraphs and stretches taken out of the texts; all rows and columns stay, as do rows
    with null ids."""
    gone = repeated_paragraphs(docs, id_col, text_col, min_words).where("removed")
    gone = gone.groupBy(F.col(id_col).alias("__id")).agg(F.collect_set(F.struct("start", "n_chars")).alias("__gone"))
    both = docs.join(gone, docs[id_col] == F.col("__id"), "left").select(*docs.columns, "__gone")
    at, last = docs.columns.index(text_col), len(docs.columns)
    return both.mapInArrow(lambda b: _without(b, at, last), docs.schema)
