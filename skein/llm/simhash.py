"""SimHash near-duplicates: every pair of fingerprints within the radius, found by tiled exclusive-or and bit counts.

Two fingerprints that differ in at most RADIUS bits agree in one of RADIUS + 1 stretches of their bits; so distinct
fingerprints meet in cells by stretch and its value (at most RADIUS + 1 times 2**13 cells whatever the input). A cell of
more than a tile is cut by bit count, and two of its tiles meet only if their bit counts allow a distance within the
radius. Within a tile, or a pair of tiles, numpy compares all whose bit counts allow it, and a spanning forest of the
links leaves the task, so that a large group of near copies gives no square of links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, salted_join, written
from .graph import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a tile at most, give or take the scatter of a hash.
TILE = 1 << 16
#: Shingles whose bits are unpacked at once, give or take a text of as many (64 bytes each, and 512 while they are summed).
SLAB = 1 << 15
_SPLIT = re.compile(rb"[\x20\x09-\x0D]+")


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of `width` words (repeats included); of the whole sequence if it is shorter; none if empty."""
    words = text.lower().split()  # bytes: lowers A-Z only, splits at ASCII white space
    n = len(words)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if n else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, n) - 1
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[: n - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)), np.uint64, n - width + 1)


def majority(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A fingerprint per run of hashes (runs begin at starts, none is empty): bits set in over half of a run."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(hashes)))
    return np.packbits(2 * sums > sizes[:, None], axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprint(text: bytes) -> int:
    """Of one text; long ones are summed slab by slab."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    sums = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLAB):
        sums += np.unpackbits(hashes[i : i + SLAB].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > len(hashes)).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros(len(batch), np.uint64)
        rows, parts, size = [], [], 0

        def flush() -> None:
            if rows:
                out[rows] = majority(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])[:-1]]))
            rows.clear()
            parts.clear()

        for i, text in enumerate(batch.column(1)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if len(data) > 2 * SLAB:  # perhaps more shingles than a slab has
                out[i] = fingerprint(data)
                continue
            hashes = shingle_hashes(data)
            if len(hashes):
                rows.append(i)
                parts.append(hashes)
                size += len(hashes)
            if size > SLAB:
                flush()
                size = 0
        flush()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row; a text without words, or null, has fingerprint zero."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        lean(_fingerprints), f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint"
    )


def links_between(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among a (b is None) or between a and b. All pairs are compared."""
    # By bit count, so that most blocks are too far apart to compare.
    order = lambda x: x[np.argsort(np.bitwise_count(x), kind="stable")]
    a, b = order(a), b if b is None else order(b)
    nodes = a if b is None else np.concatenate([a, b])
    there, offset = (a, 0) if b is None else (b, len(a))
    ones, ones2 = (np.bitwise_count(x).astype(np.int64) for x in (a, there))
    label = np.arange(len(nodes))
    left, right = [], []
    for i in range(0, len(a), 64):
        for j in range(0, len(there), 4096):
            if b is None and j + 4096 <= i:
                continue
            if ones2[j] - ones[min(i + 64, len(a)) - 1] > radius or ones[i] - ones2[min(j + 4096, len(there)) - 1] > radius:
                continue
            near = np.bitwise_count(a[i : i + 64, None] ^ there[None, j : j + 4096]) <= radius
            u, v = np.nonzero(near)
            u, v = u + i, v + j + offset
            while True:
                x, y = label[u], label[v]
                open_ = x != y
                if not open_.any():
                    break
                u, v, x, y = u[open_], v[open_], x[open_], y[open_]
                low, high = np.minimum(x, y), np.maximum(x, y)
                roots, at = np.unique(high, return_index=True)  # one link for each root that is hung under another
                left.append(nodes[u[at]])
                right.append(nodes[v[at]])
                label[roots] = low[at]
                while True:
                    up = label[label]
                    if (up == label).all():
                        break
                    label = up
    none = np.array([], nodes.dtype)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def stretches(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the radius + 1 stretches of 64 bits."""
    cut = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cut, cut[1:], strict=False)]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), enough of them to join whatever all links join."""
    value = [F.shiftrightunsigned("fp", at).bitwiseAND((1 << n) - 1) for at, n in stretches(radius)]
    cells = prints.select("fp", F.bit_count("fp").cast("int").alias("ones"), F.posexplode(F.array(*value)).alias("stretch", "value"))
    # The cells are few whatever the input; only those of more than a tile are counted by their bits too.
    big = F.broadcast(cells.groupBy("stretch", "value").agg(F.count("*").alias("n")).where(F.col("n") > tile).select("stretch", "value", F.lit(True).alias("big")))
    cells = cells.join(big, ["stretch", "value"], "left").withColumn("ones", F.when(F.col("big"), F.col("ones")).otherwise(-1)).drop("big")
    sizes = cells.where("ones >= 0").groupBy("stretch", "value", "ones").agg(F.ceil(F.count("*") / tile).cast("int").alias("n"))
    sizes = F.broadcast(sizes)
    placed = cells.join(sizes, ["stretch", "value", "ones"], "left").withColumn("t", F.pmod(F.xxhash64("fp"), F.coalesce("n", F.lit(1))).cast("int"))
    tiles = written(placed.groupBy("stretch", "value", "ones", "t").agg(F.collect_list("fp").alias("fps")).where((F.col("ones") >= 0) | (F.size("fps") > 1)), "tiles")
    alone = tiles.select("fps", F.lit(None).cast("array<bigint>").alias("fps2"))
    split = tiles.where("ones >= 0")
    others = sizes.select("stretch", "value", F.col("ones").alias("ones2"), F.col("n").alias("n2"))
    # Pairs of tiles of one cell: later ones of the same bit count, all of the next few.
    to = split.join(others, ["stretch", "value"]).where(F.col("ones2").between(F.col("ones"), F.col("ones") + radius))
    to = to.withColumn("t2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1))).where("ones2 > ones or t2 > t")
    other = split.select("stretch", "value", F.col("ones").alias("ones2"), F.col("t").alias("t2"), F.col("fps").alias("fps2"))
    pairs = to.join(other.hint("shuffle_hash"), ["stretch", "value", "ones2", "t2"]).select("fps", "fps2")
    rows = alone.unionByName(pairs).repartition(3 * int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                a = x.values.to_numpy().view(np.uint64)
                b = y.values.to_numpy().view(np.uint64) if y.is_valid else None
                u, v = links_between(a, b, radius)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["a", "b"])

    return rows.mapInArrow(lean(compare), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: (doc_id, fingerprint, component_id).

    Null, empty and blank texts have fingerprint zero and link like any other. component_id is the smallest non-null id
    that links reach (null if there is none); repeated ids and rows keep a row each; other columns are ignored; an empty
    table gives no rows. Texts are read whole; equal fingerprints count as one node.
    """
    prints = written(fingerprints(docs, id_col, text_col), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    joined = components(links(nodes, radius))
    own = nodes.join(joined, nodes.fp == joined.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    names = own.groupBy("c").agg(F.min("least").alias("component_id"))
    named = salted_join(own, names, ["c"], F.col("fp")).select("fp", "component_id")
    return salted_join(prints, named, ["fp"], F.xxhash64("id")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
