"""Exact deduplication by composable polynomial fingerprints, confirmed by a chunkwise comparison of texts.

A text is a sequence of bytes; its fingerprint is the pair of polynomial values sum(b[i] * x**(n-1-i)) mod P for two
bases x, with its length. Fingerprints of adjoining chunks compose: H(a + b) = H(a) * x**len(b) + H(b), so that chunks of
a huge document are hashed in parallel and combined by length-shifted arithmetic. Texts whose fingerprints agree are
then compared chunk by chunk with the group's first text; what differs forms a group of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, salted_join, written

P = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_013)
#: Bytes that one polynomial is summed over: 2**23 products under 2**39 stay under 2**62.
CHUNK = 1 << 16
#: Characters of a text compared at once.
PIECE = 1 << 16
#: Bytes from which a document's chunks are hashed by several tasks.
HUGE = 8 << 20
#: Copies compared with one replica of a group's first text.
SPREAD = 2_000

_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_RUNS = re.compile(rb"  +")


def normalise(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    text = text.translate(_SPACES)
    return _RUNS.sub(b" ", text) if b"  " in text else text


@lru_cache(maxsize=8)
def _powers(base: int, n: int = CHUNK) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for i in range(1, n):
        out[i] = int(out[i - 1]) * base % P
    return out[::-1].copy()


def chunk_hash(chunk: bytes, base: int) -> int:
    """The polynomial of at most CHUNK bytes; bytes count from 1 so that leading zero bytes matter."""
    if not chunk:
        return 0
    values = np.frombuffer(chunk, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(np.dot(values, _powers(base)[CHUNK - len(chunk) :])) % P


def combine(left: int, right: int, right_length: int, base: int) -> int:
    """H(a + b) from H(a), H(b) and len(b)."""
    return (left * pow(base, right_length, P) + right) % P


def fingerprint(text: bytes) -> tuple[int, int]:
    """Both polynomials of a text of any length, chunk by chunk."""
    out = []
    for base in BASES:
        h = chunk_hash(text[:CHUNK], base)
        for at in range(CHUNK, len(text), CHUNK):
            part = text[at : at + CHUNK]
            h = combine(h, chunk_hash(part, base), len(part), base)
        out.append(h)
    return out[0], out[1]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h1, h2, size, sha = [], [], [], []
        for text in batch.column(1):
            norm = normalise(text.as_buffer().to_pybytes() if text.is_valid else b"")
            a, b = fingerprint(norm)
            h1.append(a)
            h2.append(b)
            size.append(len(norm))
            sha.append(hashlib.sha256(norm).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(size, pa.int64()), pa.array(sha, pa.string())],
            ["id", "h1", "h2", "size", "sha"],
        )


def _hashed_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for chunk in batch.column(2):
            data = chunk.as_py().encode()
            rows.append((*fingerprint(data), len(data), *(pow(x, len(data), P) for x in BASES)))
        cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["id", "no", "h1", "h2", "size", "s1", "s2"])


def _norm(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _pieces(text: Column, length: int) -> Column:
    """An array of (no, piece) of at most `length` characters, at least one."""
    last = F.greatest(F.lit(0), F.floor((F.char_length(text) - 1) / length)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("no"), F.substring(text, i * length + 1, F.lit(length)).alias("piece")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE) -> DataFrame:
    """(id, h1, h2, size, sha) per row: documents of over `huge` bytes have their chunks hashed as separate rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, h1 bigint, h2 bigint, size bigint, sha string"
    small = rows.where(F.octet_length("text") <= huge).mapInArrow(lean(_hashed), schema)
    large = rows.where(F.octet_length("text") > huge).select("id", _norm(F.col("text")).alias("text"))
    large = large.select("id", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"), F.explode(_pieces(F.col("text"), huge // 8)).alias("x"))
    chunks = (
        large.repartition("id", "sha", "x.no")
        .select(F.struct("id", "sha").alias("id"), "x.no", "x.piece")
        .mapInArrow(lean(_hashed_chunks), f"id struct<id:{docs.schema[id_col].dataType.simpleString()},sha:string>, no int, h1 bigint, h2 bigint, size bigint, s1 bigint, s2 bigint")
    )
    # A text has at most 2 GB, so its chunk hashes are a short list.
    step = lambda acc, x: F.struct(
        ((acc["h1"] * x["s1"] + x["h1"]) % P).alias("h1"), ((acc["h2"] * x["s2"] + x["h2"]) % P).alias("h2"), (acc["size"] + x["size"]).alias("size")
    )
    zero = F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("h1", "h2", "size")))
    whole = chunks.groupBy("id").agg(F.aggregate(F.array_sort(F.collect_list(F.struct("no", "h1", "h2", "size", "s1", "s2"))), zero, step).alias("h"))
    return small.unionByName(whole.select("id.id", "h.h1", "h.h2", "h.size", "id.sha"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE, key: Column | None = None) -> DataFrame:
    """One row per row of docs: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal if they are the same bytes after every run of ASCII white space became one space; a null text counts
    as empty. The smallest id of a group stays, with all of its rows if it repeats; group_size counts rows. Null ids sort
    first, as ids of their own. Other columns are ignored; an empty table gives no rows. `key` overrides the fingerprint
    (tests force collisions).
    """
    rows = written(fingerprints(docs, id_col, text_col, huge), "prints")
    rows = rows.withColumn("key", F.struct("h1", "h2", "size") if key is None else F.struct(key.cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"), F.lit(0).cast("bigint").alias("size")))
    order = F.struct(F.col("id"), F.col("sha"))  # nulls are least in a struct
    prints = rows.groupBy("key", "id", "sha").agg(F.count("*").alias("n"))
    groups = prints.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("members"), F.sum("n").alias("group_size")).where("group_size > 1")
    groups = written(groups, "groups")
    spread = F.xxhash64("id", "sha")
    members = salted_join(prints, groups.where("members > 1"), ["key"], spread).select("id", "sha", "n", "key", "first", "members")
    again = written(_differing(docs, members, id_col, text_col), "differing")
    # Most rows are alone; a large group's rows are joined in several tasks.
    final = salted_join(rows, groups, ["key"], spread, "left").select("id", "sha", F.coalesce("first", order).alias("first"), F.coalesce("group_size", F.lit(1)).alias("group_size"))
    if not again.isEmpty():
        # Unequal texts under one fingerprint: these few get groups by the text itself.
        own = members.join(again, on=[members.id.eqNullSafe(again.rid), members.sha == again.rsha], how="left")
        own = own.withColumn("group", F.struct("key", F.when(F.col("rsha").isNotNull(), F.col("text")).alias("text")))
        regrouped = own.groupBy(F.col("group").alias("g")).agg(F.min(order).alias("first"), F.sum("n").alias("group_size"))
        own = own.select("id", "sha", "group").join(regrouped, F.col("group").eqNullSafe(F.col("g"))).select(F.col("id").alias("oid"), F.col("sha").alias("osha"), F.col("first").alias("ofirst"), F.col("group_size").alias("osize"))
        final = final.join(own, final["id"].eqNullSafe(own["oid"]) & (final["sha"] == own["osha"]), "left").select(
            "id", "sha", F.coalesce("ofirst", "first").alias("first"), F.coalesce("osize", "group_size").alias("group_size")
        )
    return final.select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size",
        F.col("id").eqNullSafe(F.col("first.id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def _differing(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rid, rsha, text) of members whose text isn't that of their group's first row, found chunk by chunk.

    Large groups are spread: each SPREAD copies meet a replica of the first text's chunks.
    """
    rows = docs.select(F.col(id_col).alias("did"), _norm(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    small = members.select("id", "sha", "first", "members").hint("shuffle_hash")
    found = rows.join(small, on=rows.did.eqNullSafe(small.id)).where(F.sha2(F.encode("text", "UTF-8"), 256) == F.col("sha"))
    found = found.withColumn("parts", F.ceil(F.col("members") / SPREAD).cast("int"))
    is_first = F.struct("id", "sha").eqNullSafe(F.col("first"))
    at = [F.struct("first", "parts").alias("group")]
    first = (
        found.where(is_first)
        .select(*at, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
        .select("group", "part", F.explode(_pieces(F.col("text"), PIECE)).alias("x"))
        .select("group", "part", "x.no", F.col("x.piece").alias("there"))
    )
    others = found.where(~is_first).select(
        *at, F.pmod(F.xxhash64("id", "sha"), F.col("parts")).cast("int").alias("part"), "id", "sha", F.explode(_pieces(F.col("text"), PIECE)).alias("x")
    )
    others = others.select("group", "part", F.col("x.no").alias("no"), "id", "sha", F.col("x.piece").alias("here"))
    # A chunk that the other text lacks differs too; equal byte counts rule out a proper prefix.
    bad = others.join(first, ["group", "part", "no"], "left").where(~F.col("here").eqNullSafe(F.col("there"))).select("id", "sha").distinct()
    bad = bad.select(F.col("id").alias("bid"), F.col("sha").alias("bsha"))
    whole = found.select("id", "sha", "text").join(bad, on=F.col("id").eqNullSafe(F.col("bid")) & (F.col("sha") == F.col("bsha")))
    return whole.select(F.col("id").alias("rid"), F.col("sha").alias("rsha"), "text").distinct()
