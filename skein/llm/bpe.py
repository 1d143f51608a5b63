"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

A token sequence is the BPE encoding of its bytes exactly if each pair of neighbours encodes to itself. So every prefix
of a piece has one valid last token: the one that is an encoding by itself (it starts the piece) or that forms a valid
pair with the last token of the prefix before it. PieceEncoder keeps that token per prefix: appending bytes adds
entries and never changes one; an edit drops the entries behind it. Texts are cut into pieces by the tokenizer's
pattern; a piece that is a token as a whole is that token.

Texts are taken slab by slab. A slab is cut into pieces at once, by the categories of its characters, and its distinct
pieces, told apart by hashes, are encoded side by side: step k finds the last token of all their prefixes of k bytes. The
ids are decoded again, and decoded bytes that differ from the slab's show a hash that misled; then the slab is encoded
piece by piece, as are texts under other patterns and long pieces.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from .common import lean

#: Neighbours whose validity a worker remembers.
PAIRS = 300_000
#: Bytes encoded at once, give or take a text; a longer text is cut at spaces that stand alone.
SLAB = 1_000_000
#: Bytes of the longest piece that is encoded side by side with others.
LONG = 64
#: The pattern that is cut by categories: contractions, letters, numbers, others, white space.
CATEGORIES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks with what prefix encoding looks up: which neighbours are valid.

    Merging goes by rising rank, as every token outranks its parts. The parts at a token's edge, each with the rank at
    which it is merged further, thus tell what can happen where two tokens meet: parts a | b join across the border if
    their joint rank comes before that of b's next merge or equals it (the leftmost goes first), and before a's.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        #: The end of any token -> its rank if it is a token itself, else -1.
        self.ends = {t[i:]: -1 for t in ranks for i in range(len(t))} | ranks
        self.span = max(self.tokens, default=0) + 1
        self.known: dict[int, bool] = {}
        self._edges: dict[bytes, tuple[list, list] | None] = {}

    def merge(self, data: bytes, left: list | None = None, right: list | None = None) -> list[bytes]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none join. For short data.

        left and right get the parts at either edge, each with the rank at which it was merged (-1: never).
        """
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            if left is not None and at == 0:
                left.append((parts[0], best))
            if right is not None and at == len(parts) - 2:
                right.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: bytes) -> tuple[list, list] | None:
        """The token's left and right edge parts; None if its bytes don't merge into it."""
        if token not in self._edges:
            left, right, never = [], [], 1 << 62
            whole = self.merge(token, left, right) == [token]
            self._edges[token] = ([*left, (token, never)], [*right, (token, never)]) if whole else None
        return self._edges[token]

    def alone(self, token: bytes) -> bool:
        """Whether a token's bytes merge into the token."""
        return self.edges(token) is not None

    def valid(self, left: int, right: int) -> bool:
        """Whether two tokens (ranks) side by side are the encoding of their bytes."""
        if len(self.known) > PAIRS // 4:
            self.known.clear()
        x, y, get = self.edges(self.tokens[left]), self.edges(self.tokens[right]), self.ranks.get
        found = x is not None and y is not None
        if found:
            for a, a_next in x[1]:
                for b, b_next in y[0]:
                    rank = get(a + b)
                    if rank is not None and rank < a_next and rank <= b_next:
                        found = False
        self.known[left * self.span + right] = found
        return found


class PieceEncoder:
    """The last tokens of all prefixes of one piece, and where each begins."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.begins = vocabulary, b"", [], []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Lengthen the piece: entries of earlier prefixes stay as they are."""
        start = len(self.data)
        self.data += more
        self._extend(start)

    def _extend(self, start: int) -> None:
        v, data, last, begins = self.vocabulary, self.data, self.last, self.begins
        ends, known, span = v.ends, v.known, v.span
        for end in range(start + 1, len(data) + 1):
            begin = end - 1
            while True:
                rank = ends.get(data[begin:end])
                if rank is None:  # no longer token can end here
                    raise ValueError(f"byte {data[end - 1]} isn't in the vocabulary")
                if rank >= 0:
                    if begin:
                        before = last[begin - 1]
                        ok = known.get(before * span + rank)
                        if ok is None:
                            ok = v.valid(before, rank)
                    else:
                        ok = v.alone(data[:end])
                    if ok:
                        last.append(rank)
                        begins.append(begin)
                        break
                begin -= 1

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace data[start:end]: only prefixes behind start are encoded again."""
        tail = self.data[end:]
        self.data = self.data[:start] + new + tail
        del self.last[start:], self.begins[start:]
        self._extend(start)

    def become(self, data: bytes) -> None:
        """Go on to another piece: the prefixes that both have stay."""
        same = 0
        for a, b in zip(self.data, data):  # noqa: B905
            if a != b:
                break
            same += 1
        self.data = data
        del self.last[same:], self.begins[same:]
        self._extend(same)

    def ids(self) -> list[int]:
        out, end, last, begins = [], len(self.data), self.last, self.begins
        while end:
            out.append(last[end - 1])
            end = begins[end - 1]
        out.reverse()
        return out


class Table:
    """Open addressing: 64-bit keys to small integers, -1 for unknown ones. All keys of a call are looked up at once."""

    _FREE = np.uint64((1 << 64) - 1)

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, self._FREE), np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        open_ = np.flatnonzero((found != keys) & (found != self._FREE))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found, own = self.keys[slot[open_]], keys[open_]
            hit = found == own
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != self._FREE)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that aren't there yet."""
        if 2 * (self.size + len(keys)) > 1 << self.bits:
            had = self.keys != self._FREE
            old = self.keys[had], self.values[had]
            self.__init__(max(self.bits + 1, int(4 * (self.size + len(keys))).bit_length()))
            self.put(*old)
        self.size += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == self._FREE
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            slot, keys, values = (slot[~placed] + 1) & ((1 << self.bits) - 1), keys[~placed], values[~placed]


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + sizes[i]] for each i of which, one after another."""
    size = sizes[which]
    ends = np.cumsum(size)
    shift = starts[which] - (ends - size)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, size)]


def categories() -> np.ndarray:
    """0 (others), 1 (letters), 2 (numbers) or 3 (white space) of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        chars = "".join(map(chr, range(low, high)))
        for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
            for m in regex.finditer(pattern, chars):
                out[low + m.start() : low + m.end()] = kind
    return out


class Codec:
    """Encode and decode texts."""

    _BASE = np.uint64(0xD6E8FEB86659FD93)
    _INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.by_category = pattern == CATEGORIES
        if not self.by_category:
            return
        self._category = categories()
        self._letter = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)
        self._power = self._unpower = np.ones(1, np.uint64)
        # What each token decodes to, and its decimals with a comma.
        size = self.vocabulary.span
        tokens = [self.vocabulary.tokens.get(i, b"") for i in range(size)]
        self._bytes, self._at, self._size = self._joined(tokens)
        self._digits, self._digits_at, self._digits_size = self._joined([b"%d," % i for i in range(size)])
        self._tokens, self._pairs = Table(), Table()
        real = np.flatnonzero(self._size)
        hashes = self._hashes(self._bytes)
        self._tokens.put(self._span(hashes, self._at[real], self._at[real] + self._size[real]), real.astype(np.int32))

    @staticmethod
    def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Sums of a polynomial over the bytes before each place."""
        n = len(data)
        if len(self._power) < n + 1:
            steps = np.full(n + 1, self._BASE)
            steps[0] = 1
            self._power = np.cumprod(steps)
            steps[1:] = self._INVERSE
            self._unpower = np.cumprod(steps)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._letter[data] * self._power[:n])])

    def _span(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of the bytes from start to end, wherever they stand."""
        return (hashes[end] - hashes[start]) * self._unpower[start]

    def _valid(self, before: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Whether these neighbours are valid; before is the span if the token starts its piece."""
        v = self.vocabulary
        key = before.astype(np.uint64) * np.uint64(v.span + 1) + rank.astype(np.uint64)
        found = self._pairs.get(key)
        unknown = found < 0
        if unknown.any():
            new = np.unique(key[unknown])
            if self._pairs.size + len(new) > PAIRS:
                self._pairs = Table()
                new, unknown = np.unique(key), np.ones(len(key), bool)
            ok = [v.alone(v.tokens[r]) if b == v.span else v.valid(b, r) for b, r in (divmod(k, v.span + 1) for k in new.tolist())]
            self._pairs.put(new, np.array(ok, np.int32))
            found[unknown] = self._pairs.get(key[unknown])
        return found > 0

    def _prefixes(self, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each piece, all their ids) of pieces ordered by falling size: the last token of every prefix, and
        back from the whole piece."""
        most = int(size[0])
        last, begin = np.empty((most + 1, len(size)), np.int32), np.empty((most + 1, len(size)), np.uint8)
        for k in range(1, most + 1):
            left = np.arange(np.searchsorted(-size, -k, "right"))
            for n in range(1, k + 1):
                end = start[left] + k
                rank = self._tokens.get(self._span(hashes, end - n, end))
                at = np.flatnonzero(rank >= 0)
                piece, rank = left[at], rank[at]
                ok = self._valid(last[k - n, piece] if n < k else np.full(len(piece), self.vocabulary.span), rank)
                last[k, piece[ok]], begin[k, piece[ok]] = rank[ok], k - n
                keep = np.ones(len(left), bool)
                keep[at[ok]] = False
                left = left[keep]
                if not len(left):
                    break
            else:
                raise ValueError("a byte isn't in the vocabulary")
        steps, at, left = [], size.copy(), np.arange(len(size))
        count = np.zeros(len(size), np.int64)
        while len(left):
            steps.append((left, last[at[left], left]))
            count[left] += 1
            at[left] = begin[at[left], left]
            left = left[at[left] > 0]
        ends = np.cumsum(count)
        ids = np.empty(ends[-1], np.int32)
        for i, (piece, rank) in enumerate(steps):
            ids[ends[piece] - 1 - i] = rank
        return count, ids

    def _distinct(self, data: bytes, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each piece's ids start, how many there are, the ids)."""
        order = np.argsort(-size, kind="stable")
        whole = self._tokens.get(self._span(hashes, start, start + size))
        at, count, flat, held = np.zeros(len(size), np.int64), np.ones(len(size), np.int64), [], 0

        def add(pieces: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
            nonlocal held
            at[pieces], count[pieces] = held + np.cumsum(counts) - counts, counts
            flat.append(ids)
            held += len(ids)

        known = np.flatnonzero(whole >= 0)
        add(known, np.ones(len(known), np.int64), whole[known].astype(np.int32))
        order = order[whole[order] < 0]
        long = order[size[order] > LONG]
        for i in long.tolist():
            ids = PieceEncoder(self.vocabulary, data[start[i] : start[i] + size[i]]).ids()
            add(np.array([i]), np.array([len(ids)]), np.array(ids, np.int32))
        order = order[len(long) :]
        if len(order):
            add(order, *self._prefixes(hashes, start[order], size[order]))
        return at, count, np.concatenate(flat)

    def _starts(self, chars: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The characters at which pieces start; first marks those that start a text."""
        kind = self._category[chars]
        run = first.copy()
        run[1:] |= kind[1:] != kind[:-1]
        white = kind == 3
        start = run.copy()
        # One space goes with what follows it; of more white space, the last character stands apart.
        start[1:] &= white[1:] | first[1:] | (chars[:-1] != 32)
        start[:-1] |= white[:-1] & run[1:] & ~first[1:]
        at = np.flatnonzero((chars == 39) & start)
        at = at[at + 1 < len(chars)]
        at = at[(kind[at + 1] == 1) & ~first[at + 1]]
        one = np.isin(chars[at + 1], [ord(c) for c in "stmd"])
        third = np.minimum(at + 2, len(chars) - 1)
        pair = chars[at + 1].astype(np.int64) << 32 | chars[third]
        two = ~one & np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]) & (third == at + 2) & ~first[third]
        start[at[one | two] + 1] = False
        after = np.concatenate([at[one] + 2, at[two] + 3])
        after = after[after < len(chars)]
        after = after[(kind[after] == 1) & ~first[after]]
        start[after] = True
        return np.flatnonzero(start)

    def encode(self, text: str) -> list[int]:
        """Piece by piece: each is an edit of the one before it in order of bytes."""
        pieces, ranks, known, encoder = self.split(text), self.vocabulary.ranks, {}, PieceEncoder(self.vocabulary)
        for data in sorted({p.encode() for p in pieces}):
            whole = ranks.get(data)
            if whole is None:
                encoder.become(data)
            known[data] = [whole] if whole is not None else encoder.ids()
        return [i for p in pieces for i in known[p.encode()]]

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.vocabulary.tokens
        return b"".join([tokens[i] for i in ids])

    def slab(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
        """(ids of all texts, where each text's ids end, the bytes that the ids decode to)."""
        data = b"".join(texts)
        if self.by_category and data:
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            chars = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
            width = 1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)
            byte = np.cumsum(width) - width
            first = np.zeros(len(chars), bool)
            begin = np.cumsum(size) - size
            first[np.searchsorted(byte, begin[size > 0])] = True
            start = byte[self._starts(chars, first)]
            piece = np.diff(start, append=len(data))
            raw = np.frombuffer(data, np.uint8)
            hashes = self._hashes(raw)
            _, one, which = np.unique(self._span(hashes, start, start + piece), return_index=True, return_inverse=True)
            at, count, flat = self._distinct(data, hashes, start[one], piece[one])
            ids = ragged(flat, at, count, which)
            back = ragged(self._bytes, self._at, self._size, ids)
            if len(back) == len(raw) and (back == raw).all():
                upto = np.concatenate([[0], np.cumsum(count[which])])
                return ids, upto[np.searchsorted(start, begin + size)], back.tobytes()
        every = [self.encode(t.decode()) for t in texts]
        ids = np.array([i for x in every for i in x], np.int32)
        return ids, np.cumsum([len(x) for x in every], dtype=np.int64), self.decode(ids.tolist())

    def decimals(self, ids: np.ndarray) -> bytes:
        """Each id in decimals with a comma behind."""
        if not self.by_category:
            return b"".join([b"%d," % i for i in ids.tolist()])
        return ragged(self._digits, self._digits_at, self._digits_size, ids).tobytes()

    def widths(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each id in decimals()."""
        return self._digits_size[ids] if self.by_category else np.array([len(str(i)) + 1 for i in ids.tolist()], np.int64)

    def parts(self, text: bytes) -> Iterator[bytes]:
        """A text in parts of about SLAB bytes that are encoded by themselves, each but the first from a space that
        stands alone between ASCII characters."""
        at = 0
        while self.by_category and len(text) - at > SLAB:
            m = _ALONE.search(text, at + SLAB)
            if not m:
                break
            yield text[at : m.start() + 1]
            at = m.start() + 1
        yield text[at:] if at else text

    def slabs(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
        """(how many texts, and what slab() gives for them); 0 texts: a part of the next one, of which the last part
        counts as one text."""
        at = 0
        while at < len(texts):
            if len(texts[at]) > SLAB:
                held = None
                for part in self.parts(texts[at]):
                    if held is not None:
                        yield 0, *self.slab([held])
                    held = part
                yield 1, *self.slab([held])
                at += 1
                continue
            end, size = at, 0
            while end < len(texts) and size + len(texts[end]) <= SLAB:
                size += len(texts[end])
                end += 1
            yield end - at, *self.slab(texts[at:end])
            at = end


#: A visible ASCII character, a space and another one.
_ALONE = re.compile(rb"[!-~] (?=[!-~])")


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _codec(path: str, pattern: str, made: dict[tuple[str, str], Codec] = {}) -> Codec:  # noqa: B006
    """One codec for each worker process."""
    if (path, pattern) not in made:
        made[path, pattern] = Codec(load_ranks(path), pattern)
    return made[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = False) -> DataFrame:
    """docs with the column ids, array<int>: the encoding of each whole text; a null or empty text has no ids.

    All other columns stay, nulls and repeated rows too; a column that is already named ids is replaced; an empty table
    gives no rows. `path` has to be readable on every executor. With verify the ids are decoded again, and a text that
    they don't give back is an error.
    """
    rest = docs.drop("ids")
    at = rest.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            texts = _texts(batch.column(at))
            every, ends, held, size, seen = [], [0], 0, 0, 0
            for n, ids, upto, back in codec.slabs(texts):
                if verify:
                    # Parts of a text come one by one, several texts together.
                    want = b"".join(texts[held : held + n]) if n and not seen else texts[held][seen : seen + len(back)]
                    if back != want:
                        raise ValueError("a text's ids don't decode to it")
                seen = 0 if n else seen + len(back)
                held += n
                every.append(ids)
                ends += (size + upto).tolist() if n else []
                size += len(ids)
            flat = pa.array(np.concatenate(every) if every else [], pa.int32())
            cols = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "ids"])

    return rest.mapInArrow(lean(run), StructType([*rest.schema.fields, StructField("ids", ArrayType(IntegerType()))]))


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, data): the bytes of each id sequence; null ids count as none. Repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(x.as_py() or []) for x in batch.column(1)], pa.binary())], [id_col, "data"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, data binary")


def digest_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids are decoded, and both are hashed.

    A null text counts as empty: no tokens, and the hashes of nothing. Rows that repeat and null ids stay, a row each;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            rows, ids_hash, out_hash, tokens = [], hashlib.sha256(), hashlib.sha256(), 0
            texts = _texts(batch.column(1))
            for n, ids, upto, back in codec.slabs(texts):
                said = memoryview(codec.decimals(ids))
                size = np.fromiter(map(len, texts[len(rows) : len(rows) + n]), np.int64, n)
                if n == 1 or not n:  # perhaps a part of a text
                    upto, size = np.array([len(ids)]), np.array([len(back)])
                cut = np.concatenate([[0], np.cumsum(codec.widths(ids))])[upto].tolist()
                a = b = before = 0
                for end, c, length in zip(upto.tolist(), cut, size.tolist(), strict=True):
                    # No comma behind the last id of a text.
                    if c > a:
                        ids_hash.update(b"," if tokens else b"")
                        ids_hash.update(said[a : c - 1])
                    tokens += end - before
                    out_hash.update(memoryview(back)[b : b + length])
                    a, b, before = c, b + length, end
                    if n:
                        rows.append((tokens, ids_hash.hexdigest(), out_hash.hexdigest()))
                        ids_hash, out_hash, tokens = hashlib.sha256(), hashlib.sha256(), 0
            cols = [batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string())))]
            yield pa.RecordBatch.from_arrays(cols, [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lean(run), f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
