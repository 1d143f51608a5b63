"""Exact and near duplicates against brute force, with nulls, repeats, clashing columns and empty tables."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from skein.llm import exact, paragraphs, simhash
from skein.llm.common import lean
from skein.llm.graph import components
from skein.llm.paragraphs import links_in, repeated_paragraphs, shingle_set, similarity, without_repeats

SCHEMA = "doc_id bigint, text string, id string, keep string, h1 int, fp int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA)


def test_fingerprints_compose():
    rng = random.Random(1)
    for n in (0, 1, 5, exact.CHUNK - 1, exact.CHUNK, exact.CHUNK + 1, 3 * exact.CHUNK + 7):
        data = rng.randbytes(n)
        for k in (0, n // 3, n):
            for base, whole in zip(exact.BASES, exact.fingerprint(data), strict=True):
                left, right = data[:k], data[k:]
                i = exact.BASES.index(base)
                assert exact.combine(exact.fingerprint(left)[i], exact.fingerprint(right)[i], len(right), base) == whole
    assert exact.fingerprint(b"\0") != exact.fingerprint(b"\0\0")


def test_exact_duplicates(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, None), (7, ""), (4, "a b "), (None, "a b"), (6, "A b"), (3, "a\tb"), (8, "x" * 50 + "\n\n" + "y" * 50), (2, "x" * 50 + " " + "y" * 50)]
    for huge in (exact.HUGE, 16):
        every = exact.exact_duplicates(docs(spark, rows), huge=huge).collect()
        got = {(r["doc_id"], r["text_sha256"]): r for r in every}
        assert len(every) == len(rows)
        sha = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
        groups = {}
        for i, t in rows:
            groups.setdefault(sha(t), []).append(i)
        assert set(got) == {(i, sha(t)) for i, t in rows}
        for (i, s), r in got.items():
            first = min(groups[s], key=lambda x: (x is not None, x))
            assert (r["keep_id"], r["group_size"], r["kept"]) == (first, len(groups[s]), i == first)
    assert exact.exact_duplicates(docs(spark, [])).count() == 0


def test_equal_fingerprints_of_unequal_texts(spark):
    rows = [(i, f"text {i % 3}") for i in range(12)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.exact_duplicates(docs(spark, rows), key=F.lit(1)).collect()}
    assert got == {i: (i % 3, 4) for i in range(12)}


def test_large_groups_are_spread(spark, monkeypatch):
    monkeypatch.setattr(exact, "SPREAD", 3)
    rows = [(i, f"text {i % 2} " + "x" * (exact.PIECE + 5)) for i in range(40)]
    for key in (None, F.lit(1)):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.exact_duplicates(docs(spark, rows), key=key).collect()}
        assert got == {i: (i % 2, 20) for i in range(40)}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark):
    rng = random.Random(4)
    base = [rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(300)]
    rows = [(i, " ".join(base[: 300 - i])) for i in range(8)] + [(20, None), (11, ""), (12, " \n"), (13, "one"), (14, "É é É"), (None, "one"), (13, "one")]
    rows += [(100 + i, " ".join(rng.choice("qrstuv") for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    want = {i: brute_fingerprint(t) for i, t in rows}
    assert len(got) == len(rows) and all(r["fingerprint"] == f"{want[r['doc_id']]:016x}" for r in got)
    nodes = sorted(set(want.values()))
    label = {x: x for x in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for i, f in want.items():
        if i is not None:
            least[label[f]] = min(least.get(label[f], i), i)
    assert all(r["component_id"] == least[label[want[r["doc_id"]]]] for r in got)
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_links_lose_nothing():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a[100:200] = a[:100] ^ (np.uint64(1) << rng.integers(0, 63, 100).astype(np.uint64))
    a = np.unique(a)

    def groups(pairs):
        up = {}

        def find(x):
            while up.setdefault(x, x) != x:
                x = up[x]
            return x

        for x, y in pairs:
            up[max(find(x), find(y))] = min(find(x), find(y))
        return {x: find(x) for x in list(up)}

    every = [(int(x), int(y)) for x in a for y in a if x < y and (int(x) ^ int(y)).bit_count() <= 4]
    u, v = simhash.links_between(a, None)
    assert groups(every) == groups(zip(u.tolist(), v.tolist(), strict=True))
    assert len(u) < len(a)
    across = [(x, y) for x, y in [(int(x), int(y)) for x in a[:150] for y in a[150:]] if (x ^ y).bit_count() <= 4]
    u, v = simhash.links_between(a[:150], a[150:])
    assert groups(across) == groups(zip(u.tolist(), v.tolist(), strict=True))


def test_small_tiles(spark):
    rng = np.random.default_rng(6)
    fps = rng.integers(-(1 << 62), 1 << 62, 200)
    near = fps[:50] ^ 3
    df = spark.createDataFrame([(int(x),) for x in np.unique(np.concatenate([fps, near]))], "fp bigint")
    got = {frozenset(map(int, r)) for r in simhash.links(df, tile=4).collect()}
    assert {frozenset((int(x), int(x ^ 3))) for x in fps[:50]} <= got


def test_repeated_paragraphs(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    p = [word() for _ in range(80)]
    edited = p[:40] + ["other"] + p[41:]
    own = " ".join(word() for _ in range(60))
    rows = [(1, "head\n" + " ".join(p)), (2, " ".join(edited) + "\ntail"), (3, own + "\n" + own), (4, None), (5, ""), (6, " ".join(p[:30])), (None, " ".join(p).upper())]
    got = {(r["doc_id"], r["paragraph"]): r for r in repeated_paragraphs(docs(spark, rows)).collect()}
    assert set(got) == {(1, 1), (2, 0), (None, 0)}
    assert all((r["kind"], r["component_id"], r["members"]) == ("paragraph", None, 3) for r in got.values())
    assert [r["removed"] for k, r in got.items() if k[0] is None] == [False] and got[1, 1]["start"] == 5
    kept = {r["doc_id"]: r["text"] for r in without_repeats(docs(spark, rows)).collect()}
    assert kept[1] == "head" and kept[2] == "tail" and kept[3] == own + "\n" + own and kept[4] is None
    assert repeated_paragraphs(docs(spark, [])).count() == 0


def test_repeats_over_lines_and_inside_longer_ones(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    some = lambda n: [word() for _ in range(n)]
    p, q, r = some(60), some(50), some(49)
    rows = [(1, " ".join(some(150) + p + some(150))), (2, " ".join(some(90)) + "\n" + "\n".join(" ".join(p[i : i + 15]) for i in range(0, 60, 15)) + "\nö end")]
    rows += [(3, "é " + " ".join(q).upper()[:-1] + q[-1][-1] + " " + " ".join(some(200))), (4, " ".join(some(200)) + " " + "\t".join(q)), (None, " ".join(p[:55]) + "\nx")]
    rows += [(5, " ".join(some(60) + r)), (6, " ".join(r + some(60))), (7, " ".join(q[:25] + some(1) + q[25:] + some(100)))]
    rows += [(10 + i, "\n".join(" ".join(rng.choice("ab") for _ in range(9)) for _ in range(40))) for i in range(12)]
    got = repeated_paragraphs(docs(spark, rows)).collect()
    runs = {}
    for i, t in rows:
        w = t.lower().split()
        for k in range(len(w) - 49):
            runs.setdefault(tuple(w[k : k + 50]), []).append((i, k))
    want = {i for places in runs.values() if len({i for i, _ in places}) > 1 for i, _ in places}
    assert {x["doc_id"] for x in got} == want and {1, 2, 3, 4, None} == {i for i in want if i is None or i < 10}
    texts = dict(rows)
    said = lambda x: texts[x["doc_id"]][x["start"] : x["start"] + x["n_chars"]].lower().split()
    by = {(x["doc_id"], len(said(x))): x for x in got}
    assert said(by[2, 60 - 5]) == said(by[None, 55]) == p[:55] and said(by[3, 50]) == said(by[4, 50]) == q
    assert [by[k]["removed"] for k in ((None, 55), (2, 55), (3, 50), (4, 50))] == [False, True, False, True]
    kept = {x["doc_id"]: x["text"] for x in without_repeats(docs(spark, rows)).collect()}
    assert kept[None] == texts[None] and kept[3] == texts[3] and kept[2] == rows[1][1].split("\n")[0] + "\nö end" and kept[4].strip() == " ".join(texts[4].split()[:200])


@pytest.mark.parametrize("chunk", [1 << 23, 40])
def test_stretches_against_all_runs(spark, monkeypatch, chunk):
    """One word a line, so that there are no paragraphs: the stretches cover exactly the runs that stand in another text."""
    monkeypatch.setattr(paragraphs, "CHUNK", chunk)
    rng = random.Random(11)
    some = lambda n, of="abcdefghijklmnopqrstuvwxyz": [rng.choice(of) + rng.choice(of) for _ in range(n)]
    passages = [some(n) for n in (6, 7, 9, 15, 30, 5)]
    lists = []
    for _ in range(60):
        words = some(rng.randrange(0, 30))
        for _ in range(rng.randrange(0, 4)):
            words += rng.choice(passages)[rng.randrange(0, 3) :] + some(rng.randrange(0, 8))
        lists.append(words)
    lists += [some(200, "ab") for _ in range(4)] + [lists[3], lists[5], lists[5]]
    rows = [(i if i != 7 else None, "\n".join(w).upper() if i % 5 == 1 else "\n".join(w)) for i, w in enumerate(lists)]
    got = repeated_paragraphs(docs(spark, rows), min_words=6).collect()
    texts, runs = dict(rows), {}
    for i, t in rows:
        w = t.lower().split()
        for k in range(len(w) - 5):
            runs.setdefault(tuple(w[k : k + 6]), set()).add(t)
    for i, t in rows:
        w, covered = t.lower().split(), set()
        want = {k for k in range(len(w) - 5) if len(runs[tuple(w[k : k + 6])]) > 1}
        starts = [m.start() for m in re.finditer(r"\S+", t)]
        for r in got:
            if r["doc_id"] == i and r["kind"] == "stretch":
                n = len(texts[i][r["start"] : r["start"] + r["n_chars"]].split())
                covered |= set(range(starts.index(r["start"]), starts.index(r["start"]) + n - 5))
        first = min((j for j, u in rows if u == t), key=lambda j: (j is not None, j))
        assert covered == (want if i == first else set()), i
    whole = {r["doc_id"] for r in got if r["kind"] == "text"}
    assert whole == {i for i, t in rows if sum(u == t for _, u in rows) > 1 and len(t.split()) >= 6}
    # What stays of all texts has each repeated run once.
    kept = [r["text"].lower().split() for r in without_repeats(docs(spark, rows), min_words=6).collect()]
    left = [tuple(w[k : k + 6]) for w in kept for k in range(len(w) - 5)]
    assert all(left.count(x) <= 1 or x not in runs or len(runs[x]) < 2 or set("".join(x)) <= set("ab") for x in left)


def test_links_over_tiles(spark, monkeypatch):
    """Near copies in one bucket of several tiles are all linked."""
    monkeypatch.setattr(paragraphs, "TILE", 4)
    rng = random.Random(12)
    base = [rng.choice("abcdefgh") * rng.randrange(1, 9) + str(i) for i in range(120)]
    rows = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :])) for i in range(40)] + [(100 + i, " ".join(rng.choice("qrst") + str(rng.random()) for _ in range(60))) for i in range(9)]
    got = [r for r in repeated_paragraphs(docs(spark, rows)).collect() if r["kind"] == "paragraph"]
    assert {r["doc_id"] for r in got} == set(range(40)) and all((r["component_id"], r["members"]) == (0, 40) for r in got)


def test_links_in_matches_all_pairs():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint32)) for _ in range(30)]
    names = [bytes([i]) for i in range(30)]
    for least in (0.3, 0.5):
        want = {(i, j) for i in range(30) for j in range(i) if similarity(sets[i], sets[j]) >= least}
        up = list(range(30))
        for _ in range(30):
            for i, j in want:
                up[i] = up[j] = min(up[i], up[j])
        got = list(range(30))
        for _ in range(30):
            for a, b in links_in(names, sets, least=least):
                got[a[0]] = got[b[0]] = min(got[a[0]], got[b[0]])
        assert up == got
    assert len(shingle_set(np.array([1, 2], np.uint64))) == 1


def test_fingerprints_take_little_memory():
    texts = [" ".join(f"w{i % 977}x{j % 89}" for j in range(2000)) for i in range(150)]  # 300,000 shingles
    batch = pa.RecordBatch.from_arrays([pa.array(range(150)), pa.array(texts)], ["id", "text"])
    tracemalloc.start()
    try:
        (out,) = simhash._fingerprints(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80e6
    for i in (0, 77, 149):
        assert out.column(1)[i].as_py() & (1 << 64) - 1 == simhash.fingerprint(texts[i].encode())


def test_workers_give_memory_back():
    def own() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(x.split()[1]) for x in f if x.startswith("Pss_Anon:")) // 1024

    held = []

    def run(batches):
        for batch in batches:
            texts = [b"%2000d" % i for i in range(100_000)]
            held.append(b"%2000d" % 1)  # above them, so that the heap can't shrink from its end
            yield batch
            del texts

    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["id"])
    before = own()
    assert list(lean(run)(iter([batch]))) == [batch]
    assert own() < before + 100
