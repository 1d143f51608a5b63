"""Licences, chats, languages, HTML, tokens and language model on small inputs against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from skein.llm import bpe, chat, decontaminate, html, langid, licences, pylm


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "z", 0.5) for i, t in rows], "doc_id bigint, text string, words string, score double")


LICENCED = [
    (1, "x. Licensed under the Apache License, Version 2.0. Apache license apache license"), (2, None), (3, ""), (4, "MIT license MIT License"), (5, "Licensed under CC BY-NC 4.0."),
    (6, "gnu-general_public LICENSE; the gnu general public license"), (7, "ALL RIGHTS RESERVED"), (8, "Émit license permitlicense"), (9, "... --- "), (None, "mit license"),
    (10, "This work is licensed under the GNU General Public License, version 3. " * 3), (11, "license " * 5000),
]


def test_licences(spark):
    got = {r["doc_id"]: r for r in licences.scan_licences(frame(spark, LICENCED)).collect()}
    for i, text in LICENCED:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        at, found = [], set()
        for phrase, label in licences.BASE.items():
            p = phrase.split()
            here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += here
            found |= {label} if here else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(found))), i
        assert 0 <= r["score"] <= 1
    assert got[1]["labels"] == "apache,apache-2.0" and got[5]["labels"] == "cc-by,cc-by-nc-4.0" and got[10]["labels"] == "gpl,gpl-3.0" and got[7]["labels"] == "proprietary"
    assert got[11]["labels"] == "" and got[11]["score"] == 0
    assert licences.scan_licences(frame(spark, [])).count() == 0


def test_licences_by_brute_force(spark):
    """Every alignment of every template, one by one, over edited, joined and repeated notices."""
    rng = random.Random(5)
    texts = [t for _, t, _ in licences.TEMPLATES]
    rows = [(1, " x ".join(texts)), (2, "redistribution and use in source and binary forms must retain"), (2, "redistribution and use in source and binary forms must retain"), (3, None), (None, texts[0]), (None, "none")]
    for i in range(60):
        words = " ".join(rng.choice(texts) for _ in range(rng.randrange(1, 4))).split()
        rows.append((100 + i % 50, " ".join(w if rng.random() > 0.12 else rng.choice(["x", "", rng.choice(words)]) for w in words)))
    weight = {(i, k): share for _, i, _, k, share, _ in licences.postings()}
    got = licences.scan_licences(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    want = []
    for i, text in rows:
        w, labels, scores = (text or "").split(), set(), [0.0]
        flat = f" {' '.join(w)} "
        for n, (label, template, keys) in enumerate(licences.TEMPLATES):
            t = template.split()
            best = max(sum(weight[n, k] for k in range(len(t)) if 0 <= at + k < len(w) and w[at + k] == t[k]) for at in range(-len(t), len(w) + 1))
            if best >= licences.LEAST - 1e-9 and all(f" {k} " in flat for k in keys):
                labels.add(label)
                scores.append(best)
        base = {label for phrase, label in licences.BASE.items() if f" {phrase} " in flat}
        want.append((str(i), ",".join(sorted(labels | base)), round(1.0 if base else min(1.0, max(scores)), 6)))
    assert sorted((str(r["doc_id"]), r["labels"], round(r["score"], 6)) for r in got) == sorted(want)
    assert {x for x in want[0][1].split(",")} >= {label for label, _, _ in licences.TEMPLATES}


def test_anchors():
    assert all(any(a in k.split() for k in keys for a in licences.anchors()) for _, _, keys in licences.TEMPLATES)


def test_licence_in_a_file_of_many_licence_words(spark):
    every = " ".join(sorted({w for _, t, _ in licences.TEMPLATES for w in t.split()} - {"gnu", "lesser", "general"}))
    named = {label: text for label, text, _ in licences.TEMPLATES}
    rows = [(i, f"{every} x {named[label]} y {every}") for i, label in enumerate(sorted(named))]
    got = {r["doc_id"]: r for r in licences.scan_licences(frame(spark, rows)).collect()}
    for i, label in enumerate(sorted(named)):
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1, label


def test_native_plans(spark, sf):
    from skein.llm.queries import op1_license_scan, op2_chat_format

    for q in (op1_license_scan, op2_chat_format):
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_chats(spark):
    hostile = ["a\\", "<|end|>\n", "<|sep|>", "\\<|", "|>", "<|>", "", "x\n\ny", "### Assistant: </turn>", "\\\\|", "<", "|", "é😀"]
    rng = random.Random(1)
    turns = [(c, t, rng.choice(["user", "assistant", "system", "<|x|>"]), rng.choice(hostile) + rng.choice(hostile)) for c in range(30) for t in range(rng.randrange(1, 9))]
    turns += [(50, 0, None, None), (50, None, "assistant", "first"), (51, 1, "assistant", "a"), (51, 1, "assistant", "a"), (None, 0, "user", "n")]
    df = spark.createDataFrame([(*t, "e") for t in turns], "conv_id bigint, turn int, role string, text string, no string")
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    convs = {}
    for c, t, role, text in sorted(turns, key=lambda x: (x[0] or -1, x[1] if x[1] is not None else -1, x[2] or "", x[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(convs)
    for c, ts in convs.items():
        said = "".join(f"{a}\n{b}\n" for a, b in ts)
        loss = "".join(b for a, b in ts if a == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(ts), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()), (c, ts)
    assert chat.format_conversations(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, 0, "user", "a\\<|é" * 400_000), (1, 1, "assistant", "b|>\n" * 300_000)], "conv_id int, turn int, role string, text string")
    (r,) = chat.digest(chat.format_conversations(long)).collect()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, 1_200_000, hashlib.sha256(("b|>\n" * 300_000).encode()).hexdigest())
    one = chat.format_conversations(df.where("conv_id = 51")).first()
    assert one["formatted"] == "<|assistant|>\na<|sep|>a<|end|>\n"


@pytest.fixture(scope="module")
def labelled(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")


def test_languages(spark, labelled):
    out = langid.language_of(labelled)
    rows = out.collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    model = langid.fit([(r["text"], r["lang"]) for r in labelled.collect()])
    odd = spark.createDataFrame([(1, None, 7), (2, "", 8), (3, "123 !! \n", 9), (4, "The of and the", 1)], "doc_id int, text string, lang_pred int")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en"
    assert langid.identify(odd.limit(0), model).count() == 0
    none = langid.fit([])
    assert {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}


def test_rare_label_is_learned(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.when(F.col("id").isin(5, 77, 4000), "rare").when(F.col("id") % 3 == 0, "b").otherwise("a").alias("lang"))
    got = [x for _, x in langid.learning_rows(df, "doc_id", "text", "lang", F.lit(True), 60)]
    assert got.count("rare") == 3 and len(got) <= 60 and 30 <= got.count("a") and 15 <= got.count("b")
    assert langid.learning_rows(df.limit(0), "doc_id", "text", "lang", F.lit(True)) == []


def test_code_switching(labelled):
    rows = labelled.collect()
    model = langid.fit([(r["text"], r["lang"]) for r in rows])
    pick = lambda lang: next(r["text"] for r in rows if r["lang"] == lang and len(r["text"]) > 600).replace("\n", " ")[:600]
    mass = model.label_mass([pick("de") + " " + pick("fr")])[0]
    share = dict(zip(model.labels, mass / mass.sum(), strict=True))
    assert share["de"] > 0.35 and share["fr"] > 0.35


def test_forward_backward_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    lengths = np.array([4, 3, 1])
    scores = rng.normal(size=(4, 3, 3))
    trans, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    marginal, pairs, log_z = langid.forward_backward(scores, lengths, trans, start)
    total = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        z, m, both = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for y in product(range(3), repeat=int(n)):
            p = math.exp(start[y[0]] + sum(scores[i, c, y[i]] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            z += p
            for i in range(n):
                m[i, y[i]] += p
                if i:
                    both[y[i - 1], y[i]] += p
        assert np.allclose(marginal[:n, c], m / z) and math.isclose(log_z[c], math.log(z))
        total += both / z
    assert np.allclose(pairs, total)


def test_decontamination(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    words = {i: decontaminate.words_of(t) for i, t in items.items()}
    all_docs = {r["doc_id"]: r["text"] for r in docs.collect()}
    planted, plain = {}, [i for i in all_docs if i % 7 == 3]
    rng = random.Random(3)
    for k, i in enumerate(plain):
        item = k % len(items)
        w = items[item].split()
        if k % 3 == 1:
            w = [x.upper() for x in w]
        if k % 3 == 2 and len(w) > 12:
            w[rng.randrange(len(w))] = "changed"
        planted[10_000 + i] = (f"{all_docs[i]} {' '.join(w)} {all_docs[(i + 1) % len(all_docs)]}", item)
    extra = spark.createDataFrame([(i, t) for i, (t, _) in planted.items()] + [(20_000, None), (20_001, "")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs.unionByName(extra).withColumn("share", F.lit(1)), bench.withColumn("at", F.lit("x"))).collect()}
    exact = lambda text: {k for k, w in words.items() if b" " + b" ".join(w) + b" " in b" " + b" ".join(decontaminate.words_of(text or "")) + b" "}
    want = {(i, k) for i, t in all_docs.items() for k in exact(t)} | {(i, k) for i, (t, item) in planted.items() for k in exact(t) | {item}}
    assert got == want
    empty = spark.createDataFrame([(1, None), (2, "")], "item_id bigint, text string")
    assert decontaminate.contaminated(docs, empty).count() == decontaminate.contaminated(docs.limit(0), bench).count() == decontaminate.contaminated(docs, empty.limit(0)).count() == 0


def test_leak_in_a_third_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = bench.orderBy("item_id").first()
    rng = random.Random(4)
    rows, want = [], set()
    for k, r in enumerate(docs):
        text = r["text"]
        if k % 3 == 0:
            w = item["text"].split()
            w[rng.randrange(len(w))] = f"changed{k}"
            text = f"{text} {' '.join(w)} and the rest"
            want.add(r["doc_id"])
        rows.append((r["doc_id"], text))
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).where(F.col("item_id") == item["item_id"]).collect()
    whole = b" ".join(decontaminate.words_of(item["text"]))
    assert {r["doc_id"] for r in got} == want | {i for i, t in rows if whole in b" ".join(decontaminate.words_of(t or ""))}


def test_paraphrases_with_the_answer(spark, sf):
    docs = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = bench.orderBy("item_id").collect()
    others = sorted({x.decode() for r in items for x in decontaminate.words_of(r["text"])})
    rng = random.Random(6)
    rows, want = [], set()
    for k in range(160):
        item = items[k % len(items)]
        w = [x.decode() for x in decontaminate.words_of(item["text"])]
        tail = len(decontaminate.words_of([x for x in re.split(r"[.!?\n]+", item["text"]) if decontaminate.words_of(x)][-1]))
        # every third word or so, none of the answer; 0.6 of the words and the answer stay
        for i in rng.sample(range(len(w) - tail), min(len(w) - tail, int(0.38 * len(w)))):
            w[i] = rng.choice(others)
        rows.append((k, f"{docs[k % len(docs)]} {' '.join(w)} {docs[(k + 1) % len(docs)]}"))
        want.add((k, item["item_id"]))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert want <= got


def test_common_subsequence():
    def plain(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(5)
    number = {bytes([97 + i]): i + 1 for i in range(6)}
    for _ in range(200):
        a, b = ([rng.randrange(1, 7) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        item = decontaminate.Item(0, " ".join(chr(96 + x) for x in a), number)
        assert item.common(b) == plain(a, b)


PAGE = """<html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body><header>Site</header><nav><a href="/">menu</a></nav>
<div class="content-{n}"><h1>T &amp; U</h1><p>Hello <b>big</b>
 world&nbsp;x.<p>Second, with more text here.<ul><li>one<li>two</ul><div class="ad">buy</div></div>
<div id="comments"><p>a comment, that is long. and long. and long enough to win, by far, alone.</p></div><aside>side</aside><footer>&copy;</footer></body></html>"""


def test_html(spark):
    pages = [(i, f"http://h.example:80/{i}", PAGE.replace("{n}", str(i))) for i in range(4)] + [(10, None, None), (11, "no url", ""), (12, "http://h.example/x", "<p>loose &lt;text&gt; a</p"), (12, "http://h.example/x", "<p>loose &lt;text&gt; a</p")]
    df = spark.createDataFrame([(*p, "h") for p in pages], "page_id bigint, url string, html string, host string")
    got = html.main_text(df).collect()
    assert len(got) == len(pages)
    by = {r["page_id"]: r for r in got}
    assert by[0]["text"] == "T & U\nHello big world x.\nSecond, with more text here.\none\ntwo"
    assert all(by[i]["text"] == by[0]["text"] and by[i]["container"] == "html/body/div.content-#" for i in range(4))
    assert by[10]["text"] == "" and by[10]["n_chars"] == 0 and by[11]["text"] == "" and by[12]["text"].startswith("loose <text> a")
    assert html.main_text(df.limit(0)).count() == 0


def test_whole_articles(spark):
    long = "Some words of an article, and some more of them. " * 8
    page = lambda inside: f"<html><body><div class=menu><a href=/>menu</a></div>{inside}<div id=comments><p>{'talk, talk. ' * 90}</div></body></html>"
    beside = page(f"<article><h1>Head</h1><p>Lead.</p><div class=body><p>{long}</p></div></article>")
    plain = page(f"<div class=post><h1>Head</h1><div class=body><p>{long}</p></div></div>")
    sections = page(f"<div class=text><div class=first><p>{long}{long}</p></div><div class=second><p>{long}</p></div></div>")
    wrapper = page(f"<div class='page with sidebar'><h1>Head</h1><div class=sidebar><p>side</p></div><div class=body><p>{long}</p></div></div>")
    other = page(f"<div class=intro><p>Small, small. block.</p></div><div class=story><p>{long}</p></div>")
    rows = [(1, beside), (2, plain), (3, sections), (4, wrapper)]
    df = [(i, f"http://h{i}.example/", h) for i, h in rows] + [(10 + k, "http://many.example/", page(f"<div class=intro><p>{long}</p></div>")) for k in range(5)] + [(20, "http://many.example/x", other)]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(df, "page_id int, url string, html string")).collect()}
    text = long.strip()
    assert got[1] == f"Head\nLead.\n{text}" and got[2] == got[4] == f"Head\n{text}"
    assert got[3] == f"{(long + long).strip()}\n{text}" and got[20] == text and got[10] == text


def test_pages_by_brute_force(spark, sf):
    """The query against votes and choices made page after page."""
    from collections import Counter

    from skein.llm.queries import op5_html_text

    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    host = lambda url: url.split("/")[2].lower()
    votes = {}
    for p in pages:
        path = html.best(html.container_scores(html.blocks(p["html"] or "")))
        if path is not None:
            votes.setdefault(host(p["url"]), Counter())[path] += 1
    want = {}
    for p in pages:
        found, paths = html.blocks(p["html"] or ""), votes.get(host(p["url"]), {})
        own = html.chosen(found, [x for x in sorted(paths, key=lambda x: (-paths[x], x)) if paths[x] > 1])
        want[p["page_id"]] = "\n".join(t for path, t, _ in found if own is not None and html.within(path, own))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op5_html_text(spark, sf).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}


def test_odd_markup():
    import time

    long = "Words of the article, and more of them. " * 9
    own = lambda h: [t for _, t, _ in html.blocks(h)]
    assert own(f"<article><header><h1>Head</h1><nav>menu</nav></header><p>{long}</p></article>") == ["Head", long.strip()]
    assert own(f"<header><h1>Site</h1></header><div class='related-work'><p>{long}</p></div><div class='related posts-list'>r</div><div id=notice-period>n</div>") == [long.strip(), "n"]
    assert own('<p title="a>b">x</p><p class=\'c>d\'>y < z</p>') == ["x", "y < z"]
    for piece in ('<a title="x ', "<a <b ", "<p class='", "<a<a", "<script "):
        began = time.time()
        html.blocks(f"<p>text</p>{piece * 90_000}")
        assert time.time() - began < 5


def test_many_hosts(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"http://h{i % 3}/{i}", PAGE) for i in range(12)], "page_id int, url string, html string")
    few = sorted(map(tuple, html.main_text(df).collect()))
    monkeypatch.setattr(html, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, html.main_text(df).collect())) == few


PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def test_tokens_as_the_library(codec, library):
    rng = random.Random(1)
    for _ in range(2000):
        s = "".join(rng.choice(" aabcdetheing eéüß\n\t!?#'s漢字😀0123  ") for _ in range(rng.randint(0, 70)))
        want = library.encode_ordinary(s)
        assert codec.encode(s) == want
        ids, ends, back = codec.slab([s.encode()])
        assert (ids.tolist(), ends.tolist(), back) == (want, [len(want)], s.encode())


def test_slabs(codec, library, monkeypatch):
    """Texts longer than a slab are cut, long pieces stand apart, and what is remembered goes after a while."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(" ab the ing\né!  's0'") for _ in range(rng.choice((0, 3, 40, 900)))) for _ in range(200)] + ["word " * 300, " " * 400, "x" * 500, "don't we'll'd 're'x 'Ve \n's''s"]
    monkeypatch.setattr(bpe, "SLAB", 64)
    monkeypatch.setattr(bpe, "PAIRS", 50)
    got, held = [], []
    for n, ids, ends, back in codec.slabs([t.encode() for t in texts]):
        if not n:
            held += ids.tolist()
            continue
        for a, b in zip([0, *ends], ends, strict=False):
            got.append(held + ids[a:b].tolist())
            held = []
    assert got == [library.encode_ordinary(t) for t in texts]
    other = bpe.Codec(codec.vocabulary.ranks, r"\S+|\s+")
    ids, ends, back = other.slab([b"ab  c", b""])
    assert not other.by_category and back == b"ab  c" and ends.tolist() == [len(ids)] * 2 and other.decimals(ids) == b"".join(b"%d," % i for i in ids)


def test_a_hash_that_misleads(codec, library, monkeypatch):
    """Pieces of equal hashes are found by what the ids decode to."""
    own, called = codec._span, []

    def alike(hashes, start, end):
        called.append(len(start))
        return np.full(len(start), own(hashes, start, end)[0]) if len(called) == 1 else own(hashes, start, end)

    monkeypatch.setattr(codec, "_span", alike)
    ids, _, back = codec.slab([b"two words"])
    assert ids.tolist() == library.encode_ordinary("two words") and back == b"two words"


def test_table_of_keys():
    rng = np.random.default_rng(4)
    table, known = bpe.Table(3), {}
    for _ in range(20):
        keys = np.unique(rng.integers(0, 500, 40).astype(np.uint64))
        keys = keys[table.get(keys) < 0]
        table.put(keys, (keys % 7).astype(np.int32))
        known |= {int(k): int(k) % 7 for k in keys}
        assert table.get(np.arange(500, dtype=np.uint64)).tolist() == [known.get(k, -1) for k in range(500)]


def test_append_and_edit(codec):
    rng = random.Random(2)
    for _ in range(300):
        a, b = (bytes(rng.choice(b"thein gaco") for _ in range(rng.randrange(1, 20))) for _ in range(2))
        whole = bpe.PieceEncoder(codec.vocabulary, a + b)
        grown = bpe.PieceEncoder(codec.vocabulary, a)
        grown.append(b)
        assert grown.last == whole.last and [codec.vocabulary.tokens[i] for i in grown.ids()] == codec.vocabulary.merge(a + b)
        grown.edit(1, 3, b"xy")
        assert grown.ids() == bpe.PieceEncoder(codec.vocabulary, (a + b)[:1] + b"xy" + (a + b)[3:]).ids()


def test_encode_and_decode_tables(spark, library):
    rows = [(1, None), (2, ""), (3, "The the  the\n\n x"), (3, "The the  the\n\n x"), (None, "word " * 30_000)]
    df = frame(spark, rows).withColumn("ids", F.lit("mine"))
    out = bpe.encode_texts(df, PATH, public_tokenizers.PATTERN)
    assert set(out.columns) == {"doc_id", "text", "words", "score", "ids"} and out.count() == 5
    got = {r["doc_id"]: r["ids"] for r in out.collect()}
    assert got[1] == got[2] == [] and got[3] == library.encode_ordinary(rows[2][1])
    back = {r["doc_id"]: bytes(r["data"]).decode() for r in bpe.decode_ids(out, PATH, public_tokenizers.PATTERN).collect()}
    assert back == {i: t or "" for i, t in rows}
    dig = {r["doc_id"]: r for r in bpe.digest_texts(df, PATH, public_tokenizers.PATTERN).collect()}
    assert dig[1]["n_tokens"] == 0 and dig[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest() and dig[None]["n_tokens"] == len(got[None])
    assert bpe.digest_texts(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    for verify in (False, True):
        assert bpe.encode_texts(df, PATH, public_tokenizers.PATTERN, verify=verify).where("size(ids) > 0").count() == 3
    texts = [(i, "a bé 's \n" * i) for i in range(40)] + [(99, "long text, cut " * 400_000)]
    dig = {r["doc_id"]: r for r in bpe.digest_texts(frame(spark, texts), PATH, public_tokenizers.PATTERN).collect()}
    for i, t in texts:
        ids = library.encode_ordinary(t)
        assert dig[i]["n_tokens"] == len(ids) and dig[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and dig[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert [len(r["ids"]) for r in bpe.encode_texts(frame(spark, texts), PATH, public_tokenizers.PATTERN, verify=True).orderBy("doc_id").select("ids").collect()] == [dig[i]["n_tokens"] for i, _ in texts]


def test_stirling():
    for d in (0.0, 0.5):
        s = np.exp(pylm.log_stirling(d, 8))
        for c in range(1, 8):
            for t in range(1, c + 2):
                assert math.isclose(s[c + 1, t], s[c, t - 1] + max(0, c - t * d) * s[c, t], rel_tol=1e-9)


def some_words(seed, words=20, common=3):
    """Seated words of two classes with frequent words among contexts and words, and totals that add up."""
    rng = np.random.default_rng(seed)
    hashes = np.sort(rng.integers(1, 1 << 62, common).astype(np.uint64))
    contexts = pylm.Contexts(hashes, np.array([257, 257, 513])[:common], np.zeros(common, np.int64))
    ids = np.concatenate([contexts.of_class[[0, 257, 258, 513]], contexts.of_word])
    key = np.unique(rng.integers(0, words, 80) * contexts.size + rng.choice(ids, 80))
    places = np.full(words, -1)
    places[:common] = np.arange(common)
    return pylm.Words(key // contexts.size, key % contexts.size, rng.integers(1, 200, len(key)), places, contexts), ids, rng


def totals_of(w, size, rng, before=None):
    totals = pylm.Totals(w.kind.size, len(w.kind.frequent))
    if before is not None:
        totals.t0, totals.d, totals.s = before.t0, before.d, before.s
    w.add_to(totals)
    totals.seat_frequent(size, rng)
    return totals


def test_probabilities_sum_to_one():
    w, ids, rng = some_words(1)
    size, totals = 21, None
    for _ in range(4):
        totals = totals_of(w, size, rng, totals)
        for context in ids:
            p = w.predictive(totals, size, np.arange(20), np.full(20, context))
            klass = int(w.kind.klass[context])
            unknown = 1 / size
            for level, k in ((0, 0), (1, klass >> 8), (2, klass), *([(3, context)] if w.kind.is_word[context] else [])):
                d, s = totals.d[level], totals.s[level]
                unknown *= (s + d * totals.tables[level][k]) / (s + totals.customers[level][k])
            assert math.isclose(p.sum() + unknown, 1, rel_tol=1e-9)
        w.seat(totals, size, rng)
        assert (w.t3[w.sits] >= 1).all() and (w.t3 <= w.n).all() and (w.t2 <= w.c2).all() and (w.t1 <= w.c1).all() and (w.t0 <= w.c0).all()
        totals.draw_parameters(rng)
        assert all(d in pylm.DISCOUNTS for d in totals.d) and all(x in pylm.STRENGTHS for x in totals.s)


def test_draws_follow_their_conditional():
    """Tables against the exact conditional, and the limit of many customers against it where both can be had."""
    rng = np.random.default_rng(2)
    for d, theta, others, base in ((0.5, 1.0, 3.0, 0.2), (0.8, 5.0, 40.0, 0.02)):
        for c in (2, 7, 30):
            k = np.arange(1, c + 1)
            logp = pylm.log_stirling(d)[c, 1 : c + 1] + np.cumsum(np.log(theta + d * (others + k - 1))) + k * np.log(base)
            want = np.exp(logp - logp.max())
            want /= want.sum()
            n = 40_000
            got = np.bincount(pylm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, base), d, theta, rng), minlength=c + 1)[1:] / n
            assert np.abs(got - want).sum() < 0.03
        c = 400
        s = pylm.log_stirling(d, c)
        k = np.arange(1, c + 1)
        logp = s[c, 1:] + np.cumsum(np.log(theta + d * (others + k - 1))) + k * np.log(base)
        want = np.exp(logp - logp.max())
        mean = (want / want.sum()) @ k
        got = pylm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, base), d, theta, rng).mean()
        assert abs(got - mean) < 0.1 * mean


def test_seating_logs_and_gamma():
    x = np.array([0.3, 1.0, 2.5, 9.0, 1e6])
    assert np.allclose(pylm.log_gamma(x), [math.lgamma(v) for v in x])
    c, t = np.array([1, 3, 40]), np.array([1, 2, 11])
    want = [sum(pylm.log_stirling(d)[a, b] for a, b in zip(c, t)) for d in pylm.DISCOUNTS]
    assert np.allclose(pylm.seating_logs(c, t), want)


def test_parameters_are_found():
    """Restaurants seated by the process itself, a dish for each table, give back discount and strength."""
    rng = np.random.default_rng(3)
    for d, s in ((0.8, 1.0), (0.2, 12.0)):
        totals, sizes = pylm.Totals(pylm.CLASSES, 0), []
        for k in range(200):
            tables = []
            for i in range(80):
                u = rng.random() * (i + s)
                for j, n in enumerate(tables):
                    u -= n - d
                    if u < 0:
                        tables[j] += 1
                        break
                else:
                    tables.append(1)
            totals.customers[2][k], totals.tables[2][k] = 80, len(tables)
            sizes += tables
        totals.logs[2] = pylm.seating_logs(np.array(sizes), np.ones(len(sizes), np.int64))
        totals.draw_parameters(rng)
        assert abs(totals.d[2] - d) <= 0.16 and s / 3 <= totals.s[2] <= s * 3


def test_scores(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("score")).unionByName(spark.createDataFrame([(9001, None, 1), (9002, "", 1), (9003, "zzz Zzz", 1)], "doc_id bigint, text string, score int"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = docs.select("doc_id", "text", fold.alias("h")).collect()
    got = {r["doc_id"]: r for r in pylm.score_texts(docs, fold).collect()}
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    toks = {r["doc_id"]: [*re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"])), None] for r in rows}
    count = {}
    for r in rows:
        if not r["h"]:
            for t in toks[r["doc_id"]]:
                count[t] = count.get(t, 0) + 1
    n, v = sum(count.values()), len(count)
    for r in rows:
        g, t = got[r["doc_id"]], toks[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(t), sum(x in count for x in t), n)
        assert math.isclose(g["base_score"], sum(math.log10((count.get(x, 0) + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
    held = [got[r["doc_id"]] for r in rows if r["h"]]
    size = sum(g["n_tokens"] for g in held)
    assert -sum(g["score"] for g in held) / size < -sum(g["base_score"] for g in held) / size
    assert pylm.score_texts(docs.limit(0), fold).count() == 0
    assert pylm.score_texts(docs, F.lit(True)).where("n_known > 0").count() == 0


def test_repeated_rows_and_ids_as_text(spark):
    rows = [("a", "one two three"), ("a", "one two three"), ("b", "one two"), (None, "two"), (None, None), ("c", "one two three")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id string, text string, n int")
    got = pylm.score_texts(df, F.col("doc_id").eqNullSafe(F.lit("c"))).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), len((t or "").split()) + 1) for i, t in rows)
    assert {r["train_tokens"] for r in got} == {4 + 4 + 3 + 2 + 1}
    twice = [r for r in got if r["doc_id"] == "a"]
    assert twice[0]["score"] == twice[1]["score"] and math.isclose(twice[0]["base_score"], next(r["base_score"] for r in got if r["doc_id"] == "c"))


def test_contexts():
    ids, classes = pylm.words_of(b"ab C\n\xc3\xa9")
    assert classes.tolist() == [256 * ord("b") + ord("a"), 256 * ord("c"), 256 * 0xA9 + 0xC3]
    order = np.argsort(np.append(ids[:1], np.uint64(pylm.END)))
    both = np.append(ids[:1], np.uint64(pylm.END))[order]
    c = pylm.Contexts(both, np.array([classes[0], 0])[order], np.array([1, 1]))
    words, context = c.tokens(b"AB c x")
    assert words[-1] == pylm.END and c.klass[context].tolist() == [0, classes[0], classes[1], 256 * ord("x")]
    assert c.is_word[context].tolist() == [False, True, False, False] and c.place(words).tolist() == [int(np.flatnonzero(both == ids[0])[0]), -1, -1, int(np.flatnonzero(both == np.uint64(pylm.END))[0])]
