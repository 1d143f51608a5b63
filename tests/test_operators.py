"""Matching, tags, merging, robots, crawl, sources and streams on small inputs."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from skein.functions import pages as P
from skein.functions.udfs import parse_pages
from skein.operators import catalog, crawl, dedup, matching, robots, tags
from skein.plans.queries import _waves
from skein.sources import readers, sinks
from skein.streaming import limits


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def titles(spark, *data):
    return spark.createDataFrame(list(data), "id int, title string, original_title string, year string, director string, cast array<string>")


def records(spark, *data):
    return spark.createDataFrame(list(data), "rid int, title string, year string, director string, cast array<string>")


def test_scores(spark):
    t = titles(spark, (1, "Heat", "", "1995", "M. Mann", ["a", "b", "c", "d"]), (2, "The Other", "Otra", "2001", "Ann Director", None))
    r = records(spark, (1, "Heat (1995 film)", "1995", "Michael Mann", ["A", "B", "C", "D"]), (2, "Different", "2001", "Ann Director", []), (3, "other", "2000", "", None), (4, "OTRA!", "1999", "", None))
    got = {(x["id"], x["rid"]): (x["points"], x["signals"]) for x in matching.scored(t, r).collect()}
    assert got[1, 1] == (100, ["exact_title", "year", "director", "cast:***"])
    assert got[2, 2] == (55, ["director_year_only", "year", "director"])
    assert got[2, 4][0] == 20 and got[2, 3][0] == 5
    best = {x["id"]: x["rid"] for x in matching.best_match(t, r).collect()}
    assert best == {1: 1, 2: 2}


def _copied(spark):
    """Titles and records with copies, blanks and missing values."""
    rng = random.Random(7)
    one = lambda i: (i, rng.choice(["The Heat", "heat", "Heat (film)", "Ran", "", None]), rng.choice(["Heat", "", None]), rng.choice(["1995", "", None]), rng.choice(["M. Mann", "Ann Mann", "", None]), rng.choice([["A"], ["A", "B"], None]))
    t = [one(i) for i in range(300)]
    r = [(x[0], x[1], *x[3:]) for x in (one(i) for i in range(200))]
    return titles(spark, *t), records(spark, *r)


def test_matches_of_copies(spark, monkeypatch):
    """all pairs of equal rows, each at its first probe; in blocks, and with frequent keys dealt."""
    t, r = _copied(spark)
    monkeypatch.setattr(matching, "BLOCK", 3)
    monkeypatch.setattr(matching, "DEALT", 5)
    some = [(x["id"], x["rid"], x["probe"], x["points"], tuple(x["signals"])) for x in matching.scored(t, r).collect()]
    key = lambda c: "".join(x for x in (c or "").lower() if x.isalnum())
    want = {}
    for a in t.collect():
        plain = (a["title"] or "").lower().removeprefix("the ")
        probes = [key(a["title"]), key(a["original_title"]) if a["title"] is not None and a["original_title"] != a["title"] else "", key(plain)]
        for b in r.collect():
            person = bool(a["director"] and a["year"]) and (key(a["director"]), a["year"]) == (key(b["director"]), b["year"])
            hit = [i for i, p in enumerate(probes) if p and p in (key(b["title"]), key((b["title"] or "").removesuffix(" (film)")))] + [3] * person
            if hit:
                want[a["id"], b["rid"]] = hit[0]
    assert len(some) == len(want) and {x[:2]: x[2] for x in some} == want
    assert sorted(x[:3] for x in some) == rows(matching.candidates(t, r).select("id", "rid", "probe"))
    best = {}
    for x in sorted(some, key=lambda x: (-x[3], x[2], x[1])):
        if x[3] >= 50:
            best.setdefault(x[0], x)
    assert {x["id"]: (x["id"], x["rid"], x["probe"], x["points"], tuple(x["signals"])) for x in matching.best_match(t, r).collect()} == best
    assert best


def test_matches_compare_rows_alike_once(spark, monkeypatch):
    """what meets doesn't grow with the square of the copies."""
    left, right = spark.range(300), spark.range(200)
    cols = lambda k: [F.col("id").cast("int").alias(k), F.lit("Heat").alias("title"), F.lit("").alias("original_title"), F.lit("1995").alias("year"), F.lit("M").alias("director"), F.array(F.lit("A")).alias("cast")]
    t, r = left.select(*cols("id")), right.select(*cols("rid"))
    sizes, meet = [], matching.meet
    monkeypatch.setattr(matching, "meet", lambda *a: (sizes.append((out := meet(*a)).count()), out)[1])
    assert {(x["id"], x["rid"]) for x in matching.best_match(t, r).collect()} == {(i, 0) for i in range(300)}
    assert matching.candidates(t, r).count() == matching.scored(t, r).count() == 60_000
    assert max(sizes) <= 2 and len(sizes) == 3


def _casts(spark):
    """Titles and records of few kinds, but of many casts."""
    rng = random.Random(3)
    cast = lambda: rng.choice([None, [], [rng.choice(["A", "a.", "B", "C"])], rng.choices(["A", "B", "C", "D", "d", None, "!"], k=rng.randint(2, 6))])
    one = lambda i: (i, rng.choice(["Heat", "heat!", "Ran"]), "", rng.choice(["1995", ""]), rng.choice(["M. Mann", "Ann Mann", ""]), cast())
    t, r = [one(i) for i in range(240)], [one(i) for i in range(160)]
    return titles(spark, *t), records(spark, *((x[0], x[1], *x[3:]) for x in r))


def test_best_match_of_many_casts(spark, monkeypatch):
    """F1 of round 3: rows that differ in their casts alone are scored once; the best of them is found by the names."""
    t, r = _casts(spark)
    best = {}
    for x in sorted(matching.scored(t, r).collect(), key=lambda x: (-x["points"], x["probe"], x["rid"])):
        if x["points"] >= 50:
            best.setdefault(x["id"], tuple(x))
    sizes, meet = [], matching.meet
    monkeypatch.setattr(matching, "meet", lambda *a: (sizes.append((out := meet(*a)).count()), out)[1])
    assert {x["id"]: tuple(x) for x in matching.best_match(t, r).collect()} == best
    assert best and sizes[0] < 300


def test_scores_of_many_casts(spark, monkeypatch):
    """F2 of round 3: rows that differ in their casts alone meet once; the names in common are told apart for all pairs."""
    t, r = _casts(spark)
    key = lambda c: "".join(x for x in (c or "").lower() if x.isalnum())
    names = lambda c: [key(x) for x in c or []]
    want = {}
    for a in t.collect():
        for b in r.collect():
            year, person = a["year"] != "" and a["year"] == b["year"], "" not in (a["director"], b["director"])  # one last word
            titled, alike = key(a["title"]) == key(b["title"]), a["director"] == b["director"]
            if titled or year and person and alike:
                tier = (35, "exact_title") if a["title"].lower() == b["title"].lower() else (25, "normalized_title") if titled else (5, "director_year_only")
                n = min(3, sum(x in names(b["cast"]) for x in names(a["cast"])))
                signals = [tier[1], *["year"] * year, *["director"] * person, *["cast:" + "*" * n] * (n > 0)]
                want[a["id"], b["rid"]] = (0 if titled else 3, min(100, tier[0] + 30 * year + 20 * person + 5 * n), signals)
    sizes, meet = [], matching.meet
    monkeypatch.setattr(matching, "meet", lambda *a: (sizes.append((out := meet(*a)).count()), out)[1])
    for block in (1000, 7):
        monkeypatch.setattr(matching, "BLOCK", block)
        got = matching.scored(t, r).collect()
        assert len(got) == len(want) and {(x["id"], x["rid"]): tuple(x)[2:] for x in got} == want
    assert sizes[0] < 300 and {x[1] % 5 for x in want.values()} == {0} and {len(s[-1]) for _, _, s in want.values() if "cast" in s[-1]} == {6, 7, 8}


def test_pairs_are_buffered_by_id(spark):
    """F1 of round 2: pairs are put out one id at a time; the explodes of ids and of rids aren't compiled into one loop."""
    some = spark.range(2).select(F.sequence("id", F.lit(2)).alias("ids"), F.array(F.lit(7), F.col("id")).alias("rids"), F.lit(0).alias("probe"))
    out = matching.expanded(some, "probe")
    assert rows(out) == sorted((i, r, 0) for k in range(2) for i in range(k, 3) for r in (7, k))
    plan = [x.strip() for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in x]
    assert len(plan) == 2 and "rids" in plan[0] and "*(" in plan[0] and "*(" not in plan[1]


def test_fuzzy_pairs_of_copies(spark, tmp_path, monkeypatch):
    """all pairs of copies, from names compared once; in blocks, and with frequent keys dealt."""
    from skein.plans.queries import QUERIES

    names = ["red ring", "red rings", "old bolt", "x", None]
    data = [(i, names[i % 5], i % 2, "T") for i in range(100)] + [(100, "x", None, "T"), (101, "x", None, "T")]
    spark.createDataFrame(data, "p_partkey long, p_name string, p_size int, p_type string").write.parquet(f"file://{tmp_path}/part.parquet")
    sizes, meet = [], matching.meet
    monkeypatch.setattr(matching, "meet", lambda *a: (sizes.append((out := meet(*a)).count()), out)[1])
    whole = rows(QUERIES["fuzzy_chars"](spark, f"file://{tmp_path}"))
    assert sizes == [50]
    monkeypatch.setattr(matching, "BLOCK", 3)
    monkeypatch.setattr(matching, "DEALT", 2)
    assert rows(QUERIES["fuzzy_chars"](spark, f"file://{tmp_path}")) == whole
    assert [x[:2] for x in whole] == [(a, b) for a in range(100) for b in range(a + 1, 100) if a % 2 == b % 2]
    got = {(names[a % 5], names[b % 5]): (near, named) for a, b, near, named in whole if None not in (names[a % 5], names[b % 5])}
    assert got["red ring", "red rings"] == (True, False) and got["x", "x"] == (True, True) and got["old bolt", "x"] == (False, False)


def test_cast_and_series(spark):
    t = spark.createDataFrame([("tt1", [("A", "x"), ("A", "y")]), ("", None)], "imdb_id string, cast array<struct<name:string,character:string>>")
    p = spark.createDataFrame([("tt1", [("a", "z"), ("B", ""), ("b", "")])], "tconst string, cast array<struct<name:string,character:string>>")
    assert [[m["name"] for m in r["cast"]] for r in matching.with_cast(t, p).orderBy(F.desc("imdb_id")).collect()] == [["A", "A", "B"], []]
    b = spark.createDataFrame([("t2", "tvSeries", "One", "Uno", "1990", 2), ("t1", "tvSeries", "Uno", "One", "1990", 1), ("t3", "movie", "One", "One", "1990", 0)], "tconst string, titleType string, primaryTitle string, originalTitle string, startYear string, ord int")
    s = spark.createDataFrame([("one!", "x", "1990"), ("zzz", "UNO", "1990"), ("q", "q", "1990")], "name string, original_name string, year string")
    assert {r["name"]: r["tconst"] for r in matching.series_ids(s, b).collect()} == {"one!": "t1", "zzz": "t1", "q": None}
    pr = spark.createDataFrame([("t", 2, "n2", "actor", r"\N"), ("t", 1, "n1", "actor", '["X"]'), ("t", 3, "n9", "a", "")], "tconst string, ordering int, nconst string, category string, characters string")
    nm = spark.createDataFrame([("n1", "A"), ("n2", "B"), ("n9", "")], "nconst string, name string")
    assert [tuple(m) for m in matching.names_of(pr, nm).first()["cast"]] == [("A", "X", "actor"), ("B", "", "actor")]


def test_routing(spark):
    seeds = spark.createDataFrame([("http://a:1/x",), ("http://b/",), ("http://c/",)], "url string")
    sites = spark.createDataFrame([("a:1", "full"), ("b", "UNSPECIFIED")], "domain string, strategy string")
    assert rows(matching.route_seeds(seeds, sites, "polite")) == [("http://a:1/x", "full"), ("http://b/", "polite"), ("http://c/", "polite")]


@pytest.mark.parametrize("votes, tier", [(101, "gold"), (100, "silver"), (11, "silver"), (10, "bronze")])
def test_tiers(spark, votes, tier):
    t = spark.createDataFrame([("T", "o", "p", [(1, "g")], [(1, "c")], votes, {"IN": 1}, "2001-01-01", ["KR"], "te", [("Director", "D")])], "title string, overview string, poster_path string, genres array<struct<id:int,name:string>>, cast array<struct<id:int,name:string>>, vote_count int, watch_providers map<string,int>, release_date string, origin_country array<string>, original_language string, crew array<struct<job:string,name:string>>")
    g = tags.tagged(t, "movie").first()["_tags"]
    assert (g["tier"], g["display_ready"], g["is_korean"], g["is_indian"], g["has_director"], g["release_year"], g["has_imdb_rating"]) == (tier, True, True, True, True, "2001", False)
    assert tagged_len(g) >= 47
    assert t.select(tags.director(F.col("crew"))).first()[0] == "D"


def tagged_len(g):
    return len(g.asDict())


def test_merge_in_rounds_as_in_order(spark):
    from skein.functions.text import fuzzy_chars, norm_title

    w = _waves(spark, "/root/testdata/sf0.01")
    full = w.select("*", dedup.index_keys().alias("keys"), dedup.probes().alias("probes")).collect()
    near = {(a, b) for a, b in w.alias("a").join(w.alias("b"), F.col("a.director") == F.col("b.director")).where(fuzzy_chars(norm_title(F.col("a.title")), norm_title(F.col("b.title")))).select("a.ord", "b.ord").collect()}
    want = dedup.resolve_in_order([r.asDict() | {"fuzzy": lambda root, o=r["ord"]: (o, root) in near} for r in full])
    got = {r["ord"]: r for r in dedup.resolve(w).collect()}
    stands = {}
    for r in full:
        if r["wave"] == 0:
            k = r["keys"][0]
            stands[k] = max(stands.get(k, 0), r["ord"])
    keys = {r["ord"]: (r["keys"][0], r["wave"]) for r in full}
    for o, (root, rank) in want.items():
        if keys[root][1] == 0:
            root = stands[keys[root][0]]
        assert got[o]["root"] == root, o
        assert got[o]["method"] == {m[0]: m[1] for m in dedup.METHODS}.get(rank), o
    assert {r["method"] for r in got.values()} >= {"exact", "director_year_fuzzy"}


def test_director_pass_alone_links_respelled_titles(spark):
    data = [(0, 0, "Brindavanam", "2010", "V. P", "c"), (1, 1, "Brundavanam", "2010", "", "e"), (2, 2, "Brundavanam", "2011", "V P", "y"), (3, 2, "Brundaavanam", "2010", "V P", "y")]
    got = {r["ord"]: (r["root"], r["method"]) for r in dedup.resolve(spark.createDataFrame(data, "ord long, wave int, title string, year string, director string, source string")).collect()}
    assert got == {0: (0, None), 1: (1, None), 2: (2, None), 3: (1, "transliteration")}


_MERGED = "ord long, wave int, title string, year string, director string, source string"


def test_merge_of_copies_as_in_order(spark):
    """rows alike in all fields, among them empty and missing titles, against one row after another."""
    from skein.functions.text import fuzzy_chars, norm_key, norm_title

    rng = random.Random(5)
    names = ["Foo: Returns", "Foo Returns", "Foo", "foo!", "Foo (film)", "Foo - part 2", "Brindavanam", "Brundavanam", "Brundaavanam", "The Foo", "", None, "!!!"]
    data = sorted((w := rng.choice([0, 1, 1, 2, 3])) * 1000 + i for i in range(500))
    data = [(o, o // 1000, rng.choice(names if o >= 1000 else ["Foo", "Brindavanam", ""]), rng.choice(["2010", "", None]), rng.choice(["V. P", "V P", "", None]), "s") for o in data]
    w = spark.createDataFrame(data, _MERGED)
    full = w.select("*", dedup.index_keys().alias("keys"), dedup.probes().alias("probes"), norm_title(F.col("title")).alias("n"), norm_key(F.col("title"), F.col("year")).alias("k")).collect()
    n = w.select(norm_title(F.col("title")).alias("n")).distinct()
    near = {tuple(r) for r in n.crossJoin(n.withColumnRenamed("n", "m")).where(fuzzy_chars(F.col("n"), F.col("m"))).collect()}
    by = {r["ord"]: r for r in full}
    want = dedup.resolve_in_order([r.asDict() | {"fuzzy": lambda root, r=r: (r["n"], by[root]["n"]) in near} for r in full])
    stands = {}
    for r in sorted(full, key=lambda r: r["ord"]):
        if r["wave"] == 0 and r["n"]:
            stands[r["k"]] = r["ord"]
    got = {r["ord"]: (r["root"], r["method"]) for r in dedup.resolve(w).collect()}
    methods = {m[0]: m[1] for m in dedup.METHODS}
    last = lambda o: stands.get(by[o]["k"], o) if by[o]["wave"] == 0 else o
    assert got == {o: (last(root), methods.get(rank)) for o, (root, rank) in want.items()}
    assert {m for _, m in got.values()} >= {"exact", "subtitle_stripped"}


def test_merge_pairs_are_of_classes(spark, monkeypatch):
    """pairs don't grow with the square of the copies."""
    sizes, write = {}, dedup._written

    def counted(df, name):
        out = write(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(dedup, "_written", counted)
    data = [(w * 1000 + i, w, f"Title {'ab'[i % 2]}", "2010", "V P", "s") for w in (0, 1, 2) for i in range(100)]
    got = dedup.resolve(spark.createDataFrame(data, _MERGED)).collect()
    assert {r["root"] for r in got} == {98, 99} and len(got) == 300
    assert sizes["pairs"] < 100


def test_unified_gathers_by_source_first(spark):
    """of a root's rows one for each source is gathered, not all of them."""
    kinds = ("catalogue", "encyclopedia", "yearlist", "streaming")
    data = [(i, 9000 + i if i % 4 == 3 and i > 700 else 0, i % 4, kinds[i % 4], f"T{i}", "2010", "" if i < 5 else f"D{i}", None if i < 4 else "subtitle_stripped" if i % 2 else "exact", None if i < 4 else 80 if i % 2 else 95) for i in range(800)]
    out = dedup.unified(spark.createDataFrame(data, "ord bigint, root bigint, wave int, source string, title string, year string, director string, method string, confidence int"))
    assert "keys=[root" in (plan := out._jdf.queryExecution().executedPlan().toString()) and re.search(r"keys=\[root#\d+L?, \S*source#\d+", plan)
    got = {r["root"]: r for r in out.collect()}
    first = got.pop(0)
    assert (first["title"], first["director"], first["sources"], first["method"], first["confidence"]) == ("T0", "D5", list(kinds), "subtitle_stripped", 80)
    assert len(first["platforms"]) == sum(r[1] == 0 and r[2] == 3 for r in data) and len(got) == sum(r[1] > 0 for r in data)
    assert all((r["title"], r["sources"], len(r["platforms"]), r["method"]) == (f"T{k - 9000}", ["streaming"], 1, "subtitle_stripped") for k, r in got.items())


def test_robots(spark):
    texts = {
        "north": "User-agent: *\nDisallow: /attic/ # dust\nDisallow: /cellar\nAllow: /attic/window\nCrawl-delay: 0.25\nSitemap: http://north/m1\nUser-agent: later\nSitemap: http://north/m2",
        "east": "User-agent: Spinneret\nDisallow: /\nAllow: /porch\n\nUser-agent: *\nDisallow: /shed/",
        "south": "user-AGENT: *\ndisallow: /*.tar$\ndisallow: /yard/*/well\nallow: /yard/new/well",
        "west": "User-agent: *\nDisallow:\nUser-agent: other\nDisallow: /",
        "up": "Disallow: /early\nUser-agent: loom\nUser-agent: spinneret\nDisallow: /roof\nCrawl-delay: none",
    }
    df = spark.createDataFrame(list(texts.items()), "domain string, body string")
    paths = {
        ("north", "/"): 1, ("north", "/attic/box"): 0, ("north", "/attic/window/2"): 1, ("north", "/cellars"): 0, ("east", "/gate"): 0, ("east", "/porch/1"): 1, ("south", "/x.tar"): 0, ("south", "/x.tar?v=2"): 1,
        ("south", "/yard/old/well"): 0, ("south", "/yard/new/well"): 1, ("south", "/x.tart"): 1, ("south", "/x.tar.tar"): 1, ("west", "/any"): 1, ("up", "/early"): 1, ("up", "/roof/tile"): 0,
    }
    urls = spark.createDataFrame(list(paths), "domain string, path string")
    found = robots.rules(df, "Spinneret/2.1")
    assert {(r["domain"], r["path"]): int(r["allowed"]) for r in robots.allowed(urls, found).collect()} == paths
    stranger = robots.allowed(spark.createDataFrame([("east", "/gate"), ("east", "/shed/a")], "domain string, path string"), robots.rules(df, "Bobbin"))
    assert {r["path"]: r["allowed"] for r in stranger.collect()} == {"/gate": True, "/shed/a": False}
    assert rows(robots.crawl_delay(found)) == [("north", 0.25, 4.0)]
    assert [r["value"] for r in found.where("kind = 'sitemap'").orderBy("line").collect()] == ["http://north/m1", "http://north/m2"]
    status = spark.createDataFrame([(200,), (404,), (503,), (None,)], "s int").select(robots.policy(F.col("s"))).collect()
    assert [r[0] for r in status] == ["rules", "allow", "deny", "deny"]


def test_sitemaps(spark):
    maps = spark.createDataFrame([("i", "<sitemapindex><sitemap><loc> a </loc></sitemap><sitemap><loc>x</loc></sitemap><sitemap><loc>b</loc></sitemap></sitemapindex>"), ("a", "<urlset><url><loc>1</loc></url><url><loc></loc></url></urlset>"), ("b", "<urlset><url><loc>2</loc></url><url><loc>3</loc></url></urlset>")], "loc string, body string")
    assert [r["loc"] for r in robots.sitemap_urls(maps, "i").collect()] == ["1", "2", "3"]
    assert [r["loc"] for r in robots.sitemap_urls(maps, "i", limit=2).collect()] == ["1", "2"]
    assert rows(robots.platform_urls(maps, "i", ["B"], ["2"])) == [("2",)]
    sites = spark.createDataFrame([("a", "User-agent: *\nDisallow: /x\nSitemap: s", ["ScreeningEvent"], 401), ("b", "", None, 500)], "domain string, robots string, types array<string>, api_status int")
    assert rows(robots.probe_report(sites)) == [("a", True, ["s"], True, True, True), ("b", False, [], False, False, False)]


def test_breadth_first_and_polite(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "x/skip"), ("c", "d")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert rows(crawl.breadth_first(e, seeds, 2, exclude=["skip"])) == [("a", 0), ("b", 1), ("c", 2)]
    assert rows(crawl.breadth_first(e, seeds, 9)) == [("a", 0), ("b", 1), ("c", 2), ("d", 3), ("x/skip", 2)]
    f = spark.createDataFrame([("u1", "c", 0), ("u2", "c", 0), ("u3", "c", 0)], "url string, crawl_id string, depth int")
    p = spark.createDataFrame([("u1", 200, False, True, ["n", "n", "u2"]), ("u2", 200, True, False, ["m"]), ("u3", 304, True, True, ["z"])], "url string, status int, index boolean, follow boolean, links array<string>")
    ok = spark.createDataFrame([], "url string, allowed boolean")
    stored, queued = crawl.polite_plan(f, p, ok, f.select("crawl_id", "url"))
    assert [r["url"] for r in stored.collect()] == ["u2"] and [(r["url"], r["depth"], r["discovered_from"]) for r in queued.collect()] == [("n", 1, "u1")]
    maps = spark.createDataFrame([("h", "s", "http://h/1")], "domain string, sitemap string, loc string")
    fr = spark.createDataFrame([("http://h/0", "c", 0)], "url string, crawl_id string, depth int")
    none = spark.createDataFrame([], "crawl_id string, domain string")
    assert rows(crawl.sitemap_plan(fr, maps, none, fr)) == [("c", "http://h/1", 0, "sitemap:s")]


def test_pacing_and_bucket(spark):
    r = spark.createDataFrame([(1, "d", 0), (2, "d", 0), (3, "d", 200_000), (4, "d", 5_000_000)], "id long, domain string, arrival_us long")
    assert [x["start_us"] for x in crawl.pacing(r, F.lit(500_000)).orderBy("id").collect()] == [0, 500_000, 1_000_000, 5_000_000]
    assert [x["wait_us"] for x in limits.token_bucket(r.where("id < 3"), 2.0, 1).orderBy("id").collect()] == [0, 500_000]
    rng = random.Random(3)
    data = [(i, f"d{rng.randrange(3)}", rng.randrange(10_000_000)) for i in range(200)]
    got = {x["id"]: x["wait_us"] for x in limits.token_bucket(spark.createDataFrame(data, r.schema), 1.5, 3).collect()}
    for d in {x[1] for x in data}:
        tokens, last = 3.0, None
        for i, _, at in sorted((x for x in data if x[1] == d), key=lambda x: (x[2], x[0])):
            tokens, wait = limits.bucket_step(tokens, at if last is None else last, at, 1.5, 3)
            last = at
            assert got[i] == wait


def test_streams(spark, tmp_path):
    events = [{"url": u, "crawl_id": "c", "depth": 0, "strategy": s, "queued_at": "2024-01-01T00:00:00"} for u, s in (("a", ""), ("b", "FULL"), ("a", "x"))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text("\n".join(map(json.dumps, events)))
    stream = limits.routed(limits.unseen(limits.frontier(spark, str(tmp_path / "in"))))
    q = stream.writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert [r["url"] for r in spark.sql("SELECT url FROM seen ORDER BY url").collect()] == ["a", "b"]


def test_pages(spark):
    html = """<html><head><title>Test Page</title><meta name="description" content="A test page"><meta name="robots" content="noindex, nofollow"><link rel="canonical" href="https://example.com/canonical">
    <style>color: red</style></head><body><p>Hello World</p><script>var x</script><a href="/page1">1</a><a href="https://example.com/page2#f">2</a><a href="#x">3</a><a href="javascript:1">4</a><a href="/page1">5</a></body></html>"""
    df = spark.createDataFrame([("https://example.com/test", html), ("https://example.com", None)], "url string, html string")
    a, b = parse_pages(df).collect()
    assert (a["title"], a["meta_description"], a["meta_robots"], a["canonical_url"]) == ("Test Page", "A test page", "noindex, nofollow", "https://example.com/canonical")
    assert a["links"] == ["https://example.com/page1", "https://example.com/page2"] and "Hello World" in a["text"] and "var x" not in a["text"] and "red" not in a["text"]
    assert b["title"] == "" and b["links"] == []


def test_year_tables(spark):
    html = "<table><th>Opening</th><th>x</th><th>Title</th><tr><td>MARCH</td><td>5</td><td>Film <i>One</i>[1]</td><td>Dir</td><td><a title='t' href='#'>no</a><a title=\"Ann B\">Ann B</a></td><td>Prod</td></tr><tr><td>6</td><td>Two &amp; a half</td><td>D2</td><td>Cy, Di</td><td>[2]</td></tr></table><table><th>a</th></table>"
    df = spark.createDataFrame([(1, html)], "page int, html string")
    got = P.year_tables(df, ["page"]).orderBy("row_no").collect()
    assert [(r["title"], r["director"], r["cast"], r["production_company"], r["release_month"]) for r in got] == [("Film One", "Dir", ["Ann B"], "Prod", "March"), ("Two & a half", "D2", ["Cy", "Di"], "", "March")]
    tried = spark.createDataFrame([(1, 2, "x"), (1, 3, "y"), (2, 1, "z")], "page int, pattern int, film string")
    assert rows(P.first_pattern(tried, ["page"])) == [(1, 2, "x"), (2, 1, "z")]


def test_json_ld(spark):
    block = '<script type="application/ld+json"> {} </script>'
    one = {"@type": "Movie", "name": "N", "releaseYear": "2020", "genre": ["a", "b"], "actor": [{"name": "P"}], "director": {"name": "D"}, "image": "i", "potentialAction": {"target": [{"inLanguage": "te"}], "expectsAcceptanceOf": {"name": "free plan"}}}
    two = [{"@type": "VideoObject", "name": "M", "uploadDate": "2019-01-01"}, {"@type": "Other"}]
    html = block.replace("{}", json.dumps(one)) + block.replace("{}", json.dumps(two)) + block.replace("{}", "{bad")
    df = spark.createDataFrame([(1, html), (2, "none")], "page int, html string")
    (r,) = P.json_ld_records(df, ["page"]).collect()
    assert (r["title"], r["year"], r["genres"], r["cast"], r["director"], r["language"], r["free_or_paid"], r["content_type"], r["banner_url"]) == ("M", "2020", ["a", "b"], ["P"], "D", "te", "free", "movie", "i")
    assert P.json_ld_types(df, ["page"]).first()["types"] == ["Movie", "VideoObject", "Other"]
    m = spark.createDataFrame([('<meta property="og:image" content="a&amp;b">',), ('<meta content="x" property="og:image">',)], "h string")
    assert [x[0] for x in m.select(P.banner(F.col("h"))).collect()] == ["a&b", ""]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("t\tr\tv\ntt1\t7.5\t10\ntt2\t\\N\t3\n")
    assert rows(readers.ratings(spark, str(tmp_path / "r.tsv"))) == [("tt1", 7.5, 10)]
    assert rows(readers.ratings(spark, str(tmp_path / "r.tsv"), lenient=True)) == [("tt1", 7.5, 10), ("tt2", 0.0, 3)]
    assert readers.ratings(spark, str(tmp_path / "missing.tsv")).count() == 0
    (tmp_path / "m.jsonl").write_text('{"tmdb_id": 1, "title": "A"}\n{"tmdb_id": 2}\n{bad\n')
    good, bad = readers.titles(spark, str(tmp_path / "m.jsonl"))
    assert [r["tmdb_id"] for r in good.collect()] == [1] and len(bad.collect()) == 2
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>A b</title><ns>0</ns><id>1</id><revision><id>9</id><text>{{Infobox film\n| director = [[D]]\n| released = 1999\n}}\n[[Category:Films]] x &amp;amp; y</text></revision></page><page><title>R</title><ns>0</ns><id>2</id><redirect title='A'/><revision><id>1</id><text>t</text></revision></page><page><title>T</title><ns>1</ns><id>3</id></page></mediawiki>")
    d = readers.dump(spark, str(tmp_path / "d.xml"))
    (a,) = readers.dump_articles(d).collect()
    assert (a["title"], a["type"], a["director"], a["year"], a["categories"]) == ("A b", "film", "D", "1999", ["Films"])
    (p,) = readers.dump_pages(d, "p", "c").collect()
    assert p["url"].endswith("/A%20b") and "&" in p["text"] and "[[" not in p["text"]
    pages = spark.createDataFrame([("u", "c1", "p"), ("v", "c2", "p")], "url string, crawl_id string, project_id string")
    sinks.pages(pages, str(tmp_path / "pages"))
    assert [r["url"] for r in readers.crawled_pages(spark, str(tmp_path / "pages"), "c2").collect()] == ["v"]
    sinks.json_lines(spark.createDataFrame([(1, "", 0.0)], "a int, b string, c double"), str(tmp_path / "z"))
    assert spark.read.json(str(tmp_path / "z")).columns == ["a"]
    assert rows(sinks.upserted(pages, pages.limit(1).withColumn("project_id", F.lit("q")), ["url"])) in ([("u", "c1", "q"), ("v", "c2", "p")], [("u", "c1", "p"), ("v", "c2", "q")])
    assert [len(b) for b in sinks.batches(spark.range(250))] == [100, 100, 50]
    assert readers.env_file("# c\nA=1\nB = 2\n", {"A": "0"}) == {"A": "0", "B": "2"}
    assert readers.Settings.load({"PORT": "7"}).port == 7


def test_payload(spark):
    body = {
        "id": 5, "title": "T", "credits": {"cast": [{"id": 0, "name": "x"}, {"id": 2, "name": "C"}], "crew": [{"id": 3, "job": "Director", "name": "D"}, {"id": 3, "job": "Director", "name": "E"}]},
        "keywords": {"keywords": [{"id": 1, "name": "k"}]}, "videos": {"results": [{"site": "YouTube", "key": "z", "type": "Trailer"}]},
        "release_dates": {"results": [{"iso_3166_1": "US", "release_dates": [{"certification": ""}, {"certification": "PG"}]}, {"iso_3166_1": "FR", "release_dates": []}]},
        "external_ids": {"instagram_id": "i"}, "watch/providers": {"results": {"IN": {"flatrate": [{"provider_id": 1}]}, "QQ": {}}},
    }
    (r,) = readers.payload(spark.createDataFrame([(json.dumps(body),), ("{}",)], "body string"), "movie").collect()
    assert [c["name"] for c in r["cast"]] == ["C"] and [c["name"] for c in r["crew"]] == ["D"] and r["external_ids"] is None
    assert [tuple(c) for c in r["certifications"]] == [("US", "PG")] and r["videos"][0]["url"].endswith("v=z") and set(r["watch_providers"]) == {"IN", "QQ"}
    one = spark.createDataFrame([(json.dumps(body),)], "body string")
    kept = readers.payload(one, "movie").select(catalog.kept_countries(F.col("watch_providers"), ["IN"]).alias("m"), F.size(catalog.trailers(F.col("videos"))).alias("t")).first()
    assert set(kept["m"]) == {"IN"} and kept["t"] == 1


def test_catalog(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, n int")
    assert rows(catalog.updated(t, "id", 1, name="z", n=0)) == [(1, "z", 5), (2, "b", 6)]
    page, token = catalog.page_list(t, [F.col("id")], "bad", 1)
    assert page.first()["id"] == 1 and token == "1"
    assert catalog.lookup(t, t.withColumn("id", F.col("id") + 10), "id", 12).first()["name"] == "b"
    jobs = spark.createDataFrame([(1, 1, "start"), (1, 2, "pause"), (2, 1, "start"), (2, 3, "noise")], "job_id int, at int, command string")
    assert {r["job_id"]: r["status"] for r in catalog.job_status(jobs).collect()} == {1: "PAUSED", 2: "RUNNING"}
    e = spark.createDataFrame([(1, 5.0, "2024-01-05"), (2, 0.1, "2024-01-05"), (3, 9.0, "2024-01-01")], "id int, popularity double, d string").withColumn("day", F.to_date("d"))
    kept, skipped = readers.export_ids(e, 1.0, "2024-01-06")
    assert [r["id"] for r in kept.collect()] == [1] and [r["id"] for r in skipped.collect()] == [2]


def test_fan_out_of_many(spark):
    """starts beyond 2^31 microseconds; equal addresses in several stretches are numbered without gaps."""
    urls = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("url"))
    got = crawl.fan_out(urls, 4, 2.0).collect()
    assert len(got) == 6000
    for w in range(4):
        own = sorted((r["start_us"], r["url"]) for r in got if r["worker"] == w)
        assert [s for s, _ in own] == [n * 2_000_000 + w * 500_000 for n in range(len(own))]
        assert [u for _, u in own] == sorted(u for _, u in own)
    assert max(r["start_us"] for r in got) > 2**31


def test_full_retry_and_fan_out(spark):
    f = spark.createDataFrame([("u1", "c", 0), ("u2", "c", 0), ("u3", "c", 0)], "url string, crawl_id string, depth int")
    p = spark.createDataFrame([("u1", 200, ["n", "u2", "n"]), ("u2", 500, ["m"]), ("u3", 304, ["z"])], "url string, status int, links array<string>")
    stored, queued, errors = crawl.full_plan(f, p, f.select("crawl_id", "url"))
    assert [r["url"] for r in stored.collect()] == ["u1"] and [r["url"] for r in queued.collect()] == ["n"] and [r["url"] for r in errors.collect()] == ["u2"]
    a = spark.createDataFrame([("u", 0, 429), ("u", 1, 500), ("u", 2, 200), ("v", 0, 404), ("v", 3, 200)], "url string, attempt int, status int")
    assert rows(crawl.retry_plan(a)) == [("u", 200, 3, 6), ("v", 404, 1, 1)]
    got = crawl.fan_out(spark.range(40).select(F.col("id").cast("string").alias("url")), 4, 2.0).collect()
    assert {r["worker"] for r in got} == {0, 1, 2, 3} and len({(r["worker"], r["start_us"]) for r in got}) == 40


def test_page_records(spark):
    html = '<title> P </title><meta property="og:image" content="a&amp;b"><meta name="description" content="d">'
    ld = '<script type="application/ld+json">{"@type": "Movie", "name": "N", "image": "i"}</script>'
    df = spark.createDataFrame([(1, html), (2, html + ld), (3, "")], "page int, html string")
    got = {r["page"]: (r["title"], r["description"], r["banner_url"], r["thumbnail_url"], r["content_type"]) for r in P.page_records(df, ["page"]).collect()}
    assert got == {1: ("P", "d", "a&b", "a&b", ""), 2: ("N", "d", "a&b", "i", "movie")}


def test_wire_json(spark):
    df = spark.createDataFrame([(1, "u", 0, ["a"])], "page_id bigint, final_url string, depth int, links array<string>")
    out = df.select(sinks.wire_json(df).alias("j"))
    assert json.loads(out.first()["j"]) == {"pageId": "1", "finalUrl": "u", "links": ["a"]}
    back = out.select(*sinks.from_wire_json(F.col("j"), df))
    assert rows(back) == [(1, "u", None, ["a"])]
