"""Text, date and name functions against worked examples."""

import pytest
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions import wikitext as W
from skein.functions.udfs import drop_nested, html_unescape, resolve


def values(spark, column, *args):
    names = [f"c{i}" for i in range(len(args[0]))]
    df = spark.createDataFrame([tuple(a) for a in args], ", ".join(f"{n} string" for n in names))
    return [r[0] for r in df.select(column(*(F.col(n) for n in names))).collect()]


@pytest.mark.parametrize(
    "f, cases",
    [
        (T.norm_title, {"Spider-Man: No Way Home": "spidermannowayhome", "Amélie": "amélie", "": "", None: ""}),
        (T.strip_disambig, {"Heat (1995 film)": "Heat", "Dark (TV series)": "Dark", "Heat (FILM)": "Heat (FILM)", "Fargo (season 2)": "Fargo"}),
        (lambda c: T.strip_disambig(c, narrow=True), {"Fargo (season 2)": "Fargo (season 2)", "Heat (film)": "Heat"}),
        (T.strip_subtitle, {"Pushpa: The Rise - Part 01": "Pushpa: The Rise", "Baahubali: The Beginning": "Baahubali", "Rocky II": "Rocky II", "X (a) vol. 3": "X (a)", "X: The Rise": "X: The Rise"}),
        (T.clean_characters, {'["A","B"]': "A, B", "x": "x"}),
        (T.year_prefix, {"1999-01-02": "1999", "99": "", None: ""}),
        (T.year_chars, {"1999-01-02": "1999", "99": "99", None: ""}),
        (T.year_search, {"in 1999 or 2001": "1999", "12345": "", "x2020": ""}),
        (T.strip, {"  a b \n": "a b"}),
        (T.squeeze, {" a \t\n b ": "a b"}),
        (T.content_type, {"x/movie/1": "movie", "x/movies/1": "unknown", "x/show/1": "show", "x/webseries/2": "webseries"}),
        (T.host, {"http://u:p@a.b:80/c": "a.b:80", "nothing": ""}),
        (T.robots_path, {"http://a/b?c=1": "/b?c=1", "http://a": "/"}),
        (T.content_hash, {"abc": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"}),
        (T.is_garbage, {"a": True, "12345": True, "a1": True, "ab": False}),
        (T.is_month, {"MARCH": True, "March": False}),
        (W.categories, {"[[Category: Films |x]] [[category:y]] [[Category:Z]]": ["Films", "Z"]}),
        (W.clean_field, {"[[A|B]]<br/>C {{x|{{y}}}} <i>d</i><!-- e -->": "B, C d", None: ""}),
        (W.extract_list, {"* [[A]]\n* B": ["A", "B"], "A, [[B|C]],": ["A", "C"]}),
        (W.article_kind, {"{{Infobox film": "film", "{{Infobox TV": "tv", "[[Category:1990 films]]": "film", "[[Category:x tv series]]": "tv", "z": None}),
        (W.wiki_url, {"A b": "https://en.wikipedia.org/wiki/A_b"}),
        (lambda c: W.wiki_url(c, escaped=True), {"A b": "https://en.wikipedia.org/wiki/A%20b"}),
        (html_unescape, {"&eacute;&#33;": "é!"}),
    ],
)
def test_one_argument(spark, f, cases):
    assert values(spark, f, *([k] for k in cases)) == list(cases.values())


def test_pairs(spark):
    assert values(spark, T.norm_key, ("RRR", "2022"), ("RRR", ""), ("RRR", None)) == ["rrr::2022", "rrr", "rrr"]
    assert values(spark, T.fuzzy_chars, ("brundavanam", "brindavanam"), ("ab", "abc"), ("ab", "ab"), ("abcd", "wxyz")) == [True, False, True, False]
    assert values(spark, T.fuzzy_names, ("C. Nolan", "Christopher Nolan"), ("A Lee", "Ang Lee"), ("A. B", "ab")) == [True, False, True]
    assert values(spark, T.if_other, ("a", "a"), ("a", "b"), ("", "b")) == ["", "a", ""]
    assert values(spark, T.video_url, ("YouTube", "k"), ("Vimeo", "k")) == ["https://www.youtube.com/watch?v=k", ""]


def test_variants_in_order(spark):
    (got,) = values(spark, T.translit_variants, ["Sita"])
    assert {"seeta", "sitaa", "shita", "sitha"} <= set(got) and len(got) == len(set(got))
    (the,) = values(spark, T.translit_variants, ["The Bee"])
    assert the[-1] == "bee"


def test_cast(spark):
    (got,) = values(spark, T.parse_cast, ["A as X as Y|B| "])
    assert [tuple(m) for m in got] == [("A", "X as Y", "actor"), ("B", "", "actor")]
    assert values(spark, T.split_names, ["Ann, B,\nCid"]) == [["Ann", "Cid"]]


def test_robots_flags(spark):
    for said, want in {"": (True, True), "noindex": (False, True), "nofollow": (True, False), "NOINDEX, NOFOLLOW": (False, False), "index, follow": (True, True)}.items():
        df = spark.createDataFrame([(said,)], "m string")
        assert tuple(df.select(*T.robots_flags(F.col("m"))).first()) == want


@pytest.mark.parametrize(
    "markup, want",
    [
        ("Some text [[Category:Science]] more text", "Some text more text"),
        ("See [[United States|US]] for details", "See US for details"),
        ("Visit [[Paris]] today", "Visit Paris today"),
        ("A {{outer {{inner}} stuff}} B", "A B"),
        ("Before [[File:Own.png|thumb|A [[link]] here]] after", "Before here]] after"),
        ("Before [[Image:Own.png|thumb|A view]] after", "Before after"),
        ("== Early life ==\nUlm", "Early life\nUlm"),
        ("This is '''bold''' and ''italic'' text", "This is bold and italic text"),
        ('Fact<ref>Source</ref> and<ref name="b" /> end<ref>x</ref>', "Fact and end"),
        ("See [http://example.com Example Site] for info", "See Example Site for info"),
        ("A &amp; B &lt; C &quot;E&quot;", 'A & B < C "E"'),
        ("word1    word2\n\n\n\n\nword3", "word1 word2\n\nword3"),
        ('x {| class="wikitable"\n| a\n|} y', "x y"),
        ("__NOTOC__a", "a"),
    ],
)
def test_wikitext(spark, markup, want):
    assert values(spark, W.strip_wikitext, [markup]) == [want]


def test_compat_swallows(spark):
    markup = 'a<ref name="b" /> kept<ref>x</ref> z'
    assert values(spark, W.strip_wikitext, [markup]) == ["a kept z"]
    assert values(spark, lambda c: W.strip_wikitext(c, compat=True), [markup]) == ["a z"]


def test_infobox(spark):
    box = "x {{Infobox film\n| name = N {{y|{{z}}}}\n| director =\n| writer = X\n| name = M\n}} | after = no"
    fields = lambda texts, **how: [r["f"] for r in spark.createDataFrame([(x,) for x in texts], "x string").withColumn("box", W.infobox(F.col("x"))).select(W.infobox_fields(F.col("box"), **how).alias("f")).collect()]
    assert fields([box]) == [{"director": "", "writer": "X", "name": "M"}]
    compat = fields([box], compat=True)[0]
    assert compat["director"] == "| writer = X"
    assert fields(["{{Infobox film\n| a = b", "x {{infobox TV\n| a = {{1{{2{{3{{4{{5}}}}}}}}}}\n| b = c\n}}", "none"]) == [{}, {"a": "{{1{{2{{3{{4{{5}}}}}}}}}}", "b": "c"}, {}]
    assert values(spark, W.plot_section, ["a\n== Plot ==\n'''He''' runs.\n== Cast ==\nno"]) == ["He runs."]
    assert values(spark, W.plot_section, ["none"]) == [""]


def test_nested_and_resolve():
    assert drop_nested("a{{b{{c}}d}}e", "{{", "}}") == "ae" and drop_nested("a{{b", "{{", "}}") == "a" and drop_nested("a}}b", "{{", "}}") == "a}}b"
    base = "https://e.com/d/x?q=1"
    assert [resolve(base, h) for h in ("y", "/z#f", "//o.com/", "#a", "javascript:1", "mailto:a", "ftp://x", " ", "?r")] == [
        "https://e.com/d/y", "https://e.com/z", "https://o.com/", None, None, None, None, None, "https://e.com/d/x?r",
    ]
