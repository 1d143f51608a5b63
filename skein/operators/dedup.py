"""Multi-pass merging of titles from several sources (JOIN-07, SURVEY 2.8, AGG-05, 06, 14).

Rows come in a total order (ord). A row joins the first earlier root that shares a key with it, by the rank of the pass;
a row that finds none becomes a root. Rows of the first source are always roots. Who is a root depends on earlier rows,
so roots are found in rounds: a row is decided once no undecided earlier row could become its match. Results are sets
(SORT-03): what has an order carries ord.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written as _written
from ..functions.text import fuzzy_chars, norm_key, norm_title, strip_disambig, strip_subtitle, text, translit_variants

#: Rank, method, confidence in hundredths.
METHODS = [
    (0, "exact", 95), (4, "disambig_stripped", 90), (5, "transliteration", 85), (6, "transliteration_cross", 83),
    (7, "subtitle_stripped", 80), (8, "subtitle_stripped_cross", 78), (9, "director_year_fuzzy", 75),
]


def _key(kind: str, c: Column, year: Column) -> Column:
    """Null for a title without letters and digits: such titles have nothing in common."""
    return F.when(norm_title(c) != "", F.concat(F.lit(kind), norm_key(c, year)))


def index_keys() -> Column:
    """The keys a root is found by: e(xact), t(ransliterated), s(tripped), d(irector and year)."""
    title, year = F.col("title"), F.col("year")
    clean, short = strip_disambig(title, narrow=True), strip_subtitle(title)
    director = F.when((text(F.col("director")) != "") & (text(year) != ""), F.concat(F.lit("d:"), norm_title(F.col("director")), F.lit("::"), year))
    single = F.array_compact(F.array(_key("e:", title, year), F.when(clean != title, _key("e:", clean, year)), F.when(short != title, _key("s:", short, year)), director))
    return F.array_compact(F.array_distinct(F.concat(single, F.transform(translit_variants(title), lambda v: _key("t:", v, year)))))


def probes() -> Column:
    """(rank, place, key) in the order in which they are tried; place numbers the variants."""
    title, year = F.col("title"), F.col("year")
    probe = lambda rank, place, key: F.when(key.isNotNull(), F.struct(F.lit(rank).alias("rank"), place.alias("place"), key.alias("key")))
    clean, short = strip_disambig(title, narrow=True), strip_subtitle(title)
    zero = F.lit(0)
    director = F.when((text(F.col("director")) != "") & (text(year) != ""), probe(9, zero, F.concat(F.lit("d:"), norm_title(F.col("director")), F.lit("::"), year)))
    variants = translit_variants(title)
    single = F.array(
        probe(0, zero, _key("e:", title, year)), F.when(clean != title, probe(4, zero, _key("e:", clean, year))),
        F.when(short != title, probe(7, zero, _key("e:", short, year))), F.when(short != title, probe(8, zero, _key("s:", short, year))), director,
    )
    # Both passes over a variant are tried before the next one: the place leads there.
    swapped = F.flatten(F.transform(variants, lambda v, i: F.array(probe(5, i, _key("e:", v, year)), probe(6, i, _key("t:", v, year)))))
    return F.array_compact(F.concat(single, swapped))


def match_candidates(classes: DataFrame) -> DataFrame:
    """(ord, root, how): for each class of rows after the first source, the classes whose index holds one of its probe keys
    and that began before its last row (itself, too); how orders the passes.

    classes(ord, last, fixed, title, year, director): rows alike in title, year and director as one, ord the first of them.
    """
    norm = norm_title(F.col("title"))
    left = classes.where("not fixed").select("ord", "last", norm.alias("lt"), F.explode(probes()).alias("p")).select("ord", "last", "lt", "p.*")
    right = classes.select(F.col("ord").alias("root"), norm.alias("rt"), F.explode(index_keys()).alias("key"))
    pairs = left.join(right, "key").where("root < last").where((F.col("rank") != 9) | fuzzy_chars(F.col("lt"), F.col("rt")))
    step = F.when(F.col("rank").isin(5, 6), F.lit(5)).otherwise(F.col("rank"))
    return pairs.groupBy("ord", "root").agg(F.min(F.struct(step.alias("step"), "place", "rank")).alias("how"))


def resolve(rows: DataFrame, rounds: int = 50) -> DataFrame:
    """rows(ord, wave, title, year, director) with root (the ord a row merged into; its own if it is a root), method and
    confidence in hundredths. wave 0 is the first source: of its rows with one key the last stands for all.

    Rows alike in title, year and director share all keys. So of those after the first source only the first can be a
    root (unless they have no keys at all, and meet nothing), and of those of the first source the first is found before
    the others: pairs and rounds are of such classes, and a row takes the best root of its class that lies before it.

    Rounds are written to the folder of spark.checkpoint.dir and end when all classes are decided: as many as the longest
    chain of classes that depend on each other.
    """
    cols = ("title", "year", "director")
    key = F.when(norm_title(F.col("title")) != "", norm_key(F.col("title"), F.col("year")))
    fixed = F.col("wave") == 0
    classes = rows.groupBy(*cols, fixed.alias("fixed")).agg(F.min("ord").alias("ord"), F.max("ord").alias("last"))
    classes = _written(classes.withColumn("k", F.when(F.col("fixed"), key)), "classes")
    firsts = classes.where("k is not null").groupBy("k").agg(F.max("last").alias("stands"))
    same = _written(classes.where("fixed").join(firsts.hint("merge"), "k", "left").select("ord", "stands"), "stands")
    pairs = _written(match_candidates(classes), "pairs")
    state = _written(classes.select("ord", F.when(F.col("fixed"), True).alias("is_root")), "roots")
    # Merge joins: what is broadcast would lie in the driver, once a round.
    for _ in range(rounds):
        known = pairs.where("root < ord").join(state.select(F.col("ord").alias("root"), F.col("is_root").alias("r")).hint("merge"), "root")
        seen = known.groupBy("ord").agg(F.max(F.coalesce("r", F.lit(False))).alias("some"), F.max(F.col("r").isNull()).alias("open"))
        now = F.when(F.col("is_root").isNotNull(), F.col("is_root")).when(F.coalesce("some", F.lit(False)), F.lit(False)).when(~F.coalesce("open", F.lit(False)), F.lit(True))
        state = _written(state.join(seen.hint("merge"), "ord", "left").select("ord", now.alias("is_root")), "roots")
        if state.where("is_root is null").isEmpty():
            break
    else:
        raise RuntimeError(f"merging did not settle in {rounds} rounds")
    roots = state.where("is_root").select(F.col("ord").alias("root"))
    # Of the roots that a class meets in one way the first is before the others, for all of its rows: a class has a few ways.
    first = pairs.join(roots.hint("merge"), "root").groupBy("ord", "how").agg(F.min("root").alias("root"))
    # A root of the first source may stand for several rows of one key: the last of them.
    first = first.join(same.withColumnsRenamed({"ord": "root"}).hint("merge"), "root", "left")
    ways = first.groupBy("ord").agg(F.collect_list(F.struct("how", "root", F.coalesce("stands", "root").alias("into"))).alias("ways"))
    ways = classes.where("not fixed").join(ways.hint("merge"), "ord").select(*(F.col(c).alias(f"__{c}") for c in cols), "ways")
    label = lambda i: F.create_map(*(F.lit(x) for m in METHODS for x in (m[0], m[i])))[F.col("b.how.rank")]
    met = rows.withColumn("__free", F.col("wave") > 0)
    met = met.join(ways.hint("merge"), reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in cols), F.col("__free")), "left")
    met = met.withColumn("b", F.array_min(F.filter("ways", lambda w: w["root"] < F.col("ord")))).withColumn("__k", F.when(fixed, key))
    out = met.join(firsts.withColumnsRenamed({"k": "__own"}).hint("merge"), F.col("__k") == F.col("__own"), "left")
    return out.select(*rows.columns, F.coalesce("b.into", "stands", "ord").alias("root"), label(1).alias("method"), label(2).alias("confidence"))


def resolve_in_order(rows: list[dict]) -> dict[int, tuple[int, int | None]]:
    """The same, one row after another, for small inputs: ord -> (root, rank). rows carry their index keys and probes."""
    index: dict[str, list[int]] = {}
    out: dict[int, tuple[int, int | None]] = {}
    for row in sorted(rows, key=lambda r: r["ord"]):
        hits = []
        if row["wave"] > 0:
            for p in row["probes"]:
                for root in index.get(p["key"], []):
                    if p["rank"] != 9 or row["fuzzy"](root):
                        hits.append(((5 if p["rank"] in (5, 6) else p["rank"], p["place"], p["rank"]), root))
        if hits:
            how, root = min(hits)
            out[row["ord"]] = (root, how[2])
        else:
            out[row["ord"]] = (row["ord"], None)
            for k in row["keys"]:
                index.setdefault(k, []).append(row["ord"])
    return out


def source_histogram(rows: DataFrame, sources: str = "sources") -> DataFrame:
    """AGG-05: rows per element of an array column."""
    return rows.select(F.explode(sources).alias("source")).groupBy("source").agg(F.count("*").alias("n"))


def merge_counters(rows: DataFrame) -> DataFrame:
    """AGG-06: per wave, rows that merged and rows that are new."""
    return rows.groupBy("wave").agg(F.count_if(F.col("root") != F.col("ord")).alias("merged"), F.count_if(F.col("root") == F.col("ord")).alias("new"))


#: Merge effects, by the kind of source: fields that fill a blank (the first value stays), and fields of which the last
#: value that isn't empty counts.
FILLS = {"encyclopedia": ["plot_summary"], "yearlist": ["wiki_director", "wiki_cast", "production_company"]}
REPLACES = {"encyclopedia": ["wiki_url", "categories"]}


def _present(c: str, kind: str) -> Column:
    return F.size(c) > 0 if kind.startswith("array") else text(F.col(c).cast("string")) != ""


def unified(resolved: DataFrame, source: str = "source") -> DataFrame:
    """SURVEY 2.8, merge effects; AGG-14: per root one row in which all rows that merged into it took effect.

    Title and year are the root's own; sources are distinct, in order. Rows of the encyclopedia fill a blank plot and
    replace address and categories; those of year lists fill blank director, cast and company; those of any other
    source but the first one are platforms, each an entry of `platforms`. Method and confidence are those of the last
    inexact merge of the first two kinds, after which a platform's count only if its confidence is higher. Fields that
    the rows lack are left out.
    """
    kinds = dict(resolved.dtypes)
    of = lambda kind: F.col(source) == kind
    listed = of("encyclopedia") | of("yearlist")
    platform = ~listed & (F.col("wave") > 0)
    inexact = (F.col("confidence") < 95) & listed
    picks = {c: (F.min_by, F.lit(True)) for c in ("title", "year")} | {"director": (F.min_by, text(F.col("director")) != "")}
    picks |= {c: (F.min_by, of(k) & _present(c, kinds[c])) for k, names in FILLS.items() for c in names if c in kinds}
    picks |= {c: (F.max_by, of(k) & _present(c, kinds[c])) for k, names in REPLACES.items() for c in names if c in kinds}
    picks |= {c: (F.max_by, inexact) for c in ("method", "confidence")}
    shown = [c for c in ("platform_url", "thumbnail_url", "banner_url") if c in kinds]
    ends = {F.min_by: F.min, F.max_by: F.max}
    # By root and source first: of a root's rows one for each source meets the others, with its platforms' entries.
    each = resolved.groupBy("root", F.col(source).alias("__source")).agg(
        F.min("ord").alias("__ord"), *(by(c, F.when(ok, F.col("ord"))).alias(c) for c, (by, ok) in picks.items()),
        *(ends[by](F.when(ok, F.col("ord"))).alias(f"__ord_{c}") for c, (by, ok) in picks.items()),
        F.collect_list(F.when(platform, F.struct("ord", F.col(source).alias("platform"), *shown))).alias("platforms"),
        F.max(F.when(platform & (F.col("confidence") < 95), F.struct("confidence", (-F.col("ord")).alias("o"), "method"))).alias("p"),
    )
    rows = each.groupBy("root").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col("__ord"), F.col("__source")))), lambda s: s["__source"]).alias("sources"),
        *(by(c, f"__ord_{c}").alias({"method": "m", "confidence": "c"}.get(c, c)) for c, (by, _) in picks.items()),
        F.transform(F.array_sort(F.flatten(F.collect_list("platforms"))), lambda s: F.struct(s["platform"].alias("platform"), *(s[c].alias(c) for c in shown))).alias("platforms"), F.max("p").alias("p"),
    )
    up = F.coalesce(F.col("p.confidence") > F.coalesce("c", F.lit(0)), F.lit(False))
    fields = [c for names in (*FILLS.values(), *REPLACES.values()) for c in names if c in kinds]
    return rows.select(
        "root", "title", "year", "director", *fields, "platforms", "sources", F.when(up, F.col("p.method")).otherwise(F.col("m")).alias("method"),
        F.when(up, F.col("p.confidence")).otherwise(F.col("c")).alias("confidence"),
    )
