"""Queries that run the library's sources, sinks, parsers and steps, each with its result in DuckDB SQL.

Their inputs are built from the shared tables by SQL expressions that both engines read alike (_PARTS and the like); what
a reader has to read is written to the shared folder first. The SQL says what has to come out, mostly from the columns
that went in.
"""

from __future__ import annotations

import gzip

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions import text as T
from ..functions import udfs
from ..functions import wikitext as W
from ..functions.dims import languages
from ..operators import catalog, crawl, dedup, enrich, matching, robots, tags
from ..session import shared_path, table
from ..sources import readers, sinks
from ..streaming import limits
from .queries import _SWAPS, ORACLE_SQL, QUERIES, _norm, _waves, query

__all__ = ["ORACLE_SQL", "QUERIES"]


def _joined(c, by: str = "|"):
    return F.array_join(c, by)


def _part(spark, d, **exprs: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", *(F.expr(e).alias(k) for k, e in exprs.items()))


def _lines(df: DataFrame, spark, name: str, *cols: str) -> str:
    """The rows written as lines of JSON, fields in this order; the path."""
    path = shared_path(spark, name)
    df.select(F.to_json(F.struct(*cols)).alias("value")).write.text(path)
    return path


# --- files of separated values ---

@query("""SELECT 'strict' AS kind, 'tt' || p_partkey AS tconst, p_size + 0.5::DOUBLE AS rating, p_size * 3 AS votes FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0
    UNION ALL SELECT 'lenient', 'tt' || p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size + 0.5 END, CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_size * 3 END FROM part""")
def source_ratings(spark, d):
    """SRC-01, SRC-01b."""
    path = shared_path(spark, "ratings")
    rows = _part(spark, d, rating="CASE WHEN p_partkey % 7 = 0 THEN '\\\\N' ELSE concat(p_size, '.5') END", votes="CASE WHEN p_partkey % 11 = 0 THEN 'many' ELSE string(p_size * 3) END")
    rows.select(F.concat(F.lit("tt"), "p_partkey").alias("tconst"), "rating", "votes").write.csv(path, sep="\t", header=True, quote="", escape="", compression="gzip")
    both = [readers.ratings(spark, path, lenient=x).select(F.lit(k).alias("kind"), "*") for k, x in (("strict", False), ("lenient", True))]
    return both[0].unionByName(both[1])


@query("""SELECT 'tt' || l_orderkey AS tconst, string_agg(s_name || '/' || ch || '/' || l_returnflag, '|' ORDER BY l_linenumber, s_name, ch, l_returnflag) AS members
    FROM (SELECT *, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'C' || l_partkey || ', D' END AS ch FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey WHERE s_suppkey % 5 <> 0 GROUP BY l_orderkey""")
def source_casts(spark, d):
    """SRC-02, SRC-03, STR-05, JOIN-04, AGG-01."""
    names, principals = shared_path(spark, "names"), shared_path(spark, "principals")
    s = table(spark, d, "supplier")
    empty = [F.lit(r"\N").alias(c) for c in ("birth", "death", "professions", "known_for")]
    s.select(F.concat(F.lit("nm"), "s_suppkey").alias("nconst"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_name")).otherwise("").alias("name"), *empty).write.csv(names, sep="\t", header=True, quote="", escape="", emptyValue="")
    said = F.when(F.col("l_linenumber") % 3 == 0, r"\N").otherwise(F.concat(F.lit('["C'), "l_partkey", F.lit('","D"]')))
    rows = table(spark, d, "lineitem").select(
        F.concat(F.lit("tt"), "l_orderkey").alias("tconst"), F.col("l_linenumber").alias("ordering"), F.concat(F.lit("nm"), "l_suppkey").alias("nconst"), F.col("l_returnflag").alias("category"), F.lit(r"\N").alias("job"), said.alias("characters")
    )
    rows.write.csv(principals, sep="\t", header=True, quote="", escape="")
    casts = matching.names_of(readers.principals(spark, principals), readers.names(spark, names))
    return casts.select("tconst", _joined(F.transform("cast", lambda m: F.concat_ws("/", m["name"], m["character"], m["role"]))).alias("members"))


@query("SELECT 'tt' || p_partkey AS tconst, (1990 + p_size)::VARCHAR AS start_year FROM part WHERE p_partkey % 4 IN (1, 2) AND p_partkey % 5 <> 0")
def source_series(spark, d):
    """PRED-09."""
    path = shared_path(spark, "basics")
    kind = "element_at(array('movie', 'tvSeries', 'tvMiniSeries', 'short'), int(p_partkey % 4) + 1)"
    rows = _part(spark, d, k=kind, y="CASE WHEN p_partkey % 5 = 0 THEN '\\\\N' ELSE string(1990 + p_size) END", t="p_name")
    rest = [F.lit(r"\N").alias(c) for c in ("endYear", "runtime", "genres")]
    rows.select(F.concat(F.lit("tt"), "p_partkey").alias("tconst"), F.col("k").alias("titleType"), F.col("t").alias("primaryTitle"), F.col("t").alias("originalTitle"), F.lit("0").alias("isAdult"), F.col("y").alias("startYear"), *rest).write.csv(path, sep="\t", header=True, quote="", escape="")
    return readers.basics(spark, path).select("tconst", F.col("startYear").alias("start_year"))


# --- lines of JSON ---


@query("""SELECT 'kept' AS kind, p_partkey AS id, p_name AS title, p_brand || '|' || p_type AS genres FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 10 <> 3
    UNION ALL SELECT 'rejected', count(*), '', '' FROM part WHERE p_partkey % 9 = 0 OR p_partkey % 10 = 3""")
def source_titles(spark, d):
    """SRC-04, SRC-04b, PRED-18: broken lines and records without a title are rejected; the flat form's lists."""
    path = shared_path(spark, "titles")
    rows = _part(spark, d, tmdb_id="p_partkey", title="CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_name END", genres="concat(p_brand, ', ', p_type, '|')")
    rows.select(F.when(F.col("p_partkey") % 10 == 3, F.lit('{"tmdb_id": ')).otherwise(F.to_json(F.struct("tmdb_id", "title", "genres"))).alias("value")).write.text(path)
    kept, rejected = readers.titles(spark, path, flat=True)
    named = _joined(F.transform("genres", lambda g: g["name"]))
    kept = readers.adapt_flat(kept).select(F.lit("kept").alias("kind"), F.col("tmdb_id").alias("id"), "title", named.alias("genres"))
    return kept.unionAll(rejected.select(F.lit("x").alias("x")).agg(F.lit("rejected"), F.count("*"), F.lit(""), F.lit("")))


@query("""SELECT title, kind, year FROM (SELECT p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN 'film' ELSE 'tv' END AS kind, p_size::VARCHAR AS year, p_partkey FROM part WHERE p_partkey % 6 <> 0)
    UNION ALL SELECT s_name, 'year list', (1980 + s_suppkey % 9)::VARCHAR FROM supplier""")
def source_articles(spark, d):
    """SRC-05, SRC-06, SET-01: films and shows put together; year lists by a pattern of paths."""
    rows = _part(spark, d, title="CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_name END", type="CASE WHEN p_partkey % 2 = 0 THEN 'film' ELSE 'tv' END", year="string(p_size)")
    films, shows = (_lines(rows.where(f"type = '{k}'"), spark, k, "title", "type", "year") for k in ("film", "tv"))
    both = readers.articles(spark, films, shows).select("title", F.col("type").alias("kind"), "year")
    folder = shared_path(spark, "yearlists")
    s = table(spark, d, "supplier").select(F.col("s_name").alias("title"), (1980 + F.col("s_suppkey") % 9).cast("int").alias("year"), (F.col("s_suppkey") % 2).alias("half"))
    for i in range(2):
        s.where(F.col("half") == i).select(F.to_json(F.struct("title", "year")).alias("value")).write.text(f"{folder}/{i}.jsonl")
    lists = readers.year_films(spark, f"{folder}/*.jsonl")
    return both.unionAll(lists.select("title", F.lit("year list"), F.col("year").cast("string")))


@query("SELECT CASE WHEN p_partkey % 2 = 0 THEN 'aha' ELSE 'zee5' END AS platform, p_name AS title, lower(p_brand) AS language, (p_partkey % 2)::INTEGER * 2 AS file FROM part WHERE p_partkey % 6 <> 0")
def source_streaming(spark, d):
    """SRC-07: a file for each platform; one that is missing gives nothing."""
    folder = shared_path(spark, "streaming")
    rows = _part(spark, d, title="CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_name END", language="upper(p_brand)")
    for i, p in enumerate(("aha", "zee5")):
        rows.where(F.col("p_partkey") % 2 == i).select(F.to_json(F.struct("title", "language")).alias("value")).write.text(f"{folder}/{p}.jsonl")
    return readers.streaming_records(spark, folder, ["aha", "hotstar", "zee5"]).select("platform", "title", "language", "file")


@query("SELECT region, name, shown, kind FROM (SELECT r_name AS region, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'live' ELSE 'scrape' END AS shown, 'platform' AS kind FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'chain ' || r_regionkey, 'list', 'chain' FROM region)")
def source_registry(spark, d):
    """SRC-21."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    entry = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "live").otherwise("").alias("status"), F.lit("scrape").alias("strategy"))
    platforms = n.groupBy("r_name").agg(F.collect_list(entry).alias("l")).agg(F.map_from_entries(F.collect_list(F.struct("r_name", "l"))).alias("ott_platforms"))
    chain = F.struct(F.concat(F.lit("chain "), "r_regionkey").alias("name"), F.lit("list").alias("strategy"))
    chains = table(spark, d, "region").groupBy("r_name").agg(F.collect_list(chain).alias("l")).agg(F.map_from_entries(F.collect_list(F.struct("r_name", "l"))).alias("cinema_chains"))
    path = shared_path(spark, "registry")
    platforms.crossJoin(chains).select(F.to_json(F.struct("ott_platforms", "cinema_chains")).alias("value")).coalesce(1).write.text(path)
    a, b = readers.registry(spark, path)
    return a.withColumn("kind", F.lit("platform")).unionAll(b.withColumn("kind", F.lit("chain")))


@query("SELECT 'kept' AS kind, o_orderkey AS id FROM orders WHERE o_totalprice >= 200000 AND o_orderkey > 0 AND o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-26' AND DATE '1998-06-30') UNION ALL SELECT 'skipped', o_orderkey FROM orders WHERE NOT (o_totalprice >= 200000 AND o_orderkey > 0) AND o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-26' AND DATE '1998-06-30')")
def source_export(spark, d):
    """SRC-09, SRC-10, PRED-08."""
    e = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("popularity"))
    kept, skipped = readers.export_ids(e, 200_000.0, "1998-06-30")
    return kept.select(F.lit("kept").alias("kind"), "id").unionAll(skipped.select(F.lit("skipped"), "id"))


@query("SELECT strftime(x::DATE - i::INTEGER, '%m_%d_%Y') AS day, k FROM (SELECT min(o_orderdate) AS x, o_custkey AS k FROM orders GROUP BY o_custkey), range(5) t(i)")
def export_days(spark, d):
    """DATE-05."""
    firsts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.to_date(F.min("o_orderdate")).alias("x"))
    return firsts.select(F.explode(T.export_dates(F.col("x"))).alias("day"), "k")


@query("SELECT 'entry' AS kind, p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS said FROM part WHERE p_partkey > 0 UNION ALL SELECT 'url', -p_partkey, 'http://h/' || p_partkey FROM part WHERE p_partkey % 2 = 0")
def source_entries(spark, d):
    """SRC-14, SRC-15."""
    rows = _part(spark, d, tmdb_id="p_partkey", title="CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END", name="p_brand", line="CASE WHEN p_partkey % 2 = 0 THEN concat('  http://h/', p_partkey, ' ') ELSE '# none' END")
    path = shared_path(spark, "urls")
    rows.select("line").write.text(path)
    urls = readers.url_list(spark, path).select(F.lit("url"), -F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"), "url")
    return readers.availability_entries(rows).select(F.lit("entry").alias("kind"), F.col("tmdb_id").alias("id"), F.col("title").alias("said")).unionAll(urls)


@query("SELECT key, value FROM (VALUES ('workers', '3'), ('port', '50051'), ('mode', 'cloud'), ('data_dir', './data'), ('A', 'kept'), ('B', 'x = y')) t(key, value)")
def settings(spark, d):
    """SRC-24, SRC-25."""
    env = readers.env_file("# none\n\nMODE=cloud\nWORKERS = 3\nA=new\nB=x = y\nnothing", {"A": "kept"})
    got = readers.Settings.load(env)
    rows = [(k, str(getattr(got, k))) for k in ("workers", "port", "mode", "data_dir")] + [(k, env[k]) for k in ("A", "B")]
    return spark.createDataFrame(rows, "key string, value string")


# --- nested answers ---

_BODY = """'{"id": ' || p_partkey || ', "imdb_id": "tt' || p_partkey || '", "title": "' || p_name || '", "name": "' || p_brand || '", "original_title": "o", "release_date": "1999-01-02", "runtime": ' || p_size || ', "genres": [{"id": 1, "name": "g"}],
 "credits": {"cast": [{"id": 0, "name": "zero"}, {"id": 7, "name": "' || p_type || '"}, {"id": "x", "name": "bad"}, {"id": 8, "name": 5}, 3], "crew": [{"id": 3, "job": "Director", "name": "D"}, {"id": 3, "job": "Director", "name": "E"}, {"id": 3, "job": "Writer", "name": "F"}, {"id": 0, "job": "Writer", "name": "G"}]},
 "keywords": {"keywords": [{"id": 1, "name": "m' || p_size || '"}], "results": [{"id": 2, "name": "s"}]}, "videos": {"results": [{"site": "YouTube", "key": "k' || p_partkey || '", "type": "Trailer"}, {"site": "Other", "key": "z", "type": "Clip"}]},
 "similar": {"results": [{"id": 4, "title": "like", "name": "alike"}]}, "release_dates": {"results": [{"iso_3166_1": "US", "release_dates": [{"certification": ""}, {"certification": "PG"}]}, {"iso_3166_1": "FR", "release_dates": []}]},
 "content_ratings": {"results": [{"iso_3166_1": "GB", "rating": "15"}, {"iso_3166_1": "FR", "rating": ""}]}, "external_ids": {"imdb_id": "' || CASE WHEN p_partkey % 2 = 0 THEN 'tt9' ELSE '' END || '", "instagram_id": "i"},
 "watch/providers": {"results": {"IN": {"flatrate": [{"provider_id": 1}]}, "QQ": {}}}, "also_known_as": ["a"], "gender": 2, "place_of_birth": "here", "biography": "b' || p_size || '"}'"""


def _bodies(spark, d):
    return _part(spark, d, body=_BODY.replace("\n", ""))


_SHOWN = "concat_ws('/', p_type, 'Director D,Writer F', {kw}, 'https://www.youtube.com/watch?v=k' || p_partkey || ',', {similar}, {rated}, CASE WHEN p_partkey % 2 = 0 THEN 'tt9' ELSE 'none' END, 'IN', 1)"


@query(f"""SELECT p_partkey AS id, 'movie' AS kind, p_name AS title, {_SHOWN.format(kw="'m' || p_size", similar="'like'", rated="'US PG'")} AS said FROM part
    UNION ALL SELECT p_partkey, 'tv', p_brand, {_SHOWN.format(kw="'s'", similar="'alike'", rated="'GB 15'")} FROM part""")
def payload_titles(spark, d):
    """SRC-11, SRC-12, JSON-01..03, AGG-15, AGG-16, STR-29, MAP-01, PRED-10, PRED-11."""
    out = None
    for kind, name in (("movie", "title"), ("tv", "name")):
        r = readers.payload(_bodies(spark, d), kind)
        words = lambda c, *f: F.array_join(F.transform(c, lambda x: F.concat_ws(" ", *(x[k] for k in f))), ",")
        said = F.concat_ws(
            "/", words("cast", "name"), words("crew", "job", "name"), words("keywords", "name"), words("videos", "url"), words("similar", "title"), words("certifications", "country", "certification"),
            F.coalesce(F.col("external_ids.imdb_id"), F.lit("none")), _joined(F.map_keys(catalog.kept_countries(F.col("watch_providers"), ["IN", "US"]))), F.size(catalog.trailers(F.col("videos"))).cast("string"),
        )
        rows = r.select(F.col("tmdb_id").alias("id"), F.lit(kind).alias("kind"), F.col(name).alias("title"), said.alias("said"))
        out = rows if out is None else out.unionAll(rows)
    return out


@query("SELECT p_partkey AS id, p_brand AS name, CASE WHEN p_partkey % 2 = 0 THEN 'tt9' ELSE 'tt' || p_partkey END AS imdb_id, 'b' || p_size AS biography, 2 AS gender FROM part")
def payload_persons(spark, d):
    """SRC-13."""
    return readers.person_payload(_bodies(spark, d)).select(F.col("tmdb_id").alias("id"), "name", "imdb_id", "biography", "gender")


@query("SELECT s_suppkey AS cinema_id, f AS film_id, 'Film ' || f || ' ' || s_name AS film_name, CASE f WHEN 'f1' THEN '10:00 a/12:30 b' ELSE '' END AS times FROM supplier, (VALUES ('f1'), ('f2')) t(f)")
def payload_cinemas(spark, d):
    """SRC-20, JOIN-08."""
    body = """concat('{"body": {"films": [{"id": "f1", "name": "Film f1 ', s_name, '", "length": 90}, {"id": "f2", "name": "Film f2 ', s_name, '"}], "events": [{"id": "2", "filmId": "f1", "eventDateTime": "12:30", "auditorium": "b"}, {"id": "1", "filmId": "f1", "eventDateTime": "10:00", "auditorium": "a"}]}}')"""
    films, events = readers.cinema_payload(table(spark, d, "supplier").select(F.col("s_suppkey").alias("cinema_id"), F.expr(body).alias("body")))
    out = matching.with_showtimes(films, events, ["cinema_id", "film_id"], ["time", "auditorium"])
    times = F.coalesce(_joined(F.transform("showtimes", lambda s: F.concat_ws(" ", s["time"], s["auditorium"])), "/"), F.lit(""))
    return out.select("cinema_id", "film_id", "film_name", times.alias("times"))


# --- markup ---

_KIND = "CASE WHEN p_partkey % 5 = 4 THEN 'none' WHEN p_partkey % 5 = 3 THEN 'category' WHEN p_partkey % 2 = 0 THEN 'film' ELSE 'tv' END"
_MARKUP = f"""CASE {_KIND} WHEN 'film' THEN 'x {{{{Infobox film' || chr(10) || '| name = {{{{a|{{{{b|{{{{c|{{{{d|{{{{e}}}}}}}}}}}}}}}}}}}}' || chr(10) || '| director = [[P|' || p_brand || ']]<br/>Co' || chr(10) || '| starring = [[Ann]], Bob ' || p_size || chr(10) || '| country =' || chr(10) || '| released = ' || (1980 + p_size) || chr(10) || '}}}}'
    WHEN 'tv' THEN '{{{{Infobox television' || chr(10) || '| creator = ' || p_brand || chr(10) || '| first_aired = May ' || (1980 + p_size) || chr(10) || '| num_seasons = ' || p_size || chr(10) || '}}}}' ELSE '' END
    || chr(10) || '== Plot ==' || chr(10) || 'Some ''''plot'''' of [[link|' || p_name || ']].' || chr(10) || '== Cast ==' || chr(10) || CASE {_KIND} WHEN 'category' THEN '[[Category:Indian films]]' WHEN 'none' THEN '[[Category:Birds]]' ELSE '[[Category:' || p_type || '|k]]' END"""
_XML = f"""'<page><title>' || p_name || ' ' || p_partkey || '</title><ns>' || CASE WHEN p_partkey % 7 = 6 THEN '1' ELSE '0' END || '</ns><id>' || p_partkey || '</id>' || CASE WHEN p_partkey % 11 = 10 THEN '<redirect title="q" />' ELSE '' END || '<revision><id>9</id><text xml:space="preserve">' || replace(replace({_MARKUP}, '&', '&amp;'), '<', '&lt;') || '</text></revision></page>'"""


def _dump(spark, d):
    """Eight files, each a document of its own."""
    path = shared_path(spark, "dump")
    files = _part(spark, d, value=_XML).groupBy(F.col("p_partkey") % 8).agg(F.array_join(F.collect_list("value"), chr(10)).alias("pages"))
    files.select(F.concat(F.lit("<mediawiki>"), "pages", F.lit("</mediawiki>"))).write.option("maxRecordsPerFile", 1).text(path)
    return readers.dump(spark, path)


_DUMPED = "p_partkey % 7 <> 6 AND p_partkey % 11 <> 10"


@query(f"""SELECT p_partkey AS page_id, p_name || ' ' || p_partkey AS title, 'https://en.wikipedia.org/wiki/' || replace(p_name || ' ' || p_partkey, ' ', '_') AS url, CASE WHEN k = 'tv' THEN 'tv' ELSE 'film' END AS type,
    CASE WHEN k = 'category' THEN '' ELSE (1980 + p_size)::VARCHAR END AS year, CASE k WHEN 'film' THEN p_brand || ', Co' ELSE '' END AS director, CASE k WHEN 'film' THEN 'Ann|Bob ' || p_size ELSE '' END AS starring, '' AS country,
    CASE k WHEN 'tv' THEN p_brand ELSE '' END AS creator, CASE k WHEN 'tv' THEN p_size::VARCHAR ELSE '' END AS num_seasons, 'Some plot of ' || p_name || '.' AS plot, CASE k WHEN 'category' THEN 'Indian films' ELSE p_type END AS categories, sha256(m) AS content_hash
    FROM (SELECT *, {_KIND} AS k, {_MARKUP} AS m FROM part) WHERE {_DUMPED} AND k <> 'none'""")
def dump_articles(spark, d):
    """SRC-08, PRED-06, PRED-07, STR-14, STR-15, STR-21..24, STR-28, MAP-02, DATE-03."""
    return readers.dump_articles(_dump(spark, d)).select(
        "page_id", "title", "url", "type", "year", "director", _joined("starring").alias("starring"), "country", "creator", "num_seasons", F.col("plot_summary").alias("plot"), _joined("categories").alias("categories"), "content_hash",
    )


@query(f"SELECT 'https://en.wikipedia.org/wiki/' || replace(p_name || ' ' || p_partkey, ' ', '%20') AS url, CASE {_KIND} WHEN 'film' THEN 'x ' || chr(10) ELSE '' END || 'Plot' || chr(10) || 'Some plot of ' || p_name || '.' || chr(10) || 'Cast' AS text, sha256({_MARKUP}) AS content_hash, 0 AS depth FROM part WHERE {_DUMPED}")
def dump_as_pages(spark, d):
    """STM-13, STR-16, STR-24, LIM-04."""
    return readers.dump_pages(_dump(spark, d), "p", "c").select("url", "text", "content_hash", "depth")


_ODD = r"""'= Top =' || chr(10) || '==  ' || p_name || ' == ' || chr(10) || 'a' || chr(9) || 'b  c [[t|' || p_brand || ']] [[plain]]<ref name="r" /> d<ref>gone' || chr(10) || '</ref> ''''''bold'''''' ''''it'''' [http://x/y ' || p_size || ' z] [https://q] __NOTOC__ {{t|{{u}}|v}}{|' || chr(10) || 'row |}[[File:f.jpg|thumb]][[Category:Q]] [[category:q]] <!-- c' || chr(10) || '--><b>&eacute;&amp;</b> {| open' || chr(10) || chr(10) || chr(10) || chr(10) || 'end }}'"""


@query(r"SELECT p_partkey, '= Top =' || chr(10) || p_name || chr(10) || 'a' || chr(9) || 'b c ' || p_brand || ' plain d bold it ' || p_size || ' z category:q é& {| open' || chr(10) || chr(10) || 'end }}' AS text FROM part")
def markup_stripped(spark, d):
    """STR-16, STR-17, STR-18: levels 2 to 6 are headings, case counts, what isn't closed stays."""
    return _part(spark, d, m=_ODD.replace("''''''", "'''''''").replace("'''''''bold'''''''", "''''''bold''''''")).select("p_partkey", W.strip_wikitext(F.col("m")).alias("text"))


# --- texts ---

_URLS = {
    "plain": "'https://user:pw@H' || p_size || '.example:8080/a%20b/' || p_size || '?q=%20#f'",
    "odd": "'http://h' || p_size || '/p|q'",
    "bare": "'http://h' || p_size",
    "broken": "'http://h/100%/' || p_size",
    "none": "'no address'",
}


@query(f"""SELECT p_partkey, kind, CASE kind WHEN 'plain' THEN 'H' || p_size || '.example:8080' WHEN 'odd' THEN 'h' || p_size WHEN 'bare' THEN 'h' || p_size WHEN 'broken' THEN 'h' ELSE '' END AS host,
    CASE kind WHEN 'plain' THEN '/a b/' || p_size || '?q=%20' WHEN 'odd' THEN '/p|q' WHEN 'bare' THEN '/' WHEN 'broken' THEN '/100%/' || p_size ELSE 'no address' END AS path
    FROM part, (VALUES {", ".join(f"('{k}')" for k in _URLS)}) t(kind)""")
def address_parts(spark, d):
    """STR-26, STR-27."""
    rows = table(spark, d, "part").select("p_partkey", F.explode(F.create_map(*(x for k, v in _URLS.items() for x in (F.lit(k), F.expr(v))))).alias("kind", "u"))
    return rows.select("p_partkey", "kind", T.host(F.col("u")).alias("host"), T.robots_path(F.col("u")).alias("path"))


_HREFS = {"../c/x#f": "http://h.example/c/x", "#x": "-", "mailto:a@b": "-", "//o.example/y": "http://o.example/y", "?q=1": "http://h.example/a/b?q=1", " /z ": "http://h.example/z", "javascript:0": "-", "ftp://h/x": "-"}


@query(f"SELECT p_partkey, href, CASE WHEN want = '-' THEN NULL ELSE replace(want, 'h.example', 'h' || p_size || '.example') END AS resolved FROM part, (VALUES {', '.join(f'({a!r}, {b!r})' for a, b in _HREFS.items())}) t(href, want)")
def addresses_resolved(spark, d):
    """STR-25."""
    rows = _part(spark, d, base="'http://h' || p_size || '.example/a/b?x=y'").withColumn("href", F.explode(F.array(*map(F.lit, _HREFS))))
    return rows.select("p_partkey", "href", udfs.resolve_url(F.col("base"), F.col("href")).alias("resolved"))


@query("""SELECT p_partkey, p_brand || '/' || p_type || '/actor|' || p_name || '//actor' AS members, p_brand || '|' || p_name AS names, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_name END AS other, p_name || ' & x' AS cell,
    CASE WHEN length(p_brand) > 1 THEN p_name || '|' || p_brand ELSE p_name END AS listed, CASE WHEN p_size % 3 = 0 THEN 'https://www.youtube.com/watch?v=k' || p_size ELSE '' END AS video,
    ['movie', 'webseries', 'webepisode', 'show', 'unknown'][p_size % 5 + 1] AS kind, p_size % 2 = 1 AS same, p_size % 5 IN (0, 3) AS content, p_size % 12 = 4 AS month, 'Ann ' || p_size || '|Shown' AS anchors,
    p_brand AS unescaped FROM part""")
def text_fields(spark, d):
    """STR-09..13, STR-18..20, STR-29, STR-30, PRED-04, PRED-05, PRED-16."""
    q = lambda s: F.expr(s)
    p = table(spark, d, "part")
    page = q("concat('http://h/', element_at(array('movie', 'webseries', 'webepisode', 'show', 'other'), p_size % 5 + 1), '/1')")
    month = q("CASE WHEN p_size % 12 = 4 THEN 'MAY' ELSE concat('MAY', p_size) END")
    anchors = q("""concat('<a href="#" title="t">Ann ', p_size, '</a> <a title="Shown" href="x"><i></i></a><a title="u">ann ', p_size, '</a><a title="MAY">MAY</a><a>no title</a><a title="12">12345</a>')""")
    members = T.parse_cast(q("concat(p_brand, ' as ', p_type, '|', p_name, '| ')"))
    return p.select(
        "p_partkey", _joined(F.transform(members, lambda m: F.concat_ws("/", m["name"], m["character"], m["role"]))).alias("members"),
        _joined(T.cast_names(q("concat(p_brand, ' as ', p_type, '|', p_name, '| ')"))).alias("names"), T.if_other(F.col("p_name"), q("CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'z' END")).alias("other"),
        P.clean_cell(q("concat('<b>', p_name, '</b>[1] &amp;  <i>x</i> ')")).alias("cell"), _joined(T.split_names(q("concat(p_name, ' , ', p_brand, chr(10), 'q')"))).alias("listed"),
        T.video_url(q("CASE WHEN p_size % 3 = 0 THEN 'YouTube' ELSE 'Other' END"), q("concat('k', p_size)")).alias("video"), T.content_type(page).alias("kind"),
        T.same_language(q("upper(p_brand)"), q("CASE WHEN p_size % 2 = 1 THEN lower(p_brand) ELSE 'x' END")).alias("same"), T.any_part(page, ["/movie/", "/show/"]).alias("content"),
        T.is_month(month).alias("month"), _joined(P.anchor_names(anchors)).alias("anchors"), udfs.html_unescape(q("replace(p_brand, '#', '&#35;')")).alias("unescaped"),
    )


@query("SELECT code, name, array_to_string(words, ',') AS words, (SELECT count(*) FROM documents WHERE lang = code) AS n FROM (VALUES ('en', 'English', ['english-language', 'american', 'british']), ('fr', 'French', ['french']), ('de', 'German', ['german']), ('es', 'Spanish', ['spanish'])) t(code, name, words) WHERE n > 0")
def language_titles(spark, d):
    """PRED-01, SORT-01: the languages in order of code, and each one's titles."""
    known = languages(spark).select("code", "name", _joined("wiki_words", ",").alias("words"))
    docs = table(spark, d, "documents")
    one = lambda code: docs.where(F.col("lang") == code).agg(F.lit(code).alias("lang"), F.count("*").alias("n"))
    counts = one("en").unionAll(one("fr")).unionAll(one("de")).unionAll(one("es")).where("n > 0")
    return F.broadcast(known).join(counts, F.col("code") == F.col("lang")).select("code", "name", "words", "n")


# --- pages ---

_YEAR_PAGE = """'<table><th>Opening</th><th>x</th><th>Title</th><tr><td>MARCH</td><td>5</td><td>Film <i>' || n_name || '</i>[1]</td><td>Dir ' || n_nationkey || '</td><td><a title="t" href="#">no</a> <a title="Ann B">Ann B</a></td><td>Made</td></tr><tr><td>6</td><td>Two &amp; ' || n_name || '</td><td>D2</td><td>Cy, Di</td><td>[2]</td></tr></table><table><th>a</th></table><table><th>Film</th><th>b</th><th>c</th><tr><td>7</td><td>Three</td><td>D3</td></tr></table>'"""


@query("""SELECT n_nationkey, 'Film ' || n_name AS title, 'Dir ' || n_nationkey AS director, 'Ann B' AS members, 'Made' AS company, 'March' AS month FROM nation
    UNION ALL SELECT n_nationkey, 'Two & ' || n_name, 'D2', 'Cy|Di', '', 'March' FROM nation UNION ALL SELECT n_nationkey, 'Three', 'D3', '', '', 'March' FROM nation""")
def year_pages(spark, d):
    """HTML-02, WIN-02, STR-13, STR-20, SRC-19: of the patterns tried, the first that has films."""
    n = table(spark, d, "nation")
    tried = n.select("n_nationkey", F.lit(1).alias("pattern"), F.lit("<table><th>a</th></table>").alias("html")).unionAll(n.select("n_nationkey", F.lit(2), F.expr(_YEAR_PAGE))).unionAll(n.select("n_nationkey", F.lit(3), F.expr(_YEAR_PAGE)))
    found = P.first_pattern(P.year_tables(tried, ["n_nationkey", "pattern"]), ["n_nationkey"])
    return found.select("n_nationkey", "title", "director", _joined("cast").alias("members"), F.col("production_company").alias("company"), F.col("release_month").alias("month"))


_LD = """'<html><title> P' || p_size || ' </title><meta property="og:image" content="a&amp;b' || p_size || '"><meta name="og:description" content="d"><script type="application/ld+json"> {"@type": "Movie", "name": "' || p_name || '", "image": "i' || p_size || '", "genre": ["g", "' || p_brand || '"], "actor": [{"name": "A"}, {"x": 1}], "director": {"name": "' || p_type || '"}, "typicalAgeRange": "13", "datePublished": "in 2011", "potentialAction": {"target": [{"inLanguage": "te"}], "expectsAcceptanceOf": {"name": "free plan"}}} </script><script type="application/ld+json">{broken</script><script type="application/ld+json">[{"@type": "VideoObject", "name": "' || CASE WHEN p_partkey % 2 = 0 THEN 'Later' ELSE '' END || '", "uploadDate": "2019-01-01"}, {"@type": "Other", "name": "no"}]</script>'"""


def _ld_pages(spark, d):
    return _part(spark, d, html=f"CASE WHEN p_partkey % 10 = 9 THEN '<title>Only</title>' ELSE {_LD} END")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 10 = 9 THEN 'Only' WHEN p_partkey % 2 = 0 THEN 'Later' ELSE p_name END AS title, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'd' END AS description, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'a&b' || p_size END AS banner,
    CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'i' || p_size END AS thumbnail, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'te' END AS language, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE '2011' END AS year, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'movie' END AS kind,
    CASE WHEN p_partkey % 10 = 9 THEN '' ELSE 'free' END AS paid, CASE WHEN p_partkey % 10 = 9 THEN '' ELSE p_type END AS director, CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE 'g|' || p_brand END AS genres, CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE 'A' END AS members FROM part""")
def page_records(spark, d):
    """HTML-03, JSON-04..06, DATE-04."""
    r = P.page_records(_ld_pages(spark, d), ["p_partkey"])
    return r.select(
        "p_partkey", "title", "description", F.col("banner_url").alias("banner"), F.col("thumbnail_url").alias("thumbnail"), "language", "year", F.col("content_type").alias("kind"), F.col("free_or_paid").alias("paid"), "director",
        _joined("genres").alias("genres"), _joined("cast").alias("members"),
    )


@query("SELECT p_partkey, 'Movie|VideoObject|Other' AS types FROM part WHERE p_partkey % 10 <> 9")
def page_types(spark, d):
    """HTML-04, AGG-19."""
    return P.json_ld_types(_ld_pages(spark, d), ["p_partkey"]).select("p_partkey", _joined("types").alias("types"))


# --- robots and sitemaps ---

_ROBOTS = "'User-agent: *' || chr(10) || 'Disallow: /k' || n_nationkey % 3 || '/' || chr(10) || 'Allow: /k0/open' || chr(10) || 'Crawl-delay: ' || (1 + n_nationkey % 4) || chr(10) || 'Sitemap: http://h' || n_nationkey || '/map'"
_STATUS = "CASE n_nationkey % 5 WHEN 3 THEN 404 WHEN 4 THEN 503 ELSE 200 END"


@query(f"""SELECT 'h' || n_nationkey AS domain, path, CASE {_STATUS} WHEN 404 THEN true WHEN 503 THEN false ELSE NOT starts_with(path, '/k' || n_nationkey % 3 || '/') OR starts_with(path, '/k0/open') END AS allowed
    FROM nation, (VALUES ('/'), ('/k0/x'), ('/k0/open/y'), ('/k1/x y'), ('/k2/')) t(path) UNION ALL SELECT 'unasked', '/k0/x', true""")
def robots_verdicts(spark, d):
    """ROB-01, ROB-06, STR-27: answers decide, each domain's text is parsed once; paths are matched decoded."""
    n = table(spark, d, "nation")
    answers = n.select(F.concat(F.lit("h"), "n_nationkey").alias("domain"), F.expr(_STATUS).alias("status"), F.expr(_ROBOTS).alias("body"))
    paths = F.explode(F.array(*(T.robots_path(F.lit(f"http://h{p}")) for p in ("", "/k0/x", "/k0/open/y", "/k1/x%20y", "/k2/")))).alias("path")
    urls = answers.select("domain", paths).unionAll(spark.range(1).select(F.lit("unasked"), F.lit("/k0/x")))
    return robots.verdicts(urls, answers.unionAll(answers), "skeinbot").select("domain", "path", "allowed")


@query("SELECT 'h' || n_nationkey AS domain, (1 + n_nationkey % 4)::DOUBLE AS delay, 1.0::DOUBLE / (1 + n_nationkey % 4) AS rps, 'http://h' || n_nationkey || '/map' AS sitemap FROM nation")
def robots_delays(spark, d):
    """ROB-05, MATH-03, SRC-18."""
    found = robots.rules(table(spark, d, "nation").select(F.concat(F.lit("h"), "n_nationkey").alias("domain"), F.expr(_ROBOTS).alias("body")), "skeinbot")
    maps = found.where("kind = 'sitemap'").select("domain", F.col("value").alias("sitemap"))
    return robots.crawl_delay(found).join(maps, "domain").select("domain", "delay", "rps", "sitemap")


@query("SELECT 'h' || n_nationkey AS domain, true AS has_robots, 'http://h' || n_nationkey || '/map' AS sitemaps, true AS disallows_root, n_nationkey % 2 = 0 AS has_screenings, n_nationkey % 3 <> 2 AS has_api FROM nation")
def probe_reports(spark, d):
    """ROB-07."""
    kinds = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("X"), F.lit("MovieTheater"))).otherwise(F.array(F.lit("X")))
    api = F.element_at(F.array(F.lit(200), F.lit(403), F.lit(500)), F.col("n_nationkey") % 3 + 1)
    sites = table(spark, d, "nation").select(F.concat(F.lit("h"), "n_nationkey").alias("domain"), F.expr(_ROBOTS).alias("robots"), kinds.alias("types"), api.alias("api_status"))
    return robots.probe_report(sites).withColumn("sitemaps", _joined("sitemaps"))


def _sitemaps(spark, d):
    """An index over one sitemap a region, one of them an index itself, one broken, one missing; as fetched bytes."""
    n = table(spark, d, "nation")
    url = F.concat(F.lit("<url><loc> http://n/?r="), "n_regionkey", F.lit("&amp;n="), "n_name", F.lit(" </loc></url>"))
    maps = n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(url)), "").alias("urls"))
    named = lambda r: F.concat(F.lit("<?xml version='1.0'?><sm:urlset xmlns:sm='http://s'>"), F.regexp_replace(F.col("urls"), r"<(/?)(url|loc)>", "<$1sm:$2>"), F.lit("</sm:urlset>"))
    body = F.when(F.col("n_regionkey") == 1, named(0)).when(F.col("n_regionkey") == 2, F.concat(F.lit("<urlset>"), "urls")).otherwise(F.concat(F.lit("<urlset>"), F.regexp_replace("urls", r"<loc>(.*?)</loc>", "<loc>$1</loc>"), F.lit("</urlset>")))
    maps = maps.select(F.concat(F.lit("http://n/"), "n_regionkey").alias("loc"), F.encode(body, "UTF-8").alias("body"))
    index = "".join(f"<sitemap><loc>http://n/{i}</loc></sitemap>" for i in (3, 1, 2, 9, "more"))
    more = gzip.compress(b"<sitemapindex><sitemap><loc>http://n/0</loc></sitemap><sitemap><loc>http://n/packed</loc></sitemap></sitemapindex>", mtime=0)
    packed = gzip.compress(b"<urlset><url><loc><![CDATA[http://n/?a=1&b=2]]></loc></url><url><loc></loc></url></urlset>", mtime=0)
    own = [("http://n/", f"<sitemapindex>{index}</sitemapindex>".encode()), ("http://n/more", more), ("http://n/packed", packed)]
    return maps.unionAll(spark.createDataFrame(own, "loc string, body binary"))


_LOCS = "SELECT 'http://n/?r=' || n_regionkey || '&n=' || n_name AS loc, CASE n_regionkey WHEN 3 THEN 0 WHEN 1 THEN 1 WHEN 0 THEN 4 END AS k FROM nation WHERE n_regionkey IN (0, 1, 3) UNION ALL SELECT 'http://n/?a=1&b=2', 5"


@query(f"SELECT loc, row_number() OVER (ORDER BY k, loc) - 1 AS place FROM ({_LOCS}) ORDER BY k, loc LIMIT 12")
def sitemap_addresses(spark, d):
    """SRC-16, LIM-03: indexes are followed, gzipped bodies unpacked, references and CDATA resolved; the first 12."""
    found = robots.sitemap_urls(_sitemaps(spark, d), "http://n/", limit=12)
    return found.select("loc", (F.row_number().over(Window.partitionBy().orderBy("place")) - 1).cast("bigint").alias("place"))


@query("SELECT 'http://n/?r=' || n_regionkey || '&n=' || n_name AS loc FROM nation WHERE n_regionkey IN (1, 3) AND n_nationkey % 10 = 3")
def platform_addresses(spark, d):
    """SRC-17, PRED-05."""
    maps = _sitemaps(spark, d).select("loc", udfs.body_text(F.col("body")).alias("body"))
    found = robots.platform_urls(maps, "http://n/", ["N/1", "n/3"], ["_3", "_13", "_23"])
    return found.where(F.col("loc").rlike(r"_(\d*)3$"))


# --- pages written and read ---


@query("SELECT url, 'c1' AS crawl_id, sha256(html) AS content_hash, 'p/c1/' || sha256(url) || '.json' AS key FROM pages WHERE page_id % 2 = 1")
def stored_pages(spark, d):
    """SRC-22, SRC-23, SNK-05, SNK-06."""
    folder = shared_path(spark, "pages")
    pages = table(spark, d, "pages").select("url", T.content_hash(F.col("html")).alias("content_hash"), F.lit("p").alias("project_id"), F.concat(F.lit("c"), F.col("page_id") % 2).alias("crawl_id"))
    sinks.pages(pages, folder)
    read = readers.crawled_pages(spark, folder, "c1")
    return read.select("url", "crawl_id", "content_hash", sinks.object_key(F.lit("p"), F.col("crawl_id"), F.col("url")).alias("key"))


@query("SELECT url, CASE WHEN page_id % 3 = 0 THEN 'new' ELSE 'old' END AS mark FROM pages")
def upserted_pages(spark, d):
    """SNK-06: a new row in place of the old one of its key."""
    pages = table(spark, d, "pages")
    old = pages.select("page_id", "url", F.lit("old").alias("mark"))
    return sinks.upserted(old, old.where("page_id % 3 = 0").withColumn("mark", F.lit("new")), ["page_id"]).select("url", "mark")


@query("SELECT p_partkey AS id, nullif(p_size % 3, 0) AS n, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_name END AS title, r AS run FROM part, (VALUES (1), (2)) t(r)")
def appended_lines(spark, d):
    """SNK-01, SNK-02: zero and empty values are left out; a second run appends."""
    path = shared_path(spark, "lines")
    rows = _part(spark, d, id="p_partkey", n="p_size % 3", title="CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_name END").select("id", "n", "title")
    for run in (1, 2):
        sinks.json_lines(rows.withColumn("run", F.lit(run)), path, append=run > 1)
    return spark.read.schema("id bigint, n int, title string, run int").json(path).select(F.coalesce("id", F.lit(0)).alias("id"), "n", "title", "run")


@query("SELECT p_brand AS brand, count(*) AS n, min(p_name) AS title FROM part WHERE p_brand LIKE 'Brand#1%' GROUP BY p_brand")
def split_by_column(spark, d):
    """SNK-03, SNK-04, SNK-08: a folder for each value, of which a reader prunes those it doesn't need."""
    path, copy = shared_path(spark, "split"), shared_path(spark, "copy")
    sinks.by_column(_part(spark, d, brand="p_brand", title="p_name").select("brand", "title"), path, "brand")
    kept = spark.read.schema("title string, brand string").json(path).where(F.col("brand").startswith("Brand#1"))
    sinks.to_path(kept, copy)
    return spark.read.parquet(copy).groupBy("brand").agg(F.count("*").alias("n"), F.min("title").alias("title"))


@query("SELECT 'titles' AS metric, count(*)::VARCHAR AS value FROM part UNION ALL SELECT 'largest', max(p_size)::VARCHAR FROM part UNION ALL SELECT 'batches', ceil(count(*) / 100)::INTEGER::VARCHAR FROM nation UNION ALL SELECT 'last batch', (count(*) % 10)::VARCHAR FROM nation")
def reports(spark, d):
    """SNK-07, SNK-09."""
    sizes = [len(b) for b in sinks.batches(table(spark, d, "nation"), 10)]
    n = spark.createDataFrame([("batches", str(-(-sum(sizes) // 100))), ("last batch", str(sizes[-1]))], "metric string, value string")
    return sinks.report(table(spark, d, "part"), titles=F.count("*"), largest=F.max("p_size")).unionAll(n)


@query("""SELECT l_orderkey, l_linenumber, '{"lOrderkey":"' || l_orderkey || '","lLinenumber":' || l_linenumber || ',"lReturnflag":"' || l_returnflag || '"}' AS wire, l_returnflag AS flag FROM lineitem WHERE l_orderkey > 0 AND l_linenumber > 0""")
def wire_rows(spark, d):
    """JSON-07: rows as JSON of the wire form, and back."""
    rows = table(spark, d, "lineitem").where("l_orderkey > 0 AND l_linenumber > 0").select("l_orderkey", "l_linenumber", "l_returnflag")
    out = rows.select(sinks.wire_json(rows).alias("wire"))
    back = out.select("wire", *sinks.from_wire_json(F.col("wire"), rows))
    return back.select("l_orderkey", "l_linenumber", "wire", F.col("l_returnflag").alias("flag"))


# --- titles ---

_ARTICLE = "p_partkey % 4 = 1"


@query(f"""WITH t AS (SELECT p_partkey AS k, * FROM part WHERE p_partkey % 4 = 0), r AS (SELECT p_partkey + 1 AS rid, * FROM part WHERE p_partkey % 4 = 0 AND p_size % 2 = 0)
    SELECT k::VARCHAR AS tmdb_id, 'tt' || k AS imdb_id, p_name || ' ' || k AS title, (1950 + p_size)::VARCHAR AS year, CASE WHEN k % 8 = 0 THEN '' ELSE 'o' || k END AS original_title, 'about ' || k AS overview, (1950 + p_size) || '-01-02' AS release_date, p_size AS runtime,
    'D ' || k AS director, CASE WHEN k % 3 = 0 THEN p_size + 0.5 ELSE 0 END::DOUBLE AS imdb_rating, CASE WHEN k % 3 = 0 THEN p_size * 7 ELSE 0 END AS imdb_votes, p_retailprice AS tmdb_rating, p_size AS tmdb_vote_count,
    'Ann/Role|Bob/' || CASE WHEN k % 3 = 0 THEN '|Cy/C' ELSE '' END || CASE WHEN p_size % 2 = 0 THEN '|Di/' ELSE '' END AS members, CASE WHEN p_size % 2 = 0 THEN 'plot ' || k ELSE '' END AS plot,
    CASE WHEN p_size % 2 = 0 THEN 'c1|c2' ELSE '' END AS categories, CASE WHEN p_size % 2 = 0 THEN 'http://w/' || k ELSE '' END AS wiki_url, CASE WHEN p_size % 2 = 0 THEN 0.95 ELSE 0 END::DOUBLE AS confidence,
    CASE WHEN p_size % 2 = 0 THEN 'exact_title|year|director|cast:**' ELSE '' END AS signals, 'movie' AS kind, 33 AS fields FROM t""")
def enriched_movies(spark, d):
    """PRJ-01, JOIN-01, JOIN-02, JOIN-05, JOIN-06, ARR-04, end to end."""
    p = table(spark, d, "part").where("p_partkey % 4 = 0")
    k = F.col("p_partkey")
    day = F.concat((1950 + F.col("p_size")).cast("string"), F.lit("-01-02"))
    movies = p.select(
        k.alias("tmdb_id"), F.concat(F.lit("tt"), k).alias("imdb_id"), F.concat_ws(" ", "p_name", k).alias("title"), F.when(k % 8 == 0, F.concat_ws(" ", "p_name", k)).otherwise(F.concat(F.lit("o"), k)).alias("original_title"),
        F.concat(F.lit("about "), k).alias("overview"), day.alias("release_date"), F.col("p_size").alias("runtime"), F.col("p_retailprice").alias("vote_average"), F.col("p_size").alias("vote_count"),
        F.lit("Ann as Role|Bob").alias("cast_top10"), F.concat(F.lit("D "), k).alias("director"),
    )
    ratings = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("tt"), k).alias("tconst"), (F.col("p_size") + 0.5).cast("double").alias("rating"), (F.col("p_size") * 7).alias("votes"))
    member = lambda *m: F.struct(F.lit(m[0]).alias("name"), F.lit(m[1]).alias("character"), F.lit("actor").alias("role"))
    casts = p.where("p_partkey % 3 = 0").select(F.concat(F.lit("tt"), k).alias("tconst"), F.array(member("ANN", "other"), member("Cy", "C"), member("cy", "again")).alias("cast"))
    articles = p.where("p_size % 2 = 0").select(
        (k + 1).alias("rid"), F.concat_ws(" ", "p_name", k, F.lit("(film)")).alias("title"), (1950 + F.col("p_size")).cast("string").alias("year"), F.concat(F.lit("D "), k).alias("director"),
        F.array(F.lit("bob"), F.lit("ANN"), F.lit("Di")).alias("starring"), F.concat(F.lit("plot "), k).alias("plot_summary"), F.array(F.lit("c1"), F.lit("c2")).alias("categories"), F.concat(F.lit("http://w/"), k).alias("url"),
    )
    out = enrich.enrich(movies, "movie", ratings, casts, articles)
    return out.select(
        "tmdb_id", "imdb_id", "title", "year", "original_title", "overview", "release_date", "runtime", "director", "imdb_rating", "imdb_votes", "tmdb_rating", "tmdb_vote_count",
        _joined(F.transform("cast", lambda m: F.concat_ws("/", m["name"], m["character"]))).alias("members"), F.col("wiki_plot_summary").alias("plot"), _joined("wiki_categories").alias("categories"), "wiki_url",
        F.col("wiki_confidence").alias("confidence"), _joined("wiki_match_signals").alias("signals"), F.col("content_type").alias("kind"), F.lit(len(out.columns) - 1).alias("fields"),
    )


@query("""SELECT p_partkey::VARCHAR AS tmdb_id, CASE WHEN p_partkey % 3 <> 2 THEN 'tv' || p_partkey ELSE '' END AS imdb_id, p_name || ' ' || p_partkey AS title, CASE WHEN p_partkey % 3 <> 2 THEN 8.5 ELSE 0 END::DOUBLE AS imdb_rating, '' AS director, 0 AS runtime, 'tv' AS kind FROM part WHERE p_partkey % 4 = 1""")
def enriched_shows(spark, d):
    """PRJ-02, JOIN-03."""
    p = table(spark, d, "part").where("p_partkey % 4 = 1")
    k, year = F.col("p_partkey"), (1950 + F.col("p_size")).cast("string")
    own = F.concat_ws(" ", "p_name", k)
    shows = p.select(k.alias("tmdb_id"), own.alias("name"), F.concat(F.lit("first "), own).alias("original_name"), F.concat(year, F.lit("-05-06")).alias("first_air_date"), F.lit(1.0).alias("vote_average"), F.lit(2).alias("vote_count"), F.lit("").alias("cast_top10"), F.lit("x").alias("director"))
    known = F.when(k % 3 == 0, F.upper(own)).when(k % 3 == 1, F.concat(F.lit("FIRST "), own)).otherwise("other")
    basics = p.select(F.concat(F.lit("tv"), k).alias("tconst"), F.lit("tvSeries").alias("titleType"), known.alias("primaryTitle"), known.alias("originalTitle"), year.alias("startYear"), k.alias("ord"))
    ratings = p.select(F.concat(F.lit("tv"), k).alias("tconst"), F.lit(8.5).alias("rating"), F.lit(3).alias("votes"))
    casts = ratings.limit(0).select("tconst", F.array().cast(enrich.MEMBER).alias("cast"))
    articles = p.limit(0).select(k.alias("rid"), own.alias("title"), year.alias("year"), F.lit("").alias("director"), F.array(F.lit("")).alias("starring"), F.lit("").alias("plot_summary"), F.array(F.lit("")).alias("categories"), F.lit("").alias("url"))
    return enrich.enrich(shows, "tv", ratings, casts, articles, basics).select("tmdb_id", "imdb_id", "title", "imdb_rating", "director", "runtime", F.col("content_type").alias("kind"))


def _titles(spark, d):
    p = table(spark, d, "part")
    s, k = F.col("p_size"), F.col("p_partkey")
    few = lambda n, make: F.transform(F.sequence(F.lit(1), F.lit(5)), make) if n is None else F.slice(F.transform(F.sequence(F.lit(1), F.lit(5)), make), F.lit(1), n)
    named = lambda i: F.struct(i.cast("bigint").alias("id"), F.lit("n").alias("name"))
    blank = lambda ok, v: F.when(ok, v).otherwise("")
    ids = F.struct(blank(s % 2 == 0, "tt1").alias("imdb_id"), blank(s % 3 == 0, "Q1").alias("wikidata_id"))
    return p.select(
        k.alias("tmdb_id"), F.col("p_name").alias("title"), F.when(s % 2 == 0, F.col("p_name")).otherwise("o").alias("original_title"), blank(s % 5 != 0, "about").alias("overview"), blank(s % 4 != 0, "/p").alias("poster_path"),
        blank(s % 3 != 0, "/b").alias("backdrop_path"), few(s % 3, named).alias("genres"), few(s % 4, named).alias("keywords"), few(s % 5, named).alias("cast"),
        few(s % 3, lambda i: F.struct(i.cast("bigint").alias("id"), F.when(i == 2, "Director").otherwise("Writer").alias("job"), F.lit("n").alias("name"))).alias("crew"), blank(s % 7 == 0, "t").alias("tagline"), blank(s % 6 == 0, "h").alias("homepage"),
        (s % 2).alias("runtime"), blank(s % 8 != 0, "1999-05-06").alias("release_date"), F.when(s % 9 == 0, F.struct(F.lit(1).alias("id"))).alias("belongs_to_collection"), (s % 3).cast("bigint").alias("budget"), (s % 4).cast("bigint").alias("revenue"),
        F.when(s % 10 != 0, ids).alias("external_ids"), few(s % 4, lambda i: F.struct(F.when(i == 2, "Trailer").when(i == 3, "Teaser").otherwise("Clip").alias("type"))).alias("videos"),
        F.when(s % 2 == 1, F.create_map(F.lit("IN"), F.lit(1), F.lit("US"), F.lit(2))).alias("watch_providers"), few(s % 2, named).alias("similar"), few(s % 3, named).alias("alternative_titles"), few(s % 2, named).alias("certifications"),
        (s * 25).alias("vote_count"), (s / 5.0).alias("vote_average"), (s * 2.0).alias("popularity"), (s % 11 == 0).alias("adult"), F.when(s % 2 == 0, "Released").otherwise("Planned").alias("status"),
        F.element_at(F.array(F.lit("en"), F.lit("te"), F.lit("ko")), s % 3 + 1).alias("original_language"), F.array(F.element_at(F.array(F.lit("IN"), F.lit("KR"), F.lit("JP"), F.lit("US")), s % 4 + 1)).alias("origin_country"),
    )


_TAGS = {
    "has_overview": "s % 5 <> 0", "has_poster": "s % 4 <> 0", "has_backdrop": "s % 3 <> 0", "has_genres": "s % 3 > 0", "has_keywords": "s % 4 > 0", "has_cast": "s % 5 > 0", "has_crew": "s % 3 > 0", "has_tagline": "s % 7 = 0",
    "has_homepage": "s % 6 = 0", "cast_count": "s % 5", "crew_count": "s % 3", "keyword_count": "s % 4", "has_runtime": "s % 2 > 0", "has_release_date": "s % 8 <> 0", "has_original_title": "s % 2 <> 0 AND n <> 'o'",
    "has_collection": "s % 9 = 0", "has_budget": "s % 3 > 0", "has_revenue": "s % 4 > 0", "release_year": "CASE WHEN s % 8 <> 0 THEN '1999' ELSE '' END", "has_director": "s % 3 = 2", "has_imdb_id": "s % 10 <> 0 AND s % 2 = 0",
    "has_wikidata": "s % 10 <> 0 AND s % 3 = 0", "has_external_ids": "s % 10 <> 0 AND (s % 2 = 0 OR s % 3 = 0)", "has_imdb_rating": "false", "has_trailers": "s % 4 >= 2", "trailer_count": "greatest(s % 4 - 1, 0)",
    "has_videos": "s % 4 > 0", "video_count": "s % 4", "has_availability": "s % 2 = 1", "available_countries": "s % 2 * 2", "has_similar": "s % 2 > 0", "has_alternative_titles": "s % 3 > 0", "has_certification": "s % 2 > 0",
    "vote_count": "s * 25", "vote_average": "s / 5.0::DOUBLE", "popularity": "s * 2.0::DOUBLE", "high_vote_count": "s * 25 > 100", "very_high_votes": "s * 25 > 1000", "popular": "s * 2 > 10", "very_popular": "s * 2 > 50",
    "high_rated": "s / 5.0 >= 7 AND s * 25 > 50", "is_adult": "s % 11 = 0", "is_released": "s % 2 = 0", "original_language": "['en', 'te', 'ko'][s % 3 + 1]", "is_english": "s % 3 = 0", "is_indian": "s % 4 = 0 OR s % 3 = 1",
    "is_korean": "s % 4 = 1", "is_japanese": "s % 4 = 2",
    "tier": "CASE WHEN s % 5 <> 0 AND s % 4 <> 0 AND s % 3 > 0 AND s * 25 > 100 AND s % 2 = 1 THEN 'gold' WHEN s % 5 <> 0 AND s % 4 <> 0 AND s % 3 > 0 AND s * 25 > 10 THEN 'silver' WHEN s % 5 <> 0 THEN 'bronze' ELSE 'stub' END",
    "display_ready": "s % 4 <> 0 AND s % 5 <> 0 AND s % 3 > 0 AND s % 8 <> 0",
}


@query(f"SELECT p_partkey AS id, {', '.join(f'{v} AS {k}' for k, v in _TAGS.items())} FROM (SELECT p_partkey, p_size AS s, p_name AS n FROM part)")
def all_tags(spark, d):
    """TAG-01..03, ARR-01..03, PRED-11: every tag."""
    return tags.tagged(_titles(spark, d), "movie").select(F.col("tmdb_id").alias("id"), "_tags.*")


@query(f"SELECT count(*) AS total, count(*) FILTER ({_TAGS['display_ready']}) AS ready, count(*) FILTER (s % 2 = 1) AS providers, count(*) FILTER (s % 4 >= 2) AS trailers FROM (SELECT p_size AS s FROM part)")
def presence_counts(spark, d):
    """AGG-04, AGG-08."""
    t = tags.tagged(_titles(spark, d), "movie")
    return tags.enrichment_report(t, ready=F.col("_tags.display_ready"), providers=tags.size_of(F.col("watch_providers")) > 0, trailers=F.size(catalog.trailers(F.col("videos"))) > 0)


@query("SELECT p_partkey AS id, p_name AS title, CASE WHEN p_size % 8 <> 0 THEN '1999' ELSE '' END AS year, p_size % 5 AS cast_count, p_size % 4 AS videos_count, p_size % 2 * 2 AS watch_providers_count, CASE WHEN p_size % 3 = 2 THEN 'n' ELSE '' END AS director FROM part")
def hit_cards(spark, d):
    """PRJ-05, ARR-01, ARR-02."""
    t = _titles(spark, d).withColumnRenamed("tmdb_id", "id")
    return catalog.hit_card(t).join(t.select("id", tags.director(F.col("crew")).alias("director")), "id")


@query("SELECT 'movie' AS found, 5::BIGINT AS id, p_name AS title FROM part WHERE p_partkey = 5 UNION ALL SELECT 'show', s_suppkey, s_name FROM supplier WHERE s_suppkey = 3")
def point_lookups(spark, d):
    """PRED-13: by id in the first table, else in the second one."""
    movies = table(spark, d, "part").where("p_partkey > 4").select(F.lit("movie").alias("found"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    shows = table(spark, d, "supplier").select(F.lit("show").alias("found"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    return catalog.lookup(movies, shows, "id", 5).unionAll(catalog.lookup(movies, shows, "id", 3))


@query("""SELECT id, name, seeds, rate FROM (SELECT s_suppkey AS id, CASE WHEN s_suppkey = 7 THEN 'renamed' ELSE s_name END AS name, 's' AS seeds, CASE WHEN s_suppkey = 7 THEN 2.5 ELSE 1 END::DOUBLE AS rate FROM supplier WHERE s_suppkey <> 4 UNION ALL SELECT -1, 'added', 't', 1)""")
def projects(spark, d):
    """PRJ-06: create, a partial update (empty and zero values change nothing), delete."""
    p = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("s").alias("seeds"), F.lit(1.0).alias("rate"))
    new = spark.createDataFrame([(-1, "added", "t", 1.0), (2, "there", "t", 9.0)], "id bigint, name string, seeds string, rate double")
    return catalog.deleted(catalog.updated(catalog.created(p, new), "id", 7, name="renamed", seeds="", rate=2.5), "id", 4)


@query("SELECT user_id, count(*) AS done, round(10000 * 1.0 / (count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)) , 3) AS eta FROM (SELECT * FROM events) GROUP BY user_id")
def crawl_eta(spark, d):
    """AGG-11: seconds that 10,000 more take at the rate so far."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("done"), ((T.micros(F.max("ts")) - T.micros(F.min("ts"))) / 1e6).alias("s"))
    return e.select("user_id", "done", F.round(catalog.progress(F.col("done"), F.col("done") + 10_000, F.col("s"))[1], 3).alias("eta"))


@query("SELECT 'http://h' || p_size || ':80/' || p_partkey AS url, CASE WHEN p_size % 3 = 0 THEN 'full' ELSE 'polite' END AS strategy FROM part")
def seed_routes(spark, d):
    """JOIN-11."""
    seeds = _part(spark, d, url="concat('http://h', p_size, ':80/', p_partkey)").select("url")
    sites = table(spark, d, "part").select(F.concat(F.lit("h"), "p_size", F.lit(":80")).alias("domain"), F.when(F.col("p_size") % 3 == 0, "full").otherwise("UNSPECIFIED").alias("strategy")).distinct()
    return matching.route_seeds(seeds, sites, "polite")


@query("SELECT p_partkey % 3 AS wave, count(*) FILTER (p_partkey % 2 = 0 AND p_partkey > 0) AS merged, count(*) FILTER (p_partkey % 2 <> 0 OR p_partkey = 0) AS new FROM part GROUP BY 1")
def merge_counts(spark, d):
    """AGG-06."""
    rows = _part(spark, d, ord="p_partkey", wave="p_partkey % 3", root="CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_partkey END")
    return dedup.merge_counters(rows)


@query("""SELECT s AS root, 'T' || s AS title, CASE WHEN s % 2 = 0 THEN 'plot 1' ELSE '' END AS plot_summary, 'w2' AS wiki_url, 'cat2' AS categories, 'dir' AS wiki_director, 'made' AS production_company, 'aha zee5' AS platforms, 'catalogue|encyclopedia|yearlist|aha|zee5' AS sources,
    CASE WHEN s % 2 = 0 THEN 'transliteration' ELSE 'disambig_stripped' END AS method, CASE WHEN s % 2 = 0 THEN 85 ELSE 90 END AS confidence FROM (SELECT s_suppkey * 10 AS s10, s_suppkey AS s FROM supplier)""")
def merge_effects(spark, d):
    """SURVEY 2.8, AGG-14: blanks filled, addresses replaced, platforms listed, confidence of a platform only upward."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("root"))
    odd = F.col("root") % 2 == 1
    e = lambda v="": F.lit(v)
    rows = [
        (0, 0, "catalogue", e(), e(), F.array().cast("array<string>"), e(), e(), None, None),
        (1, 1, "encyclopedia", F.when(odd, "").otherwise("plot 1"), e("w1"), F.array(e("cat1")), e(), e(), "exact", 95),
        (2, 1, "encyclopedia", F.when(odd, "").otherwise("plot 2"), e("w2"), F.array(e("cat2")), e(), e(), "transliteration", 85),
        (3, 2, "yearlist", e(), e(), F.array().cast("array<string>"), e("dir"), e("made"), "exact", 95),
        (4, 3, "aha", e(), e(), F.array().cast("array<string>"), e(), e(), "subtitle_stripped", 80),
        (5, 3, "zee5", e(), e(), F.array().cast("array<string>"), e(), e(), None, None),
    ]
    out = None
    for i, wave, source, plot, url, cats, director, made, method, confidence in rows:
        own = F.when(odd, "disambig_stripped") if source == "zee5" else F.lit(method).cast("string")
        sure = F.when(odd, 90).otherwise(95) if source == "zee5" else F.lit(confidence).cast("int")
        one = s.select(
            "root", F.struct("root", F.lit(i).alias("i")).alias("ord0"), (F.col("root") * 10 + i).alias("ord"), F.lit(wave).alias("wave"), F.lit(source).alias("source"), F.concat(F.lit("T"), "root").alias("title"), F.lit("1990").alias("year"), e().alias("director"),
            plot.alias("plot_summary"), url.alias("wiki_url"), cats.alias("categories"), director.alias("wiki_director"), made.alias("production_company"), own.alias("method"), sure.alias("confidence"),
        )
        out = one if out is None else out.unionAll(one)
    u = dedup.unified(out.drop("ord0"))
    return u.select(
        "root", "title", F.coalesce("plot_summary", F.lit("")).alias("plot_summary"), "wiki_url", _joined("categories").alias("categories"), "wiki_director", "production_company",
        _joined(F.transform("platforms", lambda p: p["platform"]), " ").alias("platforms"), _joined("sources").alias("sources"), "method", "confidence",
    )


# --- crawl steps and streams ---


def _crawl(spark, d):
    """A frontier of all pages, and what was fetched: each links to the next two pages, itself and one page of another host."""
    n = table(spark, d, "pages").select("page_id")
    url = lambda c: F.concat(F.lit("http://h/"), c)
    k = F.col("page_id")
    frontier = n.where("page_id % 2 = 0").select(url(k).alias("url"), F.lit("c").alias("crawl_id"), F.lit(3).alias("depth"))
    status = F.when(k % 10 == 4, 304).when(k % 10 == 8, 500).otherwise(200)
    links = F.array(url(k + 1), url(k + 2), url(k), url(k + 1), F.concat(F.lit("http://o/"), k))
    pages = n.select(url(k).alias("url"), status.alias("status"), (k % 6 != 0).alias("index"), (k % 4 != 0).alias("follow"), links.alias("links"))
    return frontier, pages


_FETCHED = "SELECT page_id AS k FROM pages WHERE page_id % 2 = 0"
_NEW = "SELECT dst, min(src) AS src FROM (SELECT k, 'http://h/' || k AS src, unnest(['http://h/' || (k + 1), 'http://h/' || (k + 2), 'http://h/' || k, 'http://o/' || k]) AS dst FROM ({f}) WHERE {w}) WHERE dst NOT IN (SELECT 'http://h/' || k FROM ({f})) GROUP BY dst"


@query(f"""SELECT 'stored' AS kind, 'http://h/' || k AS url, '' AS discovered_from, 3 AS depth FROM ({_FETCHED}) WHERE k % 10 NOT IN (4, 8) AND k % 6 <> 0 AND k % 14 <> 0
    UNION ALL SELECT 'queued', dst, src, 4 FROM ({_NEW.format(f=_FETCHED, w="k % 10 NOT IN (4, 8) AND k % 4 <> 0 AND k % 14 <> 0")})""")
def polite_step(spark, d):
    """STM-11, JOIN-10."""
    frontier, pages = _crawl(spark, d)
    permitted = pages.select("url", (F.regexp_extract("url", r"(\d+)$", 1).cast("bigint") % 14 != 0).alias("allowed"))
    stored, queued = crawl.polite_plan(frontier, pages, permitted, frontier.select("crawl_id", "url"))
    return stored.select(F.lit("stored").alias("kind"), "url", F.lit("").alias("discovered_from"), "depth").unionAll(queued.select(F.lit("queued"), "url", "discovered_from", "depth"))


@query(f"""SELECT 'stored' AS kind, 'http://h/' || k AS url, '' AS discovered_from, 3 AS depth FROM ({_FETCHED}) WHERE k % 10 NOT IN (4, 8)
    UNION ALL SELECT 'queued', dst, src, 4 FROM ({_NEW.format(f=_FETCHED, w="k % 10 NOT IN (4, 8)")}) UNION ALL SELECT 'error', 'http://h/' || k, '', 3 FROM ({_FETCHED}) WHERE k % 10 = 8""")
def full_step(spark, d):
    """STM-12."""
    frontier, pages = _crawl(spark, d)
    stored, queued, errors = crawl.full_plan(frontier, pages, frontier.select("crawl_id", "url"))
    rows = lambda df, k: df.select(F.lit(k).alias("kind"), "url", F.lit("").alias("discovered_from"), "depth")
    return rows(stored, "stored").unionAll(queued.select(F.lit("queued"), "url", "discovered_from", "depth")).unionAll(rows(errors, "error"))


@query("SELECT 'http://h' || n_nationkey || '/new' AS url, 'c' || i AS crawl_id, 0 AS depth, 'sitemap:m' || n_nationkey AS discovered_from FROM nation, (VALUES (1), (2)) t(i) WHERE n_nationkey % 3 <> 0 OR i = 2")
def sitemap_step(spark, d):
    """STM-05: once for each crawl and domain."""
    n = table(spark, d, "nation").select(F.concat(F.lit("h"), "n_nationkey").alias("domain"), "n_nationkey")
    frontier = n.withColumn("crawl_id", F.explode(F.array(F.lit("c1"), F.lit("c2")))).withColumn("x", F.explode(F.array(F.lit("a"), F.lit("b"))))
    frontier = frontier.select("crawl_id", F.concat(F.lit("http://"), "domain", F.lit("/"), "x").alias("url"))
    maps = n.select("domain", F.concat(F.lit("m"), "n_nationkey").alias("sitemap"), F.explode(F.array(F.concat(F.lit("http://"), "domain", F.lit("/new")), F.concat(F.lit("http://"), "domain", F.lit("/a")))).alias("loc"))
    done = n.where("n_nationkey % 3 = 0").select(F.lit("c1").alias("crawl_id"), "domain")
    return crawl.sitemap_plan(frontier, maps, done, frontier).select("url", "crawl_id", "depth", "discovered_from")


@query("SELECT user_id AS url, max(n) AS attempts, arg_max(s, n) AS status, sum(CASE WHEN s = 200 THEN 0 ELSE n + CASE WHEN s = 429 THEN 3 ELSE 0 END END)::BIGINT AS waited_s FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, CASE event_type WHEN 'error' THEN 429 WHEN 'view' THEN 500 ELSE 200 END AS s FROM events) WHERE n <= 3 GROUP BY user_id")
def retries(spark, d):
    """STM-14."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    status = F.when(F.col("event_type") == "error", 429).when(F.col("event_type") == "view", 500).otherwise(200)
    return crawl.retry_plan(table(spark, d, "events").select(F.col("user_id").alias("url"), n.alias("attempt"), status.alias("status"))).select("url", "attempts", "status", "waited_s")


@query("SELECT 4 AS workers, count(*) AS n, true AS apart FROM pages")
def fetch_workers(spark, d):
    """STM-15: each worker's starts lie workers / rate apart, and no two workers start at once."""
    out = crawl.fan_out(table(spark, d, "pages").select(F.col("page_id").cast("string").alias("url")), 4, 2.0)
    gaps = out.groupBy("worker").agg(F.count("*").alias("n"), ((F.max("start_us") - F.min("start_us")) == (F.count("*") - 1) * 2_000_000).alias("even"), (F.min("start_us") % 2_000_000).alias("at"))
    return gaps.agg(F.count("*").cast("int").alias("workers"), F.sum("n").alias("n"), (F.min("even") & (F.count_distinct("at") == 4)).alias("apart"))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 1.0 ELSE s_suppkey % 3 * 1.5 END::DOUBLE AS rate, CASE WHEN s_suppkey % 2 = 1 THEN 5 WHEN s_suppkey % 3 = 2 THEN 3 ELSE 1 END AS burst FROM supplier")
def effective_limits(spark, d):
    """MATH-05."""
    k = F.col("s_suppkey")
    rate, burst = limits.effective((k % 3 * 1.5).cast("double"), F.when(k % 2 == 1, 5).otherwise(0))
    return table(spark, d, "supplier").select(k.alias("id"), rate.alias("rate"), burst.alias("burst"))


def _streamed(spark, events: DataFrame, step, mode: str = "append") -> DataFrame:
    """What a stream over the events, written as files, leaves in its sink when all files are read."""
    folder, out, state = (shared_path(spark, x) for x in ("events", "sink", "state"))
    events.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    stream = step(limits.frontier(spark, folder, per_trigger=3))
    run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _frontier_events(spark, d):
    e = table(spark, d, "events")
    return e.select(
        F.concat(F.lit("u"), F.col("event_id") % 50).alias("url"), F.lit(1).alias("depth"), F.lit("p").alias("project_id"), F.concat(F.lit("c"), F.col("user_id") % 3).alias("crawl_id"),
        F.when(F.col("event_id") % 50 < 10, "").when(F.col("event_id") % 50 < 20, "FULL").when(F.col("event_id") % 50 < 30, "odd").otherwise("wiki").alias("strategy"),
    )


@query("SELECT DISTINCT 'u' || event_id % 50 AS url, 'c' || user_id % 3 AS crawl_id, CASE WHEN event_id % 50 < 10 THEN 'polite' WHEN event_id % 50 < 20 THEN 'full' WHEN event_id % 50 < 30 THEN 'skipped' ELSE 'wiki' END AS strategy FROM events")
def stream_unseen(spark, d):
    """STM-01, STM-02, STM-03, STM-06: a bounded source, each address once, routed by strategy."""
    return _streamed(spark, _frontier_events(spark, d), lambda s: limits.routed(limits.unseen(s))).select("url", "crawl_id", "strategy")


@query("SELECT DISTINCT 'u' || event_id % 50 || '/' || i AS url, 2 AS depth, 'u' || event_id % 50 AS discovered_from, 'c' || user_id % 3 AS crawl_id FROM events, (VALUES ('a'), ('b')) t(i)")
def stream_links(spark, d):
    """STM-04: a link is a level deeper, found from its page."""
    links = F.array(F.concat("url", F.lit("/a")), F.concat("url", F.lit("/b")))
    return _streamed(spark, _frontier_events(spark, d), lambda s: limits.expand(limits.unseen(s).withColumn("links", links))).select("url", "depth", "discovered_from", "crawl_id")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    b(event_id, user_id, a, n, tokens) AS (SELECT event_id, user_id, a, n, least(2::DOUBLE, 2::DOUBLE + greatest(0, a - a) / 1e6 * (1::DOUBLE / 28800)) - 1 FROM e WHERE n = 1
      UNION ALL SELECT e.event_id, e.user_id, e.a, e.n, CASE WHEN least(2::DOUBLE, b.tokens + greatest(0, e.a - b.a) / 1e6 * (1::DOUBLE / 28800)) >= 1 THEN least(2::DOUBLE, b.tokens + greatest(0, e.a - b.a) / 1e6 * (1::DOUBLE / 28800)) - 1 ELSE least(2::DOUBLE, b.tokens + greatest(0, e.a - b.a) / 1e6 * (1::DOUBLE / 28800)) END FROM b JOIN e ON e.user_id = b.user_id AND e.n = b.n + 1)
    SELECT user_id, event_id, a AS arrival_us, CASE WHEN n = 1 OR t >= 1 THEN 0 ELSE ceil((1 - t) / (1::DOUBLE / 28800) * 1e6)::BIGINT END AS wait_us
    FROM (SELECT *, least(2::DOUBLE, lag(tokens) OVER w + greatest(0, a - lag(a) OVER w) / 1e6 * (1::DOUBLE / 28800)) AS t FROM b WINDOW w AS (PARTITION BY user_id ORDER BY n))""")
def token_bucket(spark, d):
    """STM-09, MATH-04: each user's requests in order; a step needs the tokens left by the one before."""
    rows = table(spark, d, "events").select("event_id", "user_id", T.micros(F.col("ts")).alias("arrival_us"))
    return limits.token_bucket(rows, 1 / 28_800, 2, "user_id", "arrival_us", "event_id")


@query("SELECT lang, status, attempts FROM (SELECT lang, 'COMPLETED' AS status, count(*) AS attempts FROM documents GROUP BY lang)")
def job_lifecycle(spark, d):
    """STM-16: commands in any order of rows; the last one known counts."""
    jobs = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("attempts"))
    commands = jobs.select(F.col("lang").alias("job_id"), F.explode(F.array(*(F.struct(F.lit(i).alias("at"), F.lit(c).alias("command")) for i, c in ((3, "finish"), (1, "start"), (2, "pause"), (9, "noise"))))).alias("x")).select("job_id", "x.*")
    return catalog.job_status(commands).join(jobs, F.col("job_id").eqNullSafe(F.col("lang"))).select("lang", "status", "attempts")


# --- merging ---

_FUZZY = """(x = y OR (least(strlen(x), strlen(y)) >= 3 AND list_sum(list_transform(list_distinct(string_split(x, '')), lambda c: least(length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, ''))))) / greatest(strlen(x), strlen(y)) > 0.75))"""
#: Row after row: who is a root depends on the roots before. No title of the table has a subtitle or a disambiguation.
_CASCADE = f"""WITH RECURSIVE w AS (SELECT (p_partkey % 4) * 1000000000 + p_partkey AS ord, p_partkey % 4 AS wave, {_norm("p_name")} AS nt, p_size::VARCHAR AS y, CASE WHEN p_partkey % 4 IN (0, 2) THEN p_type ELSE '' END AS dir, p_name, lower(p_name) AS t FROM part),
    l AS (SELECT *, [{_SWAPS}, CASE WHEN starts_with(t, 'the ') THEN substr(t, 5) END] AS every FROM w), v AS (SELECT *, list_filter(every, lambda x, i: x IS NOT NULL AND list_position(every, x) = i) AS vs FROM l),
    u AS (SELECT ord, wave, y, unnest(vs) AS x, generate_subscripts(vs, 1) AS i FROM v),
    keys AS (SELECT ord, 'e:' || nt || '::' || y AS k FROM w UNION SELECT ord, 'd:' || {_norm("dir")} || '::' || y FROM w WHERE dir <> '' UNION SELECT ord, 't:' || {_norm("x")} || '::' || y FROM u),
    probes AS (SELECT ord, 0 AS how, 0 AS rank, 'e:' || nt || '::' || y AS k FROM w WHERE wave > 0 UNION ALL SELECT ord, 9000009, 9, 'd:' || {_norm("dir")} || '::' || y FROM w WHERE wave > 0 AND dir <> ''
      UNION ALL SELECT ord, 5000000 + i * 100 + 5, 5, 'e:' || {_norm("x")} || '::' || y FROM u WHERE wave > 0 UNION ALL SELECT ord, 5000000 + i * 100 + 6, 6, 't:' || {_norm("x")} || '::' || y FROM u WHERE wave > 0),
    pairs AS (SELECT ord, root, min(how) AS how FROM (SELECT p.ord, k.ord AS root, p.how, p.rank, a.nt AS x, b.nt AS y FROM probes p JOIN keys k ON k.k = p.k AND k.ord < p.ord JOIN w a ON a.ord = p.ord JOIN w b ON b.ord = k.ord) WHERE rank <> 9 OR {_FUZZY} GROUP BY ord, root),
    seq AS (SELECT w.ord, w.wave, c, row_number() OVER (ORDER BY w.ord) AS n FROM w LEFT JOIN (SELECT ord, list(root) AS c FROM pairs GROUP BY ord) USING (ord)),
    r(n, roots) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT s.n, CASE WHEN s.wave = 0 OR NOT list_has_any(coalesce(s.c, []), r.roots) THEN list_append(r.roots, s.ord) ELSE r.roots END FROM r JOIN seq s ON s.n = r.n + 1),
    final AS (SELECT unnest(roots) AS root FROM (SELECT roots FROM r ORDER BY n DESC LIMIT 1)),
    best AS (SELECT ord, arg_min(root, (how, root)) AS root, min(how) % 100 AS rank FROM pairs JOIN final USING (root) WHERE ord NOT IN (SELECT root FROM final) GROUP BY ord),
    stands AS (SELECT nt, y, max(ord) AS last FROM w WHERE wave = 0 GROUP BY nt, y),
    resolved AS (SELECT w.*, coalesce(s2.last, best.root, s1.last, w.ord) AS root, CASE best.rank {{methods}} END AS method, CASE best.rank {{sure}} END AS confidence
      FROM w LEFT JOIN best USING (ord) LEFT JOIN w b ON b.ord = best.root AND b.wave = 0 LEFT JOIN stands s2 ON s2.nt = b.nt AND s2.y = b.y LEFT JOIN stands s1 ON w.wave = 0 AND s1.nt = w.nt AND s1.y = w.y)"""
_CASCADE = _CASCADE.replace("{methods}", " ".join(f"WHEN {r} THEN '{m}'" for r, m, _ in dedup.METHODS)).replace("{sure}", " ".join(f"WHEN {r} THEN {c}" for r, _, c in dedup.METHODS))


@query(f"{_CASCADE} SELECT ord, wave::INTEGER AS wave, root, method, confidence FROM resolved")
def dedup_roots(spark, d):
    """JOIN-07, the whole cascade."""
    return dedup.resolve(_waves(spark, d)).select("ord", "wave", "root", "method", "confidence")


_SOURCE = "['catalogue', 'encyclopedia', 'yearlist', 'streaming'][wave + 1]"


@query(f"""{_CASCADE}, m AS (SELECT root, arg_min(p_name, ord) AS title, arg_min(y, ord) AS year, arg_min(dir, ord) FILTER (dir <> '') AS director, count(*) FILTER (wave = 3 AND ord > 0) AS platforms,
      array_to_string(list_transform(list_sort(list_distinct(list(wave))), lambda wave: {_SOURCE}), '|') AS sources, arg_max(method, ord) FILTER (confidence < 95 AND wave IN (1, 2)) AS m, arg_max(confidence, ord) FILTER (confidence < 95 AND wave IN (1, 2)) AS c,
      arg_max(method, (confidence, -ord)) FILTER (confidence < 95 AND wave = 3) AS pm, max(confidence) FILTER (confidence < 95 AND wave = 3) AS pc FROM resolved GROUP BY root)
    SELECT root, title, year, director, platforms, sources, CASE WHEN pc > coalesce(c, 0) THEN pm ELSE m END AS method, CASE WHEN pc > coalesce(c, 0) THEN pc ELSE c END AS confidence FROM m""")
def dedup_unified(spark, d):
    """SURVEY 2.8, merge effects; AGG-14."""
    u = dedup.unified(dedup.resolve(_waves(spark, d)))
    return u.withColumns({"sources": _joined("sources"), "platforms": F.size("platforms").cast("bigint")})


@query("SELECT page_id, url FROM pages WHERE url = (SELECT url FROM pages WHERE page_id = 17) ORDER BY page_id LIMIT 1")
def point_lookup(spark, d):
    """PRED-14: the page of an address."""
    pages = table(spark, d, "pages").select("page_id", "url", F.col("url").alias("final_url"))
    sought = pages.where("page_id = 17").first()["url"]
    return catalog.page_by_url(pages, sought).select("page_id", "url")
