"""Queries over the shared tables, one or more per operator group, each with the same query as DuckDB SQL in ORACLE_SQL.

Tables stand in by shape: pages for fetched pages, documents for text records, events for request logs, part for titles,
orders and lineitem for keyed facts, conversations for ordered lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages as P
from ..functions import text as T
from ..functions.dims import COUNTRIES, INDIAN, LANGUAGES
from ..operators import catalog, crawl, dedup, matching, robots, tags
from ..session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_NORM = r"regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{Nd}}]', '', 'g')"


def _norm(c: str) -> str:
    return _NORM.format(c=c)


def _array(c: str) -> str:
    """An array of texts as one text, on either side."""
    return f"array_to_string({c}, '|')"


# --- text and dates ---


@query(f"SELECT doc_id, {_norm('text')} AS norm, substr({_norm('text')}, 1, 60) AS head FROM documents")
def norm_title(spark, d):
    """STR-01, LIM-04."""
    n = T.norm_title(F.col("text"))
    return table(spark, d, "documents").select("doc_id", n.alias("norm"), T.limited(n, 60).alias("head"))


@query(f"SELECT key, min(p_partkey) AS first_part, max(p_partkey) AS last_part, count(*) AS n FROM (SELECT *, {_norm('p_name')} || '::' || p_size AS key FROM part) GROUP BY key")
def norm_key_wins(spark, d):
    """STR-02, AGG-12, AGG-13."""
    parts = table(spark, d, "part")
    key = T.norm_key(F.col("p_name"), F.col("p_size").cast("string"))
    return matching.wins(parts, key, "p_partkey", "p_partkey").withColumnsRenamed({"first": "first_part", "last": "last_part"})


@query("SELECT o_orderkey, regexp_extract(strftime(o_orderdate, '%Y-%m-%d'), '^(\\d{4})', 1) AS year, substr(strftime(o_orderdate, '%Y-%m-%d'), 1, 4) AS chars FROM orders")
def year_prefix(spark, d):
    """DATE-01, DATE-02."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select("o_orderkey", T.year_prefix(day).alias("year"), T.year_chars(day).alias("chars"))


@query(r"SELECT l_orderkey, l_linenumber, coalesce(nullif(regexp_extract('shipped ' || strftime(l_shipdate, '%d %m %Y'), '\b((?:19|20)\d{2})\b', 1), ''), '') AS year FROM lineitem")
def year_search(spark, d):
    """DATE-03."""
    said = F.concat(F.lit("shipped "), F.date_format("l_shipdate", "dd MM yyyy"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.year_search(F.lit(""), said).alias("year"))


_TITLES = """(SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 0 THEN ' (1999 film)' WHEN 1 THEN ': Chapter 2' WHEN 2 THEN ' - The Final Cut' WHEN 3 THEN ' part 3' WHEN 4 THEN ' (TV series)' ELSE '' END AS t FROM part)"""


def _titles(spark, d):
    ends = [" (1999 film)", ": Chapter 2", " - The Final Cut", " part 3", " (TV series)", ""]
    return table(spark, d, "part").select("p_partkey", F.concat("p_name", F.element_at(F.array(*map(F.lit, ends)), (F.col("p_partkey") % 6 + 1).cast("int"))).alias("t"))


@query(rf"""SELECT p_partkey, trim(regexp_replace(t, '\s*\((?:{T.DISAMBIGUATIONS})\)\s*\z', '')) AS clean, trim(regexp_replace(t, '\s*\((?:{T.DISAMBIGUATIONS_NARROW})\)\s*\z', '')) AS narrow FROM {_TITLES}""")
def strip_disambig(spark, d):
    """STR-03, STR-03b."""
    return _titles(spark, d).select("p_partkey", T.strip_disambig(F.col("t")).alias("clean"), T.strip_disambig(F.col("t"), narrow=True).alias("narrow"))


@query(rf"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(t, '(?i)\s*[-–:]\s*(?:{T.SUBTITLES})[^\n]*\z', ''), '\s*\([^)]*\)\s*\z', ''), '(?i)\s+(?:part|vol|chapter|pt)\.?\s*\d+\s*\z', '')) AS short FROM {_TITLES}""")
def strip_subtitle(spark, d):
    """STR-04."""
    return _titles(spark, d).select("p_partkey", T.strip_subtitle(F.col("t")).alias("short"))


_SWAPS = ", ".join(f"CASE WHEN contains(t, '{a}') THEN replace(t, '{a}', '{b}') END" for a, b in T.SWAPS)


@query(f"SELECT p_partkey, v AS variant FROM (SELECT DISTINCT p_partkey, unnest([{_SWAPS}, CASE WHEN starts_with(t, 'the ') THEN substr(t, 5) END]) AS v FROM (SELECT p_partkey, lower(p_name) AS t FROM part)) WHERE v IS NOT NULL")
def translit_variants(spark, d):
    """STR-06."""
    return table(spark, d, "part").select("p_partkey", F.explode(T.translit_variants(F.col("p_name"))).alias("variant"))


_BRANDED = "(SELECT a.p_partkey AS a, b.p_partkey AS b, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey)"


@query(f"""SELECT a, b, x = y OR (least(strlen(x), strlen(y)) >= 3 AND common / greatest(strlen(x), strlen(y)) > 0.75) AS near, lower(split_part(x, ' ', -1)) = lower(split_part(y, ' ', -1)) AND strlen(split_part(x, ' ', -1)) > 3 OR {_norm('x')} = {_norm('y')} AS named
    FROM (SELECT *, list_sum(list_transform(list_distinct(string_split(x, '')), lambda c: least(length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, ''))))) AS common FROM {_BRANDED})""")
def fuzzy_chars(spark, d):
    """STR-07, STR-08."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size", "p_type", F.col("p_name").alias("x"))
    left = matching.alike(p, "id", "p_size", "p_type", "x")
    right = left.withColumnsRenamed({"ids": "rids", "x": "y"})
    pairs = matching.meet(left, right, ["p_size", "p_type"], "ids").where(F.col("ids")[0] < F.element_at("rids", -1))
    pairs = pairs.select("ids", "rids", T.fuzzy_chars(F.col("x"), F.col("y")).alias("near"), T.fuzzy_names(F.col("x"), F.col("y")).alias("named"))
    return matching.expanded(pairs, "near", "named").where("id < rid").withColumnsRenamed({"id": "a", "rid": "b"})


@query("SELECT doc_id, sha256(text) AS hash, text ILIKE '%noindex%' IS NOT TRUE AS ix, length(text) AS n FROM documents")
def content_hash(spark, d):
    """STR-28, PRED-17."""
    index, _ = T.robots_flags(F.col("text"))
    return table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("hash"), index.alias("ix"), F.char_length("text").cast("bigint").alias("n"))


@query(r"""SELECT doc_id, strlen(w) < 2 OR regexp_matches(w, '^[+-]?\d+$') OR length(regexp_replace(w, '[^\p{L}]', '', 'g')) < 2 AS garbage, w AS word FROM (SELECT doc_id, split_part(text, ' ', 1) AS w FROM documents)""")
def garbage_titles(spark, d):
    """PRED-15."""
    w = F.substring_index("text", " ", 1)
    return table(spark, d, "documents").select("doc_id", T.is_garbage(w).alias("garbage"), w.alias("word"))


# --- filters, lookups, pages of rows ---


@query("SELECT doc_id, lang FROM documents WHERE contains(lower(coalesce(text, '')), 'license') OR contains(lower(coalesce(text, '')), 'the ') OR contains(lower(coalesce(text, '')), 'una')")
def lang_filter_any_keyword(spark, d):
    """PRED-02, PRED-03."""
    words = F.array(*map(F.lit, ("License", "the ", "una")))
    return table(spark, d, "documents").where(T.any_keyword(F.col("text"), words)).select("doc_id", "lang")


_LANGS = ", ".join(f"('{c}', '{n}')" for c, n, *_ in LANGUAGES)


@query(f"SELECT name AS language_name, count(*) AS n, sum(CASE WHEN code IN ({', '.join(map(repr, INDIAN))}) THEN 1 ELSE 0 END)::BIGINT AS indian FROM documents JOIN (VALUES {_LANGS}) AS l(code, name) ON code = lang GROUP BY name")
def language_names(spark, d):
    names = F.broadcast(spark.createDataFrame([(c, n) for c, n, *_ in LANGUAGES], "lang string, language_name string"))
    rows = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")).join(names, "lang")
    return rows.groupBy("language_name").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("lang").isin(*INDIAN), F.col("n")).otherwise(0)).alias("indian"))


@query("""WITH m AS (SELECT 'movie' AS kind, p_partkey AS id, p_name AS title FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring') ORDER BY p_partkey LIMIT 10),
    t AS (SELECT 'tv' AS kind, s_suppkey AS id, s_name AS title FROM supplier WHERE contains(lower(s_name), 'ring') ORDER BY s_suppkey LIMIT 10) SELECT * FROM m UNION ALL SELECT * FROM t WHERE (SELECT count(*) FROM m) = 0""")
def search_topk(spark, d):
    """PRED-12, LIM-01."""
    return _search(spark, d, "Ring")


@query("""WITH m AS (SELECT 'movie' AS kind, p_partkey AS id, p_name AS title FROM part WHERE contains(lower(p_name), 'supplier#00') OR contains(lower(p_type), 'supplier#00') ORDER BY p_partkey LIMIT 10),
    t AS (SELECT 'tv' AS kind, s_suppkey AS id, s_name AS title FROM supplier WHERE contains(lower(s_name), 'supplier#00') ORDER BY s_suppkey LIMIT 10) SELECT * FROM m UNION ALL SELECT * FROM t WHERE (SELECT count(*) FROM m) = 0""")
def search_fallback(spark, d):
    """PRED-12, LIM-01: shows only if no movie is found."""
    return _search(spark, d, "supplier#00")


def _search(spark, d, words):
    movies = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("ord"), F.col("p_name").alias("title"), F.col("p_type").alias("original_title"))
    shows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("ord"), F.col("s_name").alias("name"))
    return catalog.search(movies, shows, words)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def paginate(spark, d):
    """LIM-02."""
    rows, _ = catalog.page_list(table(spark, d, "orders"), [F.col("o_orderkey")], "100")
    return rows.select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderdate::VARCHAR AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def newest_first(spark, d):
    """SORT-02."""
    rows = catalog.newest_first(table(spark, d, "orders"), "o_orderdate", "o_orderkey").limit(25)
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"))


# --- joins ---


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def ratings_left_join(spark, d):
    """JOIN-01."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return matching.left_by_key(docs, table(spark, d, "labels"), "doc_id")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45 AND l_orderkey > 0)")
def resume_anti_join(spark, d):
    """JOIN-09, SET-03."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    done = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("key"))
    return matching.resume(orders, done, "key").withColumnRenamed("key", "o_orderkey")


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY ALL")
def seen_dedup(spark, d):
    """JOIN-10, STM-03: each key once, the first by order."""
    e = table(spark, d, "events").select("user_id", "event_type", F.col("event_id").alias("first_event"), F.struct("ts", "event_id").alias("ord"))
    return crawl.unseen(e, e.limit(0), ["user_id", "event_type"]).drop("ord")


def _catalogue(spark, d):
    p = table(spark, d, "part")
    cols = [F.col("p_name").alias("title"), F.lit("").alias("original_title"), F.col("p_size").cast("string").alias("year"), F.col("p_type").alias("director"), F.array("p_brand").alias("cast")]
    return p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), *cols), p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("rid"), *cols)


_N = "regexp_replace(lower(p_name), '[^\\p{L}\\p{Nd}]', '', 'g')"
_PAIRS = f"""SELECT t.p_partkey AS id, r.p_partkey AS rid, CASE WHEN t.n = r.n THEN 0 ELSE 3 END AS probe,
    CASE WHEN t.n = r.n THEN 35 ELSE 5 END + CASE WHEN t.p_size = r.p_size THEN 30 ELSE 0 END + CASE WHEN t.p_type = r.p_type THEN 20 ELSE 0 END + CASE WHEN t.p_brand = r.p_brand THEN 5 ELSE 0 END AS points
    FROM (SELECT *, {_N} AS n FROM part WHERE p_partkey % 2 = 0) t JOIN (SELECT *, {_N} AS n FROM part WHERE p_partkey % 2 = 1) r ON t.n = r.n OR (t.p_size = r.p_size AND t.p_type = r.p_type)"""


@query(f"SELECT id, rid, probe FROM ({_PAIRS})")
def candidate_pairs(spark, d):
    """JOIN-05."""
    return matching.candidates(*_catalogue(spark, d))


@query(f"SELECT id, rid, points, concat_ws('|', CASE WHEN probe = 0 THEN 'exact_title' ELSE 'director_year_only' END, CASE WHEN y THEN 'year' END, CASE WHEN w THEN 'director' END, CASE WHEN b THEN 'cast:*' END) AS signals FROM (SELECT x.*, t.p_size = r.p_size AS y, t.p_type = r.p_type AS w, t.p_brand = r.p_brand AS b FROM ({_PAIRS}) x JOIN part t ON t.p_partkey = id JOIN part r ON r.p_partkey = rid)")
def match_score(spark, d):
    """MATH-01, JOIN-13, SET-04, STR-12."""
    return matching.scored(*_catalogue(spark, d), said=lambda c: F.array_join(c, "|")).drop("probe")


@query(f"SELECT id, rid, probe, points FROM ({_PAIRS}) WHERE points >= 50 QUALIFY row_number() OVER (PARTITION BY id ORDER BY points DESC, probe, rid) = 1")
def match_best(spark, d):
    """JOIN-06, WIN-01."""
    return matching.best_match(*_catalogue(spark, d)).select("id", "rid", "probe", "points")


def _waves(spark, d):
    p = table(spark, d, "part")
    wave = (F.col("p_partkey") % 4).cast("int")
    return p.select(
        (wave.cast("bigint") * 1_000_000_000 + F.col("p_partkey")).alias("ord"), wave.alias("wave"), F.col("p_name").alias("title"), F.col("p_size").cast("string").alias("year"),
        F.when(wave.isin(0, 2), F.col("p_type")).otherwise("").alias("director"), F.element_at(F.array(*map(F.lit, ("catalogue", "encyclopedia", "yearlist", "streaming"))), wave + 1).alias("source"),
    )


@query("SELECT c.n_name, r.r_name, count(*) AS customers FROM customer JOIN nation c ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey GROUP BY ALL")
def dimension_join(spark, d):
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers")).join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "r_name", "customers")


@query("SELECT o.o_orderkey, o.o_orderstatus, string_agg(l_linenumber || '@' || l_partkey, '|' ORDER BY l_linenumber, l_partkey) AS showtimes FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey AND l_quantity > 25 GROUP BY ALL")
def cinema_showtimes(spark, d):
    """JOIN-08."""
    films = table(spark, d, "orders").select(F.col("o_orderkey").alias("film_id"), "o_orderstatus")
    events = table(spark, d, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("film_id"), "l_linenumber", "l_partkey")
    out = matching.with_showtimes(films, events, ["film_id"], ["l_linenumber", "l_partkey"])
    said = F.array_join(F.transform("showtimes", lambda s: F.concat(s["l_linenumber"].cast("string"), F.lit("@"), s["l_partkey"].cast("string"))), "|")
    return out.select(F.col("film_id").alias("o_orderkey"), "o_orderstatus", said.alias("showtimes"))


# --- aggregates ---

_TIER = "CASE WHEN length(text) > 0 AND quality = 1 AND n_chars > 100 AND toxic = 0 THEN 'gold' WHEN length(text) > 0 AND n_chars > 10 AND quality IS NOT NULL THEN 'silver' WHEN length(text) > 0 THEN 'bronze' ELSE 'stub' END"


def _tagged(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    one = lambda c: F.when(c, F.array(F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("x").alias("name"))))
    known = F.col("quality").isNotNull()
    titles = docs.select(
        "doc_id", F.substring("text", 1, 20).alias("title"), F.col("text").alias("overview"), F.when(known, "/p").alias("poster_path"), one(known).alias("genres"),
        one(F.col("quality") == 1).alias("cast"), F.col("n_chars").cast("int").alias("vote_count"), F.when(F.col("toxic") == 0, F.create_map(F.lit("IN"), F.lit(1))).alias("watch_providers"),
        F.lit("2001-02-03").alias("release_date"), F.col("lang").alias("original_language"),
    )
    return tags.tagged(titles, "movie")


@query(f"SELECT doc_id, {_TIER} AS tier, quality IS NOT NULL AND length(text) > 0 AS display_ready, n_chars > 1000 AS very_high_votes, coalesce(quality = 1, false) AS has_cast, lang = 'en' AS is_english FROM documents LEFT JOIN labels USING (doc_id)")
def tag_tiers(spark, d):
    """TAG-02, TAG-03, PRJ-04."""
    return _tagged(spark, d).select("doc_id", "_tags.tier", "_tags.display_ready", "_tags.very_high_votes", "_tags.has_cast", "_tags.is_english")


@query(f"SELECT tier, count(*) AS n, (count(*) * 100) // (SELECT count(*) FROM documents) AS pct FROM (SELECT {_TIER} AS tier FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY tier")
def tag_tier_pct(spark, d):
    """AGG-03, MATH-02."""
    return tags.tier_report(_tagged(spark, d).select("_tags.tier"))


@query("SELECT count(*) AS total, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic, count(*) FILTER (quality IS NULL) AS unlabelled FROM documents LEFT JOIN labels USING (doc_id)")
def enrichment_counts(spark, d):
    """AGG-02."""
    docs = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return tags.enrichment_report(docs, good=F.col("quality") == 1, toxic=F.col("toxic") == 1, unlabelled=F.col("quality").isNull())


@query("SELECT s AS source, count(*) AS n FROM (SELECT unnest([source, lang]) AS s FROM documents) GROUP BY s")
def source_histogram(spark, d):
    """AGG-05."""
    return dedup.source_histogram(table(spark, d, "documents").select(F.array("source", "lang").alias("sources")))


@query("WITH i AS (SELECT o_custkey AS id, 0 AS f FROM orders UNION ALL SELECT l_suppkey, 1 FROM lineitem UNION ALL SELECT l_partkey, 2 FROM lineitem), m AS (SELECT id, min(f) AS f FROM i WHERE id > 0 GROUP BY id) SELECT f AS file, count(*) AS new FROM m GROUP BY f")
def distinct_people(spark, d):
    """AGG-07, WIN-04, SET-02."""
    ids = lambda t, c, f: table(spark, d, t).select(F.lit(f).alias("file"), F.array(F.struct(F.col(c).alias("id"))).alias("cast"), F.expr("CAST(NULL AS array<struct<id:bigint>>)").alias("crew"))
    files = ids("orders", "o_custkey", 0).unionAll(ids("lineitem", "l_suppkey", 1)).unionAll(ids("lineitem", "l_partkey", 2))
    return catalog.person_ids(files)[1]


@query("SELECT user_id, count(*) FILTER (event_type = 'purchase') AS crawled, count(*) FILTER (event_type IN ('error')) AS failed, count(*) AS n, round(count(*) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1e6, 6) AS per_second FROM events GROUP BY user_id")
def crawl_stats(spark, d):
    """AGG-10."""
    out = crawl.crawl_stats(table(spark, d, "events"), "user_id", "event_type", "ts", {"crawled": ["purchase"], "failed": ["error"]})
    return out.withColumn("per_second", F.round("per_second", 6))


@query("SELECT l_orderkey, arg_min(l_returnflag, (l_linenumber, l_returnflag)) AS flag FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey")
def first_nonempty(spark, d):
    """AGG-16."""
    rows = table(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return catalog.first_of(rows, ["l_orderkey"], "flag", ["l_linenumber"])


@query("SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber) = 1")
def crew_dedupe(spark, d):
    """AGG-15."""
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber")
    return catalog.distinct_members(rows, ["l_suppkey", "l_returnflag"], ["l_orderkey", "l_linenumber"])


@query("SELECT 'documents' AS dataset, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'events', count(*) FROM events")
def dataset_counts(spark, d):
    """AGG-09, PRJ-03, SET-01."""
    return catalog.dataset_counts(**{t: table(spark, d, t) for t in ("documents", "pages", "events")})


@query("SELECT sum(x)::BIGINT AS bytes FROM (SELECT length(html) AS x FROM pages ORDER BY url, page_id LIMIT 1000)")
def bucket_size(spark, d):
    """AGG-18."""
    return catalog.bucket_size(table(spark, d, "pages").select(F.struct("url", "page_id").alias("key"), F.char_length("html").alias("size")))


# --- pages ---

_TITLE = r"trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1))"
_ALL = r"""regexp_extract_all(html, '<a href="([^"]*)"', 1)"""
_HOST = r"regexp_extract(url, '^[a-z]+://(?:[^/?#@]*@)?([^/?#]*)', 1)"


@query(f"SELECT page_id, {_TITLE} AS title, len(list_distinct({_ALL})) AS links, sha256(html) AS hash, {_HOST} AS host FROM pages")
def page_parse(spark, d):
    """STR-26, STR-28, SET-05."""
    html = F.col("html")
    return table(spark, d, "pages").select("page_id", P.page_title(html).alias("title"), F.size(P.anchors(html)).cast("bigint").alias("links"), T.content_hash(html).alias("hash"), T.host(F.col("url")).alias("host"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '[ \t\n\r\f]+', ' ', 'g')) AS text FROM pages""")
def page_text(spark, d):
    return table(spark, d, "pages").select("page_id", P.page_text(F.col("html")).alias("text"))


_BASE = r"regexp_extract(url, '^[a-z]+://[^/?#]*', 0)"


@query(f"SELECT url AS src, {_BASE} || a AS dst FROM (SELECT page_id, url, unnest(list_distinct({_ALL})) AS a FROM pages)")
def link_edges(spark, d):
    """STM-04, SET-05."""
    base = F.regexp_extract("url", r"^[a-z]+://[^/?#]*", 0)
    return crawl.link_edges(table(spark, d, "pages").withColumn("links", F.transform(P.anchors(F.col("html")), lambda a: F.concat(base, a))))


@query(f"SELECT page_id, regexp_extract(html, '(?i)<meta\\s+(?:property|name)=\"(?:og:)?description\"\\s+content=\"([^\"]+)\"', 1) AS description, true AS ix FROM pages")
def page_meta(spark, d):
    """JSON-06, PRED-17."""
    html = F.col("html")
    index, _ = T.robots_flags(P.meta_content(html, "robots"))
    return table(spark, d, "pages").select("page_id", P.meta_content(html, "description").alias("description"), index.alias("ix"))


@query()
def page_parse_udf(spark, d):
    """HTML-01, the tokenizer."""
    from ..functions.udfs import parse_pages

    return parse_pages(table(spark, d, "pages")).select("page_id", "title", F.size("links").alias("links"), "text", "content_hash")


@query(f"""SELECT p.page_id, p.path, coalesce(d.l, -1) < 0 OR coalesce(a.l, -1) >= coalesce(d.l, -1) AS allowed FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS path FROM pages) p
    LEFT JOIN (SELECT page_id, max(length(r)) AS l FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS path FROM pages), (VALUES ('/en/', '^/en/'), ('/de/1', '^/de/1')) v(r, p) WHERE regexp_matches(path, p) GROUP BY page_id) d ON d.page_id = p.page_id
    LEFT JOIN (SELECT page_id, max(length(r)) AS l FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS path FROM pages), (VALUES ('/en/2', '^/en/2')) v(r, p) WHERE regexp_matches(path, p) GROUP BY page_id) a ON a.page_id = p.page_id""")
def robots_allowed(spark, d):
    """ROB-02..04, JOIN-12, AGG-17."""
    body = "User-agent: *\nDisallow: /en/\nAllow: /en/2\nDisallow: /de/1\n"
    found = robots.rules(spark.createDataFrame([("all", body)], "domain string, body string"), "skeinbot")
    urls = table(spark, d, "pages").select("page_id", F.lit("all").alias("domain"), T.robots_path(F.col("url")).alias("path"))
    return robots.allowed(urls, found).select("page_id", "path", "allowed")


# --- crawl ---

_GRAPH = "(SELECT DISTINCT 's' || l_suppkey AS src, 'o' || l_orderkey AS dst FROM lineitem WHERE l_quantity >= 48 UNION SELECT DISTINCT 'o' || l_orderkey, 's' || l_suppkey FROM lineitem WHERE l_quantity >= 48)"


@query(f"WITH RECURSIVE g AS MATERIALIZED {_GRAPH}, b(node, depth) AS (SELECT 's1', 0 UNION SELECT g.dst, b.depth + 1 FROM b JOIN g ON g.src = b.node WHERE b.depth < 3) SELECT node, min(depth)::INTEGER AS depth FROM b GROUP BY node")
def link_bfs(spark, d):
    """STM-07."""
    x = table(spark, d, "lineitem").where("l_quantity >= 48").select(F.concat(F.lit("s"), "l_suppkey").alias("s"), F.concat(F.lit("o"), "l_orderkey").alias("o")).distinct()
    edges = x.select(F.col("s").alias("src"), F.col("o").alias("dst")).unionAll(x.select("o", "s"))
    return crawl.breadth_first(edges, spark.createDataFrame([("s1",)], "node string"), 3)


@query("""SELECT event_id, (max(epoch_us(ts) - n * 28800000000) OVER (PARTITION BY user_id ORDER BY n) + n * 28800000000)::BIGINT AS start_us FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events)""")
def rate_pacing(spark, d):
    """WIN-03, STM-08."""
    rows = table(spark, d, "events").select("event_id", "user_id", T.micros(F.col("ts")).alias("arrival_us"))
    return crawl.pacing(rows, F.lit(28_800_000_000), "user_id", "arrival_us", "event_id").select("event_id", "start_us")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def upsert_latest(spark, d):
    """SNK-06."""
    return matching.latest(table(spark, d, "events"), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id", "value")


@query("SELECT a.user_id, a.event_type, b.value IS NULL OR b.value <> a.value AS changed FROM (SELECT user_id, event_type, max(value) AS value FROM events GROUP BY ALL) a LEFT JOIN (SELECT user_id, event_type, max(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY ALL) b USING (user_id, event_type)")
def etag_changed(spark, d):
    """STM-10."""
    e = table(spark, d, "events").withColumn("url", F.concat_ws("/", "user_id", "event_type"))
    mark = lambda x: x.groupBy("url", "user_id", "event_type").agg(F.max("value").alias("content_hash"))
    return crawl.changed(mark(e.where("event_id % 2 = 0")), mark(e)).select("user_id", "event_type", "changed")


@query("SELECT event_id, CASE WHEN k = 'b' THEN 'store' WHEN k = 'a' THEN 'skip' ELSE 'ok' END AS action, props->>'$.k' AS prop FROM (SELECT *, CASE event_type WHEN 'error' THEN 'c' WHEN 'view' THEN 'a' ELSE 'b' END AS k FROM events)")
def status_routing(spark, d):
    """PRED-19."""
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "view", 304).otherwise(200)
    return table(spark, d, "events").select("event_id", crawl.route(status).alias("action"), F.get_json_object("props", "$.k").alias("prop"))


_KEPT = ", ".join(map(repr, COUNTRIES[:5]))


@query(f"SELECT n_regionkey, array_to_string(list_sort(list_filter(list(code), lambda x: x IN ({_KEPT}))), '|') AS kept FROM (SELECT n_regionkey, substr('USGBCAAUNZIEZASGINDEFRJPKRBRMXESITSENLXXYYZZ', (n_nationkey % 22) * 2 + 1, 2) AS code FROM nation) GROUP BY n_regionkey")
def country_map_filter(spark, d):
    """PRED-10, MAP-01."""
    code = F.substring(F.lit("USGBCAAUNZIEZASGINDEFRJPKRBRMXESITSENLXXYYZZ"), (F.col("n_nationkey") % 22) * 2 + 1, F.lit(2))
    offers = table(spark, d, "nation").select("n_regionkey", code.alias("code"), "n_nationkey").groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("code", "n_nationkey"))).alias("m"))
    return offers.select("n_regionkey", F.array_join(F.array_sort(F.map_keys(catalog.kept_countries(F.col("m"), COUNTRIES[:5]))), "|").alias("kept"))


@query("SELECT job_id, arg_max(command, ts_us) AS status FROM (SELECT user_id AS job_id, (ts, event_id) AS ts_us, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' ELSE 'RUNNING' END AS command FROM events) GROUP BY job_id")
def job_status(spark, d):
    """STM-16."""
    command = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "purchase", "finish").otherwise("start")
    jobs = table(spark, d, "events").select(F.col("user_id").alias("job_id"), F.struct(F.col("ts"), F.col("event_id")).alias("at"), command.alias("command"))
    return catalog.job_status(jobs).select("job_id", "status")
