"""The enriched title record, end to end: ratings, cast, identifiers and matched articles (PRJ-01, PRJ-02, JOIN-01..06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cast_names, if_other, parse_cast, text, year_prefix
from . import matching

MEMBER = "array<struct<name:string,character:string,role:string>>"
#: Of shows these are empty in the record.
OF_MOVIES = {"runtime": "int", "budget": "bigint", "revenue": "bigint", "spoken_languages": "string", "production_countries": "string", "director": "string", "belongs_to_collection": "string"}
SAME = ["overview", "tagline", "status", "original_language", "production_companies", "genres", "keywords", "poster_path", "backdrop_path", "homepage"]


def _or_empty(c: str, kind: str, have: bool) -> Column:
    value = F.col(c).cast(kind) if have else F.lit(None).cast(kind)
    return F.coalesce(value, F.lit("" if kind == "string" else 0).cast(kind)).alias(c)


def enrich(titles: DataFrame, kind: str, ratings: DataFrame, casts: DataFrame, articles: DataFrame, basics: DataFrame | None = None) -> DataFrame:
    """One record of 33 fields for each title of the flat form (readers.titles): movies, or shows if kind is "tv".

    ratings(tconst, rating, votes) and casts(tconst, cast) meet movies by imdb_id, shows by the id that basics has for
    (name, year). articles(rid, title, year, director, starring, plot_summary, categories, url) are matched by score;
    those that match a movie add members to its cast, those of a show don't. What is missing is empty or zero.
    """
    movie = kind == "movie"
    name, original, date = ("title", "original_title", "release_date") if movie else ("name", "original_name", "first_air_date")
    have = set(titles.columns)
    rows = titles.where(text(F.col(name)) != "").select(
        F.col("tmdb_id").alias("id"), text(F.col("imdb_id")).alias("imdb_id") if movie else F.lit("").alias("imdb_id"), F.col(name).alias("title"),
        text(F.col(original)).alias("original"), year_prefix(F.col(date)).alias("year"), text(F.col(date)).alias("release_date"),
        *(_or_empty(c, "string", c in have) for c in SAME), *(_or_empty(c, k, movie and c in have) for c, k in OF_MOVIES.items()),
        F.coalesce("vote_average", F.lit(0.0)).alias("tmdb_rating"), F.coalesce("vote_count", F.lit(0)).alias("tmdb_vote_count"),
        parse_cast(F.col("cast_top10")).cast(MEMBER).alias("cast"), cast_names(F.col("cast_top10")).alias("names"),
    )
    if not movie and basics is not None:
        shows = rows.select("id", F.col("title").alias("name"), F.col("original").alias("original_name"), "year")
        found = matching.series_ids(shows, basics).select(F.col("id").alias("sid"), "tconst").where(F.col("tconst").isNotNull())
        rows = rows.join(found, F.col("id") == F.col("sid"), "left").withColumn("imdb_id", text(F.col("tconst"))).drop("sid", "tconst")
    rows = matching.left_by_key(rows, ratings.select("tconst", "rating", "votes"), "imdb_id", "tconst")
    rows = matching.with_cast(rows, casts.select("tconst", F.col("cast").cast(MEMBER).alias("cast")))
    sought = rows.select("id", "title", F.col("original").alias("original_title"), "year", "director", F.col("names").alias("cast"))
    best = matching.best_match(sought, articles.select("rid", "title", "year", "director", F.col("starring").alias("cast")))
    best = best.join(articles.select("rid", "plot_summary", "categories", F.col("url").alias("wiki_url"), "starring"), "rid").select(F.col("id").alias("mid"), "points", "signals", "plot_summary", "categories", "wiki_url", "starring")
    rows = rows.join(best, F.col("id") == F.col("mid"), "left")
    if movie:
        low = F.transform("cast", lambda m: F.lower(m["name"]))
        more = F.filter("starring", lambda n: ~F.array_contains(low, F.lower(n)))
        names = F.transform(more, F.lower)
        more = F.filter(more, lambda n, i: ~F.array_contains(F.slice(names, F.lit(1), i), F.lower(n)))
        added = F.transform(more, lambda n: F.struct(n.alias("name"), F.lit("").alias("character"), F.lit("actor").alias("role"))).cast(MEMBER)
        rows = rows.withColumn("cast", F.concat("cast", F.coalesce(added, F.array().cast(MEMBER))))
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("id").cast("string").alias("tmdb_id"), "imdb_id", "title", "year", if_other(F.col("original"), F.col("title")).alias("original_title"), "overview", "tagline", "release_date",
        "runtime", "budget", "revenue", "status", "original_language", "spoken_languages", "production_countries", "production_companies", "genres", "keywords", "director", "poster_path",
        "backdrop_path", "homepage", "belongs_to_collection", F.coalesce("rating", F.lit(0.0)).alias("imdb_rating"), F.coalesce("votes", F.lit(0)).alias("imdb_votes"), "tmdb_rating",
        "tmdb_vote_count", "cast", text(F.col("plot_summary")).alias("wiki_plot_summary"), F.coalesce("categories", none).alias("wiki_categories"), text(F.col("wiki_url")).alias("wiki_url"),
        (F.coalesce("points", F.lit(0)) / 100).alias("wiki_confidence"), F.coalesce("signals", none).alias("wiki_match_signals"), F.lit(kind).alias("content_type"),
    )
