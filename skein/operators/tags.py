"""Completeness and quality tags of titles (TAG-01..03, ARR-01..03, AGG-02..04, MATH-02, PRJ-04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dims import INDIAN
from ..functions.text import text, year_chars


def size_of(c: Column) -> Column:
    """ARR-01: length of an array or map, 0 if null."""
    return F.coalesce(F.size(c), F.lit(0))


def percent(n: Column, total: Column) -> Column:
    """MATH-02: whole percents, 0 of nothing."""
    return F.coalesce(F.try_divide(n * 100, total), F.lit(0)).cast("bigint")


def director(crew: Column) -> Column:
    """ARR-02: the first named crew member whose job is Director, or ''."""
    return text(F.try_element_at(F.filter(crew, lambda m: (m["job"] == "Director") & (text(m["name"]) != "")), F.lit(1))["name"])


def tags(titles: DataFrame, kind: str) -> Column:
    """TAG-01..03: the struct of tags for titles of one kind ("movie" or "tv"). Columns that are missing count as null,
    and null, empty and zero all as not present."""
    have = {f.name: f.dataType for f in titles.schema.fields}
    s = lambda c: text(F.col(c).cast("string")) if c in have else F.lit("")
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)
    size = lambda c: size_of(F.col(c)) if c in have else F.lit(0)
    arr = lambda c, ok: F.size(F.filter(F.col(c), ok)) if c in have else F.lit(0)
    movie = kind == "movie"
    name, original, date = ("title", "original_title", "release_date") if movie else ("name", "original_name", "first_air_date")
    ext = "external_ids" in have
    id_of = lambda f: F.when(F.col("external_ids").isNotNull(), text(F.col(f"external_ids.{f}"))).otherwise(s("imdb_id") if f == "imdb_id" else F.lit("")) if ext else (s("imdb_id") if f == "imdb_id" else F.lit(""))
    origin = lambda code: F.coalesce(F.array_contains("origin_country", code), F.lit(False)) if "origin_country" in have else F.lit(False)
    year = year_chars(s(date), else_empty=True)
    votes = n("vote_count").cast("int")
    overview, poster, genres = s("overview") != "", s("poster_path") != "", size("genres") > 0
    trailers = arr("videos", lambda v: v["type"].isin("Trailer", "Teaser"))
    tier = (
        F.when(overview & poster & (size("cast") > 0) & genres & (votes > 100) & (size("watch_providers") > 0), "gold")
        .when(overview & poster & genres & (votes > 10), "silver")
        .when(overview, "bronze")
        .otherwise("stub")
    )
    out = {
        "has_overview": overview, "has_poster": poster, "has_backdrop": s("backdrop_path") != "", "has_genres": genres,
        "has_keywords": size("keywords") > 0, "has_cast": size("cast") > 0, "has_crew": size("crew") > 0,
        "has_tagline": s("tagline") != "", "has_homepage": s("homepage") != "",
        "cast_count": size("cast"), "crew_count": size("crew"), "keyword_count": size("keywords"),
        "has_runtime": (n("runtime") > 0) if movie else F.lit(False), "has_release_date": s(date) != "",
        "has_original_title": (s(original) != "") & (s(original) != s(name)),
        "has_collection": F.col("belongs_to_collection").isNotNull() if movie and "belongs_to_collection" in have else F.lit(False),
        "has_budget": (n("budget") > 0) if movie else F.lit(False), "has_revenue": (n("revenue") > 0) if movie else F.lit(False),
        "release_year": year, "has_director": arr("crew", lambda m: m["job"] == "Director") > 0,
        "has_imdb_id": id_of("imdb_id") != "", "has_wikidata": id_of("wikidata_id") != "",
        "has_external_ids": (F.col("external_ids").isNotNull() & ((id_of("imdb_id") != "") | (id_of("wikidata_id") != ""))) if ext else F.lit(False),
        "has_imdb_rating": n("imdb_rating") > 0,
        "has_trailers": trailers > 0, "trailer_count": trailers, "has_videos": size("videos") > 0, "video_count": size("videos"),
        "has_availability": size("watch_providers") > 0, "available_countries": size("watch_providers"),
        "has_similar": size("similar") > 0, "has_alternative_titles": size("alternative_titles") > 0, "has_certification": size("certifications") > 0,
        "vote_count": votes, "vote_average": n("vote_average"), "popularity": n("popularity"),
        "high_vote_count": votes > 100, "very_high_votes": votes > 1000, "popular": n("popularity") > 10, "very_popular": n("popularity") > 50,
        "high_rated": (n("vote_average") >= 7.0) & (votes > 50),
        "is_adult": F.coalesce(F.col("adult"), F.lit(False)) if "adult" in have else F.lit(False),
        "is_released": s("status").isin("Released", "Ended", "Returning Series"), "original_language": s("original_language"),
        "is_english": s("original_language") == "en", "is_indian": origin("IN") | s("original_language").isin(*INDIAN),
        "is_korean": origin("KR"), "is_japanese": origin("JP"), "tier": tier,
        "display_ready": (F.coalesce(F.nullif(s("title"), F.lit("")), s("name")) != "") & poster & overview & genres & (year != ""),
    }
    return F.struct(*(F.coalesce(c, F.lit(False)).alias(k) if k.startswith(("has_", "is_", "high", "very", "popular", "display")) and k != "popularity" else c.alias(k) for k, c in out.items()))


def tagged(titles: DataFrame, kind: str) -> DataFrame:
    """PRJ-04: all columns and _tags."""
    return titles.withColumn("_tags", tags(titles, kind))


def tier_report(rows: DataFrame, tier: str = "tier") -> DataFrame:
    """AGG-03: (tier, n, pct) with whole percents."""
    counts = rows.groupBy(tier).agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy())  # over a row per tier
    return counts.select(tier, "n", percent(F.col("n"), whole).alias("pct"))


def enrichment_report(rows: DataFrame, **conditions: Column) -> DataFrame:
    """AGG-02, AGG-04, AGG-08: one row of conditional counts, and the total."""
    return rows.agg(F.count("*").alias("total"), *(F.count_if(c).alias(k) for k, c in conditions.items()))
