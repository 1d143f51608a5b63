"""Catalogue queries and state tables (PRED-12..14, LIM-01, 02, PRJ-03..06, SORT-02, AGG-07, 09, 18, WIN-04, MAP-01, STM-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import text
from .tags import size_of


def search(movies: DataFrame, shows: DataFrame, words: str, limit: int = 10) -> DataFrame:
    """PRED-12, LIM-01: (kind, id, title) of the first movies by ord whose title or original title has the words, but for
    case; shows, by name, only if no movie has."""
    has = lambda c: F.contains(F.lower(text(F.col(c))), F.lit(words.lower()))
    hits = movies.where(has("title") | has("original_title")).orderBy("ord").limit(limit).select(F.lit("movie").alias("kind"), "id", "title")
    more = shows.where(has("name")).orderBy("ord").limit(limit).select(F.lit("tv").alias("kind"), "id", F.col("name").alias("title"))
    none = hits.agg((F.count("*") == 0).alias("none"))
    return hits.unionByName(more.crossJoin(F.broadcast(none)).where("none").drop("none"))


def hit_card(df: DataFrame) -> DataFrame:
    """PRJ-05: what a search result shows."""
    return df.select("id", "title", F.substring(text(F.col("release_date")), 1, 4).alias("year"), *(size_of(F.col(c)).alias(f"{c}_count") for c in ("cast", "videos", "watch_providers")))


def lookup(first: DataFrame, second: DataFrame, key: str, value) -> DataFrame:
    """PRED-13: the row of the first table with that key, else of the second one; columns of either."""
    both = first.where(F.col(key) == value).limit(1).withColumn("__o", F.lit(0)).unionByName(second.where(F.col(key) == value).limit(1).withColumn("__o", F.lit(1)), allowMissingColumns=True)
    return both.orderBy("__o").limit(1).drop("__o")


def page_by_url(pages: DataFrame, url: str) -> DataFrame:
    """PRED-14."""
    return pages.where((F.col("url") == url) | (F.col("final_url") == url)).limit(1)


def page_list(df: DataFrame, order: list[Column], token: str = "", size: int = 50) -> tuple[DataFrame, str]:
    """LIM-02: (rows, next token): the token is an offset, a bad one 0; no next token after a short page."""
    at = int(token) if token.isdecimal() else 0
    rows = df.orderBy(*order).offset(at).limit(size)
    return rows, str(at + size) if rows.count() == size else ""


def union_sources(*frames: DataFrame) -> DataFrame:
    """PRJ-03, SET-01: per-source columns put together by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def updated(table: DataFrame, key: str, value, **new) -> DataFrame:
    """PRJ-06: fields that are given and not empty replace old ones in the row of that key."""
    change = {k: F.when(F.col(key) == value, F.lit(v)).otherwise(F.col(k)) for k, v in new.items() if v not in (None, "", [], 0)}
    return table.withColumns(change) if change else table


def newest_first(table: DataFrame, at: str = "created_at", key: str = "id") -> DataFrame:
    """SORT-02: ties by key."""
    return table.orderBy(F.desc(at), key)


def person_ids(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AGG-07, SET-02, WIN-04: (distinct ids, new ids by file) over files(file, cast, crew), in order of file."""
    ids = files.select("file", F.explode(F.concat(F.coalesce("cast.id", F.array().cast("array<bigint>")), F.coalesce("crew.id", F.array().cast("array<bigint>")))).alias("id")).where("id > 0")
    firsts = ids.groupBy("id").agg(F.min("file").alias("file"))
    return firsts.select("id"), firsts.groupBy("file").agg(F.count("*").alias("new"))


def dataset_counts(**frames: DataFrame) -> DataFrame:
    """AGG-09: (dataset, n)."""
    return union_sources(*(f.agg(F.count("*").alias("n")).select(F.lit(k).alias("dataset"), "n") for k, f in frames.items()))


def bucket_size(listing: DataFrame, first: int = 1000) -> DataFrame:
    """AGG-18: bytes of the first objects of a listing by key."""
    return listing.orderBy("key").limit(first).agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def kept_countries(offers: Column, codes: list[str], empty_as_null: bool = False) -> Column:
    """PRED-10, MAP-01."""
    out = F.map_filter(offers, lambda k, _: k.isin(*codes))
    return F.when(F.size(out) > 0, out) if empty_as_null else out


def trailers(videos: Column) -> Column:
    """PRED-11."""
    return F.filter(videos, lambda v: v["type"].isin("Trailer", "Teaser"))


def first_of(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """AGG-16: per key the first value that isn't empty."""
    return df.where(text(F.col(value)) != "").groupBy(*keys).agg(F.min_by(value, F.struct(*order, value)).alias(value))


def distinct_members(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """AGG-15: the first row of each key, all columns."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


#: Transitions of a crawl job by command; others leave it as it is.
TRANSITIONS = {"start": "RUNNING", "pause": "PAUSED", "resume": "RUNNING", "stop": "CANCELLED", "finish": "COMPLETED", "fail": "FAILED"}


def job_status(commands: DataFrame) -> DataFrame:
    """STM-16: each job's status after its last command, jobs(job_id, at, command)."""
    status = F.create_map(*(F.lit(x) for kv in TRANSITIONS.items() for x in kv))[F.col("command")]
    known = commands.withColumn("status", status).where("status is not null")
    return known.groupBy("job_id").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("updated_at"))


#: Fields of a crawl project that a caller sets; a project of a list is shown with them.
PROJECT = "id string, name string, seeds array<string>, created_at bigint, updated_at bigint"


def created(projects: DataFrame, new: DataFrame) -> DataFrame:
    """Projects with the new ones; one whose id is there already changes nothing."""
    return projects.unionByName(new.join(projects.select("id"), "id", "left_anti"), allowMissingColumns=True)


def deleted(table: DataFrame, key: str, *values) -> DataFrame:
    """The table without the rows of these keys."""
    return table.where(~F.coalesce(F.col(key).isin(*values), F.lit(False)))


def progress(done: Column, total: Column, seconds: Column) -> tuple[Column, Column]:
    """AGG-11: rows a second so far, and the seconds that the rest will take at that rate; null before anything is done."""
    rate = F.when(seconds > 0, done / seconds)
    return rate, F.when(rate > 0, (total - done) / rate)
