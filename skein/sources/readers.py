"""Sources as DataFrames with fixed schemas (SRC-*). Missing files give empty tables; broken records are marked or dropped."""

from __future__ import annotations

import dataclasses
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import none_if_empty, strip, text, video_url
from ..functions.wikitext import article_kind, categories, clean_field, extract_list, infobox, infobox_fields, plot_section, strip_wikitext, wiki_url
from ..functions.text import content_hash, year_search


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSONL table; a record that doesn't fit the schema has its text in _corrupt_record."""
    full = f"{schema}, _corrupt_record string"
    if not path or not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A headed table of tab-separated values, compressed or not; \\N stays as it is."""
    if not path or not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape="", enforceSchema=True)


def ratings(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """SRC-01, SRC-01b: (tconst, rating, votes): rows that don't parse go, or count as 0 if lenient."""
    rating, votes = F.expr("try_cast(rating AS double)"), F.expr("try_cast(votes AS int)")
    rows = tsv(spark, path, schemas.RATINGS)
    if lenient:
        return rows.select("tconst", F.coalesce(rating, F.lit(0.0)).alias("rating"), F.coalesce(votes, F.lit(0)).alias("votes"))
    return rows.select("tconst", rating.alias("rating"), votes.alias("votes")).dropna()


def names(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02."""
    return tsv(spark, path, schemas.NAMES).select("nconst", "name").dropna()


def principals(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03, the scan; matching.names_of joins and groups."""
    return tsv(spark, path, schemas.PRINCIPALS).withColumn("ordering", F.expr("try_cast(ordering AS int)"))


def basics(spark: SparkSession, path: str) -> DataFrame:
    """PRED-09: series with a start year."""
    return tsv(spark, path, schemas.BASICS).where(F.col("titleType").isin("tvSeries", "tvMiniSeries") & (F.col("startYear") != r"\N"))


def titles(spark: SparkSession, path: str, kind: str = "movie", flat: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-04, SRC-04b, PRED-18: (titles, rejects) of either record form: broken records and those without a title are rejected."""
    rows = json_lines(spark, path, schemas.MOVIES_FLAT if flat else schemas.MOVIES if kind == "movie" else schemas.SHOWS)
    bad = F.col("_corrupt_record").isNotNull() | (text(F.col("title" if kind == "movie" else "name")) == "")
    return rows.where(~bad).drop("_corrupt_record"), rows.where(bad)


def adapt_flat(rows: DataFrame) -> DataFrame:
    """The flat record form with the lists of the newer one: genres, keywords and cast as arrays of structs."""
    named = lambda c: F.transform(F.filter(F.transform(F.split(text(F.col(c)), r"[|,]"), strip), lambda s: s != ""), lambda s: F.struct(F.lit(None).cast("bigint").alias("id"), s.alias("name")))
    return rows.withColumns({"genres": named("genres"), "keywords": named("keywords")})


def articles(spark: SparkSession, films: str, shows: str = "") -> DataFrame:
    """SRC-05, SET-01: films and shows, those with a title."""
    both = json_lines(spark, films, schemas.ARTICLES).unionByName(json_lines(spark, shows, schemas.ARTICLES))
    return both.where(text(F.col("title")) != "").drop("_corrupt_record")


def year_films(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC-06."""
    return json_lines(spark, pattern, schemas.YEAR_FILMS).where(text(F.col("title")) != "").drop("_corrupt_record")


def streaming_records(spark: SparkSession, folder: str, platforms: list[str]) -> DataFrame:
    """SRC-07, SET-01: one file per platform; its name is the platform; languages in lower case."""
    out = None
    for i, p in enumerate(platforms):
        rows = json_lines(spark, f"{folder}/{p}.jsonl", schemas.STREAMING).withColumns({"platform": F.lit(p), "language": F.lower(text(F.col("language"))), "file": F.lit(i)})
        out = rows if out is None else out.unionByName(rows)
    return out.where(text(F.col("title")) != "").drop("_corrupt_record")


def dump(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08, PRED-07: (id, title, markup) of articles of the main namespace that aren't redirects."""
    rows = spark.read.format("xml").option("rowTag", "page").options(ignoreNamespace="true", ignoreSurroundingSpaces="false").schema(schemas.XML_PAGES).load(path)
    return rows.where((F.col("ns") == "0") & F.col("redirect").isNull()).select("id", "title", text(F.col("revision.text")).alias("markup"))


def dump_articles(pages: DataFrame) -> DataFrame:
    """The filter over a dump: films and shows with infobox fields, categories, plot, address and hash (STR-21..28, MAP-02: a missing field is '')."""
    rows = pages.withColumn("type", article_kind(F.col("markup"))).where("type is not null")
    rows = rows.withColumn("box", infobox(F.col("markup"))).withColumn("f", infobox_fields(F.col("box")))
    f = lambda *n: F.coalesce(*(none_if_empty(F.try_element_at("f", F.lit(x))) for x in n), F.lit(""))
    films = F.col("type") == "film"
    return rows.select(
        "title", wiki_url(F.col("title")).alias("url"), "type",
        F.when(films, year_search(f("released"), f("release_date"), f("year"))).otherwise(year_search(f("first_aired"), f("released"), f("year"))).alias("year"),
        clean_field(f("director")).alias("director"), extract_list(f("starring")).alias("starring"), clean_field(f("genre")).alias("genre"),
        clean_field(f("country")).alias("country"), clean_field(f("language")).alias("language"), clean_field(f("runtime")).alias("runtime"),
        clean_field(f("creator")).alias("creator"), clean_field(f("network")).alias("network"), clean_field(f("num_seasons")).alias("num_seasons"),
        clean_field(f("num_episodes")).alias("num_episodes"), plot_section(F.col("markup")).alias("plot_summary"), categories(F.col("markup")).alias("categories"),
        content_hash(F.col("markup")).alias("content_hash"), F.col("id").alias("page_id"),
    )


def dump_pages(pages: DataFrame, project: str, crawl: str) -> DataFrame:
    """STM-13: articles of a dump as crawled pages."""
    return pages.select(
        wiki_url(F.col("title"), escaped=True).alias("url"), "title", F.substring(strip_wikitext(F.col("markup")), 1, 5000).alias("text"),
        content_hash(F.col("markup")).alias("content_hash"), F.lit(0).alias("depth"), F.lit(project).alias("project_id"), F.lit(crawl).alias("crawl_id"),
    )


def export_ids(exports: DataFrame, least: float = 0.0, day: str | None = None, back: int = 4) -> tuple[DataFrame, DataFrame]:
    """SRC-09, SRC-10, PRED-08: (kept, skipped) ids of the latest export of the last days; exports(day, id, popularity)."""
    if day is not None:
        recent = exports.where(F.col("day").between(F.date_sub(F.lit(day).cast("date"), back), F.lit(day).cast("date")))
        exports = recent.join(recent.agg(F.max("day").alias("day")), "day", "left_semi")
    ok = (F.col("id") > 0) & (F.coalesce("popularity", F.lit(0.0)) >= least)
    return exports.where(ok), exports.where(~F.coalesce(ok, F.lit(False)))


def availability_entries(rows: DataFrame) -> DataFrame:
    """SRC-14: (tmdb_id, title) of rows with an id; the title or else the name."""
    have = [F.col(c) for c in ("title", "name") if c in rows.columns]
    return rows.where("tmdb_id > 0").select("tmdb_id", text(F.coalesce(*map(none_if_empty, have))).alias("title"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15."""
    return spark.read.text(path).select(strip(F.col("value")).alias("url")).where(F.col("url").startswith("http"))


def crawled_pages(spark: SparkSession, folder: str, crawl: str | None = None) -> DataFrame:
    """SRC-22, SRC-23: pages written by sinks.pages; one crawl prunes partitions."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schemas.PAGES)
    rows = spark.read.schema(schemas.PAGES).json(folder)
    return rows if crawl is None else rows.where(F.col("crawl_id") == crawl)


def registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-21: (platforms, chains) by region from a nested document; a platform shows its status or else its strategy."""
    entry = "array<struct<name:string,status:string,strategy:string,domain:string>>"
    doc = spark.read.schema(f"ott_platforms map<string,{entry}>, cinema_chains map<string,{entry}>").option("multiLine", True).json(path)
    rows = lambda c: doc.select(F.explode(c).alias("region", "list")).select("region", F.explode("list").alias("e"))
    shown = F.coalesce(none_if_empty(F.col("e.status")), F.col("e.strategy"))
    return rows("ott_platforms").select("region", "e.name", shown.alias("shown")), rows("cinema_chains").select("region", "e.name", F.col("e.strategy").alias("shown"))


def bad_elements_dropped(c: Column, element: str) -> Column:
    """JSON-01: of an array of JSON texts the elements with the given fields (DDL), those that don't fit left out."""
    texts = "|".join(re.findall(r"`?(\w+)`? string", element))
    fits = F.filter(c, lambda x: ~F.schema_of_variant(F.try_parse_json(x)).rlike(rf"(?:<|, )(?:{texts}): (?!STRING|VOID)"))
    read = F.transform(fits, lambda x: F.from_json(x, f"{element}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}))
    return F.transform(F.filter(read, lambda s: s.isNotNull() & s["_corrupt_record"].isNull()), lambda s: s.dropFields("_corrupt_record"))


PAYLOAD = (
    "id bigint, imdb_id string, title string, name string, original_title string, original_name string, adult boolean, overview string, tagline string, release_date string, "
    "first_air_date string, runtime int, budget bigint, revenue bigint, popularity double, vote_average double, vote_count int, status string, original_language string, "
    f"origin_country array<string>, genres {schemas.NAMED}, homepage string, poster_path string, backdrop_path string, belongs_to_collection struct<id:bigint,name:string>, "
    f"credits struct<cast:array<string>,crew:array<string>>, keywords struct<keywords:{schemas.NAMED},results:{schemas.NAMED}>, videos struct<results:array<{schemas.VIDEO}>>, "
    "similar struct<results:array<struct<id:bigint,title:string,name:string>>>, "
    "release_dates struct<results:array<struct<iso_3166_1:string,release_dates:array<struct<certification:string>>>>>, content_ratings struct<results:array<struct<iso_3166_1:string,rating:string>>>, "
    "alternative_titles struct<titles:array<struct<iso_3166_1:string,title:string>>,results:array<struct<iso_3166_1:string,title:string>>>, "
    f"external_ids {schemas.EXTERNAL}, `watch/providers` struct<results:map<string,{schemas.OFFERS}>>"
)


def payload(rows: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """SRC-11, SRC-12, JSON-01..03, AGG-15, AGG-16, STR-29, MAP-01: title records from nested API answers."""
    movie = kind == "movie"
    p = rows.select("*", F.from_json(body, PAYLOAD).alias("p")).where("p is not null and p.id is not null")
    fields = lambda kind: kind.removeprefix("array<struct<").removesuffix(">>").replace(":", " ").replace(",", ", ")
    cast = F.filter(bad_elements_dropped(F.col("p.credits.cast"), fields(schemas.CAST)), lambda m: m["id"] > 0)
    crew = F.filter(bad_elements_dropped(F.col("p.credits.crew"), fields(schemas.CREW)), lambda m: m["id"] != 0)
    job = F.transform(crew, lambda m: F.concat_ws(":", m["id"], m["job"]))
    crew = F.filter(crew, lambda m, i: ~F.array_contains(F.slice(job, F.lit(1), i), F.concat_ws(":", m["id"], m["job"])))
    rated = F.transform("p.release_dates.results", lambda r: F.struct(r["iso_3166_1"].alias("country"), F.try_element_at(F.filter(F.transform(r["release_dates"], lambda d: d["certification"]), lambda c: text(c) != ""), F.lit(1)).alias("certification")))
    certified = F.filter(rated, lambda r: r["certification"].isNotNull()) if movie else F.transform(F.filter("p.content_ratings.results", lambda r: text(r["rating"]) != ""), lambda r: F.struct(r["iso_3166_1"].alias("country"), r["rating"].alias("certification")))
    ext = F.col("p.external_ids")
    similar = F.transform("p.similar.results", lambda s: F.struct(s["id"].alias("id"), (s["title"] if movie else s["name"]).alias("title")))
    providers = F.col("p")["watch/providers"]["results"]
    same = ["adult", "overview", "tagline", "popularity", "vote_average", "vote_count", "status", "original_language", "origin_country", "genres", "homepage", "poster_path", "backdrop_path"]
    own = ["imdb_id", "title", "original_title", "release_date", "runtime", "budget", "revenue", "belongs_to_collection"] if movie else ["name", "original_name", "first_air_date"]
    return p.select(
        F.col("p.id").alias("tmdb_id"), *(F.col(f"p.{c}").alias(c) for c in own + same), cast.alias("cast"), crew.alias("crew"),
        (F.col("p.keywords.keywords") if movie else F.col("p.keywords.results")).alias("keywords"),
        F.transform("p.videos.results", lambda v: v.withField("url", video_url(text(v["site"]), text(v["key"])))).alias("videos"), similar.alias("similar"), certified.alias("certifications"),
        (F.col("p.alternative_titles.titles") if movie else F.col("p.alternative_titles.results")).alias("alternative_titles"),
        F.when((text(ext["imdb_id"]) != "") | (text(ext["wikidata_id"]) != "") | (text(ext["facebook_id"]) != ""), ext).alias("external_ids"),
        F.when(F.size(providers) > 0, providers).alias("watch_providers"),
    )


def person_payload(rows: DataFrame, body: str = "body") -> DataFrame:
    """SRC-13."""
    p = rows.select(F.from_json(body, f"id bigint, {schemas.PERSONS.replace('tmdb_id bigint, imdb_id string, wikidata_id string, ', '')}, imdb_id string, external_ids {schemas.EXTERNAL}").alias("p")).where("p.id is not null")
    keep = ["name", "also_known_as", "biography", "birthday", "deathday", "gender", "place_of_birth", "popularity", "profile_path", "known_for_department", "adult"]
    ids = F.coalesce(none_if_empty(F.col("p.external_ids.imdb_id")), F.col("p.imdb_id"))
    return p.select(F.col("p.id").alias("tmdb_id"), ids.alias("imdb_id"), F.col("p.external_ids.wikidata_id").alias("wikidata_id"), *(f"p.{c}" for c in keep))


def cinema_payload(rows: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """SRC-20: (films, events) of cinemas(cinema_id, body)."""
    kind = "body struct<films:array<struct<id:string,name:string,length:int>>,events:array<struct<id:string,filmId:string,eventDateTime:string,bookingLink:string,auditorium:string>>>"
    p = rows.select("cinema_id", F.from_json(body, kind).alias("p"))
    films = p.select("cinema_id", F.explode("p.body.films").alias("f")).select("cinema_id", F.col("f.id").alias("film_id"), F.col("f.name").alias("film_name"), F.col("f.length").alias("runtime"))
    events = p.select("cinema_id", F.explode("p.body.events").alias("e")).select("cinema_id", F.col("e.filmId").alias("film_id"), F.col("e.eventDateTime").alias("time"), F.col("e.bookingLink").alias("booking_url"), F.col("e.auditorium").alias("auditorium"))
    return films, events


@dataclasses.dataclass
class Settings:
    """SRC-25: settings from the environment, with defaults."""

    mode: str = "local"
    port: int = 50051
    workers: int = dataclasses.field(default_factory=lambda: os.cpu_count() or 1)
    data_dir: str = "./data"

    @classmethod
    def load(cls, env: dict[str, str]) -> "Settings":
        got = {f.name: env[f.name.upper()] for f in dataclasses.fields(cls) if env.get(f.name.upper())}
        return cls(**{k: int(v) if k in ("port", "workers") else v for k, v in got.items()})


def env_file(content: str, env: dict[str, str]) -> dict[str, str]:
    """SRC-24: key=value lines; blank lines and comments are skipped; what is set already wins."""
    pairs = (line.split("=", 1) for line in map(str.strip, content.splitlines()) if line and not line.startswith("#") and "=" in line)
    return {k.strip(): v.strip() for k, v in pairs} | env
