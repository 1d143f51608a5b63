"""Schemas of the canonical tables, as DDL."""

PERSON = "id bigint, name string"
PROVIDER = "struct<provider_id:bigint,provider_name:string,logo_path:string>"
OFFERS = f"struct<flatrate:array<{PROVIDER}>,rent:array<{PROVIDER}>,buy:array<{PROVIDER}>,free:array<{PROVIDER}>,ads:array<{PROVIDER}>>"
CAST = "array<struct<id:bigint,name:string,character:string,`order`:int,profile_path:string,gender:int,popularity:double,known_for_department:string>>"
CREW = "array<struct<id:bigint,name:string,job:string,department:string,profile_path:string,gender:int>>"
VIDEO = "struct<id:string,name:string,key:string,site:string,type:string,official:boolean,size:int,published_at:string,url:string>"
NAMED = "array<struct<id:bigint,name:string>>"
EXTERNAL = "struct<imdb_id:string,wikidata_id:string,facebook_id:string,instagram_id:string,twitter_id:string>"
_COMMON = (
    "adult boolean, overview string, tagline string, popularity double, vote_average double, vote_count int, status string, "
    f"original_language string, origin_country array<string>, genres {NAMED}, homepage string, poster_path string, backdrop_path string, "
    f"cast {CAST}, crew {CREW}, keywords {NAMED}, videos array<{VIDEO}>, similar array<struct<id:bigint,title:string>>, "
    "certifications array<struct<country:string,certification:string>>, alternative_titles array<struct<iso_3166_1:string,title:string>>, "
    f"external_ids {EXTERNAL}, watch_providers map<string,{OFFERS}>, fetched_at string"
)
MOVIES = f"tmdb_id bigint, imdb_id string, title string, original_title string, release_date string, runtime int, budget bigint, revenue bigint, belongs_to_collection struct<id:bigint,name:string>, {_COMMON}"
SHOWS = (
    "tmdb_id bigint, name string, original_name string, first_air_date string, last_air_date string, type string, in_production boolean, "
    f"number_of_seasons int, number_of_episodes int, episode_run_time array<int>, networks {NAMED}, created_by {NAMED}, {_COMMON}"
)
#: The older flat form: lists as text.
MOVIES_FLAT = (
    "tmdb_id bigint, imdb_id string, title string, original_title string, overview string, tagline string, release_date string, runtime int, budget bigint, "
    "revenue bigint, popularity double, vote_average double, vote_count int, status string, original_language string, spoken_languages string, "
    "production_countries string, production_companies string, genres string, keywords string, cast_top10 string, director string, poster_path string, "
    "backdrop_path string, homepage string, imdb_rating string, imdb_votes string, belongs_to_collection string"
)
PERSONS = (
    "tmdb_id bigint, imdb_id string, wikidata_id string, name string, also_known_as array<string>, biography string, birthday string, deathday string, "
    "gender int, place_of_birth string, popularity double, profile_path string, known_for_department string, adult boolean, fetched_at string"
)
RATINGS = "tconst string, rating string, votes string"
NAMES = "nconst string, name string, birth string, death string, professions string, known_for string"
PRINCIPALS = "tconst string, ordering string, nconst string, category string, job string, characters string"
BASICS = "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, startYear string, endYear string, runtime string, genres string"
ARTICLES = (
    "title string, url string, type string, year string, director string, starring array<string>, genre string, country string, language string, runtime string, "
    "creator string, network string, num_seasons string, num_episodes string, plot_summary string, categories array<string>, content_hash string, page_id bigint"
)
YEAR_FILMS = "title string, year int, language string, language_code string, director string, cast array<string>, production_company string, genre string, release_month string, wiki_source_page string"
STREAMING = (
    "platform string, url string, content_type string, title string, description string, year string, language string, genres array<string>, cast array<string>, "
    "director string, duration string, thumbnail_url string, banner_url string, age_rating string, free_or_paid string, crawled_at string, raw_ld_json string"
)
AVAILABILITY = f"tmdb_id bigint, title string, content_type string, availability map<string,{OFFERS}>, trailers array<{VIDEO}>, all_videos array<{VIDEO}>, fetched_at string"
PAGES = (
    "url string, final_url string, status_code int, title string, text string, links array<string>, meta_description string, canonical_url string, "
    "content_hash string, depth int, crawled_at timestamp, project_id string, crawl_id string"
)
EXPORT_IDS = "id bigint, popularity double, adult boolean, name string, original_title string"
XML_PAGES = "id bigint, ns string, title string, redirect struct<_title:string>, revision struct<id:bigint,text:string>"
