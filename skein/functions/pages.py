"""Page content by expressions: JSON-LD, meta elements, year tables (JSON-04..06, HTML-02..04, STR-13, 20, SRC-19)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import is_month, none_if_empty, split_names, squeeze, strip, text

#: The references decoded in table cells.
CELL_REFERENCES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]
RECORD_TYPES = ["VideoObject", "Movie", "TVSeries", "TVEpisode"]


def clean_cell(c: Column) -> Column:
    """STR-13: bracketed notes go before tags and references, so that encoded brackets survive."""
    out = F.regexp_replace(F.regexp_replace(c, r"\[.*?\]", ""), r"<[^>]+>", "")
    return squeeze(reduce(lambda a, r: F.replace(a, F.lit(r[0]), F.lit(r[1])), CELL_REFERENCES, out))


def anchor_names(c: Column) -> Column:
    """STR-20: names in anchors that have a title: shown text, else the title; 3 to 59 bytes; distinct but for case;
    neither months nor numbers."""
    pattern = F.lit(r'(?s)<a[^>]*title="([^"]*)"[^>]*>(.*?)</a>')
    titles, shown = F.regexp_extract_all(c, pattern, F.lit(1)), F.regexp_extract_all(c, pattern, F.lit(2))
    names = F.transform(F.arrays_zip(titles.alias("t"), shown.alias("s")), lambda x: F.coalesce(none_if_empty(clean_cell(x["s"])), clean_cell(x["t"])))
    good = F.filter(names, lambda n: (F.octet_length(n) > 2) & (F.octet_length(n) < 60) & ~is_month(F.upper(n)) & ~n.rlike(r"^\d+\z"))
    low = F.transform(good, F.lower)
    return F.filter(good, lambda n, i: ~F.array_contains(F.slice(low, F.lit(1), i), F.lower(n)))


def year_tables(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """HTML-02, WIN-02: film rows of a year page's tables: keys, title, director, cast, production_company,
    release_month, table_no, row_no. A month cell holds for later rows and tables of the page."""
    tables = pages.select(*keys, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?s)<table[^>]*>(.*?)</table>"), F.lit(1))).alias("table_no", "table"))
    heads = F.transform(F.regexp_extract_all("table", F.lit(r"(?s)<th[^>]*>(.*?)</th>"), F.lit(1)), lambda h: F.lower(clean_cell(h)))
    tables = tables.where((F.size(heads) >= 3) & F.exists(heads, lambda h: h.contains("title") | h.contains("film")))
    rows = tables.select(*keys, "table_no", F.posexplode(F.regexp_extract_all("table", F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("row_no", "row"))
    rows = rows.where(~F.col("row").contains("<th")).withColumn("raw", F.regexp_extract_all("row", F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)))
    rows = rows.where(F.size("raw") >= 3).withColumn("cells", F.transform("raw", clean_cell))
    months = F.filter(F.transform(F.slice("cells", 1, 2), F.upper), is_month)
    month = F.initcap(F.try_element_at(months, F.lit(-1)))
    order = Window.partitionBy(*keys).orderBy("table_no", "row_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("release_month", text(F.last(month, ignorenulls=True).over(order)))
    is_title = lambda s: (s != "") & ~is_month(F.upper(s)) & ~s.rlike(r"^[+-]?\d+\z")
    rows = rows.withColumn("at", F.array_position(F.transform("cells", is_title), True)).where("at > 0")
    cell = lambda c, k: text(F.get(c, F.col("at").cast("int") - 1 + k))
    cast = F.when(F.size(anchor_names(cell("raw", 2))) > 0, anchor_names(cell("raw", 2))).otherwise(split_names(cell("cells", 2)))
    made = F.when(cell("cells", 3).startswith("["), "").otherwise(cell("cells", 3))
    return rows.select(
        *keys, cell("cells", 0).alias("title"), cell("cells", 1).alias("director"), cast.alias("cast"), made.alias("production_company"), "release_month", "table_no", "row_no"
    )


def first_pattern(found: DataFrame, keys: list[str], rank: str = "pattern") -> DataFrame:
    """SRC-19: of the pages tried per key, the rows of the first one that has any."""
    least = found.groupBy(*keys).agg(F.min(rank).alias(rank))
    return found.join(least, [*keys, rank], "left_semi")


def json_ld_blocks(c: Column) -> Column:
    """JSON-04: the bodies of JSON-LD scripts, in order."""
    return F.regexp_extract_all(text(c), F.lit(r'(?s)<script type="application/ld\+json">\s*(.*?)\s*</script>'), F.lit(1))


def json_ld(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """JSON-04: one row per object: keys, no (block), item (place in an array block), ld (variant). Broken blocks go."""
    blocks = pages.select(*keys, F.posexplode(json_ld_blocks(F.col(html))).alias("no", "body"))
    whole = F.try_parse_json("body")
    items = blocks.withColumn("v", whole).where("v is not null")
    many = F.expr("try_variant_get(v, '$', 'array<variant>')")
    return items.select(*keys, "no", F.posexplode(F.coalesce(many, F.array("v"))).alias("item", "ld"))


def json_ld_types(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """HTML-04, AGG-19: the distinct @type texts of each key in order of their first place."""
    typed = json_ld(pages, keys, html).withColumn("type", F.expr("try_variant_get(ld, '$[\"@type\"]', 'string')")).where("type is not null")
    got = typed.groupBy(*keys).agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("no", "item", "type"))), lambda s: s["type"])).alias("types"))
    return got


def json_ld_records(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """JSON-05, DATE-04: one record per key, folded over its blocks in order: later names win, images fill blanks, genres and cast
    add up, the year is the first found."""
    v = lambda path, kind="string": F.expr(f"try_variant_get(ld, '{path}', '{kind}')")
    text_of = lambda name: F.when(F.expr(f"schema_of_variant(variant_get(ld, '$.{name}')) = 'STRING'"), none_if_empty(v(f"$.{name}")))
    rows = json_ld(pages, keys, html).withColumn("type", v('$["@type"]')).where(F.col("type").isin(*RECORD_TYPES))
    dated = [none_if_empty(F.regexp_extract(text(v(f"$.{f}")), r"(?:19|20)\d{2}", 0)) for f in ("uploadDate", "dateCreated", "datePublished")]
    offer = "$.potentialAction.expectsAcceptanceOf"
    name = text(v(f"{offer}.name"))
    paid = F.when(name.contains("free"), "free").when(name.contains("premium") | name.contains("subscription"), "subscription").otherwise(v(f"{offer}.category"))
    targets = F.filter(F.transform(F.coalesce(v("$.potentialAction.target", "array<variant>"), F.expr("array()")), lambda t: F.try_variant_get(t, "$.inLanguage", "string")), lambda s: s.isNotNull())
    people = lambda f: F.filter(F.transform(F.coalesce(v(f"$.{f}", "array<variant>"), F.expr("array()")), lambda t: F.try_variant_get(t, "$.name", "string")), lambda s: s.isNotNull())
    cols = {
        "title": text_of("name"), "description": text_of("description"), "thumb": F.coalesce(text_of("thumbnailURL"), text_of("thumbnailUrl"), text_of("thumbnail")),
        "image": text_of("image"), "language": F.coalesce(F.try_element_at(targets, F.lit(-1)), text_of("inLanguage")), "age_rating": text_of("typicalAgeRange"),
        "duration": text_of("duration"), "release": text_of("releaseYear"), "dated": F.coalesce(*dated), "paid": paid,
        "genres": F.coalesce(v("$.genre", "array<string>"), F.array_compact(F.array(text_of("genre")))), "cast": people("actor"),
        "director": F.coalesce(v("$.director.name"), F.try_element_at(people("director"), F.lit(1))),
        "kind": F.when(F.col("type") == "Movie", "movie").when(F.col("type") == "TVSeries", "show").when(F.col("type") == "TVEpisode", "episode"),
    }
    rows = rows.select(*keys, "no", "item", *(c.alias(k) for k, c in cols.items()))
    order = F.struct("no", "item")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order))
    lists = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "item", c))), lambda s: s[c]))
    out = rows.groupBy(*keys).agg(
        *(text(last(c)).alias(c) for c in ("title", "description", "language", "age_rating", "duration", "director")),
        text(F.coalesce(last("thumb"), first("image"))).alias("thumbnail_url"), text(first("image")).alias("banner_url"),
        text(F.coalesce(last("release"), first("dated"))).alias("year"), text(last("paid")).alias("free_or_paid"), text(last("kind")).alias("content_type"),
        lists("genres").alias("genres"), lists("cast").alias("cast"),
    )
    return out.where("title <> ''")


def meta_content(c: Column, name: str) -> Column:
    """JSON-06: content of the first meta element of that name or og:name, if the name stands first; else ''."""
    return F.regexp_extract(text(c), rf'(?i)<meta\s+(?:property|name)="(?:og:)?\Q{name}\E"\s+content="([^"]+)"', 1)


def banner(c: Column) -> Column:
    """JSON-06: og:image with its ampersands decoded."""
    return F.replace(meta_content(c, "image"), F.lit("&amp;"), F.lit("&"))


def anchors(c: Column) -> Column:
    """HTML-01, SET-05 by expression: addresses of anchors, distinct, in order."""
    return F.array_distinct(F.regexp_extract_all(text(c), F.lit(r'<a href="([^"]*)"'), F.lit(1)))


def page_title(c: Column) -> Column:
    return strip(F.regexp_extract(text(c), r"(?s)<title>(.*?)</title>", 1))


def page_text(c: Column) -> Column:
    """HTML-01 by expression: text outside scripts, styles and comments, tags and the basic references resolved."""
    out = F.regexp_replace(text(c), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for a, b in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, r"[ \t\n\r\f]+", " "))


def page_records(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """HTML-03: streaming records of pages: JSON-LD first, then the banner, title, description and language of the meta
    elements where that is blank; a page without a title gives none."""
    h = F.col(html)
    meta = pages.select(
        *keys, meta_content(h, "title").alias("m_title"), meta_content(h, "description").alias("m_description"), banner(h).alias("m_banner"),
        meta_content(h, "inLanguage").alias("m_language"), page_title(h).alias("p_title"),
    )
    both = meta.join(json_ld_records(pages, keys, html), keys, "left")
    pick = lambda *c: text(F.coalesce(*(none_if_empty(F.col(x)) for x in c)))
    return both.select(
        *keys, pick("title", "m_title", "p_title").alias("title"), pick("description", "m_description").alias("description"),
        pick("m_banner", "banner_url").alias("banner_url"), pick("thumbnail_url", "m_banner").alias("thumbnail_url"), pick("language", "m_language").alias("language"),
        pick("year").alias("year"), pick("content_type").alias("content_type"), pick("free_or_paid").alias("free_or_paid"), pick("director").alias("director"), "genres", "cast",
    ).where("title <> ''")
