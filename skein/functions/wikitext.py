"""Encyclopedia markup: stripping, infobox fields, plot, lists and categories (STR-14..16, 21..24, LIM-04)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import limited, none_if_empty, squeeze, strip, text
from .udfs import html_unescape, first_template, strip_nested

#: The patterns of markup, in the order in which they are taken out, and what stays of each.
MARKUP = [
    (r"(?s)\{\|.*?\|\}", ""),
    (r"\[\[Category:[^\]]*\]\]", ""),
    (r"\[\[(?:File|Image):[^\]]*\]\]", ""),
    (r"\[\[[^\[\]]*?\|([^\[\]]*?)\]\]", "$1"),
    (r"\[\[([^\[\]|]*?)\]\]", "$1"),
    (r"(?dm)^={2,6}\s*(.+?)\s*={2,6}\s*$", "$1"),
    (r"(?d)'''(.*?)'''", "$1"),
    (r"(?d)''(.*?)''", "$1"),
    (r"\[https?://[^\s\]]+\s+([^\]]+)\]", "$1"),
    (r"\[https?://[^\s\]]+\]", ""),
    (r"__[A-Z]+__", ""),
    (r"<[^>]+>", ""),
]


def strip_wikitext(c: Column, compat: bool = False) -> Column:
    """STR-16: plain text. Self-closing references go first; compat removes reference blocks first, so that a
    self-closing one swallows what stands before the next end."""
    single, block = r"<ref[^>]*/>", r"(?s)<ref[^>]*>.*?</ref>"
    rules = [(r"(?s)<!--.*?-->", ""), *([(block, ""), (single, "")] if compat else [(single, ""), (block, "")])]
    out = reduce(lambda a, r: F.regexp_replace(a, *r), rules, text(c))
    out = html_unescape(reduce(lambda a, r: F.regexp_replace(a, *r), MARKUP, strip_nested(out)))
    return strip(F.regexp_replace(F.regexp_replace(out, r"[^\S\n]{2,}", " "), r"\n{3,}", "\n\n"))


def clean_field(c: Column) -> Column:
    """STR-14: an infobox value as text."""
    rules = [(r"<!--.*?-->", ""), (r"(?i)<\s*br\s*/?\s*>", ", "), (r"<[^>]+>", ""), (r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1"), (r"\[\[([^|\]]+)\|?\]\]", "$1")]
    out = strip_nested(reduce(lambda a, r: F.regexp_replace(a, *r), rules, text(c)))
    return squeeze(F.replace(out, F.lit("}}"), F.lit("")))


def extract_list(c: Column) -> Column:
    """STR-15: bulleted lines, else what stands between commas. Values of one list are cleaned together."""
    bullets = F.regexp_extract_all(text(c), F.lit(r"(?m)^\*\s*(.+)$"), F.lit(1))
    joined = clean_field(F.when(F.size(bullets) > 0, F.array_join(bullets, "\u0001")).otherwise(text(c)))
    parts = F.when(F.size(bullets) > 0, F.split(joined, "\u0001")).otherwise(F.split(joined, ","))
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def categories(c: Column) -> Column:
    """STR-21."""
    return F.transform(F.regexp_extract_all(text(c), F.lit(r"\[\[Category:([^\]|]+)"), F.lit(1)), strip)


#: Infobox templates and category words, in the order in which they are tried.
FILM_TEMPLATES = ["{{infobox film", "{{infobox movie", "{{infobox film series"]
TV_TEMPLATES = ["{{infobox television", "{{infobox tv", "{{infobox tv series", "{{infobox television series", "{{infobox television season", "{{infobox television episode"]
FILM_CATEGORIES = ["films", "movies"]
TV_CATEGORIES = ["television series", "television shows", "tv series", "television seasons", "television episodes"]
PLOT_HEADERS = ["== plot ==", "== synopsis ==", "== premise ==", "==plot==", "==synopsis=="]


def article_kind(c: Column) -> Column:
    """PRED-06: 'film', 'tv' or null: by infobox; only without one by categories; film first."""
    low = F.lower(text(c))
    has = lambda words, where: reduce(lambda a, w: a | F.contains(where, F.lit(w)), words, F.lit(False))
    named = F.lower(F.array_join(categories(c), "\n"))
    return (
        F.when(has(FILM_TEMPLATES, low), "film").when(has(TV_TEMPLATES, low), "tv")
        .when(has(FILM_CATEGORIES, named), "film").when(has(TV_CATEGORIES, named), "tv")
    )


def infobox(c: Column) -> Column:
    """The first known template, in the order of the lists, with its nested ones, by counting braces; null if there is
    none or it doesn't end."""
    return first_template(c, FILM_TEMPLATES + TV_TEMPLATES)


def infobox_fields(box: Column, compat: bool = False) -> Column:
    """STR-22: of an infobox(), in a column of its own, the map of lower-cased names to the first line of the value; the last of equal names wins. compat lets an
    empty value take the next line."""
    gap = r"\s*" if compat else r"[^\S\n]*"
    pattern = rf"(?mi)^\|\s*(\w[\w\s]*?)\s*={gap}(.*)$"
    box = text(box)
    keys = F.transform(F.regexp_extract_all(box, F.lit(pattern), F.lit(1)), lambda k: F.lower(strip(k)))
    values = F.transform(F.regexp_extract_all(box, F.lit(pattern), F.lit(2)), strip)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["k"]))
    return F.map_from_entries(last)


def plot_section(c: Column) -> Column:
    """STR-23: text under the first of the known headers, up to the next one; 2000 characters of markup, 1000 of text."""
    low = F.lower(text(c))
    starts = [F.when(F.locate(h, low) > 0, F.locate(h, low) + len(h)) for h in PLOT_HEADERS]
    rest = F.substring(c, F.coalesce(*starts), F.char_length(c))
    return text(limited(strip_wikitext(limited(F.substring_index(rest, "\n==", 1), 2000)), 1000))


def wiki_url(title: Column, escaped: bool = False) -> Column:
    """STR-24: both forms: spaces as underscores, or percent-escaped."""
    base = F.lit("https://en.wikipedia.org/wiki/")
    return F.concat(base, F.replace(F.url_encode(title), F.lit("+"), F.lit("%20")) if escaped else F.replace(title, F.lit(" "), F.lit("_")))
