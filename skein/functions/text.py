"""Text and date functions as Column -> Column builders, JVM-side throughout (STR-*, DATE-*, PRED-15..17)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[\s\p{Z}\x{85}]"


def text(c: Column) -> Column:
    """Null, as a missing value, is the empty text."""
    return F.coalesce(c, F.lit(""))


def none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not the space alone."""
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+\\z", "")


def squeeze(c: Column) -> Column:
    """Trim, and make each run of white space one space."""
    return strip(F.regexp_replace(c, f"{_WS}+", " "))


def norm_title(c: Column) -> Column:
    """STR-01: lower case; Unicode letters and decimal digits only."""
    return F.regexp_replace(F.lower(text(c)), r"[^\p{L}\p{Nd}]", "")


def norm_key(title: Column, year: Column) -> Column:
    """STR-02: norm::year, or norm alone without a year."""
    return F.when(text(year) == "", norm_title(title)).otherwise(F.concat(norm_title(title), F.lit("::"), year))


#: What a trailing parenthesis may say to be a disambiguation, in catalogue titles and in merging.
DISAMBIGUATIONS = r"film|movie|TV series|TV show|TV program|miniseries|season \d+|[^)]*film"
DISAMBIGUATIONS_NARROW = r"film|movie|TV series|[^)]*film"


def strip_disambig(title: Column, narrow: bool = False) -> Column:
    """STR-03, STR-03b: drop a trailing "(film)" and the like (case-sensitive)."""
    return strip(F.regexp_replace(title, rf"\s*\((?:{DISAMBIGUATIONS_NARROW if narrow else DISAMBIGUATIONS})\)\s*\z", ""))


#: Words that open a subtitle which isn't part of a title's name.
SUBTITLES = "part|chapter|volume|episode|the movie|reloaded|returns|resurrection|the final|the beginning|the conclusion|special edition"


def strip_subtitle(title: Column) -> Column:
    """STR-04: drop a subtitle of a listed kind, a trailing parenthesis and a part number; roman numerals stay."""
    out = F.regexp_replace(title, rf"(?i)\s*[-–:]\s*(?:{SUBTITLES})[^\n]*\z", "")
    out = F.regexp_replace(out, r"\s*\([^)]*\)\s*\z", "")
    return strip(F.regexp_replace(out, r"(?i)\s+(?:part|vol|chapter|pt)\.?\s*\d+\s*\z", ""))


def clean_characters(raw: Column) -> Column:
    """STR-05: '["A","B"]' as 'A, B'."""
    return F.regexp_replace(F.regexp_replace(raw, r'^[\[\]"]+|[\[\]"]+\z', ""), '","', ", ")


#: Spellings that are exchanged, in this order.
SWAPS = [
    ("aa", "a"), ("a", "aa"), ("ee", "i"), ("i", "ee"), ("oo", "u"), ("u", "oo"), ("ou", "u"), ("u", "ou"),
    ("sh", "s"), ("s", "sh"), ("th", "t"), ("t", "th"), ("dh", "d"), ("d", "dh"), ("bh", "b"), ("b", "bh"),
    ("ph", "f"), ("f", "ph"), ("kh", "k"), ("k", "kh"), ("gh", "g"), ("g", "gh"), ("ch", "c"), ("c", "ch"),
    ("v", "w"), ("w", "v"), ("z", "j"), ("j", "z"), ("x", "ksh"), ("ksh", "x"),
    ("mm", "m"), ("m", "mm"), ("nn", "n"), ("n", "nn"), ("ll", "l"), ("l", "ll"), ("tt", "t"), ("rr", "r"), ("pp", "p"), ("ss", "s"),
]


def translit_variants(title: Column) -> Column:
    """STR-06: the lower-cased title with all places of one swap replaced, for each swap that applies, in the table's
    order; then without a leading "the "; distinct."""
    low = F.lower(text(title))
    swaps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in SWAPS))
    out = F.transform(F.filter(swaps, lambda s: F.contains(low, s["a"])), lambda s: F.replace(low, s["a"], s["b"]))
    the = F.when(low.startswith("the "), F.array(F.substring(low, 5, 1_000_000))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(out, the))


def fuzzy_chars(a: Column, b: Column) -> Column:
    """STR-07: equal, or of the longer text's bytes over 3/4 are characters that both have; three bytes at least."""
    short, long = F.least(F.octet_length(a), F.octet_length(b)), F.greatest(F.octet_length(a), F.octet_length(b))
    times = lambda s, c: F.char_length(s) - F.char_length(F.replace(s, c, F.lit("")))
    common = F.aggregate(
        F.array_distinct(F.split(a, "")), F.lit(0), lambda acc, c: acc + F.when(c == "", 0).otherwise(F.least(times(a, c), times(b, c)))
    )
    return (a == b) | ((short >= 3) & (common / long > 0.75))


def last_word(c: Column) -> Column:
    return F.element_at(F.split(squeeze(c), " "), -1)


def fuzzy_names(a: Column, b: Column) -> Column:
    """STR-08: names equal after normalising, or with the same last word of over three bytes."""
    last = lambda c: F.lower(last_word(c))
    return (norm_title(a) == norm_title(b)) | ((F.octet_length(last(a)) > 3) & (last(a) == last(b)))


def parse_cast(raw: Column, role: str = "actor") -> Column:
    """STR-09: "A as X|B" as [(A, X, role), (B, '', role)]."""
    parts = F.filter(F.transform(F.split(text(raw), r"\|"), strip), lambda s: s != "")
    return F.transform(
        parts,
        lambda s: F.struct(
            strip(F.substring_index(s, " as ", 1)).alias("name"),
            F.when(F.contains(s, F.lit(" as ")), strip(F.regexp_replace(s, r"(?s)^.*? as ", ""))).otherwise("").alias("character"),
            F.lit(role).alias("role"),
        ),
    )


def cast_names(raw: Column) -> Column:
    """STR-10: the names alone."""
    return F.transform(parse_cast(raw), lambda m: m["name"])


def if_other(a: Column, b: Column) -> Column:
    """STR-11: a if it is not empty and differs from b, else ''."""
    return F.when((a != "") & (a != b), a).otherwise("")


def equal_fold(a: Column, b: Column) -> Column:
    """STR-12: equal but for case."""
    return F.lower(a) == F.lower(b)


def same_language(a: Column, b: Column) -> Column:
    """PRED-04: names of a language, equal but for case."""
    return equal_fold(a, b)


def split_names(c: Column) -> Column:
    """STR-19: names between commas and line ends, of 2 to 59 bytes."""
    return F.filter(F.transform(F.split(c, r"[,\n]"), strip), lambda s: (F.octet_length(s) > 1) & (F.octet_length(s) < 60))


def content_hash(c: Column) -> Column:
    """STR-28."""
    return F.sha2(F.encode(text(c), "UTF-8"), 256)


def video_url(site: Column, key: Column) -> Column:
    """STR-29: a watch address for videos of the one site that has a fixed form, else ''."""
    return F.when((site == "YouTube") & (key != ""), F.concat(F.lit("https://www.youtube.com/watch?v="), key)).otherwise("")


def content_type(url: Column) -> Column:
    """STR-30: the kind of a streaming page by its path."""
    kinds = [("/movie/", "movie"), ("/webseries/", "webseries"), ("/webepisode/", "webepisode"), ("/show/", "show")]
    return reduce(lambda c, k: c.when(url.contains(k[0]), F.lit(k[1])), kinds[1:], F.when(url.contains(kinds[0][0]), F.lit(kinds[0][1]))).otherwise("unknown")


def host(url: Column) -> Column:
    """STR-26: host with port, without user data; '' if there is none."""
    return F.regexp_replace(F.regexp_extract(text(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1), "^.*@", "")


def robots_path(url: Column) -> Column:
    """STR-27: path, its escapes decoded, with the query as it stands; '/' if the path is empty. A path with a broken
    escape stays as it is."""
    parts = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)(?:\?([^#]*))?"
    path, query = F.regexp_extract(text(url), parts, 1), F.regexp_extract(text(url), parts, 2)
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.concat(F.when(path == "", "/").otherwise(plain), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def year_prefix(date: Column) -> Column:
    """DATE-01: four leading digits, else ''."""
    return F.regexp_extract(text(date), r"^(\d{4})", 1)


def year_chars(date: Column, else_empty: bool = False) -> Column:
    """DATE-02: the first four characters; a shorter text as it is, or ''."""
    return F.when(F.octet_length(text(date)) >= 4, F.substring(date, 1, 4)).otherwise("" if else_empty else text(date))


def year_search(*fields: Column) -> Column:
    """DATE-03: the first 19xx or 20xx that stands alone in the first field that has one, else ''."""
    return text(F.coalesce(*(none_if_empty(F.regexp_extract(text(f), r"\b((?:19|20)\d{2})\b", 1)) for f in fields)))


def export_dates(today: Column, back: int = 4) -> Column:
    """DATE-05: MM_DD_YYYY of today and the days before it."""
    return F.transform(F.sequence(F.lit(0), F.lit(back)), lambda i: F.date_format(F.date_sub(today, i), "MM_dd_yyyy"))


def limited(c: Column, n: int) -> Column:
    """LIM-04: at most n characters."""
    return F.substring(c, 1, n)


def is_month(c: Column) -> Column:
    """PRED-16: an upper-case English month."""
    return c.isin("JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER")


def is_garbage(title: Column) -> Column:
    """PRED-15: under two bytes, a number, or of fewer than two letters."""
    return (F.octet_length(title) < 2) | title.rlike(r"^[+-]?\d+\z") | (F.char_length(F.regexp_replace(title, r"[^\p{L}]", "")) < 2)


def robots_flags(meta: Column) -> tuple[Column, Column]:
    """PRED-17: (index, follow) by a meta robots text."""
    low = F.lower(text(meta))
    return ~low.contains("noindex"), ~low.contains("nofollow")


def any_keyword(c: Column, words: Column) -> Column:
    """PRED-02, PRED-03: the lower-cased text has any of the words."""
    return F.exists(words, lambda w: F.contains(F.lower(text(c)), F.lower(w)))


def any_part(c: Column, parts: list[str]) -> Column:
    """PRED-05, PRED-06: contains any of the literal parts; false without parts."""
    return reduce(lambda a, p: a | F.contains(c, F.lit(p)), parts, F.lit(False))


def micros(ts: Column) -> Column:
    """A timestamp, with or without zone, in microseconds; the session's zone is UTC."""
    return F.unix_micros(ts.cast("timestamp"))
