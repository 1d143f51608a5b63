"""Small fixed tables as literal rows; all of bounded size (static tables of SURVEY 2.12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Language code, name, words in encyclopedia categories, words in streaming records.
LANGUAGES = [
    ("te", "Telugu", ["telugu"], ["telugu"]),
    ("ta", "Tamil", ["tamil"], ["tamil"]),
    ("ml", "Malayalam", ["malayalam"], ["malayalam"]),
    ("hi", "Hindi", ["hindi", "bollywood"], ["hindi"]),
    ("kn", "Kannada", ["kannada"], ["kannada"]),
    ("bn", "Bengali", ["bengali", "bangla"], ["bengali", "bangla"]),
    ("mr", "Marathi", ["marathi"], ["marathi"]),
    ("pa", "Punjabi", ["punjabi"], ["punjabi"]),
    ("gu", "Gujarati", ["gujarati"], ["gujarati"]),
    ("en", "English", ["english-language", "american", "british"], ["english"]),
    ("fr", "French", ["french"], ["french"]),
    ("es", "Spanish", ["spanish"], ["spanish"]),
    ("ja", "Japanese", ["japanese"], ["japanese"]),
    ("ko", "Korean", ["korean"], ["korean"]),
    ("de", "German", ["german"], ["german"]),
    ("it", "Italian", ["italian"], ["italian"]),
    ("zh", "Chinese", ["chinese", "mandarin", "cantonese", "hong kong"], ["chinese"]),
    ("pt", "Portuguese", ["portuguese", "brazilian"], ["portuguese"]),
    ("ru", "Russian", ["russian"], ["russian"]),
    ("tr", "Turkish", ["turkish"], ["turkish"]),
    ("th", "Thai", ["thai"], ["thai"]),
    ("ar", "Arabic", ["arabic"], ["arabic"]),
    ("fa", "Persian", ["persian", "iranian"], ["persian"]),
]

#: Countries whose availability is kept; languages that mark Indian titles; year-list languages.
COUNTRIES = ["US", "GB", "CA", "AU", "NZ", "IE", "ZA", "SG", "IN", "DE", "FR", "JP", "KR", "BR", "MX", "ES", "IT", "SE", "NL"]
INDIAN = ["hi", "te", "ta", "ml", "kn", "bn", "mr", "pa", "gu"]
YEAR_LIST_LANGUAGES = ["te", "ta", "ml", "hi", "kn", "bn", "mr", "pa", "gu", "ko", "ja", "fr", "es", "de", "it"]
PLATFORMS = ["aha", "hotstar", "zee5", "sunnxt"]


def languages(spark: SparkSession) -> DataFrame:
    """SORT-01: in order of code."""
    schema = "code string, name string, wiki_words array<string>, ott_words array<string>"
    return spark.createDataFrame(LANGUAGES, schema).orderBy("code")
