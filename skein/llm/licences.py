"""Licence scan with DataFrame functions only: base phrases, and a positional index of licence templates.

Templates are short public licence notices as word sequences. Their words are weighted by IDF over the templates and
indexed as postings (word, template, position). Postings that agree on the relative position (place in file - place in
template) make an alignment, which needs at least one of its template's rarest words: so many of the highest IDF, function
words last, that no alignment without them has enough weight, whatever else stands in the file. The best alignment of a
template counts if enough of its weight is there and its mandatory key phrases stand in the file.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Fixed by the contract: phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices as licensors publish them: label, text, mandatory key phrases.
TEMPLATES = [
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", ["gnu affero general public license", "version 3"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("artistic-2.0", "licensed under the artistic license 2 0", ["artistic license 2 0"]),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nc-nd-4.0", "licensed under cc by nc nd 4 0", ["cc by nc nd 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", ["waived all copyright"]),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["copy modify and or distribute this software"]),
    ("lgpl-2.1", "licensed under the gnu lesser general public license version 2 1", ["gnu lesser general public license version 2 1"]),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", ["gnu lesser general public license version 3"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("proprietary", "all rights reserved", ["all rights reserved"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software released into the public domain"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", ["in no event will the authors be held liable"]),
]

#: Function words among the templates' words: they support an alignment but aren't among the rarest if others suffice.
COMMON = set("a all and any are as be by for free in is no of or that the this to under use will with without".split())

#: An alignment's least share of its template's weight.
LEAST = 0.75
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def postings() -> list[tuple[str, int, str, int, float, bool]]:
    """(word, template, label, position, share of the template's weight, whether it is one of the rarest): bounded by
    TEMPLATES."""
    texts = [t.split() for _, t, _ in TEMPLATES]
    df = {w: sum(w in t for t in texts) for t in texts for w in t}
    idf = {w: math.log((1 + len(texts)) / n) for w, n in df.items()}
    out = []
    for i, words in enumerate(texts):
        share = [idf[w] / sum(idf[x] for x in words) for w in words]
        rarest, held = set(), 0.0
        for w in sorted(set(words), key=lambda w: (w in COMMON, -idf[w], w)):
            if held <= 1 - LEAST + 1e-6:  # what is left could still reach LEAST
                rarest.add(w)
                held += sum(x for x, v in zip(share, words, strict=True) if v == w)
        out += [(w, i, TEMPLATES[i][0], k, share[k], w in rarest) for k, w in enumerate(words)]
    return out


def anchors() -> list[str]:
    """Words such that every template's key phrases hold one, so that files without any can't match: again and again the
    word that stands in most of the templates left, the rarer of all on ties."""
    left = [{w for k in keys for w in k.split() if w not in COMMON and len(w) > 1} for _, _, keys in TEMPLATES]
    everywhere = Counter(w for x in left for w in x)
    out = []
    while left:
        now = Counter(w for x in left for w in x)
        word = min(now, key=lambda w: (-now[w], everywhere[w], w))
        out.append(word)
        left = [x for x in left if word not in x]
    return out


def spaced(text: Column) -> Column:
    """The words, lower-cased, with one space before, between and after them; a single space if there are none.

    lower() may change letters beyond ASCII, but no word boundary and no ASCII phrase depends on those.
    """
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP, " ")), F.lit(" "))


def _count(of: Column, what: str) -> Column:
    return F.char_length(of) - F.char_length(F.replace(of, F.lit(what), F.lit("")))


def base_columns(words: Column) -> dict[str, Column]:
    """The contract's base columns from spaced(text)."""
    n_words = F.when(words == "  ", F.lit(0)).otherwise(_count(words, " ") - 1).cast("bigint")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        here = words.contains(f" {phrase} ")
        counts.append(F.when(here, F.size(F.split(words, f" {phrase}(?= )", -1)) - 1).otherwise(0))
        firsts.append(F.when(here, _count(F.substring_index(words, f" {phrase} ", 1), " ")))
        lasts.append(F.when(here, n_words - _count(F.substring_index(words, f" {phrase} ", -1), " ") - len(phrase.split())))
        labels.append(F.when(here, F.lit(label)))
    return {
        "n_words": n_words,
        "n_base": sum(counts[1:], counts[0]).cast("bigint"),
        "first_word": F.least(*firsts).cast("bigint"),
        "last_word": F.greatest(*lasts).cast("bigint"),
        "found": F.array_compact(F.array(*labels)),
    }


#: Positions that share a mask.
MASK = 62


def template_matches(docs: DataFrame) -> DataFrame:
    """(id, text, label, template, at, score): the best alignment of each template that a text holds; docs(id, text, words),
    where text is a hash of the words. Rows that repeat a text change nothing: positions are collected in masks."""
    spark = docs.sparkSession
    row = lambda **x: F.struct(*(F.lit(v).alias(k) for k, v in x.items()))
    every = postings()
    index = F.broadcast(spark.range(1).select(F.inline(F.array(*(row(word=w, template=i, label=name, pos=k, share=x, rare=rare) for w, i, name, k, x, rare in every)))))
    weights = [F.struct(F.lit(i).alias("template"), F.array(*(F.lit(x[4]) for x in every if x[1] == i)).alias("shares")) for i in range(len(TEMPLATES))]
    shares = F.broadcast(spark.range(1).select(F.inline(F.array(*weights))))
    places = docs.select("id", "text", F.posexplode(F.split(F.substring("words", 2, 2_000_000_000), " ")).alias("at", "word"))
    hits = places.join(index, "word")
    bit = F.expr(f"shiftleft(1L, int(pos % {MASK}))")
    masks = hits.groupBy("id", "text", "template", "label", (F.col("at") - F.col("pos")).alias("at"), (F.col("pos") / MASK).cast("int").alias("part")).agg(F.bit_or(bit).alias("mask"), F.max("rare").alias("rare"))
    held = F.expr(f"filter(shares, (x, i) -> int(i / {MASK}) = part AND (shiftright(mask, i % {MASK}) & 1) = 1)")
    masks = masks.join(shares, "template").withColumn("share", F.aggregate(held, F.lit(0.0), lambda a, x: a + x))
    lines = (
        masks.groupBy("id", "text", "template", "label", "at")
        .agg(F.round(F.sum("share"), 9).alias("score"), F.max("rare").alias("rare"))
        .where("rare")
        .groupBy("id", "text", "template", "label")
        .agg(F.max(F.struct("score", (-F.col("at")).alias("at"))).alias("best"))
    )
    return lines.select("id", "text", "label", "template", (-F.col("best.at")).alias("at"), F.col("best.score").alias("score"))


def _verified(words: Column) -> Column:
    """The templates whose mandatory key phrases all stand in a file."""
    return F.array_compact(
        F.array(*(F.when(_all(words, keys), F.lit(i)) for i, (_, _, keys) in enumerate(TEMPLATES)))
    )


def _all(words: Column, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & words.contains(f" {k} ")
    return out


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, templates).

    A null text counts as empty and has no words or labels, null positions and score 0. score is 1 if a base phrase
    stands in the text, else the best verified template's share of weight (0 to 1). Each row is judged by its own text;
    rows that repeat stay and are alike. Other columns are ignored; an empty table gives no rows. Texts are normalised
    once: the words of files that may match are written to the shared folder.
    """
    rows = docs.select(F.col(id_col).alias("id"), spaced(F.col(text_col)).alias("words"))
    candidate = F.col("words").rlike(f" (?:{'|'.join(map(re.escape, anchors()))}) ")
    base = rows.withColumns(base_columns(F.col("words"))).withColumn("verified", F.when(candidate, _verified(F.col("words"))))
    likely = F.size("verified") > 0
    base = base.withColumn("words", F.when(likely, F.col("words"))).withColumn("text", F.xxhash64("words"))
    base = written(base, "licences")
    best = template_matches(base.where("words is not null").select("id", "text", "words")).where(F.col("score") >= LEAST)
    best = best.groupBy("id", "text").agg(F.collect_list(F.struct("template", "label", "score", "at")).alias("best")).withColumnsRenamed({"id": "bid", "text": "btext"})
    base = base.drop("words")
    both = base.join(best, on=base["id"].eqNullSafe(best["bid"]) & (base["text"] == best["btext"]), how="left")
    held = F.filter(F.coalesce("best", F.expr("array()").cast("array<struct<template:int,label:string,score:double,at:int>>")), lambda t: F.array_contains(F.col("verified"), t["template"]))
    both = both.withColumn("held", F.array_sort(held))
    labels = F.array_sort(F.array_union("found", F.transform("held", lambda t: t["label"])))
    score = F.when(F.size("found") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("held", lambda t: t["score"])), F.lit(0.0))))
    return both.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
        F.array_join(F.transform("held", lambda t: F.concat_ws("@", t["template"], t["at"])), ",").alias("templates"),
    )
