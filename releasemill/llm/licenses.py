"""License scans by diagonal voting, with DataFrame functions alone.

All rolling word k-grams of the texts and of the license templates are hashed and
joined on the hash.  A match at word p of a text and word t of a template votes for
the diagonal p - t: where a copy stands, all of its grams share one.  Added or lost
words move the rest of a copy to a neighbouring diagonal, so neighbouring diagonals of
a template merge into one span.  A span is verified by the words behind its votes and
by its extent: the template's grams it holds must be enough of them and stand about as
far apart as in the template.

Short phrases use grams of two words and must stand word by word; longer templates
use grams of five words, and four fifths of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from releasemill.llm.frames import row_key
from releasemill.workspace import small_side

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PHRASE_GRAM = 2
GRAM = 5
SIMILARITY = 0.8
# Diagonals of a template this many words apart are neighbours.
DRIFT = 4


@dataclass(frozen=True)
class Template:
    """Words to look for, in lower case, and the label they stand for."""

    label: str
    words: tuple[str, ...]
    exact: bool  # a phrase that must stand word by word

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.exact else GRAM


# Phrases and their labels.
BASE_PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Further phrases, and notices as their licenses word them.
PHRASES = (
    ("apache", "apache license"),
    ("bsd", "bsd license"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("creative-commons", "creative commons"),
    ("isc", "isc license"),
    ("lgpl", "lesser general public license"),
    ("mit", "mit license"),
    ("mpl", "mozilla public license"),
    ("public-domain", "released into the public domain"),
)
NOTICES = (
    ("apache",
     "licensed under the apache license version 2 0 the license you may not use this file except in"
     " compliance with the license you may obtain a copy of the license at"),
    ("apache",
     "unless required by applicable law or agreed to in writing software distributed under the license is"
     " distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("bsd",
     "redistribution and use in source and binary forms with or without modification are permitted provided"
     " that the following conditions are met"),
    ("bsd",
     "redistributions of source code must retain the above copyright notice this list of conditions and the"
     " following disclaimer"),
    ("gpl",
     "this program is free software you can redistribute it and or modify it under the terms of the gnu"
     " general public license as published by the free software foundation either version"),
    ("gpl",
     "this program is distributed in the hope that it will be useful but without any warranty without even"
     " the implied warranty of merchantability or fitness for a particular purpose"),
    ("isc",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is"
     " hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and"
     " associated documentation files the software to deal in the software without restriction including"
     " without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"
     " of the software"),
    ("mit",
     "the above copyright notice and this permission notice shall be included in all copies or substantial"
     " portions of the software"),
    ("mpl",
     "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl"
     " was not distributed with this file you can obtain one at"),
    ("proprietary",
     "unauthorized copying of this file via any medium is strictly prohibited"),
    ("public-domain",
     "anyone is free to copy modify publish use compile sell or distribute this software either in source"
     " code form or as a compiled binary for any purpose"),
)


def usual_templates() -> list[Template]:
    """The phrases of the base first, then those of the method."""
    phrases = [Template(label, tuple(text.split()), True) for label, text in (*BASE_PHRASES, *PHRASES)]
    return phrases + [Template(label, tuple(text.split()), False) for label, text in NOTICES]


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"))


def template_grams(spark: SparkSession, templates: list[Template], base: int) -> DataFrame:
    """A row for each gram of each template: hash, words, place, and what the template asks for."""
    listed = F.array(
        *[
            F.struct(
                F.lit(number).alias("template"), F.lit(t.label).alias("label"), F.lit(number < base).alias("base"),
                F.lit(t.exact).alias("exact"), F.lit(t.gram).alias("size"),
                F.array(*[F.lit(w) for w in t.words]).alias("words"),
            )
            for number, t in enumerate(templates)
        ]
    )
    rows = spark.range(1).select(F.inline(listed))
    grams = rows.withColumn("grams", F.size("words") - F.col("size") + 1)
    grams = grams.select("*", F.explode(F.sequence(F.lit(0), F.col("grams") - 1)).alias("at"))
    own = F.slice("words", F.col("at") + 1, F.col("size"))
    return grams.select(
        "template", "label", "base", "exact", "size", "grams", "at", F.array_join(own, " ").alias("own"),
        F.when(F.col("size") == PHRASE_GRAM, _hash(2, [own[0], own[1]]))
        .otherwise(_hash(GRAM, [F.get(own, F.lit(k)) for k in range(GRAM)])).alias("hash"),
    )


def _hash(size: int, parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(size), *parts)


def matches(docs: DataFrame, keep: list[str], templates: DataFrame, text: str) -> DataFrame:
    """Grams of the texts that share their hash with a gram of a template; `p` is the place of the text's."""
    spelled = docs.select(*keep, words(F.col(text)).alias("w"))
    shifted = [F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0))).alias(f"w{k}") for k in range(GRAM)]
    rolled = spelled.where(F.size("w") >= PHRASE_GRAM).select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("p", "g"))
    gram = [F.col(f"g.w{k}") for k in range(GRAM)]
    # Each place has a gram of either size; a text's last places have none of the longer.
    pair = F.struct(F.lit(PHRASE_GRAM).alias("size"), _hash(PHRASE_GRAM, gram[:PHRASE_GRAM]).alias("hash"))
    whole = F.struct(F.lit(GRAM).alias("size"), _hash(GRAM, gram).alias("hash"))
    rows = rolled.select(*keep, "p", "g", F.inline(F.array(pair, whole)).alias("gram_size", "gram_hash"))
    side = templates.withColumnsRenamed({"size": "of_size", "hash": "of_hash"})
    met = rows.join(side, (F.col("gram_hash") == F.col("of_hash")) & (F.col("gram_size") == F.col("of_size")))
    spoken = F.when(
        F.col("of_size") == PHRASE_GRAM, F.concat_ws(" ", *gram[:PHRASE_GRAM])
    ).otherwise(F.concat_ws(" ", *gram))
    return met.select(
        *keep, "template", "label", "base", "exact", "grams", "of_size", "at",
        F.col("p").cast("long").alias("p"), (F.col("own") == spoken).alias("same"),
    )


def spans(met: DataFrame, keep: list[str], similarity: float = SIMILARITY) -> DataFrame:
    """`keep, label, base, exact, first_word, last_word, similarity` of each verified span.

    Votes are gathered by diagonal, a template's neighbouring diagonals merged, and what
    they hold compared with the template.
    """
    place = ["template", "label", "base", "exact", "grams", "of_size"]
    votes = (
        met.where("same").groupBy(*keep, *place, (F.col("p") - F.col("at")).alias("diagonal"))
        # A template has few places; rows equal in `keep` vote for the same ones.
        .agg(F.collect_set("at").alias("ats"), F.min("p").alias("low"), F.max("p").alias("high"))
    )
    # A phrase stands on one diagonal, so its votes do not merge.
    line = Window.partitionBy(*[F.col(c) for c in (*keep, "template")]).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(line)
    starts = F.when(F.col("exact") | F.coalesce(apart > DRIFT, F.lit(True)), 1).otherwise(0)
    merged = (
        votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(line))
        .groupBy(*keep, *place, "span")
        .agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
             F.min("low").alias("low"), F.max("high").alias("high"))
    )
    share = F.size("ats") / F.col("grams")
    extent = F.col("high") - F.col("low") + 1
    asked = F.array_max("ats") - F.array_min("ats") + 1
    enough = F.when(F.col("exact"), F.size("ats") == F.col("grams")).otherwise(
        (share >= similarity) & (extent <= asked + 2 * DRIFT)
    )
    return merged.where(enough).select(
        *keep, "label", "base", "exact", F.col("low").alias("first_word"),
        (F.col("high") + F.col("of_size") - 1).alias("last_word"), share.alias("similarity"),
    )


def scanned(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
            templates: list[Template] | None = None, base: int = len(BASE_PHRASES)) -> DataFrame:
    """Per row: id, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    The first `base` templates are the base: n_base counts the places where their
    phrases stand, first_word and last_word are the smallest and largest start (null
    without any).  Labels are distinct, sorted and comma-joined, empty without any.
    score is the largest similarity of a verified span, 0 without any.  Null and empty
    texts have no words; rows that repeat an id are judged by their own text.
    """
    spark = docs.sparkSession
    templates = usual_templates() if templates is None else templates
    grams = template_grams(spark, templates, base)
    grams = small_side(grams, sum(max(0, len(t.words) - t.gram + 1) for t in templates))
    own = docs.select(
        F.col(f"`{id_column}`").alias("__id"), row_key(f"`{text}`").alias("__key"), F.col(f"`{text}`").alias("__text")
    )
    keep = ["__id", "__key"]
    found = spans(matches(own, keep, grams, "__text"), keep)
    judged = found.groupBy(*[F.col(c).alias(f"{c}_of") for c in keep]).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_word"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("similarity").alias("score"),
    )
    counted = own.select(*keep, F.size(words(F.col("__text"))).cast("long").alias("n_words"))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keep]
    return counted.join(judged, same, "left").select(
        F.col("__id").alias(id_column), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
