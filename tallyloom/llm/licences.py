"""Licence scans: a positional rare-token index, in DataFrame functions only.

The templates' words get their IDF from the documents. Each template is filed
under the rarest word of its mandatory key phrases with its position. A file
looks up the words it has of those; each posting gives a place where the
template would start, and no other place can hold the phrases. A place
counts if the mandatory key phrases stand there word for word, and scores by
the IDF share of the template's words found at their relative positions. Where
too little of a notice stands around its key phrase, the phrase is a short form
of the notice and counts by itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import TERMS


@dataclass(frozen=True)
class Template:
    """A licence notice in lower-case words; ``keys`` are its mandatory phrases (without any: the whole text)."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    def words(self) -> list[str]:
        return self.text.split()

    def mandatory(self) -> list[bool]:
        words = self.words()
        needed = [not self.keys] * len(words)
        for key in self.keys:
            part = key.split()
            at = next(k for k in range(len(words)) if words[k:k + len(part)] == part)
            needed[at:at + len(part)] = [True] * len(part)
        return needed


# The phrases that name a licence by themselves.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)

# Notices in common use, in short form.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("proprietary", "unauthorized copying of this file via any medium is strictly prohibited proprietary and confidential", ("unauthorized copying of this file",)),
)

# Short statements, titles and SPDX or version lines: templates whose every word is mandatory.
SHORT_FORMS = (
    *(Template(label, f"spdx license identifier {name}") for label, name in (
        ("mit", "mit"), ("apache-2", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"),
        ("mpl-2", "mpl 2 0"), ("isc", "isc"), ("unlicense", "unlicense"), ("cc-by", "cc by 3 0"), ("cc-by", "cc by 4 0"), ("cc-by-sa", "cc by sa"))),
    *(Template("gpl", text) for text in ("gnu gpl", "licensed under the gpl", "gplv2", "gplv3", "gpl v2", "gpl v3", "gpl version 2", "gpl version 3", "gpl 2 0", "gpl 3 0")),
    *(Template("lgpl", text) for text in ("gnu lgpl", "licensed under the lgpl", "gnu library general public license", "lgplv2", "lgplv3", "lgpl v2", "lgpl v3", "lgpl 2 1", "lgpl 3 0")),
    *(Template("agpl", text) for text in ("gnu agpl", "licensed under the agpl", "agplv3", "agpl v3", "agpl 3 0")),
    *(Template("mpl-2", text) for text in ("mozilla public license version 2", "mozilla public license 2 0", "mpl 2 0")),
    *(Template("bsd", text) for text in ("bsd license", "bsd 2 clause", "bsd 3 clause")),
    *(Template("apache-2", text) for text in ("apache license 2 0", "licensed under apache 2 0")),
    *(Template("mit", text) for text in ("license mit", "mit license copyright")),
    Template("isc", "isc license"),
    *(Template("cc-by", text) for text in ("creative commons attribution 3 0", "cc by 3 0", "cc by 4 0")),
    *(Template("cc-by-nc", text) for text in ("creative commons attribution non commercial",)),
    *(Template("cc-by-sa", text) for text in ("creative commons attribution share alike", "cc by sa")),
    Template("all-rights-reserved", "all rights reserved"),
)


def words_of(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(f"({TERMS})"), F.lit(1))


def document_frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and how many hold each word: at most a row per template word comes to the driver."""
    known = F.array_distinct(F.filter(words_of(text), lambda w: w.isin(vocabulary)))
    counted = docs.select(F.explode(known).alias("word")).groupBy("word").count()
    return docs.count(), {r["word"]: r["count"] for r in counted.collect()}


def scan_licences(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, templates: tuple[Template, ...] = BASE + NOTICES + SHORT_FORMS, least_score: float = 0.6,
) -> DataFrame:
    """``row`` with ``n_words``, ``places`` (template label, whether it is a base phrase, first word, score) and ``score`` (the best, or 0).

    One row per input row. A template is filed under the rarest word of its
    mandatory phrases, so that every place where they stand is looked at,
    whatever the other words are. Ties in rarity go to the first position. A
    place scores below ``least_score`` only around a notice's key phrases; these
    then are the place, with score 1, so that a verbatim key always labels. Null and empty texts have no words; an empty table has
    no rows; nothing is shuffled but the counts of template words.
    """
    vocabulary = sorted({w for t in templates for w in t.words()})
    total, frequency = document_frequencies(docs, vocabulary, text)
    idf = {w: math.log((total + 2) / (frequency.get(w, 0) + 1)) for w in vocabulary}

    postings: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        words = template.words()
        at = max((k for k, needed in enumerate(template.mandatory()) if needed), key=lambda k: (idf[words[k]], -k))
        postings.setdefault(words[at], []).append((number, at))
    rare = sorted(postings)
    filed = F.array(*[F.array(*[F.struct(F.lit(n).alias("template"), F.lit(at).alias("at")) for n, at in postings[w]]) for w in rare])
    texts = F.array(*[F.array(*map(F.lit, t.words())) for t in templates])
    needed = F.array(*[F.array(*map(F.lit, t.mandatory())) for t in templates])
    shares = []
    for template in templates:
        whole = sum(idf[w] for w in template.words())
        shares.append(F.array(*[F.lit(idf[w] / whole) for w in template.words()]))
    weights = F.array(*shares)
    keyed = F.array(*[F.lit(t.mandatory().index(True)) for t in templates])
    labels, base = F.array(*[F.lit(t.label) for t in templates]), F.array(*[F.lit(t.base) for t in templates])

    kept = docs.columns if keep is None else keep
    frame = docs.select(F.struct(*[docs[c] for c in kept]).alias("row"), words_of(text).alias("words"))
    spots = F.array_compact(F.transform("words", lambda w, k: F.when(w.isin(rare), k)))
    frame = frame.select("row", "words", spots.alias("spots"))

    def starts(spot: Column) -> Column:
        word = F.get(F.col("words"), spot)
        return F.transform(F.get(filed, F.array_position(F.array(*map(F.lit, rare)), word).cast("int") - 1),
                           lambda p: F.struct(p.template.alias("template"), (spot - p.at).alias("start")))

    frame = frame.select("row", "words", F.array_distinct(F.flatten(F.transform("spots", starts))).alias("starts"))

    def verified(place: Column) -> Column:
        def found(k: Column) -> Column:
            return F.coalesce(F.get(F.col("words"), place.start + k) == F.get(F.get(texts, place.template), k), F.lit(False))

        steps = F.sequence(F.lit(0), F.size(F.get(texts, place.template)) - 1)
        whole = F.forall(steps, lambda k: found(k) | ~F.get(F.get(needed, place.template), k))
        score = F.aggregate(steps, F.lit(0.0), lambda s, k: s + F.when(found(k), F.get(F.get(weights, place.template), k)).otherwise(0.0))
        return F.struct(F.get(labels, place.template).alias("label"), F.get(base, place.template).alias("base"), place.start.cast("long").alias("start"),
                        F.least(F.round(score, 9), F.lit(1.0)).alias("score"), whole.alias("whole"), F.get(keyed, place.template).alias("key"))

    def reported(place: Column) -> Column:
        short = place.score < least_score
        return F.struct(place.label.alias("label"), place.base.alias("base"), F.when(short, place.start + place.key).otherwise(place.start).alias("start"),
                        F.when(short, 1.0).otherwise(place.score).alias("score"), place.whole.alias("whole"))

    places = F.transform(F.filter(F.transform("starts", verified), lambda p: p.whole), reported)
    frame = frame.select("row", F.size("words").cast("long").alias("n_words"), places.alias("places"))
    return frame.withColumn("score", F.coalesce(F.array_max(F.transform("places", lambda p: p.score)), F.lit(0.0)))


def label_list(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))), ",")
