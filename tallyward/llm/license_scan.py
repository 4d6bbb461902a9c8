"""License scan with DataFrame functions only: fixed phrases, and a positional index of rare words.

Words are runs of letters, digits and characters beyond ASCII. Fixed phrases
give the base labels at every place where their words stand in a row.

The method adds labels by template. Document frequencies of all template words
are counted over all documents. The index keeps the ``RARE`` words of each
template with the highest inverse document frequency, with their positions. A
document's occurrences of index words are looked up; each gives the place
where the template would start. Where two different rare words agree on the
start (up to ``SLACK`` words), the template's mandatory key phrase must stand at
its place, up to the same slack. The score is the largest part of a found
template's words that stand in its stretch, at least 0.5 where a fixed
phrase stands, and 0 without a label.

All of it happens within the row: no join, no shuffle but the one that adds up
document frequencies, and a row's work follows its own words. NULL and empty
texts have no words and no labels. Repeated rows give repeated result rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 4
SLACK = 2

#: Words of the fixed phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Template notices: label, words, mandatory key phrase (part of the words).
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "except in compliance"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation",
     "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license",
     "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
)

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Posting:
    word: str
    template: int
    offset: int


def words_of(text: Column) -> Column:
    """Lower-case words. Full lower-casing moves no word border: characters
    beyond ASCII are word characters before and after it."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_WORD), F.lit(0))


def word_frequencies(docs: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES) -> dict[str, int]:
    """In how many documents each template word stands; under "" the number
    of documents. The driver gets one row per template word at most."""
    vocabulary = sorted({w for _, body, _ in templates for w in body.split()})
    here = F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary)))
    counted = docs.select(F.explode(F.concat(F.array(F.lit("")), here)).alias("w")).groupBy("w").count()
    return {r["w"]: r["count"] for r in counted.collect()}


def rare_index(frequencies: dict[str, int], templates: Sequence[tuple[str, str, str]] = TEMPLATES) -> list[Posting]:
    """Postings of each template's words with the highest inverse document frequency."""
    n = frequencies.get("", 0)
    out = []
    for t, (_, body, _) in enumerate(templates):
        words = body.split()
        idf = {w: math.log((n + 1) / (frequencies.get(w, 0) + 1)) for w in words}
        rare = set(sorted(idf, key=lambda w: (-idf[w], w))[:RARE])
        out += [Posting(w, t, k) for k, w in enumerate(words) if w in rare]
    return out


def _stands_at(words: Column, place: Column, phrase: list[str]) -> Column:
    found = F.lit(True)
    for k, w in enumerate(phrase):
        found = found & (F.get(words, place + k) == w)
    return F.coalesce(found, F.lit(False))


def scan(
    docs: DataFrame, index: list[Posting], templates: Sequence[tuple[str, str, str]] = TEMPLATES
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    looked_up = sorted({p.word for p in index} | {phrase.split()[0] for phrase, _ in PHRASES})
    worded = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    placed = worded.select(
        "doc_id",
        "words",
        F.filter(
            F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(looked_up)
        ).alias("hits"),
    )
    words = F.col("words")

    def places(phrase: list[str]) -> Column:
        starts = F.filter("hits", lambda h: (h["w"] == phrase[0]) & _stands_at(words, h["i"], phrase))
        return F.transform(starts, lambda h: h["i"])

    postings: dict[str, list[Posting]] = {}
    for p in index:
        postings.setdefault(p.word, []).append(p)

    def starts_of(h: Column) -> Column:
        """(template, start, word) for the postings of a hit."""
        empty = F.array().cast("array<struct<t:int,s:int,w:string>>")
        found = None
        for w, some in postings.items():
            rows = F.array(*[
                F.struct(F.lit(p.template).alias("t"), (h["i"] - p.offset).alias("s"), h["w"].alias("w")) for p in some
            ])
            found = F.when(h["w"] == w, rows) if found is None else found.when(h["w"] == w, rows)
        return empty if found is None else found.otherwise(empty)

    based = placed.select(
        "doc_id",
        "words",
        *[places(phrase.split()).alias(f"p{k}") for k, (phrase, _) in enumerate(PHRASES)],
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", starts_of)))).alias("starts"),
    )
    # sorted by template and start: two words that agree are neighbours somewhere
    agreed = based.select(
        "*",
        F.filter(
            F.transform("starts", lambda x, i: F.struct(
                x["t"].alias("t"), x["s"].alias("s"), F.coalesce(
                    (F.get("starts", i + 1)["t"] == x["t"])
                    & (F.get("starts", i + 1)["s"] - x["s"] <= SLACK)
                    & (F.get("starts", i + 1)["w"] != x["w"]), F.lit(False),
                ).alias("agree"),
            )),
            lambda x: x["agree"],
        ).alias("agreed"),
    )
    bodies = [body.split() for _, body, _ in templates]
    keys = [key.split() for _, _, key in templates]
    key_at = [next(k for k in range(len(b)) if b[k : k + len(q)] == q) for b, q in zip(bodies, keys)]

    def stretch(start: Column, size: int) -> Column:
        first = F.greatest(start, F.lit(0))
        return F.slice(words, first + 1, F.greatest(start + size - first, F.lit(0)))

    def verified(x: Column) -> Column:
        """Part of the template's words in its stretch, if its key phrase is there; else NULL."""
        found = F.lit(None).cast("double")
        for t, (body, key) in enumerate(zip(bodies, keys)):
            near = F.concat(F.lit(" "), F.array_join(
                stretch(x["s"] + key_at[t] - SLACK, len(key) + 3 * SLACK), " "
            ), F.lit(" "))
            part = F.size(F.array_intersect(
                stretch(x["s"] - SLACK, len(body) + 3 * SLACK), F.array(*map(F.lit, body))
            )) / len(set(body))
            found = F.when(x["t"] == t, F.when(near.contains(f" {' '.join(key)} "), part)).otherwise(found)
        return found

    checked = agreed.select(
        "*",
        F.filter(
            F.transform("agreed", lambda x: F.struct(x["t"].alias("t"), verified(x).alias("part"))),
            lambda x: x["part"].isNotNull(),
        ).alias("found"),
    )
    all_places = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    base = F.filter(F.array(*[
        F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)
    ]), lambda x: x.isNotNull())
    names = F.array(*[F.lit(label) for label, _, _ in templates])
    labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("found", lambda x: F.get(names, x["t"])))))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["part"])), F.lit(0.0))
    return checked.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"),
        F.array_max(all_places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.least(F.lit(1.0), F.greatest(best, F.when(F.size(all_places) > 0, 0.5).otherwise(0.0))).alias("score"),
    )
