"""License scans with a positional rare-token index, in DataFrame functions only.

The index holds every word of the license templates with its positions. Of the license words that a
file holds, the ones of highest inverse document frequency are looked up: for each template as many as
any match must have two of, and none if the file's words cannot make up a match. A hit proposes where the
template would begin; postings are intersected by that beginning, so that a proposal needs two words at
the right distance. It stands if the template's mandatory phrase is there word for word and enough of
its words are in place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters between words, base phrases and their labels.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # upper case is folded after splitting
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Label, wording of the notice, mandatory phrase. (No word has a "k": the Kelvin sign
# would fold to it, while only A-Z are to be folded.)
TEMPLATES = (
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "permission is hereby granted free of charge"),
    ("mit-release", "released under the mit license", "under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-notice", "licensed under the gnu general public license version", "gnu general public license"),
    ("lgpl-notice", "licensed under the gnu lesser general public license version", "gnu lesser general public license"),
    ("agpl-notice", "licensed under the gnu affero general public license version", "gnu affero general public license"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("mpl-notice", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    # Whole notices.
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
     "the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
     "portions of the software", "to deal in the software without restriction"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in "
     "writing software distributed under the license is distributed on an as is basis without warranties or conditions of any",
     "except in compliance with the license"),
    ("gpl-program", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
     "published by the free software foundation either version 3 of the license or at your option any later version this program is distributed "
     "in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a "
     "particular purpose", "terms of the gnu general public license"),
    ("bsd-conditions", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
     "in the documentation and or other materials provided with the distribution", "redistributions of source code must retain"),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
     "the above copyright notice and this permission notice appear in all copies", "notice and this permission notice appear in all copies"),
)
LEAST = 0.6       # share of a template's words (by idf) that must be in place


def _words(text: Column) -> Column:
    """Words of a text, not yet folded."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAK), lambda w: w != "")


def vocabulary() -> list[str]:
    return sorted({w for _, wording, _ in TEMPLATES for w in wording.split()} | {w for p in PHRASES.values() for w in p.split()})


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those with each license word; one row per word is collected."""
    known = _literal(vocabulary(), "string")
    found = docs.select(_words(F.col("text").cast("string")).alias("w")).select(
        F.explode(F.array_append(F.array_intersect(F.transform("w", F.lower), known), F.lit(""))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def index() -> dict[str, list[tuple[int, int]]]:
    """word -> [(template, position)]. Base phrases count from len(TEMPLATES) on."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, wording in enumerate([w for _, w, _ in TEMPLATES] + list(PHRASES.values())):
        for at, w in enumerate(wording.split()):
            postings.setdefault(w, []).append((t, at))
    return postings


def idf(n_docs: int, n: int) -> float:
    return math.log((n_docs + 1) / (n + 1))


def _literal(values: list, kind: str) -> Column:
    """An array of values without blanks, as one constant: a literal for each value makes plans slow to build."""
    return F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>")


def _phrase_at(words: Column, begin: Column, phrase: list[str]) -> Column:
    """Whether a phrase stands at a place that may lie outside the text."""
    there = F.slice(words, F.greatest(begin, F.lit(0)) + 1, F.lit(len(phrase)))
    return (begin >= 0) & (F.lower(F.array_join(there, " ")) == " ".join(phrase))


def rare_words(held: Column, weight: dict[str, float]) -> Column:
    """Words to look up for a template, from the license words that a file holds.

    ``weight``: a template's distinct words with their share of its weight. In falling order of weight, words are taken
    until what follows, with the heaviest one, is short of LEAST: a match then has two of the words taken. Empty if
    all words that the file holds together are short of LEAST.
    """
    order = sorted(weight, key=lambda w: (-weight[w], w))
    known = F.filter(F.arrays_zip(_literal(order, "string").alias("w"), _literal([weight[w] for w in order], "double").alias("x")),
                     lambda k: F.array_contains(held, k["w"]))
    total = lambda ks: F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + k["x"])
    need = lambda ks: F.filter(ks, lambda k, i: total(F.slice(ks, i + 1, F.size(ks))) + F.element_at(ks, 1)["x"] >= LEAST - 1e-9)
    return F.when(total(known) >= LEAST - 1e-9, F.transform(need(known), lambda k: k["w"])).otherwise(F.array().cast("array<string>"))


def licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are counted exactly, wherever a base phrase's words follow each other; first_word
    and last_word are their smallest and largest beginning. ``labels`` has the base labels and
    those of the notices found; score is the idf-weighted share of a notice's words in place (the
    best one), 0.5 at least if there is a base place, else 0. Null text counts as empty: no words,
    no places, empty labels, score 0. Repeated rows give equal rows, an empty table an empty one; other columns are
    not looked at; very long texts are looked at whole.
    """
    n_docs, frequency = document_frequencies(docs)
    rarity = lambda w: idf(n_docs, frequency.get(w, 0)) + 0.01
    shares = []  # of each template: word -> its share of the template's weight, at all its places together
    for _, wording, _ in TEMPLATES:
        weight: dict[str, float] = {}
        for w in wording.split():
            weight[w] = weight.get(w, 0.0) + rarity(w)
        shares.append({w: x / sum(weight.values()) for w, x in weight.items()})
    known, none = _literal(vocabulary(), "string"), F.array().cast("array<string>")
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _words(F.col("text").cast("string")).alias("words"))
    t = t.withColumn("held", F.array_intersect(F.transform("words", lambda x: F.lower(x)), known))
    # A base phrase is looked up by its rarest word if the file holds all of them.
    of_phrase = [F.when(F.size(F.array_except(_literal(sorted(set(p.split())), "string"), F.col("held"))) == 0,
                        F.array(F.lit(max(p.split(), key=lambda w: (rarity(w), w))))).otherwise(none) for p in PHRASES.values()]
    of_template = [rare_words(F.col("held"), share) for share in shares]
    t = t.select("doc_id", "words", F.array_distinct(F.concat(*of_phrase, *of_template)).alias("rare"))
    w = F.col("words")

    hit, spot = "array<struct<word:string,i:int>>", "struct<template:int,begin:int>"
    hits = F.filter(F.transform(w, lambda x, i: F.struct(F.lower(x).alias("word"), i.alias("i"))), lambda h: F.array_contains("rare", h["word"]))
    t = t.withColumn("hits", F.when(F.size("rare") > 0, hits.cast(hit)).otherwise(F.array().cast(hit)))
    postings = F.str_to_map(F.lit(" ".join(f"{word}:" + ",".join(f"{p}@{at}" for p, at in places) for word, places in index().items())),
                            F.lit(" "), F.lit(":"))
    begins_of = F.flatten(F.transform("hits", lambda h: F.transform(F.split(postings[h["word"]], ","), lambda p: F.struct(
        F.split_part(p, F.lit("@"), F.lit(1)).cast("int").alias("template"),
        (h["i"] - F.split_part(p, F.lit("@"), F.lit(2)).cast("int")).alias("begin")))))
    t = t.withColumn("spots", F.array_sort(begins_of.cast(f"array<{spot}>")))
    # Two words at the right distance: a beginning that comes twice. One word is enough for a base phrase.
    agreed = F.array_distinct(F.filter("spots", lambda s, i: (F.get("spots", i + 1) == s) | (s["template"] >= len(TEMPLATES))))
    t = t.select("doc_id", "words", agreed.alias("proposals"))

    def begins(template):
        """Proposed beginnings of one template or phrase."""
        return F.transform(F.filter("proposals", lambda p: p["template"] == template), lambda p: p["begin"])

    def base_places(k, phrase):
        return F.filter(begins(len(TEMPLATES) + k), lambda b: _phrase_at(w, b, phrase))

    def best_match(k, words, phrase):
        lead = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        weight = [rarity(x) for x in words]
        template = F.arrays_zip(_literal(words, "string").alias("w"), _literal([x / sum(weight) for x in weight], "double").alias("x"))
        share = lambda begin: F.aggregate(
            F.transform(template, lambda x, i: F.when((begin + i >= 0) & (F.lower(F.get(w, begin + i)) == x["w"]), x["x"]).otherwise(0.0)),
            F.lit(0.0), lambda acc, x: acc + x)
        found = F.filter(begins(k), lambda b: _phrase_at(w, b + lead, phrase))
        return F.array_max(F.array_append(F.transform(found, share), F.lit(0.0)))

    bases = [base_places(k, phrase.split()) for k, phrase in enumerate(PHRASES.values())]
    matches = [best_match(k, wording.split(), phrase.split()) for k, (_, wording, phrase) in enumerate(TEMPLATES)]
    t = t.select("doc_id", F.size("words").cast("long").alias("n_words"),
                 *[b.alias(f"base_{k}") for k, b in enumerate(bases)], *[m.alias(f"match_{k}") for k, m in enumerate(matches)])
    every = F.concat(*[F.col(f"base_{k}") for k in range(len(PHRASES))])
    base = [F.when(F.size(f"base_{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES)]
    found = [F.col(f"match_{k}") >= LEAST - 1e-9 for k in range(len(TEMPLATES))]
    more = [F.when(f, F.lit(label)) for f, (label, _, _) in zip(found, TEMPLATES)]
    best = F.greatest(*[F.when(f, F.col(f"match_{k}")).otherwise(0.0) for k, f in enumerate(found)])
    joined = lambda cols: F.array_join(F.array_sort(F.array_compact(F.array(*cols))), ",")
    return t.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(base + more).alias("labels"),
        F.least(F.lit(1.0), F.greatest(best, F.when(F.size(every) > 0, 0.5).otherwise(0.0))).alias("score"))
