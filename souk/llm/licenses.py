"""License scans: an exact set-similarity join of text blocks with templates.

A template is a short license statement; a text block is a run of words about
twice as long as the template; a block is found if it holds at least the
threshold share (containment) of the template's distinct words.  Blocks of
size class ``m`` (the template's words, rounded up to a multiple of 4) begin at
every ``m``-th word and hold ``2m`` words, so every run of ``m`` words lies
whole in a block.

The join's words have one global order, rarest in all texts first:

* prefix filter: a template of ``t`` words of which ``need = ceil(0.8 t)`` must
  be held shares one of its ``t - need + 1`` rarest words with the block, so only
  blocks around such words are built, and the join key is that word;
* length filter: the block holds at least ``need`` words of the templates;
* positional filter: if the first shared word is ``i``-th in the template's order
  and ``j``-th in the block's, at most ``1 + min(t - i, b - j)`` are shared;
* verification: the shared words are counted.

Words that no template has cannot count, so leaving them out is exact.

Beside the templates, phrases are looked for as consecutive words: their
places and labels are the base of the result.

Everything is DataFrame functions.  A null or empty text has no words: counts
0, no places, empty labels, score 0.  Repeated rows and ids are rows of their
own; other columns are kept out of the result unless named.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import saved

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CONTAINMENT = 80                 # percent
STEP = 4                         # size classes are multiples of this
WORDS_PER_PLAN = 2_000           # distinct template words with one order; more templates take several


class Template(NamedTuple):
    label: str
    text: str


# --- fixed values: phrases with their labels, and license statements -----------
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("epl", "made available under the terms of the Eclipse Public License"),
    Template("boost", "Distributed under the Boost Software License, Version 1.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("all-rights-reserved", "All rights reserved"),
)
# ------------------------------------------------------------------------------


class _Form(NamedTuple):
    """A template as a set: its words, size class and how many must be held."""

    label: str
    words: frozenset
    size: int
    need: int


def template_words(text: str) -> list[str]:
    """The words of a template, as those of a document: A-Z lower-cased."""
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def _forms(templates: Sequence[Template], containment: int) -> list[_Form]:
    out = []
    for t in templates:
        words = template_words(t.text)
        held = frozenset(words)
        if held:
            out.append(_Form(t.label, held, -(-len(words) // STEP) * STEP, math.ceil(containment * len(held) / 100)))
    return out


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def phrase_starts(words: Column, phrase: str) -> Column:
    """Places (from 0) where the phrase's words stand one after another."""
    parts = phrase.split(" ")
    first = F.when(F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts))).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        # the last word first: it is the rarest
        return _all([F.get(words, i + k) == w for k, w in reversed(list(enumerate(parts)))])
    # a text without the last word has no place
    return F.when(F.array_contains(words, parts[-1]), F.filter(first, here)).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


class _Plan(NamedTuple):
    """Templates of one plan with the global order of their words."""

    forms: list[_Form]
    order: dict[_Form, list[str]]      # a template's words, rarest in all texts first
    ordered: list[str]                 # all words, rarest first

    def prefix(self, form: _Form) -> list[str]:
        return self.order[form][:len(form.words) - form.need + 1]

    def blocks(self, number: int, words: Column) -> Column:
        """The blocks around prefix words, ``(plan, size, block, held)``; ``held``
        are a block's template words in the global order."""
        rare = sorted({w for f in self.forms for w in self.prefix(f)})
        every = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(rare))
        per_size = []
        for size in sorted({f.size for f in self.forms}):
            mine = [f for f in self.forms if f.size == size]
            some = sorted({w for f in mine for w in self.prefix(f)})
            vocab = _strings([w for w in self.ordered if any(w in f.words for f in mine)])
            per_size.append((size, some, vocab))

        def of_size(hits: Column, size: int, some: list[str], vocab: Column) -> Column:
            at = F.filter(hits, lambda i: F.get(words, i).isin(some))
            starts = F.flatten(F.transform(at, lambda i: F.array(F.floor(i / size) - 1, F.floor(i / size))))
            return F.transform(F.filter(F.array_distinct(starts), lambda b: b >= 0), lambda b: F.struct(
                F.lit(number).alias("plan"), F.lit(size).alias("size"), b.alias("block"),
                F.array_intersect(vocab, F.slice(words, (b * size).cast("int") + 1, 2 * size)).alias("held")))

        # one pass over all words; the sizes look at the hits only
        return F.flatten(F.transform(F.array(every), lambda hits: F.concat(*[of_size(hits, *args) for args in per_size])))


def _plans(words: DataFrame, forms: list[_Form]) -> list[_Plan]:
    """Templates in plans of at most WORDS_PER_PLAN words (or one template), with
    the frequencies of their words in all texts (one row per template word)."""
    vocab = sorted(frozenset().union(*[f.words for f in forms]))
    mine = words.select(F.explode(F.filter("words", lambda w: w.isin(vocab))).alias("word"))
    often = {r.word: r["count"] for r in mine.groupBy("word").count().collect()}
    place = {w: i for i, w in enumerate(sorted(vocab, key=lambda w: (often.get(w, 0), w)))}
    batches: list[list[_Form]] = [[]]
    for f in forms:
        if batches[-1] and len(frozenset().union(f.words, *[g.words for g in batches[-1]])) > WORDS_PER_PLAN:
            batches.append([])
        batches[-1].append(f)
    return [_Plan(b, {f: sorted(f.words, key=place.__getitem__) for f in b},
                  sorted(frozenset().union(*[f.words for f in b]), key=place.__getitem__)) for b in batches]


def _join(blocks: DataFrame, plans: list[_Plan]) -> DataFrame:
    """The blocks of ``blocks`` (``row, plan, size, block, held``) that hold a template."""
    index = blocks.sparkSession.createDataFrame(
        [(n, f.size, w, i, f.label, f.need, len(f.words), plan.order[f])
         for n, plan in enumerate(plans) for f in plan.forms for i, w in enumerate(plan.prefix(f))],
        "plan int, size int, word string, i int, label string, need int, of int, wanted array<string>")
    each = blocks.select("*", F.posexplode("held").alias("j", "word"))
    pairs = each.join(index, ["plan", "size", "word"])
    longest = F.size("held") >= F.col("need")
    reach = F.least(F.col("of") - F.col("i"), F.size("held") - F.col("j")) >= F.col("need")
    both = F.array_intersect("wanted", "held")
    # of the words shared by a pair the first in the order decides; later ones reach less far
    first = F.get(both, F.lit(0)) == F.col("word")
    return (pairs.where(longest & reach).where(first & (F.size(both) >= F.col("need")))
            .select("row", "block", "size", "label", (F.size(both) / F.col("of")).alias("share")))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
         containment: int = CONTAINMENT) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (``doc_id``, ``text``): ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score``; and the found blocks
    (``row, doc_id, first_word, n_words, label, share``).

    ``score`` is 1 with a phrase, else the greatest share of a found block, else
    0.  The texts are read twice (word frequencies, then blocks); nothing of
    their size is stored or shuffled.
    """
    spark = docs.sparkSession
    forms = _forms(templates, containment)
    words = docs.select("doc_id", words_of(F.col("text").cast("string")).alias("words"))
    plans = _plans(words, forms) if forms else []
    starts = [phrase_starts(F.col("words"), p) for p, _ in phrases]
    base = F.array_compact(F.array(*[F.when(F.size(s) > 0, F.lit(label)) for s, (_, label) in zip(starts, phrases)]))
    none = F.array().cast("array<struct<plan:int,size:int,block:bigint,held:array<string>>>")
    seen = saved(words.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").alias("n"),
        F.concat(F.array().cast("array<int>"), *starts).alias("at"), base.cast("array<string>").alias("base"),
        F.concat(none, *[p.blocks(n, F.col("words")) for n, p in enumerate(plans)]).alias("blocks")), "license-blocks")
    blocks = seen.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    if plans:
        found = _join(blocks, plans)
    else:
        found = spark.createDataFrame([], "row long, block long, size int, label string, share double")
    found = saved(found, "license-found")
    per = found.groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))   # labels: few
    joined = seen.drop("blocks").join(per, "row", "left")
    every = F.array_union("base", F.coalesce("own", F.array().cast("array<string>")))
    result = joined.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("at") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
    where = seen.select("row", "doc_id").join(found, "row").select(
        "row", "doc_id", (F.col("block") * F.col("size")).alias("first_word"), (2 * F.col("size")).alias("n_words"), "label", "share")
    return result, where
