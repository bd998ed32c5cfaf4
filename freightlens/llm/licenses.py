"""Licence scan: an exact set-similarity join of text blocks and notice templates.

Blocks are all runs of consecutive words of a text, whatever its lines, as long
as the template's notice by 100 / ``percent``.  A block matches a template if it
holds at least ``percent`` of the template's distinct words.  The join is exact:

* template words are ordered by their frequency in the whole corpus, rarest
  first;
* prefix filter: with ``need`` of ``t`` words asked for, a matching block holds
  one of the first ``t - need + 1``; the join runs on the places of those words,
  each with the words so near that a block can hold both;
* length filter: these are at least ``need`` words of the templates at all;
* positional filter: a common word at place i of the template and j of the
  words near it (both in frequency order) leaves min(t - i, b - j) common words.

Everything runs on built-in functions.  The templates are parameters, so their
index is the only side that is broadcast; the words of a common notice never meet
in one task, as blocks are grouped by the text they come from.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import ascii_lower

# Phrases and their labels (the base rule).
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Usual licence notices and their SPDX names in lower case.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
PERCENT = 80
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal(text: Column) -> Column:
    """Lower-cased (A-Z) words joined by one space."""
    return F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))


def spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def word_frequency(texts: DataFrame, words: list[str]) -> DataFrame:
    """``word, n``: texts of ``texts(words_line)`` that hold each of ``words``."""
    own = F.array(*[F.lit(w) for w in words])
    return (texts.select(F.explode(F.array_intersect(F.split("words_line", " "), own)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None,
         percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, blocks`` for every row of ``docs(doc_id, text)``.

    Words are runs of characters other than ASCII that is no letter or digit.
    ``n_base`` counts all places of the phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (words from 0, else
    null).  ``blocks`` lists ``start, label, common`` of the best matching block
    around each place of a prefix word (the first of equal ones); ``score`` is 1 with a phrase, else the best share of a template
    among the matches, else 0.

    Null or empty texts: no words, empty labels, score 0.  A null id stays
    null; repeated rows give equal results each; other columns are ignored; an
    empty table gives an empty result.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("words_line", normal(F.col("text")))

    # Places of the phrases.
    any_phrase = "|".join(phrases)
    line = F.concat(F.lit(" "), "words_line", F.lit(" "))
    holds = {p: F.contains(line, F.lit(f" {p} ")) for p in phrases}
    has_any = reduce(Column.__or__, holds.values(), F.lit(False))
    base_labels = F.array_distinct(F.array_sort(F.array_compact(F.array(
        *[F.when(holds[p], F.lit(label)) for p, label in phrases.items()]))))
    found = rows.select(
        "doc_id", "text",
        F.when(F.col("words_line") == "", 0).otherwise(spaces(F.col("words_line")) + 1).cast("long").alias("n_words"),
        F.when(has_any, F.regexp_count(line, F.lit(f"(?<= )(?:{any_phrase})(?= )"))).otherwise(0).cast("long").alias("n_base"),
        F.when(has_any, spaces(F.regexp_extract(line, f"(?s)^(.*? )(?:{any_phrase}) ", 1)) - 1).cast("long").alias("first_word"),
        F.when(has_any, spaces(F.regexp_extract(line, f"(?s)^(.* )(?:{any_phrase}) ", 1)) - 1).cast("long").alias("last_word"),
        base_labels.alias("base_list"),
        "words_line")

    # Templates in frequency order; the counts are one small row per template word.
    sets = [(label, sorted(set(t.split())), math.ceil(len(t.split()) * 100 / percent)) for label, t in templates]
    vocabulary = sorted({w for _, t, _ in sets for w in t})
    counts = {r.word: r.n for r in word_frequency(rows, vocabulary).collect()}
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for k, (label, words, width) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        need = math.ceil(len(ranks) * percent / 100)
        index += [(order[ranks[i]], ranks[i], i, k, label, [order[r] for r in ranks], need, width) for i in range(len(ranks) - need + 1)]
    spark = docs.sparkSession
    index = spark.createDataFrame(index, "word string, rank int, i int, template int, label string, notice array<string>, need int, width int")
    prefix = sorted({r.word for r in index.select("word").distinct().collect()})
    reach = max((width for *_, width in sets), default=1) - 1

    # Places of prefix words, with the words near them.
    rarer = F.map_from_arrays(F.array(*[F.lit(w) for w in order]), F.array(*[F.lit(rank[w]) for w in order]))
    own = F.array(*[F.lit(w) for w in order])
    starts = F.array(*[F.lit(w) for w in prefix])
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("hash"))
    texts = found.select(key.alias("key"), F.split("words_line", " ").alias("words")).where(F.arrays_overlap("words", starts))
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefix), i)), lambda i: i.isNotNull())

    def near(words: Column, at: Column, reach: int | Column) -> tuple[Column, Column]:
        """The first place within ``reach`` of ``at``, and the words from there."""
        first = F.greatest(at - reach, F.lit(0))
        return first, F.slice(words, first + 1, at - first + 1 + reach)

    def around(at: Column) -> Column:
        first, words = near(F.col("words"), at, F.lit(reach))
        return F.struct(at.alias("at"), first.alias("first"), words.alias("near"))

    blocks = (texts.select("key", F.explode(F.transform(places, around)).alias("p"))
              .select("key", "p.at", "p.first", "p.near", F.element_at("p.near", F.col("p.at") - F.col("p.first") + 1).alias("word")))
    common = blocks.join(F.broadcast(index), "word")
    at = F.col("at") - F.col("first")
    first, words = near(F.col("near"), at, F.col("width") - 1)
    common = common.select("key", (F.col("at") - at + first).alias("first"), (at - first).alias("at"), words.alias("near"), "rank", "i", "label", "notice", "need", "width")
    block = F.transform(F.array_intersect("near", own), lambda w: rarer[w])
    rest = F.size(F.filter(block, lambda r: r >= F.col("rank")))  # b - j
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.col("at")), lambda i: F.struct(
        F.size(F.array_intersect(F.slice("near", i + 1, F.col("width")), F.col("notice"))).alias("common"), (-i).alias("before"))))
    hits = (common.where(F.size(F.array_intersect("near", "notice")) >= F.col("need"))
            .where(F.least(F.size("notice") - F.col("i"), rest) >= F.col("need"))
            .select("key", "label", "need", "first", F.size("notice").alias("size"), best.alias("best"))
            .where(F.col("best.common") >= F.col("need"))
            .select("key", "label", "size", (F.col("first") - F.col("best.before")).alias("start"), F.col("best.common").alias("common")))
    labelled = hits.groupBy("key").agg(
        F.array_sort(F.collect_set("label")).alias("own_labels"), F.max(F.col("common") / F.col("size")).alias("best"),
        F.array_sort(F.collect_set(F.struct("start", "label", "common"))).alias("blocks"))
    narrow = found.select("doc_id", F.xxhash64("text").alias("hash"), "n_words", "n_base", "first_word", "last_word", "base_list")
    k = labelled.select(F.col("key.doc_id").alias("its"), F.col("key.hash").alias("hash"), "own_labels", "best", "blocks")
    out = narrow.join(k, (narrow["hash"] == k["hash"]) & narrow["doc_id"].eqNullSafe(k["its"]), "left")
    nothing = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_list", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_list", F.coalesce("own_labels", nothing))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), "blocks")
