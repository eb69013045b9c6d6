"""License scan: phrases, and an exact set-similarity join of text blocks with license templates.

Base: a place is where a phrase's words stand consecutively; places come from one regular expression per text.

Method: a block is a line of a text or a passage over line breaks, a template a set of words with a label. A block meets
a template if it contains at least ``CONTAINED`` of the template's words. A passage is a window of as many consecutive
words as the template has, and a tenth more. If a line meets a template alone, that template's words in it take no part in
passages, so every passage that is found is wrapped over lines, and a word counts for one notice. Of overlapping passages
the one with most words of the template, then the shortest, is the block; its number is that of the line in which it
begins. Only texts that have enough of a template's words are searched. Words of templates are ordered by their frequency over all documents, rarest
first. A block can only meet a template of which it has at least one of the first |T| - o + 1 words (prefix filter; o: the
words needed), also for windows, which are tried only where a word of the prefix stands; of whose vocabulary it has at least o words (length filter), and where the words that follow the shared
one in both are enough to get to o (positional filter). What passes is counted in full. The join is on the word, with
the templates' prefixes; their number depends on the templates alone, so that side is broadcast.

A null text is empty; an empty text has no words, places or labels and score 0. Rows with equal ids share the method's
labels; null ids are a group of their own.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.llm import common

CONTAINED = 0.9
#: words of templates in a text that windows are cut from together
PIECE = 256

# Phrases of the base, each with its label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# First sentences and common notices of public licenses.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("proprietary", "All rights reserved."),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without written permission"),
]

# A word character before A-Z are lower-cased, and what stands between words.
_CHAR = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORDS = _CHAR + "+"
_PLACE = rf"(?<!{_CHAR})(?i:" + "|".join(_GAP.join(p.split()) for p in PHRASES) + rf")(?!{_CHAR})"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _GAP, -1), "")


def _template_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


def _template_sets() -> list[tuple[str, list[str]]]:
    return [(label, list(dict.fromkeys(_template_words(text)))) for label, text in TEMPLATES]


def base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word and the distinct labels of its places (``_base``)."""
    df = common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col))
    n = lambda c: F.regexp_count(c, F.lit(_WORDS)).cast("bigint")
    some = F.lower("_t").contains("license")  # a cheap test that every place passes
    df = df.withColumn("n_words", n(F.col("_t"))).withColumn("_m", F.when(some, F.regexp_extract_all("_t", F.lit(_PLACE), F.lit(0))))
    df = df.withColumn("_has", F.coalesce(F.size("_m") > 0, F.lit(False))).withColumn("_between", F.when(F.col("_has"), F.split("_t", _PLACE, -1)))
    phrase = F.transform("_m", lambda m: F.lower(F.regexp_replace(m, _GAP, " ")))
    df = df.withColumn("_m", F.when(F.col("_has"), phrase))
    label, length = F.lit(None).cast("string"), F.lit(0)
    last = F.element_at("_m", -1)
    for p in PHRASES:
        length = F.when(last == p, F.lit(len(p.split()))).otherwise(length)

    def label_of(m: Column) -> Column:
        out = label
        for p, name in PHRASES.items():
            out = F.when(m == p, F.lit(name)).otherwise(out)
        return out

    return df.select(
        "_id",
        "n_words",
        F.when(F.col("_has"), F.size("_m")).otherwise(F.lit(0)).cast("bigint").alias("n_base"),
        F.when(F.col("_has"), n(F.element_at("_between", 1))).alias("first_word"),
        F.when(F.col("_has"), F.col("n_words") - n(F.element_at("_between", -1)) - length).cast("bigint").alias("last_word"),
        F.coalesce(F.array_sort(F.array_distinct(F.transform("_m", label_of))), F.array().cast("array<string>")).alias("_base"),
    )


def _meets(of: Column, template: Column) -> Column:
    return (F.size(of) >= template["need"]) & (F.size(F.array_intersect(of, template["words"])) >= template["need"])


def _passages(lines: Column, templates: Column, template: Column) -> Column:
    """Where words of ``template`` (words, need, window) from several of ``lines`` (i, w, s) stand together: array of
    (i, seen)."""
    words, need, longest = template["words"], template["need"], template["window"]

    def free(x: Column) -> Column:  # the line's words without those of templates that it meets alone
        taken = F.flatten(F.transform(F.filter(templates, lambda t: _meets(x["s"], t)), lambda t: t["words"]))
        kept = lambda ws: F.transform(x["w"], lambda w: F.struct(x["i"].alias("i"), F.when(F.array_contains(words, w) & ~F.array_contains(ws, w), w).alias("w")))
        return F.flatten(F.transform(F.array(taken), kept))

    placed = F.flatten(F.transform(lines, free))
    placed = F.transform(placed, lambda x, p: F.struct(p.alias("p"), x["i"].alias("i"), x["w"].alias("w")))
    placed = F.filter(placed, lambda x: x["w"].isNotNull())
    passage = lambda p, i, end, seen: F.struct(p.alias("p"), i.alias("i"), end.alias("end"), seen.alias("seen"))

    def add(a: Column, x: Column) -> Column:
        return F.when(F.array_contains(a["seen"], x["w"]), a).otherwise(passage(a["p"], a["i"], x["p"], F.concat(a["seen"], F.array(x["w"]))))

    def windows(all_: Column) -> Column:
        def window(some: Column):
            def of(x: Column, k: Column) -> Column:
                within = F.filter(F.slice(some, k + 1, longest), lambda y: y["p"] < x["p"] + longest)
                fits = lambda ws: (F.size(ws) >= need) & F.exists(ws, lambda y: F.array_contains(template["prefix"], y["w"]))
                seen = lambda ws: F.when(fits(ws), F.aggregate(ws, passage(x["p"], x["i"], x["p"], F.array().cast("array<string>")), add))
                return F.get(F.transform(F.array(within), seen), F.lit(0))

            return of

        # a slice costs as much as what it is cut from, so windows are cut from pieces
        def piece(at: Column) -> Column:
            whole = lambda some: F.transform(F.slice(some, F.lit(1), F.lit(PIECE)), lambda x, k: window(some)(x, k))
            return common.bound(F.slice(all_, at, PIECE + longest), whole)

        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(PIECE)), lambda k: k <= F.size(all_))
        return F.filter(F.flatten(F.transform(starts, piece)), lambda x: x.isNotNull() & (F.size(x["seen"]) >= need))

    # what a fold carries is copied at every step, so it carries the windows' numbers only
    light = "struct<picks:array<int>,p:int,end:int,n:int>"

    def best(a: Column, x: Column) -> Column:
        more = x["n"] - a["n"]
        better = (more > 0) | ((more == 0) & (x["end"] - x["p"] < a["end"] - a["p"]))
        apart = (F.size(a["picks"]) == 0) | (x["p"] > a["end"])
        took = lambda picks: F.struct(F.concat(picks, F.array(x["k"])).alias("picks"), x["p"].alias("p"), x["end"].alias("end"), x["n"].alias("n"))
        return F.when(apart, took(a["picks"])).when(better, took(F.slice(a["picks"], F.lit(1), F.size(a["picks"]) - 1))).otherwise(a)

    def chosen(found: Column) -> Column:
        told = F.transform(found, lambda x, k: F.struct(x["p"].alias("p"), x["end"].alias("end"), F.size(x["seen"]).alias("n"), k.alias("k")))
        none = F.struct(F.array().cast("array<int>").alias("picks"), *[F.lit(0).alias(c) for c in ("p", "end", "n")]).cast(light)
        picks = F.aggregate(told, none, lambda a, x: best(a, x).cast(light), lambda a: a["picks"])
        return F.transform(picks, lambda k: F.element_at(found, k + 1))

    return common.bound(placed, lambda all_: common.bound(windows(all_), chosen))


def _blocks(docs: DataFrame, id_col: str, text_col: str, order: list[str], prefixes: list[str], sets: list[tuple[list[str], int, int, list[str]]]) -> DataFrame:
    """Lines with as many words of templates as one of them needs, one of a prefix among them, and passages over line
    breaks: (_id, _block, _set). ``sets`` has the words, the need, the window and the prefix of each template. ``_set`` has the block's words of
    templates in global order. Blocks are sifted within a text's array, so each text is cut once."""
    df = common.packed(docs, False, _id=F.col(f"`{id_col}`"), _t=common.text_of(text_col))
    known, first = (F.array(*[F.lit(w) for w in ws]) for ws in (order, prefixes))
    list_of = lambda ws: F.array(*[F.lit(w) for w in ws])
    templates = F.array(*[F.struct(list_of(ws).alias("words"), F.lit(need).alias("need"), F.lit(window).alias("window"), list_of(prefix).alias("prefix")) for ws, need, window, prefix in sets])
    least = min(need for _, need, _, _ in sets)
    cut = F.transform(F.split("_t", "\n", -1), lambda x, i: F.struct(i.alias("i"), _words(F.lower(x)).alias("w")))
    cut = F.transform(cut, lambda x: F.struct(x["i"].alias("i"), x["w"].alias("w"), F.array_intersect(known, x["w"]).alias("s")))

    def sifted(lines: Column) -> Column:
        alone = F.filter(lines, lambda x: (F.size(x["s"]) >= least) & F.arrays_overlap(x["s"], first))
        alone = F.transform(alone, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s")))
        all_ = F.when(F.size(lines) > 1, F.array_distinct(F.flatten(F.transform(lines, lambda x: x["s"])))).otherwise(F.array().cast("array<string>"))
        near = F.transform(F.array(all_), lambda a: F.filter(templates, lambda t: _meets(a, t)))
        found = F.flatten(F.transform(F.flatten(near), lambda t: _passages(lines, templates, t)))
        return F.concat(alone, F.transform(found, lambda x: F.struct(x["i"].alias("i"), F.array_intersect(known, x["seen"]).alias("s"))))

    blocks = F.flatten(F.transform(F.array(cut), sifted))
    return df.select("_id", F.explode(blocks).alias("_line")).select("_id", F.col("_line.i").alias("_block"), F.col("_line.s").alias("_set"))


def word_order(docs: DataFrame, text_col: str, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` by frequency over all documents, rarest first; a row per word of the templates comes back."""
    df = common.packed(docs, False, _w=_words(F.lower(common.text_of(text_col))))
    df = df.select(F.explode(F.filter("_w", lambda w: w.isin(*vocabulary))).alias("_word"))
    counts = {r["_word"]: r["n"] for r in df.groupBy("_word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def template_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", contained: float = CONTAINED) -> DataFrame:
    """Every (_id, block, label, share) where the block has at least ``contained`` of a template's words."""
    spark = docs.sparkSession
    sets = _template_sets()
    order = word_order(docs, text_col, sorted({w for _, ws in sets for w in ws}))
    rank = {w: k for k, w in enumerate(order)}
    index, needs, starts = [], [], []
    for label, ws in sets:
        ranks = sorted(rank[w] for w in ws)
        need = math.ceil(contained * len(ranks) - 1e-9)
        needs.append(need)
        starts.append([order[r] for r in ranks[: len(ranks) - need + 1]])
        index += [(order[ranks[k]], k, label, need, len(ranks), [order[r] for r in ranks]) for k in range(len(ranks) - need + 1)]
    windows = [(ws, need, math.ceil(len(_template_words(text)) / contained), prefix) for (_, ws), need, (_, text), prefix in zip(sets, needs, TEMPLATES, starts, strict=True)]
    templates = F.broadcast(spark.createDataFrame(index, "_word string, _pos int, label string, _need int, _size int, _template array<string>"))
    blocks = _blocks(docs, id_col, text_col, order, sorted({w for w, *_ in index}), windows)
    probes = blocks.select("_id", "_block", "_set", F.posexplode("_set").alias("_at", "_w"))
    met = probes.join(templates, F.col("_w") == F.col("_word"))
    met = met.where(F.size("_set") >= F.col("_need"))  # length
    met = met.where(F.least(F.col("_size") - F.col("_pos"), F.size("_set") - F.col("_at")) >= F.col("_need"))  # position
    met = met.withColumn("_both", F.size(F.array_intersect("_set", "_template")))
    return met.where(F.col("_both") >= F.col("_need")).select("_id", "_block", "label", (F.col("_both") / F.col("_size")).alias("share"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks (lines in
    which a block begins that meets a template). The score is 1 with a place of the base, else the largest share of a template that a block has."""
    found = template_join(docs, id_col, text_col)
    found = found.groupBy("_id").agg(F.collect_set("label").alias("_labels"), F.max("share").alias("_share"), F.countDistinct("_block").alias("_blocks"))
    found = found.withColumnRenamed("_id", "_of")
    df = base(docs, id_col, text_col)
    df = df.join(found, F.col("_id").eqNullSafe(F.col("_of")), "left")
    labels = F.array_sort(F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    return df.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
        F.coalesce("_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )


def query(spark, sf_dir):
    """op4: license phrases and notices of every document."""
    return scan(common.documents(spark, sf_dir))


def _sql() -> str:
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    phrases = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({quoted(ws)}, '{label}')" for label, ws in _template_sets())
    cut = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {cut}) AS w FROM d
), places AS (
  SELECT doc_id, i - 1 AS i, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w), (VALUES {phrases}) AS p(p, label)
  WHERE w[i] = p[1] AND list_slice(w, i, i + len(p) - 1) = p
), base AS (
  SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list_sort(list_distinct(list(label))) AS labels FROM places GROUP BY doc_id
), lines AS (
  SELECT doc_id, i, list_distinct(regexp_extract_all(lower(x), {cut})) AS s
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)
), met AS (
  SELECT doc_id, i, label, len(list_intersect(s, p)) / len(p) AS share FROM lines, (VALUES {templates}) AS p(p, label)
  WHERE len(list_intersect(s, p)) >= ceil({CONTAINED} * len(p) - 1e-9)
), found AS (
  SELECT doc_id, list_distinct(list(label)) AS labels, max(share) AS share, count(DISTINCT i) AS blocks FROM met GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, lo AS first_word, hi AS last_word,
       array_to_string(coalesce(base.labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score, CAST(coalesce(blocks, 0) AS BIGINT) AS n_blocks
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


SQL = _sql()
