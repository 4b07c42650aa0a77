"""Licence scan: sparse TF-IDF cosine of text units to templates, then inheritance from the nearest folder.

Built on DataFrame functions alone. Three kinds of units are compared:

* a line or sentence of a file's whole text with one-sentence notices (``TEMPLATES``);
* a sentence of the leading header block, its wrapped lines joined, with the same notices;
* the whole header block and the whole file with the standard headers and whole licence texts (``license_texts``).

The header block is the comments a file begins with, or its first paragraph if it begins with none. Whole files are compared
whatever their name is. Words are weighted by tf * idf, idf coming from all lines and sentences of all files; words of
no template of the unit's kind get the idf of an unseen word, so they only lengthen the vector. A file's own licence is that of
its best unit, if the cosine reaches ``least``; a match of a header or whole text tells more than one of a notice and goes before it.

Prefix filtering keeps this cheap without losing a match: for each template, words that together are
too light for ``least`` can't make a match alone, so a matching unit holds one of the other words. Only
units with such a word are taken apart.

Licence files (by name) speak for their folder. A file without a licence of its own takes that of the
nearest folder above it that has one: every folder is joined with its ancestors' paths, once per folder and not per file.

Defined results: a null text counts as empty and a null path as the file "" of the root folder; both have no licence unless
they inherit one. Rows that repeat a path count as one file with all their units. Ties go to the
larger cosine, then the licence's name, and between licence files of one folder likewise.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.license_texts import long_templates
from tickloom.llm.storage import saved

#: Notices of well-known licences.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
LEAST = 0.7
UNIT_END = r"\n|[.!?]\s+"
#: The comments at the start of a text. All repetitions are possessive or lazy ones of a single place, so none recurses.
HEADER = (
    r"(?s)\A\ufeff?(?:\s*+(?:\#!|\#\s*(?:ifndef|ifdef|if|define|pragma)\b|<\?|<!DOCTYPE)[^\n]*+)*+"
    r"(?:\s*+(?:/\*.*?\*/|<!--.*?-->|[ru]?\"{3}.*?\"{3}|[ru]?'{3}.*?'{3}|\(\*.*?\*\)|\{-.*?-\}|=begin\b.*?=end\b"
    r"|(?:\#(?!\s*(?:include|if|ifdef|ifndef|define|import|pragma|undef)\b)|//|--|;|%|\*|!|'|\.\.|\.\\\"|@?(?i:rem|dnl)\b)[^\n]*+))*+"
)
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|notice)"


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def _tokens(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), "[^a-z0-9]+"), lambda w: w != "")


def _units(files: DataFrame) -> DataFrame:
    return files.select("path", F.explode(F.split("text", UNIT_END)).alias("unit")).where(F.col("unit") != "")


def word_weights(files: DataFrame, templates) -> tuple[dict[str, float], float]:
    """idf of every template word, and of a word that no template has; the words counted are those of the templates."""
    spark = files.sparkSession
    vocabulary = sorted({w for _, t in templates for w in _words(t)})
    words = spark.createDataFrame([(w,) for w in [*vocabulary, ""]], "word string")
    # The empty word stands for the unit itself, so one pass counts units and words.
    seen = _units(files).select(F.explode(F.array_append(F.array_distinct(_tokens(F.col("unit"))), F.lit(""))).alias("word"))
    counted = {r["word"]: r["n"] for r in seen.join(F.broadcast(words), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    units = counted.get("", 0)

    def idf(n: int) -> float:
        return math.log((1 + units) / (1 + n)) + 1

    return {w: idf(counted.get(w, 0)) for w in vocabulary}, idf(0)


def needed_words(weights: dict[str, float], least: float, common: frozenset[str] = frozenset()) -> set[str]:
    """Words of a template of which any unit of cosine ``least`` holds one: all but the lightest that can't do it alone.

    ``common`` words are left out before lighter ones, as far as they can't do it alone either.
    """
    light, bound = 0.0, least * least * sum(w * w for w in weights.values())
    out = set()
    for word, w in sorted(weights.items(), key=lambda x: (x[0] not in common, x[1], x[0])):
        light += w * w
        if light >= bound * (1 - 1e-9):
            out.add(word)
    return out


def _header_block(text: Column) -> Column:
    """The block a text begins with, paragraphs parted by a blank line."""
    comments = F.regexp_extract(text, HEADER, 0)
    first = F.split(F.regexp_replace(text, r"\A\s++", ""), r"\n[^\S\n]*+\n", 2)[0]
    block = F.when(comments.rlike(r"[A-Za-z0-9]"), comments).otherwise(first)
    return F.regexp_replace(block, r"\n(?:[^A-Za-z0-9\n]*+\n)++", "\n\n")


def _unwrapped(block: Column) -> Column:
    """The sentences of a block of several lines, each as one line."""
    joined = F.regexp_replace(block, r"(?<!\n)\n(?!\n)[^A-Za-z0-9\n]*+(?:(?i:rem|dnl)\b)?", " ")
    return F.when(F.instr(block, "\n") > 0, F.split(joined, UNIT_END)).otherwise(F.array().cast("array<string>"))


def _one_of(words: set[str]) -> str:
    """Pattern of any of the words, parted by their first letters, so that most places fail at once."""
    starts = {w[0] for w in words}
    ends = {c: "|".join(sorted(w[1:] for w in words if w[0] == c)) for c in starts}
    return rf"(?<![a-z0-9])(?:{'|'.join(f'{c}(?:{ends[c]})' for c in sorted(starts))})(?![a-z0-9])"


class _Templates:
    """Vectors of a group of templates, and the pattern of the words that any unit near enough to one of them holds."""

    def __init__(self, templates, idf: dict[str, float], unseen: float, least: float) -> None:
        vectors = []
        for _, text in templates:
            words = _words(text)
            vectors.append({w: words.count(w) * idf[w] for w in set(words)})
        own = set().union(*vectors)
        common = frozenset(w for w in own if idf[w] < 0.7 * unseen)
        norms = [math.sqrt(sum(w * w for w in v.values())) for v in vectors]
        self.needed = _one_of(set().union(*(needed_words(v, least, common) for v in vectors)))
        self.rows = [(w, number, name, v[w] / norms[number]) for number, ((name, _), v) in enumerate(zip(templates, vectors)) for w in sorted(v)]
        self.known = [(w, idf[w]) for w in sorted(own)]


def _telling_words(files: DataFrame, short: _Templates, long: _Templates | None) -> DataFrame:
    """(path, rank, number, word, tf) of all units that hold a needed word, in one pass over the texts and written to the shared folder.

    Units of rank 1 are sentences, as they stand and unwrapped from the leading block; those of rank 0 the leading block and the whole text.
    """
    low, unit = F.lower("text"), F.lower("unit")
    marked = files.select("path", "text", low.rlike(short.needed).alias("short"), (low.rlike(long.needed) if long else F.lit(False)).alias("long")).where("short OR long")
    opened = marked.withColumn("block", _header_block(F.col("text")))
    sentences = F.when(F.col("short"), F.concat(F.split("text", UNIT_END), _unwrapped(F.col("block"))))
    wholes = F.when(F.col("long"), F.array("block", "text"))

    def ranked(rank: int, found: Column) -> Column:
        return F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda u: F.struct(F.lit(rank).alias("rank"), u.alias("unit")))

    units = opened.select("path", F.inline(F.concat(ranked(1, sentences), ranked(0, wholes))))
    units = units.where((F.col("rank") == 1) & unit.rlike(short.needed) | (F.col("rank") == 0) & (unit.rlike(long.needed) if long else F.lit(False)))
    numbered = units.select("path", "rank", F.monotonically_increasing_id().alias("number"), _tokens(F.col("unit")).alias("words"))
    counted = numbered.select("path", "rank", "number", F.explode("words").alias("word")).groupBy("path", "rank", "number", "word").agg(F.count(F.lit(1)).alias("tf"))
    return saved(counted, "license-words")


def _matches(counted: DataFrame, templates: _Templates, unseen: float, least: float) -> DataFrame:
    """(path, license, score) of the units that reach ``least``; ``counted`` has the words of the telling ones."""
    spark = counted.sparkSession
    weights = spark.createDataFrame(templates.rows, "word string, template int, license string, weight double")
    known = spark.createDataFrame(templates.known, "word string, idf double")
    weighed = counted.join(F.broadcast(known), "word", "left")
    # A word of no template is a dimension of its own at each of its places.
    part = F.when(F.col("idf").isNull(), F.col("tf") * F.lit(unseen * unseen)).otherwise(F.pow(F.col("tf") * F.col("idf"), 2))
    length = weighed.groupBy("path", "number").agg(F.sqrt(F.sum(part)).alias("length"))
    dots = weighed.where("idf is not null").join(F.broadcast(weights), "word").groupBy("path", "number", "template", "license").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    return dots.join(length, ["path", "number"]).select("path", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score")).where(F.col("score") >= least)


def own_licenses(files: DataFrame, templates=TEMPLATES, least: float = LEAST, longer=None) -> DataFrame:
    """(path, license, score) of the files with a licence in their text; ``files`` has path and text."""
    longer = long_templates() if longer is None else longer
    idf, unseen = word_weights(files, [*templates, *longer])
    short = _Templates(templates, idf, unseen, least)
    long = _Templates(longer, idf, unseen, least) if longer else None
    counted = _telling_words(files, short, long)
    scored = _matches(counted.where("rank = 1"), short, unseen, least).withColumn("rank", F.lit(1))
    if long:
        scored = scored.unionByName(_matches(counted.where("rank = 0"), long, unseen, least).withColumn("rank", F.lit(0)))
    best = scored.groupBy("path").agg(F.min(F.struct("rank", (-F.col("score")).alias("minus"), "license")).alias("b"))
    return best.select("path", "b.license", (-F.col("b.minus")).alias("score"))


def folder_of(path: Column) -> Column:
    """The folder part of a path; the root folder is the empty text."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def license_scan(files: DataFrame, templates=TEMPLATES, least: float = LEAST, path: str = "path", text: str = "text", longer=None) -> DataFrame:
    """(path, license, score, source) for every path; ``source`` is own, inherited or none.

    ``templates`` are notices of one sentence, ``longer`` headers and whole texts (those of ``license_texts`` unless given).
    """
    clean = files.select(F.coalesce(F.col(path), F.lit("")).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own_licenses(clean, templates, least, longer)
    name = F.regexp_extract("path", "[^/]*$", 0)
    speaking = own.where(name.rlike(LICENSE_NAME)).groupBy(folder_of(F.col("path")).alias("ancestor")).agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b"))
    # Ancestors of each distinct folder, itself included: every prefix that ends before a slash.
    paths = clean.select("path").distinct()
    folders = paths.select(folder_of(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth"))
    above = above.select("folder", "depth", F.array_join(F.slice(F.split("folder", "/"), 1, F.col("depth")), "/").alias("ancestor"))
    nearest = above.join(speaking, "ancestor").groupBy("folder").agg(F.max(F.struct("depth", "b")).alias("n")).select("folder", F.col("n.b.license").alias("inherited"), (-F.col("n.b.minus")).alias("inherited_score"))
    out = paths.join(own, "path", "left").withColumn("folder", folder_of(F.col("path"))).join(nearest, "folder", "left")
    return out.select(
        "path", F.coalesce("license", "inherited").alias("license"), F.coalesce("score", "inherited_score").alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("source"),
    )
