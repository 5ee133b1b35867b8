"""License notices by an exact set-similarity join, with DataFrame operations only.

Blocks are the lines of a text, as sets of words, and, as notices stand wrapped, its runs of words across lines: for each
template the runs as long as its text and RUN_SLACK words more. Templates are notices, as sets of words too. A block
matches a template when it holds at least `threshold` of the template's words. All words of templates are ordered by how many
documents hold them, rarest first. A block that matches must hold one of a template's first t - o + 1 words (t words,
o needed): the prefix filter. It needs o words at all (length filter), and counted from the pair's first common word
on, the template and the block must each have o words left (positional filter). What passes is counted exactly.
A line and a template are found once, through their first common prefix word, so nothing is grouped or shuffled for it.
Runs are found around each prefix word of a text that has several lines: the words that a run with it can reach are cut
out, and only if these hold o of the template's words are its runs counted one by one.

Templates come from a fixed list, so what is collected (a count per template word) and broadcast is bounded by it.

Null and empty texts have no words, no labels and score 0; repeated rows get equal results each; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that name a license wherever their words stand in a row.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
# Notices of licenses.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.9
RUN_SLACK = 4  # words that may stand within a wrapped notice beside its own
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _spaced(text: Column) -> Column:
    """The words of a text, one blank between them."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.trim(F.regexp_replace(lower, _GAP, " "))


def _words(spaced: Column) -> Column:
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _literal(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def base_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words, n_words, n_base, first_word, last_word, base_list) of (doc_id, text).

    A blank on each side of every word keeps phrases that stand side by side apart.
    """
    rows = docs.select("doc_id", "text", _spaced(F.col("text")).alias("spaced"))
    rows = rows.withColumn("words", _words(F.col("spaced")))
    padded = F.concat(F.lit(" "), F.replace("spaced", F.lit(" "), F.lit("  ")), F.lit(" "))
    any_phrase = F.lit(False)
    for phrase in PHRASES.values():
        any_phrase |= F.col("spaced").contains(phrase)
    rows = rows.withColumn("padded", F.when(any_phrase, padded))

    def count(text: Column) -> Column:  # words of a text with blanks on both sides of each
        return ((F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("long")

    counts, firsts, lasts, labels = [], [], [], []
    for label, phrase in sorted(PHRASES.items()):
        mark = " " + phrase.replace(" ", "  ") + " "
        found = F.col("padded").contains(mark)
        without = F.replace("padded", F.lit(mark), F.lit(""))
        times = ((F.length("padded") - F.length(without)) / len(mark)).cast("long")
        counts.append(F.when(found, times).otherwise(F.lit(0).cast("long")))
        firsts.append(F.when(found, count(F.substring_index("padded", mark, 1))))
        after = count(F.substring_index("padded", mark, -1))
        lasts.append(F.when(found, F.size("words") - after - len(phrase.split())).cast("long"))
        labels.append(F.when(found, F.lit(label)))
    return rows.select(
        "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        sum(counts[1:], counts[0]).alias("n_base"),
        F.array_min(F.array(*firsts)).alias("first_word"), F.array_max(F.array(*lasts)).alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base_list"),
    )


def word_order(scan: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest in the documents first."""
    held = scan.select(F.explode(F.array_intersect(_literal(vocabulary), "words")).alias("word"))
    n = {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def matches(
    scan: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, text_key, label, containment) of every block and template that match."""
    spark = scan.sparkSession
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    order = word_order(scan, sorted({w for _, words in sets for w in words}))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, (label, words) in enumerate(sets):
        words = sorted(words, key=rank.__getitem__)
        needed = math.ceil(threshold * len(words) - 1e-9)
        for place, word in enumerate(words[: len(words) - needed + 1]):
            index.append((word, len(templates[number][1].split()) + RUN_SLACK, label, place, needed, " ".join(words)))
    listed = F.from_json(
        F.lit("[" + ",".join(
            f'{{"word":"{w}","run":{n},"label":"{label}","place":{p},"needed":{o},"template":"{t}"}}'
            for w, n, label, p, o, t in index
        ) + "]"),
        "array<struct<word string, run int, label string, place int, needed int, template string>>",
    )
    prefixes = spark.range(1).select(F.inline(listed))
    probes = sorted({w for w, *_ in index})
    lines = (
        scan.filter(F.arrays_overlap("words", _literal(probes)))
        .select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", r"\n")).alias("line", "t"))
        .select("doc_id", "text_key", "line", F.array_distinct(_words(_spaced(F.col("t")))).alias("held"))
        .filter(F.arrays_overlap("held", _literal(probes)))
        .withColumn("known", F.array_intersect(_literal(order), "held"))  # in the order of the vocabulary
        .withColumn("word", F.explode(F.array_intersect("known", _literal(probes))))
    )
    pairs = lines.join(F.broadcast(prefixes), "word").withColumn("template", F.split("template", " "))
    block_left = F.size("known") - F.array_position("known", F.col("word")) + 1
    template_left = F.size("template") - F.col("place")
    passed = pairs.filter(
        (F.size("held") >= F.col("needed"))
        & (template_left >= F.col("needed"))
        & (block_left >= F.col("needed"))
        & ~F.arrays_overlap(F.slice("template", F.lit(1), F.col("place")), "held")  # found by an earlier word
    )
    common = F.size(F.array_intersect("template", "held"))
    in_lines = passed.withColumn("common", common)
    in_runs = _run_pairs(scan, prefixes, probes, max((n for _, n, *_ in index), default=1))
    found = in_lines.select("doc_id", "text_key", "label", "template", "needed", "common").unionByName(in_runs)
    return found.filter(F.col("common") >= F.col("needed")).select(
        "doc_id", "text_key", "label", (F.col("common") / F.size("template")).alias("containment")
    )


def _run_pairs(scan: DataFrame, prefixes: DataFrame, probes: list[str], longest: int) -> DataFrame:
    """(doc_id, text_key, label, template, needed, common) of the words around a prefix word and its templates; common:
    the most that a run holds. Only texts of several lines: a run within a line holds no more than the line."""
    reach = longest - 1
    several = F.col("text").contains("\n") & F.arrays_overlap("words", _literal(probes))
    marked = F.transform("words", lambda w, i: F.when(w.isin(probes), F.struct(w.alias("word"), i.alias("at"))))
    around = F.transform(F.array_compact(marked), lambda x: F.struct(
        x["word"].alias("word"),
        F.least(x["at"], F.lit(reach)).alias("before"),
        F.slice("words", F.greatest(x["at"] - reach, F.lit(0)) + 1, F.least(x["at"], F.lit(reach)) + longest).alias("near"),
    ))
    hits = scan.filter(several).select("doc_id", F.xxhash64("text").alias("text_key"), F.inline(around))
    pairs = hits.join(F.broadcast(prefixes), "word").withColumn("template", F.split("template", " "))
    before = F.least(F.col("before"), F.col("run") - 1)
    near = F.slice("near", F.col("before") - before + 1, before + F.col("run"))
    held = F.size(F.array_intersect("template", "near"))
    passed = pairs.withColumn("near", near).filter(held >= F.col("needed"))
    common = F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("run") + 1, F.lit(1))),
        lambda at: F.size(F.array_intersect("template", F.slice("near", at, F.col("run")))),
    ))
    return passed.select("doc_id", "text_key", "label", "template", "needed", common.alias("common"))


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Words, phrases, labels and score of every row of (doc_id, text); score: the best containment, 1 for a phrase."""
    scan = base_scan(docs)
    found = (
        matches(scan, threshold=threshold)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("label").alias("own"), F.max("containment").alias("best"))
    )
    rows = scan.select(
        "doc_id", F.xxhash64("text").alias("text_key"), "n_words", "n_base", "first_word", "last_word", "base_list"
    )
    same = F.expr("a.doc_id <=> b.doc_id and a.text_key = b.text_key")
    labels = F.array_sort(F.array_union("base_list", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return rows.alias("a").join(found.alias("b"), same, "left").select(
        "a.doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_list", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )
