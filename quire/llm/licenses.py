"""License scans: phrases by position and notices by set-similarity join, with DataFrame functions only.

Base: places where the words of a known phrase stand one after the other. The
method: lines are text blocks, notices are templates, and a block matches a
template when it holds at least THRESHOLD of the template's distinct tokens.
Candidates come from an exact prefix filter: tokens are ordered by how often
they occur in all documents, rarest first, and a matching block must hold one
of the template's first |T| - ceil(t|T|) + 1 tokens (prefix), must have ceil(t|T|)
tokens (length), and enough of the template must be left from the place of its
first shared token (position). Every candidate is then counted exactly.

Defined results: null, empty and wordless texts have no words and no labels;
repeated rows are scanned each; equal lines count as one block.

notice_scan() takes runs of consecutive words as blocks, whatever lines they
stand on: a template of n words matches a run of ceil(n / THRESHOLD) words. It
also knows longer notices, and the variants of Creative Commons by their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Customary short notices of well-known licenses, as words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
)

# The same in full, for notice_scan().
NOTICES = (
    *(t for t in TEMPLATES if t[0] != "cc-by"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation either version 3 of the license or at your "
            "option any later version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met redistributions of source code must retain the above copyright notice "
            "this list of conditions and the following disclaimer"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
            "not distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
)
# Names of the Creative Commons licenses, with their version, as words.
CC = r"(?:^| )(?:cc|creative commons) (by|attribution)( nc| noncommercial| non commercial)?( sa| sharealike| share alike| nd| noderivatives| no derivatives| noderivs)? [1-4] [05](?= |$)"


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(low: Column) -> Column:
    return F.filter(F.split(low, SPLIT), lambda w: w != "")


def phrase_starts(w: Column, phrase: str) -> Column:
    """Positions (from 0) where the phrase's words stand one after the other."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            test = test & (F.get(w, i + k) == p)
        return F.coalesce(test, F.lit(False))

    return F.when(F.array_contains(w, parts[0]), F.filter(F.sequence(F.lit(0), F.size(w) - 1), here)).otherwise(
        F.array().cast("array<int>"))


def token_order(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Occurrences of each template token over all words of all documents."""
    tokens = sorted({t for _, s in templates for t in s.split(" ")})
    rows = docs.select(F.explode(words(lowered(F.col("text")))).alias("w")).where(F.col("w").isin(tokens))
    return {t: 0 for t in tokens} | {r["w"]: r["n"] for r in rows.groupBy("w").agg(F.count("*").alias("n")).collect()}


def plans(order: dict[str, int], templates=TEMPLATES, threshold: float = THRESHOLD) -> list[dict]:
    """Per template: its tokens rarest first, the tokens a match needs, and the prefix."""
    out = []
    for label, text in templates:
        tokens = sorted(set(text.split(" ")), key=lambda t: (order.get(t, 0), t))
        need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
        out.append({"label": label, "tokens": tokens, "need": need, "prefix": tokens[: len(tokens) - need + 1]})
    return out


def containment(plan: dict):
    """Function of a block's distinct tokens: the share of the template's tokens in them, if it reaches the threshold."""
    n, need = len(plan["tokens"]), plan["need"]

    def share(tokens: Column) -> Column:
        # place of the first shared token in the template's order: what is left from there must suffice
        first = F.lit(n)
        for i in range(n - need, -1, -1):
            first = F.when(F.array_contains(tokens, plan["tokens"][i]), i).otherwise(first)
        shared = F.size(F.array_intersect(tokens, F.array(*map(F.lit, plan["tokens"]))))
        return F.when((F.size(tokens) >= need) & (F.lit(n) - first >= need),
                      F.when(shared >= need, shared.cast("double") / n))

    return share


def license_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs` (doc_id, text, ...) plus n_words, n_base, first_word, last_word, base_labels, labels, score."""
    plan = plans(token_order(docs, templates), templates, threshold)
    prefixes = sorted({t for p in plan for t in p["prefix"]})
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    docs = docs.drop(*[c for c in added if c in docs.columns])
    rows = docs.withColumn("_low", lowered(F.col("text"))).withColumn("_w", words(F.col("_low")))
    w = F.col("_w")
    for i, (phrase, _) in enumerate(PHRASES):
        rows = rows.withColumn(f"_p{i}", phrase_starts(w, phrase))
    # blocks: lines of documents that hold a prefix token, as distinct tokens, of those lines that hold one
    anchor = F.array(*map(F.lit, prefixes))
    blocks = F.when(F.arrays_overlap(w, anchor), F.filter(
        F.transform(F.array_distinct(F.split("_low", "\n")), lambda line: F.array_distinct(words(line))),
        lambda t: F.arrays_overlap(t, anchor)))
    rows = rows.withColumn("_b", F.coalesce(blocks, F.array().cast("array<array<string>>")))
    # counted only where there is a block; constants keep the other documents out of the work
    best = [F.when(F.size("_b") > 0, F.array_max(F.transform("_b", containment(p)))) for p in plan]
    rows = rows.withColumn("_c", F.array(*best))
    starts = F.concat(*[F.col(f"_p{i}") for i in range(len(PHRASES))])
    base = F.array_distinct(F.filter(F.array(*[F.when(F.size(f"_p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]),
                                     lambda x: x.isNotNull()))
    found = F.filter(F.transform(F.col("_c"), lambda c, i: F.when(c.isNotNull(), F.get(
        F.array(*[F.lit(p["label"]) for p in plan]), i))), lambda x: x.isNotNull())
    return rows.select(
        *docs.columns, F.size(w).cast("long").alias("n_words"), F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, found))), ",").alias("labels"),
        F.coalesce(F.array_max("_c"), F.lit(0.0)).alias("score"))


def cc_labels(w: Column) -> Column:
    """Labels of the Creative Commons licenses named with a version: cc-by, cc-by-nc, cc-by-nc-sa, ..."""
    line = F.when(F.array_contains(w, "cc") | F.array_contains(w, "creative"), F.array_join(w, " ")).otherwise("")
    part = lambda i: F.regexp_extract_all(line, F.lit(CC), F.lit(i))
    end = lambda x: F.when(x.startswith(" s"), "-sa").when(x.startswith(" n"), "-nd").otherwise("")
    return F.zip_with(part(2), part(3), lambda nc, x: F.concat(F.lit("cc-by"), F.when(nc != "", "-nc").otherwise(""), end(x)))


def run_share(w: Column, text: str, plan: dict, threshold: float) -> Column:
    """Largest share of the template's tokens in a run of words that reaches the threshold, else null."""
    tokens, n, need = F.array(*map(F.lit, plan["tokens"])), len(plan["tokens"]), plan["need"]
    length = math.ceil(len(text.split(" ")) / threshold - 1e-9)
    prefix = F.array(*map(F.lit, plan["prefix"]))
    shared = lambda start, size: F.size(F.array_intersect(F.slice(w, start, size), tokens))
    start = lambda at: F.greatest(at - (length - 1), F.lit(1))
    # a run that matches holds a prefix token; around it there must be enough of the template at all
    at = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: F.array_contains(prefix, F.get(w, i - 1)))
    near = F.filter(at, lambda i: shared(start(i), 2 * length - 1) >= need)
    most = F.array_max(F.transform(near, lambda i: F.array_max(
        F.transform(F.sequence(start(i), i), lambda s: shared(s, length)))))
    return F.when(F.arrays_overlap(w, prefix), F.when(most >= need, most.cast("double") / n))


def notice_scan(docs: DataFrame, templates=NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of `docs` (doc_id, text, ...) plus notice_labels and notice_score, over runs of words across lines."""
    plan = plans(token_order(docs, templates), templates, threshold)
    docs = docs.drop(*[c for c in ("notice_labels", "notice_score") if c in docs.columns])
    rows = docs.withColumn("_w", words(lowered(F.col("text"))))
    w = F.col("_w")
    rows = rows.withColumn("_c", F.array(*[run_share(w, t, p, threshold) for (_, t), p in zip(templates, plan, strict=True)]))
    rows = rows.withColumn("_cc", cc_labels(w))
    found = F.filter(F.transform(F.col("_c"), lambda c, i: F.when(c.isNotNull(), F.get(
        F.array(*[F.lit(p["label"]) for p in plan]), i))), lambda x: x.isNotNull())
    return rows.select(
        *docs.columns, F.array_join(F.array_sort(F.array_distinct(F.concat(found, "_cc"))), ",").alias("notice_labels"),
        F.greatest(F.coalesce(F.array_max("_c"), F.lit(0.0)), F.when(F.size("_cc") > 0, 1.0).otherwise(0.0)).alias("notice_score"))
