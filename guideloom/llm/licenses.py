"""License scans: phrases, and an exact set-similarity join of text blocks with notice templates.

Native throughout. Words are lower-cased; a block is a window of words that starts at a
word of some template, so that no notice is missed by its place: the first template word of
any other window starts a block that holds as many. A block meets a template if it holds at least the threshold's share of the
template's distinct words. The words of all templates are ordered by their count in the
whole corpus, rarest first, and three filters find all such blocks: a block must hold one
of the template's rarest words (prefix), enough words of any template (length), and enough
of both sides' words from the place of the first shared one on (position). What passes is
compared exactly.

The text is read twice, for the counts and for the blocks, and never shuffled: only words
of templates leave the scan, with their places, in documents that hold a rare one.

Defined cases: null or empty texts have no words, labels or places, and score 0; repeated
rows give equal rows; a document of any length is searched whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import LOWER, UPPER, staged

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD, WINDOW = 0.8, 64

#: Label and notice. A notice of few words would also be met by those of its sister licenses (CC BY 4.0 stands whole in CC BY-NC 4.0).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
]


def words_of(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(UPPER, LOWER))) if w]


def padded(text: Column) -> Column:
    """The words in lower case, each between two blanks."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, NOT_WORD, " ")), F.lit(" "))


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def phrase_places(text: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, first word, last word) of a phrase in a padded text; overlapping places count."""
    inside = F.lit(f" {phrase} ")
    found = F.contains(text, inside)
    first = F.instr(text, f" {phrase} ")
    last = F.length(text) - F.instr(F.reverse(text), f" {phrase} "[::-1]) - len(phrase)
    count = F.regexp_count(text, F.lit(f" (?={re.escape(phrase)} )")).cast("long")
    return F.when(found, count).otherwise(0), F.when(found, _blanks(F.substring(text, F.lit(1), first)) - 1), F.when(found, _blanks(F.substring(text, F.lit(1), last)) - 1)


def corpus_counts(texts: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often each word of the templates stands in the padded texts. As many rows as the templates have words."""
    rows = texts.select(F.explode(F.split("padded", " ")).alias("word")).filter(F.col("word").isin(*vocabulary)).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in rows}


def license_scan(docs: DataFrame, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, window: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score. phrases: (phrase in lower case, label). window: words of a block; as it is, WINDOW or twice the longest template."""
    spark = docs.sparkSession
    longest = max((len(words_of(text)) for _, text in templates), default=0)
    window = window or max(WINDOW, 2 * longest)
    if window < longest:
        raise ValueError(f"a window of {window} words cannot hold a template of {longest}")
    sets = [(label, set(words_of(text))) for label, text in templates]
    texts = docs.select(F.col(id_col).alias("doc_id"), padded(F.col(text_col)).alias("padded"))
    counts = corpus_counts(texts, sorted(set().union(*[s for _, s in sets])))
    order = sorted(counts, key=lambda w: (counts[w], w))
    rank = {w: k for k, w in enumerate(order)}
    ranked = [(t, label, sorted(s, key=rank.get), math.ceil(threshold * len(s) - 1e-9)) for t, (label, s) in enumerate(sets)]
    prefixes = [(w, t, i, len(words), need) for t, _, words, need in ranked for i, w in enumerate(words[: len(words) - need + 1])]

    text = F.col("padded")
    places = [phrase_places(text, p) for p, _ in phrases]
    least = lambda cols: F.array_min(F.array(*cols))
    n_words = F.when(F.length(text) > 2, _blanks(text) - 1).otherwise(F.lit(0).cast("long"))
    base = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(n > 0, F.lit(label)) for (n, _, _), (_, label) in zip(places, phrases, strict=True)]), lambda x: x.isNotNull())))
    rare = sorted({p[0] for p in prefixes})
    words = F.split(F.trim(text), " ")
    marked = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: x["word"].isin(*order))
    has_rare = F.exists(words, lambda w: w.isin(*rare))
    rows = texts.select("doc_id", n_words.alias("n_words"), sum((n for n, _, _ in places), F.lit(0)).cast("long").alias("n_base"), least([f for _, f, _ in places]).alias("first_word"), F.array_max(F.array(*[z for _, _, z in places])).alias("last_word"), base.alias("base"), F.when(has_rare, marked).alias("marked"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "license-rows")

    prefix = F.broadcast(spark.createDataFrame(prefixes, "word string, template int, i int, of int, need int"))
    whole = F.broadcast(spark.createDataFrame([(t, label, ws) for t, label, ws, _ in ranked], "template int, label string, words array<string>"))
    onward = Window.partitionBy("row").orderBy("at").rangeBetween(0, window - 1)
    held = rows.filter("marked is not null").select("row", F.inline("marked")).select("row", F.collect_set("word").over(onward).alias("held"))
    held = held.filter((F.size("held") >= min((need for *_, need in ranked), default=0)) & F.exists("held", lambda w: w.isin(*rare)))
    block = held.select("row", F.array_intersect(F.array(*map(F.lit, order)), "held").alias("tokens")).distinct()
    token = block.select("row", "tokens", F.posexplode("tokens").alias("j", "word")).join(prefix, "word")
    size = F.size("tokens")
    candidates = token.filter((size >= F.col("need")) & (1 + F.least(F.col("of") - F.col("i") - 1, size - F.col("j") - 1) >= F.col("need"))).select("row", "tokens", "template", "need").distinct()
    share = F.size(F.array_intersect("tokens", "words"))
    met = candidates.join(whole, "template").filter(share >= F.col("need")).select("row", "label", (share / F.size("words")).alias("share"))
    found = met.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    out = rows.drop("marked").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.round(score, 6).alias("score"))
