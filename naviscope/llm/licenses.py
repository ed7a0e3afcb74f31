"""License scans, in DataFrame functions only: phrases, and an exact set-similarity join.

A text block is a line. A template is found in a block that holds at least CONTAINMENT of its
distinct words. Words are ordered by how often they occur in all texts, rarest first. Of a
template with n words and `need` required, one of the first n - need + 1 must be in the block
(prefix filter), the block must have `need` words (length filter), and from the first shared
word on, both must have `need` words left (positional filter); the rest is counted exactly.

Notices may also be wrapped over lines: for these, every run of a template's length and a
quarter more words is a block, whatever lines it spans, and every template found is returned
unless a closer one covers at least half of the same place.
"""

import math

from pyspark.sql import functions as F

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
CONTAINMENT = 0.8
# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Label and words of each template; a parameter of `scan`.
TEMPLATES = (
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("agpl", "licensed under the gnu affero general public license version"),
    ("apache", "licensed under the apache license version 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights cc0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def words_of(text):
    """Words of a text in lower case (A-Z only); a null text has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.filter(F.split(lowered, SEPARATORS), lambda x: x != "")


def needed(n):
    return math.ceil(CONTAINMENT * n - 1e-9)


def word_ranks(documents, templates):
    """Template words, rarest in the documents first: counted over all texts.

    What reaches the driver is one number per word of the templates.
    """
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    seen = documents.select(F.explode(F.filter(words_of(F.col("text")), lambda x: x.isin(vocabulary))).alias("word"))
    counts = {r["word"]: r["count"] for r in seen.groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def find_templates(blocks, ranked, templates):
    """Array of (label, score): for each block that holds templates, the closest (all of a tie)."""
    rank = {w: i + 1 for i, w in enumerate(ranked)}
    shapes = []
    for label, text in templates:
        ranks = sorted({rank[w] for w in text.split()})
        shapes.append((label, ranks, ranks[: len(ranks) - needed(len(ranks)) + 1], needed(len(ranks))))
    first_words = sorted({ranked[r - 1] for _, _, prefix, _ in shapes for r in prefix})
    shapes = F.array(*[
        F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, ranks)).alias("ranks"), F.array(*map(F.lit, prefix)).alias("prefix"), F.lit(need).alias("need"))
        for label, ranks, prefix, need in shapes
    ])
    order = F.array(*map(F.lit, ranked))

    def of_block(words):
        distinct = F.array_distinct(words)
        known = F.filter(distinct, lambda x: x.isin(ranked))
        ranks = F.sort_array(F.transform(known, lambda x: F.array_position(order, x).cast("int")))
        return F.struct(F.size(distinct).alias("size"), ranks.alias("ranks"))

    def possible(t, b):
        first = F.get(F.array_intersect(t["prefix"], b["ranks"]), 0)
        left = F.least(F.size(t["ranks"]) - F.array_position(t["ranks"], first), b["size"] - F.array_position(b["ranks"], first)) + 1
        return (b["size"] >= t["need"]) & F.coalesce(left >= t["need"], F.lit(False))

    def of_template(t, b):
        both = F.size(F.array_intersect(t["ranks"], b["ranks"]))
        return F.struct(t["label"].alias("label"), F.when(possible(t, b) & (both >= t["need"]), both / F.size(t["ranks"])).alias("score"))

    words = F.filter(F.transform(blocks, words_of), lambda w: F.exists(w, lambda x: x.isin(first_words)))
    found = F.transform(F.transform(words, of_block), lambda b: F.transform(shapes, lambda t: of_template(t, b)))
    closest = F.transform(found, lambda ms: F.filter(ms, lambda m: m["score"] == F.array_max(F.transform(ms, lambda x: x["score"]))))
    return F.flatten(closest), first_words


def find_notices(words, ranked, templates):
    """Array of (label, score, start, stop): templates in runs of words, but for those with a closer match there."""
    rank = {w: i for i, w in enumerate(ranked)}
    shapes, prefixes = [], set()
    for label, text in templates:
        distinct = sorted(set(text.split()), key=rank.get)
        need = needed(len(distinct))
        prefix = distinct[: len(distinct) - need + 1]
        prefixes.update(prefix)
        width = math.ceil(1.25 * len(text.split()))
        shapes.append(F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, distinct)).alias("words"), F.array(*map(F.lit, prefix)).alias("prefix"), F.lit(need).alias("need"), F.lit(width).alias("width")))
    shapes = F.array(*shapes)
    anchors = F.filter(F.transform(words, lambda x, i: F.when(x.isin(sorted(prefixes)), i)), lambda x: x.isNotNull())

    def run(t, start):
        own = F.transform(F.slice(words, start + 1, t["width"]), lambda x, j: F.when(F.array_contains(t["words"], x), start + j))
        places = F.filter(own, lambda x: x.isNotNull())
        n = F.size(F.array_intersect(F.slice(words, start + 1, t["width"]), t["words"]))
        first, last = F.array_min(places), F.array_max(places)
        return F.struct(n.alias("n"), (first - last).alias("short"), first.alias("first"), last.alias("last"))

    def near(t, p):
        start = F.greatest(p - t["width"] + 1, F.lit(0))
        around = F.slice(words, start + 1, p - start + t["width"])
        return F.array_contains(t["prefix"], F.get(words, p)) & (F.size(F.array_intersect(around, t["words"])) >= t["need"])

    def best(t, p):
        runs = F.transform(F.sequence(F.greatest(p - t["width"] + 1, F.lit(0)), p), lambda s: run(t, s))
        top = F.array_max(runs)
        score = F.when(top["n"] >= t["need"], top["n"] / F.size(t["words"]))
        return F.struct(t["label"].alias("label"), score.alias("score"), top["first"].alias("first"), top["last"].alias("last"))

    found = F.flatten(F.transform(anchors, lambda p: F.transform(F.filter(shapes, lambda t: near(t, p)), lambda t: best(t, p))))
    return F.array_distinct(F.filter(found, lambda m: m["score"].isNotNull()))


def closest_notices(found):
    """`found` without what a closer match covers by half or more."""
    def covers(a, m):
        shared = F.least(a["last"], m["last"]) - F.greatest(a["first"], m["first"]) + 1
        return (a["score"] > m["score"]) & (2 * shared >= m["last"] - m["first"] + 1)

    return F.filter(found, lambda m: ~F.exists(found, lambda a: covers(a, m)))


def phrase_places(words, phrase):
    """Places in an array of words where those of a phrase stand consecutively."""
    first, *rest = phrase.split()

    def place(x, i):
        fits = x == first
        for k, w in enumerate(rest):
            fits &= F.get(words, i + k + 1) == w
        return F.when(fits, i)

    return F.filter(F.transform(words, place), lambda x: x.isNotNull())


def scan(documents, templates=TEMPLATES):
    """License labels of every text.

    One row per input row: doc_id (may be null), n_words, places of the base phrases
    (n_base, first_word, last_word), base_labels, labels (those of templates found in lines
    and of notices too), score (1 for a phrase, else the largest containment of either, else 0) and
    n_blocks, the lines' closest templates; notice_labels, notice_score and n_notices are of the notices,
    which may span lines, alone. Null and empty texts have no words; repeated rows are repeated; an
    empty table gives no row; other columns are ignored; the time for a text of many notices grows
    as the square of their number.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranked = word_ranks(documents, templates)
    found, first_words = find_templates(F.split("text", "\n"), ranked, templates)
    rows = documents.withColumn("_words", words_of(F.col("text")))
    words = F.col("_words")
    places, labels = [phrase_places(words, p) for p in PHRASES], list(PHRASES.values())
    starts = sorted({p.split()[0] for p in PHRASES})
    none = F.array().cast("array<array<int>>")
    rows = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.when(F.exists(words, lambda x: x.isin(starts)), F.array(*places)).otherwise(none).alias("_places"),
        find_notices(words, ranked, templates).alias("_near"),
        F.when(F.exists(words, lambda x: x.isin(first_words)), found).alias("_found"),
    )
    named = F.array(*map(F.lit, labels))
    base = F.filter(F.transform("_places", lambda p, i: F.when(F.size(p) > 0, F.get(named, i))), lambda x: x.isNotNull())
    rows = rows.withColumn("_all", F.flatten("_places")).withColumn("_base", base).withColumn("_found", F.coalesce("_found", F.array().cast("array<struct<label:string,score:double>>")))
    rows = rows.withColumn("_notices", closest_notices(F.col("_near")))
    joined = lambda x: F.array_join(F.sort_array(F.array_distinct(x)), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_all").cast("long").alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"),
        F.array_max("_all").cast("long").alias("last_word"),
        joined(F.col("_base")).alias("base_labels"),
        joined(F.concat("_base", F.transform("_found", lambda m: m["label"]), F.transform("_notices", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("_all") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.concat(*[F.transform(x, lambda m: m["score"]) for x in ("_found", "_notices")])), F.lit(0.0))).alias("score"),
        F.size("_found").cast("long").alias("n_blocks"),
        joined(F.transform("_notices", lambda m: m["label"])).alias("notice_labels"),
        F.coalesce(F.array_max(F.transform("_notices", lambda m: m["score"])), F.lit(0.0)).alias("notice_score"),
        F.size("_notices").cast("long").alias("n_notices"),
    )
