"""Licence scan: which text blocks contain the words of a licence template.

An exact set-similarity join by containment, |T and B| >= 0.8 |T| for a template T and a block B.
Blocks are runs of consecutive words: every text is cut into half-overlapping runs, at a width of at
least twice the template's, so a template of that many words lies whole in one of them.

* Tokens are ordered by the number of documents that have them, rarest first.
* Prefix: a block that meets the threshold has one of the first |T| - a + 1 tokens of T, a being the
  least overlap. Blocks without any of them are not looked at.
* Length: a block with fewer than `a` tokens of the templates cannot meet it.
* Position: from their first shared token on, both sides must have `a` tokens left.

Candidates are then verified on their whole sets. The templates are a fixed list, so all that is
sent to every task is bounded by it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import KEY, content_key, split_words, whole_text

THRESHOLD = 0.8

# Phrases whose places are counted, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Sentences that stand in published licences and in notices that refer to them, with labels.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files",
    "apache": "licensed under the apache license version 2 0 you may not use this file except in "
    "compliance with the license",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "cc": "licensed under cc by 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or "
    "neighboring rights to this work",
}

# Complement of the word characters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _OTHER = "K", "�"


def lower_words(text: Column) -> Column:
    """Words of a text with A to Z in lower case; words with other letters may change in them.

    All that is compared is ASCII. Only the Kelvin sign has an ASCII letter as its lower case, so
    it is replaced by another character first.
    """
    return split_words(F.lower(F.replace(text, F.lit(_KELVIN), F.lit(_OTHER))), _BETWEEN)


def block_width(template: str) -> int:
    """Least power of two that is twice the template's length in words, or more."""
    return 2 ** math.ceil(math.log2(2 * len(template.split())))


def _places(phrase: str) -> str:
    """Starts of a phrase in `_words`, as SQL."""
    *before, last = phrase.split()
    k = len(before)
    same = [f"w = '{last}'"] + [f"get(_words, i - {k - j}) = '{w}'" for j, w in enumerate(before)]
    return f"""filter(transform(_words, (w, i) ->
        CASE WHEN {" AND ".join(same)} THEN i - {k} END), p -> p IS NOT NULL)"""


def phrase_places(docs: DataFrame, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Adds n_base, first_word, last_word and `_base` (labels) to rows with `_text` and `_words`."""
    ends = "|".join(sorted({phrase.split()[-1] for phrase in phrases}))
    none = "array_repeat(0, 0)"
    rows = docs.withColumn("_near", F.expr(f"_text RLIKE '(?i){ends}'"))
    for j, phrase in enumerate(phrases):
        found = f"CASE WHEN _near THEN {_places(phrase)} ELSE {none} END"
        rows = rows.withColumn(f"_at{j}", F.expr(found))
    every = F.concat(*[F.col(f"_at{j}") for j in range(len(phrases))])
    labels = [
        F.when(F.size(f"_at{j}") > 0, F.lit(label)) for j, label in enumerate(phrases.values())
    ]
    return (
        rows.withColumn("_all", every)
        .withColumn("n_base", F.size("_all").cast("bigint"))
        .withColumn("first_word", F.array_min("_all").cast("bigint"))
        .withColumn("last_word", F.array_max("_all").cast("bigint"))
        .withColumn("_base", F.array_distinct(F.array_compact(F.array(*labels))))
    )


def template_matches(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Blocks that meet the threshold: key of the text, `label`, `start` word, `containment`.

    `docs` has `_text` and `_words`. Equal texts have equal keys and are to be joined back by it.
    """
    spark = docs.sparkSession
    sets = {label: set(template.split()) for label, template in templates.items()}
    vocabulary = sorted(set().union(*sets.values()))
    known = F.array(*[F.lit(w) for w in vocabulary])
    # One row per word of the templates.
    counted = (
        docs.select(F.explode(F.array_intersect("_words", known)).alias("word"))
        .groupBy("word")
        .count()
        .collect()
    )
    seen = {row["word"]: row["count"] for row in counted}
    order = sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    prefixes, whole = [], []
    for label, words in sets.items():
        least = math.ceil(threshold * len(words) - 1e-9)
        ranks = sorted(rank[w] for w in words)
        width = block_width(templates[label])
        whole.append((label, ranks))
        for i, r in enumerate(ranks[: len(ranks) - least + 1]):
            prefixes.append((r, width, label, i, len(ranks), least))
    prefix = spark.createDataFrame(
        prefixes, "rank int, width int, label string, i int, n int, least int"
    )
    whole = spark.createDataFrame(whole, "label string, ranks array<int>")
    rare = F.array(*[F.lit(order[r]) for r in sorted({p[0] for p in prefixes})])
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    fewest = min(p[5] for p in prefixes)

    near = docs.select(*content_key(F.col("_text")), "_words").where(
        F.arrays_overlap("_words", rare)
    )
    near = near.withColumn("_ranks", ranks)
    widths = sorted({p[1] for p in prefixes})
    blocks = near.select(*KEY, "_words", "_ranks", F.explode(F.lit(widths)).alias("width"))
    blocks = blocks.withColumn(
        "start",
        F.expr("explode(sequence(0, greatest(size(_words) - width div 2, 0), width div 2))"),
    ).select(
        *KEY,
        "width",
        "start",
        F.array_sort(
            F.transform(
                F.array_intersect(F.expr("slice(_words, start + 1, width)"), known),
                lambda w: F.col("_ranks")[w],
            )
        ).alias("ranks"),
    )
    blocks = blocks.where(F.size("ranks") >= fewest).select(
        *KEY, "width", "start", "ranks", F.posexplode("ranks").alias("j", "rank")
    )
    left = F.least(F.col("n") - F.col("i"), F.size("ranks") - F.col("j"))
    candidates = (
        blocks.join(F.broadcast(prefix), ["rank", "width"])
        .where((F.size("ranks") >= F.col("least")) & (left >= F.col("least")))
        .join(F.broadcast(whole.withColumnRenamed("ranks", "template")), "label")
    )
    shared = F.size(F.array_intersect("ranks", "template"))
    return (
        candidates.where(shared >= F.col("least"))
        .select(*KEY, "label", "start", (shared / F.col("n")).alias("containment"))
        .distinct()
    )


def license_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: places of the phrases, labels of phrases and templates, score.

    Columns: id, n_words, n_base, first_word, last_word, base_labels, labels, score. The score is 1
    for a document with a phrase, else the highest containment of a template found, else 0. Null
    texts count as empty; equal texts get equal results; a null id stays null; other columns are not
    read.
    """
    rows = docs.select(F.col(id_column), whole_text(text).alias("_text")).withColumn(
        "_words", lower_words(F.col("_text"))
    )
    found = (
        template_matches(rows)
        .groupBy(*KEY)
        .agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    )
    based = phrase_places(rows).select(
        id_column,
        F.size("_words").cast("bigint").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        "_base",
        *content_key(F.col("_text")),
    )
    every = F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    return based.join(found, KEY, "left").select(
        id_column,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
