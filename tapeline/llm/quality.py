"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

A rule is a name and a condition that says when a document fails, over measures of its text. Selectivity
and cost of every rule are estimated on a sample: what share of the documents that all rules before it
let pass it rejects, and how many characters it goes through for that. Of the rules left the one
with the most rejections per character comes next; a document that fails one is tried by no further
rule. The order decides what is spent, and which of several failed rules is named, never which documents
are kept.

The measures that the result names are made for every document, whatever its verdict, so rules over
them cost a comparison. A measure in `LATE` is made inside the branch of the rule that asks for it: a
document that was rejected before never pays for it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import SPACE, hashed_sample, sealed, split_words, whole_text

WINDOW = 8
SAMPLE_ROWS = 500

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Conditions under which a document fails, over the measures and the text. The first two are the
# base; the others are the cascade's own.
BASE_RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
}
OWN_RULES = {
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 25 * n_words",
    "capitals": "2 * n_capitals > word_chars",
}
RULES = {**BASE_RULES, **OWN_RULES}

# Measures that wait until a rule needs them, each one pass over the text.
LATE = {"n_capitals": "length(regexp_replace(_text, '[^A-Z]+', ''))"}


def _repeat_words(words: str) -> dict[str, Column]:
    """Steps to the number of words in windows of eight words that occur twice or more.

    Windows are hashed by doubling (pairs, fours, eights). Only texts with a repeated hash are
    sorted; of those, each repeated window covers the words up to the next one, eight at most.
    """
    return {
        "_h1": F.transform(words, lambda w: F.xxhash64(w)),
        "_h2": F.expr("transform(_h1, (h, i) -> xxhash64(h, get(_h1, i + 1)))"),
        "_h4": F.expr("transform(_h2, (h, i) -> xxhash64(h, get(_h2, i + 2)))"),
        "_h8": F.expr(
            f"""CASE WHEN size({words}) < {WINDOW} THEN array(0L)
                ELSE slice(transform(_h4, (h, i) -> xxhash64(h, get(_h4, i + 4))),
                           1, size({words}) - {WINDOW - 1}) END"""
        ),
        "_sorted": F.expr(
            """CASE WHEN size(array_distinct(_h8)) < size(_h8)
                    THEN sort_array(transform(_h8, (h, i) -> struct(h AS h, i AS i))) END"""
        ),
        "_starts": F.expr(
            """sort_array(transform(
                   filter(_sorted, (s, i) -> s.h <=> get(_sorted, i - 1).h
                                          OR s.h <=> get(_sorted, i + 1).h),
                   s -> s.i))"""
        ),
        "n_repeat_words": F.expr(
            f"""coalesce(aggregate(
                    transform(_starts, (p, i) -> least(coalesce(get(_starts, i + 1) - p, {WINDOW}),
                                                       {WINDOW})),
                    0L, (total, n) -> total + n), 0L)"""
        ),
    }


def text_measures(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The measures of every whole text, next to the columns in `keep`; null counts as empty.

    Gives n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines, n_repeat_words, all bigint, and the text as `_text`, for the measures that wait.
    Repeated rows are measured each by itself, other columns are not read.
    """
    rows = docs.select(*keep, whole_text(text).alias("_text"))
    steps = {
        "_words": split_words(F.col("_text")),
        "_lines": F.expr(r"filter(split(_text, '\n'), l -> l RLIKE '[^\\x20\\x09-\\x0D]')"),
        **_repeat_words("_words"),
    }
    for name, step in steps.items():
        rows = rows.withColumn(name, step)
    def kept(pattern: str) -> Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("bigint")

    measures = F.struct(
        F.size("_words").cast("bigint").alias("n_words"),
        kept(SPACE).alias("word_chars"),
        kept("[^#*$%&|<>]+").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
    )
    return rows.select(*keep, "_text", sealed(measures)).select(*keep, "_text", "_sealed.*")


def _condition(rule: str) -> Column:
    """A rule's condition, with the measures that wait in their place. Null is no failure."""
    for name, measure in LATE.items():
        rule = re.sub(rf"\b{name}\b", lambda _, m=measure: f"({m})", rule)
    return F.coalesce(F.expr(rule), F.lit(False))


def _passes(rule: str) -> int:
    """How often a rule goes through the text."""
    return sum(bool(re.search(rf"\b{name}\b", rule)) for name in LATE)


def rule_order(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    rules: Mapping[str, str] = RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> list[str]:
    """Names of the rules, those with most rejections per cost among the documents left first.

    The sample is chosen by a hash of the id. It is counted by the set of rules that a document fails, and
    those counts, at most one per set, are what comes to the driver. A rule costs one comparison and
    the mean length of a text for each pass it makes. Ties, and an empty table, give the order in which the
    rules stand; the same table gives the same order.
    """
    sample = hashed_sample(docs.select(id_column, text), F.col(id_column), sample_rows, docs.count())
    failed = text_measures(sample, text).select(
        F.length("_text").alias("chars"), *[_condition(rule).alias(name) for name, rule in rules.items()]
    )
    sets = failed.groupBy(*rules).agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")).collect()
    chars = sum(r["chars"] for r in sets) / max(sum(r["n"] for r in sets), 1)
    cost = {name: 1 + _passes(rule) * chars for name, rule in rules.items()}
    order: list[str] = []
    while len(order) < len(rules):
        left = [r for r in sets if not any(r[name] for name in order)]
        rate = {n: sum(r["n"] for r in left if r[n]) / cost[n] for n in rules if n not in order}
        order.append(max(rate, key=lambda name: rate[name]))
    return order


def cascade(order: Sequence[str], rules: Mapping[str, str] = RULES) -> Column:
    """Name of the first failed rule in the given order, or null; later rules are not tried."""
    verdict = F
    for name in order:
        verdict = verdict.when(_condition(rules[name]), F.lit(name))
    return verdict.otherwise(F.lit(None).cast("string"))


def quality_verdicts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Measures, `base_failed`, `kept` and `rejected_by` (null if kept) for every document."""
    measured = text_measures(docs, keep=[id_column])
    order = rule_order(docs, id_column)
    base = " OR ".join(f"({condition})" for condition in BASE_RULES.values())
    return (
        measured.withColumn("base_failed", F.expr(base))
        .withColumn("rejected_by", cascade(order))
        .drop("_text")
        .withColumn("kept", F.col("rejected_by").isNull())
    )
