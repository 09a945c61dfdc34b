"""Licence scan, quality cascade and line dedup on small tables."""

import pytest
from llm_helpers import frame, odd_documents, rows_of, words
from pyspark.sql import functions as F

from tapeline.llm.license import TEMPLATES, license_scan
from tapeline.llm.line_dedup import dedup_lines
from tapeline.llm.quality import (
    LATE,
    MEASURES,
    RULES,
    cascade,
    quality_verdicts,
    rule_order,
    text_measures,
)


def test_license_phrases_and_templates(spark):
    rows = [
        (1, "Under the MIT License. mit-license, MIT_LICENSE"),
        (2, "filler " * 500 + TEMPLATES["bsd"].upper() + " filler" * 500),
        (3, " ".join(TEMPLATES["mpl"].split()[:8]) + " filler" * 50),
        (4, "GNU General Public License; Apache License"),
        (5, "MIT Licenſe mit licenKe"),
    ]
    got = {r["doc_id"]: r for r in license_scan(frame(spark, rows)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == (3, 2, 6)
    assert got[1]["base_labels"] == "mit" and got[1]["score"] == 1.0
    assert got[2]["labels"] == "bsd" and got[2]["n_base"] == 0 and got[2]["score"] == 1.0
    assert got[3]["labels"] == "" and got[3]["score"] == 0.0
    assert got[4]["base_labels"] == "apache,gpl" and "gpl" in got[4]["labels"]
    assert got[5]["n_base"] == 0


def test_license_partial_template_keeps_its_containment(spark):
    kept = TEMPLATES["mit"].split()
    text = " ".join(w for w in kept if w not in ("files", "hereby"))
    (row,) = license_scan(frame(spark, [(1, text)])).collect()
    n = len(set(kept))
    assert row["labels"] == "mit" and row["score"] == (n - 2) / n


def test_license_odd_rows(spark):
    docs = frame(spark, odd_documents(), clashing=True)
    got = license_scan(docs)
    assert got.count() == docs.count()
    assert {r["n_words"] for r in got.where("doc_id <= 3").collect()} == {0}
    assert license_scan(docs.limit(0)).collect() == []


def plain_measures(text):
    text = text or ""
    w = words(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {i + d for places in seen.values() if len(places) > 1 for i in places for d in range(8)}
    lines = [line for line in text.split("\n") if words(line)]
    return (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_measures(spark):
    rows = odd_documents() + [
        (20, "a b c d e f g h " * 30),
        (21, "a b a b a b a b a b a"),
        (22, "# ## ### | & < > $ % *\n# ## ###\n# ## ###\n\n\n \n"),
        (23, " ".join(f"u{i}" for i in range(40)) + " " + " ".join(f"u{i}" for i in range(40))),
        (24, "x y z " * 5 + "tail"),
    ]
    docs = frame(spark, [(i, r[1]) for i, r in enumerate(rows)], clashing=True)
    got = rows_of(quality_verdicts(docs), "doc_id", *MEASURES)
    assert got == sorted(((i, *plain_measures(r[1])) for i, r in enumerate(rows)), key=repr)


def test_quality_order_changes_no_verdict(spark):
    docs = frame(spark, [(i, f"word{i} " * (i % 40) + "#" * (i % 7)) for i in range(200)])
    assert sorted(rule_order(docs)) == sorted(RULES)
    verdicts = quality_verdicts(docs)
    failed = " OR ".join(f"({r})" for r in RULES.values())
    measured = text_measures(docs, keep=["doc_id"]).withColumn("n_capitals", F.expr(LATE["n_capitals"]))
    plain = measured.selectExpr("doc_id", f"NOT ({failed}) AS kept")
    assert rows_of(verdicts, "doc_id", "kept") == rows_of(plain, "doc_id", "kept")
    assert verdicts.where("kept <> isnull(rejected_by) OR (base_failed AND kept)").count() == 0
    assert quality_verdicts(docs.limit(0)).collect() == []


def test_quality_rules_in_order_of_rejections_per_cost(spark):
    """Few words reject most; symbols reject more than capitals do, but only what few words reject as well."""
    rows = [(i, "short # # # #") for i in range(60)]
    rows += [(100 + i, "CAPITALS " * 30) for i in range(8)]
    rows += [(200 + i, " ".join(f"{'w' * (j % 5 + 1)}{j}" for j in range(40 + i))) for i in range(30)]
    docs = frame(spark, rows)
    rules = {
        "capitals": "2 * n_capitals > word_chars", "symbols": "4 * n_symbols > n_words",
        "few_words": "n_words < 20", "never": "n_words < 0",
    }
    order = rule_order(docs, rules=rules)
    # Symbols and few words reject the same documents for the same cost: the one that stands first.
    assert order == ["symbols", "capitals", "few_words", "never"]
    assert all(rule_order(docs.repartition(n), rules=rules) == order for n in (1, 5, 9))
    assert rule_order(docs.limit(0), rules=rules) == list(rules)


def test_quality_measures_that_wait_are_not_made_for_rejected_documents(spark, monkeypatch):
    """A measure that fails when it is made for a document with few words: only the order decides."""
    made = "CASE WHEN size(split(_text, ' ')) < 20 THEN raise_error('made') ELSE length(_text) END"
    monkeypatch.setitem(LATE, "n_capitals", made)
    docs = frame(spark, [(i, "word " * (5 if i % 3 else 50)) for i in range(60)])
    measured = text_measures(docs, keep=["doc_id"])
    rules = {"few_words": "n_words < 20", "capitals": "n_capitals < 0"}
    found = measured.withColumn("by", cascade(["few_words", "capitals"], rules)).groupBy("by").count().collect()
    assert {r["by"]: r["count"] for r in found} == {"few_words": 40, None: 20}
    with pytest.raises(Exception, match="made"):
        measured.withColumn("by", cascade(["capitals", "few_words"], rules)).groupBy("by").count().collect()


def plain_dedup(rows):
    """Lines by order of id; rows without an id last and one document."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first, result = {}, [None] * len(rows)
    for i in order:
        doc_id, text = rows[i][:2]
        lines = (text or "").split("\n")
        full = [j for j, line in enumerate(lines) if words(line)]
        trimmed = [lines[j].strip(" \t\n\x0b\f\r") for j in full]
        covered, own = set(), set()
        for k in range(len(full) - 2):
            window = tuple(trimmed[k : k + 3])
            if first.setdefault(window, doc_id) != doc_id or window in own:
                covered |= {k, k + 1, k + 2}
            own.add(window)
        gone = {full[k] for k in covered}
        for k in covered:
            if k + 1 in covered:
                gone |= set(range(full[k], full[k + 1]))
        kept = "\n".join(line for j, line in enumerate(lines) if j not in gone)
        result[i] = (doc_id, text if not covered else kept, len(full), len(covered))
    return sorted(result, key=repr)


def test_line_dedup_against_plain_loop(spark):
    rows = [r[:2] for r in odd_documents()] + [
        (30, "p\nq\nr\ns\nt"), (31, "x\nq\n\nr\n s \ny"), (32, "q\nr"), (33, "q\nr\ns"),
        (34, "k\nl\nm\nk\nl\nm\nk\nl\nm"), (35, "a\nb\nc\nd\ne\nf"), (36, "b\nc\nd\nz\nd\ne\nf"),
        (37, "a\r\nb\r\nc\r\n"), (38, "\n\n\n"),
    ]
    got = rows_of(dedup_lines(frame(spark, rows)), "doc_id", "text", "n_lines", "n_removed")
    assert got == plain_dedup(rows)


def test_line_dedup_keeps_columns(spark):
    docs = frame(spark, odd_documents(), clashing=True)
    got = dedup_lines(docs, counts=False)
    assert got.schema == docs.schema
    assert got.where("n_chars <> length(text)").count() == 0
    assert dedup_lines(docs.limit(0)).collect() == []
