"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeline.llm import (
    bpe,
    classifier,
    html,
    jaccard,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    spelling,
    token_files,
    toxicity,
    vectors,
)
from tapeline.llm import license as licenses

# Tokenizer files have to lie at the same place on every executor.
BYTE_BPE, END_ID = public_tokenizers.path("byte_bpe_50k.json"), 2
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        "doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot", "n_slots",
    ]
    return mixing.mix_shares(_documents(spark, sf_dir)).select(*columns)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(spark, _documents(spark, sf_dir), BYTE_BPE, END_ID)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "text", "n_lines", "n_removed"]
    return line_dedup.dedup_lines(_documents(spark, sf_dir)).select(*columns)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_documents(spark, sf_dir), WORD_BPE, digests=True)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = ["doc_id", "held_out", "score", "predicted"]
    return toxicity.toxicity(_documents(spark, sf_dir), labels).select(*columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", *quality.MEASURES, "base_failed", "kept"]
    return quality.quality_verdicts(_documents(spark, sf_dir)).select(*columns)


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(_documents(spark, sf_dir))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, sf_dir))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.quality_scores(_documents(spark, sf_dir), labels)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_mixing": op2_mixing,
        "op3_token_files": op3_token_files,
        "op4_line_dedup": op4_line_dedup,
        "op5_bpe": op5_bpe,
        "op6_toxicity": op6_toxicity,
        "op7_quality_rules": op7_quality_rules,
        "op8_nearest_vectors": op8_nearest_vectors,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_html_text": op10_html_text,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_conversation_trie": op13_conversation_trie,
    }


def _license_sql() -> str:
    """Every block against every template, without filters."""
    templates = ", ".join(
        f"('{label}', {sorted(set(text.split()))}, {licenses.block_width(text)})"
        for label, text in licenses.TEMPLATES.items()
    )
    phrases = ", ".join(
        f"({phrase.split()}, '{label}')" for phrase, label in licenses.PHRASES.items()
    )
    return rf"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    places AS (
        SELECT doc_id, label, i - 1 AS i
        FROM d, unnest(range(1, len(w) + 1)) AS u(i), (VALUES {phrases}) AS p(phrase, label)
        WHERE w[i:i + len(phrase) - 1] = phrase),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
               list(DISTINCT label) AS labels
        FROM places GROUP BY doc_id),
    blocks AS (
        SELECT doc_id, label, words,
               len(list_intersect(list_distinct(w[s * (width // 2) + 1:s * (width // 2) + width]),
                                  words)) AS shared
        FROM d, (VALUES {templates}) AS t(label, words, width),
             unnest(range(0, greatest(len(w) - width // 2, 0) // (width // 2) + 1)) AS u(s)),
    found AS (
        SELECT doc_id, list(DISTINCT label) AS labels, max(shared / len(words)) AS best
        FROM blocks WHERE shared >= {licenses.THRESHOLD} * len(words) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(
               coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
    FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
    """


_QUALITY_SQL = r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
        FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
        FROM d, unnest(range(1, len(w) - 6)) AS u(i)),
    repeated AS (
        SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
    covered AS (
        SELECT doc_id, CAST(sum(least(8, coalesce(next - i, 8))) AS BIGINT) AS n
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next
              FROM repeated)
        GROUP BY doc_id),
    m AS (
        SELECT doc_id, len(w) AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
               length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
               len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
               coalesce(n, 0) AS n_repeat_words
        FROM d LEFT JOIN covered USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           {base} AS base_failed, NOT ({rules}) AS kept
    FROM m
    """


_LINES_SQL = r"""
    WITH lines AS (
        SELECT doc_id, i, l, trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
             unnest(range(1, len(ls) + 1)) AS u(i), unnest([ls[i]]) AS v(l)),
    full_lines AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
        FROM lines WHERE t <> ''),
    windows AS (
        SELECT doc_id, k, [t, lead(t) OVER w, lead(t, 2) OVER w] AS win
        FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY k)
        QUALIFY lead(t, 2) OVER w IS NOT NULL),
    repeats AS (
        SELECT doc_id, k FROM windows
        QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, k) > 1),
    covered AS (
        SELECT DISTINCT doc_id, k + d AS k FROM repeats, unnest([0, 1, 2]) AS u(d)),
    gone AS (SELECT doc_id, i, k FROM full_lines JOIN covered USING (doc_id, k)),
    -- A line without a word goes if it stands between two covered lines that follow each other.
    kept AS (
        SELECT doc_id, i, l FROM lines
        WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM gone)
          AND (t <> '' OR NOT EXISTS (
              SELECT 1 FROM gone a JOIN gone b ON a.doc_id = b.doc_id AND b.k = a.k + 1
              WHERE a.doc_id = lines.doc_id AND a.i < lines.i AND lines.i < b.i)))
    SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
           coalesce(n.n_lines, 0) AS n_lines, coalesce(g.n_removed, 0) AS n_removed
    FROM documents d
    LEFT JOIN (SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS text FROM kept GROUP BY 1) k
        USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n_lines FROM full_lines GROUP BY 1) n USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1) g USING (doc_id)
    """


def _crc32_sql(code_units: str) -> str:
    """Unsigned crc32 of a list of bytes, bit by bit: a byte enters at the first of its eight steps."""
    steps = f"flatten(list_transform({code_units}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))"
    return f"""xor(4294967295, list_reduce(
        list_transform({steps}, lambda b: b::BIGINT),
        lambda r, b: xor(xor(r, b) >> 1, 3988292384 * (xor(r, b) & 1)), 4294967295::BIGINT))"""


_ASCII = "list_transform(string_split({text}, ''), lambda ch: unicode(ch))"


# Code points up to 255 as UTF-8.
_LATIN = f"""flatten(list_transform({_ASCII}, lambda u:
    CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"""


def _spelling_sql() -> str:
    """Words that are alike but for one place, or for one code point left out, by the rest of them."""
    h = _crc32_sql(_LATIN.format(text="concat(doc_id, ':', run)"))
    lower = f"translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}')"
    return rf"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all({lower}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
    hashed AS (SELECT run, count(*) AS n, {h} AS h FROM runs GROUP BY doc_id, run),
    v AS (
        SELECT CASE WHEN h % 199 = 0
                    THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                    ELSE run END AS word,
               sum(n)::BIGINT AS n
        FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
    rests AS (
        SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
        FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
    near AS (
        SELECT x.word, y.word AS near, y.n FROM rests x JOIN rests y USING (i, a, b) WHERE x.word <> y.word
        UNION SELECT r.word, v.word, v.n FROM rests r JOIN v ON r.a || r.b = v.word
        UNION SELECT v.word, r.word, r.n FROM rests r JOIN v ON r.a || r.b = v.word),
    best AS (
        SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n
        FROM near GROUP BY word),
    formed AS (
        SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN near_n >= 5 * v.n THEN near END AS form,
               CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
        FROM v LEFT JOIN best USING (word)),
    walk AS (
        SELECT word, word AS at FROM formed
        UNION SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.at
        WHERE formed.form IS NOT NULL)
    SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
    FROM formed f JOIN walk w USING (word) JOIN formed last ON last.word = w.at AND last.form IS NULL
    """


def _trie_sql() -> str:
    """Every prefix of every conversation as a list; subtrees by comparing prefixes."""
    h = _crc32_sql(_ASCII.format(text="conv_id::VARCHAR"))
    return f"""
    WITH own AS (
        SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    heads AS (SELECT *, {h} % 9 AS h FROM own),
    built AS (
        SELECT c.conv_id, list_concat(coalesce(f.s, [])[1:c.h], c.s[c.h + 1:]) AS s
        FROM heads c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 5),
    members AS (
        SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends FROM built, unnest(range(0, len(s) + 1)) AS u(d)),
    nodes AS (
        SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends,
               (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].text) END AS saved
        FROM members GROUP BY p, d),
    children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    below AS (
        SELECT p[1:i] AS p, sum(saved) AS saved, count(*) FILTER (p NOT IN (SELECT p FROM children)) AS n
        FROM nodes, unnest(range(0, d + 1)) AS u(i) GROUP BY 1)
    SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs,
           coalesce(c.n, 0) AS n_children, b.n AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
           sha256(n.ends) AS ends_sha256
    FROM nodes n JOIN below b USING (p) LEFT JOIN children c USING (p)
    LEFT JOIN nodes up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
    """


def oracle_sql() -> dict[str, str]:
    base, rules = (
        " OR ".join(f"({condition})" for condition in some.values())
        for some in (quality.BASE_RULES, quality.RULES)
    )
    return {
        "op1_license_scan": _license_sql(),
        "op4_line_dedup": _LINES_SQL,
        "op7_quality_rules": _QUALITY_SQL.replace("{base}", base).replace("{rules}", rules),
        "op11_spelling_variants": _spelling_sql(),
        "op13_conversation_trie": _trie_sql(),
    }
