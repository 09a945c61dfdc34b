"""Line dedup by overlapping three-line windows.

Every three consecutive lines of a document are hashed; a window that also stands earlier, in the same
document or in one with a smaller id, is a repeat, and all lines that repeats cover are removed.
Neighbouring repeats overlap, so a repeated passage goes as a whole, while a single line that many
documents share stays.

Lines are trimmed for comparison and those without a word are passed over: they neither make nor break
a window, and go with the lines around them. The first window in a document is found in the row
itself, so one row per distinct window and document is shuffled, as two hashes and an id, and summed
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import sealed, stored, whole_text, with_others_aside

WINDOW = 3
_BLANK = r"^[\\x20\\x09-\\x0D]*$"


def _windows(docs: DataFrame, text: str) -> DataFrame:
    """Adds `_lines`, `_full` (places of lines with a word) and `_wins`, a hash pair per window."""
    rows = docs.withColumn("_lines", F.split(whole_text(text), "\n")).withColumn(
        "_full",
        F.expr(
            f"""filter(transform(_lines, (l, i) -> CASE WHEN NOT l RLIKE '{_BLANK}' THEN i END),
                       i -> i IS NOT NULL)"""
        ),
    )
    rows = rows.withColumn(
        "_trim", F.transform("_full", lambda i: F.btrim(F.get("_lines", i), F.lit(" \t\n\x0b\f\r")))
    )
    # Lengths keep lines apart that would read the same when put together.
    three = "get(_trim, i), get(_trim, i + 1), get(_trim, i + 2)"
    return rows.withColumn(
        "_wins",
        F.expr(
            f"""CASE WHEN size(_trim) < {WINDOW} THEN
                    array_repeat(struct(0L AS a, 0L AS b), 0)
                ELSE transform(sequence(0, size(_trim) - {WINDOW}), i -> struct(
                    xxhash64({three}) AS a, xxhash64(1, {three}) AS b)) END"""
        ),
    )


def _order_key(id_column: str) -> Column:
    """Rows without an id come last and count as one document."""
    return F.coalesce(F.col(id_column), F.lit(2**63 - 1))


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Windows of documents that stand in an earlier document: `_doc`, `_later` (their hashes)."""
    rows = _windows(docs.select(id_column, text), text).select(
        _order_key(id_column).alias("_doc"), F.explode(F.array_distinct("_wins")).alias("_win")
    )
    rows = stored(rows.select("_doc", "_win.a", "_win.b"), "line-windows")
    first = (
        rows.groupBy("a", "b")
        .agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
        .where("_first < _last")
        .drop("_last")
    )
    later = rows.join(first, ["a", "b"]).where(F.col("_doc") > F.col("_first"))
    return later.groupBy("_doc").agg(F.collect_set(F.struct("a", "b")).alias("_later"))


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", counts: bool = True
) -> DataFrame:
    """`docs` without repeated lines; with `counts` also `n_lines` and `n_removed` (with a word).

    A document with fewer than three lines with a word has no windows and stays as it is, as does a
    null text. Rows that share an id count as one document: they are not repeats of each other.
    Rows without an id are kept, as the last document. If nothing is removed the text is unchanged;
    a document that loses all its lines is kept with an empty text. Other columns stay as they are; with
    `counts`, an input column of either name gives way.
    """
    own = [name for name in (id_column, text, "n_chars") if name in docs.columns]
    return with_others_aside(docs, own, lambda rows: _dedup(rows, id_column, text, counts))


def _dedup(docs: DataFrame, id_column: str, text: str, counts: bool) -> DataFrame:
    keyed = docs.withColumn("_order", _order_key(id_column))
    later = repeated_windows(docs, id_column, text)
    rows = _windows(keyed.join(later, F.col("_order") == F.col("_doc"), "left"), text)
    # Places among the lines with a word at which a repeat begins. Sorted by hash, with a mark before
    # the windows that an earlier document has, a window is a repeat if the entry before it is equal.
    marked = F.expr(
        """sort_array(concat(
               transform(_wins, (w, i) -> struct(w.a AS a, w.b AS b, i AS i)),
               transform(coalesce(_later, array_repeat(struct(0L AS a, 0L AS b), 0)),
                         w -> struct(w.a AS a, w.b AS b, -1 AS i))))"""
    )
    some = (F.size(F.array_distinct("_wins")) < F.size("_wins")) | F.col("_later").isNotNull()
    rows = rows.withColumn("_sorted", F.when(some, marked)).withColumn(
        "_repeat",
        F.expr(
            """sort_array(transform(
                   filter(_sorted, (s, j) -> s.i >= 0 AND s.a <=> get(_sorted, j - 1).a
                                                      AND s.b <=> get(_sorted, j - 1).b),
                   s -> s.i))"""
        ),
    )
    return _without(rows, docs.columns, text, counts)


def _without(rows: DataFrame, columns: list[str], text: str, counts: bool) -> DataFrame:
    """Remove the lines that the windows at `_repeat` cover, blank lines between them included."""
    begins = F.expr(
        f"filter(_repeat, (r, j) -> j = 0 OR r > get(_repeat, j - 1) + {WINDOW})"
    )
    ends = F.expr(
        f"""transform(filter(_repeat, (r, j) -> j = size(_repeat) - 1
                                             OR r + {WINDOW} < get(_repeat, j + 1)),
                      r -> r + {WINDOW})"""
    )
    rows = rows.withColumn("_a", begins).withColumn("_b", ends)
    # From lines with a word to all lines: up to the last covered line.
    rows = rows.withColumn("_spans", F.arrays_zip(F.col("_a").alias("a"), F.col("_b").alias("b")))
    rows = rows.withColumn(
        "_cut",
        F.expr(
            "transform(_spans, s -> struct(get(_full, s.a) AS a, get(_full, s.b - 1) + 1 AS b))"
        ),
    )
    kept = F.expr(
        """flatten(transform(sequence(0, size(_cut)), j -> slice(
               _lines,
               coalesce(get(_cut, j - 1).b, 0) + 1,
               coalesce(get(_cut, j).a, size(_lines)) - coalesce(get(_cut, j - 1).b, 0))))"""
    )
    changed = F.size("_repeat") > 0
    new_text = F.when(changed, F.array_join(kept, "\n")).otherwise(F.col(text))
    rows = rows.withColumn("_new", new_text)
    values = {text: F.col("_new")}
    if "n_chars" in columns:
        chars = F.length("_new").cast(dict(rows.dtypes)["n_chars"])
        values["n_chars"] = F.when(changed, chars).otherwise(F.col("n_chars"))
    removed = F.expr("aggregate(_spans, 0L, (n, s) -> n + s.b - s.a)")
    added = [
        F.size("_full").cast("bigint").alias("n_lines"),
        F.coalesce(F.when(changed, removed), F.lit(0).cast("bigint")).alias("n_removed"),
    ]
    made = [*[v.alias(name) for name, v in values.items()], *(added if counts else [])]
    others = [name for name in columns if name not in values]
    rows = rows.select(*others, sealed(F.struct(*made)))
    order = [F.col(f"_sealed.{n}") if n in values else F.col(n) for n in columns]
    return rows.select(*order, *[f"_sealed.{n}" for n in ("n_lines", "n_removed") if counts])
