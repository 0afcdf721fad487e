"""Removal of passages that occur again, found through overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import packed, table, text_tie

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document with lines to remove: ``doc_id, tie, lines`` (sorted numbers of these lines, from 0).

    Every ``window`` consecutive lines are one window, compared by the MD5 of their text as it stands. The occurrence with the
    smallest (id, tie, line number) stays, null ids before others; the lines of every other occurrence are covered and go,
    overlapping occurrences merged. ``tie`` is a number made from the text, so rows with the same id and different texts are told
    apart; rows that repeat both are copies of one document and share its result. A document of fewer lines than the window,
    an empty or a null text has no window and loses nothing.
    """
    lines = _lines(docs[text_col].cast("string"))
    keyed = docs.select(docs[id_col].alias("doc_id"), text_tie(docs[text_col]).alias("tie"), lines.alias("lines"))
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("lines") - window),
        lambda i: F.unhex(F.md5(F.concat_ws("\n", *[F.get("lines", i + k) for k in range(window)]).cast("binary"))),
    )
    windows = keyed.filter(F.size("lines") >= window).select("doc_id", "tie", F.posexplode(hashes).alias("line", "hash"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie", "line")
    firsts = windows.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("hash", "first")
    # a window that very many documents hold is one row here; adaptive execution splits the rows that meet it
    later = windows.withColumn("place", place).join(firsts, "hash").filter("place != first")
    covered = F.explode(F.sequence("line", F.col("line") + (window - 1))).alias("line")
    gone = later.select("doc_id", "tie", covered).distinct()
    return gone.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def _lines_between(lines: Column, gone: Column) -> Column:
    """``lines`` without those whose numbers ``gone`` lists in ascending order: the stretches between them, one after the other."""
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))

    def stretches(held: Column) -> Column:
        def stretch(i: Column) -> Column:
            before, after = F.get(held["edges"], i), F.get(held["edges"], i + 1)
            return F.slice(held["lines"], before + 2, after - before - 1)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(held["edges"]) - 2), stretch))

    # both arrays are made once and bound, not once for every stretch
    return F.get(F.transform(F.array(F.struct(lines.alias("lines"), edges.alias("edges"))), stretches), F.lit(0))


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` as they were, with ``text`` after removal and the added columns ``_n_lines`` and ``_n_removed``.

    A text of which every line goes becomes empty. Null texts stay null and have no lines. Only documents that lose lines are
    matched with their line numbers; a column of ``docs`` may have any name but these two.
    """
    gone = repeated_lines(docs, id_col, text_col, window).select("doc_id", "tie", "lines")
    rows = docs.select(packed(docs).alias("row"), docs[id_col].alias("doc_id"), text_tie(docs[text_col]).alias("tie"))
    # null ids are matched too
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["tie"] == gone["tie"])
    joined = rows.join(gone, same, "left").select("row", gone["lines"].alias("gone"))
    text = F.col("row").getField(text_col)
    split = _lines(text)
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.concat_ws("\n", _lines_between(split, F.col("gone"))))
    columns = [kept.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    n_lines = F.when(text.isNull() | (text == ""), 0).otherwise(F.size(split)).cast("long")
    return joined.select(*columns, n_lines.alias("_n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_n_removed"))


def drop_emptied(deduped: DataFrame, text_col: str = "text") -> DataFrame:
    """Without the documents of which every line was removed; documents that were empty before stay."""
    columns = [c for c in deduped.columns if c not in ("_n_lines", "_n_removed")]
    return deduped.filter("_n_removed = 0 OR _n_removed < _n_lines").select(*columns)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents with what is left of their texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


#: Documents in ``{docs}`` after line removal: doc_id, text, n_lines, n_removed; other columns can be joined by doc_id and tie.
LINE_CTES = """
ld_docs AS (
    SELECT DISTINCT doc_id, text, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS tie, string_split(text, chr(10)) AS ls
    FROM {docs}
), ld_windows AS (
    SELECT doc_id, tie, i - 1 AS line, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS w
    FROM (SELECT doc_id, tie, ls, unnest(range(1, len(ls) - 1)) AS i FROM ld_docs WHERE len(ls) >= 3)
), ld_ranked AS (
    SELECT doc_id, tie, line, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, tie, line) AS r FROM ld_windows
), ld_gone AS (
    SELECT doc_id, tie, list(DISTINCT l) AS gone
    FROM (SELECT doc_id, tie, unnest([line, line + 1, line + 2]) AS l FROM ld_ranked WHERE r > 1) GROUP BY doc_id, tie
), ld_left AS (
    SELECT d.doc_id, d.tie, d.text AS old_text,
        CASE WHEN g.gone IS NULL THEN d.text
             ELSE coalesce((SELECT string_agg(ls[i], chr(10) ORDER BY i) FROM (SELECT unnest(range(1, len(ls) + 1)) AS i)
                            WHERE NOT list_contains(g.gone, i - 1)), '') END AS text,
        CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(ls) END::BIGINT AS n_lines, coalesce(len(g.gone), 0)::BIGINT AS n_removed
    FROM ld_docs d LEFT JOIN ld_gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.tie = g.tie
)"""

OP6_SQL = "WITH " + LINE_CTES.format(docs="documents") + " SELECT doc_id, text, n_lines, n_removed FROM ld_left"
