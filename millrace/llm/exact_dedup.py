"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, materialise, table

#: Characters that the second refinement hashes.
PREFIX_CHARS = 256
#: Surviving (length, beginning) groups are announced as numbers below this, so what is broadcast never exceeds it.
SLOTS = 1 << 20


def _slot(length: Column, head: Column) -> Column:
    return F.pmod(F.xxhash64(length, head), F.lit(SLOTS)).cast("int")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False, prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so all null and empty texts are one group. Of a
    group the row with the largest id stays (a null id is below every other); of rows that repeat this id one stays. Rows whose
    length or beginning no other row shares are known to be single without hashing their text: they have a null digest
    unless ``digest_all`` asks for it. Other columns of ``docs`` are not read. An empty table gives an empty result.

    The first pass counts (length, hash of the beginning) with partial sums, so a common length is a few rows; a length of one row
    has one beginning, and only groups of two and more go on. They are turned into at most ``SLOTS`` numbers and broadcast; the
    second pass hashes whole texts only where the number is among them. Two groups that share a number cost a needless hash, never
    a wrong result, but with far more than ``SLOTS`` surviving groups most texts are hashed whole. No text is ever shuffled, and
    only texts that are hashed whole are lower-cased whole: the length does not depend on case.
    """
    raw = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    length, head = F.octet_length(raw), F.xxhash64(lower_ascii(F.substring(raw, 1, prefix_chars)))
    heads = docs.select(length.alias("length"), head.alias("head")).groupBy("length", "head").agg(F.count("*").alias("n")).filter("n > 1")
    slots = heads.select(_slot(F.col("length"), F.col("head")).alias("slot")).distinct()

    texts = docs.select(
        docs[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("row"), length.alias("length"), _slot(length, head).alias("slot"), raw.alias("raw"),
    )
    marked = texts.join(F.broadcast(slots.withColumn("survives", F.lit(True))), "slot", "left")
    survives = F.coalesce(F.col("survives"), F.lit(False))
    digest = F.sha2(lower_ascii(F.col("raw")).cast("binary"), 256)
    hashed = materialise(
        marked.select(
            "doc_id", "row", "length", survives.alias("survives"),
            (digest if digest_all else F.when(survives, digest)).alias("text_sha256"),
        ),
        "exact",
    )

    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "row")
    groups = materialise(
        hashed.filter("survives").groupBy("length", "text_sha256")
        .agg(F.max(order).alias("stays"), F.count("*").alias("group_size")).filter("group_size > 1"),
        "groups",
    )
    # the rows of a large group meet its one summary row; written apart, the join is all its stage does and adaptive execution splits it
    joined = hashed.join(groups, ["length", "text_sha256"], "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("stays.row"))).alias("kept"),
        "text_sha256",
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


OP3_SQL = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""
