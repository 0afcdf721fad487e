"""Contiguous shards of nearly equal size, cut by a global prefix sum of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, offsets_before, table


def byte_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Documents are ordered by id (null first; ties by checksum and size) and cut where the running byte count passes equal
    targets: a document belongs to the shard that holds the middle of its bytes, so a shard differs from its target by less than
    the largest document. ``size`` is the UTF-8 length plus 1, so null and empty texts count 1. ``slot`` numbers the documents of
    a shard from 0 in that order. With fewer documents than shards, or a document above the target, some shards stay empty.
    ``law`` is always ``bytes`` and ``grown_shard`` null. Other columns of ``docs`` are not read; an empty table gives no rows.

    Rows are range-partitioned by id and stored without their text. Each partition's totals, one row for each, give what lies
    before it; running sums within partitions give the rest. No task sees more than one partition, however rows are spread:
    repeats of one id are told apart by a row number, so even they spread over partitions.
    """
    body = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    sized = docs.select(
        docs[id_col].alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("tie")]
    ranged = materialise(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = offsets_before(totals, "part", ["bytes", "rows"])
    # one row for each partition
    placed = ranged.join(F.broadcast(before), "part")

    upto = Window.partitionBy("part").orderBy(*order)
    start = F.col("bytes_before") + F.sum("size").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    numbered = placed.select(
        "doc_id", "size", "text_crc32", "bytes_all", start.alias("start"), (F.col("rows_before") + F.row_number().over(upto) - 1).alias("place"),
    )
    # twice the middle of the document against twice the total: whole numbers only
    shard = F.expr(f"cast(((2 * start + size) * {int(n_shards)}) div (2 * bytes_all) AS int)")
    cut = materialise(numbered.select("doc_id", "size", "text_crc32", shard.alias("shard"), "place"), "shards")
    firsts = cut.groupBy("shard").agg(F.min("place").alias("first_place"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_byte_shards(spark, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"))
