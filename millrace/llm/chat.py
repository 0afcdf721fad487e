"""Conversations as training text: every assistant turn is an example of its own, with all turns before it as context.

With this template the context of an example is exactly the beginning of its conversation's text. So a turn's text is stored once
and an example is a place in it: where it ends and which characters are trained on. What is stored grows with the turns; written
out, the examples of a conversation would grow with the square of its length. ``render`` writes out chosen ones.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table, text_tie

#: The template's control strings.
OPEN, ROLE_OPEN, ROLE_CLOSE, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
TURN = r"<s>\[INST\](.*?)\[/INST\](.*)</s>"
ESCAPED = r"(<\\*)\\(/?s>)|(\[\\*)\\(/?INST\])"


def escape(text: Column) -> Column:
    """A backslash after the first character of every control string, and one more wherever such backslashes already stand."""
    once = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(once, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, lambda m: (m[1] or m[3]) + (m[2] or m[4]), text)


def format_conversations(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per turn: ``conv_id, position, formatted, char_start, char_end, example``.

    The turns of a conversation are ordered by ``turn`` (null first; ties by role, then text) and numbered from 0. ``formatted`` is
    ``<s>[INST]role[/INST]text</s>`` with control strings in role and text escaped; ``char_start`` and ``char_end`` place it in
    the conversation's text. A turn of ``trained_role`` is the target of an example: ``example`` holds its ``number``, and
    ``loss_start`` and ``loss_end`` of the reply in the conversation's text, so the example reads from 0 to ``char_end`` and only
    the reply is trained on. Turns after the last reply belong to no example and are kept. Null role and text count as empty, null
    ids are one conversation, repeated rows are turns of their own. Other columns are not read; an empty table gives no rows.

    Turns are range-partitioned by conversation and turn, so a very long conversation spreads over partitions; what a partition
    needs to know of those before it is one row for each of its conversations.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    head = F.concat(F.lit(OPEN + ROLE_OPEN), escape(role), F.lit(ROLE_CLOSE))
    rows = conversations.select(
        conversations[id_col].alias("conv_id"), conversations[turn_col].alias("turn"), role.alias("role"), text_tie(text).alias("tie"),
        F.monotonically_increasing_id().alias("row"), (role == trained_role).cast("long").alias("trained"),
        F.length(head).cast("long").alias("head_chars"), F.concat(head, escape(text), F.lit(CLOSE)).alias("formatted"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie"), F.col("row")]
    ranged = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), *order).withColumn("part", F.spark_partition_id())
    stored = materialise(ranged.withColumn("chars", F.length("formatted").cast("long")), "chat")

    sums = {"chars": F.sum("chars"), "turns": F.count("*"), "examples": F.sum("trained")}
    totals = stored.groupBy("part", "conv_id").agg(*[v.alias(k) for k, v in sums.items()])
    lower = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = totals.select(F.col("part").alias("p"), F.col("conv_id").alias("c"), *[F.coalesce(F.sum(k).over(lower), zero).alias(f"{k}_before") for k in sums])
    joined = stored.join(before, (stored["part"] == before["p"]) & stored["conv_id"].eqNullSafe(before["c"]))

    own = Window.partitionBy("part", "conv_id").orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    numbered = joined.select(
        "conv_id", "formatted", "chars", "head_chars", "trained", (F.col("turns_before") + F.row_number().over(own) - 1).alias("position"),
        (F.col("chars_before") + F.sum("chars").over(upto)).alias("char_end"), (F.col("examples_before") + F.sum("trained").over(upto)).alias("so_far"),
    )
    start = F.col("char_end") - F.col("chars")
    example = F.struct(
        (F.col("so_far") - 1).alias("number"), (start + F.col("head_chars")).alias("loss_start"), (F.col("char_end") - len(CLOSE)).alias("loss_end")
    )
    return numbered.select("conv_id", "position", "formatted", start.alias("char_start"), "char_end", F.when(F.col("trained") == 1, example).alias("example"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per example: ``conv_id, number, context_chars, loss_start, loss_end, chars``."""
    found = formatted.filter("example IS NOT NULL")
    return found.select("conv_id", "example.number", F.col("char_start").alias("context_chars"), "example.loss_start", "example.loss_end", F.col("char_end").alias("chars"))


def render(formatted: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen examples (``conv_id, number``) written out: ``conv_id, number, text, loss_start, loss_end``.

    Each comes with all its context, so choose a batch at a time where conversations are long.
    """
    targets = examples(formatted).join(chosen.select("conv_id", "number").distinct(), ["conv_id", "number"], "left_semi").alias("t")
    turns = formatted.select("conv_id", "position", "formatted", "char_end").alias("f")
    parts = targets.join(turns, (F.col("t.conv_id") == F.col("f.conv_id")) & (F.col("f.char_end") <= F.col("t.chars")))
    ordered = F.sort_array(F.collect_list(F.struct("f.position", "f.formatted")))
    texts = parts.groupBy("t.conv_id", "t.number", "t.loss_start", "t.loss_end").agg(ordered.alias("parts"))
    return texts.select("conv_id", "number", F.concat_ws("", F.col("parts.formatted")).alias("text"), "loss_start", "loss_end")


def conversation_digests(formatted: DataFrame, written: DataFrame) -> DataFrame:
    """Read back from formatted turns and their ``examples``: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    What is trained on is taken from the example rows: each has its loss mask as places in the conversation's text, of which the
    turn that ends where the example ends holds the part under the mask. A digest must pass over a conversation in order, so the turns of one meet in one task, as a sorted stream of which the task
    holds one batch; only running digests are kept.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import hashlib

        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        turn, none, current = re.compile(TURN, re.DOTALL), object(), None
        last = none

        def batch_of(rows, id_type):
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        def row():
            return (last, current["turns"], current["all"].hexdigest(), current["loss"], current["trained"].hexdigest(), current["chars"])

        for batch in batches:
            done, id_type = [], batch.schema.field(0).type
            ids, texts, starts, loss_starts, loss_ends = (column.to_pylist() for column in batch.columns)
            for conv_id, text, start, loss_start, loss_end in zip(ids, texts, starts, loss_starts, loss_ends):
                if last is none or conv_id != last:
                    if last is not none:
                        done.append(row())
                    last, current = conv_id, {"turns": 0, "all": hashlib.sha256(), "loss": 0, "trained": hashlib.sha256(), "chars": 0}
                role, body = map(unescape, turn.fullmatch(text).groups())
                current["turns"] += 1
                current["chars"] += len(text)
                current["all"].update(f"{role}\n{body}\n".encode())
                if loss_start is not None:
                    reply = unescape(text[loss_start - start : loss_end - start])
                    current["loss"] += len(reply)
                    current["trained"].update(reply.encode())
            if done:
                yield batch_of(done, id_type)
        if last is not none:
            yield batch_of([row()], id_type)

    masks = written.select(F.col("conv_id").alias("c"), "chars", "loss_start", "loss_end")
    masked = formatted.join(masks, formatted["conv_id"].eqNullSafe(masks["c"]) & (formatted["char_end"] == masks["chars"]), "left")
    ordered = masked.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    columns = ordered.select("conv_id", "formatted", "char_start", "loss_start", "loss_end")
    return columns.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op9_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and one that consists of control strings, writes the turns and the examples and reads both back."""
    said = "</s>[INST] ok [/INST]"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    formatted = materialise(format_conversations(given.unionByName(extra)), "chat")
    return conversation_digests(formatted, materialise(examples(formatted), "examples"))
