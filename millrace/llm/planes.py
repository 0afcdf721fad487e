"""Token ids in a binary format of bit or byte planes.

Ids are cut into blocks of a fixed number. A block is transposed so that the lowest byte (or bit) of all its ids comes first,
then the next, and each plane is compressed with zstandard by itself: planes that hold little vanish. A file is one partition of
the documents in ascending order of id; its rows are the blocks with their payload and an index of what they hold.

Payload of a block, all numbers little-endian: ``MRP1``, plane kind (u8: 1 bit, 8 byte planes), ids in the block (u32), number
of planes (u8), length of each compressed plane (u32 each), then the planes.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import PIECES, SETTLED, Transducer, default_vocabulary
from millrace.llm.common import offsets_before, table, text_tie
from millrace.session import scratch_path

BLOCK_IDS = 1 << 16
LEVEL = 3
MAGIC = b"MRP1"

BLOCKS = (
    "file int, block int, first_id long, n_ids int, payload binary,"
    " documents array<struct<number:int,doc_id:{kind},start:int,n_ids:int,last:boolean>>"
)


def pack(ids, planes: str = "byte", level: int = LEVEL) -> bytes:
    """The payload of one block of unsigned 32-bit ids."""
    import numpy as np
    import zstandard

    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        columns = np.unpackbits(columns, axis=1, bitorder="little")
        rows = [np.packbits(row) for row in columns.T]
    else:
        rows = list(columns.T)
    press = zstandard.ZstdCompressor(level=level)
    packed = [press.compress(np.ascontiguousarray(row).tobytes()) for row in rows]
    head = struct.pack("<4sBIB", MAGIC, 1 if planes == "bit" else 8, len(ids), len(packed))
    return head + struct.pack(f"<{len(packed)}I", *map(len, packed)) + b"".join(packed)


def unpack(payload: bytes):
    """The ids of a block."""
    import numpy as np
    import zstandard

    magic, kind, n, count = struct.unpack_from("<4sBIB", payload)
    if magic != MAGIC:
        raise ValueError("not a block of planes")
    at = struct.calcsize("<4sBIB")
    lengths = struct.unpack_from(f"<{count}I", payload, at)
    at += 4 * count
    open_ = zstandard.ZstdDecompressor()
    rows = []
    for length in lengths:
        row = np.frombuffer(open_.decompress(payload[at : at + length]), np.uint8)
        rows.append(np.unpackbits(row, count=n) if kind == 1 else row)
        at += length
    columns = np.stack(rows, axis=1) if n else np.zeros((0, count), np.uint8)
    if kind == 1:
        columns = np.packbits(columns, axis=1, bitorder="little")
    return np.ascontiguousarray(columns).view("<u4").ravel()


def _zeros_matrix(length: int) -> tuple[int, ...]:
    """What appending ``length`` zero bytes does to a CRC-32 register, as the images of its 32 bits."""
    times = lambda m, v: functools.reduce(lambda s, k: s ^ m[k] if v >> k & 1 else s, range(32), 0)
    step = (0xEDB88320, *[1 << k for k in range(31)])  # one zero bit
    for _ in range(3):
        step = tuple(times(step, v) for v in step)  # one zero byte
    out = tuple(1 << k for k in range(32))
    while length:
        if length & 1:
            out = tuple(times(step, v) for v in out)
        step = tuple(times(step, v) for v in step)
        length >>= 1
    return out


def join_crc32(first: int, second: int, second_bytes: int, known: dict[int, tuple[int, ...]] | None = None) -> int:
    """CRC-32 of two byte strings in a row, from the CRC-32 of each. ``known`` keeps what depends on the length only."""
    known = {} if known is None else known
    if second_bytes not in known:
        known[second_bytes] = _zeros_matrix(second_bytes)
    matrix, out = known[second_bytes], second
    for k in range(32):
        if first >> k & 1:
            out ^= matrix[k]
    return out


#: White space from this length on goes to the tokenizers library: tiktoken's pattern gives up somewhat above 500,000 characters.
LONG_BLANK = 50_000


class Ids:
    """Ids of whole texts as the tokenizers library gives them, without special tokens being added.

    tiktoken runs the same merges several times as fast; texts with characters that Unicode versions classify differently, with
    very long white space, or on which tiktoken's pattern gives up, go to the tokenizers library.
    """

    def __init__(self, vocabulary: str):
        import tiktoken
        from tokenizers import Tokenizer

        coder = Transducer(vocabulary)
        special = {token: coder.bytes_of.index(token.encode()) for token in coder.added}
        ranks = {raw: i for i, raw in enumerate(coder.bytes_of) if raw and i not in special.values()}
        in_order = all(ranks[a + b] < ranks[c + d] for (a, b), (c, d) in zip(coder.merges, coder.merges[1:]))
        self.own = Tokenizer.from_str(vocabulary)
        self.own.no_truncation()
        self.own.no_padding()
        pattern = PIECES.format(L=r"\p{L}", N=r"\p{N}", S=r"\s")
        self.fast = tiktoken.Encoding("planes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special) if in_order else None
        self.unsettled = re.compile(rf"[^\x00-\u{SETTLED:04x}]")
        self.long_blank = re.compile(rf"(?<!\s)\s{{{LONG_BLANK}}}")

    def is_unsettled(self, text: str) -> bool:
        try:
            text.encode("latin-1")  # far faster than the pattern
        except UnicodeEncodeError:
            return self.unsettled.search(text) is not None
        return False

    def __call__(self, text: str):
        import numpy as np

        if self.fast is not None and not self.is_unsettled(text) and not (len(text) >= LONG_BLANK and self.long_blank.search(text)):
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # its pattern gave up on this text
                pass
        return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4")


def write_ids(
    docs: DataFrame, vocabulary: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, planes: str = "byte",
) -> None:
    """Encode every whole text, append ``end_id`` to each document and write the files of blocks below ``path``.

    Documents are written in ascending order of id (null first, then by text). Null counts as empty: such a document has its end
    id only. Repeated rows are written as often as they come; an empty table gives files without blocks. A document may span
    blocks; the index says which part of it each block holds. Memory holds one block and one document.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary})

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        held = shared.value
        if "ids" not in held:
            held["ids"] = Ids(held["vocabulary"])
        ids_of, file = held["ids"], TaskContext.get().partitionId()
        schema = None
        waiting, documents, n_waiting, first, block, number = [], [], 0, 0, 0, 0

        def row():
            ids = np.concatenate(waiting)
            cells = [[file], [block], [first], [len(ids)], [pack(ids, planes)], [documents]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)

        for batch in batches:
            if schema is None:
                part = pa.struct([("number", pa.int32()), ("doc_id", batch.schema.field(0).type), ("start", pa.int32()), ("n_ids", pa.int32()), ("last", pa.bool_())])
                schema = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()), ("payload", pa.binary()), ("documents", pa.list_(part))])
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(ids_of(text.as_py() or ""), np.array([end_id], "<u4"))
                at = 0
                while at < len(ids):
                    take = ids[at : at + block_ids - n_waiting]
                    at += len(take)
                    documents.append({"number": number, "doc_id": doc_id.as_py(), "start": n_waiting, "n_ids": len(take), "last": at == len(ids)})
                    waiting.append(take)
                    n_waiting += len(take)
                    if n_waiting == block_ids:
                        yield row()
                        first, block = first + n_waiting, block + 1
                        waiting, documents, n_waiting = [], [], 0
                number += 1
        if n_waiting:
            yield row()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), text_tie(docs[text_col]).alias("tie"))
    # the row number only spreads repeats of one document over partitions
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ordered.select("doc_id", "text").mapInArrow(run, BLOCKS.format(kind=kind))
    blocks.write.option("compression", "none").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with their index, as written."""
    return spark.read.parquet(path)


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files alone: ``doc_id, start, n_tokens, ids_crc32`` for each document, in which ``start`` counts the ids of all
    documents before it and ``ids_crc32`` is taken over its ids as little-endian unsigned 32-bit integers.

    Blocks are decoded independently of each other; checksums of the parts of a document are joined arithmetically.
    """
    blocks = read_blocks(spark, path)
    kind = blocks.schema["documents"].dataType.elementType["doc_id"].dataType.simpleString()
    parts_schema = f"file int, number int, doc_id {kind}, block int, at long, n long, crc long"

    def parts(batches):
        import pyarrow as pa

        for batch in batches:
            columns = {name: batch.column(batch.schema.get_field_index(name)) for name in batch.schema.names}
            for i in range(batch.num_rows):
                raw = unpack(columns["payload"][i].as_py()).tobytes()
                file, block, first = (columns[c][i].as_py() for c in ("file", "block", "first_id"))
                found = columns["documents"][i].as_py()
                crcs = [zlib.crc32(raw[4 * d["start"] : 4 * (d["start"] + d["n_ids"])]) for d in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * len(found), pa.int32()), pa.array([d["number"] for d in found], pa.int32()),
                        pa.array([d["doc_id"] for d in found], columns["documents"].type.value_type.field("doc_id").type),
                        pa.array([block] * len(found), pa.int32()), pa.array([first + d["start"] for d in found], pa.int64()),
                        pa.array([d["n_ids"] for d in found], pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    names=["file", "number", "doc_id", "block", "at", "n", "crc"],
                )

    def joined(batches):
        import pyarrow as pa

        known = {}
        for batch in batches:
            crcs = []
            if len(known) > 4096:
                known.clear()
            for pieces in batch.column(batch.schema.get_field_index("pieces")).to_pylist():
                crc = pieces[0]["crc"]
                for piece in pieces[1:]:
                    crc = join_crc32(crc, piece["crc"], 4 * piece["n"], known)
                crcs.append(crc)
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("ids"))
    before = offsets_before(totals, "file", ["ids"])
    found = blocks.mapInArrow(parts, parts_schema)
    whole = found.groupBy("file", "number").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"),
    )
    # one row for each file
    placed = whole.join(F.broadcast(before), "file").select("doc_id", (F.col("ids_before") + F.col("at")).alias("start"), "n_tokens", "pieces")
    return placed.mapInArrow(joined, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def op7_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), default_vocabulary(), path)
    return document_digests(spark, path)
