"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its incremental decoder.

A merge list has a finite *sufficient lookahead*: a number of bytes such that no continuation of a text can change a token that
ends at least that far before the end of what is known. The encoder holds a window of a few times this size, merges it, emits
the tokens that can no longer change and goes on behind them, so a run of letters of any length needs constant memory.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import table

#: The pre-tokenizer's pattern for byte-level vocabularies, with places for letters, numbers and white space.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: Up to here Unicode versions agree about what a letter is; texts with later characters are cut by the tokenizers library itself.
SETTLED = 0x557
#: Characters of a text that are cut into pieces at once.
CHUNK = 1 << 16
#: Pieces up to this many bytes are remembered, in two generations of at most so many.
SHORT, REMEMBERED = 48, 300_000
#: A vocabulary file is broadcast to executors; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def settled(kind: str) -> str:
    """The characters of a general category as the inside of a character class, up to ``SETTLED``."""
    return "".join(re.escape(chr(c)) for c in range(SETTLED + 1) if unicodedata.category(chr(c))[0] == kind)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes at the end of a known text whose tokens more text may still change.

    Compare a text with a continuation of it. Left of some frontier both have the same tokens; it starts at the end of the known
    text. Only a merge across the frontier moves it: left by the length of the merge's left part, which then begins what stands
    right of the frontier in both. So a later merge can only move it on if its right part begins with that left part. The longest
    such chain of merges in order of rank bounds the way of the frontier.
    """
    reach: dict[bytes, int] = {}
    most = 0
    for left, right in merges:
        behind = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        way = len(left) + behind
        most = max(most, way)
        if way > reach.get(left, 0):
            reach[left] = way
    return most


class Transducer:
    """Encoder and decoder for one byte-level vocabulary, given as the text of its JSON file."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model, before, after = spec["model"], spec["pre_tokenizer"], spec["decoder"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or after["type"] != "ByteLevel":
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        table = byte_of_char()
        raw = lambda token: bytes(map(table.__getitem__, token))
        ids = {raw(token): i for token, i in model["vocab"].items()}
        added = {}
        for token in spec["added_tokens"]:
            if token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"added token {token['content']!r} needs an unsupported rule")
            added[token["content"]] = token["id"]
        pairs = [(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merges = [(raw(a), raw(b)) for a, b in pairs]
        #: pair of ids, as one number -> rank and merged id, as one number
        self.rules = {ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for rank, (a, b) in enumerate(self.merges)}
        self.first = [ids[bytes([b])] for b in range(256)]
        size = 1 + max(chain(ids.values(), added.values()))
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = token
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.length_of = list(map(len, self.bytes_of))
        self.size = size
        self.added = added
        # of added tokens that begin at one place the longest counts
        longest_first = sorted(added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self.pattern = re.compile(PIECES.format(L=settled("L"), N=settled("N"), S=r"\t-\r \x85\xa0"))
        self.unsettled = re.compile(rf"[^\x00-\u{SETTLED:04x}]")
        self.lookahead = sufficient_lookahead(self.merges)
        self.window = 2 * (self.lookahead + max(self.length_of)) + 4096
        self.known: dict[str, list[int]] = {}
        self.known_before: dict[str, list[int]] = {}
        self.splitter = None

    # pieces

    def merge_short(self, data: bytes) -> list[int]:
        """All merges of a short piece, by rank and from the left."""
        ids = list(map(self.first.__getitem__, data))
        rules, none = self.rules.get, 1 << 62
        ranked = [rules(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranked and (best := min(ranked)) != none:
            i = ranked.index(best)
            ids[i : i + 2] = [merged := best & 0xFFFFFFFF]
            del ranked[i]
            if i:
                ranked[i - 1] = rules(ids[i - 1] << 32 | merged, none)
            if i < len(ranked):
                ranked[i] = rules(merged << 32 | ids[i + 1], none)
        return ids

    def merge_window(self, data: bytes) -> list[int]:
        """The same for a long piece, with a heap of possible merges and links between neighbours."""
        ids = [self.first[b] for b in data]
        n, rules = len(ids), self.rules.get
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r >> 32, i, ids[i], ids[i + 1], r & 0xFFFFFFFF) for i in range(n - 1) if (r := rules(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = following[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (r := rules(merged << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r >> 32, i, merged, ids[k], r & 0xFFFFFFFF))
            if (h := before[i]) >= 0 and (r := rules(ids[h] << 32 | merged)) is not None:
                heapq.heappush(heap, (r >> 32, h, ids[h], merged, r & 0xFFFFFFFF))
        return [i for i in ids if i >= 0]

    def stream(self, blocks: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one piece that arrives in blocks, each list as soon as no further byte can change it."""
        held = b""
        for block in blocks:
            held += block
            while len(held) >= self.window:
                ids, end, count = self.merge_window(held[: self.window]), 0, 0
                stable = self.window - self.lookahead
                # where nothing merges all of them are stable
                while count < len(ids) and end + self.length_of[ids[count]] <= stable:
                    end += self.length_of[ids[count]]
                    count += 1
                yield ids[:count]
                held = held[end:]
        if held:
            yield self.merge_window(held)

    def piece(self, text: str) -> list[int]:
        """Ids of one piece; short ones are remembered."""
        if (ids := self.known.get(text)) is not None:
            return ids
        if (ids := self.known_before.get(text)) is None:
            data = text.encode()
            if len(data) > SHORT:
                step = self.window
                return list(chain.from_iterable(self.stream(data[i : i + step] for i in range(0, len(data), step))))
            ids = self.merge_short(data)
        if len(self.known) >= REMEMBERED:
            self.known_before, self.known = self.known, {}
        self.known[text] = ids
        return ids

    # texts

    def cuts(self, text: str) -> Iterator[str]:
        """Parts of about ``CHUNK`` characters. Between a visible character and white space a piece always ends."""
        start, n = 0, len(text)
        while n - start > CHUNK:
            end = start + CHUNK
            while end < n and not (text[end].isspace() and not text[end - 1].isspace()):
                end += 1
            yield text[start:end]
            start = end
        yield text[start:]

    def pieces(self, part: str) -> list[str]:
        if not self.unsettled.search(part):
            return self.pattern.findall(part)
        if self.splitter is None:
            from tokenizers import pre_tokenizers

            self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, in lists of bounded size. Strings of added tokens become these tokens."""
        start = 0
        for match in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[start : match.start()])
            yield [self.added[match[0]]]
            start = match.end()
        yield from self._plain(text[start:] if start else text)

    def _plain(self, text: str) -> Iterator[list[int]]:
        piece = self.piece
        for part in self.cuts(text) if text else ():
            known = self.known.get
            yield list(chain.from_iterable([known(p) or piece(p) for p in self.pieces(part)]))

    def decoder(self) -> Decoder:
        return Decoder(self.bytes_of)


class Decoder:
    """Ids to text, list by list: a character whose bytes are not complete waits for the next ids."""

    def __init__(self, bytes_of: list[bytes]):
        self.bytes_of = bytes_of
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", True)


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read where the job is started; its size is checked, as every executor gets a copy."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return text


def share(spark: SparkSession, vocabulary: str) -> Broadcast:
    """Broadcast a vocabulary, in a dictionary to which a Python worker adds its encoder for the tasks that follow there."""
    return spark.sparkContext.broadcast({"vocabulary": vocabulary})


def coder_of(shared: Broadcast) -> Transducer:
    held = shared.value
    if "coder" not in held:
        held["coder"] = Transducer(held["vocabulary"])
    return held["coder"]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text as little-endian unsigned 32-bit integers in one binary value.

    Null and empty texts have no ids. Null and repeated ids are kept as they are, row by row; other columns are not read.
    """
    shared = share(docs.sparkSession, vocabulary)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        coder = coder_of(shared)
        for batch in batches:
            out = [b"".join(np.array(ids, "<u4").tobytes() for ids in coder.encode(text.as_py() or "")) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` as ``encode_documents`` makes them; bytes that are no UTF-8 become U+FFFD."""
    shared = share(encoded.sparkSession, vocabulary)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        coder = coder_of(shared)
        for batch in batches:
            out = []
            for ids in batch.column(1):
                decoder = coder.decoder()
                out.append(decoder.feed(np.frombuffer(ids.as_py() or b"", "<u4").tolist()) + decoder.end())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text: the digests of ``encode_documents`` and
    ``decode_documents``, taken while ids stream from the encoder through the decoder, so that neither is ever held whole.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the decoded text in UTF-8. Null counts as empty.
    """
    shared = share(docs.sparkSession, vocabulary)

    def run(batches):
        import pyarrow as pa

        coder = coder_of(shared)
        decimal = list(map(str, range(coder.size)))
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for text in batch.column(1):
                n, ids_hash, text_hash, decoder, comma = 0, hashlib.sha256(), hashlib.sha256(), coder.decoder(), ""
                for ids in coder.encode(text.as_py() or ""):
                    n += len(ids)
                    ids_hash.update((comma + ",".join(map(decimal.__getitem__, ids))).encode())
                    text_hash.update(decoder.feed(ids).encode())
                    comma = ","
                text_hash.update(decoder.end().encode())
                counts.append(n)
                ids_hex.append(ids_hash.hexdigest())
                text_hex.append(text_hash.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return columns.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> str:
    import public_tokenizers

    return read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_vocabulary())
