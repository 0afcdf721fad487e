"""Language-model score of a text: the probability of all its segmentations into subwords of an existing vocabulary.

A text is a sequence of pieces drawn one by one from a unigram distribution over the vocabulary and one end sign. The same text comes
from many sequences; its probability is the sum over all of them, which a forward recursion over the lattice of pieces gives without
listing any. A word is spelled with a space before it and no piece holds a space but as its first byte, so the lattice of a
document falls into those of its words, and the recursion runs once for each distinct word of the corpus instead of once per
occurrence. The pieces are those of a public vocabulary; their weights start from its scores and are re-estimated on the training
documents by forward-backward (expected counts over all segmentations).

Words reach their documents through chunks: documents are taken in chunks of bounded size, each with its list of distinct words, so
a word crosses the network once per chunk however often it occurs there, and no list of all words is ever in one place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table

#: Bytes of text after which a chunk of documents is closed; a longer document is a chunk of its own.
CHUNK_BYTES = 16 << 20
#: Rounds of forward-backward over the distinct words, and what is added to each piece's expected count.
ROUNDS, SMOOTHING = 2, 0.1
#: A larger vocabulary is refused: it is broadcast.
MAX_PIECES = 1 << 18
#: Bytes of words that are taken through the lattice together; a word longer than ``SPAN`` goes alone.
BATCH_BYTES, SPAN = 1 << 18, 1024


def read_pieces(path: str) -> list[tuple[bytes, float]]:
    """``(bytes, rank)`` of the pieces of a sentencepiece model, best score first.

    The mark of a word's beginning reads as a space. Control signs and pieces with a space behind their first byte are left out:
    they cannot occur inside a word. Pieces of equal bytes count once, with the better score.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            continue
        name = model.id_to_piece(k)
        piece = bytes([int(name[3:5], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode()
        if b" " not in piece[1:]:
            # single bytes have no score of their own: they come last
            score = -math.inf if model.is_byte(k) else model.get_score(k)
            found[piece] = max(score, found.get(piece, -math.inf))
    ordered = sorted(found, key=lambda p: (-found[p], p))
    return [(p, float(rank)) for rank, p in enumerate(ordered)]


def default_pieces() -> list[tuple[bytes, float]]:
    import public_tokenizers

    return read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


class Lattice:
    """The pieces as a trie in arrays, and recursions over the arcs (start, end, piece) of many words at once."""

    def __init__(self, pieces: list[bytes]):
        if len(pieces) > MAX_PIECES:
            raise ValueError(f"a vocabulary of more than {MAX_PIECES} pieces")
        if missing := [b for b in range(256) if bytes([b]) not in set(pieces)]:
            raise ValueError(f"the vocabulary must hold every single byte; it lacks {len(missing)}")
        step: dict[int, int] = {}
        accepts = [-1]
        for k, piece in enumerate(pieces):
            state = 0
            for byte in piece:
                key = state << 8 | byte
                if key not in step:
                    step[key] = len(accepts)
                    accepts.append(-1)
                state = step[key]
            accepts[state] = k
        self.step, self.accepts, self.size = step, accepts, len(pieces)
        self.keys = np.array(sorted(step), np.int64)
        self.targets = np.array([step[k] for k in self.keys.tolist()], np.int64)
        self.piece_at = np.array(accepts, np.int64)
        self.first = self.targets[np.searchsorted(self.keys, np.arange(256))]

    def arcs(self, words: list[bytes]):
        """``start, end, piece`` of every piece that matches anywhere, by node; ``first`` and ``last`` node of every word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        limit = ends[word]
        begin = np.arange(len(data))
        place, state = begin + 1, self.first[data]
        starts, stops, pieces = [], [], []
        while len(begin):
            hit = self.piece_at[state]
            held = hit >= 0
            starts.append(begin[held])
            stops.append(place[held])
            pieces.append(hit[held])
            going = place < limit[begin]
            begin, place, state = begin[going], place[going], state[going]
            if not len(begin):
                break
            key = state << 8 | data[place]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            begin, place, state = begin[known], place[known] + 1, self.targets[at[known]]
        start, end, piece = map(np.concatenate, (starts, stops, pieces))
        own = word[start]
        # a word of n bytes has n + 1 nodes
        low = ends - sizes + np.arange(len(words))
        return start + own, end + own, piece, low, low + sizes, own

    @staticmethod
    def _sweep(order: np.ndarray, level: np.ndarray, into: np.ndarray, out_of: np.ndarray, weight: np.ndarray, values: np.ndarray) -> None:
        """``values[into] = log sum exp(values[out_of] + weight)``, level by level; arcs of equal ``into`` have equal level."""
        into, out_of, weight, level = into[order], out_of[order], weight[order], level[order]
        new = np.flatnonzero(np.r_[True, into[1:] != into[:-1]])
        counts = np.diff(np.r_[new, len(into)])
        group_level = level[new]
        cuts = np.searchsorted(group_level, np.arange(1, int(group_level[-1]) + 2))
        for g, h in zip(cuts[:-1], cuts[1:]):
            if g == h:
                continue
            i, j = new[g], new[h] if h < len(new) else len(into)
            x = values[out_of[i:j]] + weight[i:j]
            heads = new[g:h] - i
            top = np.maximum.reduceat(x, heads)
            values[into[new[g:h]]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, counts[g:h])), heads))

    def _forward(self, found, weight: np.ndarray) -> np.ndarray:
        start, end, _, low, last, own = found
        alpha = np.zeros(int(last[-1]) + 1)
        level = end - low[own]
        self._sweep(np.lexsort((end, level)), level, end, start, weight, alpha)
        return alpha

    def log_probabilities(self, words: list[bytes], log_p: np.ndarray) -> np.ndarray:
        """Marginal log probability of each word over all its segmentations; words must not be empty."""
        out = np.empty(len(words))
        for chosen in batches_of(words):
            if len(words[chosen[0]]) > SPAN:
                out[chosen[0]] = self.long_word(words[chosen[0]], log_p)
            else:
                found = self.arcs([words[k] for k in chosen])
                out[chosen] = self._forward(found, log_p[found[2]])[found[4]]
        return out

    def long_word(self, word: bytes, log_p: np.ndarray) -> float:
        """The same recursion for one word of any length, holding as many nodes as the longest piece has bytes."""
        step, accepts, weight = self.step, self.accepts, log_p.tolist()
        open_nodes: dict[int, list[float]] = {0: [0.0]}
        for i in range(len(word)):
            terms = open_nodes.pop(i)
            top = max(terms)
            value = top + math.log(math.fsum(math.exp(t - top) for t in terms))
            state, place = 0, i
            while place < len(word):
                state = step.get(state << 8 | word[place], 0)
                if not state:
                    break
                place += 1
                if accepts[state] >= 0:
                    open_nodes.setdefault(place, []).append(value + weight[accepts[state]])
        terms = open_nodes[len(word)]
        top = max(terms)
        return top + math.log(math.fsum(math.exp(t - top) for t in terms))

    def expected_counts(self, words: list[bytes], counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """How often each piece is expected in ``counts`` copies of each word. A word longer than ``SPAN`` is taken in parts of that length."""
        total = np.zeros(self.size)
        parts, times = [], []
        for word, n in zip(words, counts.tolist()):
            for i in range(0, len(word), SPAN):
                parts.append(word[i : i + SPAN])
                times.append(n)
        times = np.array(times, np.float64)
        for chosen in batches_of(parts):
            found = start, end, piece, low, last, own = self.arcs([parts[k] for k in chosen])
            weight = log_p[piece]
            alpha = self._forward(found, weight)
            beta = np.zeros(len(alpha))
            level = last[own] - start
            self._sweep(np.lexsort((start, level)), level, start, end, weight, beta)
            share = np.exp(alpha[start] + weight + beta[end] - alpha[last][own])
            total += np.bincount(piece, share * times[chosen][own], minlength=self.size)
        return total


def batches_of(words: list[bytes]):
    """Indices of words in batches of at most ``BATCH_BYTES``, shortest words first; a word longer than ``SPAN`` is a batch."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    batch, held = [], 0
    for k in order:
        size = len(words[k])
        if batch and (held + size > BATCH_BYTES or size > SPAN):
            yield np.array(batch)
            batch, held = [], 0
        batch.append(k)
        held += size
    if batch:
        yield np.array(batch)


@dataclass(frozen=True)
class Weights:
    """Natural logarithms of the probabilities of the pieces and of the end of a text; they add up to 1."""

    pieces: list[bytes]
    log_p: np.ndarray
    log_end: float


def start_weights(pieces: list[tuple[bytes, float]]) -> Weights:
    """Weights by the vocabulary's own order: the probability of a piece falls with its rank, the end counts like the first piece."""
    share = np.array([1.0 / (2.0 + rank) for _, rank in pieces])
    total = share.sum() + 0.5
    return Weights([p for p, _ in pieces], np.log(share / total), math.log(0.5 / total))


def split_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A written table of two kinds of rows, by ``chunk``: words (``word, place, learned``) and documents (the others).

    ``learned`` counts the word in the chunk's documents where ``learn`` holds. A document has its distinct words as places in
    the chunk's list and how often it has each (32-bit integers). Texts are lower-cased in A-Z and cut at white space.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), docs[id_col].alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), text.alias("text"))
    names = ["chunk", "word", "place", "learned", "doc_id", "learn", "n_tokens", "places", "times"]

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        def word_rows(chunk, places, learned, id_type):
            n = len(places)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * n, pa.int64()), pa.array(list(places), pa.binary()), pa.array(range(n), pa.int32()), pa.array(learned, pa.int64()),
                    pa.nulls(n, id_type), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )

        chunk, places, learned, held = None, {}, [], 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(1).type
            chunks, tokens, codes, times = [], [], [], []
            full = []
            for part, learn, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                raw = text.as_py()
                if chunk is None:
                    chunk = part << 32
                elif held and held + len(raw) > chunk_bytes:
                    full.append(word_rows(chunk, places, learned, id_type))
                    chunk, places, learned, held = chunk + 1, {}, [], 0
                held += len(raw)
                found = Counter(raw.lower().split())
                own = np.fromiter((places.setdefault(w, len(places)) for w in found), np.int32, len(found))
                n = np.fromiter(found.values(), np.int32, len(found))
                learned.extend([0] * (len(places) - len(learned)))
                if learn:
                    for at, k in zip(own.tolist(), n.tolist()):
                        learned[at] += k
                chunks.append(chunk)
                tokens.append(int(n.sum()) + 1)
                codes.append(own.tobytes())
                times.append(n.tobytes())
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunks, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                    batch.column(1), batch.column(2), pa.array(tokens, pa.int64()), pa.array(codes, pa.binary()), pa.array(times, pa.binary()),
                ],
                names=names,
            )
            yield from full
        if places:
            yield word_rows(chunk, places, learned, id_type)

    schema = f"chunk long, word binary, place int, learned long, doc_id {kind}, learn boolean, n_tokens long, places binary, times binary"
    return materialise(rows.mapInArrow(run, schema), "lattice")


def count_words(split: DataFrame) -> DataFrame:
    """``word, c`` of every distinct word: how often the training documents have it (0: only others do). Partial sums before the shuffle."""
    return materialise(split.filter("word IS NOT NULL").groupBy("word").agg(F.sum("learned").alias("c")), "words")


def _held(shared):
    """The lattice of a broadcast vocabulary, built once in each worker."""
    value = shared.value
    if "lattice" not in value:
        value["lattice"] = Lattice(value["pieces"])
    return value["lattice"]


def learn_weights(words: DataFrame, ends: int, start: Weights, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> Weights:
    """Weights after ``rounds`` of forward-backward over all distinct training words, each counted as often as it occurs.

    A task sends back one expected count per piece it met, at most the size of the vocabulary. Without any training word or
    document the weights stay as they are.
    """
    spark = words.sparkSession
    seen = words.filter("c > 0")
    if not ends:
        return start
    pieces = spark.sparkContext.broadcast({"pieces": start.pieces})
    weights = start
    for _ in range(rounds):
        log_p = weights.log_p

        def run(batches, log_p=log_p):
            import pyarrow as pa

            lattice, total = _held(pieces), None
            for batch in batches:
                spelled = [b" " + w for w in batch.column(0).to_pylist()]
                found = lattice.expected_counts(spelled, batch.column(1).to_numpy(), log_p)
                total = found if total is None else total + found
            if total is not None:
                met = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met])], names=["piece", "n"])

        sums = seen.select("word", "c").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.full(len(start.pieces), smoothing)
        for row in sums.collect():
            expected[row["piece"]] += row["n"]
        total = expected.sum() + ends
        weights = Weights(start.pieces, np.log(expected / total), math.log(ends / total))
    return weights


def score_words(words: DataFrame, weights: Weights) -> DataFrame:
    """``word, c, log_p``: the marginal probability of each distinct word as a natural logarithm, written."""
    shared = words.sparkSession.sparkContext.broadcast({"pieces": weights.pieces, "log_p": weights.log_p})

    def run(batches):
        import pyarrow as pa

        lattice, log_p = _held(shared), shared.value["log_p"]
        for batch in batches:
            found = lattice.log_probabilities([b" " + w for w in batch.column(0).to_pylist()], log_p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["word", "c", "log_p"])

    return materialise(words.select("word", "c").mapInArrow(run, "word binary, c long, log_p double"), "scored")


def lattice_scores(
    docs: DataFrame, learn: Column, pieces: list[tuple[bytes, float]], id_col: str = "doc_id", text_col: str = "text",
    rounds: int = ROUNDS, smoothing: float = SMOOTHING, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    ``learn`` marks the training documents (null: not one). Tokens are words, and one end per document. ``base_score`` is the sum
    over tokens of log10((c + 1) / (N + V + 1)) with c the token's count, N all and V the distinct tokens of the training documents;
    ``n_known`` counts tokens with c > 0. ``score`` is the log10 of the probability of the text (A-Z lower-cased, one space between
    words) over all its segmentations, the end included. Both are what a document of no words has left: its end. Null texts count as
    empty, repeated rows are documents of their own, null ids are kept, an empty table gives no rows; other columns are not read.
    """
    split = split_documents(docs, learn, id_col, text_col, chunk_bytes)
    words = count_words(split)
    documents = split.filter("places IS NOT NULL")
    ends = documents.filter("learn").count()
    of_words = words.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    train_tokens, distinct = of_words["n"] + ends, of_words["v"] + (ends > 0)
    weights = learn_weights(words, ends, start_weights(pieces), rounds, smoothing)
    scored = score_words(words, weights)
    log_all, log_end = math.log10(train_tokens + distinct + 1), weights.log_end / math.log(10)

    own = split.filter("word IS NOT NULL").select("chunk", "word", "place")
    delivered = own.join(scored, "word").select(F.col("chunk").alias("to_chunk"), "place", "c", "log_p")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(left, right):
        import pyarrow as pa

        place = right.column("place").to_numpy()
        count, log_p = np.zeros(len(place), np.int64), np.zeros(len(place))
        count[place], log_p[place] = right.column("c").to_numpy(), right.column("log_p").to_numpy()
        base, log_p = np.log10(count + 1.0), log_p / math.log(10)
        known, bases, scores = [], [], []
        for places, times, tokens in zip(left.column("places"), left.column("times"), left.column("n_tokens").to_pylist()):
            at, n = np.frombuffer(places.as_py(), np.int32), np.frombuffer(times.as_py(), np.int32).astype(np.int64)
            known.append(int(n[count[at] > 0].sum()) + (ends > 0))
            bases.append(float(n @ base[at]) + math.log10(ends + 1) - tokens * log_all)
            scores.append(float(n @ log_p[at]) + log_end)
        return pa.Table.from_arrays(
            [
                left.column("doc_id"), left.column("learn"), left.column("n_tokens"), pa.array(known, pa.int64()),
                pa.array([train_tokens] * len(known), pa.int64()), pa.array(bases, pa.float64()), pa.array(scores, pa.float64()),
            ],
            names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    sides = documents.select("chunk", "doc_id", "learn", "n_tokens", "places", "times").groupBy("chunk").cogroup(delivered.groupBy("to_chunk"))
    return sides.applyInArrow(run, f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op13_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, scored by a model of those whose crc32(doc_id) mod 7 is not 2; a document without an id is held out of nothing."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = lattice_scores(docs, ~held_out, default_pieces())
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
