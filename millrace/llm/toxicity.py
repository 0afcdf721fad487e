"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels say only whether a whole document is toxic. Tokens are labelled from them: in toxic documents, those with a feature (the
word, a beginning or an ending of it) that occurs in toxic documents far beyond chance. The field is fitted to these tokens, so it
also weighs features and neighbours that no single count decides; its forward-backward marginals give spans and the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.language import held_out

#: Bounds of the labelled sample: toxic and clean documents, and bytes of all texts of either kind.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 6000
TOXIC_BYTES, CLEAN_BYTES = 8 << 20, 24 << 20
#: Rounds of fitting.
FIT_ROUNDS = 40
#: Momentum, and the pull of all weights to zero.
MOMENTUM, PULL = 0.7, 0.1
MAX_FEATURES = 50_000
PREFIXES, SUFFIX = (3, 4, 5, 6), 3
#: Least log ratio of a feature's share in toxic to that in clean documents for it to label tokens.
LOG_RATIO = 3.0
TOKENS = r"[^\W\d_]+"
#: Tokens whose marginals are computed at once, and steps of one block of them.
CHUNK_TOKENS, BLOCK = 400_000, 64
REMEMBERED = 400_000
#: Documents of the sample that are scored at once.
SCORED_DOCS = 200
LIMIT = 30.0


def features(token: str) -> list[str]:
    word = token.lower()
    found = ["w" + word, "s" + word[-SUFFIX:]]
    found += ["p" + word[:k] for k in PREFIXES if len(word) >= k]
    return found


@dataclass
class Field:
    """Weights in favour of state 1 (toxic); ``moves[i][j]`` is the weight of state j after i, ``start`` that of a first token."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -10.0
    moves: tuple = ((0.0, 0.0), (0.0, 0.0))
    start: tuple = (0.0, 0.0)
    #: Of the document score: constant, largest marginal, log of the expected number of toxic tokens.
    score: tuple = (-4.0, 0.0, 0.0)

    def emission(self, token: str) -> float:
        get = self.weights.get
        return max(-LIMIT, min(LIMIT, self.bias + sum([get(f, 0.0) for f in features(token)])))


class Emissions(dict):
    """Emissions by token as written, computed once and forgotten together when there are too many."""

    def __init__(self, model: Field):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value = self.model.emission(token)
        return value


def marginals(emissions, first, model: Field):
    """Probability of state 1 for every token, and of both states for each pair (previous, own), summed over all pairs.

    ``emissions`` holds the tokens of whole documents in a row, ``first`` marks the first token of each. A first token's transfer
    matrix has equal rows: nothing passes it, so one pass serves all documents. Tokens are laid out in blocks; the products of
    blocks are found side by side, chained, and the messages within blocks again side by side.
    """
    import numpy as np

    n = len(emissions)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    rows = -(-n // BLOCK)
    width = rows * BLOCK
    x = np.zeros(width)
    x[:n] = emissions
    new = np.ones(width, bool)
    new[:n] = first
    on = np.exp(x)
    (m00, m01), (m10, m11) = np.exp(np.array(model.moves))
    s0, s1 = np.exp(np.array(model.start))
    # transfer[i][j][token], laid out as step by block
    lay = lambda v: np.ascontiguousarray(v.reshape(rows, BLOCK).T)
    t00, t10 = lay(np.where(new, s0, m00)), lay(np.where(new, s0, m10))
    t01, t11 = lay(np.where(new, s1, m01) * on), lay(np.where(new, s1, m11) * on)

    p00, p01, p10, p11 = t00[0], t01[0], t10[0], t11[0]
    for k in range(1, BLOCK):
        a, b, c, d = t00[k], t01[k], t10[k], t11[k]
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    ahead, behind = np.empty((2, rows)), np.empty((2, rows))
    u0, u1 = 0.5, 0.5
    products = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist()))
    for r, (a, b, c, d) in enumerate(products):
        ahead[0, r], ahead[1, r] = u0, u1
        u0, u1 = u0 * a + u1 * c, u0 * b + u1 * d
        u0, u1 = u0 / (u0 + u1), u1 / (u0 + u1)
    v0, v1 = 0.5, 0.5
    for r in range(rows - 1, -1, -1):
        behind[0, r], behind[1, r] = v0, v1
        a, b, c, d = products[r]
        v0, v1 = a * v0 + b * v1, c * v0 + d * v1
        v0, v1 = v0 / (v0 + v1), v1 / (v0 + v1)

    f0, f1 = np.empty((BLOCK + 1, rows)), np.empty((BLOCK + 1, rows))
    f0[0], f1[0] = ahead
    for k in range(BLOCK):
        g0, g1 = f0[k] * t00[k] + f1[k] * t10[k], f0[k] * t01[k] + f1[k] * t11[k]
        scale = 1 / (g0 + g1)
        f0[k + 1], f1[k + 1] = g0 * scale, g1 * scale
    b0, b1 = behind
    out, pairs = np.empty((BLOCK, rows)), np.zeros((2, 2))
    counted = lay(~new)
    for k in range(BLOCK - 1, -1, -1):
        w0, w1 = f0[k + 1] * b0, f1[k + 1] * b1
        out[k] = w1 / (w0 + w1)
        q00, q01, q10, q11 = f0[k] * t00[k] * b0, f0[k] * t01[k] * b1, f1[k] * t10[k] * b0, f1[k] * t11[k] * b1
        share = counted[k] / (q00 + q01 + q10 + q11)
        pairs += [[(q00 * share).sum(), (q01 * share).sum()], [(q10 * share).sum(), (q11 * share).sum()]]
        b0, b1 = t00[k] * b0 + t01[k] * b1, t10[k] * b0 + t11[k] * b1
        scale = 1 / (b0 + b1)
        b0, b1 = b0 * scale, b1 * scale
    return np.ascontiguousarray(out.T).reshape(-1)[:n], pairs


#: Fewer toxic documents than this tell nothing about a feature.
LEAST_TOXIC = 3


def telling_features(split: list[tuple[list[str], bool]]) -> tuple[set[str], Counter]:
    """Features that label tokens of toxic documents, and in how many documents each feature of toxic documents occurs.

    A feature tells when its share is ``exp(LOG_RATIO)`` times as large among toxic documents and the likelihood ratio against
    chance exceeds the log of the number of features. Features of clean documents are counted only where they matter.
    """
    toxic = Counter()
    for tokens, is_toxic in split:
        if is_toxic:
            toxic.update({f for t in set(tokens) for f in features(t)})
    n_features = len(toxic) + 2
    toxic = Counter({f: n for f, n in toxic.items() if n >= LEAST_TOXIC})
    clean = Counter()
    for tokens, is_toxic in split:
        if not is_toxic:
            clean.update({f for t in set(tokens) for f in features(t) if f in toxic})
    n_toxic = sum(is_toxic for _, is_toxic in split)
    n_clean = len(split) - n_toxic
    if not n_toxic or not n_clean:
        return set(), toxic
    least, base, telling = math.log(n_features), n_toxic / (n_toxic + n_clean), set()
    for f, a in toxic.items():
        c = clean[f]
        ratio = math.log((a + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        share = a / (a + c)
        if ratio >= LOG_RATIO and a * math.log(share / base) + (c * math.log((1 - share) / (1 - base)) if c else 0.0) > least:
            telling.add(f)
    return telling, toxic + clean


def without_copies(split: list[tuple[list[str], bool]], marks: int = 24, shared: int = 6) -> list[tuple[list[str], bool]]:
    """The sample without near copies: words that a much copied text brings along would look telling.

    A document goes if, of the ``marks`` smallest checksums of its runs of three tokens, at least ``shared`` were among those
    of documents before it.
    """
    seen: set[int] = set()
    kept = []
    for tokens, toxic in split:
        runs = {zlib.crc32(" ".join(run).encode()) for run in zip(tokens, tokens[1:], tokens[2:])}
        least = sorted(runs)[:marks]
        if sum(m in seen for m in least) < shared:
            kept.append((tokens, toxic))
        seen.update(least)
    return kept


def fit_field(texts: list[tuple[str, bool]], rounds: int = FIT_ROUNDS, chunk_tokens: int = CHUNK_TOKENS) -> Field:
    """A field and document score from labelled texts; without toxic or without clean ones, one that finds nothing.

    The field is fitted to all of them. The gradient is summed over chunks of whole documents of about ``chunk_tokens`` tokens, so
    the marginals of one chunk are in memory at a time.
    """
    import numpy as np

    one: dict[str, str] = {}
    split = without_copies([([one.setdefault(t, t) for t in re.findall(TOKENS, text)], toxic) for text, toxic in texts])
    telling, counts = telling_features(split)
    if not telling:
        return Field()
    named = dict.fromkeys(telling)
    named.update(dict.fromkeys(f for f, n in counts.most_common(MAX_FEATURES) if n > 2))
    names = {f: i for i, f in enumerate(list(named)[:MAX_FEATURES])}

    kinds: dict[str, int] = {}
    chunks, numbers, size = [], [], 0
    for i, (tokens, toxic) in enumerate(split):
        numbers.append((np.fromiter((kinds.setdefault(t.lower(), len(kinds)) for t in tokens), np.int32, len(tokens)), toxic))
        size += len(tokens)
        if size >= chunk_tokens or i == len(split) - 1:
            first = np.concatenate([np.arange(len(own)) == 0 for own, _ in numbers])
            labels = np.concatenate([np.full(len(own), toxic) for own, toxic in numbers])
            chunks.append((np.concatenate([own for own, _ in numbers]), first, labels))
            numbers, size = [], 0
    # features of each kind of word, as a ragged table
    ragged = [[names[f] for f in features(word) if f in names] for word in kinds]
    flat, owner = np.array([f for r in ragged for f in r], int), np.repeat(np.arange(len(ragged)), [len(r) for r in ragged])
    tells = np.array([any(f in telling for f in features(word)) for word in kinds])
    chunks = [(order, first, tells[order] & labels) for order, first, labels in chunks]

    seen, kind_wanted, n_wanted, n_tokens = np.zeros(len(kinds)), np.zeros(len(kinds)), 0.0, 0
    pair_counts, starts = np.zeros((2, 2)), np.zeros(2)
    for order, first, wanted in chunks:
        seen += np.bincount(order, minlength=len(kinds))
        kind_wanted += np.bincount(order[wanted], minlength=len(kinds))
        n_wanted, n_tokens = n_wanted + float(wanted.sum()), n_tokens + len(wanted)
        is_pair = ~first[1:]
        pair_counts += np.bincount(2 * wanted[:-1][is_pair] + wanted[1:][is_pair], minlength=4).reshape(2, 2)
        starts += np.bincount(wanted[first].astype(int), minlength=2)
    feature_seen = np.bincount(flat, seen[owner], len(names)) + 1.0

    # gradient ascent with momentum; a step is scaled by a bound of the curvature, to which all features of a token add
    active = 2 + len(PREFIXES) + 1
    weights, moves, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    bias = math.log((n_wanted + 1) / (n_tokens - n_wanted + 1))
    bounds = [0.25 * active * feature_seen + PULL, 0.25 * active * n_tokens, 0.25 * pair_counts.sum() / 4 + PULL, 0.25 * starts.sum() + PULL]
    speed = [np.zeros(len(names)), 0.0, np.zeros((2, 2)), np.zeros(2)]
    for _ in range(rounds):
        by_kind = np.clip(bias + np.bincount(owner, weights[flat], len(kinds)), -LIMIT, LIMIT)
        current = Field(moves=tuple(map(tuple, moves)), start=tuple(start))
        gap, pairs, now = kind_wanted.copy(), np.zeros((2, 2)), np.zeros(2)
        for order, first, _ in chunks:
            probability, own_pairs = marginals(by_kind[order], first, current)
            gap -= np.bincount(order, probability, len(kinds))
            pairs += own_pairs
            now += [(1 - probability[first]).sum(), probability[first].sum()]
        slopes = [np.bincount(flat, gap[owner], len(names)) - PULL * weights, gap.sum(), pair_counts - pairs - PULL * moves, starts - now - PULL * start]
        speed = [MOMENTUM * v + s / most for v, s, most in zip(speed, slopes, bounds)]
        weights, bias, moves, start = weights + speed[0], bias + speed[1], moves + speed[2], start + speed[3]

    kept = {f: float(weights[i]) for f, i in names.items() if abs(weights[i]) > 1e-3}
    model = Field(kept, float(bias), tuple(map(tuple, moves.tolist())), tuple(start.tolist()))
    model.score = fit_score(model, split)
    return model


def document_measures(model: Field, documents: list[list[str]], emissions: Emissions | None = None):
    """Per document the largest marginal and the expected number of toxic tokens; and the marginals, document by document."""
    import numpy as np

    get = (Emissions(model) if emissions is None else emissions).__getitem__
    parts = [np.fromiter(map(get, tokens), float, len(tokens)) for tokens in documents]
    lengths = np.array([len(p) for p in parts])
    ends = np.cumsum(lengths)
    first = np.zeros(int(lengths.sum()), bool)
    first[(ends - lengths)[lengths > 0]] = True
    probability, _ = marginals(np.concatenate(parts) if parts else np.zeros(0), first, model)
    split = np.split(probability, ends[:-1]) if len(ends) else []
    return [(float(p.max()), float(p.sum())) if len(p) else (0.0, 0.0) for p in split], split


def fit_score(model: Field, split: list[tuple[list[str], bool]], rounds: int = 25) -> tuple:
    """Logistic weights for the document score, by Newton's method with a weak pull to zero."""
    import numpy as np

    emissions, measures = Emissions(model), []
    for i in range(0, len(split), SCORED_DOCS):
        measures += document_measures(model, [tokens for tokens, _ in split[i : i + SCORED_DOCS]], emissions)[0]
    x = np.array([[1.0, top, math.log1p(total)] for top, total in measures])
    y = np.array([float(toxic) for _, toxic in split])
    w = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -LIMIT, LIMIT)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.01, 0.1, 0.1])
        w = w + np.clip(np.linalg.solve(curve, x.T @ (y - p) - np.array([0.01, 0.1, 0.1]) * w), -2, 2)
    return tuple(w.tolist())


def learn_field(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN, toxic_bytes: int = TOXIC_BYTES, clean_bytes: int = CLEAN_BYTES,
) -> Field:
    """Fit to a bounded sample: of each label the rows with the smallest hash of their id, without those held out.

    A document labelled more than once is toxic if any label says so; null labels and ids teach nothing. The sample is bounded in
    documents and in bytes: sampled documents are taken in the order of their hash, whole, leaving out those that no longer fit. So
    a document may be as long as the bound. The sample is bounded, so it is broadcast to the two scans of the documents, the first
    of lengths only.
    """
    named = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("toxic")).dropna()
    known = named.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda wanted, n: known.filter(F.col("toxic") == wanted).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = pick(1, sample_toxic).unionByName(pick(0, sample_clean))
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("bytes")).dropna().join(F.broadcast(sample), "doc_id")
    sized = sizes.groupBy("doc_id", "toxic").agg(F.sum("bytes").alias("bytes")).withColumn("order", F.xxhash64("doc_id"))
    left, fitting = {1: toxic_bytes, 0: clean_bytes}, []
    for row in sorted(sized.collect(), key=lambda r: (r["order"], r["doc_id"])):
        if row["bytes"] <= left[row["toxic"]]:
            left[row["toxic"]] -= row["bytes"]
            fitting.append((row["doc_id"], row["toxic"]))
    # at most sample_toxic + sample_clean rows
    chosen = docs.sparkSession.createDataFrame(fitting, sample.schema)
    found = rows.dropna().join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    texts = sorted((r["doc_id"], r["text"], r["toxic"] == 1) for r in found.toLocalIterator())
    return fit_field([(text, toxic) for _, text, toxic in texts])


def score_toxicity(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted, spans`` of every whole text.

    ``spans`` lists ``start, end, probability`` of the runs of tokens that are toxic with at least ``threshold``, as character
    offsets of the text; tokens of a run that only white space and signs part are one span. Null texts and texts without letters
    have the score of a document in which nothing was found. Only the text is read; repeated rows get equal results.
    """
    # bounded by MAX_FEATURES
    shared = docs.sparkSession.sparkContext.broadcast({"model": vars(model)})

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = shared.value
        if "emissions" not in held:
            held["emissions"] = Emissions(Field(**held["model"]))
        emissions, words = held["emissions"], re.compile(TOKENS)
        model = emissions.model
        constant, by_top, by_total = model.score
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

        def spans(text, probability):
            found, last = [], -2
            hot = np.flatnonzero(probability >= threshold).tolist()
            if hot:
                places = {i: m.span() for i, m in enumerate(words.finditer(text)) if probability[i] >= threshold}
                for i in hot:
                    if i == last + 1:
                        found[-1]["end"] = places[i][1]
                        found[-1]["probability"] = max(found[-1]["probability"], float(probability[i]))
                    else:
                        found.append({"start": places[i][0], "end": places[i][1], "probability": float(probability[i])})
                    last = i
            return found

        def scored(ids, texts, tokens):
            measures, split = document_measures(model, tokens, emissions)
            scores = [1 / (1 + math.exp(-max(-LIMIT, min(LIMIT, constant + by_top * top + by_total * math.log1p(total))))) for top, total in measures]
            marked = [spans(text, p) if top >= threshold else [] for text, p, (top, _) in zip(texts, split, measures)]
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(marked, span)],
                names=["doc_id", "score", "predicted", "spans"],
            )

        for batch in batches:
            start, texts, tokens, n = 0, [], [], 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                tokens.append(words.findall(texts[-1]))
                n += len(tokens[-1])
                if n >= CHUNK_TOKENS:
                    yield scored(batch.column(0)[start : i + 1], texts, tokens)
                    start, texts, tokens, n = i + 1, [], [], 0
            if texts:
                yield scored(batch.column(0)[start:], texts, tokens)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, spans array<struct<start:int,end:int,probability:double>>"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_field(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"))
