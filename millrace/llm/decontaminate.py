"""Benchmark passages in training documents, found by binary search in suffix arrays of the documents."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialise, packed, table, unpacked

#: Consecutive words that make a match; an item of fewer words must occur whole.
WINDOW = 10
#: Words of documents in one suffix array; a longer document has one of its own.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark texts that are searched in one pass over the documents.
BLOCK_BYTES = 32 << 20
#: Bits of a word's number where a key holds three words, and where a shard has too many distinct words for that and it holds two.
ID_BITS, WIDE_ID_BITS = 21, 31

#: Bytes to word characters: A-Z in lower case, digits, a-z and everything beyond ASCII; all others part words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


class SuffixArray:
    """Suffixes of a shard's words, in order up to ``depth`` words. Word 0 ends a document, so no match crosses its end."""

    def __init__(self, tokens, vocabulary: dict[bytes, int], depth: int):
        import numpy as np

        self.tokens, self.vocabulary = tokens, vocabulary
        n = len(tokens)
        self.padded = np.concatenate([tokens, np.zeros(depth + 3, tokens.dtype)])
        wide = self.padded.astype(np.int64)
        self.key_words, self.bits = (3, ID_BITS) if len(vocabulary) <= 1 << ID_BITS else (2, WIDE_ID_BITS)
        keys = wide[:n]
        for k in range(1, self.key_words):
            keys = (keys << self.bits) | wide[k : n + k]
        order = np.argsort(keys)
        self.keys = keys[order]
        edge = np.ones(n, bool)
        edge[1:] = self.keys[1:] != self.keys[:-1]
        begin = np.maximum.accumulate(np.where(edge, np.arange(n), 0))
        rank = np.zeros(n + depth + 3, np.int64)
        rank[order] = begin + 1
        # twice as many words are compared each time, and only where suffixes are still equal
        known = self.key_words
        places = np.flatnonzero(~(edge & np.append(edge[1:], True)))
        while known < depth and len(places):
            suffixes = order[places]
            both = (rank[suffixes] << 32) | rank[np.minimum(suffixes + known, n)]
            by_both = np.argsort(both)
            order[places], both = suffixes[by_both], both[by_both]
            edge = np.ones(len(places), bool)
            edge[1:] = both[1:] != both[:-1]
            begin = places[np.maximum.accumulate(np.where(edge, np.arange(len(places)), 0))]
            rank[order[places]] = begin + 1
            places = places[~(edge & np.append(edge[1:], True))]
            known *= 2
        self.order = order

    def narrow(self, low, high, depth, wanted):
        """Within intervals of suffixes that agree in ``depth`` words, the parts whose next word is ``wanted``."""
        import numpy as np

        bounds = []
        for after in (0, 1):
            a, b = low.copy(), high.copy()
            while True:
                open_ = np.flatnonzero(a < b)
                if not len(open_):
                    break
                middle = (a[open_] + b[open_]) >> 1
                before = self.padded[self.order[middle] + depth] < wanted[open_] + after
                a[open_] = np.where(before, middle + 1, a[open_])
                b[open_] = np.where(before, b[open_], middle)
            bounds.append(a)
        return bounds


class Queries:
    """The suffixes of all benchmark items of a block."""

    def __init__(self, items: list[tuple[object, bytes]], window: int):
        import numpy as np

        split = [(item, found) for item, raw in items if (found := words(raw))]
        self.items = [item for item, _ in split]
        self.vocabulary = sorted({w for _, found in split for w in found})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        lengths = np.array([len(found) for _, found in split], int)
        self.depth = int(lengths.max(initial=1))
        self.flat = np.array([number[w] for _, found in split for w in found], int)
        ends = np.cumsum(lengths)
        # every suffix that is at least a window long
        spans = np.minimum(lengths, window)
        per_item = lengths - spans + 1
        self.item_of = np.repeat(np.arange(len(split)), per_item)
        offset = np.arange(per_item.sum()) - np.repeat(np.cumsum(per_item) - per_item, per_item)
        self.offset = offset
        self.start = (ends - lengths)[self.item_of] + offset
        self.end = ends[self.item_of]
        self.window = spans[self.item_of]
        self.longest_suffix = self.end - self.start

    def search(self, index: SuffixArray):
        """For every suffix the interval of documents' suffixes that begin with its window, and the longest match found.

        Returns low, high, longest match in words and one place of it.
        """
        import numpy as np

        ids = np.array([index.vocabulary.get(w, -1) for w in self.vocabulary], int)
        text = np.append(ids[self.flat], [-1] * (self.depth + 3)) if len(self.flat) else np.zeros(self.depth + 3, int)
        top, known = (1 << index.bits) - 1, index.key_words
        word = lambda k: np.where(self.longest_suffix > k, text[self.start + k], -2)
        leading = [word(k) for k in range(known)]
        # words past the end of a short item match anything; unknown words match nothing
        key = lambda rest: sum(np.where(w == -2, rest, w) << index.bits * (known - 1 - k) for k, w in enumerate(leading))
        usable = np.all([w != -1 for w in leading], axis=0)
        low = np.where(usable, np.searchsorted(index.keys, key(0), "left"), 0)
        high = np.where(usable, np.searchsorted(index.keys, key(top), "right"), 0)
        length = np.minimum(known, self.longest_suffix)
        longest = np.where(high > low, length, 0)
        place = np.where(high > low, index.order[np.minimum(low, len(index.order) - 1)], -1)
        at_window = np.stack([low, high])
        live = np.flatnonzero((high > low) & (self.longest_suffix > known))
        low, high, depth = low[live], high[live], known
        at_window[:, live[self.window[live] > known]] = 0
        while len(live):
            low, high = index.narrow(low, high, depth, text[self.start[live] + depth])
            depth += 1
            found = high > low
            live, low, high = live[found], low[found], high[found]
            longest[live], place[live] = depth, index.order[low]
            here = self.window[live] == depth
            at_window[:, live[here]] = low[here], high[here]
            more = self.longest_suffix[live] > depth
            live, low, high = live[more], low[more], high[more]
        return at_window[0], at_window[1], longest, place


def search_shard(tokens, starts, index: SuffixArray, queries: Queries) -> dict[int, dict]:
    """Hits of a shard's documents by their number: covered runs of words, items, and the longest match."""
    import numpy as np

    low, high, longest, place = queries.search(index)
    met = np.flatnonzero(high > low)
    if not len(met):
        return {}
    # the same window may stand in several items: one interval, many items
    code = low[met] * (len(tokens) + 1) + high[met]
    _, one, which = np.unique(code, return_index=True, return_inverse=True)
    sample = met[one]
    counts = high[sample] - low[sample]
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[sample], counts)
    window_of, places = np.repeat(np.arange(len(sample)), counts), index.order[at]
    marks = np.bincount(places, minlength=len(tokens) + queries.depth) - np.bincount(places + queries.window[sample][window_of], minlength=len(tokens) + queries.depth)
    covered = np.cumsum(marks) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    document = np.searchsorted(starts, places, "right") - 1
    hits: dict[int, dict] = defaultdict(lambda: {"runs": [], "items": [], "longest": None})
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        d = int(np.searchsorted(starts, a, "right")) - 1
        hits[d]["runs"].append((a - int(starts[d]), b - int(starts[d])))

    pairs = np.unique(document * len(sample) + window_of)
    items_by_window = np.argsort(which, kind="stable")
    many = np.bincount(which, minlength=len(sample))
    first = np.cumsum(many) - many
    w = pairs % len(sample)
    spread = np.arange(many[w].sum()) - np.repeat(np.cumsum(many[w]) - many[w], many[w]) + np.repeat(first[w], many[w])
    item = queries.item_of[met[items_by_window[spread]]]
    for p in np.unique(np.repeat(pairs // len(sample), many[w]) * len(queries.items) + item).tolist():
        if queries.items[p % len(queries.items)] is not None:
            hits[p // len(queries.items)]["items"].append(queries.items[p % len(queries.items)])

    # of each suffix of an item, the place of its longest match; of each document, the longest of those that lie in it
    for q in met[np.argsort(longest[met], kind="stable")].tolist():
        d = int(np.searchsorted(starts, place[q], "right")) - 1
        hits[d]["longest"] = {"item_id": queries.items[queries.item_of[q]], "item_start": int(queries.offset[q]), "start": int(place[q] - starts[d]), "n_words": int(longest[q])}
    return hits


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    """Items of the benchmark, in blocks of at most ``block_bytes`` and one item. Null texts are left out."""
    rows = benchmark.select(benchmark[item_col].alias("item"), benchmark[text_col].cast("string").cast("binary").alias("raw")).dropna(subset=["raw"])
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row["item"], bytes(row["raw"])))
        size += len(row["raw"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _pass(rows: DataFrame, block: list[tuple[object, bytes]], kind: str, item_kind: str, window: int, shard_words: int) -> DataFrame:
    """``row, doc_id, n_words, runs, items, longest`` for every row, for one block of the benchmark."""
    shared = rows.sparkSession.sparkContext.broadcast({"block": block})

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = shared.value
        if "queries" not in held:
            held["queries"] = Queries(held["block"], window)
        queries = held["queries"]
        schema = None

        def answer(numbers, ids, tokens, vocabulary):
            lengths = np.array([len(t) for t in tokens])
            starts = np.cumsum(lengths) - lengths
            flat = np.concatenate(tokens)
            hits = {}
            if len(queries.items) and len(vocabulary) > 1:
                hits = search_shard(flat, starts, SuffixArray(flat, vocabulary, queries.depth), queries)
            none = {"runs": [], "items": [], "longest": None}
            found = [hits.get(i, none) for i in range(len(tokens))]
            columns = [
                numbers, ids, [int(n) - 1 for n in lengths], [[{"start": a, "end": b} for a, b in f["runs"]] for f in found],
                [f["items"] for f in found], [f["longest"] for f in found],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        numbers, ids, tokens, total = [], [], [], 0
        vocabulary = None
        for batch in batches:
            if schema is None:
                item = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[item_kind]
                runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                match = pa.struct([("item_id", item), ("item_start", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64())])
                schema = pa.schema([
                    ("row", pa.int64()), ("doc_id", batch.schema.field(1).type), ("n_words", pa.int64()), ("runs", runs), ("items", pa.list_(item)), ("longest", match),
                ])
            for number, doc_id, raw in zip(*(column for column in batch.columns)):
                if vocabulary is None:
                    vocabulary = defaultdict()
                    vocabulary[b""] = 0
                    vocabulary.default_factory = vocabulary.__len__
                found = words(raw.as_py() or b"")
                found.append(b"")
                tokens.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
                numbers.append(number.as_py())
                ids.append(doc_id.as_py())
                total += len(found)
                if total >= shard_words:
                    yield answer(numbers, ids, tokens, vocabulary)
                    numbers, ids, tokens, total, vocabulary = [], [], [], 0, None
        if tokens:
            yield answer(numbers, ids, tokens, vocabulary)

    match = f"struct<item_id:{item_kind},item_start:long,start:long,n_words:long>"
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, runs array<struct<start:long,end:long>>, items array<{item_kind}>, longest {match}")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``row, doc_id, n_words, n_hit, runs, items, longest, contaminated``.

    Words are runs of ``0-9``, ``a-z`` and characters beyond ASCII after lower-casing A-Z. ``runs`` are the covered stretches
    of words (start, end), merged; ``n_hit`` counts their words; ``items`` are the distinct items of which a window occurs, in
    ascending order of their text form; ``longest`` is the longest verbatim match found at its place. Null and wordless documents
    and items match nothing; repeated items count once per id, and items without an id hit words without being listed. ``row`` only tells rows apart. Other columns are not read.

    Each task sorts the suffixes of its documents, about ``shard_words`` words at a time, and searches every suffix of the
    benchmark in them. The benchmark is the query set: it is sent in blocks of ``block_bytes``, one pass over the documents for
    each, and the passes are joined by row. An ordinary benchmark is one block, and then nothing is shuffled.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    if item_kind not in ("string", "bigint", "int"):
        raise TypeError(f"item ids must be strings or integers, not {item_kind}")
    raw = docs[text_col].cast("string").cast("binary")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), raw.alias("raw"))
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _pass(rows, first, kind, item_kind, window, shard_words)
    else:
        rows = materialise(rows, "decontaminate")
        passes = [materialise(_pass(rows, block, kind, item_kind, window, shard_words), "decontaminate") for block in (first, second)]
        passes += [materialise(_pass(rows, block, kind, item_kind, window, shard_words), "decontaminate") for block in blocks]
        every = passes[0]
        for one in passes[1:]:
            every = every.unionByName(one)
        found = every.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.max_by("longest", "longest.n_words").alias("longest"),
        )
        step = "IF(size(acc) > 0 AND x.start <= element_at(acc, -1).end, concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end)))), concat(acc, array(x)))"
        merged = f"aggregate(array_sort(runs), cast(array() AS array<struct<start:bigint,end:bigint>>), (acc, x) -> {step})"
        found = found.withColumn("runs", F.expr(merged))
    n_hit = F.expr("aggregate(runs, 0L, (n, r) -> n + r.end - r.start)")
    in_order = F.expr("array_sort(items, (a, b) -> CASE WHEN string(a) < string(b) THEN -1 WHEN string(a) > string(b) THEN 1 ELSE 0 END)")
    return found.select("row", "doc_id", "n_words", n_hit.alias("n_hit"), "runs", in_order.alias("items"), "longest", (F.size("runs") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark; columns and other rows as they were.

    Only the numbers of affected rows are matched with the documents.
    """
    stamped = materialise(docs.select(packed(docs).alias("doc"), docs[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("stamp")), "clean")
    texts = stamped.select("stamp", F.col("doc").getField(text_col).alias("text"))
    hit = find_contamination(texts, benchmark, "stamp", "text", **options).filter("contaminated").select(F.col("doc_id").alias("stamp"))
    return unpacked(stamped.join(hit, "stamp", "left_anti"), "doc", docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.transform("items", lambda i: i.cast("string")), ",")
    digest = F.sha2(ids.cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


OP5_SQL = r"""
WITH dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), bw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM bw WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT k FROM win), occ AS (
    SELECT doc_id, i, k, array_to_string(ws[i : i + k - 1], ' ') AS w
    FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, sizes WHERE len(ws) >= k)
), met AS (SELECT o.doc_id, o.i, o.k, win.item_id FROM occ o JOIN win ON o.w = win.w AND o.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY doc_id),
its AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
)
SELECT dw.doc_id, len(dw.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
