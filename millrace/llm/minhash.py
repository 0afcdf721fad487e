"""Near-duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table
from millrace.llm.components import connected_components

WORDS_PER_SHINGLE = 5
#: Least similarity of linked documents, in hundredths.
PERCENT = 75
#: At similarity 0.75 a pair shares no bucket with probability (1 - 0.75 ** ROWS) ** BANDS = 5e-6.
BANDS, ROWS = 32, 4
#: Centres of a bucket in the second round, on average, and how many times as many there are in each further one.
GROWTH = 16
#: Steps of the hash by which centres are drawn.
DRAWS = 1 << 20
REMEMBERED = 300_000
SEED = 20240229
#: Bits of the odd sketch, which rules out pairs without looking at their sets.
ODD_BITS = 4096


class Shingler:
    """Hashes of a document's distinct shingles, and the sketch made from them."""

    def __init__(self, size: int = WORDS_PER_SHINGLE, bands: int = BANDS, rows: int = ROWS):
        import numpy as np
        import xxhash

        class Words(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[word] = value = xxhash.xxh3_64_intdigest(word)
                return value

        random = np.random.default_rng(SEED)
        self.size, self.bands, self.rows, self.bins = size, bands, rows, bands * rows
        self.of_word = Words().__getitem__
        self.factors = random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # an empty bin takes the value of the first filled one in an order of its own
        self.preference = np.argsort(random.random((self.bins, self.bins)), axis=1).argsort(axis=1)
        edges = [(k << 64) // self.bins for k in range(self.bins)]
        self.edges = np.array(edges, np.uint64)

    @staticmethod
    def mix(x):
        import numpy as np

        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))

    def shingles(self, raw: bytes):
        """Sorted distinct hashes; words are parted by white space, A-Z count as a-z."""
        import numpy as np

        words = raw.lower().split()
        hashed = np.fromiter(map(self.of_word, words), np.uint64, len(words))
        n, size = len(words), self.size
        if not n:
            return hashed
        if n < size:
            # fewer words are one shingle, told apart from full ones by a factor for their number
            total = (hashed * self.factors[:n]).sum(keepdims=True, dtype=np.uint64) + self.factors[size + n]
        else:
            total = np.zeros(n - size + 1, np.uint64)
            for k in range(size):
                total += hashed[k : n - size + 1 + k] * self.factors[k]
        return np.unique(self.mix(total))

    def key(self, shingles) -> tuple[int, int]:
        """128 bits that are equal for equal sets."""
        import numpy as np

        other = self.mix(shingles + self.factors[20])
        return int(shingles.sum(dtype=np.uint64).view(np.int64)), int(other.sum(dtype=np.uint64).view(np.int64))

    def odd_sketch(self, shingles):
        """A bit for each remainder, set where an odd number of shingles has it.

        Two sketches differ in no more bits than their sets differ in elements, so too many different bits prove that the sets
        are not similar; the other way round nothing is claimed.
        """
        import numpy as np

        counts = np.bincount((shingles & np.uint64(ODD_BITS - 1)).view(np.int64), minlength=ODD_BITS)
        return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)

    def buckets(self, shingles):
        """One number for each band of the signature; the number says which band it is."""
        import numpy as np

        places = np.searchsorted(shingles, self.edges)
        filled = np.flatnonzero(np.diff(np.append(places, len(shingles))))
        signature = np.zeros(self.bins, np.uint64)
        signature[filled] = shingles[places[filled]]
        if len(filled) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), filled, assume_unique=True)
            donors = filled[self.preference[np.ix_(empty, filled)].argmin(axis=1)]
            # with the bin's number: a borrowed value never equals the same value in another bin
            signature[empty] = self.mix(signature[donors] + empty.astype(np.uint64))
        signature = signature.reshape(self.bands, self.rows)
        total = np.arange(self.bands, dtype=np.uint64) * self.factors[30]
        for k in range(self.rows):
            total = self.mix(total + signature[:, k] * self.factors[31 + k])
        return total.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, mark, n, key1, key2, buckets`` of every whole text; ``mark`` finds a row again by its content."""

    def run(batches):
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            n, key1, key2, buckets = [], [], [], []
            for raw in batch.column(2):
                found = shingler.shingles(raw.as_py() or b"")
                one, two = shingler.key(found)
                n.append(len(found))
                key1.append(one)
                key2.append(two)
                buckets.append(shingler.buckets(found) if len(found) else [])
            columns = [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in (n, key1, key2)], pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "n", "key1", "key2", "buckets"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _marked(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, mark long, n long, key1 long, key2 long, buckets array<long>")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """``node, mark, n, shingles, odd`` (the odd sketch) of the rows whose ``mark`` is in ``wanted``.

    A node that names several classes has a row for each, also where their sets are of one size.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingler = Shingler()
        for batch in batches:
            sets = [shingler.shingles(raw.as_py() or b"") for raw in batch.column(2)]
            lists = [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(list(map(shingler.odd_sketch, sets)), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(map(len, sets)), pa.int64()), *lists], names=["node", "mark", "n", "shingles", "odd"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = _marked(docs, id_col, text_col).join(wanted.select("mark"), "mark", "left_semi").select("doc_id", "mark", "raw")
    return rows.mapInArrow(run, f"node {kind}, mark long, n long, shingles array<long>, odd array<long>").dropDuplicates(["node", "mark"])


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[id_col], text).alias("mark"), text.cast("binary").alias("raw"))


def _fits(a: str, b: str) -> str:
    """Sizes between which the similarity is possible at all."""
    return f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})"


def _differ_little(a: str, b: str) -> str:
    """Not ruled out: at similarity s, sets of sizes n and m differ in (n + m) (1 - s) / (1 + s) elements."""
    bits = f"aggregate(zip_with({a}.odd, {b}.odd, (x, y) -> bit_count(x ^ y)), 0, (sum, d) -> sum + d)"
    return f"{100 + PERCENT} * {bits} <= {100 - PERCENT} * ({a}.n + {b}.n)"


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs ``a, b`` those whose full sets are similar enough. A node that is in very many pairs should be ``b``."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").filter(_fits("n_a", "n_b"))
    common = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("set_a", "set_b")).alias("common"))
    return common.filter(f"100 * common >= {PERCENT} * (n_a + n_b - common)").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents with Jaccard similarity of at least 0.75 between their sets of five-word shingles are linked; ``component_id`` is the
    smallest id reachable. Null, empty and blank texts have no shingles and no links. Rows with one id are one document: links
    of any of its rows are its own. A null id is linked with nothing, has a null component and is kept. Other columns are not
    read; an empty table gives no rows.

    Equal sets become one class before anything is compared. Classes that share a bucket are candidates; the class with the
    smallest id is the centre of a star, so a bucket of any size gives one pair for each member. Every pair is checked on full
    sets. A bucket whose members are then in one component is done. In the others, members outside the largest component
    become centres in their turn, in growing numbers, until each has been compared with all other components: no link between
    classes of a bucket is lost, and buckets that are alike throughout never cost more than their size. Odd sketches rule out
    most of these later pairs, never a similar one, before they become rows.
    """
    found = materialise(sketches(docs, id_col, text_col), "sketch")
    keys = ["n", "key1", "key2"]
    known = found.filter("n > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy(*keys).agg(F.min(F.struct("doc_id", "mark", "buckets")).alias("first"))
    classes = materialise(classes.select(*keys, F.col("first.doc_id").alias("node"), "first.mark", "first.buckets"), "classes")

    spread = classes.select("node", "mark", "n", F.explode("buckets").alias("bucket"))
    centres = spread.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("centre"), F.max("node").alias("last")).filter("centre.node <> last")
    members = materialise(spread.join(centres.select("bucket", "centre"), "bucket"), "members")
    sets = materialise(shingle_sets(docs, id_col, text_col, members.select("mark").distinct()), "sets")

    stars = members.filter("node <> centre.node").select(F.col("node").alias("a"), F.col("centre.node").alias("b"), "n", F.col("centre.n").alias("n_b"))
    pairs = materialise(stars.filter(_fits("n", "n_b")).select("a", "b").distinct(), "pairs")
    links = materialise(confirmed(pairs, sets).unionByName(_same_ids(known, classes, keys)), "links")
    components, compared = connected_components(links), pairs

    waiting, n_centres = members.filter("node <> centre.node").select("bucket", "node", "n"), GROWTH
    while True:
        # about as many centres for each bucket, by a hash: nothing orders a bucket; all where no more are left
        drawn = F.pmod(F.xxhash64("bucket", "node", F.lit(n_centres)), F.lit(DRAWS)) * F.col("n_minor") < F.lit(n_centres * DRAWS)
        open_ = _open_members(waiting, components).withColumn("centre", (F.col("component") != F.col("largest")) & drawn)
        waiting = materialise(open_, "waiting")
        if waiting.isEmpty():
            break
        centre = F.col("centre")
        odd = sets.select("node", "n", "odd")
        one, two = (side.join(odd, ["node", "n"]).alias(name) for side, name in ((waiting, "m"), (waiting.filter(centre), "c")))
        met = one.join(two, F.expr(f"m.bucket = c.bucket AND m.component <> c.component AND {_fits('m.n', 'c.n')} AND {_differ_little('m', 'c')}"))
        pairs = met.select(F.greatest("m.node", "c.node").alias("a"), F.least("m.node", "c.node").alias("b")).distinct()
        pairs = materialise(pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            compared = compared.unionByName(pairs)
            new = materialise(confirmed(pairs, sets), "links")
            if not new.isEmpty():
                # the components so far stand for their links
                components = connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new))
        waiting = waiting.filter(~centre).select("bucket", "node", "n")
        n_centres *= GROWTH

    labels = classes.join(components, "node", "left").select(*keys, F.coalesce("component", "node").alias("component"))
    joined = found.join(labels, keys, "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _same_ids(known: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """Links ``a, b`` between the classes of ids that occur with different sets."""
    one, other = (f(F.struct(*keys)).alias(name) for f, name in ((F.min, "one"), (F.max, "other")))
    several = known.groupBy("doc_id").agg(one, other).filter("one <> other").select("doc_id")
    nodes = known.join(several, "doc_id").join(classes.select(*keys, "node"), keys).select("doc_id", "node").distinct()
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("b"))
    return nodes.join(least, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b")


def _open_members(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets in which more than one component waits, with their own and their bucket's ``largest`` component, and how
    many of the bucket are outside it."""
    own = components.select("node", "component")
    placed = members.join(own, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = placed.groupBy("bucket", "component").agg(F.count("*").alias("waiting"))
    open_ = counts.groupBy("bucket").agg(
        F.count("*").alias("several"), F.max_by("component", F.struct("waiting", "component")).alias("largest"), (F.sum("waiting") - F.max("waiting")).alias("n_minor"))
    return placed.join(open_.filter("several > 1").select("bucket", "largest", "n_minor"), "bucket")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
