"""Clustering of vectors around centroids, through dictionaries of their parts.

Components become integers, so every distance and every mean is exact. A vector is cut into blocks of a few dimensions, and each
block's distinct parts form a dictionary. In a round the squared distance of every distinct part to every centroid's part is computed
once; the distance of a vector to a centroid is the sum over its blocks of what the dictionary says for its codes.

Vectors are kept in chunks of bounded size: per chunk one row with the codes of its vectors, and one row for each distinct part in
it. In a round only the latter are joined with the dictionary's distances, so a part travels once per chunk however many of its
vectors have it, and a very common vector adds nothing. Centroids are the only thing that passes the driver.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table

#: Dimensions of a block, and vectors of a chunk. Codes of a chunk are 16-bit numbers, so a chunk has 65,536 vectors at most.
WIDTH, CHUNK_ROWS = 2, 1 << 16
#: Centroids times dimensions beyond this are refused: they are sent to every task.
MAX_CENTROID_CELLS = 1 << 20


def largest_component(dims: int) -> int:
    """The largest magnitude of integer components at which no squared distance leaves 63 bits."""
    return math.isqrt((2**63 - 1) // dims) // 2


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, ints``: floor(scale * x) of the components, only of rows with exactly ``dims`` of them, none null or not finite.

    A component whose square could overflow a distance ends the job with an error. Null ids and repeated rows are kept.
    """
    x, limit = vectors[vector_col], largest_component(dims)

    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))

    def whole(v: Column) -> Column:
        scaled = F.floor(v.cast("double") * F.lit(float(scale)))
        too_large = F.abs(v.cast("double") * F.lit(float(scale))) >= float(limit)
        return F.when(too_large, F.raise_error(F.lit(f"a component is beyond {limit} / {scale}")).cast("long")).otherwise(scaled)

    kept = vectors.filter(F.coalesce((F.size(x) == dims) & F.forall(x, finite), F.lit(False)))
    return kept.select(vectors[id_col].alias("vec_id"), F.transform(x, whole).alias("ints"))


def encode(vectors: DataFrame, dims: int, width: int = WIDTH, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(chunks, entries)`` of ``vec_id, ints``, both written.

    ``chunks(chunk, vec_ids, codes)`` has the codes of a chunk's vectors, vector by vector, as 16-bit numbers in one binary value.
    ``entries(chunk, block, place, part)`` has the distinct parts of the chunk; ``place`` is what the codes say.
    """
    if dims % width:
        raise ValueError("the dimensions must be a multiple of the width")
    if not 0 < chunk_rows <= 1 << 16:
        raise ValueError("a chunk has 1 to 65,536 vectors")
    kind, blocks = vectors.schema["vec_id"].dataType.simpleString(), dims // width
    names = ["chunk", "block", "place", "part", "vec_ids", "codes"]

    def run(batches):
        import pyarrow as pa

        def rows_of(chunk, ids, cells):
            codes = np.empty((len(cells), blocks), np.uint16)
            block_of, place_of, parts = [], [], []
            for b in range(blocks):
                distinct, inverse = np.unique(cells[:, b * width : (b + 1) * width], axis=0, return_inverse=True)
                codes[:, b] = inverse.reshape(-1)
                block_of.append(np.full(len(distinct), b, np.int32))
                place_of.append(np.arange(len(distinct), dtype=np.int32))
                parts.append(distinct)
            parts = np.concatenate(parts)
            n = len(parts)
            offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32))
            id_type = ids.type
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk)), pa.array(np.concatenate(block_of)), pa.array(np.concatenate(place_of)),
                    pa.ListArray.from_arrays(offsets, pa.array(parts.reshape(-1))), pa.nulls(n, pa.list_(id_type)), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([codes.tobytes()], pa.binary()),
                ],
                names=names,
            )

        chunk, held, count = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if chunk is None:
                chunk = batch.column(0)[0].as_py() << 32
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, chunk_rows - count)
                held.append(piece)
                count += piece.num_rows
                at += piece.num_rows
                if count == chunk_rows:
                    yield from rows_of(chunk, *_cells(held, dims))
                    chunk, held, count = chunk + 1, [], 0
        if held:
            yield from rows_of(chunk, *_cells(held, dims))

    def _cells(held, dims):
        import pyarrow as pa

        ids = pa.concat_arrays([b.column(1) for b in held])
        return ids, np.concatenate([b.column(2).flatten().to_numpy() for b in held]).reshape(-1, dims)

    rows = vectors.select(F.spark_partition_id().cast("long").alias("part"), "vec_id", "ints")
    schema = f"chunk long, block int, place int, part array<long>, vec_ids array<{kind}>, codes binary"
    packed = materialise(rows.mapInArrow(run, schema), "codes")
    chunks = packed.filter("codes IS NOT NULL").select("chunk", "vec_ids", "codes")
    return chunks, packed.filter("part IS NOT NULL").select("chunk", "block", "place", "part")


def build_dictionary(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(dictionary, entries)``: the distinct ``block, part`` of all chunks with a ``code``, and ``chunk, block, place, code``, both written."""
    distinct = materialise(entries.groupBy("block", "part").agg(F.count("*").alias("chunks")), "parts")
    dictionary = materialise(distinct.select("block", "part", F.monotonically_increasing_id().alias("code")), "dictionary")
    coded = entries.join(dictionary, ["block", "part"]).select("chunk", "block", "place", "code")
    return dictionary, materialise(coded, "entries")


def part_distances(dictionary: DataFrame, centroids: list[list[int]], width: int) -> DataFrame:
    """``code, part, distances``: the squared distance of each distinct part to the same part of every centroid, in their order."""
    spark = dictionary.sparkSession
    if len(centroids) * len(centroids[0]) > MAX_CENTROID_CELLS:
        raise ValueError(f"more than {MAX_CENTROID_CELLS} components of centroids")
    cut = [(b, [c[b * width : (b + 1) * width] for c in centroids]) for b in range(len(centroids[0]) // width)]
    # bounded by MAX_CENTROID_CELLS
    wanted = F.broadcast(spark.createDataFrame(cut, "block int, centres array<array<long>>"))

    def distance(centre: Column) -> Column:
        squares = F.zip_with(F.col("part"), centre, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)

    return dictionary.join(wanted, "block").select("code", "part", F.transform("centres", distance).alias("distances"))


def _assign(chunks: DataFrame, entries: DataFrame, dictionary: DataFrame, centroids: list[list[int]], width: int, sums_only: bool) -> DataFrame:
    """Each vector's nearest centroid (ties: the first): ``vec_id, cluster, distance``, or per chunk and cluster its count and sums."""
    delivered = entries.join(part_distances(dictionary, centroids, width), "code").select(F.col("chunk").alias("to_chunk"), "block", "place", "part", "distances")
    k, dims = len(centroids), len(centroids[0])
    blocks = dims // width

    def run(left, right):
        import pyarrow as pa

        block, place = right.column("block").to_numpy(), right.column("place").to_numpy()
        flat = right.column("distances").combine_chunks().flatten().to_numpy().reshape(-1, k)
        part = right.column("part").combine_chunks().flatten().to_numpy().reshape(-1, width)
        codes = np.frombuffer(left.column("codes")[0].as_py(), np.uint16).reshape(-1, blocks)
        ids = left.column("vec_ids").combine_chunks().flatten()
        total = np.zeros((len(codes), k), np.int64)
        rows_of = []
        for b in range(blocks):
            at = np.flatnonzero(block == b)
            rows = np.empty(len(at), np.int64)
            rows[place[at]] = at
            total += flat[rows[codes[:, b]]]
            rows_of.append(rows)
        nearest = total.argmin(axis=1)
        if not sums_only:
            distance = total[np.arange(len(total)), nearest]
            return pa.Table.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])
        sums = np.empty((k, dims), np.int64)
        for b, rows in enumerate(rows_of):
            met = np.bincount(nearest * len(rows) + codes[:, b], minlength=k * len(rows)).reshape(k, len(rows))
            sums[:, b * width : (b + 1) * width] = met @ part[rows]
        count = np.bincount(nearest, minlength=k)
        held = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(held) + 1) * dims, dims, dtype=np.int32)), pa.array(sums[held].reshape(-1)))
        return pa.Table.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held]), lists], names=["cluster", "n", "sums"])

    sides = chunks.groupBy("chunk").cogroup(delivered.groupBy("to_chunk"))
    if sums_only:
        return sides.applyInArrow(run, "cluster int, n long, sums array<long>")
    kind = chunks.schema["vec_ids"].dataType.elementType.simpleString()
    return sides.applyInArrow(run, f"vec_id {kind}, cluster int, distance long")


def moved_centroids(sums: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the mean of each cluster; a cluster without vectors keeps its centroid. Reads one number per centroid and component."""
    cells = sums.select("cluster", "n", F.posexplode("sums").alias("dim", "x")).groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    moved = [list(c) for c in centroids]
    for row in cells.collect():
        moved[row["cluster"]][row["dim"]] = row["x"] // row["n"]
    return moved


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The vectors of the ``k`` smallest SHA-256 of ``salt`` and the id (null: empty); ties by the vector."""
    name = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = vectors.select(F.sha2(name, 256).alias("hash"), "ints").orderBy("hash", "ints").limit(k)
    return [list(row["ints"]) for row in least.collect()]


def cluster_vectors(
    vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int, k: int, rounds: int, salt: str,
    width: int = WIDTH, chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every kept vector (written) and the centroids after ``rounds`` rounds.

    Rows without exactly ``dims`` finite components are left out. With fewer than ``k`` kept vectors there are as many centroids as
    vectors; without any the result is empty. Repeated ids and vectors are rows of their own. Ties go to the centroid of smaller
    number. Only the two named columns are read.
    """
    kept = integer_vectors(vectors, id_col, vector_col, dims, scale)
    centroids = first_centroids(kept, k, salt)
    if not centroids:
        none = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
        return none, []
    chunks, entries = encode(kept, dims, width, chunk_rows)
    dictionary, entries = build_dictionary(entries)
    for _ in range(rounds):
        centroids = moved_centroids(_assign(chunks, entries, dictionary, centroids, width, sums_only=True), centroids)
    return materialise(_assign(chunks, entries, dictionary, centroids, width, sums_only=False), "clusters"), centroids


def with_totals(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and the digest of each row's centroid."""
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    named = assigned.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per_cluster.agg(F.sum("cluster_inertia").alias("inertia")).first()["inertia"]
    # both have one row per centroid
    facts = F.broadcast(per_cluster.join(F.broadcast(named), "cluster"))
    return assigned.join(facts, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components around 16 centroids, after three rounds."""
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, 64, 16, 3, "1:")
    return with_totals(assigned, centroids)


def _round_sql(i: int) -> str:
    """Assignment to the centroids ``c{i}`` and the centroids ``c{i + 1}`` that follow from it."""
    return f""", a{i} AS MATERIALIZED (
    SELECT row, vec_id, v, min(struct_pack(d := d, k := k)) AS best FROM (
        SELECT row, vec_id, kept.v, k, list_sum(list_transform(list_zip(kept.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, c{i} c
    ) GROUP BY row, vec_id, v
), s{i} AS (
    SELECT k, j, sum(x) AS s, count(*) AS n FROM (
        SELECT best.k AS k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}
    ) GROUP BY k, j
), c{i + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
        SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY k
    ) m ON c.k = m.k
)"""


OP12_SQL = f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v FROM (
        SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 16
    )
){"".join(_round_sql(i) for i in range(4))}, named AS (
    SELECT k, sha256(array_to_string(list_transform(v, lambda x: x::VARCHAR), ',')) AS centroid_sha256 FROM c3
), per_cluster AS (
    SELECT best.k AS k, sum(best.d)::BIGINT AS cluster_inertia FROM a3 GROUP BY best.k
)
SELECT a3.vec_id, best.k::INTEGER AS cluster, best.d AS distance, p.cluster_inertia,
    (SELECT sum(cluster_inertia) FROM per_cluster)::BIGINT AS inertia, n.centroid_sha256
FROM a3 JOIN per_cluster p ON a3.best.k = p.k JOIN named n ON a3.best.k = n.k"""
