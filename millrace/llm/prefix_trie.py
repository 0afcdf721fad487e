"""The trie of conversation prefixes: which beginnings conversations share, and what storing each beginning once saves.

A node is a distinct sequence of first turns. It is named by its depth and its smallest member, so a conversation owns the nodes of
which it is the smallest member: the deepest part of its own path. Sequences are compared by a fingerprint that is a running sum of
salted turn hashes (160 bits in four numbers); sums can be taken in parts, so a very long conversation spreads over partitions, and
texts are read once and never shuffled.

Totals over subtrees go by bands of a fixed height. Within a band each node adds its values to its ancestors in that band only; a
conversation's path is cut at the bands, so a group holds at most a band's height of rows, and nodes in a row are summed before they
are sent. The nodes that begin a band, each with its band's total, form a trie that is lower by the height; it is summed the same
way, and its totals are then added to the ancestors in the band above. So there are as many rounds as the height goes into the
depth logarithmically, and no node is exploded to more than one band of ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, table

#: Depths of one band.
HEIGHT = 32
#: Numbers of 40 bits that make a fingerprint; a sum over 2^23 turns still fits 63 bits.
LANES = [f"k{i}" for i in range(4)]
#: Ids of one piece of a node's list while its digest is taken.
PIECE_IDS = 8192
VALUES = ["leaves", "saved"]


def running_sums(rows: DataFrame, key: str, order: Sequence[Column], measures: Sequence[str], label: str) -> DataFrame:
    """``rows`` with each measure summed up to and with the row, in ``order`` within ``key``.

    Rows are range-partitioned by key and order, so the rows of one key spread; one row per key and partition carries the totals on.
    """
    ranged = rows.repartitionByRange(F.col(key).asc(), *order).withColumn("_part", F.spark_partition_id())
    stored = materialise(ranged, label)
    totals = stored.groupBy("_part", key).agg(*[F.sum(m).alias(m) for m in measures])
    lower = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = totals.select("_part", key, *[F.coalesce(F.sum(m).over(lower), zero).alias(f"_{m}") for m in measures])
    upto = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.col(f"_{m}") + F.sum(m).over(upto)).alias(m) for m in measures]
    others = [c for c in rows.columns if c not in measures]
    return stored.join(before, ["_part", key]).select(*others, *sums)


def ordered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, position, digest, chars``: the turns of each conversation numbered from 1, written.

    Turns go by ``turn`` (null first), ties by role and then by digest; null role and text count as empty. Rows without an id
    belong to no conversation and are left out. ``digest`` tells role and text apart; ``chars`` counts the text's code points.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(
        conversations[id_col].cast("long").alias("conv"), conversations[turn_col].alias("turn"), role.alias("role"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("position"),
    ).filter("conv IS NOT NULL")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("row")]
    return materialise(running_sums(rows, "conv", order, ["position"], "turns").select("conv", "position", "digest", "chars"), "ordered")


def node_paths(turns: DataFrame, members: DataFrame) -> DataFrame:
    """``conv, depth, owner, n_convs, chars`` of every conversation at every depth from 0 to its length, written.

    ``turns(conv, position, digest, chars)`` must be numbered from 1 without gaps; ``members(conv)`` lists all conversations, those
    without turns too. ``owner`` is the smallest conversation with the same first ``depth`` turns, ``n_convs`` their number.
    """
    salted = F.sha2(F.concat(F.col("position").cast("string"), F.lit(":"), F.col("digest")), 256)
    hashed = turns.withColumn("hash", salted)
    lanes = [F.conv(F.substring("hash", 1 + 10 * i, 10), 16, 10).cast("long").alias(k) for i, k in enumerate(LANES)]
    rows = hashed.select("conv", F.col("position").alias("depth"), "chars", *lanes)
    prefixes = materialise(running_sums(rows, "conv", [F.col("depth")], LANES, "lanes"), "prefixes")
    # written apart, the join below is all its stage does, and adaptive execution splits the rows of a common beginning
    nodes = materialise(prefixes.groupBy("depth", *LANES).agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs")), "owners")
    deeper = prefixes.join(nodes, ["depth", *LANES]).select("conv", "depth", "owner", "n_convs", "chars")
    facts = members.agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs")).first()
    zero = F.lit(0).cast("long")
    top = members.select("conv", zero.alias("depth"), F.lit(facts["owner"]).cast("long").alias("owner"), F.lit(facts["n_convs"]).alias("n_convs"), zero.alias("chars"))
    return materialise(top.unionByName(deeper), "paths")


def _in_bands(paths: DataFrame, height: int) -> DataFrame:
    """``conv, depth, <values>``: what the nodes of each band add up to below each node, the band's own nodes only."""
    own = F.col("owner") == F.col("conv")
    band = Window.partitionBy("conv", "_band").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(F.when(own, F.col(v))).over(band).alias(v) for v in VALUES]
    # where a conversation owns nothing from here to the band's end, the sums are null
    sent = paths.withColumn("_band", F.floor(F.col("depth") / height)).select("owner", "depth", *sums).filter(F.col(VALUES[0]).isNotNull())
    return sent.groupBy(F.col("owner").alias("conv"), "depth").agg(*[F.sum(v).alias(v) for v in VALUES])


def subtree_totals(paths: DataFrame, deepest: int, height: int = HEIGHT) -> DataFrame:
    """``conv, depth, <values>`` of every node, summed over its subtree.

    ``paths(conv, depth, owner, <values>)`` holds every conversation's path; values count where the conversation owns the node.
    """
    inside = _in_bands(paths, height)
    if deepest < height:
        return inside
    inside = materialise(inside, "bands")
    # the nodes that begin a band, with their bands' totals, one level per band
    begins = paths.filter(F.col("depth") % height == 0).select("conv", "depth", "owner")
    lower = begins.join(inside, ["conv", "depth"], "left").select("conv", F.floor(F.col("depth") / height).alias("depth"), "owner", *VALUES)
    totals = subtree_totals(materialise(lower, "roots"), deepest // height, height)
    # a band's total goes to all nodes of the band above on the way to the root
    above = totals.filter("depth > 0").select("conv", (F.col("depth") - 1).alias("_band"), *[F.col(v).alias(f"_{v}") for v in VALUES])
    ways = paths.select("conv", "depth", "owner", F.floor(F.col("depth") / height).alias("_band")).join(above, ["conv", "_band"])
    added = ways.groupBy(F.col("owner").alias("conv"), "depth").agg(*[F.sum(f"_{v}").alias(f"_{v}") for v in VALUES])
    both = inside.join(added, ["conv", "depth"], "left")
    return materialise(both.select("conv", "depth", *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in VALUES]), "totals")


def end_digests(ends: DataFrame) -> DataFrame:
    """``conv, depth, ends_sha256`` of ``owner, depth, conv``: SHA-256 of each node's conversations, ascending, joined by commas.

    A digest must pass over a list in order. Lists are written as pieces of text by many tasks (ids are range-partitioned, so a
    node at which very many conversations end spreads); one task streams a node's pieces and holds one of them.
    """

    def pieces(batches):
        import pyarrow as pa

        names, node, ids = ["owner", "depth", "first", "text"], None, []

        def row():
            return (*node, ids[0], ",".join(map(str, ids)))

        for batch in batches:
            done = []
            for owner, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and (node != (owner, depth) or len(ids) == PIECE_IDS):
                    done.append(row())
                    ids = []
                node = (owner, depth)
                ids.append(conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[row()])], names=names)

    def digests(batches):
        import pyarrow as pa

        names, node, state = ["conv", "depth", "ends_sha256"], None, None
        for batch in batches:
            done = []
            for owner, depth, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if node != (owner, depth):
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (owner, depth), hashlib.sha256(text.encode())
                else:
                    state.update(b",")
                    state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], names=names)

    order = ["owner", "depth", "conv"]
    spread = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    listed = spread.mapInArrow(pieces, "owner long, depth long, first long, text string")
    met = listed.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return met.mapInArrow(digests, "conv long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` and ``members`` as for ``node_paths``. The root has depth 0, no parent and all conversations as members. ``n_leaves``
    and ``saved_tokens`` (per node its members but one, times the code points of its last text) are sums over the node's subtree,
    itself included. ``ends_sha256`` is of the members with exactly ``depth`` turns. Without any conversation there is no node.
    """
    paths = node_paths(turns, members)
    if paths.isEmpty():
        none = {"conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long"}
        return paths.select(*[F.lit(None).cast(kind).alias(name) for name, kind in none.items()], F.lit("").alias("ends_sha256")).limit(0)
    owned = paths.filter("owner = conv")
    upper = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    linked = materialise(owned.join(upper, ["conv", "depth"], "left").select("conv", "depth", "parent", "n_convs", "chars"), "nodes")
    children = linked.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    counted = linked.join(children, ["conv", "depth"], "left").select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"), saved.alias("saved"),
    )
    nodes = materialise(counted, "nodes")
    valued = paths.select("conv", "depth", "owner").join(nodes.select("conv", "depth", *VALUES), ["conv", "depth"], "left")
    deepest = int(nodes.agg(F.max("depth")).first()[0])
    totals = subtree_totals(materialise(valued, "valued"), deepest, height)

    last = F.max(F.struct("depth", "owner"))
    ends = paths.groupBy("conv").agg(last.alias("last")).select("last.owner", "last.depth", "conv")
    whole = nodes.drop(*VALUES).join(totals, ["conv", "depth"]).join(end_digests(ends), ["conv", "depth"], "left")
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


#: Conversations are rebuilt from the one that begins their hundred, of which fewer than this many turns are taken.
HUNDRED, MOST_TAKEN = 100, 6


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, members)`` of every conversation c rebuilt: the first h turns of conversation c - c % 100, then its own behind the first h.

    h is crc32(c) % 6. Where that conversation is absent or shorter, what there is of it comes first.
    """
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_TAKEN
    members = turns.select("conv").distinct().select("conv", share.alias("h"), (F.col("conv") - F.col("conv") % HUNDRED).alias("base"))
    heads = turns.filter(F.col("position") < MOST_TAKEN).select(F.col("conv").alias("base"), "position", "digest", "chars")
    lengths = heads.groupBy("base").agg(F.max("position").alias("longest"))
    facts = members.join(lengths, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("longest", F.lit(0).cast("long"))).alias("taken"))
    facts = materialise(facts, "members")
    given = facts.join(heads, "base").filter("position <= taken").select("conv", "position", "digest", "chars")
    own = turns.join(facts, "conv").filter("position > h").select("conv", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "digest", "chars")
    return given.unionByName(own), facts.select("conv")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(*rebuilt_turns(ordered_turns(table(spark, sf_dir, "conversations"))))


OP11_SQL = """WITH read AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), t AS (
    SELECT conv_id, role, text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)
    ) AS pos FROM read
), c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END
    ), 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), lengths AS (
    SELECT conv_id AS base, count(*) AS n FROM t GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, b.pos AS d, b.role, b.text FROM c JOIN t b ON b.conv_id = c.base AND b.pos <= c.h
    UNION ALL
    SELECT t.conv_id, least(c.h, coalesce(l.n, 0)) + t.pos - c.h, t.role, t.text
    FROM t JOIN c ON t.conv_id = c.conv_id LEFT JOIN lengths l ON l.base = c.base WHERE t.pos > c.h
), path AS MATERIALIZED (
    SELECT conv_id, 0 AS d, '' AS key, 0 AS chars FROM c
    UNION ALL
    SELECT conv_id, d, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d)), length(text) FROM rebuilt
), last AS (
    SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id
), node AS MATERIALIZED (
    SELECT p.d, p.key, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(p.chars) AS saved,
        sha256(coalesce(string_agg(CASE WHEN l.d = p.d THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
    FROM path p JOIN last l ON p.conv_id = l.conv_id GROUP BY p.d, p.key
), linked AS MATERIALIZED (
    SELECT n.*, u.key AS parent_key, q.conv_id AS parent_conv_id FROM node n
    LEFT JOIN path u ON u.conv_id = n.conv_id AND u.d = n.d - 1 LEFT JOIN node q ON q.d = u.d AND q.key = u.key
), children AS (
    SELECT d - 1 AS d, parent_key AS key, count(*) AS n_children FROM linked WHERE parent_key IS NOT NULL GROUP BY d, parent_key
), below AS (
    SELECT p.d, p.key, count(*) FILTER (ch.n_children IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM node n LEFT JOIN children ch ON ch.d = n.d AND ch.key = n.key JOIN path p ON p.conv_id = n.conv_id AND p.d <= n.d GROUP BY p.d, p.key
)
SELECT n.conv_id, n.d::BIGINT AS depth, n.parent_conv_id, n.n_convs, coalesce(ch.n_children, 0)::BIGINT AS n_children, b.n_leaves,
    b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM linked n JOIN below b ON b.d = n.d AND b.key = n.key LEFT JOIN children ch ON ch.d = n.d AND ch.key = n.key"""
