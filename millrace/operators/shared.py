"""Features of many anchors from work that is done once per instant.

What a feature is at an instant does not depend on the anchor that reads it, but for two things: a smoothed value near the ends of
an anchor's slice, where the median's window is cut off, and the plant conditions, which are constant in a slice. So

* smoothing, feature functions and imputation run once over each series, in blocks of time at least as wide as a slice, with the few
  rows around a block that its medians need;
* every row of a block gets the sums over the block up to it (``with_prefixes``). An anchor's reading is a range of rows; it lies
  in two blocks at most and is read off the rows at the range's ends, two for each block (``range_requests``);
* only the rows within half a smoothing window of a slice's ends are smoothed anew for the anchor (``edge_rows``).

What follows the shuffle of events into blocks grows with events, and with anchors by their readings and edges, a few rows each; the
length of a slice does not matter. Series are ``(_block, site_id, phase)``: on the short horizon a grid of its own for each phase that
anchors have within a step, dense in the blocks that hold an event; on the long horizon the rows as they are, numbered by time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.config import Feature, StoreConfig, local_table
from millrace.functions.times import Grid, floor_div
from millrace.operators import features as fo
from millrace.operators.history import ANCHOR, PLANT_SERIES, compact_events, long_frame, short_frame
from millrace.operators.joins import anchor_slice
from millrace.operators.reshape import stack_rows
from millrace.operators.signals import next_known
from millrace.operators.trend import PART, own_sums, part_of_point, part_struct, segment_sums

SERIES = ["_block", "site_id", "phase"]
EDGE = ["anchor_ts", "site_id", "side"]
NEW_SIDE, OLD_SIDE = 0, 1
#: Readings of the plant state itself: the last hour, the hour before, what precedes the slice.
LAST_HOUR, HOUR_BEFORE, BEFORE_SLICE = 5, 6, 7


@dataclass(frozen=True)
class Horizon:
    """Sizes of one horizon. Times are microseconds; ``width`` is that of a block, and ``span`` of a slice."""

    dense: bool
    step: int
    slice_steps: int
    width: int
    span: int
    half: int

    @property
    def block_steps(self) -> int:
        return self.width // self.step

    @property
    def halo(self) -> int:
        """How far a median's window reaches, in whole steps on the grid."""
        return self.half // self.step if self.dense else self.half

    @property
    def newest_edge(self) -> int:
        """Grid steps at the newest end whose windows an anchor cuts off."""
        return -(-self.half // self.step)

    @property
    def oldest_edge(self) -> int:
        return max((self.half - 2) // self.step + 1, 0)


def horizon(cfg: StoreConfig, dense: bool) -> Horizon:
    grid = Grid(cfg.step_seconds)
    half = grid.span(cfg.smooth_steps) // 2
    steps = cfg.slice_steps if dense else cfg.long_slice_steps
    reach = max(cfg.switch_steps, steps) + 1 if dense else steps
    return Horizon(dense, grid.step_micros, steps, grid.span(reach), grid.span(steps), half)


def shares_work(feature: Feature, cfg: StoreConfig, h: Horizon) -> bool:
    """Whether a feature can be read off shared series.

    Not where a plant condition is mixed with tags, where gaps are points of a trend, or where the ends of a slice would overlap.
    """
    plant = [t in PLANT_SERIES for t in fo.operands(feature)]
    mixed = h.dense and any(plant) and not all(plant)
    gaps_are_points = fo.TORQUE == feature.current and fo.gap_value(feature, cfg) is not None
    return not mixed and not gaps_are_points and h.span > 4 * h.half


def is_constant(feature: Feature, h: Horizon) -> bool:
    """Whether a feature reads plant conditions only; they are known on the short horizon alone."""
    names = fo.operands(feature)
    return h.dense and bool(names) and all(t in PLANT_SERIES for t in names)


# --- series ---------------------------------------------------------------------------------------------


def _phase_and_step(micros: Column, h: Horizon) -> tuple[Column, Column]:
    phase = F.pmod(micros, F.lit(h.step))
    return phase, floor_div(micros, h.step)


def block_rows(events: DataFrame, anchors: DataFrame, h: Horizon, smooth: bool) -> DataFrame:
    """The rows of every block that an anchor sees: ``(_block, site_id, phase, pos, micros, own, plant_up, cells)``.

    ``pos`` numbers a block's own rows from 0; the others only serve medians. An event crosses the network once, or twice near the end
    of a block, and not at all where no anchor looks. The shuffle has the session's number of partitions, given explicitly, because
    rows multiply by slots and features behind it.
    """
    count = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    halo = h.halo if smooth else 0
    micros, at = F.unix_micros("ts"), F.unix_micros("anchor_ts")
    if h.dense:
        phase, step = _phase_and_step(micros, h)
        anchor_phase, anchor_step = _phase_and_step(at, h)
        size, first = h.block_steps, F.col("_step")
        seen = F.sequence(floor_div(anchor_step - (size - 1), size), floor_div(anchor_step, size))
    else:
        phase, step, anchor_phase = F.lit(0).cast("bigint"), micros, F.lit(0).cast("bigint")
        size, first = h.width, F.col("_step")
        seen = F.sequence(floor_div(at - h.span, size), floor_div(at, size))
    keys = anchors.select("site_id", anchor_phase.alias("phase"), F.explode(seen).alias("_block")).distinct()
    placed = events.select("site_id", phase.alias("phase"), step.alias("_step"), "plant_up", "cells")
    # an outer explode keeps Spark from filtering the source by this expression
    near = F.explode_outer(F.sequence(floor_div(first - halo, size), floor_div(first + halo, size)))
    copies = placed.withColumn("_block", near).join(keys, SERIES, "left_semi").repartition(count, "site_id", "phase", "_block")
    in_block = Window.partitionBy(*SERIES).orderBy("_step")
    start = F.col("_block") * size
    if not h.dense:
        own = floor_div(first, size) == F.col("_block")
        numbered = F.sum(own.cast("bigint")).over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - 1
        return copies.select(*SERIES, numbered.alias("pos"), first.alias("micros"), own.alias("own"), "plant_up", "cells")
    # the grid of the block is made from the distances between its rows, behind the shuffle
    begin = F.when(F.lag("_step").over(in_block).isNull(), start - halo).otherwise(first)
    end = F.coalesce(F.lead("_step").over(in_block), start + (size + halo)) - 1
    spanned = copies.withColumns({"_begin": F.least(begin, first), "_end": F.greatest(end, first)})
    filled = spanned.withColumn("_at", F.explode(F.sequence("_begin", "_end")))
    present = F.col("_at") == first
    pos = F.col("_at") - start
    return filled.select(
        *SERIES, pos.alias("pos"), (F.col("_at") * h.step + F.col("phase")).alias("micros"), pos.between(0, size - 1).alias("own"),
        F.when(present, F.coalesce("plant_up", F.lit(0))).otherwise(0).alias("plant_up"), F.when(present, F.col("cells")).alias("cells"),
    )


def series_values(rows: DataFrame, cfg: StoreConfig, features: Sequence[Feature], slots: fo.Slots, impute: bool) -> DataFrame:
    """Every feature at every row of the blocks, once: ``(_block, site_id, phase, pos, feature_id, elem, value, missing)``."""
    cells = fo.cell_rows(rows, slots, fo.wanted_slots(features, slots), [*SERIES, "pos", "micros", "own"])
    smooth = fo.smooth_cells(cells, slots, cfg, SERIES).where("own")
    return fo.feature_values(smooth, cfg, features, slots, impute, SERIES, ["pos"])


def with_prefixes(values: DataFrame, trended: Sequence[int]) -> DataFrame:
    """Sums over the block up to and with each row: values ``s`` and their count ``c``, missing ones ``m``, the newest value ``last``.

    For ``trended`` features also the moments up to the newest (``to``) and at the next point (``from``), against the block's first value.
    """
    series = [*SERIES, "feature_id", "elem"]
    ordered = Window.partitionBy(*series).orderBy("pos")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    held = F.col("value").isNotNull()
    sums = {
        "s": F.coalesce(F.sum("value").over(upto), F.lit(0.0)),
        "c": F.count("value").over(upto),
        "m": F.sum("missing").over(upto),
        "last": F.last(F.when(held, F.struct("pos", "value")), ignorenulls=True).over(upto),
    }
    if not trended:
        return values.withColumns(sums)
    is_trended = F.col("feature_id").isin(list(trended))
    known = values.withColumns(sums | {"ref": F.first(F.when(is_trended, F.col("value")), ignorenulls=True).over(upto)})
    x, y = F.col("pos").cast("double"), F.col("value") - F.col("ref")
    point = F.when(is_trended & held, F.struct(x.alias("x"), y.alias("y")))
    before = known.withColumn("before", F.last(point, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    b = F.col("before")
    steps = [
        F.when(point.isNotNull(), F.when(b.isNull(), alone).otherwise(joined))
        for alone, joined in zip(own_sums(x, y), segment_sums(b["x"], b["y"], x, y))
    ]
    moments = before.withColumns({f"t{i}": F.sum(step).over(upto) for i, step in enumerate(steps)})
    here = moments.withColumn("here", F.when(point.isNotNull(), F.struct(x.alias("x"), y.alias("y"), "t0", "t1", "t2")))
    ends = here.withColumns({"to": F.last("here", ignorenulls=True).over(upto), "from": F.coalesce("here", next_known("here", ordered))})
    return ends.drop("before", "here", "t0", "t1", "t2")


# --- anchors --------------------------------------------------------------------------------------------


def dense_facts(anchors: DataFrame, h: Horizon) -> DataFrame:
    """Per anchor on the grid: its phase and step, the rows its slice counts and where its ends begin (ranks, 1 the newest)."""
    phase, step = _phase_and_step(F.unix_micros("anchor_ts"), h)
    total = h.slice_steps + 1
    return anchors.select(
        *ANCHOR, phase.alias("phase"), step.alias("top"), F.lit(total).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("tail"),
        F.lit(total).cast("bigint").alias("rows"), F.lit(h.newest_edge).cast("bigint").alias("new_edge"), F.lit(h.oldest_edge).cast("bigint").alias("old_edge"),
        F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("start_before"), floor_div(step, h.block_steps).alias("block"),
    )


def rows_until(events: DataFrame, anchors: DataFrame, instants: dict[str, Column], width: int) -> DataFrame:
    """How many events of its site lie at or before each named instant (microseconds) of an anchor, one column per name.

    Events meet instants in blocks of time; only one row per block passes a window of a whole site.
    """
    marks = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), at.alias("micros")) for name, at in instants.items()]))
    asked = anchors.select(*ANCHOR, marks.alias("_mark")).select(*ANCHOR, "_mark.name", "_mark.micros")
    given = events.select("site_id", F.unix_micros("ts").alias("micros"), F.lit(1).alias("is_event"))
    block = floor_div(F.col("micros"), width).alias("_block")
    both = stack_rows(given, asked.withColumn("is_event", F.lit(0)), missing=True).withColumn("_block", block)
    # an event at the very instant counts
    in_block = Window.partitionBy("site_id", "_block").orderBy("micros", F.desc("is_event")).rowsBetween(Window.unboundedPreceding, 0)
    counted = both.withColumn("_n", F.sum("is_event").over(in_block)).where("is_event = 0")
    totals = both.groupBy("site_id", "_block").agg(F.sum("is_event").alias("_own"))
    lower = Window.partitionBy("site_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("site_id", "_block", F.coalesce(F.sum("_own").over(lower), F.lit(0)).alias("_before"))
    found = counted.join(before, ["site_id", "_block"])
    picked = [F.max(F.when(F.col("name") == name, F.col("_n") + F.col("_before"))).alias(name) for name in instants]
    return found.groupBy(*ANCHOR).agg(*picked)


def row_facts(events: DataFrame, anchors: DataFrame, h: Horizon, cfg: StoreConfig) -> DataFrame:
    """The same on rows as they are; ``top`` numbers the newest row of the slice, ``start`` and ``start_before`` the rows before its two blocks.

    An anchor without any earlier row counts the empty short grid before it.
    """
    at = F.unix_micros("anchor_ts")
    first_block = floor_div(at, h.width) * h.width
    oldest = at - h.span
    instants = {
        "top": at, "earlier": at - 1, "below": oldest - 1, "recent": at - Grid(cfg.step_seconds).span(cfg.long_steps), "new_from": at - h.half,
        "old_to": oldest + h.half - 2, "start": first_block - 1, "start_before": first_block - h.width - 1,
    }
    n = rows_until(events, anchors, instants, h.width)
    rows, own = F.col("top") - F.col("below"), F.col("top") - F.col("earlier")
    alone = F.col("earlier") == F.col("below")
    return n.select(
        *ANCHOR, F.lit(0).cast("bigint").alias("phase"), "top", F.when(alone, own + cfg.slice_steps).otherwise(rows).alias("total"),
        F.when(alone, own + min(cfg.slice_steps, cfg.long_steps - 1)).otherwise(F.col("top") - F.col("recent")).alias("tail"),
        rows.alias("rows"), (F.col("top") - F.col("new_from")).alias("new_edge"), F.greatest(F.col("old_to") - F.col("below"), F.lit(0)).alias("old_edge"),
        "start", "start_before", floor_div(at, h.width).alias("block"),
    )


def reading_table(spark: SparkSession, features: Sequence[Feature], edged: set[int], spans_tail: bool) -> DataFrame:
    """One row per reading of each feature: ``kind``, its ranks, and whether the ends of the slice are read apart.

    ``spans_tail``: means and last values end with the anchor's tail instead of a fixed number of rows.
    """
    rows = []
    for f in features:
        for kind, first, last in fo.readings(f):
            follows = spans_tail and kind in (fo.NOW, fo.AHEAD)
            rows.append((f.id, kind, first, None if follows else last, follows, f.id in edged, fo.elements(f)))
    return _reading_rows(spark, rows)


def _reading_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32())
    names = ("feature_id", "kind", "first", "last", "follows", "edged", "elems")
    return local_table(spark, {n: (k, [r[i] for r in rows]) for i, (n, k) in enumerate(zip(names, kinds))})


def _ranks() -> tuple[Column, Column]:
    """First and last rank of a reading, within the slice's rows."""
    last = F.when(F.col("follows"), F.col("first") - 1 + F.col("tail")).otherwise(F.coalesce("last", F.col("total")))
    return F.greatest("first", F.lit(1)), F.least(last, F.col("total"))


def range_requests(facts: DataFrame, table: DataFrame, h: Horizon) -> DataFrame:
    """The rows to look up: ``(_block, site_id, phase, feature_id, elem, pos)`` at both ends of each reading in each of its blocks.

    ``base`` places the block's rows: a row's rank is ``top - base - pos + 1``.
    """
    first, last = _ranks()
    asked = fo.with_each(facts, table).withColumns({"r1": first, "r2": F.least(last, F.col("rows"))})
    inner_first = F.when(F.col("edged"), F.greatest(F.col("r1"), F.col("new_edge") + 1)).otherwise(F.col("r1"))
    inner_last = F.when(F.col("edged"), F.least(F.col("r2"), F.col("rows") - F.col("old_edge"))).otherwise(F.col("r2"))
    inner = asked.withColumns({"r1": inner_first, "r2": inner_last}).where("r1 <= r2")
    low, high = F.col("top") - F.col("r2") + 1, F.col("top") - F.col("r1") + 1
    if h.dense:
        size = h.block_steps
        blocks = F.transform(F.sequence(floor_div(low, size), floor_div(high, size)), lambda b: F.struct(
            b.alias("block"), (b * size).alias("base"), F.greatest(low - b * size, F.lit(0)).alias("p1"), F.least(high - b * size, F.lit(size - 1)).alias("p2")))
    else:
        # rows are numbered from 1 over all blocks and from 0 within one
        def part(block: Column, before: Column, end: Column) -> Column:
            return F.struct(block.alias("block"), (before + 1).alias("base"), (F.greatest(low, before + 1) - before - 1).alias("p1"), (F.least(high, end) - before - 1).alias("p2"))

        own = part(F.col("block"), F.col("start"), F.col("top"))
        earlier = part(F.col("block") - 1, F.col("start_before"), F.col("start"))
        blocks = F.filter(F.array(earlier, own), lambda p: p["p1"] <= p["p2"])
    pieces = inner.select(*ANCHOR, "phase", "feature_id", "elems", "kind", "first", "top", F.posexplode(blocks).alias("piece", "b"))
    ends = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(f"b.{p}").alias("pos")) for side, p in ((0, "p1"), (1, "p2"))]))
    sided = pieces.select(*ANCHOR, "phase", "feature_id", "elems", "kind", "first", "top", "piece", "b", ends.alias("e"))
    every = sided.withColumn("elem", F.explode(F.sequence(F.lit(0), F.col("elems") - 1)))
    return every.select(
        F.col("b.block").alias("_block"), "site_id", "phase", "feature_id", "elem", F.col("e.pos").alias("pos"), "anchor_ts", "kind", "first", "top",
        "piece", F.col("e.side").alias("side"), F.col("b.base").alias("base"), F.col("b.p1").alias("p1"), F.col("b.p2").alias("p2"),
    )


def range_pieces(prefixes: DataFrame, requests: DataFrame) -> DataFrame:
    """``(site_id, anchor_ts, feature_id, elem, kind, partial, part)``: what each reading finds in each of its blocks.

    Sums up to the end of the range, less what precedes its start. Both ends of a range lie in one block, so they meet without a
    shuffle. The x of a trend runs from 0, the oldest point, to 119.
    """
    # in the order the prefixes were summed in, so that they are not sorted once more
    found = requests.join(prefixes, [*SERIES, "feature_id", "elem", "pos"])
    is_end = F.col("side") == 1
    keys = [*SERIES, "anchor_ts", "feature_id", "elem", "kind", "piece"]
    has_trend = "ref" in prefixes.columns

    def at(end: int, name: str) -> Column:
        return F.max(F.when(is_end if end else ~is_end, F.col(name)))

    measures = {c: F.max(c) for c in ("top", "base", "p1", "p2", "first")}
    measures |= {f"{c}{end}": at(end, c) for c in ("s", "c", "m") for end in (0, 1)} | {"value": at(0, "value"), "missing": at(0, "missing"), "last": at(1, "last")}
    if has_trend:
        measures |= {"ref": at(1, "ref"), "a": at(0, "from"), "b": at(1, "to")}
    rows = found.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])
    held = F.col("value").isNotNull().cast("bigint")
    newest = F.col("last.pos") >= F.col("p1")
    c = F.col("c1") - F.col("c0") + held
    partial = fo.partial_row(
        F.col("kind"), F.col("piece"), F.col("p2") - F.col("p1") + 1, F.col("s1") - F.col("s0") + F.coalesce("value", F.lit(0.0)), c,
        F.col("m1") - F.col("m0") + F.col("missing"), F.when(newest, F.col("top") - F.col("base") - F.col("last.pos") + 1), F.when(newest, F.col("last.value")),
    )
    is_trend = F.col("kind") == fo.TREND
    columns = [F.when(~is_trend, partial).alias("partial")]
    if has_trend:
        a, b = F.col("a"), F.col("b")
        shift = (F.lit(118) + F.col("first") - F.col("top") + F.col("base")).cast("double")
        s0, s1, s2 = (b[f"t{i}"] - a[f"t{i}"] + own for i, own in enumerate(own_sums(a["x"], a["y"])))
        part = part_struct({
            "fx": a["x"] + shift, "fy": a["y"], "lx": b["x"] + shift, "ly": b["y"], "ref": F.col("ref"), "points": c, "s0": s0, "s1": s1 + shift * s0, "s2": s2})
        inside = (a["x"] <= F.col("p2")) & (b["x"] >= F.col("p1"))
        columns.append(F.when(is_trend & inside, part).alias("part"))
    return rows.select(*ANCHOR, "feature_id", "elem", "kind", *columns)


# --- rows that anchors have for themselves ----------------------------------------------------------------


def edge_rows(events: DataFrame, facts: DataFrame, h: Horizon) -> DataFrame:
    """The rows at both ends of each slice, with those its medians need: ``(anchor_ts, site_id, side, micros, rank, total, tail, is_edge, plant_up, cells)``."""
    count = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.unix_micros("anchor_ts")
    reach = (max(h.newest_edge, h.oldest_edge) - 1 + h.halo) * h.step if h.dense else 2 * h.half
    ends = F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), F.timestamp_micros(to).alias("until")) for side, to in ((NEW_SIDE, at), (OLD_SIDE, at - h.span + reach))
    ]))
    known = ["rows", "total", "tail"]
    sides = facts.select(*ANCHOR, *known, ends.alias("_e")).select("site_id", F.col("anchor_ts").alias("_anchor"), *known, "_e.side", F.col("_e.until").alias("anchor_ts"))
    sliced = anchor_slice(events, sides, reach, carried=("_anchor", "side", *known))
    found = sliced.select(F.col("_anchor").alias("anchor_ts"), "site_id", "side", *known, F.unix_micros("ts").alias("micros"), "plant_up", "cells")
    is_new = F.col("side") == NEW_SIDE
    if h.dense:
        on_grid = found.where(F.pmod(at - F.col("micros"), F.lit(h.step)) == 0)
        steps = F.sequence(F.lit(0), F.lit(reach // h.step))
        spread = sides.select(F.col("_anchor").alias("anchor_ts"), "site_id", "side", *known, F.unix_micros("anchor_ts").alias("_until"), F.explode(steps).alias("_back"))
        grid = spread.withColumn("micros", F.col("_until") - F.col("_back") * F.lit(h.step)).drop("_until", "_back")
        every = stack_rows(on_grid, grid, missing=True).repartition(count, *EDGE)
        rows = every.groupBy(*EDGE, "micros").agg(
            *[F.max(c).alias(c) for c in known], F.coalesce(F.max("plant_up"), F.lit(0)).alias("plant_up"), F.first("cells", ignorenulls=True).alias("cells"))
        rank = floor_div(at - F.col("micros"), h.step) + 1
        edge = F.when(is_new, rank <= h.newest_edge).otherwise(rank > F.col("rows") - h.oldest_edge)
    else:
        rows = found.repartition(count, *EDGE)
        newest, oldest = Window.partitionBy(*EDGE).orderBy(F.desc("micros")), Window.partitionBy(*EDGE).orderBy("micros")
        rank = F.when(is_new, F.row_number().over(newest)).otherwise(F.col("rows") - F.row_number().over(oldest) + 1).cast("bigint")
        edge = F.when(is_new, F.col("micros") > at - h.half).otherwise(F.col("micros") < at - h.span + h.half - 1)
    return rows.select(*EDGE, "micros", rank.alias("rank"), "total", "tail", edge.alias("is_edge"), "plant_up", "cells")


def edge_values(rows: DataFrame, cfg: StoreConfig, features: Sequence[Feature], slots: fo.Slots, impute: bool) -> DataFrame:
    cells = fo.cell_rows(rows, slots, fo.wanted_slots(features, slots), [*EDGE, "micros", "rank", "total", "tail", "is_edge"])
    smooth = fo.smooth_cells(cells, slots, cfg, EDGE).where("is_edge")
    return fo.feature_values(smooth, cfg, features, slots, impute, EDGE, ["rank", "total", "tail"])


def frame_values(frame: DataFrame, cfg: StoreConfig, features: Sequence[Feature], slots: fo.Slots, impute: bool) -> DataFrame:
    """Features at every row of whole slices, one copy per anchor: for the few that cannot share work."""
    keys = ["anchor_ts", "site_id", "_block"]
    cells = fo.cell_rows(frame, slots, fo.wanted_slots(features, slots), [*keys, "micros", "rank"])
    return fo.feature_values(fo.smooth_cells(cells, slots, cfg, keys), cfg, features, slots, impute, keys, ["rank"]).drop("_block")


def rank_pieces(values: DataFrame, table: DataFrame) -> DataFrame:
    """The same of rows that carry their rank: each row counts for all readings it belongs to."""
    first, last = _ranks()
    met = values.join(F.broadcast(table), "feature_id").where(F.col("rank").between(first, last))
    held = F.col("value").isNotNull()
    one = F.lit(1).cast("bigint")
    partial = fo.partial_row(
        F.col("kind"), (F.col("rank") + 10).cast("int"), one, F.coalesce("value", F.lit(0.0)), held.cast("bigint"), F.col("missing"),
        F.when(held, F.col("rank")), F.col("value"),
    )
    is_trend = F.col("kind") == fo.TREND
    point = part_of_point(F.lit(119) + F.col("first") - F.col("rank"), F.col("value"))
    return met.select(*ANCHOR, "feature_id", "elem", "kind", F.when(~is_trend, partial).alias("partial"), F.when(is_trend & held, point).alias("part"))


# --- plant conditions -------------------------------------------------------------------------------------


def plant_readings(spark: SparkSession, cfg: StoreConfig) -> DataFrame:
    hour, steps = cfg.hour_steps, cfg.slice_steps
    ranges = ((LAST_HOUR, 2, hour + 1), (HOUR_BEFORE, hour + 2, 2 * hour + 1), (BEFORE_SLICE, steps + 2, cfg.switch_steps + 1))
    return _reading_rows(spark, [(fo.PLANT_STATE, kind, first, last, False, False, 1) for kind, first, last in ranges])


def plant_constants(events: DataFrame, anchors: DataFrame, facts: DataFrame, cfg: StoreConfig, h: Horizon) -> DataFrame:
    """Uptime flag, switch flag and minutes up of every anchor, as one array in the order of ``PLANT_SERIES``, with its facts."""
    state, slots = [Feature(fo.PLANT_STATE)], fo.Slots(())
    bare = events.select("site_id", "ts", "plant_up", F.lit(None).cast("array<double>").alias("cells"))
    values = series_values(block_rows(bare, anchors, h, False), cfg, state, slots, False)
    least = F.lit(cfg.switch_steps + 1).cast("bigint")
    reaching = facts.withColumns({"rows": F.greatest("rows", least), "total": F.greatest("total", least)})
    pieces = range_pieces(with_prefixes(values, []), range_requests(reaching, plant_readings(events.sparkSession, cfg), h))
    sums = pieces.groupBy(*ANCHOR).agg(*[F.sum(F.when(F.col("kind") == k, F.col("partial.s"))).alias(f"up{k}") for k in (LAST_HOUR, HOUR_BEFORE, BEFORE_SLICE)])
    known = facts.select(*ANCHOR, "total", "tail").join(sums, ANCHOR, "left")
    minutes, before, earlier = (F.coalesce(f"up{k}", F.lit(0.0)) for k in (LAST_HOUR, HOUR_BEFORE, BEFORE_SLICE))
    running = (minutes / cfg.hour_steps > cfg.up_share) & (before / cfg.hour_steps > cfg.up_share)
    width = cfg.switch_steps - cfg.slice_steps
    share = earlier / width if width > 0 else F.lit(0.0)
    flags = (F.when(running, 1.0).otherwise(0.0), F.when(share < cfg.switch_share, 1.0).otherwise(0.0), minutes)
    return known.select(*ANCHOR, "total", "tail", F.array(*flags).alias("constants"))


def constant_pieces(constants: DataFrame, table: DataFrame, cfg: StoreConfig, features: Sequence[Feature], slots: fo.Slots) -> DataFrame:
    """The same of features of plant conditions, which have one value at every row of the slice."""
    rows = constants.withColumns({"plant_up": F.lit(0), "cells": F.lit(None).cast("array<double>")})
    cells = fo.cell_rows(rows, slots, fo.wanted_slots(features, slots), [*ANCHOR, "total", "tail"])
    values = fo.feature_values(cells, cfg, features, slots, False, ANCHOR, ["total", "tail"])
    first, last = _ranks()
    met = values.join(F.broadcast(table), "feature_id").withColumns({"r1": first, "r2": last}).where("r1 <= r2")
    n, held = F.col("r2") - F.col("r1") + 1, F.col("value").isNotNull()
    partial = fo.partial_row(
        F.col("kind"), F.lit(0), n, n * F.coalesce("value", F.lit(0.0)), n * held.cast("bigint"), n * F.col("missing"), F.when(held, F.col("r1")), F.col("value"))
    zero, is_trend = F.lit(0.0), F.col("kind") == fo.TREND
    part = part_struct({c: zero for c in PART} | {
        "fx": (F.lit(119) + F.col("first") - F.col("r2")).cast("double"), "lx": (F.lit(119) + F.col("first") - F.col("r1")).cast("double"),
        "ref": F.col("value"), "points": n})
    return met.select(*ANCHOR, "feature_id", "elem", "kind", F.when(~is_trend, partial).alias("partial"), F.when(is_trend & held, part).alias("part"))


# --- all together -----------------------------------------------------------------------------------------


def horizon_features(events: DataFrame, anchors: DataFrame, cfg: StoreConfig, features: Sequence[Feature], dense: bool) -> DataFrame:
    """Outputs of all ``features`` of one horizon at every anchor (see ``finished_features``). ``events`` are corrected and nested."""
    spark, h = events.sparkSession, horizon(cfg, dense)
    anchors = anchors.select(*ANCHOR).distinct()
    slots = fo.Slots(tuple(fo.needed_tags(features, cfg)))
    compact = compact_events(events, slots.tags)
    facts = dense_facts(anchors, h) if dense else row_facts(events.select("site_id", "ts"), anchors, h, cfg)
    shared = [f for f in features if shares_work(f, cfg, h)]
    constant = [f for f in shared if is_constant(f, h)]
    series = [f for f in shared if not is_constant(f, h)]
    alone = [f for f in features if not shares_work(f, cfg, h)]
    smoothed = set(slots.smoothed(cfg))
    edged = [f for f in series if any(slots.of(t) in smoothed for t in fo.operands(f))]
    trended = [f.id for f in features if f.current == fo.TORQUE]

    pieces = []
    if series:
        values = series_values(block_rows(compact, anchors, h, bool(edged)), cfg, series, slots, impute=dense)
        table = reading_table(spark, series, {f.id for f in edged}, not dense)
        trended = [f.id for f in series if f.current == fo.TORQUE]
        pieces.append(range_pieces(with_prefixes(values, trended), range_requests(facts, table, h)))
    if constant:
        constants = plant_constants(compact, anchors, facts, cfg, h)
        pieces.append(constant_pieces(constants, reading_table(spark, constant, set(), False), cfg, constant, slots))
    if edged:
        values = edge_values(edge_rows(compact, facts, h), cfg, edged, slots, impute=dense)
        pieces.append(rank_pieces(values, reading_table(spark, edged, set(), not dense)))
    if alone:
        frame = short_frame(compact, anchors, cfg) if dense else long_frame(compact, anchors, cfg)
        values = frame_values(frame, cfg, alone, slots, impute=dense).join(facts.select(*ANCHOR, "total", "tail"), ANCHOR)
        pieces.append(rank_pieces(values, reading_table(spark, alone, set(), not dense)))
    return fo.finished_features(stack_rows(*pieces, missing=True), facts.select(*ANCHOR, "total", "tail"), cfg, features)
