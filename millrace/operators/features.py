"""Configured features: functions over tags, null report, imputation, lags and time aggregation.

All features of a run are computed together. The configuration is joined as a small table and decides by
value what happens to a row, so the plan does not grow with the number of features. A list feature is one
series per element, numbered in configuration order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import Feature, StoreConfig, local_table
from millrace.functions.scalar import at_least_flag, impute_when_up, mass_rate, ratio_or_null
from millrace.functions.times import Grid
from millrace.operators.history import ANCHOR, PLANT_SERIES
from millrace.operators.signals import centred_median
from millrace.operators.trend import TREND_POINTS, TrendLimits, merged_part, part_level

# Fixed names of feature functions and time aggregations in the configuration.
MEAN, MAX, MASS_RATE = "mean", "max", "thickener_underflow_mass_rate"
TARGET, GREATER, PASSTHROUGH = "moisture_target", "greater", "passthrough"
LAST, TORQUE, RATIO, MEAN_GREATER = "last", "torque", "ratio", "mean_greater"

FUNCTIONS = frozenset({MEAN, MAX, MASS_RATE, TARGET, GREATER, PASSTHROUGH})
AGGREGATIONS = frozenset({MEAN, LAST, TORQUE, RATIO, MEAN_GREATER})

#: Slot of the plant state in the exploded cells; it gives features without tags a row at every instant.
STATE_SLOT = 0
FIRST_TAG_SLOT = 1 + len(PLANT_SERIES)
#: Feature id of the series of the plant state itself.
PLANT_STATE = -(2**31)
ANTICIPATION_STEPS = 60


def operands(feature: Feature) -> tuple[str, ...]:
    """Tags a feature reads, in order; mass rates name theirs in the custom input."""
    if feature.function == MASS_RATE and feature.custom:
        return tuple(c.replace(" ", "") for c in feature.custom)
    if feature.function == TARGET:
        return ()
    return feature.tags


def require_pairs(features: Sequence[Feature]) -> None:
    """A ratio is of exactly two readings: raise for a feature that would take it of fewer or of more."""
    wrong = [f.id for f in features if RATIO in (f.current, f.anticipated) and len(operands(f)) != 2]
    if wrong:
        raise ValueError(f"a ratio needs two tags: features {', '.join(map(str, wrong))}")


def needed_tags(features: Sequence[Feature], cfg: StoreConfig) -> list[str]:
    """Tags the features read; everything else is dropped before the first shuffle."""
    return sorted({t for f in features for t in operands(f)} - set(PLANT_SERIES))


@dataclass(frozen=True)
class Slots:
    """Positions of tags and plant series in the exploded cells."""

    tags: tuple[str, ...]

    def of(self, name: str) -> int:
        if name in PLANT_SERIES:
            return 1 + PLANT_SERIES.index(name)
        return FIRST_TAG_SLOT + self.tags.index(name)

    def smoothed(self, cfg: StoreConfig) -> list[int]:
        return [self.of(t) for t in self.tags if t in set(cfg.smoothed_tags)]


def operand_table(spark: SparkSession, features: Sequence[Feature], slots: Slots) -> DataFrame:
    """``(slot, feature_id, operand, elem)``: one row per feature and operand; a feature without any reads the plant state.

    Every operand of a list feature is an element of its own; all other features have one element, 0.
    """
    rows = [(slots.of(t), f.id, i, i if f.function == PASSTHROUGH else 0) for f in features for i, t in enumerate(operands(f))]
    # the plant state's own series reads it as its operand
    rows += [(STATE_SLOT, f.id, 0 if f.id == PLANT_STATE else -1, 0) for f in features if not operands(f)]
    names = ("slot", "feature_id", "operand", "elem")
    return local_table(spark, {name: (pa.int32(), [r[i] for r in rows]) for i, name in enumerate(names)})


def function_table(spark: SparkSession, features: Sequence[Feature]) -> DataFrame:
    """What decides a feature's value at one instant."""
    return local_table(
        spark,
        {
            "feature_id": (pa.int32(), [f.id for f in features]),
            "function": (pa.string(), [f.function for f in features]),
            "limit": (pa.int64(), [_threshold(f) for f in features]),
            "impute": (pa.float64(), [f.null_impute for f in features]),
        },
    )


def aggregation_table(spark: SparkSession, features: Sequence[Feature]) -> DataFrame:
    """How a feature's candidate aggregates turn into its outputs."""
    return local_table(
        spark,
        {
            "feature_id": (pa.int32(), [f.id for f in features]),
            "current_agg": (pa.string(), [f.current for f in features]),
            "ahead_agg": (pa.string(), [f.anticipated for f in features]),
            "threshold": (pa.int64(), [_threshold(f) for f in features]),
            "null_limit": (pa.float64(), [f.null_threshold for f in features]),
            "is_list": (pa.bool_(), [f.function == PASSTHROUGH for f in features]),
        },
    )


def elements(feature: Feature) -> int:
    """How many series a feature has: one per operand of a list, else one."""
    return max(len(operands(feature)), 1) if feature.function == PASSTHROUGH else 1


def _threshold(f: Feature) -> int | None:
    return f.threshold if f.function == GREATER or f.current == MEAN_GREATER else None


def gap_value(feature: Feature, cfg: StoreConfig) -> float | None:
    """A feature's value at an instant without any reading, where the plant counts as down."""
    if feature.function == TARGET:
        return cfg.moisture_target
    return 0.0 if feature.function == GREATER else None


#: What is read off a feature's series: the null share, the value now and an hour ahead, the quotient of two elements, the trend.
SHARE, NOW, AHEAD, PAIR, TREND = range(5)


def anticipated_lag(feature: Feature) -> int:
    return feature.lag - ANTICIPATION_STEPS if feature.lag is not None and feature.lag > ANTICIPATION_STEPS else 0


def readings(feature: Feature) -> list[tuple[int, int, int | None]]:
    """``(kind, first rank, last rank)`` of what a feature's outputs need; rank 1 is the newest row.

    Shifting by ``lag`` rows and taking the newest ``n`` reads the ranks ``lag+1 .. lag+n``, so no shifted series is ever built. The
    null share reads all rows (last rank: none).
    """
    lag, ahead = feature.lag or 0, anticipated_lag(feature)
    found = [(SHARE, 1, None)]
    if feature.current in (MEAN, LAST, MEAN_GREATER):
        found.append((NOW, lag + 1, lag + feature.steps))
    if feature.anticipated in (MEAN, LAST):
        found.append((AHEAD, ahead + 1, ahead + feature.steps))
    if feature.current == RATIO:
        found.append((PAIR, lag + 1, lag + feature.steps))
    if feature.current == TORQUE:
        found.append((TREND, lag + 1, lag + TREND_POINTS))
    return found


def cell_rows(frame: DataFrame, slots: Slots, wanted: Sequence[int], carried: Sequence[str]) -> DataFrame:
    """A frame's arrays as rows ``(carried..., plant_up, slot, value)``, one per wanted slot; absent cells are null."""
    state = F.array(F.col("plant_up").cast("double"))
    unknown = F.array_repeat(F.lit(None).cast("double"), len(PLANT_SERIES))
    constants = F.coalesce("constants", unknown) if "constants" in frame.columns else unknown
    cells = F.coalesce("cells", F.array_repeat(F.lit(None).cast("double"), len(slots.tags)))
    every = F.concat(state, constants, cells)
    rows = frame.select(*carried, "plant_up", F.posexplode(every).alias("slot", "value"))
    return rows.where(F.col("slot").isin(list(wanted)))


def wanted_slots(features: Sequence[Feature], slots: Slots) -> list[int]:
    wanted = {slots.of(t) for f in features for t in operands(f)}
    if not all(operands(f) for f in features):
        wanted.add(STATE_SLOT)
    return sorted(wanted)


def smooth_cells(rows: DataFrame, slots: Slots, cfg: StoreConfig, keys: Sequence[str]) -> DataFrame:
    """Low-pass the numeric tags inside each bounded series that ``keys`` name."""
    smoothed = slots.smoothed(cfg)
    if not smoothed:
        return rows
    is_smoothed = F.col("slot").isin(smoothed)
    width = Grid(cfg.step_seconds).span(cfg.smooth_steps)
    median = centred_median(F.when(is_smoothed, F.col("value")), [*keys, "slot"], "micros", width, cfg.smooth_min)
    return rows.withColumn("value", F.when(is_smoothed, median).otherwise(F.col("value")))


def feature_values(
    rows: DataFrame, cfg: StoreConfig, features: Sequence[Feature], slots: Slots, impute: bool, keys: Sequence[str], at: Sequence[str]
) -> DataFrame:
    """Every feature's value at every instant (``keys`` and ``at``) of cell rows, after its function and imputation.

    One row per element: ``(keys..., at..., feature_id, elem, value, missing)``. ``missing`` tells whether the value was null before
    imputation; a list itself is never missing.
    """
    spark = rows.sparkSession
    joined = rows.join(operand_table(spark, features, slots), "slot")
    operand_at, value = F.col("operand"), F.col("value")
    used = {f.function for f in features}

    def operand(i: int) -> Column:
        return F.max(F.when(operand_at == i, value))

    measures = {"plant_up": F.max("plant_up"), "p0": operand(0)}
    if MEAN in used:
        measures["mean"] = F.avg(F.when(operand_at >= 0, value))
    if used & {MAX, PASSTHROUGH}:
        measures["max"] = F.max(F.when(operand_at >= 0, value))
    if MASS_RATE in used:
        measures |= {f"p{i}": operand(i) for i in (1, 2, 3)}
    grouped = joined.groupBy(*keys, "feature_id", "elem", *at).agg(*[c.alias(n) for n, c in measures.items()])

    rows = grouped.join(function_table(spark, features), "feature_id")
    function = F.col("function")
    result = F.when(function.isNull(), F.col("p0"))
    if MEAN in used:
        result = result.when(function == MEAN, F.col("mean"))
    if used & {MAX, PASSTHROUGH}:
        # an element of a list has one operand
        result = result.when(function.isin(MAX, PASSTHROUGH), F.col("max"))
    if MASS_RATE in used:
        result = result.when(function == MASS_RATE, mass_rate(*[F.col(f"p{i}") for i in range(4)]))
    if TARGET in used:
        result = result.when(function == TARGET, F.lit(cfg.moisture_target))
    if GREATER in used:
        result = result.when(function == GREATER, at_least_flag(F.col("p0"), F.col("limit")).cast("double"))
    rows = rows.withColumn("value", result.cast("double"))
    is_list = F.coalesce(function == PASSTHROUGH, F.lit(False))
    rows = rows.withColumn("missing", F.when(is_list, 0).otherwise(F.col("value").isNull().cast("int")))
    if impute:
        rows = rows.withColumn("value", impute_when_up(F.col("value"), F.col("plant_up"), F.col("impute")))
    return rows.select(*keys, *at, "feature_id", "elem", "value", "missing")


#: One partial result of an element of a feature: which reading it belongs to, its place among the others, rows, sums, and the newest
#: value with its rank. Few of them make up a reading, so they can be added in order and a result never depends on the shuffle.
PARTIAL = "struct<kind:int,place:int,n:bigint,s:double,c:bigint,m:bigint,rank:bigint,v:double>"


def partial_row(kind: Column, place: Column, n: Column, s: Column, c: Column, m: Column, rank: Column, v: Column) -> Column:
    names = ("kind", "place", "n", "s", "c", "m", "rank", "v")
    return F.struct(*[col.alias(name) for col, name in zip((kind, place, n, s, c, m, rank, v), names)]).cast(PARTIAL)


def with_each(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Every row with every row of a table as small as the configuration."""
    one = F.lit(1).alias("_one")
    return rows.select("*", one).join(F.broadcast(table.select("*", one)), "_one").drop("_one")


def element_table(spark: SparkSession, cfg: StoreConfig, features: Sequence[Feature]) -> DataFrame:
    """One row per element of each feature, with the value and share its gaps have and the ranks its readings begin and end at."""
    rows = [(f, e) for f in features for e in range(elements(f))]
    gaps = [gap_value(f, cfg) for f, _ in rows]
    return local_table(
        spark,
        {
            "feature_id": (pa.int32(), [f.id for f, _ in rows]),
            "elem": (pa.int32(), [e for _, e in rows]),
            "gap": (pa.float64(), gaps),
            "gap_missing": (pa.int64(), [int(g is None and f.function != PASSTHROUGH) for (f, _), g in zip(rows, gaps)]),
            "lag": (pa.int64(), [f.lag or 0 for f, _ in rows]),
            "lag_ahead": (pa.int64(), [anticipated_lag(f) for f, _ in rows]),
            "steps": (pa.int64(), [f.steps for f, _ in rows]),
        },
    )


def finished_features(partials: DataFrame, bases: DataFrame, cfg: StoreConfig, features: Sequence[Feature]) -> DataFrame:
    """Outputs of every feature at every anchor: ``current``, ``anticipated``, the null share, and all elements of list features.

    ``bases(site_id, anchor_ts, total, tail)`` has every anchor once, with the rows its slice counts and, on the long horizon, how
    many of them an aggregate spans. ``partials(site_id, anchor_ts, feature_id, elem, partial, part)`` hold the rows that were found, a few each in
    sums or in parts of trends; all others are gaps. A scalar's outputs are those of its only element; of a list, ``current`` is its
    first element's, or the quotient of its two.
    """
    require_pairs(features)
    spark = partials.sparkSession
    every = with_each(bases, element_table(spark, cfg, features))
    used = {f.current for f in features} | {f.anticipated for f in features}
    lists = {"found": F.array_sort(F.collect_list("partial"))} | ({"parts": F.collect_list("part")} if TORQUE in used else {})
    listed = partials.groupBy(*ANCHOR, "feature_id", "elem").agg(*[c.alias(n) for n, c in lists.items()])
    rows = every.join(listed, [*ANCHOR, "feature_id", "elem"], "left")
    rows = rows.withColumn("found", F.coalesce("found", F.array().cast(f"array<{PARTIAL}>")))
    if TORQUE in used:
        rows = rows.withColumn("line", F.when(F.size("parts") > 0, merged_part("parts")))

    # SQL text reaches the session in one call; the same written with columns takes hundreds
    def added(kind: int, field: str) -> str:
        zero = "0D" if field == "s" else "0L"
        return f"aggregate(filter(found, p -> p.kind = {kind}), {zero}, (total, p) -> total + coalesce(p.{field}, {zero}))"

    def counted(lag: str, span: str) -> str:
        return f"greatest(least({lag} + {span}, total) - greatest({lag} + 1, 1L) + 1, 0L)"

    def mean(kind: int, lag: str, span: str) -> Column:
        filled = f"if(gap IS NULL, 0L, {counted(lag, span)} - {added(kind, 'n')})"
        n = f"({added(kind, 'c')} + {filled})"
        return F.expr(f"if({n} > 0, ({added(kind, 's')} + coalesce(gap, 0D) * {filled}) / {n}, NULL)")

    def last(kind: int, lag: str, span: str) -> Column:
        held = f"filter(found, p -> p.kind = {kind} AND p.v IS NOT NULL)"
        newest = f"array_min(transform({held}, p -> struct(p.rank AS rank, p.v AS v)))"
        is_gap = f"gap IS NOT NULL AND {counted(lag, span)} > 0 AND ({newest}.rank IS NULL OR {newest}.rank > greatest({lag} + 1, 1L))"
        return F.expr(f"if({is_gap}, gap, {newest}.v)")

    span = "coalesce(tail, steps)"
    measures = {
        "now_mean": mean(NOW, "lag", span),
        "ahead_mean": mean(AHEAD, "lag_ahead", span),
        "null_share": F.expr(f"({added(SHARE, 'm')} + (total - {added(SHARE, 'n')}) * gap_missing) / total"),
    }
    if LAST in used:
        measures |= {"now_last": last(NOW, "lag", span), "ahead_last": last(AHEAD, "lag_ahead", span)}
    if RATIO in used:
        measures["pair_mean"] = mean(PAIR, "lag", "steps")
    if TORQUE in used:
        measures["level"] = part_level("line", TrendLimits(cfg.trend_high, cfg.trend_high_high))
    rows = rows.select(*ANCHOR, "feature_id", "elem", *[c.alias(n) for n, c in measures.items()])
    rows = rows.join(F.broadcast(aggregation_table(spark, features)), "feature_id")
    now, then = F.col("current_agg"), F.col("ahead_agg")
    current = F.when(now == MEAN, F.col("now_mean"))
    anticipated = F.when(then == MEAN, F.col("ahead_mean"))
    if LAST in used:
        current = current.when(now == LAST, F.col("now_last"))
        anticipated = anticipated.when(then == LAST, F.col("ahead_last"))
    if MEAN_GREATER in used:
        current = current.when(now == MEAN_GREATER, at_least_flag(F.col("now_mean"), F.col("threshold")).cast("double"))
    if TORQUE in used:
        current = current.when(now == TORQUE, F.col("level"))
    rows = rows.withColumns({"current": current, "anticipated": anticipated})
    no_list = F.lit(None).cast("array<double>")
    if any(f.function == PASSTHROUGH for f in features):
        first = F.col("elem") == 0
        ordered = {
            name: F.when(F.max("is_list"), F.transform(F.array_sort(F.collect_list(F.struct("elem", F.col(name).alias("v")))), lambda x: x["v"]))
            for name in ("current", "anticipated")
        }
        kept = {name: F.max(F.when(first, F.col(name))) for name in ("current", "anticipated", "null_share")}
        pair = {f"pair{i}": F.max(F.when(F.col("elem") == i, F.col("pair_mean"))) for i in (0, 1)} if RATIO in used else {}
        fixed = ["current_agg", "null_limit"]
        rows = rows.groupBy(*ANCHOR, "feature_id").agg(
            *[c.alias(n) for n, c in (kept | pair).items()], *[F.max(c).alias(c) for c in fixed],
            *[c.alias(f"{n}_list") for n, c in ordered.items()],
        )
        if RATIO in used:
            quotient = ratio_or_null(F.col("pair0"), F.col("pair1"))
            rows = rows.withColumn("current", F.when(now == RATIO, quotient).otherwise(F.col("current")))
    else:
        rows = rows.withColumns({"current_list": no_list, "anticipated_list": no_list})
    return rows.select(
        *ANCHOR,
        "feature_id",
        "current",
        "anticipated",
        "null_share",
        F.coalesce(F.col("null_share") > F.col("null_limit"), F.lit(False)).alias("too_many_nulls"),
        "current_list",
        "anticipated_list",
    )
