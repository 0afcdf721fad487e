"""Synthetic events of any size as a Spark job, steered by the same kind of configuration."""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
NULL_SHARE = 0.2
#: Modulus and multiplier of the draws: products stay below 2^63, so every engine with 64-bit integers draws the same numbers.
MODULUS, FACTOR, SHIFT = 2**31 - 1, 48271, 13


@dataclass(frozen=True)
class EventSpec:
    """One event type: its scalar fields and record value with their types, ids, limits and choices.

    ``allowed`` maps an id or a field to the values it may take. ``nullable`` names fields (or ``value``)
    that are null in a fifth of the rows.
    """

    fields: Mapping[str, str]
    ids: Sequence[str] = ("#NA",)
    value_type: str = "float"
    allowed: Mapping[str, Sequence[float]] = field(default_factory=dict)
    nullable: Sequence[str] = ()
    float_range: tuple[float, float] = (-400.0, 1200.0)
    int_range: tuple[int, int] = (0, 100)
    seed: int = 42


def sequence_id(index: Column, base: int = 10**15) -> Column:
    """Consecutive 16-digit identifiers with leading zeros; numbers that need more digits are an error, never cut."""
    number = index + F.lit(base)
    too_long = F.raise_error(F.concat(F.lit("sequence id beyond 16 digits: "), number.cast("string")))
    return F.when(number < F.lit(10**16), F.lpad(number.cast("string"), 16, "0")).otherwise(too_long)


def number_of(name: str) -> int:
    """The number that stands for a name in a draw."""
    return zlib.crc32(name.encode()) % MODULUS


def drawn(state: Column, part: Column | int) -> Column:
    """The next draw, 0 to ``MODULUS`` - 1, from the draw before it and one more number: a multiplicative step, its bits mixed."""
    number = F.lit(part % MODULUS).cast("bigint") if isinstance(part, int) else F.pmod(part.cast("bigint"), F.lit(MODULUS))
    stepped = F.pmod((state + number + 1) * F.lit(FACTOR), F.lit(MODULUS))
    return _let(stepped, lambda x: F.pmod(x.bitwiseXOR(F.shiftright(x, SHIFT)), F.lit(MODULUS)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_draw(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """The draw all values of a row start from: its integer keys, instants in whole seconds; texts count by their hash."""
    state = F.lit(seed % MODULUS).cast("bigint")
    for k in keys:
        kind = df.schema[k].dataType
        number = F.unix_seconds(k) if isinstance(kind, T.TimestampType) else F.col(k) if isinstance(kind, T.IntegralType) else F.xxhash64(k)
        state = drawn(state, number)
    return state


def scaled(draw: Column, size: int) -> Column:
    """A draw as a whole number from 0 to ``size`` - 1."""
    if size > 2**32:
        raise ValueError("a range has at most 2^32 values")
    return F.call_function("div", draw * F.lit(size).cast("bigint"), F.lit(MODULUS))


def random_text(draw: Column, length: int = 10) -> Column:
    """Letters, one per position."""
    letters = F.lit(LETTERS)
    return F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(length)), lambda i: F.substring(letters, (scaled(drawn(draw, i), len(LETTERS)) + 1).cast("int"), F.lit(1))), ""
    )


@dataclass(frozen=True)
class Span:
    """Numbers from ``low`` to ``high``: of ``digits`` digits, or whole ones with both ends where that is None."""

    low: float
    high: float
    digits: int | None = None

    def at(self, draw: Column) -> Column:
        if self.digits is None:
            return (F.lit(int(self.low)) + scaled(draw, int(self.high - self.low) + 1)).cast("int")
        unit = 10**self.digits
        return (F.lit(round(self.low * unit)) + scaled(draw, round((self.high - self.low) * unit))) / F.lit(float(unit))


# Fixed names and limits of number types; those of "float" and "int" are configured.
SPANS = {"decimal": Span(-400.0, 1000.0, 6), "discrete": Span(0.0, 100.0, 6), "number": Span(0, 1), "bool": Span(0, 1)}


def typed_value(kind: str, draw: Column, spec: EventSpec, ts: Column) -> Column:
    """A value of the configured type from a draw; an unknown type gives empty text."""
    wanted = kind.lower()
    spans = SPANS | {"float": Span(*spec.float_range, 6), "int": Span(*spec.int_range)}
    if wanted in spans:
        return spans[wanted].at(draw)
    if wanted == "timestamp":
        return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if wanted == "string":
        return random_text(draw)
    return F.lit(False) if wanted == "fbool" else F.lit("")


def _choice(values: Sequence[float], draw: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, scaled(draw, len(values)).cast("int"))


def _nullable(value: Column, draw: Column) -> Column:
    return F.when(drawn(draw, number_of("null")) >= int(NULL_SHARE * MODULUS), value)


def _pick(name: str, kind: str, row: Column, ts: Column, spec: EventSpec) -> Column:
    draw = drawn(row, number_of(name))
    if name in spec.allowed:
        return _choice(spec.allowed[name], draw)
    value = typed_value(kind, draw, spec, ts)
    return _nullable(value, draw) if name in spec.nullable else value


def synthetic_events(instants: DataFrame, spec: EventSpec, keys: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """One event per row of ``instants``: scalar fields and a list of ``{id, value}`` for every id.

    All values follow from the keys, so rows are made where they lie, without a shuffle.
    """
    instants = instants.withColumn("_draw", row_draw(instants, keys, spec.seed))
    row, ts = F.col("_draw"), F.col(keys[-1])
    scalars = {n: _pick(n, kind, row, ts, spec) for n, kind in spec.fields.items()}
    free = [i for i in spec.ids if i not in spec.allowed]
    numeric = spec.value_type.lower() not in ("string", "timestamp", "fbool")

    def record(ident: Column) -> Column:
        draw = drawn(row, ident["number"])
        value = typed_value(spec.value_type, draw, spec, ts)
        value = value.cast("double") if numeric else value.cast("string")
        if "value" in spec.nullable:
            value = _nullable(value, draw)
        return F.struct(ident["id"].alias("id"), value.alias("value"))

    def chosen(ident: str) -> Column:
        value = _choice(spec.allowed[ident], drawn(row, number_of(ident)))
        value = value.cast("double") if numeric else value.cast("string")
        return F.struct(F.lit(ident).alias("id"), value.alias("value"))

    parts = [F.array(*[chosen(i) for i in spec.ids if i in spec.allowed])] if set(spec.ids) & set(spec.allowed) else []
    if free:
        parts.append(F.transform(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(number_of(i)).alias("number")) for i in free]), record))
    records = F.concat(*parts) if len(parts) > 1 else parts[0]
    return instants.select(*keys, *[c.alias(n) for n, c in scalars.items()], records.alias("records"))


#: Instants of one site that one task makes at once.
GRID_BLOCK = 10_000


def time_grid(sites: DataFrame, start: Column, end: Column, interval_seconds: int) -> DataFrame:
    """Every instant from start to end, both included, for every site.

    Blocks of instants are dealt out over tasks before they are written out, so one site may make up all the events. The number of
    tasks is given explicitly: blocks are a few bytes each, and merged by that size they would all be written out by one task.
    """
    count = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = interval_seconds * 1_000_000
    last = F.floor((F.unix_micros(end) - F.unix_micros(start)) / step).cast("bigint")
    spans = sites.select("site_id", F.unix_micros(start).alias("_start"), last.alias("_last")).where("_last >= 0")
    blocks = spans.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / GRID_BLOCK).cast("bigint"))))
    first = F.col("_block") * GRID_BLOCK
    numbers = F.sequence(first, F.least(first + (GRID_BLOCK - 1), F.col("_last")))
    dealt = blocks.repartition(count, "site_id", "_block").withColumn("_number", F.explode(numbers))
    return dealt.select("site_id", F.timestamp_micros(F.col("_start") + F.col("_number") * step).alias("ts"))


def number_events(events: DataFrame, sites_before: Column, per_site: int, index_in_site: Column) -> DataFrame:
    """Add consecutive sequence ids from positions known up front: no global sort and no single task."""
    return events.withColumn("sequenceID", sequence_id(sites_before * F.lit(per_site) + index_in_site))


def spec_from_config(config: Mapping) -> EventSpec:
    """One event type's configuration: ``schema`` with a nested record list, ``ids``, limits and choices."""
    schema = config["schema"]
    nested = [field for value in schema.values() if isinstance(value, list) for field in value]
    value_type = next((kinds["value"] for kinds in nested if "value" in kinds), "float")
    defaults = EventSpec({})

    def limits(kind: str, fallback: tuple) -> tuple:
        low, high = config.get(f"{kind}_min_value"), config.get(f"{kind}_max_value")
        return (fallback[0] if low is None else low, fallback[1] if high is None else high)

    return EventSpec(
        fields={name: kind for name, kind in schema.items() if not isinstance(kind, list)},
        ids=tuple(str(i) for i in config.get("ids") or defaults.ids),
        value_type=value_type,
        allowed={str(k): v for k, v in (config.get("allowed_values") or {}).items()},
        nullable=tuple(config.get("columns_with_none") or ()),
        float_range=limits("f", defaults.float_range),
        int_range=limits("i", defaults.int_range),
        seed=config.get("seed", defaults.seed),
    )


def generate(sites: DataFrame, config: Mapping, path: str) -> None:
    """Write the events of every configured type for every site, one JSON text per line.

    ``config["event_types"]`` maps a type to its configuration with ``start_time``, ``end_time`` (both
    included) and ``interval_seconds``. Each type's sequence ids go on where those of the types before it end.
    """
    sites_numbered = sites.agg(F.max("site_id")).first()[0]
    offset = 0
    for name, one in config["event_types"].items():
        first, last = (datetime.fromisoformat(one[k]) for k in ("start_time", "end_time"))
        start, end = (F.lit(one[k]).cast("timestamp") for k in ("start_time", "end_time"))
        step = int(one["interval_seconds"])
        count = int((last - first).total_seconds()) // step + 1
        grid = time_grid(sites, start, end, step)
        events = synthetic_events(grid, spec_from_config(one))
        index = (F.unix_seconds("ts") - F.unix_seconds(start)) / step + F.lit(offset)
        numbered = number_events(events, F.col("site_id").cast("bigint"), count, index.cast("bigint"))
        offset += (int(sites_numbered or 0) + 1) * count
        write_events(numbered.withColumn("eventtype", F.lit(name)).drop("ts"), path)


def write_events(events: DataFrame, path: str) -> None:
    """Newline-delimited JSON, nulls kept."""
    events.write.mode("append").option("ignoreNullFields", "false").json(path)
