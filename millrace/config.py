"""Resolved configuration: a plain, bounded description the plans are built from."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Feature:
    """One configured feature; durations and lags count grid steps."""

    id: int
    tags: tuple[str, ...] = ()
    function: str | None = None
    lag: int | None = None
    null_impute: float | None = None
    null_threshold: float | None = None
    current: str | None = None
    anticipated: str | None = None
    steps: int = 60
    custom: tuple[str, ...] = ()
    condition: bool = False

    @property
    def threshold(self) -> int | None:
        return int(float(self.custom[0])) if self.custom else None


@dataclass(frozen=True)
class StoreConfig:
    """Everything a feature run needs besides data. Defaults are those of a one-minute grid."""

    features: tuple[Feature, ...]
    smoothed_tags: tuple[str, ...] = ()
    #: run tags by dependent tag
    run_tags_of: dict = field(default_factory=dict)
    critical_tags: tuple[str, ...] = ()
    optimal_tag: str | None = None
    optimal_threshold: float = 600.0
    moisture_target: float | None = None
    trigger_features: tuple[int, ...] = ()
    step_seconds: int = 60
    slice_steps: int = 120
    switch_steps: int = 150
    hour_steps: int = 60
    long_slice_steps: int = 3300
    long_steps: int = 2880
    smooth_steps: int = 15
    smooth_min: int = 7
    up_share: float = 0.8
    switch_share: float = 0.2
    trend_high: float = 15.0
    trend_high_high: float = 20.0

    def subset(self, features: tuple[Feature, ...]) -> "StoreConfig":
        return replace(self, features=features)

    @property
    def short_features(self) -> tuple[Feature, ...]:
        return tuple(f for f in self.features if f.steps != self.long_steps)

    @property
    def long_features(self) -> tuple[Feature, ...]:
        return tuple(f for f in self.features if f.steps == self.long_steps)

    @property
    def gate_features(self) -> tuple[Feature, ...]:
        return tuple(f for f in self.features if f.id in set(self.trigger_features))


#: A configuration beyond this many rows is not a configuration; it is rejected, never cut.
MAX_CONFIG_ROWS = 100_000


def bounded_rows(df: DataFrame, limit: int = MAX_CONFIG_ROWS) -> list:
    """All rows of a configuration table; raises when it is larger than the limit."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"configuration has more than {limit} rows")
    return rows


def local_table(spark: SparkSession, columns: dict[str, tuple[pa.DataType, list]]) -> DataFrame:
    """A small table whose exact size the optimizer knows, so it decides by size whether to broadcast it."""
    table = pa.table({name: pa.array(values, type=kind) for name, (kind, values) in columns.items()})
    return spark.createDataFrame(table)
