"""Laboratory tables: conform names, merge live and historical rows, join, attach goals, choose the load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import live_and_historical
from millrace.operators.reshape import prefix_columns, rename, stack_rows


@dataclass(frozen=True)
class TableNames:
    """How one lab table is conformed: a prefix for its fields and new names for its keys."""

    prefix: str
    fields: Sequence[str]
    keys: Mapping[str, str] = field(default_factory=dict)


def conform(df: DataFrame, names: TableNames) -> DataFrame:
    return rename(prefix_columns(df, names.fields, names.prefix), names.keys)


def conform_pair(live: DataFrame, historical: DataFrame, names: TableNames, drop: Sequence[str] = ()) -> DataFrame:
    """Live and historical rows of one table under their conformed names, each distinct row once."""
    return live_and_historical(conform(live, names), conform(historical, names), drop)


def conform_dimension(df: DataFrame, names: TableNames) -> DataFrame:
    return conform(df, names).distinct()


@dataclass(frozen=True)
class LabKeys:
    """Join columns after conforming."""

    sample: str
    test_sample: str
    test: str
    result_test: str
    result_analysis: str
    analysis: str
    goal: Sequence[str]


def join_chain(sample: DataFrame, test: DataFrame, result: DataFrame, analysis: DataFrame, keys: LabKeys, strict_inner: bool = True) -> DataFrame:
    """Samples with their tests, results and analyses.

    The final inner join drops samples without a result anyway, so the joins are written inner; that
    leaves Spark free to reorder them and to prune by any filter. ``strict_inner=False`` keeps them left.
    """
    how = "inner" if strict_inner else "left"
    return (
        sample.join(test, sample[keys.sample] == test[keys.test_sample], how)
        .join(result, test[keys.test] == result[keys.result_test], how)
        .join(analysis, result[keys.result_analysis] == analysis[keys.analysis])
    )


def lab_dataset(sample: DataFrame, test: DataFrame, result: DataFrame, analysis: DataFrame, goal: DataFrame, keys: LabKeys) -> DataFrame:
    """The joined dataset without duplicate rows, outer-joined with the goals on their shared keys.

    Tests, results, analyses are distinct already and all their columns are kept, so making the samples
    distinct makes the joined rows distinct. That replaces a shuffle of the wide joined rows by one of
    the samples.
    """
    joined = join_chain(sample.distinct(), test, result, analysis, keys)
    shared = list(keys.goal)
    # a full outer join can neither split a hot key nor broadcast the goals; a left join and the goals left over can
    # whole rows are asked for and null keys not sorted out before the joins, so both readers of the joined rows have the same plan up
    # to the last shuffle, which then runs once; the hash is never below its smallest value
    rows = F.max(F.xxhash64(*joined.columns)).alias("_rows")
    met = joined.groupBy(*shared).agg(rows).where(F.col("_rows") >= F.lit(-(2**63))).select(*[F.col(k).alias(f"_{k}") for k in shared])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) & F.col(k).isNotNull() for k in shared]
    unmet = goal.join(met, reduce(and_, same), "left_anti")
    return stack_rows(joined.join(goal, shared, "left"), unmet, missing=True)
