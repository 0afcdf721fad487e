"""Date windows, load choice and scope filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days kept by each load method; ``None`` keeps everything.
LOAD_DAYS = {"full": None, "overwrite": 265 * 7, "incremental": 15}


def date_window(df: DataFrame, load_method: str, as_of: Column, date_column: str = "sample_date") -> DataFrame:
    """Rows dated between ``as_of`` less the method's days and ``as_of``, both ends included."""
    if load_method not in LOAD_DAYS:
        raise ValueError(f"Incorrect load-method specified: {load_method}")
    days = LOAD_DAYS[load_method]
    if days is None:
        return df
    end = as_of.cast("date")
    return df.where(F.col(date_column).between(F.date_sub(end, days), end))


def load_selection(df: DataFrame, target_table: str, as_of: Column, date_column: str = "sample_date") -> DataFrame:
    """The recent window when the target table exists already, otherwise everything."""
    method = "incremental" if df.sparkSession.catalog.tableExists(target_table) else "full"
    return date_window(df, method, as_of, date_column)


def in_scope(df: DataFrame, ids: DataFrame, column: str = "tag_id") -> DataFrame:
    return df.join(ids.select(column).distinct(), column, "left_semi")


def out_of_scope(df: DataFrame, ids: DataFrame, column: str = "tag_id") -> DataFrame:
    return df.join(ids.select(column).distinct(), column, "left_anti")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition and rows that do not; rows where it is null are in neither."""
    return df.where(condition), df.where(~condition)
