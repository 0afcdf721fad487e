"""Quality reports: null shares, schema quarantine, feature parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.history import ANCHOR

BROKEN = "_corrupt_record"


class FeatureMismatch(Exception):
    """Current and anticipated feature sets differ."""


def null_share_report(series: DataFrame, keys: Sequence[str], limit: Column, gate_run: bool = False) -> DataFrame:
    """Series whose share of null values exceeds their limit, with the severity of the finding."""
    share = F.avg(F.col("value").isNull().cast("int"))
    report = series.groupBy(*keys).agg(share.alias("null_share"), F.max(limit).alias("null_limit"))
    severity = F.lit("info" if gate_run else "error")
    return report.where(F.col("null_share") > F.col("null_limit")).withColumn("severity", severity)


def null_violations(features: DataFrame, gate_run: bool = False) -> DataFrame:
    """The same report from finished feature rows."""
    return features.where("too_many_nulls").select(
        *ANCHOR, "feature_id", "null_share", F.lit("info" if gate_run else "error").alias("severity")
    )


def parse_with_reason(raw: DataFrame, column: str, schema: T.StructType, required: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """Add ``parsed`` and ``reason`` (null when valid) to rows of JSON text.

    ``checks`` maps a reason to a condition on the parsed fields that must hold. Unreadable text, absent
    required fields and failed checks are told apart in that order.
    """
    with_broken = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = raw.withColumn("_p", F.from_json(F.col(column), with_broken, options))
    reason = F.when(F.col("_p").isNull() | F.col(f"_p.{BROKEN}").isNotNull(), F.lit("unreadable"))
    for name in required:
        reason = reason.when(F.col(f"_p.{name}").isNull(), F.lit(f"missing {name}"))
    fields = F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])
    staged = parsed.withColumn("parsed", fields)
    for label, holds in checks.items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), F.lit(label))
    return staged.withColumn("reason", reason).drop("_p")


def quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reason."""
    return checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL")


def feature_mismatch(current: DataFrame, anticipated: DataFrame, key: str = "feature_id") -> DataFrame:
    """Features found on one side only, and on which."""
    left = current.select(key).distinct().withColumn("_c", F.lit(True))
    right = anticipated.select(key).distinct().withColumn("_a", F.lit(True))
    side = F.when(F.col("_a").isNull(), "current").when(F.col("_c").isNull(), "anticipated")
    return left.join(right, key, "full_outer").withColumn("only_in", side).where("only_in IS NOT NULL").select(key, "only_in")


def require_parity(current: DataFrame, anticipated: DataFrame, key: str = "feature_id") -> None:
    """Raise when the feature sets differ; names at most ten of the features concerned."""
    sample = feature_mismatch(current, anticipated, key).orderBy(key).limit(10).collect()
    if sample:
        names = ", ".join(f"{r[key]} only in {r['only_in']}" for r in sample)
        raise FeatureMismatch(
            f"Features mismatch between currentFeatureRecords and anticipatedFeatureRecords: {names}"
        )
