"""The recent events of every site as a table, of which a micro-batch replaces the parts it touches.

Sites are dealt into buckets. A batch reads the newest version of the buckets its events fall in, adds them, lets go what no slice can
reach any more and writes these buckets as a generation of its own, numbered by the batch. So a batch reads and writes what its
sites hold, never the log; a replayed batch reads the same older versions and overwrites only its own, and a batch that broke off has
left nothing that counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import survivor_per_key
from millrace.operators.reshape import stack_rows
from millrace.sources import folders

#: Columns of an event that the state keeps.
KEPT = T.StructType(
    [
        T.StructField("site_id", T.IntegerType()),
        T.StructField("eventtype", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("plant_up", T.IntegerType()),
        T.StructField("sequenceID", T.StringType()),
        T.StructField("records", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.DoubleType())]))),
    ]
)


@dataclass(frozen=True)
class SiteState:
    """``reach_seconds``: how far before a site's newest event anything is still read. ``buckets`` must not change once data is there."""

    path: str
    reach_seconds: int
    telemetry: str
    buckets: int = 64

    def _bucket(self):
        return F.pmod(F.xxhash64("site_id"), F.lit(self.buckets)).cast("int")

    def _versions(self, spark: SparkSession, below: int) -> dict[int, list[int]]:
        """Generations under ``below`` that hold each bucket, ascending."""
        found: dict[int, list[int]] = {}
        for g in folders.generations(spark, self.path):
            if g < below:
                for name in folders.names(spark, f"{self.path}/generation={g}"):
                    if name.startswith("bucket="):
                        found.setdefault(int(name.removeprefix("bucket=")), []).append(g)
        return found

    def _read(self, spark: SparkSession, parts: list[tuple[int, int]]) -> DataFrame:
        paths = [f"{self.path}/generation={g}/bucket={b}" for b, g in parts]
        return spark.read.schema(KEPT).parquet(*paths) if paths else spark.createDataFrame([], KEPT)

    def newest(self, spark: SparkSession) -> DataFrame:
        """All sites as the last complete batches left them."""
        return self._read(spark, [(b, gs[-1]) for b, gs in self._versions(spark, 2**62).items()])

    def merge(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The recent events of all sites in the buckets that ``batch`` touches, the batch included, as written.

        Of several events of a site, type and instant the one with the greatest sequence stays. A late event is kept while it is
        within reach of its site's newest.
        """
        spark = batch.sparkSession
        incoming = batch.select(*[F.col(f.name).cast(f.dataType) for f in KEPT.fields])
        # at most as many rows as there are buckets
        touched = {r[0] for r in incoming.select(self._bucket()).distinct().collect()}
        versions = self._versions(spark, batch_id)
        before = self._read(spark, [(b, versions[b][-1]) for b in sorted(touched) if b in versions])
        known = survivor_per_key(stack_rows(before, incoming), ["site_id", "eventtype", "ts"], F.col("sequenceID"))
        newest = known.where(F.col("eventtype") == self.telemetry).groupBy("site_id").agg(F.max("ts").alias("_newest"))
        oldest = F.unix_micros("_newest") - F.lit(self.reach_seconds * 1_000_000)
        within = F.col("_newest").isNull() | (F.unix_micros("ts") >= oldest)
        kept = known.join(newest, "site_id", "left").where(within).select(*KEPT.fieldNames(), self._bucket().alias("bucket"))
        out = f"{self.path}/generation={batch_id}"
        kept.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(out)
        self._forget(spark, batch_id, versions, touched)
        return self._read(spark, [(b, batch_id) for b in sorted(touched)])

    def _forget(self, spark: SparkSession, batch_id: int, versions: dict[int, list[int]], touched: set[int]) -> None:
        """Delete versions that neither this batch's replay nor any later batch can read."""
        for b in touched:
            for g in versions.get(b, [])[:-1]:
                folders.delete(spark, f"{self.path}/generation={g}/bucket={b}")


__all__ = ["KEPT", "SiteState"]
