"""Aggregates of a table's partitions, each partition's replaced whole when rows have come to it.

What is stored of a partition depends on the rows of that partition alone, not on the batches that told of them. So a batch
that comes again, a stream that starts anew under another checkpoint, and a table that was written anew all lead to the same
aggregates, and no clock is read. Layout below ``path``::

    rows/run=<n>/partial_of=<hash>/   the aggregates of the partitions that run n replaced
    commits/<n>.json             which run each partition's aggregates are in; one entry for each partition

A run writes its own folder and its commit last, so a run that died leaves no trace. Of two runs at one time one is refused.
Runs that the last commits don't name are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.commits import CommitLog, drop_unnamed
from tidemark.sources.tables import children

# The hash of a partition whose value is NULL.
_NULL = "none"


@dataclass(frozen=True)
class PartialStore:
    """``partition`` is the column whose values are the partitions; their number must suit the driver, as that of days does."""

    path: str
    partition: str

    def touched(self, batch: DataFrame) -> list:
        """The partitions that a batch has rows of."""
        return [r[0] for r in batch.select(self.partition).distinct().collect()]

    def only(self, table: DataFrame, values: list) -> DataFrame:
        """The rows of some partitions of the table; the others are not read."""
        known = [v for v in values if v is not None]
        found = F.col(self.partition).isin(known)
        return table.filter(found | F.col(self.partition).isNull() if len(known) < len(values) else found)

    def replace(self, spark: SparkSession, values: list, partials: DataFrame) -> None:
        """Store the aggregates of whole partitions instead of what was known of them; a partition without rows is forgotten."""
        if not values:
            return
        log = CommitLog(f"{self.path}/commits")
        number, state = log.latest(spark)
        run, parts = number + 1, dict(state.get("parts", {}))
        folder = f"{self.path}/rows/run={run}"
        dealt = self.only(partials, values).withColumn("partial_of", _name(F.col(self.partition))).hint("rebalance", "partial_of")
        dealt.write.mode("overwrite").partitionBy("partial_of").parquet(folder)
        written = {n.removeprefix("partial_of=") for n in children(spark, folder)}
        asked = spark.createDataFrame([(v,) for v in values], StructType().add("v", partials.schema[self.partition].dataType))
        for r in asked.select(_name(F.col("v")).alias("name")).collect():
            if r["name"] in written:
                parts[r["name"]] = run
            else:
                parts.pop(r["name"], None)
        log.commit(spark, run, {"parts": parts})
        drop_unnamed(spark, f"{self.path}/rows", [f"run={r}" for r in (*parts.values(), *state.get("parts", {}).values(), run)])

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The aggregates of all partitions as of the last commit."""
        _, state = CommitLog(f"{self.path}/commits").latest(spark)
        folders = [f"{self.path}/rows/run={run}/partial_of={name}" for name, run in sorted(state.get("parts", {}).items())]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _name(value: Column) -> Column:
    return F.coalesce(F.md5(value.cast("string")), F.lit(_NULL))
