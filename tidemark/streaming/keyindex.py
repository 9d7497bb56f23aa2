"""An index of the keys that a table has, so that a batch finds out which of its keys are new without reading the table.

The table's own files are by day, and keys may be random, so looking for them there would read the key column of the whole table.
The index holds the keys alone, in buckets of their hash, and a batch reads the buckets that its keys fall into. Runs of keys are
rewritten as one when there are many of them, so a key is rewritten as often as the logarithm of their number. Files are sorted
by key and have Parquet's Bloom filters. Layout below ``path``::

    keys/of_run=<n>/bucket=<b>/  keys, and the day whose folder of the table has them
    commits/<n>.json             the runs that count, and the run whose rows may not have reached the table

A run of keys is committed before its rows are appended, and marked as done afterwards. If a job dies in between, the next
one looks into the table, in the days of that run only, keeps the keys that it finds there and takes the others for new.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.sources.commits import CommitLog, drop_unnamed, merged, to_merge

BUCKETS = 256
INDEX_RUNS = 16
_DAY = "__key_day"


@dataclass(frozen=True)
class KeyIndex:
    path: str
    keys: tuple[str, ...]
    schema: StructType
    buckets: int = BUCKETS

    def unseen(self, fresh: DataFrame) -> DataFrame:
        """The rows whose keys the table doesn't have. Reads the buckets of the rows, and of these the keys."""
        state = CommitLog(f"{self.path}/commits").latest(fresh.sparkSession)[1]
        placed = fresh.withColumn("__bucket", self._bucket())
        touched = [r[0] for r in placed.select("__bucket").distinct().collect()]
        known = self._read(fresh.sparkSession, state.get("runs", [])).filter(F.col("bucket").isin(touched))
        same = [placed[k].eqNullSafe(known[k]) for k in self.keys]
        return placed.join(known, [placed["__bucket"] == known["bucket"], *same], "left_anti").drop("__bucket")

    def begin(self, fresh: DataFrame, day: str) -> None:
        """Commit the keys of rows that are about to be appended."""
        self._add(fresh.select(*self.keys, F.col(day).alias(_DAY)), True)

    def done(self, spark: SparkSession) -> None:
        """The rows have been appended."""
        log = CommitLog(f"{self.path}/commits")
        last, state = log.latest(spark)
        log.commit(spark, last + 1, {**state, "doubt": None})

    def settle(self, table: DataFrame, day: str) -> None:
        """Make the index that of the table: built if there is none, and mended if the last append may have failed."""
        spark, log = table.sparkSession, CommitLog(f"{self.path}/commits")
        last, state = log.latest(spark)
        shown = table.select(*self.keys, F.col(day).alias(_DAY))
        if last < 0:
            self._add(shown.distinct(), False)
        elif state["doubt"] is not None:
            runs = [r for r in state["runs"] if r["folder"] != state["doubt"]]
            doubted = self._read(spark, [{"folder": state["doubt"]}])
            days = [r[0] for r in doubted.select(_DAY).distinct().collect()]
            there = shown.filter(F.col(_DAY).isin([d for d in days if d is not None]) | F.col(_DAY).isNull())
            same = [doubted[c].eqNullSafe(there[c]) for c in (*self.keys, _DAY)]
            name = f"of_run={last + 1}"
            self._write(doubted.drop("bucket").join(there, same, "left_semi"), name)
            log.commit(spark, last + 1, {"runs": [*runs, {"folder": name, "level": 0}], "doubt": None})

    def _add(self, keys: DataFrame, doubt: bool) -> None:
        spark, log = keys.sparkSession, CommitLog(f"{self.path}/commits")
        last, state = log.latest(spark)
        name, before = f"of_run={last + 1}", state.get("runs", [])
        # The new run is in doubt until it is done, so it stays a run of its own until then.
        runs, count = list(before), to_merge(before, INDEX_RUNS)
        if count > 1:
            self._write(self._read(spark, before[-count:]).drop("bucket"), f"{name}-{count}")
            runs = merged(before, count, f"{name}-{count}")
        self._write(keys, name)
        log.commit(spark, last + 1, {"runs": [*runs, {"folder": name, "level": 0}], "doubt": name if doubt else None})
        drop_unnamed(spark, f"{self.path}/keys", [name, *(r["folder"] for r in (*runs, *before))])

    def _read(self, spark: SparkSession, runs: Sequence[dict]) -> DataFrame:
        fields = [StructField(k, self.schema[k].dataType, True) for k in self.keys]
        shape, base = StructType(fields).add(_DAY, "date").add("bucket", "integer"), f"{self.path}/keys"
        if not runs:
            return spark.createDataFrame([], shape)
        found = spark.read.schema(shape).option("basePath", base).parquet(*(f"{base}/{r['folder']}" for r in runs))
        return found.select(*shape.names)

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets))

    def _write(self, keys: DataFrame, folder: str) -> None:
        dealt = keys.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys)
        writer = dealt.write.mode("overwrite").partitionBy("bucket")
        writer.option(f"parquet.bloom.filter.enabled#{self.keys[0]}", "true").parquet(f"{self.path}/keys/{folder}")
