"""Slowly changing dimensions that are kept up to date from a stream of changes.

Window functions cannot run on a stream, so each micro-batch is worked into the dimension as a batch job. Layout below
``path``::

    log/of_run=<n>/bucket=<b>/      the changes of a run (type 2 only)
    rows/of_run=<n>/bucket=<b>/     what the run adds to the dimension
    commits/<n>.json             the runs that count, from the oldest to the newest, and the batches that they stand for

A run adds and never rewrites, so a batch writes about its own size, also if it touches all buckets. Of type 1 it adds its
newest row of each key, and a reader takes the newest of all runs. Of type 2 it adds, for each key that it touches, the versions
of one stretch of the key's history: from the version that holds when its first change comes to the one that follows its last
change. A row without a version says which stretch that is, and a reader leaves out what older runs have there. The rest of a
history is neither read nor written. The log is only read for keys with a change inside a version, that is, before the
last change that a version has seen, as the changes behind it are not in the rows; and of those keys only the stretch.

Runs are rewritten as one when there are ``LOG_RUNS`` of them, and these again with such as are no larger, so a row is rewritten as
often as the logarithm of their number. When the oldest run is rewritten too, nothing older is left to be left out.

A key always falls into the same bucket. A run writes only its own folders and its commit last, so a run that died is
repeated without trace, readers never see half of one, and of two writers one is refused. The store numbers its runs itself and
knows a batch by its name, the stream's id and the batch's number: a batch that comes again changes nothing, and a stream that
starts anew under a new checkpoint goes on behind the last run. Folders stay for one run after they have been rewritten, so
that readers can finish.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidemark.operators.scd import END, START, scd1, scd2
from tidemark.sources.commits import CommitLog, drop_unnamed, knows, merged, to_merge, with_batch
from tidemark.sources.tables import delete_path
from tidemark.streaming.files import batch_name

BUCKETS = 64
LOG_RUNS = 16

# The whole sequence of a change; of a version's first and last change; the ends of a stretch; the run that a row is of.
_SEQ, _FIRST, _LAST, _CUT, _STOP, _RUN = "__seq", "__first", "__last", "__cut", "__stop", "__run"
_INSIDE = "__inside"


@dataclass(frozen=True)
class DimensionStore:
    """A dimension of type 2 if any column is tracked, else of type 1."""

    path: str
    keys: tuple[str, ...]
    sequence_by: tuple[str, ...]
    track: tuple[str, ...] = ()
    buckets: int = BUCKETS

    def sink(self, checkpoint: str) -> Callable[[DataFrame, int], None]:
        """What a stream with this checkpoint does with each of its batches."""
        return lambda batch, number: self.apply(batch, batch_name(batch.sparkSession, checkpoint, number))

    def apply(self, changes: DataFrame, batch: str) -> None:
        """Add the changes of one batch; a batch that has been added before changes nothing."""
        spark, log = changes.sparkSession, CommitLog(f"{self.path}/commits")
        last, state = log.latest(spark)
        self._check_layout(state)
        streams = state.get("streams", {})
        if knows(streams, batch):
            return
        run, schema, name = last + 1, _nullable(changes.schema), f"of_run={last + 1}"
        lists = {part: [*state.get(part, []), {"folder": name, "level": 0}] for part in (("log", "rows") if self.track else ("rows",))}
        if self.track:
            # The batch is read once, also when it comes from a long computation.
            self._write(changes, f"{self.path}/log/{name}")
            self._splice(spark, schema, run, state.get("rows", []), lists["log"])
        else:
            self._write(scd1(changes, self.keys, self.sequence_by), f"{self.path}/rows/{name}")
        lists = {part: self._merge(spark, schema, part, runs, run) for part, runs in lists.items()}
        log.commit(spark, run, {"layout": self._layout(), "streams": with_batch(streams, batch), **lists})
        for part, runs in lists.items():
            drop_unnamed(spark, f"{self.path}/{part}", [name, *(r["folder"] for r in (*runs, *state.get(part, [])))])

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The dimension as of the last complete run; ``schema`` is that of the changes."""
        schema, runs = _nullable(schema), CommitLog(f"{self.path}/commits").latest(spark)[1].get("rows", [])
        if not self.track:
            return scd1(self._read(spark, schema, "rows", runs), self.keys, self.sequence_by).select(*schema.names)
        found = self._versions(self._read(spark, schema, "rows", runs), len(runs) > 1)
        return found.select(*schema.names, START, END)

    def _layout(self) -> str:
        return json.dumps({"keys": self.keys, "sequence": self.sequence_by, "track": self.track, "buckets": self.buckets})

    def _check_layout(self, state: dict) -> None:
        if state and state["layout"] != self._layout():
            raise ValueError(f"the store at {self.path} was made as {state['layout']} and is opened as {self._layout()}")

    def _splice(self, spark: SparkSession, schema: StructType, run: int, runs: list[dict], logs: list[dict]) -> None:
        """Write what the changes of a run make of the versions next to them."""
        scratch, sequence = f"{self.path}/scratch/run={run}", F.struct(*self.sequence_by)
        changes = self._read(spark, schema, "log", logs[-1:])
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]
        if not touched:
            self._write(spark.createDataFrame([], self._shape(schema, "rows")).drop("bucket"), f"{self.path}/rows/of_run={run}")
            return
        here = F.col("bucket").isin(touched)
        known = self._versions(self._read(spark, schema, "rows", runs).filter(here), len(runs) > 1)
        known = self._matching(known, changes.select(*self.keys).distinct())
        both = known.select(*schema.names, F.col(_FIRST).alias(_SEQ), _LAST, END, F.lit(True).alias("__known"))
        new = changes.select(*schema.names, sequence.alias(_SEQ), sequence.alias(_LAST), self._moment(schema).alias(END), F.lit(False).alias("__known"))
        self._stretches(both.unionByName(new)).write.mode("overwrite").parquet(f"{scratch}/near")
        near = spark.read.parquet(f"{scratch}/near")

        # Of an untouched version its row stands for all changes that it has seen.
        events = near.filter(~F.col(_INSIDE)).select(*schema.names, _SEQ, _LAST, _CUT, _STOP, END)
        inside = near.filter(F.col(_INSIDE))
        if not inside.isEmpty():
            stretches = inside.select(*self.keys, _CUT, _STOP).distinct()
            earliest = stretches.agg(F.min(f"{_CUT}.{self.sequence_by[0]}").alias("low"), F.count_if(F.col(_CUT).isNull()).alias("all")).first()
            log = self._read(spark, schema, "log", logs).filter(here)
            if not earliest["all"]:
                log = log.filter(F.col(self.sequence_by[0]) >= F.lit(earliest["low"]))
            log = self._joined(log.withColumn(_SEQ, sequence), stretches)
            log = log.filter((F.col(_CUT).isNull() | (F.col(_SEQ) >= F.col(_CUT))) & (F.col(_STOP).isNull() | (F.col(_SEQ) < F.col(_STOP))))
            seen = log.select(*schema.names, _SEQ, F.col(_SEQ).alias(_LAST), _CUT, _STOP, self._moment(schema).alias(END))
            behind = inside.filter(F.col("__known") & (F.col(_SEQ) == F.col(_STOP))).select(*events.columns)
            events = events.unionByName(seen).unionByName(behind)
        # The version behind the stretch ends as it did; all others end where the next one begins.
        ends = F.when(F.col(_SEQ) == F.col(_STOP), F.col(END))
        events = events.withColumn("__ends", ends).drop(END)
        fresh = scd2(events, self.keys, [_SEQ], self.track, scratch=f"{scratch}/hot")
        moment = self.sequence_by[0]
        versions = fresh.select(
            *schema.names,
            F.col(f"{START}.{moment}").alias(START),
            F.coalesce(F.col(f"{END}.{moment}"), F.col("__ends")).alias(END),
            F.col(START).alias(_FIRST),
            _LAST,
            F.lit(run).cast("long").alias(_RUN),
        )
        marks = near.filter(~F.col("__known")).select(*self.keys, _CUT, _STOP).distinct().withColumn(_RUN, F.lit(run).cast("long"))
        self._write(versions.unionByName(marks, allowMissingColumns=True), f"{self.path}/rows/of_run={run}")
        delete_path(spark, scratch)

    def _stretches(self, rows: DataFrame) -> DataFrame:
        """Changes, and of the known versions those of the stretch that they touch, with its ends; no end where it is open.

        ``__inside`` says whether one of the key's changes comes no later than the last change that its version has seen.
        """
        w = Window.partitionBy(*self.keys).orderBy(_SEQ, F.desc("__known"))
        before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
        version = lambda c: F.when(F.col("__known"), F.col(c))
        placed = rows.withColumns(
            {
                "__held": F.last(version(_SEQ), ignorenulls=True).over(before),
                "__seen": F.last(version(_LAST), ignorenulls=True).over(before),
                "__next": F.first(version(_SEQ), ignorenulls=True).over(after),
            }
        )
        key, change = Window.partitionBy(*self.keys), ~F.col("__known")
        placed = placed.withColumns(
            {
                "__open": F.max(change & F.col("__held").isNull()).over(key),
                "__low": F.min(F.when(change, F.col("__held"))).over(key),
                _STOP: F.max_by(F.when(change, F.col("__next")), F.when(change, F.col(_SEQ))).over(key),
                _INSIDE: F.coalesce(F.max(change & (F.col(_SEQ) <= F.col("__seen"))).over(key), F.lit(False)),
            }
        ).withColumn(_CUT, F.when(~F.col("__open"), F.col("__low")))
        within = (F.col(_CUT).isNull() | (F.col(_SEQ) >= F.col(_CUT))) & (F.col(_STOP).isNull() | (F.col(_SEQ) <= F.col(_STOP)))
        return placed.filter(change | within).drop("__held", "__seen", "__next", "__open", "__low")

    def _versions(self, rows: DataFrame, several: bool) -> DataFrame:
        """The versions that no newer run has replaced."""
        versions = rows.filter(F.col(_FIRST).isNotNull())
        if not several:
            return versions.drop(_CUT, _STOP)
        marks = rows.filter(F.col(_FIRST).isNull()).groupBy(*self.keys)
        marks = marks.agg(F.collect_list(F.struct(F.col(_RUN).alias("run"), F.col(_CUT).alias("cut"), F.col(_STOP).alias("stop"))).alias("__marks"))

        def replaced(mark: Column) -> Column:
            begun = mark["cut"].isNull() | (mark["cut"] <= F.col(_FIRST))
            return (mark["run"] > F.col(_RUN)) & begun & (mark["stop"].isNull() | (F.col(_FIRST) <= mark["stop"]))

        found = self._joined(versions.drop(_CUT, _STOP), marks, "left")
        return found.filter(F.col("__marks").isNull() | ~F.exists("__marks", replaced)).drop("__marks")

    def _merge(self, spark: SparkSession, schema: StructType, part: str, runs: list[dict], run: int) -> list[dict]:
        """Rewrite the newest runs as one if there are enough of them."""
        count = to_merge(runs, LOG_RUNS)
        if count < 2:
            return runs
        folder, found = f"of_run={run}-{count}", self._read(spark, schema, part, runs[-count:]).drop("bucket")
        if part == "rows" and not self.track:
            found = scd1(found, self.keys, self.sequence_by)
        elif part == "rows":
            # What is left is of one run: nothing in it replaces anything else in it.
            marks = found.filter(F.col(_FIRST).isNull()) if count < len(runs) else found.limit(0)
            found = self._versions(found, True).unionByName(self._widest(marks), allowMissingColumns=True)
            found = found.withColumn(_RUN, F.lit(run).cast("long"))
        self._write(found, f"{self.path}/{part}/{folder}")
        return merged(runs, count, folder)

    def _widest(self, marks: DataFrame) -> DataFrame:
        """The stretches that lie in no other stretch of their key."""
        each = marks.groupBy(*self.keys).agg(F.collect_set(F.struct(F.col(_CUT).alias("cut"), F.col(_STOP).alias("stop"))).alias("__all"))

        def holds(outer: Column, inner: Column) -> Column:
            low = outer["cut"].isNull() | (inner["cut"].isNotNull() & (outer["cut"] <= inner["cut"]))
            high = outer["stop"].isNull() | (inner["stop"].isNotNull() & (inner["stop"] <= outer["stop"]))
            return F.coalesce(low & high, F.lit(False))

        alone = F.filter("__all", lambda m: ~F.exists("__all", lambda o: ~o.eqNullSafe(m) & holds(o, m)))
        return each.select(*self.keys, F.explode(alone).alias("m")).select(*self.keys, F.col("m.cut").alias(_CUT), F.col("m.stop").alias(_STOP))

    def _shape(self, schema: StructType, part: str) -> StructType:
        shape = StructType([*schema.fields])
        if part == "rows" and self.track:
            moment = schema[self.sequence_by[0]].dataType
            sequence = StructType([schema[c] for c in self.sequence_by])
            shape = shape.add(START, moment).add(END, moment)
            for name, kind in ((_FIRST, sequence), (_LAST, sequence), (_RUN, "long"), (_CUT, sequence), (_STOP, sequence)):
                shape = shape.add(name, kind)
        return shape.add("bucket", "integer")

    def _read(self, spark: SparkSession, schema: StructType, part: str, runs: list[dict]) -> DataFrame:
        shape = self._shape(schema, part)
        base = f"{self.path}/{part}"
        if not runs:
            return spark.createDataFrame([], shape)
        found = spark.read.schema(shape).option("basePath", base).parquet(*(f"{base}/{r['folder']}" for r in runs))
        return found.select(*shape.names)

    def _moment(self, schema: StructType) -> Column:
        kind: DataType = schema[self.sequence_by[0]].dataType
        return F.lit(None).cast(kind)

    def _matching(self, df: DataFrame, keys: DataFrame) -> DataFrame:
        return df.join(keys, [df[k].eqNullSafe(keys[k]) for k in self.keys], "left_semi")

    def _joined(self, df: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
        """Rows with the further columns that another table has for their keys; NULL equals NULL."""
        named = other.withColumnsRenamed({k: f"__of_{k}" for k in self.keys})
        same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in self.keys]
        return df.join(named, same, how).drop(*(f"__of_{k}" for k in self.keys))

    def _write(self, df: DataFrame, folder: str) -> None:
        # Rebalancing gathers a bucket into few files and, unlike a plain repartition, splits an oversized one.
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        bucketed = df.withColumn("bucket", bucket).hint("rebalance", "bucket").sortWithinPartitions("bucket", self.sequence_by[0])
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(folder)


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
