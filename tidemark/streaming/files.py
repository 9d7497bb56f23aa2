"""Stream sources and sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.quality import Rule, keep_valid, quality_report
from tidemark.sources.commits import CommitLog, drop_unnamed, knows, merged, to_merge, with_batch
from tidemark.sources.tables import path_exists

# One micro-batch takes at most so many files, so a first run over a large lake is not one single batch.
MAX_FILES = 1000

SOURCE_FILE = "__source_file"
# So many runs of rule counts are rewritten as one.
COUNT_RUNS = 16


def stream_files(spark: SparkSession, path: str, schema: StructType, max_files: int = MAX_FILES) -> DataFrame:
    """Parquet files as they arrive anywhere below ``path``.

    Columns that a file lacks are NULL, so a wider schema on restart adds columns.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", max_files).parquet(path)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a stream of the rows appended to it."""
    return spark.readStream.table(name)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    table: str | None = None,
    name: str | None = None,
    partition_by: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start appending all available rows to parquet files, then stop; optionally as a catalog table at ``path``.

    Files and checkpoint belong together: the sink remembers the batches of its checkpoint, so a replay under a new
    checkpoint needs a new path. ``conf`` holds for this stream alone, such as ``LARGE_STATE_CONF`` for one that remembers many
    keys; a stream that has run before keeps the state store it began with.
    """
    writer = available_now(df, checkpoint, name).outputMode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is None:
        return _started(df.sparkSession, conf, lambda: writer.start(path))
    add_missing_columns(df.sparkSession, table, df.schema)
    return _started(df.sparkSession, conf, lambda: writer.option("path", path).toTable(table))


def _started(spark: SparkSession, conf: Mapping[str, str] | None, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """A stream takes a copy of the session's settings when it starts."""
    before = {key: spark.conf.get(key, None) for key in conf or {}}
    for key, value in (conf or {}).items():
        spark.conf.set(key, value)
    try:
        return start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def available_now(df: DataFrame, checkpoint: str, name: str | None = None) -> DataStreamWriter:
    writer = df.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    return writer.queryName(name) if name else writer


def add_missing_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Widen an existing catalog table by the columns of a schema that it lacks."""
    if not spark.catalog.tableExists(table):
        return
    known = set(spark.read.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query, then raise the first failure, so that a failed stream fails the job."""
    failure: Exception | None = None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:
            failure = failure or error
    if failure is not None:
        raise failure


def with_source_file(df: DataFrame) -> DataFrame:
    """A file stream with the file of each row, by which :func:`counted_sink` knows what it has counted."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def counted_sink(
    rules: Sequence[Rule], name: str, counts: str, checkpoint: str, land: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """What a stream does with each batch: count the rules over all of it, then land the rows that pass.

    Counts are kept by source file, so whatever comes again, a batch after a crash or all files under a new checkpoint,
    counts once. The batch is read once: it is kept until it is landed and counted. Counting is a grouped aggregate, not an
    observation, because a task that is run again after a lost executor is observed twice. A stream without
    :func:`with_source_file` is counted by batch, so under a new checkpoint it counts again.

    Layout below ``counts``: ``rows/run=<n>/``, one row for each file and rule, and ``commits/<n>.json``, the runs that count.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, log = batch.sparkSession, CommitLog(f"{counts}/commits")
        label = batch_name(spark, checkpoint, number)
        named = SOURCE_FILE in batch.columns
        last, state = log.latest(spark)
        if knows(state.get("streams", {}), label):
            land(keep_valid(batch, rules).drop(SOURCE_FILE), number)
            return
        kept = batch.persist(StorageLevel.DISK_ONLY)
        try:
            whole = kept if named else kept.withColumn(SOURCE_FILE, F.lit(label))
            report = quality_report(whole, rules, name, [SOURCE_FILE])
            known = _counted(spark, counts, state.get("runs", [])).select(SOURCE_FILE).distinct()
            fresh = report.join(known, SOURCE_FILE, "left_anti")
            runs = [*state.get("runs", []), {"folder": f"run={last + 1}", "level": 0}]
            fresh.coalesce(1).write.mode("overwrite").parquet(f"{counts}/rows/run={last + 1}")
            land(keep_valid(kept, rules).drop(SOURCE_FILE), number)
        finally:
            kept.unpersist()
        count = to_merge(runs, COUNT_RUNS)
        if count > 1:
            _counted(spark, counts, runs[-count:]).coalesce(1).write.mode("overwrite").parquet(f"{counts}/rows/run={last + 1}-{count}")
            runs = merged(runs, count, f"run={last + 1}-{count}")
        log.commit(spark, last + 1, {"runs": runs, "streams": with_batch(state.get("streams", {}), label)})
        drop_unnamed(spark, f"{counts}/rows", [r["folder"] for r in (*runs, *state.get("runs", []), {"folder": f"run={last + 1}"})])

    return run


def _counted(spark: SparkSession, counts: str, runs: list[dict]) -> DataFrame:
    shape = f"{SOURCE_FILE} string, table_name string, rule string, action string, passed bigint, failed bigint"
    folders = [f"{counts}/rows/{r['folder']}" for r in runs]
    return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)


def rule_totals(spark: SparkSession, counts: str) -> DataFrame:
    """One row per rule with its counts over all files that a stream has ever landed."""
    found = _counted(spark, counts, CommitLog(f"{counts}/commits").latest(spark)[1].get("runs", []))
    return found.groupBy("table_name", "rule", "action").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )


def batch_name(spark: SparkSession, checkpoint: str, number: int) -> str:
    """A name for a batch that no other stream and no other checkpoint gives."""
    found = f"{checkpoint}/metadata"
    stream = json.loads(spark.read.text(found).first()[0])["id"] if path_exists(spark, found) else checkpoint
    return f"{stream}/{number}"
