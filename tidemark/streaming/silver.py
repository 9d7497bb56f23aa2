"""Bronze to silver: clean and deduplicate each table's stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tidemark.operators.dedupe import dedupe_latest, dedupe_stream, dedupe_version
from tidemark.operators.rows import RESCUED, drop_columns
from tidemark.session import LARGE_STATE_CONF
from tidemark.sources.control import TableSpec
from tidemark.sources.tables import path_exists, read_or_empty, register_folder
from tidemark.streaming.files import append_stream, await_all, stream_files
from tidemark.streaming.keyindex import KeyIndex
from tidemark.streaming.landed import LandedFolders

DAY = "__day"


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The transforms of a table, and no rescue column."""
    for transform in spec.transforms:
        df = df.transform(transform)
    return drop_columns(df, [RESCUED])


def refine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The silver rows of a bronze stream, for tables whose dedupe is part of the stream."""
    df = clean(df, spec)
    return dedupe_stream(df, spec.keys) if spec.dedupe == "key" else df


def append_unseen(
    batch: DataFrame, path: str, keys: Sequence[str], event_time: str, by_key: bool = False
) -> None:
    """Append the rows of a batch that the table does not have yet, in folders by day.

    A row is known by its key and event time, so only the days that occur in the batch need to be looked at, and of those
    only the key columns. With ``by_key`` it is known by its key alone: an id that comes again with another time is the same
    event, and what landed first stays; of several in one batch, the one with the highest time. These are looked up in an index
    of keys beside the table, of which only the batch's buckets are read.
    Repeating a batch appends nothing, also after a crash that left part of it behind.
    """
    if by_key:
        _append_unseen_keys(batch, path, keys, event_time)
        return
    spark = batch.sparkSession
    fresh = dedupe_version(batch, keys, [event_time]).withColumn(DAY, F.to_date(event_time))
    if path_exists(spark, path):
        shape = StructType([batch.schema[c] for c in keys if c != event_time] + [batch.schema[event_time]]).add(DAY, "date")
        seen = spark.read.schema(_nullable(shape)).parquet(path)
        days = batch.select(F.to_date(event_time).alias("__of_batch")).distinct()
        # The days of the batch prune the folders of the table when it is read.
        seen = seen.join(days, seen[DAY].eqNullSafe(days["__of_batch"]), "left_semi")
        same = [fresh[c].eqNullSafe(seen[c]) for c in [*keys, event_time, DAY]]
        fresh = fresh.join(seen, same, "left_anti")
    _append_days(fresh, path, keys)


def _append_unseen_keys(batch: DataFrame, path: str, keys: Sequence[str], event_time: str) -> None:
    spark = batch.sparkSession
    index = KeyIndex(f"{path.rstrip('/')}_keys", tuple(keys), batch.schema)
    shape = _nullable(StructType([batch.schema[k] for k in keys]).add(DAY, "date"))
    index.settle(read_or_empty(spark, path, shape), DAY)
    fresh = dedupe_latest(batch, keys, [event_time]).withColumn(DAY, F.to_date(event_time))
    fresh = index.unseen(fresh).persist(StorageLevel.DISK_ONLY)
    try:
        if not fresh.isEmpty():
            index.begin(fresh, DAY)
            _append_days(fresh, path, keys)
            index.done(spark)
    finally:
        fresh.unpersist()


def _append_days(fresh: DataFrame, path: str, keys: Sequence[str]) -> None:
    fresh.hint("rebalance", DAY).sortWithinPartitions(DAY, *keys).write.mode("append").partitionBy(DAY).parquet(path)


def start_silver(
    spark: SparkSession, spec: TableSpec, schema: StructType, bronze: str, silver: str, table: str | None = None
) -> StreamingQuery:
    """Start the stream of a table whose dedupe is part of the stream; ``table`` also registers it in the catalog."""
    arriving = stream_files(spark, f"{bronze}/{spec.table}", _with_rescue(schema))
    # The state has a row for every key ever seen, so it is kept on disk.
    conf = LARGE_STATE_CONF if spec.dedupe == "key" else None
    data, checkpoint = f"{silver}/{spec.table}/data", f"{silver}/{spec.table}/checkpoint"
    return append_stream(refine(arriving, spec), data, checkpoint, table, f"silver-{spec.table}", conf=conf)


def land_silver(
    spark: SparkSession, spec: TableSpec, schema: StructType, bronze: str, silver: str, table: str | None = None
) -> None:
    """Land the new batches of a table whose rows are looked up in the table itself."""
    data = f"{silver}/{spec.table}/data"

    def land(batch: DataFrame, _: int) -> None:
        append_unseen(clean(batch, spec), data, spec.keys, spec.sequence[0], by_key=spec.dedupe == "unseen_key")
        if table is not None:
            register_folder(spark, table, data)

    LandedFolders(f"{bronze}/{spec.table}", f"{silver}/{spec.table}/cursor").run(spark, _with_rescue(schema), land)


def run_silver(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    schemas: Mapping[str, StructType],
    bronze: str,
    silver: str,
    database: str | None = None,
) -> None:
    """Bring every table that has landed up to date, side by side; fails if any of them fails.

    With ``database`` the tables are also in the catalog, as ``silver_`` and the table's name.
    """
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    landed = [(s, database and f"{database}.silver_{s.table.lower()}") for s in specs if s.table in schemas]
    streams = [
        start_silver(spark, s, schemas[s.table], bronze, silver, name) for s, name in landed if s.dedupe in ("none", "key")
    ]
    looked_up = [(s, name) for s, name in landed if s.dedupe not in ("none", "key")]
    with ThreadPoolExecutor(max(1, len(looked_up))) as pool:
        jobs = [pool.submit(land_silver, spark, s, schemas[s.table], bronze, silver, name) for s, name in looked_up]
    await_all(streams)
    for job in jobs:
        job.result()


def silver_schema(spark: SparkSession, spec: TableSpec, schema: StructType) -> StructType:
    """The columns of a silver table, given those of its bronze files."""
    return clean(spark.createDataFrame([], _with_rescue(schema)), spec).schema


def read_silver(spark: SparkSession, spec: TableSpec, schema: StructType, silver: str) -> DataFrame:
    """A silver table as it is now; empty before its first row."""
    shape = silver_schema(spark, spec, schema)
    path = f"{silver}/{spec.table}/data"
    if not path_exists(spark, path):
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(path).select(*shape.names)


def _with_rescue(schema: StructType) -> StructType:
    fields = [f for f in schema.fields if f.name != RESCUED]
    return StructType(fields).add(RESCUED, "string")


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
