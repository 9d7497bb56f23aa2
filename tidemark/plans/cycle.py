"""The full cycle: sources to bronze, bronze to silver, silver to gold. Every step can be repeated.

Each step reads what is new since the last cycle: streams read new files only, dimensions refresh the keys of a batch, the
daily mart and the sums of the ranking the days of a batch. All of it depends on the rows, not on how they came, so a stream
that starts anew under another checkpoint changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.joins import count_per_key
from tidemark.operators.rows import event_date
from tidemark.plans.ingest import LakePaths, Source, ingest_all
from tidemark.plans.marts import creators_by_totals, daily_metrics
from tidemark.plans.model import COMMENTS, DIMENSIONS, PROPERTIES, fact_stream
from tidemark.sources.commits import CommitLog
from tidemark.sources.control import EPOCH_DATE, TableSpec
from tidemark.sources.schemas import registered_schema
from tidemark.sources.tables import describe_table, path_exists, publish_run, publish_table, read_or_empty, read_run
from tidemark.streaming.dimensions import DimensionStore
from tidemark.streaming.files import (
    append_stream,
    available_now,
    await_all,
    counted_sink,
    rule_totals,
    stream_files,
    with_source_file,
)
from tidemark.streaming.partials import PartialStore
from tidemark.streaming.silver import run_silver, silver_schema

FACT = "FactStream"
FACT_TABLE = "gold_fact_stream"
DAILY_TABLE = "gold_daily_streaming_metrics"
TOP_TABLE = "gold_top_artists_by_streams"
FILES_A_DAY = 8


@dataclass(frozen=True)
class CycleReport:
    """What a cycle did: one audit row per source table, one quality row per rule, the gold tables as written."""

    audit: DataFrame
    quality: DataFrame
    gold: Mapping[str, DataFrame] = field(default_factory=dict)


def run_cycle(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    source: Source | Mapping[str, DataFrame],
    paths: LakePaths,
    backfill: bool = False,
    backfill_from: str = EPOCH_DATE,
    buckets: int = 64,
    database: str | None = None,
) -> CycleReport:
    """Ingest, refine, publish. Running it again without new source rows leaves every table as it is.

    ``specs`` may name any tables; the gold tables are those whose sources are among them.

    With ``database`` the gold tables are also published in the catalog, with their comments and properties.
    """
    by_table = {s.table: s for s in specs}
    audit = ingest_all(spark, specs, source, paths, backfill, backfill_from)
    landed = landed_schemas(spark, specs, paths)
    run_silver(spark, specs, landed, paths.bronze, paths.silver, database)
    schemas = {t: silver_schema(spark, s, landed.get(t) or s.columns) for t, s in by_table.items()}
    gold = publish_dimensions(spark, by_table, schemas, landed.keys(), paths, buckets)
    if FACT in by_table:
        gold[FACT_TABLE] = publish_fact(spark, schemas[FACT], FACT in landed, paths, database)
        gold[DAILY_TABLE] = publish_daily(spark, gold[FACT_TABLE], paths)
        if {"gold_dim_track_scd1", "gold_dim_artist_scd1"} <= gold.keys():
            gold[TOP_TABLE] = publish_top(spark, gold, paths)
    count_others(spark, by_table, schemas, landed.keys(), paths)
    if database is not None:
        publish_catalog(spark, gold, paths, database)
    checked = [rule_totals(spark, _counts(paths, s.table)) for s in specs if s.rules]
    quality = reduce(DataFrame.unionAll, checked) if checked else rule_totals(spark, _counts(paths, "none"))
    return CycleReport(audit, quality, gold)


def _counts(paths: LakePaths, table: str) -> str:
    return f"{paths.audit}-rules/{table}"


def landed_schemas(
    spark: SparkSession, specs: Sequence[TableSpec], paths: LakePaths
) -> dict[str, StructType]:
    """The registered schema of every table with at least one batch in bronze."""
    found = {}
    for spec in specs:
        schema = registered_schema(spark, paths.registry, spec.table)
        if schema is not None and path_exists(spark, f"{paths.bronze}/{spec.table}"):
            found[spec.table] = schema
    return found


def publish_dimensions(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    schemas: Mapping[str, StructType],
    landed: Collection[str],
    paths: LakePaths,
    buckets: int,
) -> dict[str, DataFrame]:
    """Stream what is new in the silver change logs into the dimensions, all side by side."""
    stores, queries = {}, []
    for name, table in DIMENSIONS.items():
        if table not in specs:
            continue
        spec, base = specs[table], f"{paths.gold}/{name}"
        stores[name] = DimensionStore(f"{base}/data", spec.keys, spec.sequence, spec.track, buckets)
        if table in landed:
            arriving, checkpoint = stream_files(spark, f"{paths.silver}/{table}/data", schemas[table]), f"{base}/checkpoint"
            land = stores[name].sink(checkpoint)
            if spec.rules:
                arriving = with_source_file(arriving)
                land = counted_sink(spec.rules, table, _counts(paths, table), checkpoint, land)
            queries.append(available_now(arriving, checkpoint, name).foreachBatch(land).start())
    await_all(queries)
    return {name: store.read(spark, schemas[DIMENSIONS[name]]) for name, store in stores.items()}


def count_others(
    spark: SparkSession,
    specs: Mapping[str, TableSpec],
    schemas: Mapping[str, StructType],
    landed: Collection[str],
    paths: LakePaths,
) -> None:
    """Count the rules of tables that no dimension is made of; only what is new is read."""
    queries = []
    for table in sorted(set(landed) - set(DIMENSIONS.values())):
        if specs[table].rules:
            base = _counts(paths, table)
            arriving = with_source_file(stream_files(spark, f"{paths.silver}/{table}/data", schemas[table]))
            land = counted_sink(specs[table].rules, table, base, f"{base}-checkpoint", lambda batch, number: None)
            queries.append(available_now(arriving, f"{base}-checkpoint", f"rules-{table}").foreachBatch(land).start())
    await_all(queries)


def publish_fact(
    spark: SparkSession, schema: StructType, landed: bool, paths: LakePaths, database: str | None = None
) -> DataFrame:
    """Stream new silver events through the rules into the fact table."""
    base = f"{paths.gold}/{FACT_TABLE}"
    shape = fact_stream(spark.createDataFrame([], schema)).schema
    if landed:
        if database is not None:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        table = database and f"{database}.{FACT_TABLE}"
        arriving = stream_files(spark, f"{paths.silver}/{FACT}/data", schema)
        # A day's rows of a batch go to a few tasks, and so to a few files, however many tasks have read them.
        dealt = fact_stream(arriving).repartition("stream_date", F.pmod(F.hash("stream_id"), F.lit(FILES_A_DAY)))
        query = append_stream(dealt, f"{base}/data", f"{base}/checkpoint", table, FACT_TABLE, ["stream_date"])
        await_all([query])
    return read_or_empty(spark, f"{base}/data", shape)


def _by_day(
    spark: SparkSession, name: str, fact: DataFrame, paths: LakePaths, summed: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Sums of the facts of each day, brought up to date for the days that new facts fall on; other days are not read again."""
    base, data = f"{paths.gold}/{name}", f"{paths.gold}/{FACT_TABLE}/data"
    store = PartialStore(f"{base}/days", "stream_date")

    def refresh(batch: DataFrame, _: int) -> None:
        days = store.touched(event_date(batch))
        store.replace(spark, days, summed(store.only(fact, days)))

    if path_exists(spark, data):
        arriving = stream_files(spark, data, StructType([fact.schema["stream_timestamp"]]))
        await_all([available_now(arriving, f"{base}/checkpoint", name).foreachBatch(refresh).start()])
    return store.read(spark, summed(fact).schema)


def publish_daily(spark: SparkSession, fact: DataFrame, paths: LakePaths) -> DataFrame:
    """Bring the daily mart up to date."""
    return _by_day(spark, DAILY_TABLE, fact, paths, lambda facts: daily_metrics(facts, extended=True, ordered=False))


def publish_top(spark: SparkSession, gold: Mapping[str, DataFrame], paths: LakePaths) -> DataFrame:
    """Bring the sums of each day and track up to date, and rank the artists by the sums of their tracks.

    A reader of the mart sees the last ranking that was written whole.
    """
    track = lambda facts: count_per_key(facts, ["stream_date", "track_id"], "stream_id", "listen_duration")
    by_day = _by_day(spark, TOP_TABLE, gold[FACT_TABLE], paths, track)
    sums = by_day.groupBy("track_id").agg(F.sum("__rows").alias("__rows"), F.sum("__total").alias("__total"))
    top = creators_by_totals(sums, gold["gold_dim_track_scd1"], gold["gold_dim_artist_scd1"])
    publish_run(top, f"{paths.gold}/{TOP_TABLE}/data")
    return read_run(spark, f"{paths.gold}/{TOP_TABLE}/data", top.schema)


def publish_catalog(spark: SparkSession, gold: Mapping[str, DataFrame], paths: LakePaths, database: str) -> None:
    """Show the dimensions and marts as catalog tables; the fact table is filled by its own stream.

    What hasn't changed since it was last shown isn't written again. A table is pointed at its new files when they are whole.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in gold.items():
        table = f"{database}.{name}"
        if name != FACT_TABLE:
            publish_table(df, table, f"{paths.gold}/{name}/published", COMMENTS[name], PROPERTIES, _stamp(spark, paths, gold, name))
        elif spark.catalog.tableExists(table):
            describe_table(spark, table, COMMENTS[name], PROPERTIES)


def _stamp(spark: SparkSession, paths: LakePaths, gold: Mapping[str, DataFrame], name: str) -> str:
    """The commits that a gold table is derived from; the ranking also depends on its dimensions."""
    of = {"gold_dim_track_scd1", "gold_dim_artist_scd1"} & gold.keys() if name == TOP_TABLE else set()
    logs = [f"{n}/{part}" for n in sorted({name, *of}) for part in ("data", "days")]
    return " ".join(str(CommitLog(f"{paths.gold}/{log}/commits").latest(spark)[0]) for log in logs)
