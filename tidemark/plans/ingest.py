"""Source to bronze for every configured table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rows import RESCUED
from tidemark.sources.bronze import bronze_folder, land_bronze
from tidemark.sources.commits import CommitLog, ConcurrentCommit
from tidemark.sources.control import EPOCH_DATE, TableSpec
from tidemark.sources.extract import extract_window
from tidemark.sources.schemas import conform, evolve, merge_schemas, registered_schema
from tidemark.sources.tables import delete_path
from tidemark.sources.watermarks import (
    Watermark,
    commit_watermark,
    get_watermark,
    mark_text,
    mark_value,
    rows_fingerprint,
)

PIPELINE = "master_ingestion"
PARALLEL_TABLES = 5

AUDIT_SCHEMA = (
    "pipeline string, run_id string, table_name string, status string, row_count bigint, "
    "null_cdc_rows bigint, watermark string, error string, finished_at timestamp"
)

Source = Callable[[TableSpec], DataFrame]


@dataclass(frozen=True)
class LakePaths:
    """Folders of one lake, all below ``base``."""

    base: str

    def __getattr__(self, layer: str) -> str:
        if layer in ("bronze", "silver", "gold", "state", "registry", "audit"):
            return f"{self.base}/{layer}"
        raise AttributeError(layer)


def ingest_all(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    source: Source | Mapping[str, DataFrame],
    paths: LakePaths,
    backfill: bool = False,
    backfill_from: str = EPOCH_DATE,
) -> DataFrame:
    """Extract every table, a few at a time, and return one audit row per table.

    Tables are independent: one that fails is recorded as FAILED with its error, keeps its watermark, and does not stop
    the others. The audit rows are also appended to the audit table.
    """
    read = source if callable(source) else lambda spec: source[spec.table]
    narrow = getattr(source, "since", None)
    run_id = uuid.uuid4().hex[:12]

    def one(spec: TableSpec) -> tuple:
        try:
            outcome = ingest_table(spark, spec, read(spec), paths, run_id, backfill, backfill_from, narrow)
        except Exception as error:  # any failure of a table is a result, recorded below
            outcome = ("FAILED", 0, 0, None, f"{type(error).__name__}: {error}")
        return (PIPELINE, run_id, spec.table, *outcome, datetime.now(timezone.utc))

    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        rows = list(pool.map(one, specs))
    audit = spark.createDataFrame(rows, AUDIT_SCHEMA)
    audit.coalesce(1).write.mode("append").parquet(paths.audit)
    return audit


def ingest_table(
    spark: SparkSession,
    spec: TableSpec,
    df: DataFrame,
    paths: LakePaths,
    run_id: str,
    backfill: bool = False,
    backfill_from: str = EPOCH_DATE,
    narrow: Callable[[TableSpec, DataFrame, str], DataFrame] | None = None,
) -> tuple[str, int, int, str | None, str | None]:
    """Land one table's new rows, then advance its watermark: (status, rows, rows without cdc value, mark, error).

    The batch starts on the watermark, not after it, because rows with that very value may have been added or changed
    since. If nothing lies beyond the mark and the rows on it have the number and the fingerprint of those already landed,
    there is nothing to do; else the rows on the mark land again, and the overlap is removed by the dedupe in silver. The
    batch's end is fixed before it is read. A crash before the watermark is written repeats the batch. Of two ingests of a table at
    one time one fails and takes back what it has landed: each claims a numbered commit before it lands and makes the next
    one after that, and a number is given once. ``narrow`` may read the
    table from a mark on in a better way than by a filter on all of it, such as in balanced ranges.
    """
    fence = CommitLog(f"{paths.state}-commits/{spec.table}")
    number, _ = fence.latest(spark)
    kind = df.schema[spec.cdc_col].dataType
    mark = get_watermark(spark, paths.state, spec.table, kind)
    start = (spec.from_date or backfill_from) if backfill else mark.value

    cdc = F.col(spec.cdc_col)
    low, on_mark = mark_value(F.lit(start), kind), cdc == mark_value(F.lit(mark.value), kind)
    # Reads one column, and of that only what the pushed filter leaves.
    found = (
        df.filter((cdc >= low) | cdc.isNull())
        .agg(
            F.count(cdc).alias("rows"),
            F.count_if(cdc.isNull()).alias("unset"),
            F.count_if(on_mark).alias("on_mark"),
            mark_text(F.max(cdc), kind).alias("high"),
            F.max(cdc).cast("string").alias("shown"),
        )
        .first()
    )
    shown = spark.range(1).select(mark_value(F.lit(mark.value), kind).cast("string")).first()[0]
    if mark.value == EPOCH_DATE:
        shown = EPOCH_DATE
    if found["rows"] == 0 or (not backfill and _landed(spark, spec, df.filter(on_mark), paths, mark, found)):
        return ("EMPTY", 0, found["unset"], shown, None)

    batch = extract_window(df if narrow is None else narrow(spec, df, start), spec.cdc_col, start, found["high"])
    schema = evolve(spark, paths.registry, spec.table, df.schema, spec.columns)
    folder = bronze_folder(paths.bronze, spec.table, run_id)
    fence.commit(spark, number + 1, {"run": run_id, "landing": folder})
    rows, at_high, fingerprint = land_bronze(conform(batch, schema, RESCUED), folder, spec.cdc_col, found["high"])
    try:
        fence.commit(spark, number + 2, {"run": run_id, "landed": folder})
    except ConcurrentCommit:
        delete_path(spark, folder)
        raise
    commit_watermark(spark, paths.state, spec.table, Watermark(found["high"], at_high, fingerprint), run_id)
    # Without a backfill the batch started on the mark, so its end is the new one; a backfill may end below it.
    ahead = backfill and get_watermark(spark, paths.state, spec.table, kind).value != found["high"]
    return ("OK", rows, found["unset"], shown if ahead else found["shown"], None)


def _landed(spark: SparkSession, spec: TableSpec, rows: DataFrame, paths: LakePaths, mark: Watermark, found) -> bool:
    """Whether all rows found lie on the mark and are those that have landed. Reads whole rows only on the mark."""
    if not found["rows"] == found["on_mark"] == mark.rows_at_value:
        return False
    schema = merge_schemas(registered_schema(spark, paths.registry, spec.table) or spec.columns, rows.schema)
    landed = conform(rows, schema, RESCUED)
    return landed.agg(rows_fingerprint(landed, F.lit(True)).alias("f")).first()["f"] == mark.fingerprint
