"""Extraction watermarks: one typed high-water mark per table, kept as an append-only table.

Every table has its own folder, because tables are ingested side by side and two jobs must not commit into one folder.

A mark is text. That of a timestamp is ``us:`` and its microseconds since 1970, so it means the same moment in whatever time
zone a session runs; that of any other type, which has no zone, is the value as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

from tidemark.sources.control import EPOCH_DATE
from tidemark.sources.tables import read_or_empty

_STATE = "cdc_value string, rows_at_value bigint, fingerprint string, run_id string, committed_at timestamp"
_MICROS = "us:"


@dataclass(frozen=True)
class Watermark:
    """The highest change value extracted so far, and the rows that carried exactly that value: how many, and what."""

    value: str = EPOCH_DATE
    rows_at_value: int = 0
    fingerprint: str | None = None


def mark_text(value: Column, kind: DataType) -> Column:
    """A change value as a mark."""
    if isinstance(kind, TimestampType):
        return F.concat(F.lit(_MICROS), F.unix_micros(value).cast("string"))
    return value.cast("string")


def mark_value(text: Column, kind: DataType) -> Column:
    """The change value of a mark; other text, such as a configured start, is cast as usual."""
    if not isinstance(kind, TimestampType):
        return text.cast(kind)
    micros = F.substring_index(text, _MICROS, -1).try_cast("bigint")
    return F.when(text.startswith(_MICROS), F.timestamp_micros(micros)).otherwise(text.try_cast(kind))


def rows_fingerprint(df: DataFrame, of: Column) -> Column:
    """An aggregate over all columns that tells sets of rows apart, in whatever order they come."""
    moments = {f.name for f in df.schema if isinstance(f.dataType, TimestampType)}
    shown = [F.unix_micros(F.col(f"`{c}`")).alias(c) if c in moments else F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(F.to_json(F.struct(*shown)))
    return F.coalesce(F.sum(F.when(of, row).cast("decimal(38,0)")), F.lit(0)).cast("string")


def get_watermark(spark: SparkSession, state_path: str, table: str, kind: DataType) -> Watermark:
    """The highest committed mark of a table, compared in the type of its change column; of equal ones the newest."""
    state = read_or_empty(spark, f"{state_path}/{table}", _STATE)
    typed = mark_value(F.col("cdc_value"), kind).alias("typed")
    best = state.agg(
        F.max(F.struct(typed, "committed_at", "rows_at_value", "cdc_value", "fingerprint")).alias("w")
    ).first()["w"]
    return Watermark() if best is None else Watermark(best["cdc_value"], best["rows_at_value"], best["fingerprint"])


def commit_watermark(spark: SparkSession, state_path: str, table: str, mark: Watermark, run_id: str) -> None:
    """Record a mark. Older marks stay; a lower mark never becomes the current one."""
    row = spark.range(1).select(
        F.lit(mark.value).alias("cdc_value"),
        F.lit(mark.rows_at_value).cast("bigint").alias("rows_at_value"),
        F.lit(mark.fingerprint).cast("string").alias("fingerprint"),
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("committed_at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{state_path}/{table}")


def watermark_table(spark: SparkSession, state_path: str, marks: dict[str, DataType]) -> DataFrame:
    """The current mark of each table, as text."""
    rows = [(t, get_watermark(spark, state_path, t, kind).value) for t, kind in marks.items()]
    return spark.createDataFrame(rows, "table_name string, cdc_value string")
