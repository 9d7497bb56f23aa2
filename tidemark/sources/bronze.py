"""Bronze: immutable parquet files in dated folders, exactly as extracted."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.rows import RESCUED
from tidemark.sources.watermarks import mark_value, rows_fingerprint


def bronze_folder(base: str, table: str, run_id: str, at: datetime | None = None) -> str:
    """``<base>/<table>/<yyyy-MM-dd>/<table>_<yyyyMMdd_HHmmss>_<run>``: a new folder for every batch."""
    moment = at or datetime.now(timezone.utc)
    return f"{base}/{table}/{moment:%Y-%m-%d}/{table}_{moment:%Y%m%d_%H%M%S}_{run_id}"


def with_rescue_column(df: DataFrame) -> DataFrame:
    """Add the rescue column, NULL, where the batch has none."""
    return df if RESCUED in df.columns else df.withColumn(RESCUED, F.lit(None).cast("string"))


def land_bronze(df: DataFrame, folder: str, cdc_col: str, high: str) -> tuple[int, int, str]:
    """Write one batch; return its row count, and of the rows with the highest change value their number and fingerprint.

    They are taken on the way past. The write is the last stage of its job, and Spark takes the metrics of a final stage
    once per task, however often a task was retried.
    """
    counts = Observation()
    batch = with_rescue_column(df)
    top = F.col(cdc_col) == mark_value(F.lit(high), df.schema[cdc_col].dataType)
    watched = batch.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(top).alias("rows_at_high"),
        rows_fingerprint(batch, top).alias("fingerprint"),
    )
    watched.write.mode("errorifexists").option("compression", "snappy").parquet(folder)
    found = counts.get
    return found["rows"], found["rows_at_high"], found["fingerprint"]


def read_bronze(spark: SparkSession, base: str, table: str, schema: StructType) -> DataFrame:
    """All batches of a table in one scan; columns that older files lack are NULL."""
    wide = schema if RESCUED in schema.names else StructType([*schema.fields]).add(RESCUED, "string")
    return spark.read.schema(wide).option("recursiveFileLookup", True).parquet(f"{base}/{table}")
