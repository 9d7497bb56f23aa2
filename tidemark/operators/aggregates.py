"""General aggregates: value counts, row counts, largest value."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rows import ranked


def value_counts(df: DataFrame, c: str, count: str = "count") -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(count))
    return ranked(counts, count, [c])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def max_value(df: DataFrame, c: str, out: str = "max_value") -> DataFrame:
    return df.agg(F.max(F.col(c)).alias(out))
