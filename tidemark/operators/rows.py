"""Projections, filters, row search, preview, ordering and union."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import LOW_BELOW, MEDIUM_BELOW, duration_label, standard_name, title_text

RESCUED = "_rescued_data"


def drop_columns(df: DataFrame, cols: Iterable[str] = (RESCUED,)) -> DataFrame:
    """Drop the named columns; names that are absent are ignored."""
    return df.drop(*cols)


def standardize_name(df: DataFrame, c: str = "user_name") -> DataFrame:
    return df.withColumn(c, standard_name(F.col(c))) if c in df.columns else df


def clean_title(df: DataFrame, c: str = "track_name") -> DataFrame:
    return df.withColumn(c, title_text(F.col(c))) if c in df.columns else df


def duration_flag(
    df: DataFrame,
    c: str = "duration_sec",
    out: str = "durationFlag",
    low: float = LOW_BELOW,
    medium: float = MEDIUM_BELOW,
) -> DataFrame:
    return df.withColumn(out, duration_label(F.col(c), low, medium)) if c in df.columns else df


def event_date(df: DataFrame, c: str = "stream_timestamp", out: str = "stream_date") -> DataFrame:
    return df.withColumn(out, F.to_date(F.col(c)))


def keep_positive(df: DataFrame, c: str) -> DataFrame:
    """Rows with ``c > 0``; zero, negative and NULL go."""
    return df.filter(F.col(c) > 0)


def keep_not_null(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c).isNotNull())


def keep_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(c).isin(list(values)))


def search_rows(df: DataFrame, pattern: str) -> DataFrame:
    """Rows in which any column, as text, contains the regular expression, ignoring case in any script."""
    expression = f"(?iu){pattern}"
    hits = [F.col(f"`{c}`").cast("string").rlike(expression) for c in df.columns]
    return df.filter(reduce(or_, hits))


def preview(df: DataFrame, n: int = 100, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in the given order (any ``n`` rows without one)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def ranked(
    df: DataFrame, measure: str, keys: Sequence[str], ascending: bool = False, n: int | None = None
) -> DataFrame:
    """Order by a measure, with the key as tie-break so that the order and any top ``n`` are determined."""
    lead = F.col(measure).asc() if ascending else F.col(measure).desc()
    ordered = df.orderBy(lead, *[F.col(k).asc() for k in keys])
    return ordered if n is None else ordered.limit(n)


def union_batches(*dfs: DataFrame) -> DataFrame:
    """All rows of all batches by column name; a column missing from a batch is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
