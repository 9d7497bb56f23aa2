"""Duplicate removal.

The batch operators are plain aggregates, so each map task reduces its own copies before the shuffle and a group
that holds a large share of all rows never meets in one task as rows. Ties are broken by the row content, hence the
result does not depend on arrival order, file order or task retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever it is."""
    return df.dropDuplicates(list(keys))


def dedupe_latest(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The row with the highest sequence per key."""
    return _one_per_key(df, keys, sequence, F.max)


def dedupe_first(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The row with the lowest sequence per key."""
    return _one_per_key(df, keys, sequence, F.min)


def dedupe_version(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row per key and sequence: every version stays, redelivered copies go."""
    return _one_per_key(df, [*keys, *sequence], (), F.max)


def dedupe_stream(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    lateness: str | None = None,
    spread: int = 16,
) -> DataFrame:
    """First arrival per key on a stream.

    A stream has no map-side combine, so a key with very many copies would send them all to one state task. The copies
    are first reduced per (key, input partition modulo ``spread``): at most ``spread`` of them survive and only those
    meet on the key. Once a key has been seen, its state rejects every later arrival, so the result is the same.

    With ``lateness`` the state of both steps is dropped once the event time has passed by that much; copies further
    apart than that are not recognised. Without it the state keeps every key.
    """
    bounded = event_time is not None and lateness is not None
    if bounded:
        df = df.withWatermark(event_time, lateness)

    def distinct(part: DataFrame, cols: list[str]) -> DataFrame:
        return part.dropDuplicatesWithinWatermark(cols) if bounded else part.dropDuplicates(cols)

    if spread > 1:
        slot = "__slot"
        df = df.withColumn(slot, F.spark_partition_id() % F.lit(spread))
        df = distinct(df, [*keys, slot]).drop(slot)
    return distinct(df, list(keys))


def _one_per_key(
    df: DataFrame, keys: Sequence[str], sequence: Sequence[str], pick: Callable[[Column], Column]
) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in sequence]
    ordered = [*sequence, *rest]
    if not ordered:
        return df.select(*keys).distinct()
    winner = df.groupBy(*keys).agg(pick(F.struct(*ordered)).alias("__row"))
    return winner.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
