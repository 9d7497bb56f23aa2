"""Marts over the fact table and the dimensions. Column names are parameters; the defaults are the published model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import average, minutes
from tidemark.operators.joins import count_per_key, join_current
from tidemark.operators.rows import ranked


def daily_metrics(
    fact: DataFrame,
    extended: bool = False,
    ordered: bool = True,
    day: str = "stream_date",
    event: str = "stream_id",
    user: str = "user_id",
    seconds: str = "listen_duration",
) -> DataFrame:
    """Events, listening time and its mean per day.

    ``stream_events`` counts the rows with a user, which is not the number of users. The extended form has that as
    ``unique_listeners``, adds minutes, rounds the mean and is ordered by day unless the order would not be kept.
    """
    aggs = [
        F.count(event).alias("total_streams"),
        F.count(user).alias("stream_events"),
        F.sum(seconds).alias("total_listen_seconds"),
        F.count(seconds).alias("__timed"),
    ]
    if extended:
        aggs.append(F.count_distinct(user).alias("unique_listeners"))
    sums = fact.groupBy(day).agg(*aggs)
    total = F.col("total_listen_seconds")
    mean = average(total, F.col("__timed"))
    if not extended:
        return sums.select(
            day, "total_streams", "stream_events", total, mean.alias("avg_listen_duration_seconds")
        )
    metrics = sums.select(
        day,
        "total_streams",
        "stream_events",
        "unique_listeners",
        total,
        minutes(total).alias("total_listen_minutes"),
        F.round(mean, 1).alias("avg_listen_duration_seconds"),
    )
    return metrics.orderBy(day) if ordered else metrics


def daily_kpis(metrics: DataFrame, day: str = "stream_date") -> DataFrame:
    """The daily mart as a report, newest day first, rounded for reading."""
    return metrics.select(
        day,
        "total_streams",
        "stream_events",
        minutes(F.col("total_listen_seconds")).alias("total_minutes"),
        F.round("avg_listen_duration_seconds", 1).alias("avg_duration_sec"),
    ).orderBy(F.desc(day))


def top_creators(
    fact: DataFrame,
    items: DataFrame,
    creators: DataFrame,
    n: int | None = None,
    event: str = "stream_id",
    seconds: str = "listen_duration",
    item_key: str = "track_id",
    creator_key: str = "artist_id",
    labels: Sequence[str] = ("artist_name", "genre"),
) -> DataFrame:
    """Events and listening time per creator, reached from the facts through the item, most events first.

    The facts are summed per item before the first join and per creator before the second, so no join sees more than
    one row per key from that side, however hot the key. The last grouping only matters for a creator listed twice; it
    finds the rows partitioned by creator already.
    """
    per_item = count_per_key(fact, item_key, event, seconds)
    return creators_by_totals(per_item, items, creators, n, item_key, creator_key, labels)


def creators_by_totals(
    per_item: DataFrame,
    items: DataFrame,
    creators: DataFrame,
    n: int | None = None,
    item_key: str = "track_id",
    creator_key: str = "artist_id",
    labels: Sequence[str] = ("artist_name", "genre"),
) -> DataFrame:
    """The same from events and listening time per item, such as :func:`count_per_key` gives."""
    bridge = items.select(item_key, creator_key)
    labelled = creators.select(creator_key, *labels)
    sums = [F.sum("__rows").alias("__rows"), F.sum("__total").alias("__total")]
    per_creator = per_item.join(bridge, item_key).groupBy(creator_key).agg(*sums)
    totals = per_creator.join(labelled, creator_key).groupBy(creator_key, *labels).agg(*sums)
    result = totals.select(
        creator_key,
        *labels,
        F.col("__rows").alias("total_streams"),
        F.col("__total").alias("total_listen_duration_sec"),
    )
    return ranked(result, "total_streams", [creator_key, *labels], n=n)


def top_creators_minutes(top: DataFrame, keys: Sequence[str] = ("artist_id",), n: int = 10) -> DataFrame:
    """The first ``n`` of the creator mart with minutes beside the seconds."""
    with_minutes = top.withColumn("total_listen_minutes", minutes(F.col("total_listen_duration_sec")))
    return ranked(with_minutes, "total_streams", keys, n=n)


def tier_distribution(
    fact: DataFrame,
    history: DataFrame,
    user: str = "user_id",
    tier: str = "subscription_type",
    event: str = "stream_id",
) -> DataFrame:
    """Events and users per tier, by the tier that each user has now."""
    per_user = count_per_key(fact, user, event)
    tiers = join_current(per_user, history, user).groupBy(tier)
    counts = tiers.agg(F.sum("__rows").alias("total_streams"), F.count_distinct(user).alias("active_users"))
    return ranked(counts, "total_streams", [tier])
