"""The published model: five source tables of a music service, their rules, and the tables derived from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.operators.quality import expect, expect_or_drop, keep_valid
from tidemark.operators.rows import clean_title, duration_flag, event_date, standardize_name
from tidemark.operators.scd import current, scd1, scd2
from tidemark.operators.star import StarEntry, star_join
from tidemark.sources.control import TableSpec


def _columns(**kinds: str) -> StructType:
    schema = StructType()
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return schema


# Source tables, columns and types.
USER_COLUMNS = _columns(
    user_id="integer",
    user_name="string",
    country="string",
    subscription_type="string",
    start_date="date",
    end_date="date",
    updated_at="timestamp",
)
ARTIST_COLUMNS = _columns(
    artist_id="integer", artist_name="string", genre="string", country="string", updated_at="timestamp"
)
TRACK_COLUMNS = _columns(
    track_id="integer",
    track_name="string",
    artist_id="integer",
    album_name="string",
    duration_sec="integer",
    release_date="date",
    updated_at="timestamp",
)
DATE_COLUMNS = _columns(
    date_key="integer", date="date", day="integer", month="integer", year="integer", weekday="string"
)
FACT_COLUMNS = _columns(
    stream_id="long",
    user_id="integer",
    track_id="integer",
    date_key="integer",
    listen_duration="integer",
    device_type="string",
    stream_timestamp="timestamp",
)

# Names, predicates and actions of the quality rules.
USER_RULES = (
    expect("valid_user_id", "user_id IS NOT NULL"),
    expect_or_drop("valid_subscription", "subscription_type IN ('Free', 'Premium', 'Family', 'Student')"),
)
ARTIST_RULES = (expect("valid_artist_id", "artist_id IS NOT NULL"),)
TRACK_RULES = (
    expect("valid_track_id", "track_id IS NOT NULL"),
    expect_or_drop("valid_duration", "duration_sec > 0"),
)
FACT_RULES = (
    expect_or_drop("positive_listen_duration", "listen_duration > 0"),
    expect("valid_user_fk", "user_id IS NOT NULL"),
    expect("valid_track_fk", "track_id IS NOT NULL"),
)

MODEL: dict[str, TableSpec] = {
    spec.table: spec
    for spec in (
        TableSpec(
            "DimUser",
            "updated_at",
            columns=USER_COLUMNS,
            keys=("user_id",),
            sequence=("updated_at",),
            dedupe="version",
            transforms=(standardize_name,),
            rules=USER_RULES,
            track=("subscription_type", "country"),
        ),
        TableSpec(
            "DimTrack",
            "updated_at",
            columns=TRACK_COLUMNS,
            keys=("track_id",),
            sequence=("updated_at",),
            dedupe="version",
            transforms=(duration_flag, clean_title),
            rules=TRACK_RULES,
        ),
        TableSpec(
            "DimDate",
            "date",
            columns=DATE_COLUMNS,
            keys=("date_key",),
            sequence=("date",),
            dedupe="version",
        ),
        TableSpec(
            "DimArtist",
            "updated_at",
            columns=ARTIST_COLUMNS,
            keys=("artist_id",),
            sequence=("updated_at",),
            dedupe="version",
            rules=ARTIST_RULES,
        ),
        TableSpec(
            "FactStream",
            "stream_timestamp",
            columns=FACT_COLUMNS,
            keys=("stream_id",),
            sequence=("stream_timestamp",),
            dedupe="unseen_key",
            rules=FACT_RULES,
        ),
    )
}

# The columns of the wide table, in their order. Aliases and conditions are free.
STAR = (
    StarEntry("FactStream", "event", ("stream_id", "listen_duration", "device_type", "stream_timestamp")),
    StarEntry(
        "DimUser",
        "who",
        ("who.user_id", "who.user_name", "who.country", "who.subscription_type"),
        "who.user_id = event.user_id",
    ),
    StarEntry(
        "DimTrack",
        "what",
        ("what.track_id", "what.track_name", "what.album_name", "what.duration_sec", "what.durationFlag"),
        "what.track_id = event.track_id",
    ),
    StarEntry(
        "DimArtist", "maker", ("maker.artist_id", "maker.artist_name", "maker.genre"), "maker.artist_id = what.artist_id"
    ),
)

COMMENTS = {
    "gold_dim_date": "Calendar for reporting",
    "gold_dim_user_scd2": "Users with the history of tier and country",
    "gold_dim_artist_scd1": "Artists, latest state",
    "gold_dim_track_scd1": "Tracks, latest state",
    "gold_fact_stream": "Valid listening events with their day",
    "gold_daily_streaming_metrics": "Events and listening time per day",
    "gold_top_artists_by_streams": "Artists by number of events",
}
PROPERTIES = {"quality": "gold"}


# Published dimension -> source table. A table with tracked columns becomes a dimension of type 2, any other of type 1.
DIMENSIONS = {
    "gold_dim_date": "DimDate",
    "gold_dim_user_scd2": "DimUser",
    "gold_dim_artist_scd1": "DimArtist",
    "gold_dim_track_scd1": "DimTrack",
}


def dimension(name: str, log: DataFrame) -> DataFrame:
    """A published dimension, derived in one go from its whole silver change log."""
    spec = MODEL[DIMENSIONS[name]]
    valid = keep_valid(log, spec.rules)
    if spec.track:
        return scd2(valid, spec.keys, spec.sequence, spec.track)
    return scd1(valid, spec.keys, spec.sequence)


def fact_stream(silver_fact: DataFrame) -> DataFrame:
    """Valid events with their day; batch or stream."""
    return event_date(keep_valid(silver_fact, FACT_RULES), "stream_timestamp", "stream_date")


def star_query(spark: SparkSession, gold: Mapping[str, DataFrame]) -> DataFrame:
    """The wide table: every event with its user, track and artist as they are now."""
    tables = {
        "FactStream": gold["gold_fact_stream"],
        "DimUser": current(gold["gold_dim_user_scd2"]),
        "DimTrack": gold["gold_dim_track_scd1"],
        "DimArtist": gold["gold_dim_artist_scd1"],
    }
    return star_join(spark, STAR, tables)
