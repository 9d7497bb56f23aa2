from datetime import date, datetime

import pytest
from conftest import values

from tidemark.operators.joins import join_current, join_using, join_via
from tidemark.plans.marts import (
    daily_kpis,
    daily_metrics,
    tier_distribution,
    top_creators,
    top_creators_minutes,
)

D1, D2 = date(2025, 10, 1), date(2025, 10, 2)


@pytest.fixture
def fact(rows):
    return rows(
        "stream_id bigint, user_id int, track_id int, listen_duration int, stream_date date",
        (1, 1, 10, 100, D1),
        (2, 1, 10, 50, D1),
        (3, None, 11, 30, D1),
        (4, 2, 12, 1, D2),
        (5, 3, 99, 7, D2),
    )


@pytest.fixture
def tracks(rows):
    return rows("track_id int, artist_id int, country string", (10, 1, "x"), (11, 2, "y"), (12, 2, "z"))


@pytest.fixture
def artists(rows):
    return rows("artist_id int, artist_name string, genre string", (1, "A", "Pop"), (2, "B", "Rock"))


def test_daily_metrics(fact):
    assert values(daily_metrics(fact)) == [(D1, 3, 2, 180, 60.0), (D2, 2, 2, 8, 4.0)]


def test_daily_metrics_extended_is_ordered(fact):
    assert [tuple(r) for r in daily_metrics(fact, extended=True).collect()] == [
        (D1, 3, 2, 1, 180, 3.0, 60.0),
        (D2, 2, 2, 2, 8, 0.13, 4.0),
    ]


def test_daily_kpis_newest_first(fact):
    assert [tuple(r) for r in daily_kpis(daily_metrics(fact)).collect()] == [
        (D2, 2, 2, 0.13, 4.0),
        (D1, 3, 2, 3.0, 60.0),
    ]


def test_top_creators_equals_join_then_group(fact, tracks, artists):
    assert [tuple(r) for r in top_creators(fact, tracks, artists).collect()] == [
        (1, "A", "Pop", 2, 150),
        (2, "B", "Rock", 2, 31),
    ]
    assert top_creators(fact, tracks, artists, n=1).count() == 1


def test_top_creators_counts_duplicated_dimension_rows_like_a_join(spark, fact, tracks, artists):
    twice = artists.unionAll(artists.filter("artist_id = 1"))
    double_track = tracks.unionAll(tracks.filter("track_id = 11"))
    got = values(top_creators(fact, double_track, twice))
    fact.createOrReplaceTempView("f"), double_track.createOrReplaceTempView("t"), twice.createOrReplaceTempView("a")
    plain = spark.sql(
        "SELECT artist_id, artist_name, genre, count(stream_id), sum(listen_duration) "
        "FROM f JOIN t USING (track_id) JOIN a USING (artist_id) GROUP BY 1, 2, 3"
    )
    assert got == values(plain)


def test_top_creators_minutes(fact, tracks, artists):
    report = top_creators_minutes(top_creators(fact, tracks, artists), n=1)
    assert report.first()["total_listen_minutes"] == 2.5


def test_tier_distribution_uses_the_open_version(rows, fact):
    at = datetime(2025, 1, 1)
    history = rows(
        "user_id int, subscription_type string, __START_AT timestamp, __END_AT timestamp",
        (1, "Free", at, at),
        (1, "Premium", at, None),
        (2, "Free", at, None),
    )
    assert [tuple(r) for r in tier_distribution(fact, history).collect()] == [("Premium", 2, 1), ("Free", 1, 1)]
    assert join_current(fact, history, "user_id").count() == 3


def test_joins(fact, tracks, artists):
    assert join_using(fact, tracks, "track_id").count() == 4
    assert join_via(fact, tracks, artists, "track_id", "artist_id").count() == 4
