from datetime import date, datetime, timedelta

import pytest
from conftest import values

from tidemark.plans.cycle import run_cycle
from tidemark.plans.ingest import LakePaths
from tidemark.plans.marts import daily_metrics
from tidemark.plans.model import (
    ARTIST_COLUMNS,
    COMMENTS,
    DATE_COLUMNS,
    DIMENSIONS,
    FACT_COLUMNS,
    MODEL,
    TRACK_COLUMNS,
    USER_COLUMNS,
    dimension,
    star_query,
)
from tidemark.streaming.files import stream_files

T0 = datetime(2025, 9, 1, 12)


def t(n):
    return T0 + timedelta(days=n)


USERS = [
    (1, " ann ", "US", "Free", date(2024, 1, 1), None, t(1)),
    (2, "bob", "UK", "Family", date(2024, 1, 1), None, t(2)),
    (3, "eve", "UK", "Pirate", date(2024, 1, 1), None, t(2)),
]
USER_CHANGES = [
    (1, "ann", "US", "Premium", date(2024, 1, 1), None, t(9)),
    (2, "bob", "UK", "Free", date(2024, 1, 1), None, t(4)),
]
ARTISTS = [(1, "A", "Pop", "US", t(1)), (2, "B", "Rock", "UK", t(1))]
ARTIST_CHANGES = [(2, "B", "Jazz", "UK", t(5))]
TRACKS = [
    (10, "-one-", 1, "x", 149, None, t(1)),
    (11, "two-too", 2, "x", 299, None, t(1)),
    (12, "three", 2, "x", 300, None, t(1)),
    (13, "bad", 2, "x", 0, None, t(1)),
]
DATES = [(20250901, date(2025, 9, 1), 1, 9, 2025, "Monday")]
FACTS = [
    (1, 1, 10, 20250901, 60, "Mobile", t(2)),
    (2, 1, 11, 20250901, 30, "Mobile", t(2)),
    (3, 2, 11, 20250901, 90, "Desktop", t(3)),
    (4, 2, 12, 20250901, 0, "Desktop", t(3)),
    (5, None, 12, 20250901, 12, "Desktop", t(3)),
]
LATE_FACTS = [(6, 2, 12, 20250901, 45, "Mobile", t(3)), (7, 1, 10, 20250901, 15, "Mobile", t(4))]


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


@pytest.fixture
def source(spark):
    def build(users=(), artists=(), facts=()):
        return {
            "DimUser": spark.createDataFrame(USERS + list(users), USER_COLUMNS),
            "DimArtist": spark.createDataFrame(ARTISTS + list(artists), ARTIST_COLUMNS),
            "DimTrack": spark.createDataFrame(TRACKS, TRACK_COLUMNS),
            "DimDate": spark.createDataFrame(DATES, DATE_COLUMNS),
            "FactStream": spark.createDataFrame(FACTS + list(facts), FACT_COLUMNS),
        }

    return build


def everything(report):
    return {name: values(df) for name, df in report.gold.items()}


def test_full_cycle_then_changes_then_nothing_new(spark, source, paths):
    specs = list(MODEL.values())
    first = run_cycle(spark, specs, source(), paths, buckets=2)
    assert {r["status"] for r in first.audit.collect()} == {"OK"}
    gold = first.gold

    users = gold["gold_dim_user_scd2"].orderBy("user_id").collect()
    assert [(u["user_name"], u["subscription_type"], u["__START_AT"], u["__END_AT"]) for u in users] == [
        ("ANN", "Free", t(1), None),
        ("BOB", "Family", t(2), None),
    ]
    tracks = gold["gold_dim_track_scd1"].orderBy("track_id").collect()
    assert [(r["track_name"], r["durationFlag"]) for r in tracks] == [
        ("one", "low"),
        ("two too", "medium"),
        ("three", "high"),
    ]
    assert "_rescued_data" not in gold["gold_dim_track_scd1"].columns
    facts = gold["gold_fact_stream"].orderBy("stream_id").collect()
    assert [(f["stream_id"], f["stream_date"]) for f in facts] == [
        (1, t(2).date()),
        (2, t(2).date()),
        (3, t(3).date()),
        (5, t(3).date()),
    ]
    daily = values(gold["gold_daily_streaming_metrics"].select("stream_date", "total_streams", "unique_listeners"))
    assert daily == [(t(2).date(), 2, 1), (t(3).date(), 2, 1)]
    assert values(gold["gold_top_artists_by_streams"]) == [(1, "A", "Pop", 1, 60), (2, "B", "Rock", 3, 132)]
    failed = {r["rule"]: r["failed"] for r in first.quality.collect()}
    assert failed == {
        "valid_user_id": 0,
        "valid_subscription": 1,
        "valid_artist_id": 0,
        "valid_track_id": 0,
        "valid_duration": 1,
        "positive_listen_duration": 1,
        "valid_user_fk": 1,
        "valid_track_fk": 0,
    }

    changed = source(USER_CHANGES, ARTIST_CHANGES, LATE_FACTS)
    second = run_cycle(spark, specs, changed, paths, buckets=2, database="lake")
    versions = second.gold["gold_dim_user_scd2"].orderBy("user_id", "__START_AT").collect()
    assert [(v["user_id"], v["subscription_type"], v["__START_AT"], v["__END_AT"]) for v in versions] == [
        (1, "Free", t(1), t(9)),
        (1, "Premium", t(9), None),
        (2, "Family", t(2), t(4)),
        (2, "Free", t(4), None),
    ]
    assert values(second.gold["gold_dim_artist_scd1"].select("artist_id", "genre")) == [(1, "Pop"), (2, "Jazz")]
    assert sorted(r["stream_id"] for r in second.gold["gold_fact_stream"].collect()) == [1, 2, 3, 5, 6, 7]

    wide = star_query(spark, second.gold).orderBy("stream_id").collect()
    assert [(w["stream_id"], w["subscription_type"], w["genre"]) for w in wide] == [
        (1, "Premium", "Pop"),
        (2, "Premium", "Jazz"),
        (3, "Free", "Jazz"),
        (5, None, "Jazz"),
        (6, "Free", "Jazz"),
        (7, "Premium", "Pop"),
    ]

    # The dimensions, kept up to date batch by batch, equal those derived from the whole logs.
    for name, table in DIMENSIONS.items():
        log = spark.read.parquet(f"{paths.silver}/{table}/data")
        assert values(second.gold[name]) == values(dimension(name, log).select(*second.gold[name].columns))

    whole = daily_metrics(second.gold["gold_fact_stream"], extended=True)
    assert values(second.gold["gold_daily_streaming_metrics"]) == values(whole)

    for name in second.gold:
        published = spark.read.table(f"lake.{name}")
        assert published.count() == second.gold[name].count()
        shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED lake.{name}").collect()}
        assert shown["Comment"] == COMMENTS[name] and "quality=gold" in shown["Table Properties"]

    before = everything(second)
    third = run_cycle(spark, specs, changed, paths, buckets=2)
    assert {r["status"] for r in third.audit.collect()} == {"EMPTY"}
    assert everything(third) == before

    # A full backfill delivers every row a second time.
    fourth = run_cycle(spark, specs, changed, paths, buckets=2, backfill=True)
    assert {r["status"] for r in fourth.audit.collect()} == {"OK"}
    assert everything(fourth) == before


def test_cycle_with_a_failed_table(spark, source, paths):
    partial = source()
    del partial["FactStream"]
    report = run_cycle(spark, list(MODEL.values()), partial, paths, buckets=2)
    status = {r["table_name"]: r["status"] for r in report.audit.collect()}
    assert status.pop("FactStream") == "FAILED" and set(status.values()) == {"OK"}
    assert report.gold["gold_fact_stream"].count() == 0
    assert report.gold["gold_dim_user_scd2"].count() == 2


def test_stream_without_files_waits_quietly(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert stream_files(spark, str(tmp_path / "none"), USER_COLUMNS).isStreaming
