from datetime import datetime

import pytest
from conftest import values

from tidemark.plans import ingest
from tidemark.plans.ingest import LakePaths, ingest_all
from tidemark.sources.bronze import read_bronze
from tidemark.sources.control import TableSpec
from tidemark.sources.schemas import registered_schema

SCHEMA = "id int, v string, at timestamp"


def at(day):
    return datetime(2025, 1, day)


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path))


@pytest.fixture
def specs():
    return [TableSpec(t, "at", keys=("id",), sequence=("at",)) for t in ("a", "b", "c")]


def audit(frame):
    return {r["table_name"]: (r["status"], r["row_count"], r["watermark"]) for r in frame.collect()}


def bronze_ids(spark, paths, table):
    schema = registered_schema(spark, paths.registry, table)
    return sorted(r["id"] for r in read_bronze(spark, paths.bronze, table, schema).collect())


def test_rows_are_extracted_once(spark, rows, paths, specs):
    spec = specs[:1]
    first = rows(SCHEMA, (1, "x", at(1)), (2, "y", at(2)), (3, "z", None))
    report = ingest_all(spark, spec, {"a": first}, paths)
    assert audit(report) == {"a": ("OK", 2, "2025-01-02 00:00:00")}
    assert report.first()["null_cdc_rows"] == 1
    assert audit(ingest_all(spark, spec, {"a": first}, paths)) == {"a": ("EMPTY", 0, "2025-01-02 00:00:00")}
    assert bronze_ids(spark, paths, "a") == [1, 2]
    assert spark.read.parquet(paths.audit).count() == 2


def test_late_rows_on_the_watermark_are_picked_up(spark, rows, paths, specs):
    spec = specs[:1]
    first = rows(SCHEMA, (1, "x", at(1)), (2, "y", at(2)))
    ingest_all(spark, spec, {"a": first}, paths)
    tie = first.unionAll(rows(SCHEMA, (3, "tie", at(2))))
    assert audit(ingest_all(spark, spec, {"a": tie}, paths)) == {"a": ("OK", 2, "2025-01-02 00:00:00")}
    assert set(bronze_ids(spark, paths, "a")) == {1, 2, 3}
    assert audit(ingest_all(spark, spec, {"a": tie}, paths))["a"][0] == "EMPTY"
    more = tie.unionAll(rows(SCHEMA, (4, "new", at(3))))
    assert audit(ingest_all(spark, spec, {"a": more}, paths)) == {"a": ("OK", 3, "2025-01-03 00:00:00")}


def test_a_changed_row_on_the_watermark_is_picked_up(spark, rows, paths, specs):
    """As many rows as before on the mark, but not the same ones."""
    spec = specs[:1]
    ingest_all(spark, spec, {"a": rows(SCHEMA, (1, "x", at(1)), (2, "y", at(2)))}, paths)
    other = rows(SCHEMA, (1, "x", at(1)), (3, "z", at(2)))
    assert audit(ingest_all(spark, spec, {"a": other}, paths))["a"][:2] == ("OK", 1)
    assert set(bronze_ids(spark, paths, "a")) == {1, 2, 3}
    assert audit(ingest_all(spark, spec, {"a": other}, paths))["a"][0] == "EMPTY"


def test_the_mark_does_not_depend_on_the_time_zone(spark, rows, paths, specs):
    spec, zone = specs[:1], spark.conf.get("spark.sql.session.timeZone")
    first = rows(SCHEMA, (1, "x", at(1)), (2, "y", at(2)))
    ingest_all(spark, spec, {"a": first}, paths)
    more = first.unionAll(rows(SCHEMA, (3, "z", datetime(2025, 1, 2, 1))))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert audit(ingest_all(spark, spec, {"a": first}, paths))["a"][0] == "EMPTY"
        assert audit(ingest_all(spark, spec, {"a": more}, paths))["a"][:2] == ("OK", 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert set(bronze_ids(spark, paths, "a")) == {1, 2, 3}


def test_backfill_takes_older_rows_and_keeps_the_mark(spark, rows, paths, specs):
    spec = specs[:1]
    first = rows(SCHEMA, (2, "y", at(20)))
    ingest_all(spark, spec, {"a": first}, paths)
    old = rows(SCHEMA, (1, "x", at(5)), (0, "w", at(1)))
    report = ingest_all(spark, spec, {"a": old}, paths, backfill=True, backfill_from="2025-01-05")
    assert audit(report) == {"a": ("OK", 1, "2025-01-20 00:00:00")}
    assert bronze_ids(spark, paths, "a") == [1, 2]


def test_table_start_overrides_the_backfill_start(spark, rows, paths):
    spec = TableSpec("a", "at", from_date="2025-01-02")
    df = rows(SCHEMA, (1, "x", at(1)), (2, "y", at(2)))
    assert audit(ingest_all(spark, [spec], {"a": df}, paths, backfill=True))["a"][1] == 1


def test_an_empty_source_writes_nothing(spark, rows, paths, specs, tmp_path):
    empty = rows(SCHEMA, (1, "x", at(1))).filter("id > 1")
    assert audit(ingest_all(spark, specs[:1], {"a": empty}, paths)) == {"a": ("EMPTY", 0, "1900-01-01")}
    assert not (tmp_path / "bronze").exists()


def test_a_failing_table_does_not_stop_the_others(spark, rows, paths, specs):
    df = rows(SCHEMA, (1, "x", at(1)))
    report = ingest_all(spark, specs, {"a": df, "c": df}, paths)
    assert audit(report) == {
        "a": ("OK", 1, "2025-01-01 00:00:00"),
        "b": ("FAILED", 0, None),
        "c": ("OK", 1, "2025-01-01 00:00:00"),
    }
    failed = report.filter("status = 'FAILED'").first()
    assert failed["pipeline"] and failed["run_id"] and "KeyError" in failed["error"] and failed["finished_at"]
    again = ingest_all(spark, specs, {"a": df, "b": df, "c": df}, paths)
    assert {t: s for t, (s, _, _) in audit(again).items()} == {"a": "EMPTY", "b": "OK", "c": "EMPTY"}


def test_crash_between_bronze_and_watermark_repeats_the_batch(spark, rows, paths, specs, monkeypatch):
    df = rows(SCHEMA, (1, "x", at(1)))

    def crash(*args):
        raise OSError("gone")

    monkeypatch.setattr(ingest, "commit_watermark", crash)
    assert audit(ingest_all(spark, specs[:1], {"a": df}, paths))["a"][0] == "FAILED"
    monkeypatch.undo()
    assert audit(ingest_all(spark, specs[:1], {"a": df}, paths))["a"][0] == "OK"
    assert bronze_ids(spark, paths, "a") == [1, 1]


def test_new_and_drifting_columns(spark, rows, paths, specs):
    spec = specs[:1]
    ingest_all(spark, spec, {"a": rows("id int, v int, at timestamp", (1, 5, at(1)))}, paths)
    drift = rows("id int, v string, at timestamp, w string", (2, "six", at(2), "w"), (3, "7", at(2), None))
    ingest_all(spark, spec, {"a": drift}, paths)
    schema = registered_schema(spark, paths.registry, "a")
    assert schema.names == ["id", "v", "at", "w"]
    got = read_bronze(spark, paths.bronze, "a", schema).select("id", "v", "w", "_rescued_data")
    assert values(got) == [(1, 5, None, None), (2, None, "w", '{"v":"six"}'), (3, 7, None, None)]


def test_source_can_be_a_function(spark, rows, paths, specs):
    df = rows(SCHEMA, (1, "x", at(1)))
    assert audit(ingest_all(spark, specs, lambda spec: df, paths)).keys() == {"a", "b", "c"}
