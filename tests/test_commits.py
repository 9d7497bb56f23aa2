"""Numbered commits, and aggregates and counts that nothing makes count twice."""

from datetime import datetime, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.joins import count_per_key
from tidemark.operators.quality import expect, expect_or_drop
from tidemark.sources.commits import KEPT, CommitLog, ConcurrentCommit, knows, merged, to_merge, with_batch
from tidemark.streaming import files
from tidemark.streaming.files import available_now, await_all, counted_sink, rule_totals, stream_files, with_source_file
from tidemark.streaming.partials import PartialStore

SCHEMA = StructType().add("day", "date").add("item", "integer").add("seconds", "integer")
D0 = datetime(2025, 1, 1).date()


def d(n):
    return D0 + timedelta(days=n)


# ---- commits -------------------------------------------------------------------------------------------------------
def test_a_commit_is_made_once(spark, tmp_path):
    log = CommitLog(f"{tmp_path}/log")
    assert log.latest(spark) == (-1, {})
    log.commit(spark, 0, {"a": [1, "é"]})
    with pytest.raises(ConcurrentCommit):
        log.commit(spark, 0, {"a": 2})
    assert log.latest(spark) == (0, {"a": [1, "é"]})
    assert [p.name for p in (tmp_path / "log").iterdir() if "-" in p.name] == []


def test_old_commits_go(spark, tmp_path):
    log = CommitLog(f"{tmp_path}/log")
    for n in range(KEPT + 3):
        log.commit(spark, n, {"n": n})
    assert log.numbers(spark) == list(range(3, KEPT + 3)) and log.latest(spark)[1] == {"n": KEPT + 2}


def test_batches_of_a_stream_are_known_up_to_the_last():
    streams = with_batch(with_batch({}, "s/3"), "other")
    assert knows(streams, "s/3") and knows(streams, "s/0") and knows(streams, "other")
    assert not knows(streams, "s/4") and not knows(streams, "t/0")


def test_runs_are_rewritten_as_often_as_there_are_levels():
    runs, written = [], 0
    for n in range(100):
        runs, written = [*runs, {"folder": n, "level": 0, "size": 1}], written + 1
        count = to_merge(runs, 8)
        if count > 1:
            size = sum(r["size"] for r in runs[-count:])
            runs, written = merged(runs, count, f"m{n}"), written + size
            runs[-1]["size"] = size
        levels = [r["level"] for r in runs]
        assert levels == sorted(levels, reverse=True) and len({x for x in levels if x}) == sum(x > 0 for x in levels)
    assert sum(r["size"] for r in runs) == 100 and written <= 100 * 5


# ---- aggregates by partition ---------------------------------------------------------------------------------------
@pytest.fixture
def facts(spark, tmp_path):
    """A table of facts by day; adding returns what is there now."""

    def add(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/facts")
        return spark.read.schema(SCHEMA).parquet(f"{tmp_path}/facts")

    return add


def sums(df):
    return count_per_key(df, ["day", "item"], "item", "seconds")


def refresh(spark, store, batch, table):
    days = store.touched(batch)
    store.replace(spark, days, sums(store.only(table, days)))


def test_partitions_are_replaced_whole(spark, tmp_path, facts):
    store, shape = PartialStore(f"{tmp_path}/sums", "day"), sums(facts((d(0), 1, 5))).schema
    assert store.read(spark, shape).count() == 0
    table = facts((d(0), 1, 7), (d(1), 2, 1), (None, 3, 4))
    refresh(spark, store, table, table)
    assert values(store.read(spark, shape)) == values(sums(table))
    late = spark.createDataFrame([(d(0), 2, 2)], SCHEMA)
    table = facts((d(0), 2, 2))
    for _ in range(3):  # a batch that comes again
        refresh(spark, store, late, table)
    assert values(store.read(spark, shape)) == values(sums(table))
    refresh(spark, store, table, table)  # all of it comes again
    assert values(store.read(spark, shape)) == values(sums(table))


def test_a_batch_writes_only_its_partitions(spark, tmp_path, facts):
    store = PartialStore(f"{tmp_path}/sums", "day")
    table = facts(*[(d(n), n, n) for n in range(9)])
    refresh(spark, store, table, table)
    refresh(spark, store, table.filter(F.col("day") == F.lit(d(4))), table)
    assert len(list((tmp_path / "sums/rows/run=1").glob("partial_of=*"))) == 1
    plan = store.only(table, [d(4)])._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "In(day" in plan or "EqualTo(day" in plan


def test_a_partition_that_is_empty_now_is_forgotten(spark, tmp_path, facts):
    store, table = PartialStore(f"{tmp_path}/sums", "day"), facts((d(0), 1, 5), (d(1), 1, 5))
    refresh(spark, store, table, table)
    rest = table.filter(F.col("day") != F.lit(d(0)))
    refresh(spark, store, table, rest)
    assert values(store.read(spark, sums(table).schema)) == values(sums(rest))


def test_a_run_that_died_is_without_trace(spark, tmp_path, facts, monkeypatch):
    store, table = PartialStore(f"{tmp_path}/sums", "day"), facts((d(0), 1, 5))
    refresh(spark, store, table, table)
    more = facts((d(0), 1, 6), (d(1), 1, 6))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", dies)
        with pytest.raises(RuntimeError):
            refresh(spark, store, more, more)
    assert values(store.read(spark, sums(table).schema)) == [(d(0), 1, 1, 5)]
    refresh(spark, store, more, more)
    assert values(store.read(spark, sums(table).schema)) == values(sums(more))


# ---- rule counts by file -------------------------------------------------------------------------------------------
RULES = [expect("long", "seconds >= 10"), expect_or_drop("item", "item > 0")]


def drop(spark, base, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")


def run(spark, base, checkpoint, land=lambda batch, number: None, max_files=1):
    arriving = with_source_file(stream_files(spark, f"{base}/in", SCHEMA, max_files))
    sink = counted_sink(RULES, "t", f"{base}/counts", f"{base}/{checkpoint}", land)
    await_all([available_now(arriving, f"{base}/{checkpoint}").foreachBatch(sink).start()])
    return values(rule_totals(spark, f"{base}/counts"))


def test_rules_count_each_file_once_under_any_checkpoint(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "COUNT_RUNS", 3)
    base, landed = str(tmp_path), []
    for n in range(7):
        drop(spark, base, (d(n), n, 5 * n), (d(n), None, 99))
    expected = [("t", "item", "drop", 6, 8), ("t", "long", "warn", 12, 2)]
    assert run(spark, base, "a", lambda batch, number: landed.append(batch.columns)) == expected
    assert landed == [SCHEMA.names] * 7
    assert run(spark, base, "b", max_files=4) == expected
    drop(spark, base, (d(9), 9, 9))
    more = [("t", "item", "drop", 7, 8), ("t", "long", "warn", 12, 3)]
    # A batch of files that have been counted and one that hasn't.
    assert run(spark, base, "c", max_files=100) == more
    assert run(spark, base, "a") == more and run(spark, base, "b") == more
    assert len(list((tmp_path / "counts/rows").glob("run=*"))) <= 8


def test_a_batch_whose_landing_failed_counts_once(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, base, (d(0), 1, 50))

    def fails(batch, number):
        batch.count()
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, base, "a", fails)
    assert values(rule_totals(spark, f"{base}/counts")) == []
    assert run(spark, base, "a") == [("t", "item", "drop", 1, 0), ("t", "long", "warn", 1, 0)]


def test_a_batch_is_read_once(spark, tmp_path):
    """The landing and the counting read what is kept of the batch."""
    base, plans = str(tmp_path), []
    drop(spark, base, (d(0), 1, 50))
    run(spark, base, "a", lambda batch, number: plans.append(batch._jdf.queryExecution().executedPlan().toString()))
    assert "InMemoryTableScan" in plans[0]
