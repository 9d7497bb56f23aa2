"""Dimension stores: any batches in any order against the operators over the whole log, and what a run reads and writes."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql.types import StructType

from tidemark.operators.scd import scd1, scd2
from tidemark.sources.commits import CommitLog, ConcurrentCommit
from tidemark.streaming import dimensions
from tidemark.streaming.dimensions import DimensionStore

SCHEMA = StructType().add("k", "integer").add("tier", "string").add("place", "string").add("at", "timestamp").add("n", "integer")
T0 = datetime(2025, 1, 1)


def t(n):
    return T0 + timedelta(days=n)


def change(rng, span):
    key, tier = rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["A", "A", "B", None])
    return (key, tier, rng.choice("xyz"), t(rng.randrange(span)), rng.choice([0, 0, 1, None]))


@pytest.mark.parametrize("seed, span", [(1, 6), (2, 40), (3, 400)])
def test_any_batches_give_the_history_of_the_whole_log(spark, tmp_path, monkeypatch, seed, span):
    """Late, tied and repeated changes, null keys and values; every batch shape, and merges of all levels."""
    monkeypatch.setattr(dimensions, "LOG_RUNS", 2)
    rng = random.Random(seed)
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at", "n"), ("tier",), buckets=2)
    log = []
    for run in range(7):
        batch = [change(rng, span) for _ in range(rng.randrange(0, 12))] + rng.sample(log, min(len(log), run))
        log += batch
        store.apply(spark.createDataFrame(batch, SCHEMA), f"s/{run}")
        whole = scd2(spark.createDataFrame(log, SCHEMA), ["k"], ["at", "n"], ["tier"])
        assert values(store.read(spark, SCHEMA)) == values(whole), (seed, run)


def ordered(run, keys, flips=3):
    """One change a key, in order; every third one changes the tracked value."""
    return [(k, "AB"[(run + k) // flips % 2], f"place {run * k % 97}", t(run), 0) for k in keys]


def log_reads(monkeypatch):
    """Which parts of a store are read from now on."""
    reads, real = [], DimensionStore._read

    def read(self, spark, schema, part, runs):
        reads.append((part, len(runs)))
        return real(self, spark, schema, part, runs)

    monkeypatch.setattr(DimensionStore, "_read", read)
    return reads


def test_changes_in_order_do_without_the_log(spark, tmp_path, monkeypatch):
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at", "n"), ("tier",), buckets=2)
    for run in range(3):
        store.apply(spark.createDataFrame(ordered(run, range(5)), SCHEMA), f"s/{run}")
    reads = log_reads(monkeypatch)
    store.apply(spark.createDataFrame(ordered(3, range(5)), SCHEMA), "s/3")
    assert ("log", 4) not in reads and ("log", 1) in reads  # the batch itself is a run of the log
    store.apply(spark.createDataFrame([(1, "Z", "late", t(0), 1)], SCHEMA), "s/4")
    assert ("log", 5) in reads


def test_a_late_change_writes_the_versions_next_to_it(spark, tmp_path):
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at", "n"), ("tier",), buckets=1)
    history = [(1, "AB"[n % 2], "x", t(10 * n), 0) for n in range(200)]
    store.apply(spark.createDataFrame(history, SCHEMA), "s/0")
    store.apply(spark.createDataFrame([(1, "C", "late", t(1005), 0)], SCHEMA), "s/1")
    # The version that held, the new one, the one behind it, and the row that says which stretch this is.
    assert spark.read.parquet(f"{tmp_path}/s/rows/of_run=1").count() == 4
    whole = scd2(spark.createDataFrame([*history, (1, "C", "late", t(1005), 0)], SCHEMA), ["k"], ["at", "n"], ["tier"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


class Written:
    """The bytes of all Parquet files that a store has ever written below its folder."""

    def __init__(self, monkeypatch):
        self.total, self.batches, real = 0, 0, DimensionStore._write

        def write(store, df, folder):
            real(store, df, folder)
            size = sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))
            self.total += size
            self.batches += size if "/log/" in folder and "-" not in folder.rsplit("/", 1)[1] else 0

        monkeypatch.setattr(DimensionStore, "_write", write)


def test_bytes_written_stay_within_ten_times_those_received(spark, tmp_path, monkeypatch):
    """As many levels of runs as a hundred runs have; a hundred runs with 16 of them to a level passed too."""
    monkeypatch.setattr(dimensions, "LOG_RUNS", 5)
    written = Written(monkeypatch)
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at", "n"), ("tier",), buckets=1)
    rng, log = random.Random(5), []
    for run in range(30):
        batch = ordered(run, rng.sample(range(3000), 600))
        log += batch
        store.apply(spark.createDataFrame(batch, SCHEMA).coalesce(1), f"s/{run}")
    assert written.total < 10 * written.batches
    whole = scd2(spark.createDataFrame(log, SCHEMA), ["k"], ["at", "n"], ["tier"])
    assert values(store.read(spark, SCHEMA)) == values(whole)


def test_a_batch_on_all_buckets_writes_its_own_size(spark, tmp_path):
    """Type 1: nothing that is there already is read or written."""
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at",), buckets=4)
    store.apply(spark.createDataFrame(ordered(0, range(2000)), SCHEMA), "s/0")
    store.apply(spark.createDataFrame(ordered(1, range(0, 2000, 100)), SCHEMA), "s/1")
    assert spark.read.parquet(f"{tmp_path}/s/rows/of_run=1").count() == 20
    log = spark.createDataFrame(ordered(0, range(2000)) + ordered(1, range(0, 2000, 100)), SCHEMA)
    assert values(store.read(spark, SCHEMA)) == values(scd1(log, ["k"], ["at"]))


@pytest.mark.parametrize("tracked", [(), ("tier",)])
def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch, tracked):
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at",), tracked, buckets=2)
    store.apply(spark.createDataFrame(ordered(0, range(5)), SCHEMA), "a/0")
    real = CommitLog.commit

    def late(log, spark, number, state):
        with monkeypatch.context() as patch:
            patch.setattr(CommitLog, "commit", real)
            DimensionStore(f"{tmp_path}/s", ("k",), ("at",), tracked, buckets=2).apply(spark.createDataFrame(ordered(1, range(5)), SCHEMA), "b/0")
        real(log, spark, number, state)

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", late)
        with pytest.raises(ConcurrentCommit):
            store.apply(spark.createDataFrame(ordered(2, range(5)), SCHEMA), "a/1")
    store.apply(spark.createDataFrame(ordered(2, range(5)), SCHEMA), "a/1")
    log = spark.createDataFrame([r for run in range(3) for r in ordered(run, range(5))], SCHEMA)
    assert values(store.read(spark, SCHEMA)) == values(scd2(log, ["k"], ["at"], ["tier"]) if tracked else scd1(log, ["k"], ["at"]))


def test_a_reader_finishes_while_the_store_goes_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dimensions, "LOG_RUNS", 2)
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at",), ("tier",), buckets=1)
    store.apply(spark.createDataFrame(ordered(0, range(5)), SCHEMA), "s/0")
    before = store.read(spark, SCHEMA)
    store.apply(spark.createDataFrame(ordered(4, range(5)), SCHEMA), "s/1")
    assert values(before) == values(scd2(spark.createDataFrame(ordered(0, range(5)), SCHEMA), ["k"], ["at"], ["tier"]))


def test_a_wider_schema_adds_a_column(spark, tmp_path):
    store = DimensionStore(f"{tmp_path}/s", ("k",), ("at",), ("tier",), buckets=1)
    wide = StructType([*SCHEMA.fields]).add("more", "string")
    store.apply(spark.createDataFrame(ordered(0, range(3)), SCHEMA), "s/0")
    store.apply(spark.createDataFrame([(*r, "m") for r in ordered(9, range(3))], wide), "s/1")
    rows = store.read(spark, wide).collect()
    assert {r["more"] for r in rows if r["__END_AT"] is None} == {"m"}
